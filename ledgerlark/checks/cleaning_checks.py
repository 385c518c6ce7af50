"""Registered queries for raw files, audits and cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from ledgerlark.checks.support import CLAIMS, snap_all, sql_snap
from ledgerlark.functions import cleaning as cl
from ledgerlark.operators import cleanse, quality
from ledgerlark.operators.merge import insert_if_absent
from ledgerlark.operators.ranking import first_per_key
from ledgerlark.schema import CHRONIC_FLAGS, LINE_ALLOWED, LINE_CODE, LINE_PAID, LINE_PROVIDER
from ledgerlark.schema import OUTPATIENT_CODE, OUTPATIENT_REVENUE
from ledgerlark.session import materialise, scratch_path
from ledgerlark.sources import raw
from ledgerlark.sources import sample_views as views
from ledgerlark.sources.tables import table_exists

_ZONES: dict[tuple[str, str], str] = {}

_BENE_FILE = "DE1_0_{year}_Beneficiary_Summary_File_Sample_{s}"


def _write_csvs(df: DataFrame, root: str, files: list[tuple[str, str]], sample: Column, file: Column, *unwritten: str) -> None:
    """The CSV files (sample, name) of one header by one job, so that the view behind them is run once."""

    def write(out: DataFrameWriter, path: str) -> None:
        out.option("header", True).option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False
        ).csv(path)

    places = {(s, f): f"{root}/csv/{s}/{f}.csv" for s, f in files}
    raw.write_by_file(df.withColumns({"_sample": sample, "_file": file}).drop(*unwritten), f"{root}/_writing", places, write)


def raw_zone(spark: SparkSession, sf_dir: str) -> str:
    """Claim files made from the test tables: whole tables, split over two samples by key.

    Sample 2 has no carrier B file and its outpatient file lacks the payment column, so that the
    audits have something to find.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _ZONES and table_exists(
        spark, f"{_ZONES[key]}/parquet/sample_01/{_BENE_FILE.format(year=2008, s=1)}.parquet"
    ):
        return _ZONES[key]
    root = scratch_path(spark, "raw-zone")
    wide = views.wide_claims(spark, sf_dir)
    k = F.coalesce(F.col("clm_id"), F.lit("0")).cast("bigint")
    part = F.when(k % 3 == 0, "1A").when(k % 3 == 1, "1B").otherwise("2A")
    carrier = "DE1_0_2008_to_2010_Carrier_Claims_Sample_"
    files = [(f"sample_0{n[0]}", carrier + n) for n in ("1A", "1B", "2A")]
    _write_csvs(wide, root, files, F.concat(F.lit("sample_0"), F.substring(part, 1, 1)), F.concat(F.lit(carrier), part))
    op = views.raw_outpatient(spark, sf_dir)
    odd = F.col("desynpuf_id").cast("bigint") % 2
    for s, rows in ((1, op.filter(odd == 0)), (2, op.filter(odd == 1).drop("clm_pmt_amt"))):  # two headers
        f = f"DE1_0_2008_to_2010_Outpatient_Claims_Sample_{s}"
        _write_csvs(rows, root, [(f"sample_0{s}", f)], F.lit(f"sample_0{s}"), F.lit(f))
    bene = views.raw_beneficiary(spark, sf_dir).drop("sample_id")
    years = F.when(F.col("year") <= 1996, 2008).when(F.col("year") <= 1998, 2009).otherwise(2010)
    half = F.coalesce(F.trim("desynpuf_id"), F.lit("0")).cast("bigint") % 2
    files = [(f"sample_0{s}", _BENE_FILE.format(year=y, s=s)) for s in (1, 2) for y in (2008, 2009, 2010)]
    file = F.format_string(_BENE_FILE.format(year="%d", s="%d"), years, half + 1)
    _write_csvs(bene.filter(half.isin(0, 1)), root, files, F.concat(F.lit("sample_0"), half + 1), file, "year")
    raw.convert_all(spark, f"{root}/csv", f"{root}/parquet")
    _ZONES[key] = root
    return root


# SQL for the same split of rows over files.
_FILES = f"""
wide AS ({views.WIDE_CLAIMS}), raw_op AS ({views.RAW_OUTPATIENT}), raw_bene AS ({views.RAW_BENEFICIARY}),
wide_k AS (SELECT *, CAST(coalesce(clm_id, '0') AS BIGINT) % 3 AS m FROM wide),
bene_k AS (SELECT *, CAST(coalesce(trim(desynpuf_id), '0') AS BIGINT) % 2 + 1 AS s,
                  CASE WHEN year <= 1996 THEN 2008 WHEN year <= 1998 THEN 2009 ELSE 2010 END AS y FROM raw_bene),
file_rows AS (
  SELECT 'carrier' AS kind, CASE m WHEN 2 THEN 2 ELSE 1 END AS s, CAST(NULL AS INT) AS y,
         'DE1_0_2008_to_2010_Carrier_Claims_Sample_' || CASE m WHEN 0 THEN '1A' WHEN 1 THEN '1B' ELSE '2A' END AS file_name,
         desynpuf_id AS id, clm_id AS cid, true AS has_cid FROM wide_k
  UNION ALL SELECT 'outpatient', CAST(desynpuf_id AS BIGINT) % 2 + 1, NULL,
         'DE1_0_2008_to_2010_Outpatient_Claims_Sample_' || (CAST(desynpuf_id AS BIGINT) % 2 + 1), desynpuf_id, clm_id, true FROM raw_op
  UNION ALL SELECT 'beneficiary', s, CAST(y AS INT), 'DE1_0_' || y || '_Beneficiary_Summary_File_Sample_' || s,
         desynpuf_id, NULL, false FROM bene_k),
expected AS (
  SELECT 'sample_0' || s AS sample, replace(pattern, '#', CAST(s AS VARCHAR)) AS file_name, target
  FROM (VALUES (1), (2)) samples(s), (VALUES ('DE1_0_2008_to_2010_Carrier_Claims_Sample_#A', 2350000),
       ('DE1_0_2008_to_2010_Carrier_Claims_Sample_#B', 2350000), ('DE1_0_2008_to_2010_Outpatient_Claims_Sample_#', 790000),
       ('DE1_0_2008_Beneficiary_Summary_File_Sample_#', 116352), ('DE1_0_2009_Beneficiary_Summary_File_Sample_#', 116352),
       ('DE1_0_2010_Beneficiary_Summary_File_Sample_#', 116352)) files(pattern, target)),
counted AS (SELECT 'sample_0' || s AS sample, file_name, count(*) AS rows FROM file_rows GROUP BY ALL),
row_audit AS (
  SELECT sample, file_name, rows, CAST(target AS BIGINT) AS target, abs(rows - target) / target AS deviation,
         CASE WHEN rows IS NULL THEN 'MISSING' WHEN rows = 0 THEN 'EMPTY' WHEN abs(rows - target) / target > 0.1 THEN 'DEVIATION' ELSE 'OK' END AS finding
  FROM expected LEFT JOIN counted USING (sample, file_name))"""


def src_csv_roundtrip(spark, sf_dir):
    """Every file discovered and read back as text: filled values and their characters, for every column."""
    root = raw_zone(spark, sf_dir)
    out = None
    for r in raw.discover(spark, f"{root}/csv").collect():
        back = raw.read_csv(spark, r["location"])
        totals = back.agg(*[F.struct(F.count(c), F.coalesce(F.sum(F.length(c)), F.lit(0))).alias(c) for c in back.columns])
        long = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`.col1").alias("filled"), F.col(f"`{c}`.col2").alias("chars")) for c in back.columns])
        part = totals.select(F.lit(r["file_name"]).alias("file_name"), F.inline(long))
        out = part if out is None else out.unionByName(part)
    return out


def src_staging_load(spark, sf_dir):
    """Rows per staging table, sample and year tag."""
    root = raw_zone(spark, sf_dir)
    out = None
    for kind in ("carrier", "outpatient", "beneficiary"):
        rows = raw.staging(spark, f"{root}/parquet", kind)
        year = F.col("year") if kind == "beneficiary" else F.lit(None)
        part = rows.groupBy(
            F.lit(kind).alias("file_type"), F.col("sample_id").cast("int").alias("sample_id"), year.cast("int").alias("year")
        ).agg(F.count("*").alias("rows"), F.count_distinct("desynpuf_id").alias("beneficiaries"))
        out = part if out is None else out.unionByName(part)
    return out


def src_load_log(spark, sf_dir):
    root = raw_zone(spark, sf_dir)
    out = None
    for kind in ("carrier", "outpatient", "beneficiary"):
        part = raw.load_log(raw.staging(spark, f"{root}/parquet", kind), kind)
        out = part if out is None else out.unionByName(part)
    return out.withColumn("sample_id", F.col("sample_id").cast("int"))


def _profile(spark, sf_dir):
    root, specs = raw_zone(spark, sf_dir), quality.expected_specs()
    found = [(r["sample"], r["file_name"], r["location"]) for r in raw.discover(spark, f"{root}/csv").collect()]
    groups = raw.group_files(spark, [f for f in found if f[:2] in specs])
    return quality.stack_profiles(
        spark, [quality.group_profiles(g.read(spark), g.columns, specs, [f[:2] for f in g.files]) for g in groups]
    )


def dq_row_count(spark, sf_dir):
    return snap_all(quality.row_count_audit(quality.expected_files(spark), _profile(spark, sf_dir)))


def dq_required_columns(spark, sf_dir):
    return quality.required_columns_audit(_profile(spark, sf_dir))


def dq_key_null_rate(spark, sf_dir):
    return snap_all(quality.key_null_audit(_profile(spark, sf_dir)))


def dq_summary(spark, sf_dir):
    profile = materialise(_profile(spark, sf_dir), "file-profiles")
    return quality.summary(
        [
            quality.row_count_audit(quality.expected_files(spark), profile),
            quality.required_columns_audit(profile),
            quality.key_null_audit(profile),
        ]
    )


def _with_id(df, *cols):
    return snap_all(df.select("clm_id", "desynpuf_id", *cols))


def clean_dates(spark, sf_dir):
    wide = views.wide_claims(spark, sf_dir)
    return _with_id(
        wide,
        cl.date_from_text(F.col("clm_from_dt")).alias("from_day"),
        cl.date_from_text(F.col("clm_thru_dt")).alias("thru_day"),
    )


BENE_AMOUNTS = [f"{kind}_{place}" for place in ("ip", "op", "car") for kind in ("medreimb", "benres", "pppymt")]
BENE_SMALL = [
    "bene_hi_cvrage_tot_mons", "bene_smi_cvrage_tot_mons", "bene_hmo_cvrage_tot_mons", "plan_cvrg_mos_num", "sp_alzhdmta", "sp_chf",
    "sp_chrnkidn", "sp_cncr", "sp_copd", "sp_depressn", "sp_diabetes", "sp_ischmcht", "sp_osteoprs", "sp_ra_oa", "sp_strketia",
]


def clean_numeric(spark, sf_dir):
    bene = views.raw_beneficiary(spark, sf_dir)
    return snap_all(
        bene.select(
            "desynpuf_id",
            "year",
            *[cl.double_from_text(F.col(c)).alias(c) for c in BENE_AMOUNTS],
            *[cl.small_int_from_text(F.col(c)).alias(c) for c in BENE_SMALL],
        )
    )


def clean_codes(spark, sf_dir):
    """Code columns and principal diagnosis of carrier and outpatient claims."""
    wide = views.wide_claims(spark, sf_dir)
    op = views.raw_outpatient(spark, sf_dir)
    dgns = cl.code_from_text(F.col("icd9_dgns_cd_1")).alias("prncpal_dgns_cd")
    return wide.select(
        F.lit("carrier").alias("source"), "clm_id", dgns, F.lit(None).cast("string").alias("prvdr_num")
    ).unionByName(
        op.select(F.lit("outpatient").alias("source"), "clm_id", dgns, cl.code_from_text(F.col("prvdr_num")).alias("prvdr_num"))
    )


def claim_provider_id(spark, sf_dir):
    wide = views.wide_claims(spark, sf_dir)
    return _with_id(wide, cl.first_filled(cl.present(wide, LINE_PROVIDER)).alias("at_physn_npi")).filter(
        "at_physn_npi IS NOT NULL"
    )


def claim_amounts(spark, sf_dir):
    wide = views.wide_claims(spark, sf_dir)
    paid, allowed = cl.money_sum(cl.present(wide, LINE_PAID)), cl.money_sum(cl.present(wide, LINE_ALLOWED))
    return _with_id(
        wide, paid.alias("clm_pmt_amt"), allowed.alias("allowed_amt"), cl.guarded_ratio(paid, allowed).alias("ratio")
    )


def claim_code_array(spark, sf_dir):
    """Ordered distinct codes of carrier claims, and procedure and revenue codes of outpatient claims."""
    wide, op = views.wide_claims(spark, sf_dir), views.raw_outpatient(spark, sf_dir)

    def part(source, df, codes, revenue):
        arr = cl.code_array(cl.present(df, codes))
        rev = cl.code_array(cl.present(df, revenue)) if revenue else F.array().cast("array<string>")
        return df.select(
            F.lit(source).alias("source"),
            "clm_id",
            "desynpuf_id",
            F.array_join(arr, ",").alias("codes"),
            F.try_element_at(arr, F.lit(1)).alias("primary_code"),
            F.array_join(rev, ",").alias("revenue"),
        )

    return part("carrier", wide, LINE_CODE, None).unionByName(part("outpatient", op, OUTPATIENT_CODE, OUTPATIENT_REVENUE))


def claim_calendar(spark, sf_dir):
    c = views.claims(spark, sf_dir)
    return c.groupBy(F.col("clm_from_dt").cast("string").alias("day")).agg(
        F.max("claim_year").alias("claim_year"), F.bool_or("is_weekend_claim").alias("weekend"), F.count("*").alias("claims")
    )


def bene_chronic_count(spark, sf_dir):
    b = cleanse.clean_beneficiaries(views.raw_beneficiary(spark, sf_dir))
    return b.select("desynpuf_id", F.col("year").cast("int").alias("year"), "chronic_condition_count")


def bene_clean(spark, sf_dir):
    rows = views.raw_beneficiary(spark, sf_dir)
    return snap_all(cleanse.clean_beneficiaries(rows.unionByName(rows)))  # repeated keys


def _flat(df):
    arrays = [f.name for f in df.schema.fields if f.dataType.typeName() == "array"]
    return snap_all(df.select(*[F.array_join(c, ",").alias(c) if c in arrays else F.col(c) for c in df.columns]))


#: Stand-ins for two code columns that the sample claims lack; the same text runs in both engines.
PLACE = "CASE length(clm_id) % 3 WHEN 0 THEN ' 11 ' WHEN 1 THEN 'nan' END"
CLAIM_TYPE = "CASE length(clm_id) % 2 WHEN 0 THEN '71' ELSE '72' END"


def _two_samples(rows):
    """Every row delivered in both samples, the later one first: one of them has to go."""
    return rows.withColumn("sample_id", F.lit("2")).unionByName(rows.withColumn("sample_id", F.lit("1")))


def claim_clean(spark, sf_dir):
    place, kind = (F.expr(e) for e in (PLACE, CLAIM_TYPE))
    wide = views.wide_claims(spark, sf_dir).withColumns({"line_place_of_srvc_cd": place, "nch_clm_type_cd": kind})
    return _flat(cleanse.clean_carrier(_two_samples(wide)))


def outpatient_clean(spark, sf_dir):
    return _flat(cleanse.clean_outpatient(_two_samples(views.raw_outpatient(spark, sf_dir))))


_DEDUP_ORDER = (
    "clm_from_dt", "desynpuf_id", "at_physn_npi", "primary_hcpcs_cd", "allowed_amt", "clm_pmt_amt", "place_of_service_cd",
)


def claim_dedup(spark, sf_dir):
    c = views.claims(spark, sf_dir).select("clm_id", *_DEDUP_ORDER)
    return snap_all(first_per_key(c, ["clm_id"], _DEDUP_ORDER))


def merge_insert_ignore(spark, sf_dir):
    """Claims from 1998 on inserted into a table that holds the earlier claims: new claim ids only."""
    c = views.claims(spark, sf_dir).select("clm_id", *_DEDUP_ORDER)
    target = c.filter("clm_from_dt < date'1998-01-01'")
    return snap_all(insert_if_absent(target, c.filter("clm_from_dt >= date'1998-01-01'"), ["clm_id"], _DEDUP_ORDER))


# --- SQL -----------------------------------------------------------------------------------------


def _date(c: str) -> str:
    d = f"split_part(trim({c}), '.', 1)"
    return f"CASE WHEN regexp_full_match({d}, '[0-9]{{8}}') THEN CAST(try_strptime({d}, '%Y%m%d') AS DATE) END"


def _num(c: str) -> str:
    return f"TRY_CAST(trim({c}) AS DOUBLE)"


def _small(c: str) -> str:
    return f"TRY_CAST({_num(c)} AS SMALLINT)"


def _code(c: str) -> str:
    return f"nullif(trim({c}), 'nan')"


def _line_sum(cols) -> str:
    return " + ".join(f"coalesce(TRY_CAST(trim({c}) AS DECIMAL(14,2)), 0)" for c in cols)


def _array(cols) -> str:
    items = ", ".join(f"trim({c})" for c in cols)
    return f"list_filter([{items}], lambda x: x IS NOT NULL AND lower(x) NOT IN ('', 'nan', 'none', '0'))"


def _distinct_join(cols) -> str:
    a = _array(cols)
    return (
        f"coalesce(array_to_string(list_filter({a}, lambda x, i: list_position({a}, x) = i), ','), '')"
    )


_WIDE = f"wide AS ({views.WIDE_CLAIMS})"
_OP = f"raw_op AS ({views.RAW_OUTPATIENT})"
_RB = f"raw_bene AS ({views.RAW_BENEFICIARY})"
_NPI = "coalesce(" + ", ".join(f"nullif(trim({c}), '')" for c in LINE_PROVIDER) + ")"
_PAID, _ALLOWED = _line_sum(LINE_PAID), _line_sum(LINE_ALLOWED)
_RATIO = (
    "CASE WHEN allowed > 0 THEN (CAST(paid * 100 AS BIGINT) * 20000 + CAST(allowed * 100 AS BIGINT))"
    " // (2 * CAST(allowed * 100 AS BIGINT)) / 10000.0 END"
)
_FLAG_COUNT = " + ".join(f"(CASE WHEN {_small(c)} = 1 THEN 1 ELSE 0 END)" for c in CHRONIC_FLAGS)


def _required_sql() -> str:
    source = {"carrier": "wide_k", "outpatient": "raw_op", "bene": "bene_k"}
    parts = []
    for key, spec in quality.FILE_SPECS.items():
        kind = key.split("_")[0]
        for s in (1, 2):
            if key == "carrier_b" and s == 2:
                continue
            where = {
                "carrier_a": f"m = {0 if s == 1 else 2}",
                "carrier_b": "m = 1",
                "outpatient": f"CAST(desynpuf_id AS BIGINT) % 2 = {s - 1}",
            }.get(key, f"s = {s} AND y = {key[-4:]}")
            for c in spec.required:
                there = not (kind == "outpatient" and s == 2 and c == "clm_pmt_amt")
                filled = f"count(nullif(CAST({c} AS VARCHAR), ''))" if there else "count(CASE WHEN false THEN 1 END)"
                name = spec.pattern.replace("{sample}", f"Sample_{s}")
                parts.append(
                    f"SELECT 'sample_0{s}' AS sample, '{name}' AS file_name, '{c}' AS \"column\", {str(there).lower()} AS present,"
                    f" {filled} AS filled FROM {source[kind]} WHERE {where}"
                )
    return " UNION ALL ".join(parts)


_COLUMN_AUDIT = f"column_audit AS (SELECT *, CASE WHEN present THEN 'OK' ELSE 'MISSING_COLUMN' END AS finding FROM ({_required_sql()}))"
_NULL_AUDIT = """
null_audit AS (SELECT *, CASE WHEN null_rate > 0.05 THEN 'HIGH_NULL_RATE' ELSE 'OK' END AS finding FROM (
  SELECT 'sample_0' || s AS sample, file_name, 'desynpuf_id' AS "column", avg(CAST(id IS NULL AS INT)) AS null_rate FROM file_rows GROUP BY ALL
  UNION ALL SELECT 'sample_0' || s, file_name, 'clm_id', avg(CAST(cid IS NULL AS INT)) FROM file_rows WHERE has_cid GROUP BY ALL))"""
_SEVERITY = (
    "CASE WHEN finding IN ('MISSING', 'EMPTY', 'MISSING_COLUMN', 'HIGH_NULL_RATE') THEN 'error'"
    " WHEN finding = 'DEVIATION' THEN 'warning' ELSE 'ok' END"
)

QUERIES = {
    f.__name__: f
    for f in (
        src_csv_roundtrip,
        src_staging_load,
        src_load_log,
        dq_row_count,
        dq_required_columns,
        dq_key_null_rate,
        dq_summary,
        clean_dates,
        clean_numeric,
        clean_codes,
        claim_provider_id,
        claim_amounts,
        claim_code_array,
        claim_calendar,
        bene_chronic_count,
        bene_clean,
        claim_clean,
        outpatient_clean,
        claim_dedup,
        merge_insert_ignore,
    )
}

_ORDER_SQL = ", ".join(f"{c} NULLS FIRST" for c in _DEDUP_ORDER)
_DEDUP_COLS = (
    "clm_id, CAST(clm_from_dt AS VARCHAR) AS clm_from_dt, desynpuf_id, at_physn_npi, primary_hcpcs_cd, "
    f"{sql_snap('allowed_amt')} AS allowed_amt, {sql_snap('clm_pmt_amt')} AS clm_pmt_amt, place_of_service_cd"
)


def _bene_select() -> str:
    smalls = {
        "sample_id": "CAST(sample_id AS VARCHAR)",
        "part_a_months": "bene_hi_cvrage_tot_mons",
        "part_b_months": "bene_smi_cvrage_tot_mons",
        "hmo_months": "bene_hmo_cvrage_tot_mons",
        **{new: old for old, new in CHRONIC_FLAGS.items()},
    }
    codes = {
        "desynpuf_id": "desynpuf_id",
        "sex_cd": "bene_sex_ident_cd",
        "race_cd": "bene_race_cd",
        "esrd_ind": "bene_esrd_ind",
        "state_code": "sp_state_code",
        "county_cd": "bene_county_cd",
    }
    money = {"inpatient": "medreimb_ip", "outpatient": "medreimb_op", "carrier": "medreimb_car"}
    return ", ".join(
        [f"{_code(c)} AS {n}" for n, c in codes.items()]
        + ["year"]
        + [f"CAST({_small(c)} AS INT) AS {n}" for n, c in smalls.items()]
        + [f"CAST({_date('bene_birth_dt')} AS VARCHAR) AS birth_date", f"CAST({_date('bene_death_dt')} AS VARCHAR) AS death_date"]
        + [f"CAST({_FLAG_COUNT} AS INT) AS chronic_condition_count"]
        + [f"{sql_snap(_num(c))} AS reimbursement_{n}" for n, c in money.items()]
    )




def _long(rows: str) -> str:
    return (
        "SELECT file_name, name AS \"column\", count(nullif(v, '')) AS filled, CAST(coalesce(sum(length(v)), 0) AS BIGINT) AS chars"
        f" FROM (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM ({rows})) UNPIVOT INCLUDE NULLS (v FOR name IN (COLUMNS(* EXCLUDE (file_name)))) GROUP BY ALL"
    )


_CARRIER_NAME = "'DE1_0_2008_to_2010_Carrier_Claims_Sample_' || CASE m WHEN 0 THEN '1A' WHEN 1 THEN '1B' ELSE '2A' END"
_OP_SAMPLE = "(CAST(desynpuf_id AS BIGINT) % 2 + 1)"
_LONG_FILES = f"""l1 AS ({_long(f"SELECT {_CARRIER_NAME} AS file_name, * EXCLUDE (m) FROM wide_k")}),
l2 AS ({_long(f"SELECT 'DE1_0_2008_to_2010_Outpatient_Claims_Sample_' || {_OP_SAMPLE} AS file_name, * FROM raw_op")}),
l3 AS ({_long("SELECT 'DE1_0_' || y || '_Beneficiary_Summary_File_Sample_' || s AS file_name, * EXCLUDE (s, y, year, sample_id) FROM bene_k")})
SELECT * FROM l1 UNION ALL SELECT * FROM l2 WHERE NOT (file_name LIKE '%_2' AND "column" = 'clm_pmt_amt') UNION ALL SELECT * FROM l3"""

ORACLE = {
    "src_csv_roundtrip": f"WITH {_FILES}, " + _LONG_FILES,
    "src_staging_load": f"WITH {_FILES} SELECT kind AS file_type, CAST(s AS INT) AS sample_id, y AS year, count(*) AS rows, count(DISTINCT id) AS beneficiaries FROM file_rows GROUP BY ALL",
    "src_load_log": f"WITH {_FILES} SELECT kind AS table_name, CAST(s AS INT) AS sample_id, file_name, count(*) AS rows_loaded FROM file_rows GROUP BY ALL",
    "dq_row_count": f"WITH {_FILES} SELECT sample, file_name, rows, target, {sql_snap('deviation')} AS deviation, finding, {_SEVERITY} AS severity FROM row_audit",
    "dq_required_columns": f"WITH {_FILES}, {_COLUMN_AUDIT} SELECT *, {_SEVERITY} AS severity FROM column_audit",
    "dq_key_null_rate": f"WITH {_FILES}, {_NULL_AUDIT} SELECT sample, file_name, \"column\", {sql_snap('null_rate')} AS null_rate, finding, {_SEVERITY} AS severity FROM null_audit",
    "dq_summary": f"WITH {_FILES}, {_COLUMN_AUDIT}, {_NULL_AUDIT}, findings AS (SELECT sample, {_SEVERITY} AS severity FROM ("
    "SELECT sample, finding FROM row_audit UNION ALL SELECT sample, finding FROM column_audit UNION ALL SELECT sample, finding FROM null_audit))"
    " SELECT sample, count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'warning') AS warnings,"
    " bool_and(severity <> 'error') AS passed FROM findings GROUP BY ALL",
    "clean_dates": f"WITH {_WIDE} SELECT clm_id, desynpuf_id, CAST({_date('clm_from_dt')} AS VARCHAR) AS from_day, CAST({_date('clm_thru_dt')} AS VARCHAR) AS thru_day FROM wide",
    "clean_numeric": f"WITH {_RB} SELECT desynpuf_id, year, "
    + ", ".join(f"{sql_snap(_num(c))} AS {c}" for c in BENE_AMOUNTS)
    + ", "
    + ", ".join(
        f"CAST({_small(c)} AS INT) AS {c}"
        for c in BENE_SMALL
    )
    + " FROM raw_bene",
    "clean_codes": f"WITH {_WIDE}, {_OP} SELECT 'carrier' AS source, clm_id, {_code('icd9_dgns_cd_1')} AS prncpal_dgns_cd, CAST(NULL AS VARCHAR) AS prvdr_num FROM wide"
    f" UNION ALL SELECT 'outpatient', clm_id, {_code('icd9_dgns_cd_1')}, {_code('prvdr_num')} FROM raw_op",
    "claim_provider_id": f"WITH {_WIDE} SELECT clm_id, desynpuf_id, {_NPI} AS at_physn_npi FROM wide WHERE {_NPI} IS NOT NULL",
    "claim_amounts": f"WITH {_WIDE}, sums AS (SELECT clm_id, desynpuf_id, {_PAID} AS paid, {_ALLOWED} AS allowed FROM wide)"
    f" SELECT clm_id, desynpuf_id, {sql_snap('paid')} AS clm_pmt_amt, {sql_snap('allowed')} AS allowed_amt, {sql_snap(_RATIO)} AS ratio FROM sums",
    "claim_code_array": f"WITH {_WIDE}, {_OP} SELECT 'carrier' AS source, clm_id, desynpuf_id, {_distinct_join(LINE_CODE)} AS codes, {_array(LINE_CODE)}[1] AS primary_code, '' AS revenue FROM wide"
    f" UNION ALL SELECT 'outpatient', clm_id, desynpuf_id, {_distinct_join(OUTPATIENT_CODE)}, {_array(OUTPATIENT_CODE)}[1], {_distinct_join(OUTPATIENT_REVENUE)} FROM raw_op",
    "claim_calendar": f"WITH {CLAIMS} SELECT CAST(clm_from_dt AS VARCHAR) AS day, max(yr) AS claim_year, bool_or(isodow(clm_from_dt) IN (6, 7)) AS weekend, count(*) AS claims FROM claims GROUP BY clm_from_dt",
    "bene_chronic_count": f"WITH {_RB} SELECT {_code('desynpuf_id')} AS desynpuf_id, year, CAST({_FLAG_COUNT} AS INT) AS chronic_condition_count FROM raw_bene WHERE desynpuf_id IS NOT NULL",
    "bene_clean": f"WITH {_RB} SELECT {_bene_select()} FROM raw_bene WHERE desynpuf_id IS NOT NULL",
    "claim_clean": f"""WITH {_WIDE}, typed AS (SELECT trim(clm_id) AS clm_id, desynpuf_id, {_NPI} AS at_physn_npi, {_date('clm_from_dt')} AS d, {_date('clm_thru_dt')} AS t,
  {_PAID} AS paid, {_ALLOWED} AS allowed, {_distinct_join(LINE_CODE)} AS hcpcs_codes, {_array(LINE_CODE)}[1] AS primary_hcpcs_cd, {_code('icd9_dgns_cd_1')} AS prncpal_dgns_cd,
  {_code(PLACE)} AS place_of_service_cd, {_code(CLAIM_TYPE)} AS nch_clm_type_cd, CAST(s AS INT) AS sample_id
  FROM wide, range(1, 3) AS r(s) WHERE clm_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY trim(clm_id) ORDER BY s) = 1)
SELECT clm_id, desynpuf_id, at_physn_npi, CAST(d AS VARCHAR) AS clm_from_dt, CAST(t AS VARCHAR) AS clm_thru_dt, CAST(year(d) AS INT) AS claim_year,
  {sql_snap('paid')} AS clm_pmt_amt, {sql_snap('allowed')} AS submitted_charge_amt, {sql_snap('allowed')} AS allowed_amt,
  {sql_snap(_RATIO)} AS submitted_to_allowed_ratio, place_of_service_cd, nch_clm_type_cd, sample_id, prncpal_dgns_cd, primary_hcpcs_cd, hcpcs_codes, isodow(d) > 5 AS is_weekend_claim
FROM typed WHERE clm_id IS NOT NULL AND at_physn_npi IS NOT NULL AND d IS NOT NULL""",
    "outpatient_clean": f"""WITH {_OP}, typed AS (SELECT *, CAST(s AS INT) AS sample_id, {_date('clm_from_dt')} AS d FROM raw_op, range(1, 3) AS r(s)
  WHERE clm_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY trim(clm_id) ORDER BY s) = 1)
SELECT trim(clm_id) AS clm_id, desynpuf_id, {_code('prvdr_num')} AS prvdr_num, {_code('at_physn_npi')} AS at_physn_npi, CAST(d AS VARCHAR) AS clm_from_dt,
  CAST({_date('clm_thru_dt')} AS VARCHAR) AS clm_thru_dt, CAST(year(d) AS INT) AS claim_year, {sql_snap(_num('clm_pmt_amt'))} AS clm_pmt_amt,
  {_code('clm_fac_type_cd')} AS clm_fac_type_cd, {_code('icd9_dgns_cd_1')} AS prncpal_dgns_cd, {_distinct_join(OUTPATIENT_CODE)} AS hcpcs_codes,
  {_distinct_join(OUTPATIENT_REVENUE)} AS revenue_codes, sample_id, isodow(d) > 5 AS is_weekend_claim
FROM typed WHERE clm_id IS NOT NULL AND d IS NOT NULL""",
    "claim_dedup": f"WITH {CLAIMS} SELECT {_DEDUP_COLS} FROM claims QUALIFY row_number() OVER (PARTITION BY clm_id ORDER BY {_ORDER_SQL}) = 1",
    "merge_insert_ignore": f"WITH {CLAIMS}, late AS (SELECT * FROM claims WHERE clm_from_dt >= DATE '1998-01-01' QUALIFY row_number() OVER (PARTITION BY clm_id ORDER BY {_ORDER_SQL}) = 1)"
    f" SELECT {_DEDUP_COLS} FROM late WHERE clm_id NOT IN (SELECT clm_id FROM claims WHERE clm_from_dt < DATE '1998-01-01')",
}
