"""The registered text queries against their SQL on the smallest tables, and their column types."""

import duckdb
import pytest

from ledgerlark.llm import queries

SF = "/root/testdata/sf0.001"
TYPES = {
    "op1_ring_shards": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op3_compression_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op4_ppm_language": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op5_two_fit_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op6_line_dedup": "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string",
    "op7_credential_links": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op8_chat_format": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    "op9_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op10_jaccard_join": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op11_identity_alignment": "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, n_best bigint, count_sum bigint",
    "op12_shortest_pack_first": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op13_dyadic_runs": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string",
}


@pytest.mark.parametrize("name", sorted(TYPES))
def test_types(spark, name):
    got = queries.QUERIES[name](spark, SF)
    assert ", ".join(f"{c} {t}" for c, t in got.dtypes) == TYPES[name]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_rows_equal_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    cur = con.execute(queries.ORACLE[name])
    at = [[d[0] for d in cur.description].index(c) for c in cols]
    assert got == sorted((tuple(r[i] for i in at) for r in cur.fetchall()), key=repr)
