"""Secret scan: three base patterns, and weak parts of credentials that count only together.

Base spans (assign, access, hex) are found anywhere.  Weak parts - account identifiers, short or unlabelled secrets,
endpoints - are common in clean text and are reported only where complementary parts meet: an identifier with a
secret near it in the same scope, a secret with an identifier, an endpoint with both.  Base spans act as parts
too.  A scope is a stretch of text without an empty line; near means at most WINDOW code points apart.

The linking is an interval join: parts are rows keyed by (document, scope, stretch of WINDOW code points) and look
for partners in their own and the neighbouring stretches, so a join key never holds more than fits into a
stretch, and semi joins never multiply rows.  Everything is DataFrame expressions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import Scratch, join_on_key, with_row_key

WINDOW = 256
SPAN = "struct<start:int,end:int>"

# Patterns of the base kinds and their least lengths (fixed values).
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 12
ACCESS = r"AKIA[A-Z0-9]+"
ACCESS_CHARS = 18
HEX = r"[0-9a-f]{16,}"  # the runs of 16 and more are the runs of any length that are long enough
KINDS = ("assign", "access", "hex", "linked_id", "linked_secret", "linked_endpoint")

# Weak parts.
ID = r"""(?i:client_?id|access_?key_?id|access_?id|user_?name|user_?id|user|login|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}"""
ENDPOINT = r"""(?i:https?|ftp|jdbc:[a-z0-9]+|postgres|postgresql|mysql|mongodb|redis|amqp)://[^\s"'<>]+"""
KEYLIKE = r"[A-Za-z0-9+/_-]{20,}"
#: Any of these must be in a text before weak parts are looked for.
HINT = r"(?i)user|login|account|client_?id|access_?(?:key_?)?id|AKIA"


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, hit>> of all leftmost matches, in code points, by the gaps between them."""
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(F.slice(gaps, 1, F.size(hits)).alias("gap"), hits.alias("hit"))
    kind = "array<struct<start:int,end:int,hit:string>>"

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["0"])
        end = start + F.length(p["1"])
        found = F.struct(start.alias("start"), end.alias("end"), p["1"].alias("hit"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(found)).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))
    pairs = F.transform(pairs, lambda p: F.struct(p["gap"].alias("0"), p["hit"].alias("1")))
    return F.aggregate(pairs, start, step, lambda acc: acc["out"])


def _spans(found: Column) -> Column:
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end")))


def _assign_value(hit: Column) -> Column:
    return F.length(F.regexp_extract(hit, ASSIGN, 2))


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of the base kinds; patterns run only where a cheap test finds their start."""
    none = F.array().cast(f"array<{SPAN}>")
    assign = F.filter(matches(text, ASSIGN), lambda m: _assign_value(m["hit"]) >= ASSIGN_VALUE)
    access = F.filter(matches(text, ACCESS), lambda m: m["end"] - m["start"] >= ACCESS_CHARS)
    return {
        "assign": F.when(text.rlike(ASSIGN), _spans(assign)).otherwise(none),
        "access": F.when(F.contains(text, F.lit("AKIA")), _spans(access)).otherwise(none),
        "hex": F.when(text.rlike(HEX), _spans(matches(text, HEX))).otherwise(none),
    }


def _parts(text: Column) -> Column:
    """array<struct<role, kind, start, end>>; kind is null for base spans, which are reported anyway."""
    base = base_spans(text)
    short = F.filter(matches(text, ASSIGN), lambda m: _assign_value(m["hit"]) < ASSIGN_VALUE)
    mixed = F.filter(
        matches(text, KEYLIKE),
        lambda m: m["hit"].rlike("[0-9]") & m["hit"].rlike("[a-z]") & m["hit"].rlike("[A-Z]") & ~m["hit"].rlike("^AKIA[A-Z0-9]+$"),
    )

    def part(found: Column, role: str, kind: str | None) -> Column:
        return F.transform(found, lambda m: F.struct(F.lit(role).alias("role"), F.lit(kind).cast("string").alias("kind"), m["start"].alias("start"), m["end"].alias("end")))

    return F.concat(
        part(base["access"], "id", None), part(base["assign"], "secret", None), part(base["hex"], "secret", None),
        part(matches(text, ID), "id", "linked_id"), part(short, "secret", "linked_secret"), part(mixed, "secret", "linked_secret"),
        part(matches(text, ENDPOINT), "endpoint", "linked_endpoint"),
    )


def _near(parts: DataFrame, role: str) -> DataFrame:
    """Parts that have a part of another ``role`` within WINDOW in their scope (interval semi join)."""
    partners = parts.where(F.col("role") == role).select(
        F.col("_rk1").alias("k1"), F.col("_rk2").alias("k2"), F.col("scope").alias("s"), F.col("start").alias("from_"), F.col("end").alias("to_"),
        F.explode(F.sequence(F.greatest(F.lit(0), F.expr(f"start div {WINDOW}") - 1), F.expr(f"end div {WINDOW}") + 1)).alias("stretch"),
    )
    # a part may be long: a partner is near its start or near its end
    edges = F.array_distinct(F.array(F.expr(f"start div {WINDOW}"), F.expr(f"end div {WINDOW}")))
    mine = parts.where(F.col("role") != role).withColumn("mine", F.explode(edges))
    gap = F.greatest(F.col("from_") - F.col("end"), F.col("start") - F.col("to_"))
    apart = (F.col("from_") >= F.col("end")) | (F.col("start") >= F.col("to_"))
    same = (F.col("_rk1") == F.col("k1")) & (F.col("_rk2") == F.col("k2")) & (F.col("scope") == F.col("s")) & (F.col("mine") == F.col("stretch"))
    return mine.join(partners, same & apart & (gap <= WINDOW), "left_semi").drop("mine").distinct()


def linked_parts(keyed: DataFrame, scratch: Scratch) -> DataFrame:
    """(_rk1, _rk2, linked): weak spans with their complements, per distinct row key of ``keyed`` (text, _rk1, _rk2)."""
    hinted = keyed.where(F.col("text").rlike(HINT)).groupBy("_rk1", "_rk2").agg(F.any_value("text").alias("text"))
    # scopes with the code points before them
    cut = F.split("text", "\n\n", -1)
    before = F.aggregate(F.slice(F.col("cut"), 1, F.col("scope")), F.lit(0), lambda acc, x: acc + F.length(x) + 2)
    scopes = hinted.select("_rk1", "_rk2", cut.alias("cut")).select("_rk1", "_rk2", "cut", F.posexplode("cut").alias("scope", "body"))
    found = scopes.where(F.col("body").rlike(HINT)).select("_rk1", "_rk2", "scope", before.alias("before"), F.explode(_parts(F.col("body"))).alias("p"))
    parts = scratch.write(
        found.select("_rk1", "_rk2", "scope", "p.role", "p.kind", (F.col("p.start") + F.col("before")).alias("start"), (F.col("p.end") + F.col("before")).alias("end")).distinct(),
        "parts",
    )
    with_id, with_secret = _near(parts, "id"), _near(parts, "secret")
    ids = with_secret.where("kind = 'linked_id'")
    secrets = with_id.where("kind = 'linked_secret'")
    at = ["_rk1", "_rk2", "scope", "role", "kind", "start", "end"]
    ends = with_id.where("kind = 'linked_endpoint'").select(*at).intersect(with_secret.where("kind = 'linked_endpoint'").select(*at))
    found = reduce(DataFrame.unionAll, [x.select(*at) for x in (ids, secrets, ends)])
    return found.groupBy("_rk1", "_rk2").agg(F.collect_set(F.struct("kind", "start", "end")).alias("linked"))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) for each row of ``docs`` (doc_id, text; others are not read).

    ``spans``: array of (kind, start, end) in code points, end exclusive, by start, then kind as in KINDS, then end.
    A null text has none.  Repeated rows come back once each.  An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    body = F.coalesce(F.col("text"), F.lit(""))
    keyed = with_row_key(docs.select("doc_id", body.alias("text")), "doc_id", "text")
    base = scratch.write(keyed.select("doc_id", "_rk1", "_rk2", *[c.alias(k) for k, c in base_spans(F.col("text")).items()]), "base")
    linked = linked_parts(keyed.select("text", "_rk1", "_rk2"), scratch)
    tag = lambda k: F.transform(k, lambda m: F.struct(F.lit(k).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    every = F.concat(tag("assign"), tag("access"), tag("hex"), F.coalesce(F.col("linked"), none))
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    ordered = F.sort_array(F.transform(every, lambda m: F.struct(m["start"].alias("start"), rank[m["kind"]].alias("rank"), m["end"].alias("end"), m["kind"].alias("kind"))))
    spans = F.transform(ordered, lambda m: F.struct(m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end")))
    return join_on_key(base, linked, "left").select("doc_id", spans.alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(":", m["kind"], m["start"].cast("string"), m["end"].cast("string"))), ",")


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span replaced by ``mark``; overlapping spans count as one."""
    keyed = with_row_key(docs, "doc_id", "text")
    body = F.coalesce(F.col("text"), F.lit(""))
    scratch = Scratch(docs.sparkSession, "secrets")
    found = with_row_key(docs.select("doc_id", "text"), "doc_id", "text")
    base = found.select("text", "_rk1", "_rk2", F.concat(*base_spans(body).values()).alias("own"))
    linked = linked_parts(found.select(body.alias("text"), "_rk1", "_rk2"), scratch)
    none = F.array().cast(f"array<{SPAN}>")
    per_key = join_on_key(base.select("_rk1", "_rk2", "own").distinct(), linked, "left").select(
        "_rk1", "_rk2", F.sort_array(F.concat("own", F.coalesce(_spans(F.col("linked")), none))).alias("_spans")
    )
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, m: Column) -> Column:
        fresh = m["start"] >= acc["at"]
        out = F.when(fresh, F.concat(acc["out"], F.substring(body, acc["at"] + 1, m["start"] - acc["at"]), F.lit(mark))).otherwise(acc["out"])
        return F.struct(out.alias("out"), F.greatest(acc["at"], m["end"]).alias("at"))

    clean = F.aggregate("_spans", start, step, lambda acc: F.concat(acc["out"], F.substring(body, acc["at"] + 1, F.length(body))))
    return join_on_key(keyed, per_key, "left").withColumn("text", clean).select(*docs.columns)
