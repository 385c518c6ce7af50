"""Quality rules whose thresholds come from the corpus: one mergeable quantile sketch per language and source.

The sketch of a ratio is a histogram over its thousandths (of a mean word length: over hundredths), built with
a plain map-side combined count, merged by adding counts, and exact in rank (far beyond any ordinary value its buckets widen).  Where a source has few documents in a
language, the sketches of all its sources are merged; below that, all sketches.

A document fails an upper rule when its value lies above  median + SPREAD * (median - lower decile) + slack  of its
group, and a lower rule likewise below.  Medians and lower deciles ignore up to half of a group being junk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.common import WS, Scratch, word_array

MIN_GROUP = 50
SPREAD = 6
#: Rule name, slack in units of the sketch (thousandths; hundredths for word_len).
UPPER = {"symbols": 60, "dup_lines": 500, "repeats": 400, "word_len": 600}
LOWER = {"word_len": 200}
BROADCAST_GROUPS = 50_000
#: Sketch buckets up to this value are exact; beyond it they widen with the value, by one part in FINE at most.
TOP = 20_000
FINE = 4096


def word_metrics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Append n_words, word_chars, n_symbols, n_dup_lines, n_text_lines, n_repeat_words to ``docs``.

    Null texts have none of each.  Columns of these names in ``docs`` are replaced.  All expressions stay in the
    row: no shuffle.  Repeated three-word windows are found by sorting (hash, position), so the work on a long text
    is n log n; texts without a repeated window skip it.
    """
    docs = docs.drop("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_text_lines", "n_repeat_words")
    body = F.coalesce(F.col(text), F.lit(""))
    keep = docs.columns
    a = docs.withColumn("_w", word_array(F.col(text)))
    at = lambda i: F.get("_w", i)
    a = a.withColumn(
        "_t",
        F.when(F.size("_w") >= 3, F.transform(F.sequence(F.lit(0), F.size("_w") - 3), lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2))))
        .otherwise(F.array().cast("array<bigint>")),
    )
    lines = F.filter(F.split(body, "\n", -1), lambda x: F.trim(x, F.lit(" \t\x0b\x0c\r")) != "")
    a = a.select(
        *keep,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count(body, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
        "_t",
        (F.size(F.array_distinct("_t")) < F.size("_t")).alias("_again"),
    )
    a = a.select(
        *keep, "n_words", "word_chars", "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_text_lines"),
        F.when(F.col("_again"), F.sort_array(F.transform("_t", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
        .otherwise(F.array().cast("array<struct<h:bigint,i:int>>")).alias("_s"),
    )
    near = lambda i: F.coalesce(F.get("_s", i)["h"], F.lit(None).cast("bigint"))
    found = F.filter("_s", lambda x, i: F.coalesce(near(i + 1) == x["h"], F.lit(False)) | F.coalesce(near(i - 1) == x["h"], F.lit(False)))
    a = a.withColumn("_p", F.sort_array(F.transform(found, lambda x: x["i"])))
    covered = F.aggregate(
        "_p",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, p: F.struct((acc["n"] + p + 3 - F.greatest(p, acc["end"])).alias("n"), (p + 3).alias("end")),
        lambda acc: acc["n"].cast("long"),
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_text_lines"]
    return a.select(*keep, *counts, covered.alias("n_repeat_words"))


def _units() -> dict[str, Column]:
    """Integer values that are judged; division by nothing gives 0."""
    ratio = lambda a, b, scale: F.when(F.col(b) > 0, F.expr(f"({scale} * {a}) div {b}")).otherwise(F.lit(0)).cast("long")
    return {
        "symbols": ratio("n_symbols", "word_chars", 1000),
        "dup_lines": ratio("n_dup_lines", "n_text_lines", 1000),
        "repeats": ratio("n_repeat_words", "n_words", 1000),
        "word_len": ratio("word_chars", "n_words", 100),
    }


def _bucket(value: Column) -> Column:
    """Sketch bucket of a value: the lowest value in it."""
    width = F.lit(1).cast("long")
    at = 2 * FINE
    while at < 1 << 40:  # a value is below 1,000 times the length of a text
        width = F.when(value >= at, F.lit(at // FINE).cast("long")).otherwise(width)
        at *= 2
    return F.when(value <= TOP, value).otherwise(value - F.pmod(value, width))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _quantiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Median, lower decile and size per group and rule.  A group has TOP + 1 buckets at most, and FINE for each doubling beyond."""
    merged = sketch.groupBy(*by, "rule", "value").agg(F.sum("n").alias("n"))
    run = Window.partitionBy(*by, "rule").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by, "rule")
    ranked = merged.withColumns({"upto": F.sum("n").over(run), "total": F.sum("n").over(whole)})
    q = lambda p: F.min(F.when(100 * F.col("upto") >= p * F.col("total"), F.col("value")))
    return ranked.groupBy(*by, "rule").agg(q(50).alias("mid"), q(10).alias("low"), q(90).alias("high"), F.max("total").alias("size"))


def thresholds(metrics: DataFrame, scratch: Scratch) -> DataFrame:
    """(lang, source, upper_<rule>, lower_<rule>): one row per group of ``metrics``, nulls being values like others.

    Only documents that pass the base rules shape the sketches.
    """
    units = _units()
    stack = F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), _bucket(v).alias("value")) for k, v in units.items()]))
    sketch = scratch.write(
        metrics.where(~base_failed()).select("lang", "source", stack.alias("s")).groupBy("lang", "source", "s.rule", "s.value").agg(F.count("*").alias("n")),
        "sketch",
    )
    fine = _quantiles(sketch, ["lang", "source"])
    mid = _quantiles(sketch, ["lang"]).select(F.col("lang").alias("lang_"), F.col("rule").alias("rule_"), F.struct("mid", "low", "high", "size").alias("by_lang"))
    top = _quantiles(sketch, []).select(F.col("rule").alias("rule__"), F.struct("mid", "low", "high", "size").alias("by_all"))
    chosen = (
        fine.join(mid, fine["lang"].eqNullSafe(mid["lang_"]) & (fine["rule"] == mid["rule_"]))
        .join(top, F.col("rule") == F.col("rule__"))
        .withColumn("q", F.when(F.col("size") >= MIN_GROUP, F.struct("mid", "low", "high", "size")).when(F.col("by_lang.size") >= MIN_GROUP, F.col("by_lang")).otherwise(F.col("by_all")))
    )
    rule = F.col("rule")
    limits = []
    for name, slack in UPPER.items():
        value = F.col("q.mid") + SPREAD * (F.col("q.mid") - F.col("q.low")) + slack
        limits.append(F.max(F.when(rule == name, value)).alias(f"upper_{name}"))
    for name, slack in LOWER.items():
        value = F.col("q.mid") - SPREAD * (F.col("q.high") - F.col("q.mid")) - slack
        limits.append(F.max(F.when(rule == name, value)).alias(f"lower_{name}"))
    return chosen.groupBy("lang", "source").agg(*limits)


def judge(measured: DataFrame, scratch: Scratch) -> DataFrame:
    """``measured`` (a table with the metrics, lang and source) plus base_failed and kept."""
    limits = scratch.write(thresholds(measured, scratch), "limits").select(
        F.col("lang").alias("_lang"), F.col("source").alias("_source"), *[f"upper_{k}" for k in UPPER], *[f"lower_{k}" for k in LOWER]
    )
    if limits.count() <= BROADCAST_GROUPS:  # else both sides are shuffled
        limits = F.broadcast(limits)
    joined = measured.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    units = _units()
    fine = F.lit(True)
    for k in UPPER:
        fine = fine & F.coalesce(units[k] <= F.col(f"upper_{k}"), F.lit(True))
    for k in LOWER:
        fine = fine & F.coalesce(units[k] >= F.col(f"lower_{k}"), F.lit(True))
    return joined.withColumns({"base_failed": base_failed(), "kept": ~base_failed() & fine})


def apply_rules(docs: DataFrame, carry: list[str]) -> DataFrame:
    """Metrics and verdict for each row of ``docs``, with the columns in ``carry`` (may hold the text).

    ``docs`` needs text, lang and source; a missing lang or source counts as null.  Each row stands for itself,
    repeated or not; an empty table gives an empty result.
    """
    for c in ("lang", "source"):
        if c not in docs.columns:
            docs = docs.withColumn(c, F.lit(None).cast("string"))
    scratch = Scratch(docs.sparkSession, "rules")
    need = list(dict.fromkeys([*carry, "lang", "source", "text"]))
    measured = word_metrics(docs.select(*need))
    keep = list(dict.fromkeys([*carry, "lang", "source"]))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_text_lines", "n_repeat_words"]
    table = scratch.write(measured.select(*[c for c in keep if c not in counts], *counts), "measured")
    return judge(table, scratch)
