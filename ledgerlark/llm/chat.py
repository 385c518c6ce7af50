"""Chat formatting with Spark expressions: sort the turns of a conversation, merge neighbours of one role, join.

Template (fixed): ``<|im_start|>role\\ntext<|im_end|>\\n`` for each block of neighbouring turns of one role, the
texts of the block separated by ``<|im_sep|>``.  Inside texts a backslash is doubled and ``<|`` becomes ``<\\|``, so no
text can hold a control string and every text can be read back exactly.  Roles stand on one line: there a backslash
becomes ``\\s``, a line end ``\\n`` and ``<|`` again ``<\\|``.

The work grows linearly with the turns: places come from a running sum, each block is cut out of the sorted turns once,
and reading back looks at a loss span only in the portions of the string that it touches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END, SEP = "<|im_start|>", "<|im_end|>\n", "<|im_sep|>"
LOSS_ROLE = "assistant"
#: Code points in which a formatted string is cut to read its loss spans.
PORTION = 256


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    """Escaped texts hold ``<\\|`` only where ``<|`` was: backslashes of the text come in pairs."""
    return F.replace(F.replace(c, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def _escape_role(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\n")), F.lit("<|"), F.lit("<\\|"))


def _unescape_role(c: Column) -> Column:
    """Every backslash begins a pair, so the pairs can be replaced one kind after the other."""
    return F.replace(F.replace(F.replace(c, F.lit("<\\|"), F.lit("<|")), F.lit("\\n"), F.lit("\n")), F.lit("\\s"), F.lit("\\"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) for each conversation of ``turns`` (conv_id, turn, role, text, ...).

    Turns are ordered by turn, nulls first, then by their escaped roles and texts; repeated rows stay.  Null roles and texts count as empty; a null conv_id is a
    conversation of its own.  ``loss_spans`` lists (start, length) in code points of every assistant text, in
    order.  Other columns are not read.  An empty table gives an empty result.  A conversation is one output row, so it has to fit into one.
    """
    role = _escape_role(F.coalesce(F.col("role").cast("string"), F.lit("")))
    body = escape(F.coalesce(F.col("text"), F.lit("")))
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    head = len(START) + F.length("role") + 1
    before = F.when(F.col("prev").isNull(), head).when(F.col("prev") == F.col("role"), F.lit(len(SEP))).otherwise(head + len(END))
    end = F.sum(before + F.length("body")).over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    placed = (
        turns.select("conv_id", "turn", role.alias("role"), body.alias("body")).withColumn("prev", F.lag("role").over(in_order))
        .withColumn("at", (end - F.length("body")).cast("int"))
    )
    # places rise, so they are the order of the turns
    collected = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "role", "body"))).alias("turns"))
    role_at = lambda i: F.get("turns", i)["role"]
    firsts = collected.withColumn("firsts", F.filter(F.sequence(F.lit(0), F.size("turns") - 1), lambda i: (i == 0) | (role_at(i) != role_at(i - 1))))

    def block(first: Column, k: Column) -> Column:
        after = F.coalesce(F.get("firsts", k + 1), F.size("turns"))
        bodies = F.array_join(F.transform(F.slice("turns", first + 1, after - first), lambda t: t["body"]), SEP)
        return F.concat(F.lit(START), role_at(first), F.lit("\n"), bodies, F.lit(END))

    spans = F.transform(F.filter("turns", lambda t: t["role"] == LOSS_ROLE), lambda t: F.struct(t["at"].alias("start"), F.length(t["body"]).alias("length")))
    return firsts.select("conv_id", F.array_join(F.transform("firsts", block), "").alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_text, formatted) parsed from the formatted strings: the inverse of the formatter.

    Strings of any length; an empty table gives an empty result.
    """
    pieces = F.split("formatted", r"<\|im_end\|>\n", -1)
    blocks = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda p: F.substring(p, F.lit(len(START) + 1), F.length(p)))

    def turns_of(b: Column) -> Column:
        role = F.substring_index(b, "\n", 1)
        bodies = F.split(F.substring(b, F.length(role) + 2, F.length(b)), r"<\|im_sep\|>", -1)
        return F.transform(bodies, lambda x: F.struct(_unescape_role(role).alias("role"), unescape(x).alias("text")))

    def spoken(s: Column) -> Column:
        first = F.floor(s["start"] / PORTION).cast("int")
        last = F.floor((s["start"] + s["length"]) / PORTION).cast("int")
        near = F.array_join(F.slice("portions", first + 1, last - first + 1), "")
        return unescape(F.substring(near, s["start"] - first * PORTION + 1, s["length"]))

    cut = formatted.withColumn("portions", F.regexp_extract_all("formatted", F.lit(f"(?s).{{1,{PORTION}}}"), F.lit(0)))
    # "portions" stands here twice, so the optimizer keeps it as a column and does not cut the string anew for each span
    loss = F.when(F.size("portions") > 0, F.array_join(F.transform("loss_spans", spoken), "")).otherwise("")
    return cut.select("conv_id", F.flatten(F.transform(blocks, turns_of)).alias("turns"), loss.alias("loss_text"), "formatted")
