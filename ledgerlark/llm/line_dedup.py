"""Line deduplication over levelled, sorted runs of line hashes.

A line's key is the line without ASCII white space at its ends and with A-Z in lower case.  Documents come in
batches.  A batch's keys are counted (documents holding the key), merge-anti-joined with the keys that the runs
already know to be repeated, and the rest is written as a new sorted run.  When a level has ``fanout`` runs they
are merged into one run of the next level.  Keys whose counts over all runs reach ``min_docs`` lose their lines
in every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm.common import Scratch, freeing, join_on_key, shuffle_partitions, slices, with_row_key

BATCHES = 4
FANOUT = 2
FLUSH_KEYS = 200_000
_WS = b" \t\n\x0b\x0c\r"
_KEY = ["h1", "h2"]


def line_key(line: bytes) -> bytes:
    return line.strip(_WS).lower()


def _hash(key: bytes) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(key)
    return (h >> 64) - (1 << 63), (h & 0xFFFFFFFFFFFFFFFF) - (1 << 63)


def _lines(text: str | None) -> list[bytes]:
    return (text or "").encode().split(b"\n")


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars)


def _count_keys(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """(batch, h1, h2, n): documents of this task that hold the key; combined before they leave the task."""
    seen: dict[tuple[int, int, int], int] = {}

    def flush() -> pa.RecordBatch:
        keys = list(seen)
        out = pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int64()),
             pa.array([k[2] for k in keys], pa.int64()), pa.array(list(seen.values()), pa.int64())],
            names=["batch", "h1", "h2", "n"],
        )
        seen.clear()
        return out

    for rb in batches:
        for text, batch in zip(rb.column(0), rb.column(1).to_pylist(), strict=True):
            for key in {k for line in _lines(text.as_py()) if _long_enough(k := line_key(line), min_chars)}:
                at = (batch, *_hash(key))
                seen[at] = seen.get(at, 0) + 1
            if len(seen) >= FLUSH_KEYS:
                yield flush()
    if seen:
        yield flush()


def _line_hashes(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """(_rk1, _rk2, h1, h2, line) for each line with a key."""
    for rb in slices(batches):
        cols: list[list[int]] = [[], [], [], [], []]
        for text, a, b in zip(rb.column(0), rb.column(1).to_pylist(), rb.column(2).to_pylist(), strict=True):
            for i, line in enumerate(_lines(text.as_py())):
                if _long_enough(key := line_key(line), min_chars):
                    for col, v in zip(cols, (a, b, *_hash(key), i), strict=True):
                        col.append(v)
        types = [pa.int64()] * 4 + [pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["_rk1", "_rk2", "h1", "h2", "line"])


def _keep_lines(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[pa.RecordBatch]:
    """Replace the text and append n_lines, n_dropped; the last input column lists the dropped line numbers."""
    for rb in slices(batches):
        texts, n_lines, n_dropped = [], [], []
        for text, gone in zip(rb.column(text_at), rb.column(rb.num_columns - 1), strict=True):
            lines, drop = (text.as_py() or "").split("\n"), set(gone.as_py() or ())
            texts.append("\n".join(x for i, x in enumerate(lines) if i not in drop) if drop else "\n".join(lines))
            n_lines.append(len(lines))
            n_dropped.append(len(drop))
        cols = list(rb.columns[:-1])
        cols[text_at] = pa.array(texts, pa.string())
        yield pa.RecordBatch.from_arrays(
            [*cols, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names=[*rb.schema.names[:-1], "n_lines", "n_dropped"]
        )


class LineRuns:
    """Sorted runs of (h1, h2, n) by level, in the shared folder."""

    def __init__(self, spark: SparkSession, scratch: Scratch, fanout: int = FANOUT):
        self.spark, self.scratch, self.fanout = spark, scratch, fanout
        self.levels: list[list[str]] = []
        self.tables: dict[str, DataFrame] = {}
        self.serial = 0

    def _write(self, counts: DataFrame, level: int) -> None:
        self.serial += 1
        name = f"run{self.serial}-level{level}"
        ordered = counts.repartition(shuffle_partitions(self.spark), *_KEY).sortWithinPartitions(*_KEY)
        self.tables[name] = self.scratch.write(ordered, name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def totals(self) -> DataFrame | None:
        """Documents per key over all runs."""
        frames = list(self.tables.values())
        if not frames:
            return None
        out = frames[0]
        for f in frames[1:]:
            out = out.unionAll(f)
        return out.groupBy(*_KEY).agg(F.sum("n").alias("n"))

    def add(self, counts: DataFrame, min_docs: int) -> None:
        """Anti-join a batch's counts with the keys already known as repeated; write the rest; compact full levels."""
        known = self.totals()
        if known is not None:
            counts = counts.join(known.where(F.col("n") >= min_docs).select(*_KEY), _KEY, "left_anti")
        self._write(counts, 0)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            names = self.levels[level]
            merged = self.tables[names[0]]
            for name in names[1:]:
                merged = merged.unionAll(self.tables[name])
            self._write(merged.groupBy(*_KEY).agg(F.sum("n").alias("n")), level + 1)
            self.levels[level] = []
            for name in names:
                del self.tables[name]
            self.scratch.drop(*names)
            level += 1


def repeated_keys(docs: DataFrame, scratch: Scratch, min_docs: int, min_chars: int, batches: int = BATCHES) -> DataFrame:
    """Hashes of the keys held by at least ``min_docs`` documents."""
    spark = docs.sparkSession
    dealt = docs.select("text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).cast("int").alias("batch"))
    counted = scratch.write(dealt.mapInArrow(freeing(partial(_count_keys, min_chars=min_chars)), "batch int, h1 long, h2 long, n long"), "counts", "batch")
    runs = LineRuns(spark, scratch)
    for b in range(batches):
        runs.add(counted.where(F.col("batch") == b).groupBy(*_KEY).agg(F.sum("n").alias("n")), min_docs)
    scratch.drop("counts")
    return runs.totals().where(F.col("n") >= min_docs).select(*_KEY)


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = BATCHES) -> DataFrame:
    """``docs`` with repeated lines removed from ``text``, plus n_lines and n_dropped.

    Each row is a document, repeated rows too.  A null text counts as empty (one line, whose key has no
    characters and is never dropped) and comes back empty.  Lines are cut at ``\\n`` only.  Columns named n_lines
    or n_dropped in ``docs`` are replaced.  An empty table gives an empty result.  Line hashes have 128 bits.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lines")
    docs = docs.drop("n_lines", "n_dropped")
    hot = scratch.write(repeated_keys(docs, scratch, min_docs, min_chars, batches), "repeated")
    keyed = with_row_key(docs, "doc_id", "text")
    hits = (
        keyed.select("text", "_rk1", "_rk2")
        .mapInArrow(freeing(partial(_line_hashes, min_chars=min_chars)), "_rk1 long, _rk2 long, h1 long, h2 long, line int")
        .join(hot, _KEY, "left_semi")
        .groupBy("_rk1", "_rk2").agg(F.collect_set("line").alias("_gone"))
    )
    joined = join_on_key(keyed, hits, "left").select(*docs.columns, "_gone")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + ", n_lines long, n_dropped long"
    return joined.mapInArrow(freeing(partial(_keep_lines, text_at=docs.columns.index("text"))), schema)
