"""Shortest-pack-first packing over the histogram of lengths.

Lengths are placed longest first.  Each piece goes to the shortest pack in which it fits.  Packs of the same pieces
are one pattern with a count, and pieces of one length are one number, so a length is placed by moving counts
between patterns: a length splits one pattern at most and opens two, so there are never more than ``2 * capacity`` patterns,
whatever the input.  Each piece then finds its pack from its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.common import TEXT_BATCH, Scratch, setting, slices, text_groups
from ledgerlark.llm.packing import VOCABULARY, WordTokens

CAPACITY = 2048
END_ID = 1
#: Pieces of one length are ranked in cells of about this many rows, or in this many cells if there are more.
CELL_ROWS, MOST_CELLS = 500, 1 << 16
#: Pieces are cut shorter where that saves more than this share of the sequences.
WORTH_CUTTING = 0.005
#: One run of a pattern: pieces of one length, side by side.
Pattern = tuple[tuple[int, int], ...]


def shortest_pack_first(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, Pattern]]:
    """(packs, ((length, pieces), ...)) of each pattern, from (length: pieces)."""
    by_room: list[list[tuple[int, Pattern]]] = [[] for _ in range(capacity + 1)]  # patterns by the room left in them
    for length in sorted(counts, reverse=True):
        left, room = counts[length], capacity
        while left and room >= length:
            if not by_room[room]:
                room -= 1
                continue
            packs, pattern = by_room[room].pop()
            filled = min(packs, left)
            if filled < packs:
                by_room[room].append((packs - filled, pattern))
            tail = pattern[-1]
            longer = (*pattern[:-1], (length, tail[1] + 1)) if tail[0] == length else (*pattern, (length, 1))
            by_room[room - length].append((filled, longer))
            left -= filled
        # No pack has room.  A new one is the shortest pack until no further piece of this length fits.
        side_by_side = capacity // length
        full, rest = divmod(left, side_by_side)
        if full:
            by_room[capacity - side_by_side * length].append((full, ((length, side_by_side),)))
        if rest:
            by_room[capacity - rest * length].append((1, ((length, rest),)))
    return [p for patterns in by_room for p in patterns]


def cut_shorter(counts: dict[int, int], longest: int) -> dict[int, int]:
    """The histogram after pieces are cut at multiples of ``longest``."""
    out: dict[int, int] = {}
    for length, n in counts.items():
        whole, rest = divmod(length, longest)
        for part, times in ((longest, whole * n), (rest, n)):
            if part and times:
                out[part] = out.get(part, 0) + times
    return out


def piece_limit(counts: dict[int, int], capacity: int = CAPACITY) -> int:
    """Longest piece to cut: the capacity, or a half, quarter or eighth of it where long pieces leave gaps that no short ones fill."""
    best, fewest = capacity, sum(n for n, _ in shortest_pack_first(counts, capacity))
    for part in (2, 4, 8):
        if capacity % part == 0:
            packs = sum(n for n, _ in shortest_pack_first(cut_shorter(counts, capacity // part), capacity))
            if packs < fewest * (1 - WORTH_CUTTING):
                best, fewest = capacity // part, packs
    return best


@lru_cache(maxsize=1)
def _tokens(path: str) -> WordTokens:
    return WordTokens(path)


def _pieces(batches: Iterator[pa.RecordBatch], path: str | None, limit: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    tokens = _tokens(path or public_tokenizers.path(VOCABULARY))
    end = np.array([END_ID], dtype="<u4").tobytes()
    step = 4 * limit
    for rb in slices(batches):
        at = 0
        for group in text_groups([t or "" for t in rb.column(1).to_pylist()]):
            row, start, length, crc, total, ids = [], [], [], [], [], []
            for i, raw in enumerate(tokens.encode(group), at):
                raw += end
                for k in range(0, len(raw), step):
                    part = raw[k : k + step]
                    row.append(i)
                    start.append(k // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    total.append(len(raw) // 4)
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            at += len(group)
            cols = [rb.column(0).take(pa.array(row, pa.int64())), *(pa.array(c, pa.int64()) for c in (start, length, crc, total))]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                cols.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)


def _slots(patterns: list[tuple[int, Pattern]]) -> dict[str, np.ndarray]:
    """Where the pieces of each length go, in order of rank: first rank, pieces side by side, first sequence, first offset."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for packs, pattern in patterns:
        offset = 0
        for length, side in pattern:
            first = taken.get(length, 0)
            rows.append((length, first, side, sequence, offset))
            taken[length] = first + packs * side
            offset += length * side
        sequence += packs
    names = ("length", "rank", "side", "sequence", "offset")
    return dict(zip(names, np.array(sorted(rows), dtype=np.int64).reshape(-1, 5).T, strict=True))


def _join_slots(batches: Iterator[pa.RecordBatch], slots: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Replace the last column (rank) by sequence_id and offset."""
    of_length = {n: np.searchsorted(slots["length"], [n, n + 1]) for n in np.unique(slots["length"]).tolist()}
    for rb in batches:
        length = rb.column("length").to_numpy()
        rank = rb.column("rank").to_numpy()
        slot = np.zeros(len(rank), dtype=np.int64)
        for n in np.unique(length).tolist():
            a, b = of_length[n]
            mine = length == n
            slot[mine] = a + np.searchsorted(slots["rank"][a:b], rank[mine], side="right") - 1
        place = rank - slots["rank"][slot]
        side = slots["side"][slot]
        cols = [*rb.columns[:-1], pa.array(slots["sequence"][slot] + place // side), pa.array(slots["offset"][slot] + length * (place % side))]
        yield pa.RecordBatch.from_arrays(cols, names=[*rb.schema.names[:-1], "sequence_id", "offset"])


def _with_rank(pieces: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Number the pieces of each length from 0: within cells of a hash, plus all pieces in the cells before."""
    spread = pieces.sparkSession.createDataFrame([(k, min(MOST_CELLS, -(-n // CELL_ROWS))) for k, n in counts.items()], "length long, cells long")
    dealt = pieces.join(F.broadcast(spread), "length").withColumn("cell", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), "cells"))
    earlier = Window.partitionBy("length").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("length", "cell").agg(F.count("*").alias("n"))
    before = sizes.select("length", "cell", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "cell").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = dealt.withColumn("within", F.row_number().over(within) - 1).join(before, ["length", "cell"])
    return ranked.select(*pieces.columns, (F.col("before") + F.col("within")).alias("rank"))


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens[, ids], sequence_id, offset.

    Reads doc_id and text only, so other columns never clash.  A null or empty text is the end id alone.  Documents
    longer than the capacity are cut into pieces of it; where many pieces are so long that no others fit beside them, all are cut at
    a half, quarter or eighth of it (``piece_limit``).  Repeated rows and null ids are packed like any other row; ties in rank
    are between equal rows.  A very long text is many pieces and is tokenised by the task that reads it.  An empty
    table gives an empty result.  The driver sees one count per length.  ``vocabulary``: path of the tokenizer file.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "histogram-packing")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + (", ids array<int>" if with_ids else "")
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def cut(limit: int) -> tuple[DataFrame, dict[int, int]]:
        with setting(spark, *TEXT_BATCH):
            made = scratch.write(read.mapInArrow(partial(_pieces, path=vocabulary, limit=limit, with_ids=with_ids), schema), f"pieces-{limit}")
        return made, {r["length"]: r["n"] for r in made.groupBy("length").agg(F.count("*").alias("n")).collect()}

    pieces, counts = cut(capacity)
    if not counts:
        return pieces.withColumns({"sequence_id": F.lit(None).cast("long"), "offset": F.lit(None).cast("long")})
    if (limit := piece_limit(counts, capacity)) < capacity:
        scratch.drop(f"pieces-{capacity}")
        pieces, counts = cut(limit)
    slots = _slots(shortest_pack_first(counts, capacity))
    return _with_rank(pieces, counts).mapInArrow(partial(_join_slots, slots=slots), schema + ", sequence_id long, offset long")


def padding(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: sequences, tokens, padding (sequences are padded to ``capacity``, except at a power of two)."""
    fill = packed.groupBy("sequence_id").agg(F.sum("length").alias("fill"))
    power = F.bit_count("fill") == 1
    return fill.agg(
        F.count("*").alias("sequences"), F.sum("fill").alias("tokens"), F.sum(F.when(power, 0).otherwise(capacity - F.col("fill"))).alias("padding")
    )
