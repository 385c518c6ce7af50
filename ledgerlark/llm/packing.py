"""Best-two-fit packing of tokenised documents into sequences of fixed length.

Fill a bin greedily, each time with the longest piece that fits; then try to replace the bin's smallest piece by
two unpacked pieces that fill the widened gap better.  Pieces of one length are alike, so what is packed is the
histogram of lengths (at most ``capacity`` numbers, whatever the input): a bin pattern is repeated as often as the
counts allow.  Each piece finds its bin from its rank among the pieces of its length.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

from ledgerlark.llm.common import TEXT_BATCH, Scratch, freeing, give_back, setting

CAPACITY = 2048
END_ID = 0
VOCABULARY = "word_bpe_49k.json"
CELL_ROWS = 500
CACHE_ENTRIES = 700_000
GROUP_CHARS = 500_000
#: The vocabulary's own word pattern; words never hold white space, so texts may be cut there.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: Text of these characters is lower-cased and composed one character at a time, here as in the tokenizer.
PLAIN = regex.compile("[\x20-\x7e\xa0-įı-ɏ]*")


class WordTokens:
    """Token ids of texts as bytes (little-endian unsigned 32 bits), from a bounded cache of runs between blanks and
    of the words in them.  Equal to encoding the whole text: the vocabulary's words never cross white space.

    Runs with other characters, or with a control string, go through the tokenizer as they are.  A full cache
    becomes the old generation, from which what is still used moves on.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.tokenizer.model)  # for words that are cut out and normalised already
        self.plain.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends_word[i] = token.endswith("</w>")
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    @staticmethod
    def _encode(tokenizer: Tokenizer, text: str) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _learn(self, runs: set[str]) -> None:
        known, old = self.known, self.old
        parts, words = {}, []
        for run in runs:
            if (ids := old.get(run)) is not None:
                known[run] = ids
            elif not run.isascii() and PLAIN.fullmatch(run) is None or "<|" in run:
                known[run] = self._encode(self.tokenizer, run).tobytes()
            elif run.isalpha() and run.islower():  # most runs: one word, perhaps with a mark after it
                words.append(run)
            elif run[-1:] in (",", ".") and run[:-1].isalpha():
                parts[run] = (run[:-1].lower(), run[-1])
            else:
                parts[run] = WORD.findall(run.lower())
        seen = set(words)
        for ws in parts.values():
            for w in ws:
                if w not in known and w not in seen:
                    if (ids := old.get(w)) is not None:
                        known[w] = ids
                    else:
                        seen.add(w)
                        words.append(w)
        if words:
            ids = self._encode(self.plain, " ".join(words))
            stops = np.flatnonzero(self.ends_word[ids]) + 1
            if len(stops) == len(words):
                raw, at = ids.tobytes(), 0
                for w, stop in zip(words, (stops * 4).tolist(), strict=True):
                    known[w] = raw[at:stop]
                    at = stop
            else:  # a word without a word-end token: one at a time
                for w in words:
                    known[w] = self._encode(self.tokenizer, w).tobytes()
        for run, ws in parts.items():
            known[run] = b"".join([known[w] for w in ws])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of a group of texts."""
        if len(self.known) > CACHE_ENTRIES:
            self.known, self.old = {}, self.known
        low = [t.lower() if "<|" not in t and (t.isascii() or PLAIN.fullmatch(t)) else t for t in texts]
        cut = [t.replace("\n", " ").split(" ") for t in low]
        get = self.known.get
        found = [list(map(get, c)) for c in cut]
        gaps = [i for i, f in enumerate(found) if None in f]
        if gaps:
            self._learn({r for i in gaps for r, x in zip(cut[i], found[i], strict=True) if x is None})
            for i in gaps:
                found[i] = [x if x is not None else get(r) for r, x in zip(cut[i], found[i], strict=True)]
        return [b"".join(f) for f in found]


@lru_cache(maxsize=1)
def _tokens(path: str) -> WordTokens:
    return WordTokens(path)


def _groups(texts: list[str]) -> Iterator[list[str]]:
    group, size = [], 0
    for t in texts:
        if group and size + len(t) > GROUP_CHARS:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group


def _cut_pieces(batches: Iterator[pa.RecordBatch], path: str | None, capacity: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    give_back()  # earlier jobs may have used this worker
    tokens = _tokens(path or public_tokenizers.path(VOCABULARY))
    end = np.array([END_ID], dtype="<u4").tobytes()
    for rb in batches:
        texts = [t or "" for t in rb.column(1).to_pylist()]
        at = 0
        for group in _groups(texts):
            rows: list[list] = [[], [], [], [], [], []]
            for doc_id, raw in zip(rb.column(0)[at : at + len(group)].to_pylist(), tokens.encode(group), strict=True):
                raw += end
                for k, start in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[start : start + 4 * capacity]
                    row = (doc_id, k, start // 4, len(part) // 4, zlib.crc32(part), np.frombuffer(part, "<u4").astype(np.int32) if with_ids else None)
                    for col, v in zip(rows, row, strict=True):
                        col.append(v)
            at += len(group)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            keep = 6 if with_ids else 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows[:keep], types[:keep], strict=True)], names=names[:keep])


def bin_patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """(repeats, lengths) of each bin pattern, by best-two-fit over a histogram of lengths."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    lengths = np.arange(capacity + 1)
    patterns = []
    while True:
        have = np.flatnonzero(left)
        if not len(have):
            return patterns
        free = left.copy()
        bin_, gap = [int(have[-1])], capacity - int(have[-1])
        free[have[-1]] -= 1
        fits = np.maximum.accumulate(np.where(free > 0, lengths, 0))  # longest free piece of at most this length
        while gap and (take := int(fits[gap])):
            bin_.append(take)
            gap -= take
            free[take] -= 1
            if not free[take]:
                fits = np.maximum.accumulate(np.where(free > 0, lengths, 0))
        while gap and len(bin_) > 1:  # two for the smallest
            small = min(bin_)
            room = gap + small
            a = np.flatnonzero(free[: room + 1])
            a = a[a > 0]
            if not len(a):
                break
            b = fits[room - a]
            alone = (b == a) & (free[a] < 2)
            b = np.where(alone, fits[np.maximum(a - 1, 0)], b)
            total = np.where(b > 0, a + b, 0)
            best = int(np.argmax(total))
            if total[best] <= small:
                break
            bin_.remove(small)
            free[small] += 1
            for x in (int(a[best]), int(b[best])):
                bin_.append(x)
                free[x] -= 1
            gap = room - int(total[best])
            fits = np.maximum.accumulate(np.where(free > 0, lengths, 0))
        used, uses = np.unique(bin_, return_counts=True)
        repeats = int(np.min(left[used] // uses))
        left[used] -= uses * repeats
        patterns.append((repeats, sorted(bin_, reverse=True)))


def _ranges(patterns: list[tuple[int, list[int]]]) -> dict[str, np.ndarray]:
    """For each length, in order of rank: first rank, first sequence, offset."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for repeats, lengths in patterns:
        offset = 0
        for length in lengths:
            rank = taken.get(length, 0)
            rows.append((length, rank, sequence, offset))
            taken[length] = rank + repeats
            offset += length
        sequence += repeats
    length, rank, first, offset = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4).T
    return {"length": length, "rank": rank, "sequence": first, "offset": offset}


def _place(batches: Iterator[pa.RecordBatch], ranges: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Replace the last column (rank) by sequence_id and offset."""
    key = ranges["length"].astype(np.float64) * 2.0**40 + ranges["rank"]  # exact: lengths below 2**12, ranks below 2**40
    for rb in batches:
        length = rb.column(rb.schema.get_field_index("length")).to_numpy()
        rank = rb.column(rb.num_columns - 1).to_numpy()
        at = np.searchsorted(key, length.astype(np.float64) * 2.0**40 + rank, side="right") - 1
        sequence = ranges["sequence"][at] + rank - ranges["rank"][at]
        yield pa.RecordBatch.from_arrays(
            [*rb.columns[:-1], pa.array(sequence), pa.array(ranges["offset"][at])], names=[*rb.schema.names[:-1], "sequence_id", "offset"]
        )


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset.

    Reads doc_id and text only.  A null or empty text is the end id alone.  Documents longer than ``capacity`` are
    cut into pieces of that size.  Repeated rows and null ids are packed like any other row; ties in rank are
    between equal rows.  An empty table gives an empty result.  ``vocabulary``: path of the tokenizer file.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    cut = partial(_cut_pieces, path=vocabulary, capacity=capacity, with_ids=with_ids)
    with setting(spark, *TEXT_BATCH):
        pieces = scratch.write(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(freeing(cut), schema), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return pieces.withColumns({"sequence_id": F.lit(None).cast("long"), "offset": F.lit(None).cast("long")})
    ranges = _ranges(bin_patterns(counts, capacity))

    # rank within a length: rank within a cell of about CELL_ROWS pieces, plus the pieces in earlier cells
    cells = spark.createDataFrame([(k, -(-n // CELL_ROWS)) for k, n in counts.items()], "length long, cells long")
    dealt = pieces.join(F.broadcast(cells), "length").withColumn("cell", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("cells"))).drop("cells")
    before = dealt.groupBy("length", "cell").agg(F.count("*").alias("n")).withColumn(
        "before", F.sum("n").over(Window.partitionBy("length").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    )
    in_cell = Window.partitionBy("length", "cell").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (
        dealt.withColumn("rank", F.row_number().over(in_cell) - 1)
        .join(before.drop("n"), ["length", "cell"])
        .select(*pieces.columns, (F.col("rank") + F.col("before")).alias("rank"))
    )
    return ranked.mapInArrow(partial(_place, ranges=ranges), schema + ", sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids) from pieces packed ``with_ids``; a sequence holds at most ``capacity`` ids."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id"))).alias("p"))
    return parts.select("sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"), F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"))


assert sys.byteorder == "little"  # ids are read back as written
