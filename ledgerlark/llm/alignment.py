"""Alignment of two tokenizers over the same texts.

Both tokenisations of a text cover the same bytes; where tokens of both end they cut the text into groups, and every
token A of a group is linked with every token B of it.

* Identity map.  For each A id the B id of the same bytes is looked up once (an array over vocabulary A).  A group of one
  token each is nearly always such a pair.  Links of mapped pairs need no pair at all: their document counts are one
  vector over vocabulary A, summed task by task.
* Pair shuffle.  Only links that the map does not cover are shuffled, as distinct (A, B) per document, and counted.
* Scores.  A document's links take their counts from the vector and from the most frequent pairs, up to a fixed number of
  them; rarer pairs are joined on the pair.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import TEXT_BATCH, Scratch, setting, slices, text_groups

VOCABULARY_A = "byte_bpe_50k.json"
VOCABULARY_B = "piece_bpe_32k.model"
#: Pairs whose counts travel to all tasks (16 bytes each); the others are joined.
SENT_PAIRS = 500_000
#: Groups with more links than this are reduced to distinct ids before they are paired.
WIDE_GROUP = 4096
#: Very long texts go to the tokenizers in parts of about this many characters.
PART_CHARS = 200_000
#: Characters that every version of the Unicode tables classes alike, so both byte-level encoders split them alike.
SETTLED = regex.compile(r"[\x00-\u024f\u0370-\u03ff\u2000-\u206f]*")
_CUT = regex.compile(r"(?<=[^\s]) (?=[^\s])")
_B_BITS = 16


def byte_alphabet() -> dict[str, int]:
    """Character that stands for each byte in a byte-level vocabulary: itself if printable, else from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabularies:
    """Both tokenizers, the bytes of their tokens and the identity map."""

    def __init__(self, path_a: str, path_b: str):
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        self.exact_a = tokenizers.Tokenizer.from_file(path_a)
        self.exact_a.encode_special_tokens = True
        special = {t["id"] for t in spec["added_tokens"]}
        letters = byte_alphabet()
        vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.bytes_a = [b""] * (1 + max([*vocabulary.values(), *special]))
        for token, i in vocabulary.items():
            if i not in special:
                self.bytes_a[i] = bytes(letters[c] for c in token)
        # Ids that follow the order of the merges can serve as ranks.
        merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
        self.fast_a = None
        if merged == list(range(256, 256 + len(merged))):
            ranks = {b: i for i, b in enumerate(self.bytes_a) if i not in special}
            self.fast_a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.model_b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        b = self.model_b
        self.bytes_b = []
        for i in range(b.get_piece_size()):
            piece = b.id_to_piece(i)
            plain = b"" if b.is_control(i) or b.is_unknown(i) else piece.replace("▁", " ").encode()
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if b.is_byte(i) else plain)
        assert len(self.bytes_b) < 1 << _B_BITS
        self.starts_words = not any(b" " in x.lstrip(b" ") for x in self.bytes_b)  # a space only ever begins a token
        self.length_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        of_bytes: dict[bytes, int] = {}
        for i, x in enumerate(self.bytes_b):  # a byte's fall-back id counts only where no piece has that byte
            if x and (x not in of_bytes or b.is_byte(of_bytes[x]) and not b.is_byte(i)):
                of_bytes[x] = i
        self.same = np.array([of_bytes.get(x, -1) if x else -1 for x in self.bytes_a], dtype=np.int64)
        # Ids as text with what follows them: within a group, at the end of its part, and at the end of the text.
        ids = range(max(len(self.bytes_a), len(self.bytes_b)))
        self.comma, self.bar, self.semicolon = (np.array([b"%d%s" % (i, sign) for i in ids], dtype=object) for sign in (b",", b"|", b";"))

    def _parts(self, text: str) -> Iterator[str]:
        """Parts that start at a single space after the first one: no token of either vocabulary crosses into such a space."""
        at = 0
        while self.starts_words and len(text) - at > PART_CHARS:
            m = _CUT.search(text, at + PART_CHARS)
            if m is None:
                break
            yield text[at : m.start()]
            at = m.start()
        yield text[at:]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A and of B for a space and the text; None where the tokens do not spell that out."""
        spaced, a, b = " " + text, [], []
        for part in self._parts(spaced):
            if self.fast_a is not None and SETTLED.fullmatch(part):  # whole bytes by construction
                a.append(np.array(self.fast_a.encode_ordinary(part), dtype=np.int64))
            else:
                ids = self.exact_a.encode(part, add_special_tokens=False).ids
                if b"".join(map(self.bytes_a.__getitem__, ids)) != part.encode():
                    return None
                a.append(np.array(ids, dtype=np.int64))
            b += self.model_b.encode(part[1:])  # this one adds the space itself
        if b"".join(map(self.bytes_b.__getitem__, b)) != spaced.encode():
            return None
        return np.concatenate(a), np.array(b, dtype=np.int64)


@lru_cache(maxsize=1)
def vocabularies(path_a: str | None, path_b: str | None) -> Vocabularies:
    return Vocabularies(path_a or public_tokenizers.path(VOCABULARY_A), path_b or public_tokenizers.path(VOCABULARY_B))


def _linked(a: np.ndarray, b: np.ndarray, first_a, n_a, first_b, n_b) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs (as one number) of the given groups, and how often each is linked."""
    wide = n_a * n_b > WIDE_GROUP
    fa, na, fb, nb = (x[~wide] for x in (first_a, n_a, first_b, n_b))
    links = na * nb
    which = np.repeat(np.arange(len(links)), links)
    nth = np.arange(len(which)) - (np.cumsum(links) - links)[which]
    keys = [(a[fa[which] + nth // nb[which]] << _B_BITS) | b[fb[which] + nth % nb[which]]]
    times = [np.ones(len(which), dtype=np.int64)]
    for i in np.flatnonzero(wide).tolist():
        ids_a, times_a = np.unique(a[first_a[i] : first_a[i] + n_a[i]], return_counts=True)
        ids_b, times_b = np.unique(b[first_b[i] : first_b[i] + n_b[i]], return_counts=True)
        keys.append(((ids_a << _B_BITS)[:, None] | ids_b).ravel())
        times.append((times_a[:, None] * times_b).ravel())
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, np.bincount(inverse, np.concatenate(times), len(distinct)).astype(np.int64)


def align_text(v: Vocabularies, text: str | None) -> dict | None:
    """Groups and distinct links of one text; None where it has no tokens."""
    if not text or (ids := v.encode(text)) is None:
        return None
    a, b = ids
    ends_a, ends_b = np.cumsum(v.length_a[a]), np.cumsum(v.length_b[b])
    at = np.searchsorted(ends_b, ends_a)
    last_a = np.flatnonzero(ends_b[at] == ends_a)
    last_b = at[last_a]
    n_a, n_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
    first_a, first_b = last_a - n_a + 1, last_b - n_b + 1
    identity = (n_a == 1) & (n_b == 1) & (v.same[a[last_a]] == b[last_b])
    # The groups as text: tokens A of a group stand after all tokens of the groups before it, tokens B after these.
    written = np.empty(len(a) + len(b), dtype=object)
    place = np.arange(len(a)) + np.repeat(first_b, n_a)
    written[place] = v.comma[a]
    written[place[last_a]] = v.bar[a[last_a]]
    place = np.arange(len(b)) + np.repeat(last_a + 1, n_b)
    written[place] = v.comma[b]
    written[place[last_b]] = v.semicolon[b[last_b]]
    groups = b"".join(written.tolist())[:-1]
    rest = np.flatnonzero(~identity)
    same_a, same_n = np.unique(a[last_a[identity]], return_counts=True)
    pair, pair_n = _linked(a, b, first_a[rest], n_a[rest], first_b[rest], n_b[rest])
    mapped = v.same[pair >> _B_BITS] == (pair & ((1 << _B_BITS) - 1))  # a mapped pair inside a larger group
    if mapped.any():
        joined = np.concatenate([same_a, pair[mapped] >> _B_BITS])
        same_a, inverse = np.unique(joined, return_inverse=True)
        same_n = np.bincount(inverse, np.concatenate([same_n, pair_n[mapped]])).astype(np.int64)
        pair, pair_n = pair[~mapped], pair_n[~mapped]
    return {
        "n_a": len(a), "n_b": len(b), "n_groups": len(last_a), "n_links": int(np.sum(n_a * n_b)), "groups": groups,
        "same_a": same_a, "same_n": same_n, "pair_a": pair >> _B_BITS, "pair_b": pair & ((1 << _B_BITS) - 1), "pair_n": pair_n,
    }


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_LISTS = ("same_a", "same_n", "pair_a", "pair_b", "pair_n")
_NOTHING = dict.fromkeys(_COUNTS, 0) | dict.fromkeys(_LISTS, np.zeros(0, dtype=np.int64)) | {"groups": b""}


def _align(batches: Iterator[pa.RecordBatch], path_a: str | None, path_b: str | None, with_groups: bool) -> Iterator[pa.RecordBatch]:
    v = vocabularies(path_a, path_b)
    for rb in slices(batches):
        at = 0
        for group in text_groups([t or "" for t in rb.column(1).to_pylist()]):
            rows = [align_text(v, t) or _NOTHING for t in group]
            digest = [hashlib.sha256(r["groups"]).hexdigest() if r["groups"] else "" for r in rows]
            cols = [
                rb.column(0).slice(at, len(group)),
                *(pa.array([r[c] for r in rows], pa.int64()) for c in _COUNTS),
                pa.array(digest, pa.string()),
                *(pa.array([r[c].astype(np.int32) for r in rows], pa.list_(pa.int32())) for c in _LISTS),
            ]
            if with_groups:
                cols.append(pa.array([r["groups"].decode() for r in rows], pa.string()))
            at += len(group)
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", *_COUNTS, "groups_sha256", *_LISTS, *(["groups"] if with_groups else [])])


def _sum_vector(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The task's documents per A id, over the mapped pairs."""
    total = np.zeros(size, dtype=np.int64)
    for rb in batches:
        total += np.bincount(rb.column(0).flatten().to_numpy(), minlength=size)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["a", "docs"])


class Mapping:
    """Document counts of all linked pairs: a vector for the mapped ones, a table (a, b, docs) for the others.

    ``best``: the highest count of each A id, over both.
    """

    def __init__(self, aligned: DataFrame, scratch: Scratch, v: Vocabularies):
        size = len(v.bytes_a)
        self.same = v.same
        self.vector, self.best = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        parts = aligned.select("same_a").mapInArrow(partial(_sum_vector, size=size), "a int, docs long")
        for r in parts.groupBy("a").agg(F.sum("docs").alias("docs")).toArrow().to_pylist():  # at most one row per A id
            self.vector[r["a"]] = r["docs"]
        pairs = aligned.select(F.explode(F.arrays_zip("pair_a", "pair_b")).alias("p")).select(F.col("p.pair_a").alias("a"), F.col("p.pair_b").alias("b"))
        self.pairs = scratch.write(pairs.groupBy("a", "b").agg(F.count("*").alias("docs")), "pairs")
        for r in self.pairs.groupBy("a").agg(F.max("docs").alias("docs")).toArrow().to_pylist():
            self.best[r["a"]] = r["docs"]
        self.best = np.maximum(self.best, self.vector)

    def table(self) -> DataFrame:
        """(a, b, docs, best) of every linked pair."""
        spark = self.pairs.sparkSession
        ids = np.flatnonzero(self.vector).tolist()
        mapped = spark.createDataFrame([(i, int(self.same[i]), int(self.vector[i])) for i in ids], "a int, b int, docs long")
        highest = spark.createDataFrame([(i, n) for i, n in enumerate(self.best.tolist()) if n], "a int, best long")
        return self.pairs.unionByName(mapped).join(F.broadcast(highest), "a").select("a", "b", "docs", (F.col("docs") == F.col("best")).alias("best"))

    def split(self) -> tuple[np.ndarray, np.ndarray, DataFrame | None]:
        """(pairs as numbers, their counts) of the most frequent pairs, and the table of the others, if any."""
        level = F.floor(F.log2("docs") * 8)  # a few hundred values
        sizes = {r["level"]: r["n"] for r in self.pairs.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()}
        room, cut = SENT_PAIRS, None
        for k in sorted(sizes, reverse=True):
            if sizes[k] > room:
                cut = k
                break
            room -= sizes[k]
        sent = (self.pairs if cut is None else self.pairs.filter(level > cut)).toArrow()
        key = (sent["a"].to_numpy().astype(np.int64) << _B_BITS) | sent["b"].to_numpy()
        order = np.argsort(key)
        return key[order], sent["docs"].to_numpy()[order], None if cut is None else self.pairs.filter(level <= cut)


def _flat(rb: pa.RecordBatch, *names: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """(row of each element, elements of the list columns)."""
    sizes = rb.column(names[0]).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(rb.num_rows), sizes), [rb.column(n).flatten().to_numpy().astype(np.int64) for n in names]


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(keys, wanted)
    found = at < len(keys)
    found[found] = keys[at[found]] == wanted[found]
    return at, found


def _score(batches: Iterator[pa.RecordBatch], known) -> Iterator[pa.RecordBatch]:
    """Sums over the links whose counts are at hand; list columns are dropped."""
    vector, best, keys, docs = known.value
    for rb in batches:
        n = rb.num_rows
        row, (a, times) = _flat(rb, "same_a", "same_n")
        top = np.bincount(row, times * (vector[a] == best[a]), n)
        total = _exact_sum(row, times * vector[a], n)
        row, (a, b, times) = _flat(rb, "pair_a", "pair_b", "pair_n")
        at, found = _find(keys, (a << _B_BITS) | b)
        row, a, times, count = row[found], a[found], times[found], docs[at[found]]
        top = top + np.bincount(row, times * (count == best[a]), n)
        total = total + _exact_sum(row, times * count, n)
        keep = [c for c in rb.schema.names if c not in _LISTS]
        cols = [*(rb.column(c) for c in keep), pa.array(top.astype(np.int64)), pa.array(total)]
        yield pa.RecordBatch.from_arrays(cols, names=[*keep, "n_best", "count_sum"])


def _exact_sum(row: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sum per row in whole numbers (rows rise)."""
    total = np.concatenate([[0], np.cumsum(values)])
    edges = np.searchsorted(row, np.arange(n + 1))
    return total[edges[1:]] - total[edges[:-1]]


def _not_sent(batches: Iterator[pa.RecordBatch], known) -> Iterator[pa.RecordBatch]:
    """(row_id, a, b, links) of the pairs that are not at hand."""
    keys = known.value[2]
    for rb in batches:
        row, (a, b, times) = _flat(rb, "pair_a", "pair_b", "pair_n")
        rest = ~_find(keys, (a << _B_BITS) | b)[1]
        ids = rb.column("row_id").to_numpy()[row[rest]]
        cols = [pa.array(ids), pa.array(a[rest].astype(np.int32)), pa.array(b[rest].astype(np.int32)), pa.array(times[rest])]
        yield pa.RecordBatch.from_arrays(cols, names=["row_id", "a", "b", "links"])


def align(
    docs: DataFrame, vocabulary_a: str | None = None, vocabulary_b: str | None = None, with_groups: bool = False
) -> tuple[DataFrame, Mapping]:
    """(one row per row of ``docs``, mapping of the whole table).

    Columns: doc_id, n_a, n_b, n_groups, n_links, groups_sha256[, groups], n_best, count_sum.  A pair's count is the
    number of rows that hold it linked; ``n_best``: links with the highest count of their A id; ``count_sum``: counts summed over links.
    ``groups``: ids of A and B per group, ``a1,a2|b1;a3|b2,b3``.

    Reads doc_id and text only, so other columns never clash.  A null or empty text, and one that either vocabulary
    does not spell out byte for byte, has no tokens: zeros and ''.  Repeated rows count each; null ids are rows like any other.
    Control strings inside texts are ordinary text.  A very long text is tokenised in parts and aligned by the task that reads it.
    An empty table gives an empty result.  The driver sees vectors over vocabulary A and at most ``SENT_PAIRS`` pairs.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "alignment")
    lists = ", ".join(f"{c} array<int>" for c in _LISTS)
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in _COUNTS) + f", groups_sha256 string, {lists}" + (", groups string" if with_groups else "")
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    one = partial(_align, path_a=vocabulary_a, path_b=vocabulary_b, with_groups=with_groups)
    with setting(spark, *TEXT_BATCH):
        aligned = scratch.write(read.mapInArrow(one, schema).withColumn("row_id", F.monotonically_increasing_id()), "aligned")
    mapping = Mapping(aligned, scratch, vocabularies(vocabulary_a, vocabulary_b))
    keys, counts, others = mapping.split()
    known = spark.sparkContext.broadcast((mapping.vector, mapping.best, keys, counts))
    plain = [f for f in aligned.schema.fields if f.name not in _LISTS]
    result = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in plain) + "n_best long, count_sum long"
    scored = aligned.mapInArrow(partial(_score, known=known), result)
    if others is not None:
        rest = aligned.select("row_id", "pair_a", "pair_b", "pair_n").mapInArrow(partial(_not_sent, known=known), "row_id long, a int, b int, links long")
        highest = spark.createDataFrame([(i, n) for i, n in enumerate(mapping.best.tolist()) if n], "a int, best long")
        sums = rest.join(others, ["a", "b"]).join(F.broadcast(highest), "a").groupBy("row_id").agg(
            F.sum(F.when(F.col("docs") == F.col("best"), F.col("links")).otherwise(0)).alias("more_best"), F.sum(F.col("docs") * F.col("links")).alias("more")
        )
        scored = scored.join(sums, "row_id", "left").withColumns(
            {"n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more", F.lit(0))}
        )
    tail = ["groups"] if with_groups else []
    return scored.select("doc_id", *_COUNTS, "groups_sha256", *tail, "n_best", "count_sum"), mapping
