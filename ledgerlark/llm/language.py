"""Language identification by prediction by partial matching over UTF-8 bytes.

Per language a context tree of order ORDER counts which byte follows which context.  A byte seen in the longest
known context costs its share there; else an escape is paid (method C: as many escape counts as distinct
followers) and the next shorter context decides among the bytes not yet excluded, down to a uniform choice.
Statistics are frozen after learning, so all code lengths of all contexts are laid out once in a table, and a text's exact
code length per language is a sum of table entries.  The shortest code wins.

Learned from a bounded sample: all rows of a language that has at most ``sample``, else about ``sample`` of its distinct
texts, each once, drawn by hash of the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import Scratch, slices

ORDER = 3
SAMPLE = 400
#: Contexts of the full order seen less often than this in every language are left to shorter contexts.
MIN_CONTEXT = 3
PIECE = 1 << 20
UNDETERMINED = "und"
_PAD = b"   "


@dataclass(frozen=True)
class ContextTrees:
    languages: tuple[str, ...]
    #: byte -> class; class 0 is any byte not learned
    classes: np.ndarray
    size: int
    #: three classes -> row, row * size + class -> bits per language
    rows: np.ndarray
    bits: np.ndarray


def _bytes(text: str | None) -> bytes:
    return (text or "").lower().encode()


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n): four-byte sequences (context and follower) as integers; each text starts after blanks."""
    for rb in batches:
        counts: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), strict=True):
            b = np.frombuffer(_PAD + _bytes(text), np.uint8).astype(np.int64)
            if len(b) > ORDER:
                counts.setdefault(lang, []).append(((b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]))
        for lang, parts in counts.items():
            grams, n = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])


def _tables(languages: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> ContextTrees:
    parts = np.stack([(gram >> s) & 255 for s in (24, 16, 8, 0)], axis=1)
    known = np.unique(parts)
    classes = np.zeros(256, dtype=np.int64)
    classes[known] = np.arange(1, len(known) + 1)
    size = len(known) + 1
    c = classes[parts]
    context = [np.zeros(len(c), dtype=np.int64)]  # contexts of order 0, 1, 2, 3 as numbers
    for k in range(1, ORDER + 1):
        context.append(context[-1] + c[:, 3 - k] * size ** (k - 1))
    base = np.full(size, 1.0 / 256)
    base[0] = max(1, 256 - len(known)) / 256
    often = np.zeros(0, dtype=np.int64)
    for i in range(len(languages)):
        ids, inverse = np.unique(context[ORDER][lang == i], return_inverse=True)
        often = np.union1d(often, ids[np.bincount(inverse, weights=n[lang == i], minlength=len(ids)) >= MIN_CONTEXT])
    wanted = [np.unique(np.concatenate([often % size**k, context[k]])) if k < ORDER else often for k in range(ORDER + 1)]
    bits = np.zeros((sum(map(len, wanted)), size, len(languages)), dtype=np.float32)
    for i in range(len(languages)):
        mine = lang == i
        below, at = base[None, :], 0
        for k in range(ORDER + 1):
            shorter = np.zeros(len(wanted[k]), dtype=np.int64) if k == 0 else np.searchsorted(wanted[k - 1], wanted[k] % size ** (k - 1))
            p = below[shorter].copy()
            counts = np.zeros((len(wanted[k]), size))
            where = np.searchsorted(wanted[k], context[k][mine])
            where[where == len(wanted[k])] = 0
            hit = wanted[k][where] == context[k][mine] if len(wanted[k]) else np.zeros(mine.sum(), dtype=bool)
            np.add.at(counts, (where[hit], c[mine, 3][hit]), n[mine][hit])
            total, kinds = counts.sum(axis=1, keepdims=True), (counts > 0).sum(axis=1, keepdims=True)
            unseen = np.where(counts > 0, 0.0, p)
            rest = unseen.sum(axis=1, keepdims=True)
            with np.errstate(divide="ignore", invalid="ignore"):
                own = np.where(counts > 0, counts / (total + kinds), kinds / (total + kinds) * unseen / np.where(rest > 0, rest, 1))
            p = np.where(total > 0, own, p)
            bits[at : at + len(p), :, i] = -np.log2(np.maximum(p, 1e-12))
            below, at = p, at + len(p)
    # the longest known context of each three classes
    every = np.arange(size**ORDER)
    rows, at = np.zeros(size**ORDER, dtype=np.int32), 0
    for k in range(ORDER + 1):
        if len(wanted[k]):
            short = every % size**k
            found = np.searchsorted(wanted[k], short)
            found[found == len(wanted[k])] = 0
            hit = wanted[k][found] == short
            rows[hit] = at + found[hit]
        at += len(wanted[k])
    return ContextTrees(tuple(languages), classes.astype(np.int32), size, rows, bits.reshape(-1, len(languages)))


def fit(docs: DataFrame, train: Column, sample: int = SAMPLE) -> ContextTrees:
    """Learn from rows of ``docs`` (text, lang) for which ``train`` holds and lang is not null."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "language")
    known = docs.where(train & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    texts = known.groupBy("lang", F.xxhash64("text").alias("h")).agg(F.count("*").alias("n"))
    sizes = {r["lang"]: (r["n"], r["m"]) for r in texts.groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("m")).collect()}
    languages = sorted(sizes)
    if not languages:
        return ContextTrees((), np.zeros(256, np.int32), 1, np.zeros(1, np.int32), np.zeros((1, 0), np.float32))
    shares = spark.createDataFrame([(k, min(1.0, sample / m), n > sample) for k, (n, m) in sizes.items()], "lang string, share double, once boolean")
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / F.lit(1 << 30)
    met = known.join(F.broadcast(shares), "lang").where(draw < F.col("share")).groupBy("lang", "text").agg(F.count("*").alias("n"), F.first("once").alias("once"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("once"), 1).otherwise(F.col("n")).cast("int")))
    drawn = scratch.write(met.select("lang", "text", copies).select("lang", "text"), "sample")
    grams = drawn.mapInArrow(_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    scratch.drop("sample")
    order = {k: i for i, k in enumerate(languages)}
    lang = np.array([order[x] for x in grams.column("lang").to_pylist()], dtype=np.int64)
    return _tables(languages, lang, grams.column("gram").to_numpy(), grams.column("n").to_numpy())


def code_lengths(texts: list[bytes], trees: ContextTrees) -> np.ndarray:
    """Bits per text and language; texts are worked through in pieces, each with the context before it."""
    out = np.zeros((len(texts), len(trees.languages)))

    def add(raw: list[bytes], owners: list[int]) -> None:
        joined = trees.classes[np.frombuffer(b"".join(raw), np.uint8)].astype(np.int64)
        index = (joined[:-3] * trees.size + joined[1:-2]) * trees.size + joined[2:-1]
        bits = trees.bits[trees.rows[index].astype(np.int64) * trees.size + joined[3:]]
        ends = np.cumsum([len(r) for r in raw])
        starts = ends - [len(r) for r in raw]
        cuts = np.stack([starts, ends - ORDER], axis=1).ravel()  # entry i is the byte at i + ORDER
        sums = np.add.reduceat(np.concatenate([bits, np.zeros((ORDER + 1, bits.shape[1]), np.float32)]), cuts, axis=0, dtype=np.float64)[::2]
        np.add.at(out, owners, sums)

    raw, owners, size = [], [], 0
    for i, t in enumerate(texts):
        for at in range(0, len(t), PIECE):
            part = (t[at - ORDER : at] if at else _PAD) + t[at : at + PIECE]
            if size + len(part) > PIECE and raw:
                add(raw, owners)
                raw, owners, size = [], [], 0
            raw.append(part)
            owners.append(i)
            size += len(part)
    if raw:
        add(raw, owners)
    return out


def _predict(batches: Iterator[pa.RecordBatch], trees: ContextTrees) -> Iterator[pa.RecordBatch]:
    """Replace the last column (text) by lang_pred and score."""
    names = np.array([*trees.languages, UNDETERMINED], dtype=object)
    for rb in slices(batches):
        texts = rb.column(rb.num_columns - 1).to_pylist()
        if trees.languages:
            bits = code_lengths([_bytes(t) for t in texts], trees)
            best = np.argmin(bits, axis=1)
            chance = 1 / np.exp2(np.minimum(bits.min(axis=1, keepdims=True) - bits, 0)).sum(axis=1)
        else:
            best, chance = np.zeros(len(texts), dtype=int), np.zeros(len(texts))
        letters = np.array([t is not None and any(map(str.isalpha, t)) for t in texts], dtype=bool) & bool(trees.languages)
        pred = names[np.where(letters, best, len(trees.languages))]
        cols = [*rb.columns[:-1], pa.array(pred.tolist(), pa.string()), pa.array(np.where(letters, chance, 0.0), pa.float64())]
        yield pa.RecordBatch.from_arrays(cols, names=[*rb.schema.names[:-1], "lang_pred", "score"])


def predict(docs: DataFrame, trees: ContextTrees) -> DataFrame:
    """(doc_id, lang_pred, score) for each row of ``docs``; only the text decides.

    ``und`` with score 0 where the text is null or has no letter; else the score is the language's share if all
    were as likely beforehand.  Ties go to the first language by name.
    """
    return docs.select("doc_id", "text").mapInArrow(partial(_predict, trees=trees), "doc_id long, lang_pred string, score double")
