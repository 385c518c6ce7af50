"""Quality score by compression: one zstandard dictionary from good text, one from bad.

A text is compressed block by block with either dictionary, so the dictionary counts everywhere in a long text, not
only at its start.  The difference of the two compressed sizes over the text's own size is the feature.  Short
texts are drawn to the corpus mean, the feature is bent to limit outliers, and a logistic curve fitted on labelled
documents that no dictionary has seen turns it into a score.

Fitted on a bounded sample: about ``sample`` labelled documents per class (two thirds for the dictionaries, one
third for the curve), from each at most ``BLOCKS_PER_DOC`` blocks for the dictionaries.  The sample is drawn by
hash over all labels, whatever their number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import Scratch, slices

BLOCK = 512
BLOCKS_PER_DOC = 8
DICTIONARY_BYTES = 64 * 1024
LEVEL = 3
SAMPLE = 2400
#: Every text counts as if so many more bytes of average quality belonged to it.
PRIOR_BYTES = 128
BEND = 20.0


@dataclass(frozen=True)
class CompressionModel:
    good: bytes
    bad: bytes
    prior: float
    bias: float
    slope: float


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    kind = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=kind, write_content_size=False, write_checksum=False, write_dict_id=False)


def _blocks(text: str | None) -> list[bytes]:
    raw = (text or "").encode()
    return [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]


def size_difference(text: str | None, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> tuple[int, int]:
    """(bytes that the dictionary of good text saves against the other, bytes of the text)."""
    saved = size = 0
    for b in _blocks(text):
        saved += len(bad.compress(b)) - len(good.compress(b))
        size += len(b)
    return saved, size


def _sample_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, block): evenly spread blocks of each sampled text."""
    for rb in batches:
        labels, out = [], []
        for label, text in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), strict=True):
            own = _blocks(text)
            at = range(len(own)) if len(own) <= BLOCKS_PER_DOC else np.linspace(0, len(own) - 1, BLOCKS_PER_DOC).astype(int)
            for i in at:
                labels.append(label)
                out.append(own[i])
        yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(out, pa.binary())], names=["label", "block"])


def _features(batches: Iterator[pa.RecordBatch], good: bytes, bad: bytes) -> Iterator[pa.RecordBatch]:
    """Replace the last column (text) by saved and size."""
    a, b = _compressor(good), _compressor(bad)
    for rb in slices(batches):
        found = [size_difference(t, a, b) for t in rb.column(rb.num_columns - 1).to_pylist()]
        cols = [*rb.columns[:-1], pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())]
        yield pa.RecordBatch.from_arrays(cols, names=[*rb.schema.names[:-1], "saved", "size"])


def _fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weighted logistic regression on one feature by Newton steps, with a slight pull to 0."""
    if len(x) == 0:
        return 0.0, 0.0
    w = np.zeros(2)
    a = np.stack([np.ones_like(x), x], axis=1)
    pull = np.diag([1e-6, 1e-4]) * weight.sum()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ a + pull, a.T @ (weight * (y - p)) - pull @ w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def _dictionary(blocks: list[bytes]) -> bytes:
    """A trained dictionary, or the blocks themselves where there are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[-DICTIONARY_BYTES:]


def fit(docs: DataFrame, labels: DataFrame, train: Column, sample: int = SAMPLE) -> CompressionModel:
    """``labels``: doc_id and label (0, 1; others are ignored); ``train``: which doc_ids may be learned from.

    Labels are sampled before they meet the texts, so only sampled texts leave the scan.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")
    known = labels.where(train & F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col("label").cast("int"))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = lambda q: F.lit(min(1.0, sample / max(1, counts.get(q, 0))))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(1 << 30)
    drawn = known.where(draw < F.when(F.col("label") == 1, share(1)).otherwise(share(0)))
    # about 2 * sample rows
    texts = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(3)))
    chosen = scratch.write(texts.select("label", "text", "part"), "sample")
    blocks: dict[int, list[bytes]] = {0: [], 1: []}
    for r in chosen.where("part < 2").select("label", "text").mapInArrow(_sample_blocks, "label int, block binary").collect():
        blocks[r["label"]].append(bytes(r["block"]))
    for own in blocks.values():
        own.sort()  # the order in which tasks end does not matter
    good, bad = _dictionary(blocks[1]), _dictionary(blocks[0])
    rows = chosen.where("part = 2").select("label", "text").mapInArrow(partial(_features, good=good, bad=bad), "label int, saved long, size long").collect()
    saved, size, y = (np.array([r[c] for r in rows], dtype=float) for c in ("saved", "size", "label"))
    weight = np.where(y == 1, counts.get(1, 0) / max(1, (y == 1).sum()), counts.get(0, 0) / max(1, (y == 0).sum()))
    prior = float((weight * saved / np.maximum(size, 1)).sum() / max(weight.sum(), 1e-9))
    x = np.tanh(BEND * (saved + prior * PRIOR_BYTES) / (size + PRIOR_BYTES))
    bias, slope = _fit_curve(x, y, weight)
    scratch.drop("sample")
    return CompressionModel(good, bad, prior, bias, slope)


def score(docs: DataFrame, model: CompressionModel) -> DataFrame:
    """(doc_id, score) for each row of ``docs``; only the text decides.

    Null texts count as empty and score like average text.  Repeated rows score alike.
    """
    sizes = docs.select("doc_id", "text").mapInArrow(partial(_features, good=model.good, bad=model.bad), "doc_id long, saved long, size long")
    x = F.tanh(BEND * (F.col("saved") + model.prior * PRIOR_BYTES) / (F.col("size") + PRIOR_BYTES))
    return sizes.select("doc_id", (1 / (1 + F.exp(-(F.lit(model.bias) + F.lit(model.slope) * x)))).alias("score"))
