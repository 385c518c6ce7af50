"""Compression quality and language identification: held-out accuracy, exact code lengths, odd inputs."""

import math
import random
from collections import Counter

import numpy as np
import zstandard
from pyspark.sql import functions as F

from ledgerlark.llm import language, quality_model, queries

SF = "/root/testdata/sf0.01"


def test_quality_on_held_out_documents(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.op3_compression_quality(spark, SF).collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    held = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    good, bad = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    wins = sum((g > b) + 0.5 * (g == b) for g in good for b in bad)
    assert wins / (len(good) * len(bad)) > 0.95
    assert sum(s >= 0.3 for s in good) / len(good) > 0.97


def test_quality_odd_inputs(spark, make_docs):
    good = [f"calm words follow each other number {i} in a quiet line of prose" for i in range(40)]
    bad = [f"$$$ ### buy{i} !!! $$$ ### %%% &&& now{i} $$$" for i in range(40)]
    docs = make_docs(good + bad + [None, "", "x" * 300_000])
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(80)] + [(None, 1), (5, None), (81, 7)], "doc_id long, label int")
    model = quality_model.fit(docs, labels, F.lit(True))
    rows = {r["doc_id"]: r["score"] for r in quality_model.score(docs, model).collect()}
    assert len(rows) == 83 and min(rows[i] for i in range(40)) > max(rows[i] for i in range(40, 80))
    assert rows[80] == rows[81] and all(0 <= v <= 1 for v in rows.values())
    empty = quality_model.fit(docs.where("false"), labels.where("false"), F.lit(True))
    assert {round(r["score"], 6) for r in quality_model.score(docs, empty).collect()} == {0.5}
    assert quality_model.score(docs.where("false"), model).count() == 0


def test_quality_scores_equal_plain_zstandard(spark):
    """Every score from the two dictionaries block by block; the curve is where the slope of its likelihood is 0."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    model = quality_model.fit(docs, labels, F.lit(True))
    packers = [
        zstandard.ZstdCompressor(level=quality_model.LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_checksum=False, write_dict_id=False)
        for d in (model.good, model.bad)
    ]

    def plain(text):
        raw = (text or "").encode()
        parts = [raw[i : i + 512] for i in range(0, len(raw), 512)]
        good, bad = (sum(len(z.compress(p)) for p in parts) for z in packers)
        return math.tanh(quality_model.BEND * (bad - good + model.prior * quality_model.PRIOR_BYTES) / (len(raw) + quality_model.PRIOR_BYTES))

    bent = {r["doc_id"]: plain(r["text"]) for r in docs.collect()}
    got = {r["doc_id"]: r["score"] for r in quality_model.score(docs, model).collect()}
    assert set(got) == set(bent)
    assert all(abs(got[d] - 1 / (1 + math.exp(-(model.bias + model.slope * x)))) < 1e-9 for d, x in bent.items())

    rng = np.random.default_rng(1)
    y = (rng.random(400) < 0.7).astype(float)
    x, weight = rng.normal(size=400) + y, rng.random(400) + 0.5
    bias, slope = quality_model._fit_curve(x, y, weight)
    gap = weight * (y - 1 / (1 + np.exp(-(bias + slope * x))))
    assert abs(gap.sum() - 1e-6 * weight.sum() * bias) < 1e-6 and abs((gap * x).sum() - 1e-4 * weight.sum() * slope) < 1e-6


def test_language_on_held_out_documents(spark):
    want = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op4_ppm_language(spark, SF).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == 1000 and sum(r["lang_pred"] == want[r["doc_id"]] for r in held) / len(held) > 0.98


def chance_plain(raw, i, followers, kept, known):
    """Distribution of the next byte from the shortest context up, each mixed into the next as the tables do."""
    classes = sorted(known)
    p = {b: 1 / 256 for b in classes}
    p[None] = max(1, 256 - len(known)) / 256
    for k in range(4):
        c = raw[i - k : i]
        seen = followers[k].get(c)
        if not seen or (k == 3 and c not in kept):
            continue
        total, kinds = sum(seen.values()), len(seen)
        rest = sum(v for b, v in p.items() if b not in seen)
        p = {b: seen[b] / (total + kinds) if b in seen else kinds / (total + kinds) * v / rest for b, v in p.items()}
    return p.get(raw[i], p[None])


def test_code_lengths_are_exact(spark, monkeypatch):
    rng = random.Random(7)
    texts = {"aa": ["ana banana kana " * 3 + "".join(rng.choice("abn ") for _ in range(50)) for _ in range(6)], "bb": ["zu zebra über zoo " * 2] * 4}
    docs = spark.createDataFrame([(i, t, lang) for lang, ts in texts.items() for i, t in enumerate(ts)], "doc_id long, text string, lang string")
    trees = language.fit(docs, F.lit(True), sample=1000)
    probes = ["banana zoo", "Über ana", "?!", "a" * 40, "z"]
    monkeypatch.setattr(language, "PIECE", 16)
    got = language.code_lengths([language._bytes(p) for p in probes], trees)
    assert trees.languages == ("aa", "bb")
    known = set("".join(sum(texts.values(), [])).lower().encode()) | {32}
    for j, lang in enumerate(trees.languages):
        counts3, followers = Counter(), [{} for _ in range(4)]
        for t in texts[lang]:
            raw = b"   " + t.lower().encode()
            for i in range(3, len(raw)):
                counts3[raw[i - 3 : i]] += 1
                for k in range(4):
                    followers[k].setdefault(raw[i - k : i], Counter())[raw[i]] += 1
        kept = {c for c, n in counts3.items() if n >= language.MIN_CONTEXT}
        for p, bits in zip(probes, got, strict=True):
            raw = b"   " + p.lower().encode()
            want = -sum(math.log2(chance_plain(raw, i, followers, kept, known)) for i in range(3, len(raw)))
            assert math.isclose(bits[j], want, rel_tol=1e-4, abs_tol=1e-3), (lang, p)


def test_language_odd_inputs(spark):
    rows = [(1, "der hund und die katze " * 5, "de"), (2, "the dog and the cat " * 5, "en"), (3, None, "en"), (4, "12 34 !?", "en"), (5, "the", None), (5, "the", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    trees = language.fit(docs, F.lit(True))
    out = sorted(((r["doc_id"], r["lang_pred"], r["score"]) for r in language.predict(docs, trees).collect()))
    assert [o[:2] for o in out] == [(1, "de"), (2, "en"), (3, "und"), (4, "und"), (5, "en"), (5, "en")]
    assert out[2][2] == 0 and out[0][2] > 0.99 and np.isfinite([o[2] for o in out]).all()
    none = language.fit(docs.where("false"), F.lit(True))
    assert {r["lang_pred"] for r in language.predict(docs, none).collect()} == {"und"}
    assert language.predict(docs.where("false"), trees).count() == 0


def test_copies_do_not_outweigh_other_texts(spark):
    """A text in most rows of a large language counts like each other text of it."""
    others = [f"lorem ipsum number {i} dolor sit" for i in range(60)]
    copied, schema = "zebra quartz vivid " * 3, "doc_id long, text string, lang string"
    make = lambda n: spark.createDataFrame([(i, t, "la") for i, t in enumerate(others + [copied] * n)], schema)
    once, often = (language.fit(make(n), F.lit(True), sample=100) for n in (1, 500))
    probes = [language._bytes(t) for t in (copied, others[3])]
    assert np.array_equal(language.code_lengths(probes, once), language.code_lengths(probes, often))
