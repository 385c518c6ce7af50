"""The Jaccard join against brute force over exact shingle sets."""

import random

import numpy as np
import pytest

from ledgerlark.llm import near_dups
from ledgerlark.llm.hashing import shingle_set, word_hashes

WS = " \t\n\x0b\x0c\r"


def exact_set(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    for c in WS[1:]:
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    """doc_id -> (n_shingles, component_id)"""
    sets = [exact_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return {(d, len(sets[i]), (d if not sets[i] else low[root(i)])) for i, (d, _) in enumerate(rows) if d is not None}


def edited(words, n, rng):
    out = list(words)
    for _ in range(n):
        at = rng.randrange(len(out))
        kind = rng.random()
        if kind < 0.5:
            out[at] = f"new{rng.random()}"
        elif kind < 0.75 and len(out) > 2:
            del out[at]
        else:
            out.insert(at, f"ins{rng.random()}")
    return out


def sample(seed):
    rng = random.Random(seed)
    texts = []
    for size in (3, 4, 5, 6, 8, 12, 13, 20, 40, 60, 63, 68, 80, 100, 130, 150, 200, 300, 640):
        base = [f"w{rng.randrange(400)}" for _ in range(size)]
        texts.append(" ".join(base))
        for edits in (0, 1, 1, 2, 3, size // 40 + 1, size // 30 + 1, size // 25 + 2):
            texts.append(" \n".join(edited(base, edits, rng)).upper() if edits % 2 else "\t".join(edited(base, edits, rng)))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, make_docs, seed):
    texts = sample(seed) + ["", None, " \n ", "a b", "a  b", "A B", "Ünï çödé", "ünï çödé"]
    got = {tuple(r) for r in near_dups.near_duplicates(make_docs(texts)).collect()}
    assert got == brute(list(enumerate(texts)))


def test_small_chunks_give_the_same(spark, make_docs, monkeypatch):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    texts = [" ".join(edited(base, rng.randrange(0, 7), rng)) for _ in range(90)]
    monkeypatch.setattr(near_dups, "CHUNK_DOCS", 12)
    monkeypatch.setattr(near_dups, "ANCHORS", 1)
    got = {tuple(r) for r in near_dups.near_duplicates(make_docs(texts)).collect()}
    assert got == brute(list(enumerate(texts)))


def test_hot_keys_are_salted_and_lose_no_link(spark, make_docs, monkeypatch):
    """A passage in every third text: its blocks are hot; links and components stay as brute force has them."""
    rng = random.Random(6)
    passage = [f"p{i}" for i in range(12)]
    texts = []
    for i in range(120):
        own = [f"w{i}x{j}" for j in range(rng.choice((15, 30, 90)))]
        texts.append(" ".join(own + passage if i % 3 == 0 else own))
    texts += [" ".join(passage + [f"e{i}"]) for i in range(30)] + texts[:20]
    docs = make_docs(texts)
    want = brute(list(enumerate(texts)))
    listed = []
    keep = near_dups.hot_keys
    monkeypatch.setattr(near_dups, "hot_keys", lambda counted: listed.append(keep(counted)) or listed[-1])
    for most in (500_000, 3):
        monkeypatch.setattr(near_dups, "HOT_KEY", 5)
        monkeypatch.setattr(near_dups, "MAX_HOT_KEYS", most)
        monkeypatch.setattr(near_dups, "SALTS", 4)
        assert {tuple(r) for r in near_dups.near_duplicates(docs).collect()} == want
        assert len(listed[-1].collect()) <= most
    assert listed[0].count() > 0


def test_hot_keys_are_few_and_counted(spark, monkeypatch):
    counted = spark.createDataFrame([(1, 150), (1, 60), (2, 200), (3, 900), (4, 2)], "key long, hits long")
    assert sorted(map(tuple, near_dups.hot_keys(counted).collect())) == [(1, 210), (3, 900)]
    monkeypatch.setattr(near_dups, "MAX_HOT_KEYS", 2)
    assert [tuple(r) for r in near_dups.hot_keys(counted).collect()] == [(3, 900)]
    assert near_dups.hot_keys(counted.where("key > 9")).count() == 0


def test_tasks_count_blocks_in_portions(monkeypatch):
    """Whatever the portion, a key counts once for each set that shows it in a portion, and rows come through unchanged."""
    import pyarrow as pa

    text = " ".join(f"w{i}" for i in range(30))
    texts = [f"{text} end{i}" for i in range(40)] + [text, text, "", None, "a b"]
    n = len(texts)
    ids = pa.array(range(n), pa.int64())
    rb = pa.RecordBatch.from_arrays([pa.array(texts), ids, ids, ids], names=["text", "doc_id", "_rk1", "_rk2"])
    for portion, least in ((10**6, 41), (200, 5)):
        monkeypatch.setattr(near_dups, "TALLY", portion)
        out = pa.Table.from_batches(list(near_dups._sizes(iter([rb.slice(i, 5) for i in range(0, n, 5)])))).to_pylist()
        rows = [r for r in out if r["hits"] is None]
        assert [r["doc_id"] for r in rows] == list(range(n)) and [r["n"] for r in rows[-5:]] == [26, 26, 0, 0, 1]
        hits = [r["hits"] for r in out if r["hits"] is not None]
        assert hits and min(hits) >= 2 and max(hits) >= least


def test_repeated_rows_null_ids_and_extra_columns(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(7, long, 1), (7, long, 2), (None, long, 3), (3, long + " x", 4), (9, "other words entirely here now", 5), (None, None, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node int")
    got = sorted(map(tuple, near_dups.near_duplicates(docs).collect()), key=repr)
    assert got == sorted([(7, 56, 3), (7, 56, 3), (None, 56, None), (3, 57, 3), (9, 1, 9), (None, 0, None)], key=repr)
    kept = near_dups.keep_one(docs)
    assert kept.columns == ["doc_id", "text", "node"]
    assert sorted((r["node"] for r in kept.collect())) == [4, 5, 6]
    once = spark.createDataFrame([(1, long, 8), (1, long, 2), (5, long, 1)], "doc_id long, text string, node int")
    assert [tuple(r) for r in near_dups.keep_one(once).select("doc_id", "node").collect()] == [(1, 2)]


def test_keep_one_judges_texts_that_share_an_id_one_by_one(spark):
    long, other = (" ".join(f"{c}{i}" for i in range(60)) for c in "wv")
    rows = [(2, long, 1), (5, long + " x", 2), (5, other, 3), (None, other + " y", 4), (None, other + " y", 5), (None, "", 6), (8, None, 7), (8, None, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _rk1 int")
    assert sorted(r["_rk1"] for r in near_dups.keep_one(docs).collect()) == [1, 3, 6, 7, 8]
    only = docs.where("doc_id IS NULL AND text != ''")
    assert [r["_rk1"] for r in near_dups.keep_one(only).collect()] == [4]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_dups.near_duplicates(docs).count() == 0
    assert near_dups.keep_one(docs).count() == 0


def test_word_hashes_do_not_depend_on_grouping(monkeypatch):
    texts = [b"One two  three", b"", b"x" * 3000 + b" tail words", b"two THREE one", "é ü\tß".encode()]
    alone = [next(iter(word_hashes([t])))[1] for t in texts]
    monkeypatch.setattr("ledgerlark.llm.hashing.CHUNK", 16)
    for i, words in word_hashes(texts):
        assert np.array_equal(words, alone[i])
    assert np.array_equal(np.sort(alone[0]), np.sort(alone[3]))


def test_block_guarantee():
    """Sets within the distance share at least ``need`` of the chosen blocks in the larger set's band."""
    rng = np.random.default_rng(3)
    for n in (10, 30, 63, 64, 90, 127, 128, 500, 2000):
        for _ in range(20):
            a = np.unique(rng.integers(0, 2**64 - 1, n, dtype=np.uint64))
            swaps = len(a) // 9
            b = np.unique(np.concatenate([a[swaps:], rng.integers(0, 2**64 - 1, swaps, dtype=np.uint64)]))
            b = b if near_dups.similar(near_dups._common(a, b), len(a), len(b)) else a
            band = near_dups.band_of(max(len(a), len(b)))
            pick = lambda s: [(k, abs(need)) for k, need in near_dups.elements(s) if (need > 0) == (near_dups.band_of(len(s)) == band)][0]  # noqa: E731, B023
            (ka, na), (kb, nb) = pick(a), pick(b)
            assert len(np.intersect1d(ka, kb)) >= max(1, min(na, nb))


def test_shingles_of_short_texts():
    get = lambda t: shingle_set(next(iter(word_hashes([t])))[1])
    assert len(get(b"a b c d")) == 1 and not np.array_equal(get(b"a b c d"), get(b"a b c"))
    assert not np.array_equal(get(b"a b"), get(b"b a"))


def test_contained_sets_at_the_threshold():
    """need never exceeds what sets of different size are sure to share, in each band where both are."""
    at = lambda n: {b for b in (near_dups.band_of(n), near_dups.band_of(n) + 1) if b == near_dups.band_of(n) or n * 5 // 4 >= near_dups._band_top(b - 1)}
    for n in [*range(4, 700), 1000, 1279, 1280, 2047, 2048]:
        for m in {n, -(-4 * n // 5), n - n // 7, n - 1} & {m for m in range(4, n + 1) if 5 * m >= 4 * n}:
            band = near_dups.band_of(n)
            assert band in at(m)
            d = (n + m) // 9
            sure = -(-(n + m - d) // 2) if band == 0 else min(near_dups._length(n, band), near_dups._length(m, band)) - d
            assert 1 <= near_dups._need(n, band) <= sure and 1 <= near_dups._need(m, band) <= sure, (n, m)


def test_need_of_a_set_that_holds_a_smaller_one():
    """100 shingles and 80 of them: 10 shared blocks are guaranteed, so 12 must not be asked for."""
    rng = np.random.default_rng(8)
    assert next(near_dups.elements(np.unique(rng.integers(0, 2**64 - 1, 100, dtype=np.uint64))))[1] <= 10
    for n in (65, 100, 125, 150, 200, 500):
        for _ in range(20):
            a = np.unique(rng.integers(0, 2**64 - 1, n, dtype=np.uint64))
            b = np.sort(rng.permutation(a)[: -(-4 * n // 5)])
            band = near_dups.band_of(n)
            (ka, na), (kb, nb) = near_dups.blocks(a, band), near_dups.blocks(b, band)
            assert len(np.intersect1d(ka, kb)) >= max(na, nb)
            assert max(na, nb) <= max(1, min(near_dups._length(n, band), near_dups._length(len(b), band)) - (n + len(b)) // 9)


def test_sets_with_few_filled_blocks_show_empty_ones():
    """All shingles in a few blocks: the list is as long as promised, and similar sets still share what is needed."""
    rng = np.random.default_rng(4)
    for n in (70, 120, 200, 600):
        band = near_dups.band_of(n)
        for fill in (4, 16, 64):
            a = np.unique(rng.integers(0, 2**64 // fill, n, dtype=np.uint64))
            b = np.sort(rng.permutation(a)[: -(-4 * len(a) // 5)])
            (ka, na), (kb, nb) = near_dups.blocks(a, band), near_dups.blocks(b, band)
            assert len(set(ka.tolist())) == near_dups._length(len(a), band) and len(kb) == near_dups._length(len(b), band)
            assert len(np.intersect1d(ka, kb)) >= max(na, nb)
