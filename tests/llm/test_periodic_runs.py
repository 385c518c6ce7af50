"""Runs and collapsed texts against their definition, tried for every period."""

import hashlib
import random
import zlib
from fractions import Fraction

import pytest

from ledgerlark.llm import periodic_runs as pr
from ledgerlark.llm import queries

SPACE = " \t\n\x0b\x0c\r"


def split(text):
    for c in SPACE:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute_runs(w):
    """Every maximal stretch with equal words q apart, smallest q first; a stretch inside one of a smaller period has that period."""
    found = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q) and not any(s <= i and s + n >= i + length for s, n, p in found if p < q):
                found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def random_words(rng):
    letters, out = rng.choice([1, 2, 2, 3, 5]), []
    for _ in range(rng.randrange(8)):
        if rng.random() < 0.4:
            out += [rng.randrange(letters) for _ in range(rng.randrange(30))]
        else:
            root = [rng.randrange(letters) for _ in range(rng.randrange(1, rng.choice([3, 10, 40])))]
            if rng.random() < 0.3:
                root = root * rng.randrange(1, 5) + root[:1]
            out += root * rng.randrange(1, 9) + root[: rng.randrange(len(root) + 1)]
    return [b"%d" % x for x in out]


@pytest.mark.parametrize("portion", [1, 7, 64, 1 << 16])
def test_runs_equal_the_definition(monkeypatch, portion):
    monkeypatch.setattr(pr, "PORTION", portion)
    rng = random.Random(portion)
    for _ in range(40 if portion == 1 else 250):
        texts = [random_words(rng) for _ in range(rng.randrange(1, 4))]
        assert pr.runs_of(texts) == [brute_runs(t) for t in texts]


def test_runs_inside_the_period_of_a_longer_run_are_reported():
    root = b"x a a a a a a a b".split()
    found = pr.runs_of([root * 6])[0]
    assert found == brute_runs(root * 6) and (0, 54, 9) in found and sum(p == 1 for _, _, p in found) == 6


def test_collisions_of_hashes_are_seen(monkeypatch):
    monkeypatch.setattr(pr, "mix", lambda x: x * 0)
    words = random.Random(3).choices([b"a", b"b"], k=200) + [b"a", b"b"] * 5
    assert all(w[0] + w[1] <= len(words) for w in pr.runs_of([words])[0])
    for start, length, p in pr.runs_of([words])[0]:
        assert words[start : start + length - p] == words[start + p : start + length]


@pytest.mark.parametrize("words,want", [([b"a"] * 300_000, [(0, 300_000, 1)]), ([b"%d" % (i % 999) for i in range(300_000)], [(0, 300_000, 999)])])
def test_very_long_repetitive_texts(words, want):
    assert pr.runs_of([words])[0] == want


def test_long_text_of_all_runs():
    a, b = [b"0"], [b"0", b"1"]
    while len(b) < 3000:
        a, b = b, b + a
    assert pr.runs_of([b])[0] == brute_runs(b)


TEXTS = [None, "", " \n\t ", "one", "a a a a a", "a a a a a a", "a b " * 4, "a b " * 3 + "a", "x\x0by\x0cx y x y x y z", "a a a a " * 4,
         "A a " * 9, "p q r " * 4 + "p q " * 7, "\x1c \x1c \x1c \x1c \x1c \x1c"]


def check(row, words):
    runs = brute_runs(words)
    drop = {i for s, n, p in runs for i in range(s + p, s + n)}
    assert [tuple(r) for r in row["runs"]] == runs and row["n_words"] == len(words)
    assert row["collapsed"] == " ".join(w for i, w in enumerate(words) if i not in drop)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    assert (row["strongest"] and tuple(row["strongest"])) == best


def test_odd_rows(spark):
    rows = [(i, t, i, "x") for i, t in enumerate(TEXTS)] + [(None, TEXTS[5], 0, "x"), (5, TEXTS[5], 0, "x"), (5, TEXTS[5], 0, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int, n_words string")  # clashing columns
    out = pr.find_runs(docs).collect()
    assert len(out) == len(rows) and sum(r["doc_id"] is None for r in out) == 1
    for r in out:
        check(r, split(TEXTS[5 if r["doc_id"] is None else r["doc_id"]] or ""))
    assert pr.find_runs(docs.where("false")).count() == 0


def test_query_on_planted_texts(spark):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in queries.op13_dyadic_runs(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert set(got) == {d["doc_id"] for d in docs}
    planted = 0
    for d in docs:
        words = split(d["text"] or "")
        n, h = len(words), zlib.crc32(str(d["doc_id"]).encode())
        g = h // 10
        if h % 10 == 0 and n:
            planted += 1
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if n > 3000:
            continue  # the brute force takes too long
        runs, row = brute_runs(words), got[d["doc_id"]]
        drop = {i for s, m, p in runs for i in range(s + p, s + m)}
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(runs), *best)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert row["runs_sha256"] == sha("".join(f"{s},{m},{p}\n" for s, m, p in runs))
        assert row["collapsed_sha256"] == sha(" ".join(w for i, w in enumerate(words) if i not in drop))
    assert planted
