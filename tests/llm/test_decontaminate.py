"""Contamination search against brute force over all windows."""

import random
import re
from collections import Counter

import xxhash

from ledgerlark.llm import decontaminate as dc


def words(text):
    return [w for w in re.findall(r"[^\W_]+", (text or "").lower())]


def simhash(ws):
    hs = [xxhash.xxh64(w.encode(), seed=42).intdigest() for w in ws]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def shingles(ws):
    return Counter(tuple(ws[i : i + 5]) for i in range(len(ws) - 4))


def windows(ws, w):
    size = min(w, len(ws))
    return [(i, ws[i : i + size]) for i in range(len(ws) - size + 1)]


def alike(a, b):
    a, b = shingles(a), shingles(b)
    top = sum((a | b).values())
    return sum((a & b).values()) / top if top else 0.0


def brute(docs, items):
    out = {}
    for d, text in docs:
        for i, item in items:
            iw = words(item)
            if len(iw) < 5:
                continue
            for at, win in windows(words(text), len(iw)):
                s = alike(win, iw)
                if s >= 0.8 and (near := (simhash(win) ^ simhash(iw)).bit_count()) <= dc.RADIUS and s > out.get((d, i), (0, -1.0))[1]:
                    out[d, i] = (at, s, near)
    return {(d, i, *v) for (d, i), v in out.items()}


def test_rows_equal_brute_force(spark):
    rng = random.Random(11)
    vocab = [f"wort{i}" for i in range(60)] + ["the", "of", "é"] * 8
    some = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, some(n)) for i, n in enumerate([5, 8, 15, 15, 30, 30, 60, 120, 4])] + [(9, ["a", "b"] * 12)]
    docs = []
    for k in range(120):
        body = some(rng.randrange(0, 80))
        i, item = items[k % len(items)]
        copy = list(item)
        for _ in range(k % 4):
            at = rng.randrange(len(copy))
            copy[at : at + rng.randrange(2)] = some(rng.randrange(2))
        text = " ".join(body) + (" - " if k % 3 else "\n") + (", ".join(copy).upper() if k % 5 == 0 else " ".join(copy)) + " " + " ".join(some(rng.randrange(40)))
        docs.append((k, text))
    docs += [(500, " ".join(items[6][1][: 55])), (501, None), (502, ""), (503, " ".join(some(400)))]
    texts = [(i, " ".join(w)) for i, w in items] + [(20, None), (21, "")]
    found = dc.find_contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(texts, "item_id long, text string"))
    got = {tuple(r)[:5] for r in found.collect()}
    want = brute(docs, texts)
    assert {(g[0], g[1]) for g in got} == {(w[0], w[1]) for w in want}
    close = {(g[0], g[1]): g for g in got}
    for d, i, at, s, near in want:
        mine = close[d, i]
        assert abs(mine[3] - s) < 1e-9  # the best window lies at an alignment
        assert mine[2] != at or mine[4] == near
    exact = [(d, i, at, s) for d, i, at, s, _ in want if s == 1.0]
    assert exact and {(d, i, at, s) for d, i, at, s, _ in got if s == 1.0} == set(exact)


def test_removal_keeps_columns_and_clean_rows(spark):
    item = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame(
        [(1, f"before {item} after", 5), (1, f"before {item} after", 5), (2, "clean text of some more words", 6), (None, None, 7), (3, item.upper() + "!", 8)],
        "doc_id long, text string, fp int",
    )
    bench = spark.createDataFrame([(7, item), (7, item), (8, None)], "item_id long, text string")
    left = dc.remove_contaminated(docs, bench)
    assert left.columns == ["doc_id", "text", "fp"]
    assert sorted(r["fp"] for r in left.collect()) == [6, 7]
    assert dc.remove_contaminated(docs, bench.where("false")).count() == 5
    assert dc.find_contamination(docs.where("false"), bench).count() == 0
    plan = dc.find_contamination(docs, bench)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_blocks_find_every_fingerprint_within_the_radius(spark):
    rng = random.Random(8)
    fps, pairs = [rng.getrandbits(64) for _ in range(6)], []
    for k, fp in enumerate(fps):
        for distance in (0, 1, dc.RADIUS - 1, dc.RADIUS, dc.RADIUS, dc.RADIUS, dc.RADIUS + 6):
            flips = sum(1 << b for b in rng.sample(range(64), distance))
            pairs.append((k, fp ^ flips, distance))
        spread = sum(1 << 16 * block + b for block in range(4) for b in range(5))  # five bits in every block: out of reach
        pairs.append((k, fp ^ spread, 20))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    left = dc._blocks(spark.createDataFrame([(n, k, signed(x), d) for n, (k, x, d) in enumerate(pairs)], "n int, k int, fp long, d int"))
    right = dc._neighbours(dc._blocks(spark.createDataFrame([(k, signed(x)) for k, x in enumerate(fps)], "k int, fp long"))).drop("fp")
    assert right.count() == 6 * 4 * 2517
    found = {r["n"] for r in left.join(right, ["k", "block", "value"]).select("n").collect()}
    within = {n for n, (_, _, d) in enumerate(pairs) if d <= dc.RADIUS}
    assert within <= found and not found & {n for n, (_, _, d) in enumerate(pairs) if d == 20}


def edited(rng, item, k):
    """A copy with new words at one end, or scattered deletions and insertions, as far as five-word shingles allow at 0.8."""
    cut = rng.randrange(0, max(1, (len(item) - 4) // 9 + 1))
    new = [f"n{k}u{j}" for j in range(cut)]
    return new + item[cut:] if k % 2 else item[: len(item) - cut] + new


def test_recall_without_a_bound_on_the_distance(spark):
    """All windows of similarity 0.8 and more by brute force, per size and number of different words of the item."""
    rng = random.Random(4)
    kinds = {f"{w} words": [f"v{i}" for i in range(w)] for w in (5, 15, 40, 59, 100, 200)} | {"40 words, 12 different": [f"x{i % 12}" for i in range(40)]}
    items = [(n * 10 + r, [f"{x}r{r}" for x in ws], kind) for n, (kind, ws) in enumerate(kinds.items()) for r in range(4)]
    docs = []
    for k in range(25 * len(items)):
        item = items[k % len(items)][1]
        docs.append((k, " ".join([f"p{k}", *edited(rng, item, k // len(items)), f"q{k}"])))
    texts = [(i, " ".join(w)) for i, w, _ in items]
    found = dc.find_contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(texts, "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    counts = {kind: [0, 0] for kind in kinds}
    for d, text in docs:
        i, item, kind = items[d % len(items)]
        if any(alike(win, item) >= 0.8 for _, win in windows(words(text), len(item))):
            counts[kind][0] += 1
            counts[kind][1] += (d, i) in got
    assert sum(n for n, _ in counts.values()) > 500
    print({kind: hit / n for kind, (n, hit) in counts.items()})
    assert all(hit >= 0.9 * n for n, hit in counts.values()), counts
