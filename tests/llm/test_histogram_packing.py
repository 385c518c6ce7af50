"""Shortest-pack-first over counts against the same rule piece by piece, and an exact round trip."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerlark.llm import histogram_packing as hp

TEXTS = [None, "", " ", "\n\n", "It's  the END, isn't it?", "Ünḯ ΣΑΣ İstanbul", "<|endoftext|> x", "😀😀 #tag $5.00", "日本語 a  b"]


def one_by_one(lengths, capacity):
    """Each piece, longest first, to the pack with the most room if it fits, else to a new one."""
    packs = []
    for n in sorted(lengths, reverse=True):
        best = min(packs, key=sum, default=None)
        if best is None or sum(best) + n > capacity:
            packs.append(best := [])
        best.append(n)
    return packs


@pytest.mark.parametrize("seed", range(30))
def test_counts_equal_piece_by_piece(seed):
    rng = random.Random(seed)
    capacity = rng.choice([8, 64, 100])
    lengths = [rng.choice([rng.randint(1, capacity), rng.randint(1, max(1, capacity // 5)), capacity, capacity // 2]) for _ in range(rng.choice([1, 7, 300]))]
    patterns = hp.shortest_pack_first(Counter(lengths), capacity)
    assert len(patterns) <= 2 * capacity
    used, fills = Counter(), Counter()
    for packs, pattern in patterns:
        for n, side in pattern:
            used[n] += packs * side
        fills[sum(n * side for n, side in pattern)] += packs
    assert used == Counter(lengths)
    assert fills == Counter(sum(p) for p in one_by_one(lengths, capacity))


def test_large_counts_cost_nothing():
    counts = {n: 10**12 + n for n in range(1, 2049)}
    patterns = hp.shortest_pack_first(counts)
    total = sum(n * c for n, c in counts.items())
    assert sum(p for p, _ in patterns) * 2048 < total * 1.01


def test_long_pieces_are_cut_where_nothing_fits_beside_them():
    assert hp.piece_limit({1100: 1000}) < 2048 and hp.piece_limit({1100: 500, 900: 500, 40: 1000}) == 2048
    for counts in ({1100: 1000}, {1500: 10, 7: 3}):
        for limit in (1024, 512, 256):
            cut = hp.cut_shorter(counts, limit)
            assert sum(n * c for n, c in cut.items()) == sum(n * c for n, c in counts.items()) and max(cut) <= limit


def round_trip(packed, want, repeats=1):
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in packed.collect():
        assert r["length"] == len(r["ids"]) > 0 and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        assert r["doc_tokens"] == len(want[r["doc_id"]])
        pieces[r["doc_id"]].append((r["start"], r["ids"]))
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for d, ids in want.items():
        at = 0
        for start, part in sorted(pieces[d]):
            assert start == at and part == ids[at : at + len(part)]
            at += len(part)
        assert at == len(ids)
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1]] and sum(n for _, n in parts) <= 2048
    return bins


def test_round_trip(spark, make_docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = [*TEXTS, "word " * 50_000, *[f"text number {i} of many" for i in range(60)], *["same text"] * 900]
    want = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}
    packed = hp.pack(make_docs(texts), with_ids=True)
    bins = round_trip(packed, want)
    total = sum(map(len, want.values()))
    assert len(bins) == -(-total // 2048)
    row = hp.padding(packed).first()
    fill = [sum(n for _, n in b) for b in bins.values()]
    assert (row["sequences"], row["tokens"]) == (len(bins), total)
    assert row["padding"] == sum(2048 - f for f in fill if f & (f - 1))


def test_cut_at_half_the_capacity(spark, make_docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["word " * 1100] * 40
    want = {i: tokenizer.encode(t, add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}
    bins = round_trip(hp.pack(make_docs(texts), with_ids=True), want)
    assert len(bins) < 24  # 40 without cuts


def test_cells(spark, make_docs, monkeypatch):
    monkeypatch.setattr(hp, "CELL_ROWS", 7)
    packed = hp.pack(make_docs([f"word {'x ' * (i % 3)}" for i in range(500)]))
    rows = packed.collect()
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows) == 500


def test_repeated_rows_clashing_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b", 9, 1), (1, "a b", 9, 1), (None, None, 1, 1)], "doc_id long, text string, length int, rank int")
    rows = hp.pack(docs).collect()
    assert sorted((r["doc_id"] or 0, r["length"], r["offset"]) for r in rows) == [(0, 1, 6), (1, 3, 0), (1, 3, 3)]
    assert hp.pack(docs.where("false")).count() == 0
