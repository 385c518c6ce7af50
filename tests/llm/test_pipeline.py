"""The pipeline against a plain Python version of its stages, on a small table."""

import collections
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from test_decontaminate import brute as leaks
from test_near_dups import brute as components
from test_quality_rules import verdicts


@pytest.fixture(scope="module")
def table(tmp_path_factory, spark):
    rng = random.Random(3)
    vocab = [f"{a}{b}" for a in ("ver", "lin", "so", "tra", "mo") for b in ("ta", "ne", "kul", "ist", "o", "en")]
    say = lambda n: [rng.choice(vocab) + str(rng.randrange(40)) for _ in range(n)]
    items = [" ".join(say(25)) for _ in range(4)]
    rows = []
    for i in range(160):
        body = say(rng.randrange(20, 140))
        text = "\n".join(" ".join(body[k : k + 15]) for k in range(0, len(body), 15))
        if i % 4 == 0:
            text = "Read our terms first.\n" + text + "\n  READ our terms FIRST. "
        if i % 10 == 3:
            text += "\n" + items[i % 4]
        if i % 12 == 5:
            text = "### $$$ " * 60 + text
        rows.append((i, text, ["en", "de"][i % 2], f"s{i % 3}", len(text)))
    for i in range(160, 190):
        text = rows[i - 160][1] + (" one more word" if i % 2 else "")
        rows.append((i, text, "en", "s0", len(text)))
    rows += [(200, None, None, None, None), (201, "", "en", "s1", 0), (202, "just words " * 2500, "de", "s2", 27500)]
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, list(enumerate(items))


def expected_stages(rows, items):
    kept = [r for r, ok in zip(rows, verdicts(rows), strict=True) if ok]
    yield {r[0] for r in kept}, {r[0]: r[1] for r in kept}
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    seen = collections.Counter(k for r in kept for k in {key(x) for x in (r[1] or "").split("\n")})
    kept = [(r[0], "\n".join(x for x in (r[1] or "").split("\n") if not (key(x) and seen[key(x)] >= 10))) for r in kept]
    yield {r[0] for r in kept}, dict(kept)
    low = {d: c for d, _, c in components(kept)}
    kept = [r for r in kept if low[r[0]] == r[0]]
    yield {r[0] for r in kept}, dict(kept)
    dirty = {x[0] for x in leaks(kept, items)}
    kept = [r for r in kept if r[0] not in dirty]
    yield {r[0] for r in kept}, dict(kept)


def test_stages_and_packing(spark, table):
    folder, rows, items = table
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for (name, stage), (ids, texts) in zip(corpus_pipeline.STAGES[:4], expected_stages(rows, items), strict=True):
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        got = docs.collect()
        assert {r["doc_id"]: r["text"] for r in got} == texts, name
        assert len(got) == len(ids) and all(r["n_chars"] == len(r["text"]) for r in got)
        docs = spark.createDataFrame(got, docs.schema)
    assert len(ids) < len(rows) - 40
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in texts.items()}
    pieces = corpus_pipeline.run(spark, folder).collect()
    got = collections.Counter()
    bins = collections.defaultdict(list)
    for p in pieces:
        got[p["doc_id"]] += p["length"]
        bins[p["sequence_id"]].append((p["offset"], p["length"]))
    assert dict(got) == want
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1]] and sum(n for _, n in parts) <= 2048
    assert len(bins) <= -(-sum(want.values()) // 2048) + 1


def test_clashing_columns_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(80))
    docs = spark.createDataFrame(
        [(i, f"{text} {i}" if i else None, None, "s", 1, "mine", 7, 8, 9) for i in range(3)],
        "doc_id long, text string, lang string, source string, n_chars long, kept string, n_words int, n_lines int, node int",
    )
    bench = "/root/testdata/sf0.001"
    for rows in (docs, docs.where("false")):
        now = rows
        for _, stage in corpus_pipeline.STAGES[:4]:
            now = stage(spark, now, bench)
            assert now.columns == docs.columns
        assert {(r["kept"], r["n_words"], r["n_lines"], r["node"]) for r in now.collect()} <= {("mine", 7, 8, 9)}
        assert corpus_pipeline.STAGES[4][1](spark, now, bench).count() == now.count()
    assert now.count() == 0


def test_oracle_is_left_out():
    assert corpus_pipeline.ORACLE_SQL is None and [s[0] for s in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "jaccard_join", "decontamination", "packing",
    ]
