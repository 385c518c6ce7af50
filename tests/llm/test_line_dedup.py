"""Line dedup against plain Python, and the levels of runs."""

from collections import Counter

from ledgerlark.llm import line_dedup
from ledgerlark.llm.common import Scratch

WS = " \t\n\x0b\x0c\r"


def key(line):
    return line.strip(WS).translate({c: c + 32 for c in range(65, 91)})


def brute(texts, min_docs, min_chars):
    seen = Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")})
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or seen[key(x)] < min_docs]
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def test_equal_to_plain_python(spark, make_docs):
    texts = [None, "", "\n", " \n\t", "Hot line\nown", "x\r\nhot LINE  \nx", "É hot\né hot"]
    texts += [f"Hot line\nunique {i}\n{'almost' if i < 2 else 'rare ' + str(i)}" for i in range(8)]
    texts += ["hot line\n" * 300 + "end", "ΑΒ\nαβ", "hot line"]
    for min_docs, min_chars in ((3, 1), (2, 9), (1, 1)):
        got = line_dedup.dedup_lines(make_docs(texts), min_docs, min_chars, batches=3)
        rows = {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()}
        assert rows == dict(enumerate(brute(texts, min_docs, min_chars)))


def test_repeated_rows_clashing_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a\nb", 7, 1.5)] * 3 + [(None, "b", 8, None)], "doc_id long, text string, n_lines int, h1 double")
    rows = line_dedup.dedup_lines(docs, 4).collect()
    assert sorted((r["doc_id"] or 0, r["text"], r["n_lines"], r["n_dropped"], r["h1"] or 0) for r in rows) == [(0, "", 1, 1, 0)] + [(1, "a", 2, 1, 1.5)] * 3
    assert line_dedup.dedup_lines(docs.where("false")).count() == 0


def test_runs_are_compacted_and_counts_add_up(spark):
    runs = line_dedup.LineRuns(spark, Scratch(spark, "test"), fanout=2)
    batch = lambda *rows: spark.createDataFrame(list(rows), "h1 long, h2 long, n long")
    runs.add(batch((1, 1, 6), (2, 2, 1)), 5)
    assert [len(x) for x in runs.levels] == [1]
    runs.add(batch((1, 1, 9), (2, 2, 2), (3, 3, 1)), 5)  # (1, 1) is known as repeated and not added again
    assert [len(x) for x in runs.levels] == [0, 1]
    runs.add(batch((3, 3, 4)), 5)
    assert [len(x) for x in runs.levels] == [1, 1]
    assert sorted(map(tuple, runs.totals().collect())) == [(1, 1, 6), (2, 2, 3), (3, 3, 5)]
    runs.add(batch((4, 4, 1)), 5)
    assert [len(x) for x in runs.levels] == [0, 0, 1]
