"""Metrics and adaptive verdicts against plain Python."""

import re
from collections import Counter

from ledgerlark.llm import quality_rules as qr

WS = re.compile(r"[\x20\x09-\x0D]+")


def metrics(text):
    text = text or ""
    words = [w for w in WS.split(text) if w]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + j for i in range(len(words) - 2) for j in range(3) if windows[tuple(words[i : i + 3])] > 1}
    lines = [x for x in text.split("\n") if WS.sub("", x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_text_lines": len(lines), "n_repeat_words": len(covered),
    }


def base_failed(m):
    return m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"]


def units(m):
    part = lambda a, b, k: min(qr.TOP, k * m[a] // m[b]) if m[b] else 0
    return {
        "symbols": part("n_symbols", "word_chars", 1000), "dup_lines": part("n_dup_lines", "n_text_lines", 1000),
        "repeats": part("n_repeat_words", "n_words", 1000), "word_len": part("word_chars", "n_words", 100),
    }


def verdicts(rows):
    """Kept or not for rows (doc_id, text, lang, source, ...)."""
    found = [metrics(r[1]) for r in rows]
    good = [(r[2], r[3], units(m)) for r, m in zip(rows, found, strict=True) if not base_failed(m)]

    def at(values, p):
        values = sorted(values)
        return next(v for i, v in enumerate(values, 1) if 100 * i >= p * len(values))

    out = []
    for r, m in zip(rows, found, strict=True):
        own = [u for lang, source, u in good if (lang, source) == (r[2], r[3])]
        if own and len(own) < qr.MIN_GROUP:
            own = [u for lang, _, u in good if lang == r[2]]
            if len(own) < qr.MIN_GROUP:
                own = [u for _, _, u in good]
        ok = not base_failed(m)
        for k, slack in qr.UPPER.items():
            values = [u[k] for u in own]
            ok = ok and units(m)[k] <= at(values, 50) + qr.SPREAD * (at(values, 50) - at(values, 10)) + slack
        for k, slack in qr.LOWER.items():
            values = [u[k] for u in own]
            ok = ok and units(m)[k] >= at(values, 50) - qr.SPREAD * (at(values, 90) - at(values, 50)) - slack
        out.append(ok)
    return out


def test_metrics_and_verdicts(spark):
    plain = "one two three four five six seven eight nine ten " * 3
    texts = [
        None, "", " \n\t ", "a", "a b", "a b a b a b", "x\n\nx\n x\nx", plain, "the cat sat. the cat sat. the cat ran", "é ü 😀 #tag $5 <b>|", "w " * 400,
        "\n".join(["same line here"] * 30), " ".join(f"w{i}" for i in range(120)), "\x0bv\x0cf\rr", " ".join(f"w{i % 70}" for i in range(100)),
    ]
    long = [" ".join(f"word{(i * k) % 997}" for i in range(80)) for k in range(1, 130)]
    junk = ["### " + " ".join(f"a{i}$$$" for i in range(90)), " | ".join(f"z{i}" for i in range(90)), " ".join("q" * 60 + str(i) for i in range(60))]
    rows = [(i, t, [None, "en"][i % 2], ["a", None, "b"][i % 3], "x") for i, t in enumerate(texts + long + junk)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept string")
    out = qr.apply_rules(docs, ["doc_id"]).collect()
    want = verdicts(rows)
    assert len(out) == len(rows)
    for r in out:
        m = metrics(rows[r["doc_id"]][1])
        assert {k: r[k] for k in m} == m
        assert r["base_failed"] == base_failed(m) and r["kept"] == want[r["doc_id"]], rows[r["doc_id"]]
    assert not any(want[-3:]) and all(want[len(texts) : -3])


def test_missing_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert qr.apply_rules(docs, ["doc_id"]).first()["base_failed"]
    assert qr.apply_rules(docs.where("false"), ["doc_id"]).count() == 0
    plan = qr.apply_rules(docs, ["doc_id"])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_long_words_are_judged_in_full(spark):
    """Beyond TOP a value still counts: blobs fail among long words, and groups of longer words adapt."""
    text = lambda size: " ".join(f"{i:03d}" + "x" * (size - 3) for i in range(60))
    rows = [(i, text(60 if i < 10 else 80 if i < 48 else 120), "a") for i in range(60)] + [(60, text(5000), "a")]
    rows += [(100 + i, text(300 + i % 3), "b") for i in range(60)] + [(160, text(5000), "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = qr.apply_rules(docs, ["doc_id"]).collect()
    assert not any(r["base_failed"] for r in out)
    assert {r["doc_id"] for r in out if not r["kept"]} == {60, 160}


def test_buckets_are_exact_then_fine(spark):
    values = [0, 1, 8191, 19_999, qr.TOP, qr.TOP + 1, 32_767, 32_768, 1_000_003, 2**31 + 12_345, 2**39 + 1]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for v, b in df.select("v", qr._bucket(df["v"])).collect():
        assert b == v if v <= qr.TOP else v - v / qr.FINE < b <= v
