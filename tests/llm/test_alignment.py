"""Groups, links and counts against a plain reading of the definition, with the tokenizers' own encoders."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerlark.llm import alignment as al

TEXTS = [
    None, "", " ", "  ", "\n", "The cat sat on the mat.", "aba aba abab", "naïve café — “quoted” text… 12½", "日本語のテキスト 漢字", "😀😀👩‍👩‍👧 emoji",
    "under▁score is lost", "<|endoftext|> and <s> </s> <unk>", "tabs\tand\r\nlines\n\n\nmore   spaces ", "x" * 700, "=" * 333 + " " * 77 + "-" * 90,
    "\x00\x01\x1c control \x7f", "don't we'll I'M it’s", "Привет, мир! Γειά σου", " nbsp em ls", "ﬁ ﷺ ligature", "ab" * 400 + "b", "a b c d e f g",
]


@pytest.fixture(scope="module")
def encoders():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = al.byte_alphabet()
    bytes_a = {i: bytes(letters.get(c, 63) for c in t) for t, i in a.get_vocab().items()}
    bytes_b = {}
    for i in range(b.get_piece_size()):
        p = b.id_to_piece(i)
        bytes_b[i] = bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
    return a, b, bytes_a, bytes_b


def brute(texts, encoders):
    a, b, bytes_a, bytes_b = encoders
    docs, count = [], Counter()
    for t in texts:
        ids_a, ids_b = (a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)) if t else ([], [])
        raw = (" " + (t or "")).encode()
        if b"".join(bytes_a[i] for i in ids_a) != raw or b"".join(bytes_b[i] for i in ids_b) != raw:
            ids_a, ids_b = [], []
        ends = [[], []]
        for out, ids, table in zip(ends, (ids_a, ids_b), (bytes_a, bytes_b), strict=True):
            at = 0
            for i in ids:
                at += len(table[i])
                out.append(at)
        groups, ga, gb = [], [], []
        common = sorted(set(ends[0]) & set(ends[1]))
        start = 0
        for end in common:
            ga = [i for i, e in zip(ids_a, ends[0], strict=True) if start < e <= end]
            gb = [i for i, e in zip(ids_b, ends[1], strict=True) if start < e <= end]
            groups.append((ga, gb))
            start = end
        links = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        count.update(links.keys())
        docs.append((len(ids_a), len(ids_b), groups, links))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    rows = []
    for n_a, n_b, groups, links in docs:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append((
            n_a, n_b, len(groups), sum(links.values()), sum(n for p, n in links.items() if count[p] == best[p[0]]),
            sum(n * count[p] for p, n in links.items()), hashlib.sha256(text.encode()).hexdigest() if text else "", text,
        ))
    return rows, count, best


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]


@pytest.mark.parametrize("sent,wide", [(500_000, 4096), (3, 4096), (0, 1), (40, 3)])
def test_rows_equal_the_definition(spark, make_docs, encoders, monkeypatch, sent, wide):
    monkeypatch.setattr(al, "SENT_PAIRS", sent)
    for t in TEXTS:  # wide groups are formed inside tasks, so compare them here
        monkeypatch.setattr(al, "WIDE_GROUP", 4096)
        first = al.align_text(al.vocabularies(None, None), t)
        monkeypatch.setattr(al, "WIDE_GROUP", wide)
        second = al.align_text(al.vocabularies(None, None), t)
        assert (first is None) == (second is None)
        for c in al._LISTS if first else ():
            assert first[c].tolist() == second[c].tolist()
    texts = TEXTS + TEXTS[5:8] + ["The cat sat"] * 30
    rows, count, best = brute(texts, encoders)
    got, mapping = al.align(make_docs(texts), with_groups=True)
    assert {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in got.collect()} == dict(enumerate(rows))
    table = {(r["a"], r["b"]): (r["docs"], r["best"]) for r in mapping.table().collect()}
    assert table == {p: (n, n == best[p[0]]) for p, n in count.items()}
    assert mapping.pairs.count() < len(count)  # mapped pairs are not among the shuffled ones


def test_whole_table(spark, encoders):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pdf = docs.select("doc_id", "text").collect()
    rows, _, _ = brute([r["text"] for r in pdf], encoders)
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS[:-1]) for r in al.align(docs)[0].collect()}
    assert got == {d["doc_id"]: r[:-1] for d, r in zip(pdf, rows, strict=True)}


def test_both_encoders_of_a_agree_on_settled_characters():
    v = al.vocabularies(None, None)
    signs = [chr(c) for c in range(0x2070) if al.SETTLED.fullmatch(chr(c))]
    assert len(signs) > 700 and not al.SETTLED.fullmatch("語")
    for s in signs:
        for t in (s, f"a{s}b", f" {s} 1{s}{s} ", f"{s}\n{s}'s", f"  {s}"):
            assert v.fast_a.encode_ordinary(t) == v.exact_a.encode(t, add_special_tokens=False).ids, (hex(ord(s)), t)


def test_very_long_text_in_parts(monkeypatch):
    v = al.vocabularies(None, None)
    text = " ".join(t for t in TEXTS if t and "▁" not in t) * 3
    whole = v.encode(text)
    monkeypatch.setattr(al, "PART_CHARS", 10)
    parts = v.encode(text)
    assert len(list(v._parts(text))) > 20
    assert all((x == y).all() for x, y in zip(whole, parts, strict=True))


def test_odd_rows(spark):
    docs = spark.createDataFrame([(7, "a b", 1, 1), (7, "a b", 1, 1), (None, "a b", 1, 1), (None, None, 1, 1)], "doc_id long, text string, n_a int, row_id int")
    rows = sorted(((r["doc_id"] or 0, r["n_a"], r["count_sum"]) for r in al.align(docs)[0].collect()))
    assert rows == [(0, 0, 0), (0, 2, 6), (7, 2, 6), (7, 2, 6)]
    assert al.align(docs.where("false"))[0].count() == 0
