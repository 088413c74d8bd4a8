import random

import pytest

from quillspark.llm import splitting as s

E = "doc_id long, chunk_index int, heading string, start_line int, end_line int, char_count int, text string, part int"
D = "doc_id long, text string, spans string"


def text_of(seed):
    r = random.Random(seed)
    out = []
    for k in range(200):
        out.append(r.choice(["", "## Heading", "```", " ".join("word" * r.randrange(1, 3) for _ in range(r.randrange(1, 40))) + ".", "x" * r.randrange(1, 900)]))
    return "\n".join(out)


@pytest.mark.parametrize("seed", range(20))
def test_pieces_lose_nothing(seed):
    t = text_of(seed)
    lines = s.Lines(t)
    whole = t + "\n"
    got = s.cut(lines, 3, 180, 1000, 100)
    a, b = lines.span(3, 180)
    assert got[0][0] == a and got[-1][1] == b
    for p, q in got:
        assert 0 < q - p <= 1000
    for (p, q), (x, y) in zip(got, got[1:]):
        assert p < x <= q and q - x <= 100 and y > q
    assert whole[a:b] == "".join(t_ + "\n" for t_ in t.split("\n")[2:180])


def test_cuts_at_boundaries():
    t = "\n\n".join(f"Paragraph {k} says something short." for k in range(100))
    for _, q in s.cut(s.Lines(t), 1, 500, 300, 50)[:-1]:
        assert t[q - 2 : q] == "\n\n"
    hard = s.cut(s.Lines("x" * 1000), 1, 1, 300, 20)
    assert hard[0] == (0, 300) and hard[1][0] == 280


@pytest.mark.parametrize("spans", [512, 2])
def test_entries(spark, monkeypatch, spans):
    monkeypatch.setattr(s, "SPANS", spans)
    long = "\n".join("a line of some words" for _ in range(1000))
    docs = spark.createDataFrame([(1, long, ""), (2, None, ""), (3, "", ""), (4, "x" * 6499, ""), (5, "x" * 6500, "")], D)
    rows = [(1, 0, "h", 1, 5000, 1, "", 0), (1, 0, "h", 1, 5000, 2, "", 0), (1, 1, None, 1, 10, None, "", 0), (1, 2, "h", 2000, 2100, 1, "", 0), (1, 3, "h", None, 5, 1, "", 0), (1, 4, "h", 9, 5, 1, "", 0),
            (2, 0, "h", 1, 9, 1, "", 0), (3, 0, "h", 1, 9, 1, "", 0), (4, 0, "h", 1, 1, 1, "", 0), (5, 0, "h", 0, 1, 1, "", 0), (9, 0, "h", 1, 2, 1, "", 0), (None, 0, "h", 1, 2, 1, "", 0)]
    entries = spark.createDataFrame(rows, E)
    got = s.split_entries(entries, docs).collect()
    n = {}
    for r in got:
        n[r.doc_id, r.chunk_index] = n.get((r.doc_id, r.chunk_index), 0) + 1
        assert len(r.text) == r.end_char - r.start_char <= s.LIMIT and r.piece < r.n_pieces
    assert n[4, 0] == 1 and n[5, 0] == 2 and n[1, 1] == 1 and n[3, 0] == 1 and set(n) == {(1, 0), (1, 1), (3, 0), (4, 0), (5, 0)}
    cut = {(r.doc_id, r.chunk_index) for r in s.split_entries(entries, docs, only_cut=True).collect()}
    assert cut == {(1, 0), (5, 0)}
    assert s.split_entries(entries.limit(0), docs).count() == 0


def test_code_is_cut_at_its_lines():
    t = "```cpp\n" + "\n".join(f"auto variable_{k:04d} = compute({k}, {k + 1});" for k in range(400)) + "\n```\nAfter it."
    got = s.cut(s.Lines(t), 1, 1000, 1000, 100)
    assert len(got) > 10 and all(t[q - 1] == "\n" and t[p - 1] == "\n" for p, q in got[1:-1])


def test_line_ends_come_before_sentences_and_words():
    t = "\n".join("some words. and more words here" for _ in range(60))
    assert all(t[q - 1] == "\n" for _, q in s.cut(s.Lines(t), 1, 60, 500, 50)[:-1])
    assert all(t[q - 2] in ". " or t[q - 1] in ". " for _, q in s.cut(s.Lines(" ".join(t.split("\n"))), 1, 1, 500, 50)[:-1])


@pytest.mark.parametrize("limit", [0, 2000])
def test_beyond_the_broadcast_limit(spark, limit):
    docs = spark.createDataFrame([(n, text_of(n), "") for n in range(30)] + [(31, None, "")], D)
    rows = [(n, k, f"h{k}", a, b, None, "", 0) for n in range(32) for k, (a, b) in enumerate([(1, 9), (1, 60), (10, 400), (190, 500), (300, 400)])]
    entries = spark.createDataFrame(rows, E)
    for only in (True, False):
        few = {tuple(r) for r in s.split_entries(entries, docs, 3000, 100, only).collect()}
        far = s.split_entries(entries, docs, 3000, 100, only, broadcast_limit=limit)
        assert {tuple(r) for r in far.collect()} == few and few
    assert any(r[7] > 1 for r in few) and any(r[7] == 1 for r in few)
