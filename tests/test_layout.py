import pytest
from pyspark.sql import functions as F

from quillspark.convert import layout as y

LINE = "doc string, page int, line int, x0 double, y0 double, x1 double, y1 double, text string, size double, bold boolean, mono boolean"


def lines_of(spark, pages, mono=lambda t: t.startswith("    ")):
    rows = [("d", p, k, 10.0 + 6 * (len(t or "") - len((t or "").lstrip())), 14.0 * k, 10.0 + 6 * len(t or ""), 14.0 * k + 12, t, 18.0 if (t or "").startswith("#") else 10.0, (t or "").startswith("#"), mono(t or "")) for p, ts in enumerate(pages) for k, t in enumerate(ts)]
    return spark.createDataFrame(rows, LINE)


def test_runs_of_lines(spark):
    pages = [["# Head", "A paragraph of some words that is long", "and goes on here", "", "- one", "- two", "  - deep", "text", "    int a;", "", "    int b;", None, "This sentence goes"], ["on over the page."]]
    ln = lines_of(spark, pages)
    assert [tuple(r) for r in y.joined_across_pages(ln).collect()] == [("d", 0, "This sentence goes", "on over the page.")]
    assert [r.depth for r in y.list_items(ln).orderBy("line").collect()] == [0, 0, 1]
    texts = [r.text for r in y.paragraphs(ln).orderBy("paragraph").collect()]
    assert "A paragraph of some words that is long and goes on here" in texts and "- two" in texts
    assert [(r.first_line, r.lines) for r in y.code_runs(ln).collect()] == [(8, 2)]
    m = y.document_measures(ln).first()
    assert m.pitch == 14.0 and m.margin == 10.0 and m.hyphens == 0.0
    for f in (y.joined_across_pages, y.list_items, y.paragraphs, y.code_runs, y.document_measures, y.font_ranks, y.leaked_contents, y.row_like_runs):
        assert f(ln.limit(0)).count() == 0


def test_contents_and_fields(spark):
    ln = lines_of(spark, [["Document: P1R0", "**Date:** 2024-01-02", "P1 R0", "Scope ..... 1", "1 Terms   2", "Gone .... 3", "# 1 Scope", "P1R0", "# Terms"]])
    assert {r.line for r in y.leaked_contents(ln).collect()} == {3, 4}
    f = y.labelled_fields(ln)
    assert {(r.field, r.value) for r in f.collect()} == {("document", "P1R0"), ("date", "2024-01-02")}
    both = y.merged_fields(f, spark.createDataFrame([("d", "date", "x"), ("d", "title", "T"), ("d", "audience", "")], "doc string, field string, value string"))
    assert {(r.field, r.value) for r in both.collect()} == {("document", "P1R0"), ("date", "2024-01-02"), ("title", "T")}
    assert {r.line for r in y.without_echoes(ln, f).collect()} == {0, 1, 3, 4, 5, 6, 7, 8}


@pytest.mark.parametrize("code,want", [("1 int a;\n2   b;\n", "int a;\n  b;\n"), ("    a;  \n\n      b;", "a;\n\n  b;"), ("", ""), ("\tx\r\n\ty", "x\ny"), ("1 a\nb", "1 a\nb")])
def test_tidy_code(spark, code, want):
    assert spark.createDataFrame([(code,)], "c string").select(y.tidy_code(F.col("c"))).first()[0] == want


def test_boxes_and_words(spark):
    ch = spark.createDataFrame([("d", 0, 0, x, x + 5.0, c) for x, c in ((0.0, "a"), (6.0, "b"), (20.0, "c"), (26.0, " "), (30.0, "d"))], "doc string, page int, line int, x0 double, x1 double, ch string")
    assert [r.text for r in y.words_from_characters(ch, 3.0).orderBy("word").collect()] == ["ab", "c", "d"]
    head = [("d", 0, 0, k, 10.0 * k, 10.0 * k + 4, t) for k, t in enumerate(["SF", "F", "N", "A", "SA"])]
    votes = [("d", 0, 1, k, x, x + 2, v) for k, (x, v) in enumerate([(1.0, "5"), (11.0, "7"), (42.0, "1"), (20.0, "x")])]
    w = spark.createDataFrame(head + votes, "doc string, page int, line int, word int, x0 double, x1 double, text string")
    assert {(r.choice, r.votes) for r in y.poll_counts(w).collect()} == {("SF", 5), ("F", 7), ("SA", 1)}
    b = spark.createDataFrame([("d", 0, 1, 0.0, 0.0, 10.0, 10.0), ("d", 0, 2, 8.0, 0.0, 18.0, 10.0), ("d", 0, 3, 5.0, 5.0, 5.0, 5.0)], "doc string, page int, k int, x0 double, y0 double, x1 double, y1 double")
    o = spark.createDataFrame([("d", 0, 0.0, 0.0, 10.0, 10.0)], "doc string, page int, x0 double, y0 double, x1 double, y1 double")
    assert [r.k for r in y.covered_boxes(b, o, "k", 0.5).collect()] == [1]
    s = spark.createDataFrame([("d", 0, 0, 0, "wo", False), ("d", 0, 0, 1, "rd ", True), ("d", 0, 0, 2, "next", True)], "doc string, page int, line int, span int, text string, bold boolean")
    assert [r.snapped for r in y.snapped_style(s, "bold").orderBy("span").collect()] == [False, False, True]


def test_markdown_and_ratchet(spark):
    s = spark.createDataFrame([("d", 1, "heading", 2, "T", None), ("d", 2, "list", 1, "a", None), ("d", 3, "list", 2, "b", None), ("d", 4, "code", None, "x;", "cpp"), ("d", 5, "quote", None, "p\nq", None), ("d", 6, "paragraph", None, None, None)], "doc string, k int, kind string, level int, text string, language string")
    assert y.emitted_markdown(s, "doc", ["k"]).first().markdown == "## T\n\n- a\n  - b\n\n```cpp\nx;\n```\n\n> p\n> q\n\n"
    b, c = (spark.createDataFrame(r, "k string, x double") for r in ([("a", 0.5), ("b", 0.5)], [("a", 0.6), ("b", 0.4), ("n", 0.1)]))
    as_set = lambda df: {tuple(r) for r in df.collect()}
    assert as_set(y.ratchet(b, c, "k", ["x"])) == as_set(b)
    assert as_set(y.ratchet(b, c, "k", ["x"], forced=True)) == as_set(c)
    assert as_set(y.ratchet(b, c.where("k <> 'b'"), "k", ["x"])) == {("a", 0.6), ("b", 0.5), ("n", 0.1)}
