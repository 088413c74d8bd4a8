from pyspark.sql import functions as F

from quillspark.functions import text as x


def values(spark, f, inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r.o for r in df.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


def test_dates(spark):
    given = ["2020-1-2", "2020/11/30", "March 5, 2021", "5 march 2021", "2020-13-01", "1899-01-01", "soon", "", None, " 2020-02-31 "]
    assert values(spark, x.normal_date, given) == ["2020-01-02", "2020-11-30", "2021-03-05", "2021-03-05", None, None, None, None, None, "2020-02-31"]


def test_references(spark):
    assert values(spark, x.paper_ids, ["see P1234R5, p1 and [N4321](P9999R9) P1234R5 P12R1", "", None]) == [["P1234R5", "N4321"], [], None]
    assert values(spark, x.loose_ids, ["P1234 and D12345R0"]) == [["P1234", "D12345R0"]]
    assert values(spark, x.urls, ["at https://a.b/c. and (http://d.e)!"]) == [["https://a.b/c", "http://d.e"]]
    assert values(spark, x.stable_labels, ["[a.b] [A.b] [x] [a.b]"]) == [["a.b"]]
    assert values(spark, x.latex_xrefs, ["\\ref{a.b, c.d} and \\iref{a.b}"]) == [["a.b", "c.d"]]


def test_normalisers(spark):
    assert values(spark, x.near_exact, ["a \r\nb\n\n\n", "", None]) == ["a\nb\n", "\n", None]
    assert values(spark, x.coverage_text, ["Some hyphen-\nated self-\naware “Text”�!", None]) == ["some hyphenated self aware text", None]
    assert values(spark, x.plain_email, ["me at host dot org", "a (at) b (dot) c", "x.y@z.org", "none", None]) == ["me@host.org", "a@b.c", "x.y@z.org", None, None]
    assert values(spark, x.entities, ["aé\U0001f600", "", None]) == ["a&#233;&#128512;", "", None]
    assert values(spark, x.toc_entry, ["1.2 Title ........ 7", "A. Other", None]) == ["title", "other", None]
    assert values(spark, x.code_language, ["C++", "rust", None]) == ["cpp", "rust", None]
    assert values(spark, x.expand_macros, ["\\tcode{a\\_b} of \\Cpp{} in \\ref{x.y} ``q''"]) == ['a_b of C++ in [x.y] "q"']


def test_classes(spark):
    assert values(spark, x.line_kind, ["P1234R0", "2020-01", "12,5", "---", "int x;", "two words", "a1 b2 c", "", None]) == ["id", "date", "num", "mark", "code", "word", "mixed", "mixed", "mixed"]
    assert values(spark, x.normative_force, ["the behavior is undefined", "it shall be", "text", "\\begin{note} shall", None])[:4] == ["undefined", "requirement", "normative", "note"]
    assert values(spark, x.query_intent, ["[a.b]", "is there a x", "grammar of y", "find z"]) == ["label", "exist", "grammar", "search"]
    assert values(spark, lambda c: x.has_phrase(c, "LEWG"), ["a lewg b", "lewgi", None]) == [True, False, None]


def test_hashes_are_stable(spark):
    import hashlib

    want = int.from_bytes(hashlib.sha256(b"a:7").digest()[:8], "big")
    assert values(spark, lambda c: x.stable_key(c, F.lit(7)), ["a"]) == [want]
