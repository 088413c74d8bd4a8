import pytest
from pyspark.sql import functions as F

from quillspark.operators import decisions as x
from quillspark.operators import worklists as k


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_worklists(spark):
    df = spark.createDataFrame([(1, 0, "a", "", None), (2, -3, "a", "b", "c"), (3, None, None, "b", "c"), (4, 2, "a", "b", "")], "id int, status int, one string, two string, three string")
    assert [r.id for r in k.pending(df, "status", 2).collect()] == [1]
    assert rows(df.select("id", k.failed_stage(F.col("status")).alias("s")), "id") == [(1, None), (2, 2), (3, None), (4, None)]
    arts = ["one", "two", "three"]
    assert [r[1] for r in rows(df.select("id", k.reached_stage(arts).alias("s")), "id")] == [1, 3, 0, 2]
    c = {r.id: (r.changed, r.one, r.two, r.three) for r in k.cleared(df, F.lit(1), arts).collect()}
    assert c[2] == (["two", "three"], "a", "", "") and c[3] == (["two", "three"], None, "", "") and c[1][0] == []
    kinds = spark.createDataFrame([(" ALL",), ("2024",), ("2024-02",), ("P1R2",), ("x",), (None,)], "t string").select(k.target_kind(F.col("t")).alias("k"))
    assert [r.k for r in kinds.collect()] == ["all", "year", "month", "paper", "error", "error"]
    assert k.swapped(df, df.limit(0), "id").count() == 4 and k.outside_vocabulary(df, "one", ["a"]).count() == 0


def test_overlap(spark):
    df = spark.createDataFrame([("The allocator of a list", "a list with the allocator"), ("", "x"), (None, None), ("the of", "x")], "a string, b string")
    j, n = x.word_overlap(F.col("a"), F.col("b"))
    assert [tuple(r) for r in df.select(j, n).collect()] == [(1.0, 2), (0.0, 0), (0.0, 0), (0.0, 0)]
    e = F.array().cast("array<string>")
    assert df.select(x.set_jaccard(e, e)).first()[0] == 0.0
    s = spark.createDataFrame([("minor", 0.7, 0.0, 0), ("minor", 0.1, 0.9, 9), ("significant", None, 0.3, 3), ("significant", None, 0.3, 2), ("cosmetic", 0.9, 1.0, 9)], "s string, c double, j double, n int")
    assert [r[0] for r in s.select(x.raised_severity(F.col("s"), F.col("c"), F.col("j"), F.col("n"))).collect()] == ["critical", "minor", "critical", "significant", "cosmetic"]


def test_verdicts(spark):
    f = spark.createDataFrame([("a", "critical", True, None), ("b", "minor", True, "x"), ("b", "significant", False, "y"), ("b", "minor", False, "y"), ("c", "minor", False, None)], "g string, s string, t boolean, c string")
    assert rows(x.verdicts(f, "g", "s", "t", "c"), "g") == [("a", "Undermined", "High", 1, None), ("b", "Weakened", "Medium", 3, "y"), ("c", "Sound", "High", 0, None)]
    v = spark.createDataFrame([(1, True), (1, False), (2, True), (9, True)], "id int, s boolean")
    out = x.cross_examined(spark.createDataFrame([(1,), (2,), (3,)], "id int"), v, "id", "s")
    assert rows(out.select("id", "outcome"), "id") == [(1, "killed"), (2, "survived"), (3, "unjudged")]
    assert x.verdicts(f.limit(0), "g", "s", "t", "c").count() == 0


def test_orders_and_merges(spark):
    h = spark.createDataFrame([("q", "a", 0.5), ("q", "a", 0.9), ("q", "b", 0.9), ("q", "c", 0.1)], "g string, i string, s double")
    assert rows(x.merged_hits(h, "g", "i", "s", 2), "place") == [("q", "a", 0.9, 1), ("q", "b", 0.9, 2)]
    b = spark.createDataFrame([("d", 1, 5), ("d", 2, 5), ("d", 3, 1)], "g string, o int, n int")
    assert rows(x.within_budgets(b, ["g"], ["o"], "n", {"s": 4, "m": 9, "l": 99}), "n") == [("d", "s", 0, 0), ("d", "m", 1, 5), ("d", "l", 3, 11)]
    t = spark.createDataFrame([("t", 1, "noise", None, 0), ("t", 2, "teaser", None, 0), ("t", 3, "signal", 1, 1), ("t", 4, "noise", 1, 0), ("t", 5, "signal", None, 0)], "t string, s int, r string, c int, n int")
    assert [r.s for r in x.generation_order(t, "t", "s", "r", "c", "n").orderBy("place").collect()] == [2, 4, 3, 5, 1]
    assert x.nearest_known({1: 2, 2: 3}, {3}, 1) == 3 and x.nearest_known({1: 2, 2: 1}, {3}, 1) is None and x.nearest_known({}, {3}, 1) is None
    c = spark.createDataFrame([(1, 1), (1, 2)], "c int, l int")
    d = spark.createDataFrame([(1, 1, True), (1, 3, False)], "c int, l int, y boolean")
    assert rows(x.decided_claims(c, d, "c", "l", "y"), "l") == [(1, 1, "supported"), (1, 2, "missing"), (1, 3, "hallucinated")]


@pytest.mark.parametrize("limit", [1 << 20, 1])
def test_all_against_a_stated_set(spark, limit):
    from quillspark.session import against

    a, b = spark.range(50), spark.createDataFrame([(f"q{i}",) for i in range(9)], "q string")
    assert against(a, b, limit).distinct().count() == 450
