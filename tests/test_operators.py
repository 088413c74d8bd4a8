"""Small fixtures for operators whose queries run on whole tables elsewhere."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quillspark.operators import measures as m
from quillspark.operators import segments as g
from quillspark.operators import sequence as s
from quillspark.operators import simulate
from quillspark.operators import tables as t
from quillspark.operators.containment import maximal_strings
from quillspark.operators.graph import connected_components


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_upsert_keeps_what_is_set(spark):
    store = spark.createDataFrame([(1, "a", "x"), (2, "b", ""), (3, "c", None)], "k int, v string, intent string")
    feed = spark.createDataFrame([(1, "A", "new"), (2, "B", "new"), (4, "D", "new")], "k int, v string, intent string")
    assert rows(t.upsert(store, feed, "k", ["v"], ["intent"]), "k") == [(1, "A", "x"), (2, "B", "new"), (3, "c", None), (4, "D", "new")]
    assert rows(t.insert_or_ignore(store, feed, "k"), "k")[-1] == (4, "D", "new") and t.insert_or_replace(store, feed, "k").count() == 4


def test_revisions_are_numbers(spark):
    df = spark.createDataFrame([("P1R2",), ("p1r10",), ("P1R9",), ("N5",), ("",), (None,)], "id string")
    assert rows(t.latest_revision(df, "id"), "base") == [("N5", "N5", 1), ("P1", "P1R10", 3)]
    refs = spark.createDataFrame([("P1R9",), ("P1",), ("N5R1",), ("P7",)], "r string")
    assert rows(t.resolve_references(refs, "r", df, "id"), "ref") == [("N5R1", "base", "N5"), ("P1", "latest", "P1R10"), ("P1R9", "exact", "P1R9"), ("P7", "none", None)]


def test_range_join_meets_every_bucket(spark):
    pts = spark.createDataFrame([("a", i) for i in range(100)], "g string, x int")
    rng = spark.createDataFrame([("a", 5, 70, 1), ("a", 68, 68, 2), ("b", 0, 99, 3)], "g string, lo int, hi int, id int")
    got = t.range_join(pts, rng, "g", "x", "lo", "hi", 10)
    assert got.count() == 67 and got.distinct().count() == 67


def test_snapshot_diff_treats_nulls_as_equal(spark):
    a = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "k int, v string")
    b = spark.createDataFrame([(1, None), (2, "z"), (4, "y")], "k int, v string")
    assert [r[1] for r in rows(t.snapshot_diff(a, b, "k", "v"), "k")] == ["same", "changed", "missing", "new"]


def test_maximal_strings_as_brute_force(spark):
    import random

    r = random.Random(2)
    words = ["".join(r.choice("ab") for _ in range(r.randrange(0, 14))) for _ in range(120)]
    got = {x[0] for x in maximal_strings(spark.createDataFrame([(w,) for w in [*words, None]], "s string"), "s").collect()}
    assert got == {w for w in words if w == "" or not any(w != v and w in v for v in words)}


def test_maximal_strings_send_no_parts_of_the_strings_to_all(spark, tmp_path):
    # the grams of these take tens of MB, though their table's file is small
    words = [f"{'on ' if i % 3 else ''}{i % 97} headers for {i * 7919 % 100_003:06d} ranges of {i}" for i in range(10_000)]
    words += [w[3:-2] for w in words[:50]] + [w[-5:] for w in words[60:90]]
    spark.createDataFrame([(w,) for w in words], "s string").write.parquet(str(tmp_path / "w"))
    df = spark.read.parquet(str(tmp_path / "w"))
    conf, before = "spark.sql.maxBroadcastTableSize", spark.conf.get("spark.sql.maxBroadcastTableSize", None)
    spark.conf.set(conf, "24m")  # a broadcast of a few rows takes 16 MB here
    try:
        got = [x[0] for x in maximal_strings(df, "s").collect()]
    finally:
        spark.conf.unset(conf) if before is None else spark.conf.set(conf, before)
    have = set(words)
    held = {p for w in have for i in range(len(w)) for j in range(i + 1, len(w) + 1) if (p := w[i:j]) != w and p in have}
    assert len(got) == len(set(got)) and set(got) == have - held


@pytest.mark.parametrize("limit", [0, 32 << 20])
def test_maximal_strings_by_either_plan(spark, limit):
    words = ["abcdefgh", "xabcdefgh", "abcdefghi", "é日", "日", "a", "", "aa", "hij 日é", "lone", "lonely text", "ly", "text lonely"]
    got = [x[0] for x in maximal_strings(spark.createDataFrame([(w,) for w in [*words, "a", None]], "s string"), "s", limit).collect()]
    assert sorted(got) == sorted(w for w in words if w == "" or not any(w != v and w in v for v in words))


def test_components(spark):
    import random

    r = random.Random(4)
    edges = [(r.randrange(80), r.randrange(80)) for _ in range(50)] + [(200 + i, 201 + i) for i in range(60)] + [(7, 7), (None, 1)]
    got = dict(connected_components(spark.createDataFrame(edges, "src int, dst int")).collect())
    up = {}
    find = lambda x: x if up.setdefault(x, x) == x else find(up[x])
    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            up[y] = x
    assert got == {x: min(y for y in up if find(y) == find(x)) for x in up}
    assert connected_components(spark.createDataFrame([], "src int, dst int")).count() == 0


def test_sequence_operators(spark):
    df = spark.createDataFrame([("d", i, v) for i, v in enumerate(["h", None, "x", None, None])], "d string, p int, v string")
    assert [r[-1] for r in rows(s.carry_forward(df, ["d"], ["p"], "v", "o", "none"), "p")] == ["h", "h", "x", "x", "x"]
    iv = spark.createDataFrame([("d", 1, 3), ("d", 2, 2), ("d", 4, 6), ("d", 9, 9)], "d string, a int, b int")
    assert rows(s.merge_intervals(iv, ["d"], "a", "b"), "a") == [("d", 1, 3, 2), ("d", 4, 6, 1), ("d", 9, 9, 1)]
    assert rows(s.merge_intervals(iv, ["d"], "a", "b", gap=1), "a") == [("d", 1, 6, 3), ("d", 9, 9, 1)]
    parts = spark.createDataFrame([("u", "a", 5), ("u", "b", 3), ("u", "c", 2), ("v", "a", 1)], "g string, p string, n long")
    assert [r[-1] for r in rows(s.largest_remainder(parts, ["g"], "p", "n", 4), "g", "p")] == [2, 1, 1, 1]
    pk = spark.createDataFrame([("d", i, n) for i, n in enumerate([3, 4, 9, 1, 1])], "d string, i int, n int")
    assert [r[-1] for r in rows(s.greedy_pack(pk, ["d"], ["i"], "n", 7), "i")] == [0, 0, 1, 2, 2]
    out = spark.createDataFrame([("d", i, dep, f"k{i}") for i, dep in enumerate([0, 1, 1, 2, 0, 1])], "d string, i int, depth int, k string")
    assert [r[2:] for r in rows(s.number_outline(out, "d", "i", "depth", "k"), "i")] == [("1", None), ("1.1", "k0"), ("1.2", "k0"), ("1.2.1", "k2"), ("2", None), ("2.1", "k4")]
    ids = s.global_ids(spark.range(1000).repartition(7), [F.desc("id")])
    assert [r.gid for r in ids.orderBy(F.desc("id")).collect()] == list(range(1, 1001))
    run = s.running_totals(spark.range(100).repartition(5), ["id"], {"before": "id"})
    assert all(r.before == r.id * (r.id - 1) // 2 for r in run.collect())
    flags = spark.createDataFrame([("d", i, f) for i, f in enumerate([True, True, False, True, False, False, False, True])], "d string, i int, f boolean")
    assert rows(s.runs(flags, ["d"], ["i"], "f", least=2, bridge=1), "first") == [("d", 1, 4, 3)]


def test_guard(spark):
    b = spark.createDataFrame([("same", 0.5), ("worse", 0.5), ("gone", 0.5), ("null", None), ("edge", 0.51), ("floor", 0.31)], "k string, x double")
    c = spark.createDataFrame([("same", 0.5), ("worse", 0.4), ("null", 0.1), ("new", 0.9), ("low", 0.1), ("nan", float("nan")), ("edge", 0.49), ("floor", 0.295)], "k string, x double")
    got = dict(m.guard_status(b, c, "k", ["x"], 0.02, {"x": 0.3}).collect())
    assert got == {"same": "ok", "worse": "regressed", "gone": "vanished", "null": "ok", "new": "new", "low": "new_below_floor", "nan": "invalid", "edge": "ok", "floor": "crossed_floor"}


def test_recall_both_ways(spark):
    refs = spark.createDataFrame([(1, "a b b"), (2, "C d"), (3, ""), (4, None)], "r int, t string")
    hyps = spark.createDataFrame([(10, "b b b a"), (11, "c"), (12, "zz"), (13, None)], "h long, x string")
    a, b = (rows(m.multiset_recall(refs, "r", "t", hyps, "h", "x", limit=most), "r", "h") for most in (1 << 20, 0))
    assert a == b == [(1, 10, 3, 1.0), (2, 11, 1, 0.5)]
    a, b = (rows(m.multiset_recall(refs, "r", "t", hyps.union(hyps.selectExpr("h + 100", "x || ' d'")), "h", "x", best=True, limit=most), "r", "h") for most in (1 << 20, 0))
    assert a == b == [(1, 10, 3, 1.0), (2, 111, 2, 1.0)]
    assert rows(m.multiset_recall(refs, "r", "t", hyps, "h", "x", least=0.6), "r", "h") == [(1, 10, 3, 1.0)]


def test_pairs_of_a_row(spark):
    df = spark.createDataFrame([(1, "a b b", "b b c"), (2, None, "x"), (3, "", None), (4, "é É", "é")], "k int, a string, b string")
    assert rows(m.pairwise_coverage(df, "k", "a", "b"), "k") == [(1, 2 / 3, 1 / 3), (2, 1.0, 1.0), (3, 1.0, 0.0), (4, 0.5, 0.0)]
    assert rows(m.char_conservation(df, "k", "a", "b"), "k") == [(1, 1, 1), (2, 0, 1), (3, 0, 0), (4, 1, 0)]


def test_calibration(spark):
    df = spark.createDataFrame([(float(v), v < 4) for v in range(10)], "v double, bad boolean")
    best = m.operating_point(m.roc_curve(df, "v", "bad")).first()
    assert best.threshold == 4.0 and best.tpr == 1.0 and best.fpr == 0.0
    assert m.roc_curve(df, "v", "bad").count() == 11


def test_markdown_parts():
    md = "---\ntitle: \"A: b\"\naudience:\n  - LWG\n---\n# T\n\nText one.\n\n```cpp\n# no\n\nint x;\n```\n\n| a | b |\n|---|---|\n| 1 | x\\|y |\n\n## S\n- i\n- j\n---\nlost\n## R\nkept"
    fields, body = g.front_matter(md)
    assert fields == {"title": "A: b", "audience": "LWG"} and g.format_front_matter(fields) == '---\ntitle: "A: b"\naudience: LWG\n---'
    assert g.headings(body) == ([1, 2, 2], ["T", "S", "R"]) and g.pipe_tables(body) == [[["a", "b"], ["1", "x|y"]]]
    assert g.sections(body) == [("S", 15, "- i\n- j"), ("R", 20, "kept")] and g.code_blocks(body)[0][1:] == ("cpp", "# no\n\nint x;")
    assert [b["kind"] for b in g.blocks(body)] == ["heading", "paragraph", "code", "table", "heading", "list", "paragraph", "heading", "paragraph"]
    assert g.spanned_grid([[("a", 2, 1), ("b", 1, 2)], [("c", 1, 1)]]) == [["a", "b", "b"], ["a", "c", ""]]
    lines = body.count("\n") + 1
    c = g.chunks(body, 60)
    assert c[0]["start_line"] == 1 and c[-1]["end_line"] == lines and all(a["end_line"] + 1 == b["start_line"] for a, b in zip(c, c[1:]))


def test_thread_rules(spark):
    c = spark.createDataFrame([("t", "a", None, 0), ("t", "b", "a", 1), ("t", "c", "b", 3), ("t", "d", "zz", 1), ("t", "e", None, 2), ("t", "b2", "a", 1), ("t", "b2", "a", 1)], "t string, s string, p string, d int")
    assert {(r[1], r[2]) for r in simulate.thread_violations(c, "t", "s", "p", "d").collect()} == {("c", "wrong_depth"), ("d", "no_parent"), ("e", "deep_root"), ("b2", "repeated_slot")}


def test_casting_respects_caps(spark):
    slots = spark.createDataFrame([("t", i, "x") for i in range(6)], "t string, i int, d string")
    people = pd.DataFrame([("p", "x"), ("q", "x"), ("r", "y")], columns=["person", "domain"])
    got = [r.person for r in simulate.cast_roles(slots, people, "t", "i", "d", cap=2).orderBy("i").collect()]
    assert sorted(got[:4]) == ["p", "p", "q", "q"] and got[4:] == ["r", "r"]


@pytest.mark.parametrize("name", ["years_count", "latest_revision_numeric", "citation_edges", "merge_intervals", "carry_forward", "roc_curve"])
def test_queries_on_the_smallest_tables(spark, name):
    import __spark_entry__

    assert __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001").count() >= 0
