import json

import pytest
from pyspark.sql import functions as F

from quillspark.functions import blocks as b
from quillspark.operators import facts as fa
from quillspark.operators import grids as g
from quillspark.operators.containment import quote_lines


@pytest.mark.parametrize("lines,want", [
    (["Ann Lee <ann@x.org>", "Bo Ray", "bo (at) y (dot) org", "Cy"], ["Ann Lee <ann@x.org>", "Bo Ray <bo@y.org>", "Cy"]),
    (["Ann", "Bo", "bo@x.org", "", "c@x.org"], ["Ann", "Bo <bo@x.org>", "<c@x.org>"]),
    (["Dee, dee at z dot co dot uk"], ["Dee <dee@z.co.uk>"]), ([], []), (["Audience: LWG", "Ann"], ["Ann"]),
])
def test_author_lines(lines, want):
    assert b.author_lines(lines, lambda s: s.startswith("Audience:")) == want


def test_step_prompts():
    body = "- **Model:** Small (fast)\n- **Tools:** read, , grep\n- **Max-Output:** 200\n- **Colour:** red\n```\n- **Model:** none\n```\n### System Prompt\nBe brief.\n\n### Notes\nNo."
    s = b.step_prompt("3. Read", body)
    assert (s["number"], s["model"], s["tools"], s["max_output"], s["extra"], s["system"], s["mode"]) == (3, "small", ["read", "grep"], 200, {"colour": "red"}, "Be brief.", "append")
    assert b.step_prompt("Step 4", "")["model"] == "default"
    for name, text in (("Intro", ""), ("1. A", "- **System prompt:** replace"), ("1. A", "- **System prompt:** merge")):
        with pytest.raises(ValueError):
            b.step_prompt(name, text)


def test_block_kinds(spark):
    cases = [("$ git pull\n$ make", "shell"), ("#!/bin/sh\nx", "shell"), ("list ::= item", "grammar"), ('{"a": 1}', "json"), ("+----+\n| a |", "diagram"), ("int a[] = {1};", "code"), ("", "code")]
    df = spark.createDataFrame([(t,) for t, _ in cases], "t string")
    assert [r[0] for r in df.select(b.block_kind(F.col("t"))).collect()] == [k for _, k in cases]
    q = spark.createDataFrame([("a\n> one\n>  two\nb\n> three",), ("none",), (None,)], "t string").select(b.quoted_blocks(F.col("t")).alias("q")).collect()
    assert [r.q for r in q] == [["one two", "three"], [], None]


MD = "# T\n\nThe *quick* brown fox. Then the lazy dog.\n\n$a + b$\n\n| k | v |\n|---|---|\n| x | 1 |\n| y | 2 |\n"
FACTS = [
    ({"type": "present", "text": "quick brown"}, True), ({"type": "present", "text": "quick brawn"}, False), ({"type": "present", "text": "quick brawn", "max_diffs": 1}, True),
    ({"type": "absent", "text": "slow"}, True), ({"type": "absent", "text": "lazy dog"}, False), ({"type": "math", "text": "$a+b$"}, True), ({"type": "math", "text": "a-b"}, False),
    ({"type": "order", "sequence": ["fox", "dog"]}, True), ({"type": "order", "sequence": ["dog", "fox"]}, False), ({"type": "order", "sequence": ["fox", "cat"]}, False),
    ({"type": "table", "cell": "x", "neighbors": {"right": "1", "down": "y", "heading": "k", "up": "k"}}, True), ({"type": "table", "cell": "x", "neighbors": {"left": "1"}}, False),
    ({"type": "table", "cell": "x", "neighbors": {"right": "3"}}, False), ({"type": "table", "cell": "zz"}, False),
]


def test_facts(spark):
    records = [{"id": f"f{k}", "checked": k % 2 == 0, **f} for k, (f, _) in enumerate(FACTS)]
    got = [fa.failure(MD, fa.parse_fact(json.dumps(r))) == "" for r in records]
    assert got == [ok for _, ok in FACTS]
    docs = spark.createDataFrame([(1, MD, "x"), (2, None, "x"), (3, "", "x")], "id int, text string, fact string")
    facts = spark.createDataFrame([(i, json.dumps(r)) for i in (1, 2) for r in records] + [(3, json.dumps({"id": "z", "type": "present", "text": "a"}))], "id int, record string")
    checks = fa.check_facts(docs, "id", "text", facts, "record")
    gate = {r.id: tuple(r) for r in fa.fact_gate(checks, "id").collect()}
    assert gate[1][1:3] == (14, 7) and gate[1][3] == sum(not ok for k, (_, ok) in enumerate(FACTS) if k % 2 == 0) and gate[3][4]
    for bad in ('{"id": 1, "type": "odd"}', '{"id": 1, "type": "present"}', '{"id": 1, "type": "order", "sequence": ["a"]}'):
        with pytest.raises(ValueError):
            fa.parse_fact(bad)


def test_grids(spark):
    assert g.sanity_flags([]) == ["empty"] and g.sanity_flags([["a", "b"], ["c", "d"], ["e", "f"]]) == []
    assert "toc-like" in g.sanity_flags([["Intro", "1"], ["Body", "5"], ["End", "9"]]) and "bullet-list" in g.sanity_flags([["• a", "b"], ["• c", "d"]])
    assert "numbered-list" in g.sanity_flags([["1.1", "a"], ["1.2", "b"]]) and "reference-list" in g.sanity_flags([["[A]", "a"], ["[B]", "b"]])
    assert "sparse-columns" in g.sanity_flags([["h", "i", "j"], ["a", "", ""], ["b", "", ""], ["c", "", "x"]]) and "ascii-art" in g.sanity_flags([["+---+", "+---+"], ["a", "b"]])
    assert "constant-first-column" in g.sanity_flags([["k", "a"], ["k", "b"], ["k", "c"], ["k", "d"]]) and "single-cell-rows" in g.sanity_flags([["h", "i"], ["a", ""], ["b", ""]])
    grid = lambda t, rows: [(t, r, c, x) for r, row in enumerate(rows) for c, x in enumerate(row)]
    prose = "one two three four five six seven eight nine ten eleven twelve thirteen"
    tables = {
        "spec": [["Expression", "Return type", "Note"], ["a", "b", "c"]], "ballot": [["[ES-047]", "a"], ["[FI-071]", "b"], ["[SE]", "c"]], "bib": [["[CodeQL]", "a"], ["[P2900R14]", "b"]],
        "kv": [["Name", prose], ["Kind", "x"]], "prose": [["a much longer key of five words", prose], ["b", None]], "matrix": [["a", "b"], ["c", "d"]], "none": [["", None], ["a", ""]],
    }
    df = spark.createDataFrame([x for t, rows in tables.items() for x in grid(t, rows)], "t string, r int, c int, text string")
    got = {r.t: r.kind for r in g.table_kinds(df, "t").collect()}
    assert got == {"spec": "spec_table", "ballot": "ballot", "bib": "bibliography", "kv": "key_value", "prose": "prose", "matrix": "matrix", "none": "false_positive"}
    flags = {(r.t, r.flag) for r in g.flagged_tables(df, "t").collect()}
    assert ("bib", "reference-list") in flags and not any(t == "matrix" for t, _ in flags)
    assert g.table_kinds(df.limit(0), "t").count() == 0


def test_quotes(spark):
    docs = spark.createDataFrame([(1, "x\nThe  quick brown fox jumps\nover it. Short one."), (2, None), (3, ""), (4, "see the quick brown fox jumps over it now")], "d int, t string")
    quotes = spark.createDataFrame([("a", "quick brown fox jumps over it"), ("b", "short one"), ("c", ""), ("d", None), ("e", "ick brown fox jumps over it no")], "q string, s string")
    got = {tuple(r) for r in quote_lines(docs, "d", "t", quotes, "q", "s").collect()}
    assert got == {("a", 1, 2, 2), ("b", 1, 3, 1), ("a", 4, 1, 1), ("e", 4, 1, 1)}
