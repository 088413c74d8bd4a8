import pytest

from quillspark.operators.packed_fields import AUTHORS, GROUPS, split_packed

SCHEMA = "scrape_id long, authors string, target_group string, value string"

CASES = [
    ("A Foo; B Bar ;; C Baz;", ["A Foo", "B Bar", "C Baz"]),
    ("Foo, Jane", ["Foo, Jane"]),
    ("Foo, J. K.\nB Bar", ["Foo, J. K.", "B Bar"]),
    ("Jane Foo, Jr., Bob Bar", ["Jane Foo, Jr.", "Bob Bar"]),
    ("Acme Works, Inc.<br/>B Bar", ["Acme Works, Inc.", "B Bar"]),
    ('"Foo, Jane", "Bar and Partners", C Baz', ["Foo, Jane", "Bar and Partners", "C Baz"]),
    ('"Joe ""Jo"" Foo" / B Bar', ['Joe "Jo" Foo', "B Bar"]),
    ('Joe "Jo" Foo, B Bar', ['Joe "Jo" Foo', "B Bar"]),
    ("“Foo, Jane” & B Bar", ["Foo, Jane", "B Bar"]),
    ('["A Foo", "Ren\\u00e9e \\"R\\" Bar"]', ["A Foo", 'Renée "R" Bar']),
    ("['A Foo', \"B O'Bar\"]", ["A Foo", "B O'Bar"]),
    ("A Foo (X, Y), B Bar <b@c.d>, and C Baz", ["A Foo (X, Y)", "B Bar <b@c.d>", "C Baz"]),
    ('"A Foo', ['"A Foo']),
    ("A Foo, A Foo", ["A Foo", "A Foo"]),
    ("", []), (None, []), (" ", []), (", ;", []),
]

GROUP_CASES = [
    ("LEWG LWG", ["LEWG", "LWG"]), ("SG1 Concurrency", ["SG1 Concurrency"]), ("EWG/LWG + SG6", ["EWG", "LWG", "SG6"]),
    ("Library (LWG), LEWG: Library Evolution and CWG", ["Library (LWG)", "LEWG: Library Evolution", "CWG"]),
    ('"LWG Library / Incubator";CWG', ["LWG Library / Incubator", "CWG"]),
]


@pytest.mark.parametrize("limit", [1 << 25, 0])
def test_values(spark, limit):
    rows = [(i, a, None, "x") for i, (a, _) in enumerate(CASES)] + [(100 + i, None, g, None) for i, (g, _) in enumerate(GROUP_CASES)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = split_packed(df, "scrape_id", [AUTHORS, GROUPS], broadcast_limit=limit).orderBy("scrape_id", "pos").collect()
    by = {}
    for r in got:
        by.setdefault(r.scrape_id, []).append(r.value)
        assert r.pos == len(by[r.scrape_id])
    for i, (text, want) in enumerate(CASES):
        assert by.get(i, []) == want, text
    for i, (text, want) in enumerate(GROUP_CASES):
        assert by.get(100 + i, []) == want, text


def test_long_and_empty(spark):
    many = "; ".join(f"A{i} Foo" for i in range(3000))
    got = split_packed(spark.createDataFrame([(1, many, None, None)], SCHEMA), "scrape_id", [AUTHORS])
    assert got.count() == 3000
    assert split_packed(spark.createDataFrame([], SCHEMA), "scrape_id", [AUTHORS, GROUPS]).count() == 0
