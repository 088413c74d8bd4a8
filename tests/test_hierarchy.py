import random

import pytest

from quillspark.operators import hierarchy as h

SCHEMA = "draft string, label string, parent string, child string, scope string"


def brute(rows):
    key = lambda x: (x or "").lower().strip(" []\t\n")
    rows = [x for x in rows if x[0]]
    nodes = {(d, key(c)) for d, c, p in rows if key(c)}
    up = {}
    for d, c, p in rows:
        if key(c) and (d, key(p)) in nodes:
            up.setdefault((d, key(c)), set()).add(key(p))
    out = set()
    for d, c in nodes:
        seen, level, k = {}, {c}, 0
        while level:
            k += 1
            level = {p for x in level for p in up.get((d, x), ()) if p not in seen}
            seen.update(dict.fromkeys(level, k))
        out |= {(d, a, c, k) for a, k in seen.items()}
    return out


def random_rows(n, seed):
    r = random.Random(seed)
    rows = [("d", f"n{i}", f"n{r.randrange(max(1, i))}") for i in range(n)] + [("e", f" [N{i}]", f"n{i - 1} ") for i in range(40)]
    rows += [("d", "n3", f"n{n - 1}"), ("d", "n5", "n2"), ("d", "n5", "n2"), ("d", "x", "x"), ("d", None, "n1"), ("d", "y", None), ("d", "", "n1"), ("e", "z", "gone"), (None, "a", "b"), (None, "b", "")]
    return rows


@pytest.mark.parametrize("limit", [50_000, 10])
def test_ancestors(spark, limit):
    rows = random_rows(60, 1)
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)
    edges = h.links(df, "draft", "label", "parent")
    got = {tuple(r) for r in h.ancestor_pairs(edges, limit).collect()}
    assert got == brute([(d, c, p) for d, c, p in rows])


def test_nodes_same_both_ways(spark):
    df = spark.createDataFrame([(*r, "", "") for r in random_rows(50, 2)], SCHEMA)
    a = {tuple(r) for r in h.tree_nodes(df, "draft", "label", "parent").collect()}
    b = {tuple(r) for r in h.tree_nodes(df, "draft", "label", "parent", local_links=5).collect()}
    assert a == b
    by = {(r[0], r[1]): r for r in a}
    assert by["e", "n3"][2:5] == ("n0", 3, "n0/n1/n2/n3") and by["e", "n0"][5] == 39
    assert by["d", "x"][2] is None and by["d", "x"][6] and by["d", "y"][2:5] == ("y", 0, "y")


def test_nodes_with_several_parents_same_both_ways(spark):
    r = random.Random(5)
    rows = [("f", f"n{i}", f"n{p}") for i in range(1, 60) for p in {r.randrange(i) for _ in range(3)}] + [("f", "n0", None)]
    df = spark.createDataFrame([(*x, "", "") for x in rows], SCHEMA)
    a = {tuple(x) for x in h.tree_nodes(df, "draft", "label", "parent").collect()}
    b = {tuple(x) for x in h.tree_nodes(df, "draft", "label", "parent", local_links=5).collect()}
    assert a == b
    for _, node, root, depth, path, *_ in b:
        assert path.split("/")[0] == root == "n0" and path.split("/")[-1] == node and path.count("/") == depth


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert h.ancestor_pairs(h.links(df, "draft", "label", "parent")).count() == 0
    assert h.tree_nodes(df, "draft", "label", "parent").count() == 0


SHAPES = {
    "chain": [(f"n{i:04d}", f"n{i - 1:04d}") for i in range(1, 400)],
    "star": [(f"n{i}", "hub") for i in range(600)] + [("hub", "top")],
    "circle": [(f"n{i}", f"n{(i * 7 + 1) % 90}") for i in range(90)] + [(f"m{i}", f"n{i % 90}") for i in range(200)],
    "two circles and second parents": [(f"n{i}", f"n{(i + 1) % 40}") for i in range(40)] + [(f"o{i}", f"o{(i + 1) % 3}") for i in range(3)] + [(f"m{i}", f"{'no'[i % 2]}{i % 3}") for i in range(60)] + [(f"m{i}", f"m{i - 7}") for i in range(7, 60, 3)],
}


@pytest.mark.parametrize("shape", SHAPES)
def test_shapes_beyond_one_task(spark, shape):
    rows = [("d", c, p) for c, p in SHAPES[shape]]
    labels = {x for _, c, p in rows for x in (c, p)}
    rows += [("d", x, None) for x in sorted(labels)]
    df = spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA)
    got = {tuple(r) for r in h.ancestor_pairs(h.links(df, "draft", "label", "parent"), 60).collect()}
    assert got == brute(rows)
    a = {tuple(r) for r in h.tree_nodes(df, "draft", "label", "parent", local_links=100_000).collect()}
    assert a == {tuple(r) for r in h.tree_nodes(df, "draft", "label", "parent", local_links=60).collect()}
