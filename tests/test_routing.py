from pyspark.sql import functions as F

from quillspark.operators import learned
from quillspark.operators import retrieval as v
from quillspark.operators import routing as r

MD = """---
title: x
---
# Motivation

We propose to add std::cursor for users because it is easier to use. This paper introduces std::buffer for namespace std. We propose std::thing because of existing practice here.

```cpp
int x; // fence
```

## Proposed wording

Returns: the std::cursor value shall be returned here."""


def test_units_and_sections(spark):
    docs = spark.createDataFrame([(1, MD, "LEWG", "k"), (2, None, None, "k"), (3, "", "", "k"), (4, MD.replace("\n", "\r\n"), "LWG", None)], "doc_id long, text string, audience string, kind string")
    u = {(x.doc_id, x.pos): (x.line, x.kind, x.unit) for x in r.units(docs).collect()}
    one = [u[k] for k in sorted(u) if k[0] == 1]
    assert [x[1] for x in one].count("heading") == 2 and any(x[1] == "fence" and "int x" in x[2] for x in one)
    assert (5, "prose", "We propose to add std::cursor for users because it is easier to use.") in one
    assert [x[2].replace("\r", "") for x in one] == [u[k][2] for k in sorted(u) if k[0] == 4]
    tagged = {(x.doc_id, x.section) for x in r.tagged_units(r.units(docs)).collect()}
    assert (1, "MOTIVATION") in tagged and (1, "WORDING") in tagged
    got = {x.doc_id: x for x in r.route(docs, "audience").collect() if x.role == "primary"}
    assert got[1].group == "LEWG" and got[1].score > 0.3 and 2 not in got
    assert r.route(docs.limit(0)).count() == 0


def test_units_of_wording():
    kinds = lambda t: [(k, u) for _, k, u in r.text_units(t)]
    assert kinds("note-list: item-list other-item\nnote: See the Standard here.\n\nadd: more words") == [("rule", "note-list: item-list other-item"), ("prose", "note: See the Standard here."), ("prose", "add: more words")]
    assert kinds("Effects: Equivalent to x.\n*Returns*: y. More of it.") == [("prose", "Effects: Equivalent to x."), ("prose", "*Returns*: y."), ("prose", "More of it.")]
    assert kinds("In the table, add: Effects: none") == [("prose", "In the table, add:"), ("prose", "Effects: none")]
    assert kinds("~~~\na\n```\n~~~\n```\nb\n```") == [("fence", "~~~\na\n```\n~~~"), ("fence", "```\nb\n```")]
    assert kinds("") == [] and kinds("```\nopen") == [("fence", "```\nopen")]


def test_lines_of_wording(spark):
    df = spark.createDataFrame([("Effects: x",), ("**Error conditions:** y",), ("item-list: item",), ("add: item",), ("note: See it.",), (None,)], "s string")
    got = df.select(r.is_label_line(F.col("s")).alias("label"), r.is_rule_line(F.col("s")).alias("rule")).collect()
    assert [x.label for x in got] == [True, True, False, False, False, None] and [x.rule for x in got] == [False, False, True, False, False, None]


def test_emission_policy(spark):
    s = spark.createDataFrame([(1, 0.5, 0.45, 0.0, 0.0), (2, 0.04, 0.0, 0.0, 0.0), (3, 0.0, 0.0, 0.4, 0.1), (4, 0.31, 0.2, 0.0, 0.0)], "doc_id long, LEWG double, LWG double, EWG double, CWG double")
    n = spark.createDataFrame([(1, 50, 9, 9, 0, 0), (2, 50, 9, 9, 9, 9), (3, 50, 0, 0, 0, 0), (4, 50, 0, 5, 0, 0)], "doc_id long, units long, n_LEWG long, n_LWG long, n_EWG long, n_CWG long")
    got = sorted((x.doc_id, x.group, x.role) for x in r.emitted(s, n).collect())
    assert got == [(1, "LEWG", "primary"), (1, "LWG", "secondary"), (3, "EWG", "primary"), (4, "LWG", "primary")]
    a = r.arbitrated(s).where("doc_id = 3").first()
    assert (a.LEWG, a.EWG) == (0.0, 0.4)


def test_learned_head(spark):
    docs = spark.createDataFrame([(i, MD if i % 2 else "# Notes\n\nA text about other things that has no names at all, and nothing more.") for i in range(24)], "doc_id long, text string")
    f = learned.routing_features(r.tagged_units(r.units(docs)))
    assert len(learned.FEATURES) == len(f.columns) - 1
    labels = spark.createDataFrame([(i, ["LEWG"] if i % 2 else []) for i in range(24)], "doc_id long, groups array<string>")
    heads = learned.train_heads(f, labels, iterations=3)
    assert set(heads) == {"LEWG"} and {x.doc_id for x in learned.predicted_groups(f, heads, {"LEWG": 0.5}).collect()} == set(range(1, 24, 2))
    assert learned.predicted_groups(f, {}, {}).count() == 0


def test_search(spark):
    docs = spark.createDataFrame([(1, "alpha beta beta", "x"), (2, "alpha", "beta"), (3, None, "alpha"), (4, "gamma", "y")], "id long, text string, title string")
    got = [x.id for x in v.bm25(docs, "id", {"text": 1.0, "title": 5.0}, ["alpha", "BETA"], 5).collect()]
    assert got == [2, 1] and v.bm25(docs, "id", {"text": 1.0}, ["beta"], 5, phrase="beta beta").count() == 1 and v.bm25(docs, "id", {"text": 1.0}, ["none"], 5).count() == 0
    vec = spark.createDataFrame([(0, [1.0, 0.0], "a"), (1, [0.9, 0.1], "a"), (2, [0.8, 0.2], "a"), (3, [0.0, 1.0], "b"), (4, [0.0, 0.0], "b"), (5, [0.7, 0.7], "b")], "v long, e array<double>, g string")
    q = vec.where("v = 0").select(vec.v.alias("q"), "e")
    assert [(x.v, x.place) for x in v.vector_topk(q, "q", vec, "v", "e", 3, least=0.3, group="g", per_group=2).orderBy("place").collect()] == [(0, 1), (1, 2), (5, 3)]


def test_parts_pass_over_nothing(spark):
    """Patterns behind their parts and patterns alone find the same, in any case and with odd letters."""
    texts = ["a <b> x", "9.1 [a.b] modify it", "STD::x is_same foo_v", "the Library shall be Updated", "namespace  STD", "Library Evolution", "Allocator model", "users may specialize", "[expr.prim]", "Variable Templates", "a-b: c", "lambda-expression",
             "ADL and name  lookup", "SFINAE", "storage duration", "Core Working Group", "type deduction", "this paper introduces", "update accordingly", "propose removing", "for several reasons", "_v suffix", "alternative approach", "less verbose", "returns a",
             "no breaking change", "doesn't affect", "implemented in", "widely used", "compile-time cost", "Effects: x", "so add:", "Table 5", "__has_cpp_attribute", "audience: x", "P1234R5", "migration path", "ABI break", "SF/F/N/A/SA", "ſtd::x and ſhall", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.array_compact(F.array(*[F.when(F.col("t").rlike(("(?iUd)" if fold else "(?Ud)") + p), k) for k, (fold, p) in r.CATALOGUE.items()]))
    got = df.select("t", r.hits(F.col("t")).alias("a"), plain.alias("b")).collect()
    assert all(x.a == x.b for x in got) and {k for x in got for k in x.a} == set(r.CATALOGUE)
