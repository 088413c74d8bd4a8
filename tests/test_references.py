from datetime import datetime as T

from quillspark.operators import references as r

P = "scrape_id long, paper_id string, previous_version string, scraped_at timestamp, key string"
S = "id long, draft_tag string, stable_label string, ingested_at timestamp"
X = "xref_id long, draft_tag string, from_label string, to_label string, extracted_at timestamp"
R = "source_table string, scope string, record_key string, removed_at timestamp"


def day(n):
    return T(2020, 1, 1 + n)


def run(spark, papers=(), sections=(), xrefs=(), removed=()):
    d = [spark.createDataFrame(list(x), s) for x, s in ((papers, P), (sections, S), (xrefs, X), (removed, R))]
    return sorted(tuple(x) for x in r.document_orphans(*d).collect())


def test_states(spark):
    papers = [(1, "P1R0", None, day(0), "k"), (2, "P1R1", " p1r0.pdf", day(1), "k"), (3, "P2R1", "P2 R0", day(1), "k"), (4, "P2R0", "N/A", day(3), "k"), (5, "P3R0", "P9R9", day(2), None), (6, "P3R0", "P8R8", None, None)]
    sections = [(1, "d", "A.b", day(0)), (2, "d", " [c]", day(5)), (3, "e", "z", day(0)), (4, "d", None, day(0))]
    xrefs = [(1, "d", "a.B", "[c]", day(1)), (2, "d", "c", "z", day(6)), (3, "d", "q ", "", day(1)), (4, None, "a.b", None, day(1))]
    removed = [("standard_sections", "d", "Q", day(0)), ("papers", "", "p9r9", day(0)), ("papers", "", "p9r9", day(1)), (None, None, None, None)]
    assert run(spark, papers, sections, xrefs, removed) == [
        ("papers", "previous_version", 3, "2020-01", "late"),
        ("papers", "previous_version", 5, "2020-01", "deleted"),
        ("section_xrefs", "from_label", 3, "2020-01", "deleted"),
        ("section_xrefs", "from_label", 4, "2020-01", "missing"),
        ("section_xrefs", "to_label", 1, "2020-01", "late"),
        ("section_xrefs", "to_label", 2, "2020-01", "missing"),
    ]


def test_empty(spark):
    assert run(spark) == []
    assert run(spark, xrefs=[(1, "d", "a", "b", day(0))])[0][4] == "missing"


def test_ledger_is_incremental(spark):
    ref = r.references(spark.createDataFrame([(1, "d", "a", "b", day(1))], X), "section", "section_xrefs", ["to_label"], "xref_id", "extracted_at", r.F.col("draft_tag"), r.label_key)
    none = spark.createDataFrame([], S)
    some = spark.createDataFrame([(1, "d", "b", day(0))], S)
    e = lambda df: r.existence(df, "section", "ingested_at", r.F.col("draft_tag"), r.label_key(r.F.col("stable_label")))
    ledger = r.apply_deltas(None, r.deltas(ref, e(none)))
    assert r.orphan_keys(ledger).count() == 1
    assert r.orphan_keys(r.apply_deltas(ledger, r.deltas(ref.limit(0), e(some)))).count() == 0
