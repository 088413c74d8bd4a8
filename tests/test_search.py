import datetime

import pytest

from quillspark.search import SectionIndex

SECTION = "id long, draft_tag string, stable_label string, section_number string, title string, depth int, parent_label string, chapter_file string, raw_latex string, cleaned_text string"
ROWS = [
    (1, "n1", "a", "1", "General", 0, None, "a.tex", "\\pnum First \\tcode{x}.\\pnum Second.", "First x. Second. allocator"),
    (2, "n1", "a.b", "1.1", "Allocator", 1, "a", "a.tex", "\\defn{thing} \\indextext{thing!odd}\n\\begin{bnf}\nitem-list:\n  item\n\\end{bnf}\\begin{itemdecl}\nvoid swap_all(int);\n\\end{itemdecl}", "The allocator buffer."),
    (3, "n1", " [A.B.C] ", "1.1.1", "Deep", 2, "a.b", "b.tex", "", "buffer only"),
    (4, "n0", "a", "1", "General", 0, "", "a.tex", None, "First."),
    (5, "n1", None, None, None, None, None, None, None, None),
]


@pytest.fixture(scope="module")
def index(spark):
    refs = spark.createDataFrame([(1, "n1", "a.b", "a"), (2, "n1", "a.b.c", "[a]"), (3, "n1", "a.b", "a"), (4, "n0", "z", "a"), (5, "n1", "a", None)], "xref_id long, draft_tag string, from_label string, to_label string")
    drafts = spark.createDataFrame([("n0", 1, datetime.datetime(2024, 1, 1)), ("n1", 4, None)], "draft_tag string, section_count long, ingested_at timestamp")
    return SectionIndex(spark.createDataFrame(ROWS, SECTION), refs, drafts)


def ids(df):
    return sorted(r.id for r in df.collect())


def test_lookups(index):
    assert [r.draft_tag for r in index.list_drafts().collect()] == ["n1", "n0"]
    assert ids(index.list_chapters()) == [1] and ids(index.list_sections(chapter="a.tex", depth=1)) == [1, 2]
    assert ids(index.section("[A.b.c]")) == [3] and ids(index.section("a", "n0")) == [4] and ids(index.section("zz")) == []
    assert [(r.id, r.place) for r in index.sections_of(["a.b.c", "zz", "a"]).orderBy("place").collect()] == [(3, 0), (1, 2)] and ids(index.sections_of([])) == []
    assert ids(index.in_all_drafts("a")) == [1, 4] and ids(index.children("a")) == [2]
    assert [tuple(r) for r in index.ancestors("a.b.c").collect()] == [("a.b", 1), ("a", 2)] and [tuple(r) for r in index.descendants("a").collect()] == [("a.b", 1), ("a.b.c", 2)]
    assert index.paragraph("a", 1).first().paragraph.strip() == "First x." and index.paragraph("a", 9).count() == 0
    c = index.changed("a", "n0", "n1").first()
    assert not c.same and c.old_text == "First." and index.changed("zz", "n0", "n1").first().same


def test_terms_and_searches(index):
    assert [tuple(r) for r in index.references_to("a").collect()] == [("a.b", 2), ("a.b.c", 1)] and [tuple(r) for r in index.references_from("a.b").collect()] == [("a", 2)]
    assert ids(index.definitions("Thing")) == [2] and ids(index.index_entries("ODD")) == [2] and ids(index.grammar("item-list")) == [2] and ids(index.grammar("item")) == []
    assert ids(index.declarations("swap_all")) == [2] and ids(index.declarations("swap")) == []
    assert [r.id for r in index.search(["allocator"]).collect()] == [2, 1] and ids(index.search(["allocator", "buffer"])) == [2] and ids(index.search(["zz"])) == []
    assert {tuple(r) for r in index.verified(["a", "[A.B.C]", "zz", "a"]).collect()} == {("a", True), ("[A.B.C]", True), ("zz", False)}
    asked = {q: index.guide(q)[0] for q in ("[a.b]", "is there a.b", "define thing", "grammar of item-list", "effects of swap_all", "uses of a", "allocator buffer")}
    assert list(asked.values()) == ["label", "exist", "define", "grammar", "spec", "xref", "search"]
    assert ids(index.guide("define thing")[1]) == [2] and ids(index.guide("allocator buffer")[1]) == [2]
