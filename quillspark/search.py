"""Questions to an index of sections: lookups, children, references, definitions, grammar, full text, and a guide that picks among them.

The index is three DataFrames; every answer is one too, made by the operators
of the library, so nothing is read before it is asked for.

Defined results
  unknown label or draft    no rows
  label in other letters, with blanks or brackets    the same label
  no draft given            the greatest tag, by alphabet
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions import text as x
from quillspark.operators.hierarchy import LOCAL_LINKS, ancestor_pairs, label_key, links
from quillspark.operators.retrieval import bm25, snippet, vector_topk

_BRIEF = ("id", "draft_tag", "stable_label", "section_number", "title", "depth")


@dataclass
class SectionIndex:
    sections: DataFrame
    xrefs: DataFrame
    drafts: DataFrame
    draft: str | None = None

    def _of(self, draft: str | None) -> DataFrame:
        tag = draft or self.draft
        if tag is None:
            tag = self.sections.agg(F.max("draft_tag")).first()[0]
        return self.sections.where(F.col("draft_tag") == F.lit(tag))

    @staticmethod
    def _is(label: str, column: str = "stable_label") -> Column:
        return label_key(F.col(column)) == label_key(F.lit(label))

    # -------------------------------------------------------- lookups

    def list_drafts(self) -> DataFrame:
        return self.drafts.select("draft_tag", "section_count", "ingested_at").orderBy(F.desc("draft_tag"))

    def list_chapters(self, draft: str | None = None) -> DataFrame:
        return self._of(draft).where("depth = 0").select(*_BRIEF)

    def list_sections(self, draft: str | None = None, chapter: str | None = None, depth: int | None = None) -> DataFrame:
        s = self._of(draft)
        s = s if chapter is None else s.where(F.col("chapter_file") == chapter)
        return (s if depth is None else s.where(F.col("depth") <= depth)).select(*_BRIEF)

    def section(self, label: str, draft: str | None = None) -> DataFrame:
        return self._of(draft).where(self._is(label))

    def sections_of(self, labels: list[str], draft: str | None = None) -> DataFrame:
        """The sections of a list of labels, with their place in it."""
        at = F.create_map(*[v for k, s in reversed(list(enumerate(labels))) for v in (label_key(F.lit(s)), F.lit(k))]) if labels else F.create_map().cast("map<string,int>")
        return self._of(draft).withColumn("place", at[label_key(F.col("stable_label"))]).where("place is not null")

    def in_all_drafts(self, label: str) -> DataFrame:
        return self.sections.where(self._is(label)).select(*_BRIEF)

    def children(self, label: str, draft: str | None = None) -> DataFrame:
        return self._of(draft).where(self._is(label, "parent_label")).select(*_BRIEF)

    def _pairs(self, draft: str | None) -> DataFrame:
        return ancestor_pairs(links(self._of(draft), "draft_tag", "stable_label", "parent_label"), LOCAL_LINKS)

    def ancestors(self, label: str, draft: str | None = None) -> DataFrame:
        """(label, distance) of what lies above, the nearest first."""
        return self._pairs(draft).where(F.col("descendant") == label_key(F.lit(label))).select(F.col("ancestor").alias("label"), "distance").orderBy("distance", "label")

    def descendants(self, label: str, draft: str | None = None) -> DataFrame:
        return self._pairs(draft).where(F.col("ancestor") == label_key(F.lit(label))).select(F.col("descendant").alias("label"), "distance").orderBy("distance", "label")

    def paragraph(self, label: str, number: int, draft: str | None = None) -> DataFrame:
        """(id, paragraph) of a numbered paragraph, from 1."""
        parts = F.filter(F.split("raw_latex", r"\\pnum", -1), lambda p: F.trim(p) != "")
        return self.section(label, draft).select("id", x.expand_macros(F.try_element_at(parts, F.lit(number))).alias("paragraph")).where("paragraph is not null")

    def changed(self, label: str, old: str, new: str) -> DataFrame:
        """(old_text, new_text, same) of a label in two drafts; null where it isn't there."""
        text = lambda tag, name: self.sections.where((F.col("draft_tag") == tag) & self._is(label)).agg(F.max_by("cleaned_text", "id").alias(name))
        both = text(old, "old_text").crossJoin(text(new, "new_text"))  # one row each
        return both.withColumn("same", F.col("old_text").eqNullSafe(F.col("new_text")))

    # -------------------------------------------------------- references and terms

    def references_from(self, label: str, draft: str | None = None) -> DataFrame:
        return self._refs(label, draft, "from_label", "to_label")

    def references_to(self, label: str, draft: str | None = None) -> DataFrame:
        return self._refs(label, draft, "to_label", "from_label")

    def _refs(self, label: str, draft: str | None, here: str, there: str) -> DataFrame:
        tags = self._of(draft).select("draft_tag").distinct()
        r = self.xrefs.join(F.broadcast(tags), "draft_tag").where(self._is(label, here))  # one tag
        return r.groupBy(label_key(F.col(there)).alias("label")).agg(F.count("*").alias("n")).where("label is not null").orderBy(F.desc("n"), "label")

    def _terms(self, draft: str | None, terms: Column) -> DataFrame:
        return self._of(draft).where("raw_latex is not null").select("id", "stable_label", F.explode(terms).alias("term"))

    def definitions(self, term: str, draft: str | None = None) -> DataFrame:
        return self._terms(draft, x.latex_definitions(F.col("raw_latex"))).where(F.lower("term") == term.lower())

    def index_entries(self, part: str, draft: str | None = None) -> DataFrame:
        return self._terms(draft, x.latex_index_terms(F.col("raw_latex"))).where(F.lower("term").contains(part.lower()))

    def grammar(self, name: str, draft: str | None = None) -> DataFrame:
        """(id, stable_label, rule): blocks of grammar that define a name."""
        blocks = F.regexp_extract_all("raw_latex", F.lit(r"(?s)\\begin\{(?:nc)?(?:simple)?bnf\}(.*?)\\end"), F.lit(1))
        return self._terms(draft, blocks).withColumnRenamed("term", "rule").where(F.col("rule").rlike(rf"(?m)^\s*(?:\\nontermdef\{{)?\Q{name}\E\}}?\s*:"))

    def declarations(self, name: str, draft: str | None = None) -> DataFrame:
        """(id, stable_label, declaration): declared items that name something."""
        blocks = F.regexp_extract_all("raw_latex", F.lit(r"(?s)\\begin\{(?:itemdecl|codeblock)\}(.*?)\\end"), F.lit(1))
        return self._terms(draft, blocks).withColumnRenamed("term", "declaration").where(F.col("declaration").rlike(rf"(?<![\w])\Q{name}\E(?![\w])"))

    # -------------------------------------------------------- searches

    def search(self, terms: list[str], k: int = 20, draft: str | None = None) -> DataFrame:
        """(id, score, stable_label, title, snippet) of the k best sections that hold all terms."""
        s = self._of(draft)
        best = bm25(s, "id", {"cleaned_text": 1.0, "title": 5.0, "stable_label": 10.0}, terms, k)
        return s.join(F.broadcast(best), "id").select("id", "score", "stable_label", "title", snippet(F.col("cleaned_text"), terms[0]).alias("snippet")).orderBy("score", "id")  # k rows

    def similar(self, vectors: DataFrame, key: str, vector: str, wanted: DataFrame, wanted_key: str, k: int = 5, least: float = 0.3) -> DataFrame:
        """The k nearest vectors of each wanted one."""
        return vector_topk(wanted, wanted_key, vectors, key, vector, k, least)

    def verified(self, labels: list[str], draft: str | None = None) -> DataFrame:
        """(label, there) of labels that a text refers to."""
        spark = self.sections.sparkSession
        asked = spark.createDataFrame([(v,) for v in dict.fromkeys(labels)], "label string")
        known = self._of(draft).select(label_key(F.col("stable_label")).alias("_k")).where("_k is not null").distinct()
        j = asked.withColumn("_k", label_key(F.col("label"))).join(known.withColumn("_there", F.lit(True)), "_k", "left")
        return j.select("label", F.coalesce("_there", F.lit(False)).alias("there"))

    def guide(self, question: str, draft: str | None = None) -> tuple[str, DataFrame]:
        """What a question asks for, and its answer; full text where no other way fits."""
        spark = self.sections.sparkSession
        row = spark.range(1).select(x.query_intent(F.lit(question)).alias("i"), F.regexp_extract(F.lit(question), r"([\w:.-]+)\W*$", 1).alias("name")).first()
        word = row.name
        ways = {
            "label": lambda: self.section(question.strip(), draft), "exist": lambda: self.verified([word], draft), "define": lambda: self.definitions(word, draft), "grammar": lambda: self.grammar(word, draft),
            "spec": lambda: self.declarations(word, draft), "xref": lambda: self.references_to(word, draft),
        }
        terms = [t for t in question.lower().split() if t.isalnum()] or [question]
        return row.i, ways.get(row.i, lambda: self.search(terms, 20, draft))()
