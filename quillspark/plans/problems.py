"""Queries for packed fields, hierarchies and orphan references."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators.hierarchy import ancestor_pairs, links, tree_nodes
from quillspark.operators.packed_fields import AUTHORS, GROUPS, split_packed
from quillspark.operators.references import document_orphans
from quillspark.session import checkpointed, table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return split_packed(table(spark, d, "papers"), "scrape_id", [AUTHORS, GROUPS])


def p1_values(spark: SparkSession, d: str) -> DataFrame:
    """Use of each packed value: fields, first place, number of rows."""
    return p1_found(spark, d).groupBy("field", "value").agg(F.count("*").alias("n"), F.countDistinct("scrape_id").alias("papers"), F.min("pos").alias("first_pos"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    edges = checkpointed(links(table(spark, d, "standard_sections"), "draft_tag", "stable_label", "parent_label"))
    return ancestor_pairs(edges).select(
        F.col("scope").alias("draft_tag"), F.col("ancestor").alias("ancestor_label"), F.col("descendant").alias("descendant_label"), "distance"
    )


def p4_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Root, depth, path, number of descendants and circle flag of every section label."""
    return tree_nodes(table(spark, d, "standard_sections"), "draft_tag", "stable_label", "parent_label").withColumnsRenamed({"scope": "draft_tag", "node": "label"})


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return document_orphans(*[table(spark, d, t) for t in ("papers", "standard_sections", "section_xrefs", "removed_records")])


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphan references per table, field, month and state."""
    return p6_found(spark, d).groupBy("source_table", "field", "period", "state").agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (p1_found, p1_values, p4_found, p4_nodes, p6_found, p6_report)}

_LABEL = r"regexp_replace(lower({0}), '^[\s\[\]]+|[\s\[\]]+$', '', 'g')"
_PAPER = r"regexp_replace(regexp_replace(upper({0}), '\s+', '', 'g'), '\.(PDF|HTML?|MD|TXT|DOCX?)$', '')"

_P4_CLOSURE = f"""
WITH RECURSIVE s AS (
  SELECT draft_tag, {_LABEL.format("stable_label")} AS c, {_LABEL.format("parent_label")} AS p FROM standard_sections),
n AS (SELECT draft_tag, count(DISTINCT c) AS n FROM s WHERE c <> '' GROUP BY 1),
e AS (SELECT DISTINCT s.draft_tag, s.c, s.p FROM s WHERE s.c <> '' AND s.p <> ''
      AND EXISTS (SELECT 1 FROM s q WHERE q.draft_tag = s.draft_tag AND q.c = s.p)),
r(draft_tag, a, d, k) AS (
  SELECT draft_tag, p, c, 1 FROM e
  UNION
  SELECT r.draft_tag, e.p, r.d, r.k + 1 FROM r JOIN e ON e.draft_tag = r.draft_tag AND e.c = r.a
  JOIN n ON n.draft_tag = r.draft_tag WHERE r.k < n.n)
"""

_P6 = f"""
WITH x AS (
  SELECT 'section' AS kind, coalesce(draft_tag, '') AS scope, {_LABEL.format("from_label")} AS k, 'section_xrefs' AS source_table, 'from_label' AS field, xref_id AS row_id, extracted_at AS t FROM section_xrefs
  UNION ALL
  SELECT 'section', coalesce(draft_tag, ''), {_LABEL.format("to_label")}, 'section_xrefs', 'to_label', xref_id, extracted_at FROM section_xrefs
  UNION ALL
  SELECT 'paper', '', CASE WHEN regexp_matches(previous_version, '[0-9]') THEN {_PAPER.format("previous_version")} ELSE '' END, 'papers', 'previous_version', scrape_id, scraped_at FROM papers),
y AS (
  SELECT 'section' AS kind, coalesce(draft_tag, '') AS scope, {_LABEL.format("stable_label")} AS k, min(ingested_at) AS t FROM standard_sections GROUP BY 1, 2, 3
  UNION ALL
  SELECT 'paper', '', {_PAPER.format("paper_id")}, min(scraped_at) FROM papers GROUP BY 3),
g AS (
  SELECT DISTINCT CASE WHEN source_table = 'papers' THEN 'paper' ELSE 'section' END AS kind,
    CASE WHEN source_table = 'papers' THEN '' ELSE coalesce(scope, '') END AS scope,
    CASE WHEN source_table = 'papers' THEN {_PAPER.format("record_key")} ELSE {_LABEL.format("record_key")} END AS k FROM removed_records),
o AS (
  SELECT DISTINCT x.source_table, x.field, x.row_id, strftime(x.t, '%Y-%m') AS period,
    CASE WHEN y.t IS NOT NULL THEN 'late' WHEN g.k IS NOT NULL THEN 'deleted' ELSE 'missing' END AS state
  FROM x LEFT JOIN y ON y.kind = x.kind AND y.scope = x.scope AND y.k = x.k
  LEFT JOIN g ON g.kind = x.kind AND g.scope = x.scope AND g.k = x.k
  WHERE x.k <> '' AND x.t IS NOT NULL AND (y.t IS NULL OR y.t > x.t))
"""

ORACLES = {
    "p4_found": _P4_CLOSURE + "SELECT draft_tag, a AS ancestor_label, d AS descendant_label, min(k)::INT AS distance FROM r GROUP BY 1, 2, 3",
    "p4_nodes": _P4_CLOSURE
    + """, m AS (SELECT DISTINCT draft_tag, c FROM s WHERE c <> '' AND draft_tag IS NOT NULL), f AS (SELECT draft_tag, c, min(p) AS p FROM e GROUP BY ALL),
u(draft_tag, c, top, k, path) AS (
  SELECT draft_tag, c, c, 0, c FROM m
  UNION ALL
  SELECT u.draft_tag, u.c, f.p, u.k + 1, f.p || '/' || u.path FROM u JOIN f ON f.draft_tag = u.draft_tag AND f.c = u.top JOIN n ON n.draft_tag = u.draft_tag WHERE u.k < n.n),
t AS (SELECT u.* FROM u WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.draft_tag = u.draft_tag AND f.c = u.top)),
b AS (SELECT draft_tag, a, count(DISTINCT d) FILTER (d <> a) AS below, bool_or(a = d) AS circle FROM r GROUP BY 1, 2)
SELECT m.draft_tag, m.c AS label, t.top AS root, t.k::BIGINT AS depth, t.path, coalesce(b.below, 0) AS n_descendants, coalesce(b.circle, false) AS on_circle
FROM m LEFT JOIN t ON t.draft_tag = m.draft_tag AND t.c = m.c LEFT JOIN b ON b.draft_tag = m.draft_tag AND b.a = m.c""",
    "p6_found": _P6 + "SELECT source_table, field, row_id, period, state FROM o",
    "p6_report": _P6 + "SELECT source_table, field, period, state, count(*) AS n FROM o GROUP BY 1, 2, 3, 4",
}
