"""Queries of document structure, conversion, similarity, graphs and simulation."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from quillspark.convert import operators as c
from quillspark.functions import udfs
from quillspark.operators import segments as g
from quillspark.operators import simulate
from quillspark.operators.containment import quote_lines
from quillspark.operators.graph import connected_components
from quillspark.session import checkpointed, spread, table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def docs(spark, d):
    return spread(table(spark, d, "documents").select("doc_id", "text"))


_FENCED = r"""f AS (SELECT doc_id, k, line, regexp_matches(line, '^\s*(```+|~~~+)') AS mark FROM (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS k FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL))),
  o AS (SELECT *, mark OR sum(mark::INT) OVER (PARTITION BY doc_id ORDER BY k) % 2 = 1 AS fenced FROM f)"""
_ESCAPED = r"replace(line, '\|', chr(1))"
_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
_CELLS = rf"""{_FENCED}, c AS (SELECT doc_id, k, line, NOT fenced AND starts_with({_STRIP.format("line")}, '|') AND length(line) - length(replace(line, '|', '')) >= 2 AS cand, regexp_matches(line, '^\s*\|?(?:\s*:?-{{2,}}:?\s*\|?)+\s*$') AS rule FROM o),
  i AS (SELECT *, k - row_number() OVER (PARTITION BY doc_id ORDER BY k) AS island FROM c WHERE cand), w AS (SELECT doc_id, island, k, row_number() OVER (PARTITION BY doc_id, island ORDER BY k) - 1 AS r, string_split(regexp_replace({_STRIP.format(_ESCAPED)}, '^\|+|\|+$', '', 'g'), '|') AS l FROM i WHERE NOT rule),
  t AS (SELECT doc_id, (dense_rank() OVER (PARTITION BY doc_id ORDER BY island) - 1)::INT AS tbl, r::INT AS r, l FROM w), g AS (SELECT doc_id, tbl, r, (generate_subscripts(l, 1) - 1)::INT AS c, replace({_STRIP.format("unnest(l)")}, chr(1), '|') AS cell FROM t)"""


@query(f"WITH {_CELLS} SELECT doc_id, tbl, r, c, cell FROM g")
def pipe_tables(spark, d):
    return g.table_cells(docs(spark, d))


@query(f"""WITH {_CELLS} SELECT g.doc_id, g.tbl, g.r, g.c, g.cell, u.cell AS up, d.cell AS down, l.cell AS left, r.cell AS right, h.cell AS heading FROM g LEFT JOIN g u ON u.doc_id = g.doc_id AND u.tbl = g.tbl AND u.r = g.r - 1 AND u.c = g.c LEFT JOIN g d ON d.doc_id = g.doc_id AND d.tbl = g.tbl AND d.r = g.r + 1 AND d.c = g.c
  LEFT JOIN g l ON l.doc_id = g.doc_id AND l.tbl = g.tbl AND l.r = g.r AND l.c = g.c - 1 LEFT JOIN g r ON r.doc_id = g.doc_id AND r.tbl = g.tbl AND r.r = g.r AND r.c = g.c + 1 LEFT JOIN g h ON h.doc_id = g.doc_id AND h.tbl = g.tbl AND h.r = 0 AND h.c = g.c""".replace("AS left", 'AS "left"').replace("AS right", 'AS "right"'))
def cell_neighbours(spark, d):
    return g.cell_neighbours(checkpointed(g.table_cells(docs(spark, d))))


@query()
def md_blocks(spark, d):
    return g.document_blocks(docs(spark, d)).groupBy("doc_id", "kind").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"))


@query()
def chunk_tree(spark, d):
    return g.document_chunks(docs(spark, d))


@query()
def rag_chunks(spark, d):
    return g.document_rag_chunks(docs(spark, d))


@query("""WITH l AS (SELECT doc_id, string_split(regexp_extract(replace(text, chr(13), ''), '^---\\n((?:.*\\n)*?)---(?:\\n|$)', 1), chr(10)) AS l FROM documents WHERE starts_with(replace(text, chr(13), ''), '---' || chr(10)))
  SELECT doc_id, regexp_extract(x, '^([\\w-]+):', 1) AS name, trim(trim(regexp_extract(x, '^[\\w-]+:\\s*(.*)$', 1)), '"') AS value FROM (SELECT doc_id, unnest(l) AS x FROM l) WHERE regexp_matches(x, '^[\\w-]+:')""")
def front_matter(spark, d):
    return g.document_fields(docs(spark, d))


@query("""SELECT doc_id, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL) WHERE regexp_matches(line, '^```[a-z]+\\s*$') GROUP BY 1""")
def code_blocks(spark, d):
    return g.document_code(docs(spark, d)).where("language <> ''").groupBy("doc_id").agg(F.count("*").alias("n"))


@query(rf"""WITH {_FENCED}, e AS (SELECT *, NOT fenced AND regexp_matches(line, '^##\s+') AND regexp_matches(line, '^##\s') AS head, NOT fenced AND regexp_matches(line, '^-{{3,}}\s*$') AS stop FROM o), q AS (SELECT *, max(CASE WHEN head OR stop THEN k END) OVER (PARTITION BY doc_id ORDER BY k) AS last FROM e),
  b AS (SELECT doc_id, last AS line, string_agg(line, chr(10) ORDER BY k) AS body FROM q WHERE NOT head AND NOT stop AND last IS NOT NULL GROUP BY doc_id, last)
  SELECT e.doc_id, regexp_extract(e.line, '^##\s+(.*?)\s*#*\s*$', 1) AS title, e.k::INT AS line, coalesce(regexp_replace(b.body, '^\n+|\n+$', '', 'g'), '') AS body FROM e LEFT JOIN b ON b.doc_id = e.doc_id AND b.line = e.k WHERE e.head""")
def h2_sections(spark, d):
    return g.document_sections(docs(spark, d))


@query("""SELECT doc_id, '  ' || lpad((i)::VARCHAR, 5, ' ') || ': ' || line AS numbered FROM (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL))""")
def numbered_lines(spark, d):
    x = docs(spark, d).where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("p", "line"))
    return x.select("doc_id", F.format_string("  %5d: %s", F.col("p") + 1, "line").alias("numbered"))


@query()
def block_match(spark, d):
    """Block agreement of each section's source with its cleaned text; beyond `CELLS` pairs of blocks (a fixed value) the whole texts are compared, which `whole_text` tells."""
    s = table(spark, d, "standard_sections").where("raw_latex is not null and cleaned_text is not null")
    s = s.select("id", "raw_latex", "cleaned_text")
    return spread(s).select("id", udfs.block_match("raw_latex", "cleaned_text").alias("m")).select("id", "m.nid", "m.matched", "m.order", "m.whole_text")


@query()
def tree_edit(spark, d):
    """Heading-tree similarity of documents of a paper with the first one of it."""
    t = table(spark, d, "documents").where("paper_id is not null and text rlike '(?m)^## '")
    first = t.groupBy("paper_id").agg(F.min_by("text", "doc_id").alias("base"))
    return t.join(first, "paper_id").select("doc_id", "paper_id", F.round(udfs.heading_similarity("base", "text"), 6).alias("similarity"))


@query("SELECT scrape_id, CASE WHEN greatest(length(title), length(source_file)) = 0 THEN 0.0 ELSE levenshtein(title, source_file) / greatest(length(title), length(source_file)) END AS ned FROM papers WHERE title IS NOT NULL AND source_file IS NOT NULL")
def ned_names(spark, d):
    n = F.greatest(F.length("title"), F.length("source_file"))
    return table(spark, d, "papers").where("title is not null and source_file is not null").select("scrape_id", F.when(n == 0, 0.0).otherwise(F.levenshtein("title", "source_file") / n).alias("ned"))


@query("""WITH w AS (SELECT s.id, list_distinct(regexp_split_to_array(trim(lower(s.title)), '\\s+')) AS a, list_distinct(regexp_split_to_array(trim(lower(p.title)), '\\s+')) AS b FROM standard_sections s JOIN standard_sections p ON p.draft_tag = s.draft_tag AND p.stable_label = s.parent_label WHERE s.title <> '' AND p.title <> '')
  SELECT id, max(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b)))) AS jaccard FROM w GROUP BY id""")
def jaccard_words(spark, d):
    s = table(spark, d, "standard_sections").where("title <> ''")
    p = s.select("draft_tag", F.col("stable_label").alias("parent_label"), F.col("title").alias("up"))
    w = lambda x: F.array_distinct(F.split(F.trim(F.lower(x)), r"\s+"))
    j = s.join(p, ["draft_tag", "parent_label"]).select("id", w("title").alias("a"), w("up").alias("b"))
    return j.groupBy("id").agg(F.max(F.size(F.array_intersect("a", "b")) / F.size(F.array_union("a", "b"))).alias("jaccard"))


@query()
def fuzzy_substring(spark, d):
    """Edits that make each paper's title a part of each of its documents, whole texts."""
    t = table(spark, d, "documents").where("paper_id is not null and text is not null").select("doc_id", "paper_id", F.col("text").alias("head"))
    p = table(spark, d, "papers").where("title <> ''").groupBy("paper_id").agg(F.min_by("title", "scrape_id").alias("title"))
    return t.join(p, "paper_id").select("doc_id", udfs.near_substring("title", "head").alias("edits"))


_SQUEEZE = "trim(regexp_replace(lower({0}), '\\s+', ' ', 'g'))"


@query(f"""WITH q AS (SELECT item_id, i, {_SQUEEZE.format("s")} AS q FROM (SELECT item_id, unnest(l) AS s, generate_subscripts(l, 1) AS i FROM (SELECT item_id, string_split(text, '. ') AS l FROM benchmark))), l AS (SELECT doc_id, {_SQUEEZE.format("unnest(l)")} AS line, {_SQUEEZE.format("unnest(m)")} AS two, generate_subscripts(l, 1) AS n FROM (SELECT doc_id, l, list_transform(list_zip(l, l[2:] || ['']), lambda z: z[1] || ' ' || z[2]) AS m FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)))
  SELECT item_id, i::INT AS sentence, doc_id, coalesce(min(n) FILTER (contains(line, q)), min(n))::INT AS line, CASE WHEN bool_or(contains(line, q)) THEN 1 ELSE 2 END::INT AS lines FROM q JOIN l ON length(q) >= 20 AND contains(two, q) GROUP BY ALL""")
def quote_grounding(spark, d):
    """Where each document holds a sentence of an item, within a line or across two."""
    s = table(spark, d, "benchmark").select("item_id", F.posexplode(F.split("text", r"\. ", -1)).alias("i", "s"))
    s = s.select(F.concat("item_id", F.lit(":"), F.col("i") + 1).alias("quote"), "s").where(F.length(F.trim(F.regexp_replace("s", r"\s+", " "))) >= 20)
    hit = quote_lines(docs(spark, d), "doc_id", "text", s, "quote", "s")
    part = F.split("quote", ":")
    return hit.select(part[0].cast("long").alias("item_id"), part[1].cast("int").alias("sentence"), "doc_id", "line", "lines")


@query()
def html_to_md(spark, d):
    """HTML tables among the documents as Markdown."""
    return c.html_documents(docs(spark, d).where("text like '%<tr>%'"), "doc_id", "text")


@query()
def casting(spark, d):
    """Event types of each user's stream cast from a roster, least used first."""
    people = pd.DataFrame([(f"p{k}", t) for k in range(12) for t in [("click", "view", "error", "purchase")[k % 4]]], columns=["person", "domain"])
    return simulate.cast_roles(table(spark, d, "events").select("user_id", "event_id", "event_type"), people, "user_id", "event_id", "event_type", cap=40)


@query("""WITH RECURSIVE e AS (SELECT DISTINCT draft_tag || '/' || from_label AS a, draft_tag || '/' || to_label AS b FROM section_xrefs WHERE from_label IS NOT NULL AND to_label IS NOT NULL AND draft_tag IS NOT NULL), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
  r(n, m) AS (SELECT a, a FROM u UNION SELECT u.b, r.m FROM r JOIN u ON u.a = r.n WHERE r.m < u.b)
  SELECT component, count(*) AS nodes FROM (SELECT n, min(m) AS component FROM r GROUP BY n) GROUP BY 1""")
def xref_components(spark, d):
    """Connected groups of labels that refer to one another."""
    x = table(spark, d, "section_xrefs").where("draft_tag is not null and from_label is not null and to_label is not null")
    e = x.select(F.concat("draft_tag", F.lit("/"), "from_label").alias("src"), F.concat("draft_tag", F.lit("/"), "to_label").alias("dst"))
    nodes = e.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    comp = connected_components(e)
    return nodes.join(comp, "node", "left").groupBy(F.coalesce("component", "node").alias("component")).agg(F.count("*").alias("nodes"))


@query("""SELECT draft_tag, id, rule FROM (SELECT s.draft_tag, s.id, CASE WHEN coalesce(s.parent_label, '') = '' AND s.depth <> 0 THEN 'deep_root' WHEN coalesce(s.parent_label, '') <> '' AND NOT EXISTS (SELECT 1 FROM standard_sections p WHERE p.draft_tag = s.draft_tag AND p.stable_label = s.parent_label) THEN 'no_parent' END AS rule FROM standard_sections s) WHERE rule IS NOT NULL""")
def outline_violations(spark, d):
    s = table(spark, d, "standard_sections")
    p = s.select("draft_tag", F.col("stable_label").alias("parent_label"), F.lit(True).alias("there")).distinct()
    up = F.coalesce("parent_label", F.lit(""))
    rule = F.when((up == "") & (F.col("depth") != 0), "deep_root").when((up != "") & F.col("there").isNull(), "no_parent")
    return s.join(p, ["draft_tag", "parent_label"], "left").select("draft_tag", "id", rule.alias("rule")).where("rule is not null")
