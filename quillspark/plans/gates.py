"""Queries of checks against anchors, structure, other versions and known items."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from quillspark.functions import similarity
from quillspark.operators import gates as g
from quillspark.operators import segments
from quillspark.session import spread, table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query("""SELECT doc_id, array_to_string(list_filter([CASE WHEN NOT contains(text, '.') THEN 'missing:.' END, CASE WHEN contains(text, 'TODO') THEN 'forbidden:TODO' END, CASE WHEN contains(text, chr(65533)) THEN 'forbidden:' || chr(65533) END,
  CASE WHEN strpos(text, '## ') > 0 AND strpos(text, '### ') > 0 AND strpos(text, '### ') <= strpos(text, '## ') THEN 'order' END, CASE WHEN NOT regexp_matches(text, '[PDN][0-9]{4}') THEN 'pattern:paper' END], lambda z: z IS NOT NULL), ',') AS failures FROM documents WHERE text IS NOT NULL""")
def anchors_report(spark, d):
    r = g.anchor_report(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text", ["."], ["TODO", "\ufffd"], ["## ", "### "], {"paper": "[PDN][0-9]{4}"})
    return r.select("doc_id", F.array_join("failures", ",").alias("failures"))


@query(r"""SELECT flag, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN len(regexp_extract_all(text, '(?m)^\s*```')) % 2 = 1 THEN 'open_fence' END, CASE WHEN NOT regexp_matches(text, '(?m)^#{1,6}\s') THEN 'no_heading' END,
  CASE WHEN trim(regexp_replace(text, '^---\r?\n(?s:.*?)\r?\n---\r?\n?', '')) = '' THEN 'front_matter_only' END, CASE WHEN len(list_distinct(list_transform(regexp_extract_all(text, '(?m)^\|.*\|[ \t]*$'), lambda r: length(regexp_replace(replace(r, '\|', ''), '[^|]', '', 'g'))))) > 1 THEN 'ragged_table' END,
  CASE WHEN contains(text, chr(65533)) THEN 'replacement_chars' END], lambda z: z IS NOT NULL)) AS flag FROM (SELECT replace(text, chr(13) || chr(10), chr(10)) AS text FROM documents WHERE text IS NOT NULL)) GROUP BY 1""")
def structural_gates(spark, d):
    t = table(spark, d, "documents").select("doc_id", "text")
    return g.structural_gates(t, "doc_id", "text").select(F.explode("flags").alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


_A = """WITH x AS (SELECT {g} AS k, regexp_extract_all(lower(raw_latex), '[\\p{{L}}\\p{{N}}_]+') AS a, regexp_extract_all(lower(cleaned_text), '[\\p{{L}}\\p{{N}}_]+') AS b FROM standard_sections WHERE raw_latex IS NOT NULL AND cleaned_text IS NOT NULL),
  p AS (SELECT k, t, count(*) AS n FROM (SELECT k, unnest(a) AS t FROM x) GROUP BY ALL), q AS (SELECT k, t, count(*) AS m FROM (SELECT k, unnest(b) AS t FROM x) GROUP BY ALL),
  j AS (SELECT coalesce(p.k, q.k) AS k, sum(least(coalesce(n, 0), coalesce(m, 0))) AS both_, greatest(sum(coalesce(n, 0)), sum(coalesce(m, 0))) AS all_ FROM p FULL JOIN q ON p.k = q.k AND p.t = q.t GROUP BY 1) SELECT k AS {g}, round(both_ / all_, 9) AS agreement FROM j"""


@query(_A.format(g="id"))
def agreement_by_section(spark, d):
    return g.agreement_at(spread(table(spark, d, "standard_sections")), ["id"], "raw_latex", "cleaned_text").withColumn("agreement", F.round("agreement", 9))


@query(_A.format(g="draft_tag"))
def agreement_by_draft(spark, d):
    return g.agreement_at(spread(table(spark, d, "standard_sections")), ["draft_tag"], "raw_latex", "cleaned_text").withColumn("agreement", F.round("agreement", 9))


@query("""WITH w AS (SELECT p_partkey, p_name AS a, p_type AS b FROM part), t AS (SELECT p_partkey, CASE WHEN length(a) >= 3 THEN list_distinct([substring(a, i, 3) FOR i IN range(1, length(a) - 1)]) ELSE [] END AS x, CASE WHEN length(b) >= 3 THEN list_distinct([substring(b, i, 3) FOR i IN range(1, length(b) - 1)]) ELSE [] END AS y FROM w)
  SELECT p_partkey, round(CASE WHEN len(list_distinct(list_concat(x, y))) = 0 THEN 0 ELSE len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y))) END, 9) AS overlap FROM t""")
def trigram_overlap(spark, d):
    return table(spark, d, "part").select("p_partkey", F.round(g.ngram_overlap(F.col("p_name"), F.col("p_type")), 9).alias("overlap"))


@query("""WITH q AS (SELECT vec_id AS id, embedding AS e FROM embeddings WHERE vec_id % 50 = 0), s AS (SELECT q.id, max(list_sum(list_transform(list_zip(embedding, e), lambda z: z[1]::DOUBLE * z[2]::DOUBLE)) / (sqrt(list_sum(list_transform(embedding, lambda z: z::DOUBLE * z::DOUBLE))) * sqrt(list_sum(list_transform(e, lambda z: z::DOUBLE * z::DOUBLE))))) AS best FROM q JOIN embeddings x ON x.vec_id <> q.id GROUP BY 1)
  SELECT id, round(best, 6) AS best, CASE WHEN best < 0.5 THEN 'new' ELSE 'known' END AS verdict FROM s""")
def finding_dedup(spark, d):
    """Candidates (every fiftieth vector) that no other vector is as close to as the threshold."""
    e = spread(table(spark, d, "embeddings").select("vec_id", "embedding"))
    best = g.nearest_known(e, e.where("vec_id % 50 = 0"), "vec_id", "embedding", 0.5)
    return best.select(F.col("vec_id").alias("id"), F.round("best", 6).alias("best"), "verdict")


@query("""SELECT status, count(*) AS n, count(*) FILTER (error <> '') AS failed, count(*) FILTER (coalesce(markdown_path, '') <> '') AS ready FROM papers GROUP BY status""")
def status_summary(spark, d):
    p = table(spark, d, "papers")
    return p.groupBy("status").agg(F.count("*").alias("n"), F.count_if(F.col("error") != "").alias("failed"), F.count_if(F.coalesce("markdown_path", F.lit("")) != "").alias("ready"))


@query("SELECT task, avg((length(text) > 500)::INT) AS rate, count(*) AS n FROM benchmark WHERE text <> '' GROUP BY 1")
def pass_rate(spark, d):
    return table(spark, d, "benchmark").where("text <> ''").groupBy("task").agg(F.avg((F.length("text") > 500).cast("int")).alias("rate"), F.count("*").alias("n"))


@query("SELECT scrape_id, array_to_string(list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda z: list_position(w, z[1]) = z[2]), lambda z: z[1]), ' ') AS title FROM (SELECT scrape_id, string_split(lower(title), ' ') AS w FROM papers WHERE title IS NOT NULL)")
def ordered_distinct(spark, d):
    return table(spark, d, "papers").where("title is not null").select("scrape_id", F.array_join(F.array_distinct(F.split(F.lower("title"), " ", -1)), " ").alias("title"))


@query(r"""WITH w AS (SELECT id, list_distinct(regexp_extract_all(raw_latex, '\\i?ref\{([a-z.]+)\}', 1)) AS a, list_distinct(regexp_extract_all(cleaned_text, '\[([a-z]+(?:\.[a-z]+)+)\]', 1)) AS b FROM standard_sections WHERE raw_latex IS NOT NULL AND cleaned_text IS NOT NULL)
  SELECT id, len(list_intersect(a, b))::INT AS kept, len(list_filter(a, lambda z: NOT list_contains(b, z)))::INT AS lost, len(list_filter(b, lambda z: NOT list_contains(a, z)))::INT AS added FROM w""")
def reference_sets(spark, d):
    """Set algebra per row: references kept, lost and added by cleaning."""
    s = table(spark, d, "standard_sections").where("raw_latex is not null and cleaned_text is not null")
    a, b = F.array_distinct(F.regexp_extract_all("raw_latex", F.lit(r"\\i?ref\{([a-z.]+)\}"), F.lit(1))), F.array_distinct(F.regexp_extract_all("cleaned_text", F.lit(r"\[([a-z]+(?:\.[a-z]+)+)\]"), F.lit(1)))
    w = s.select("id", a.alias("a"), b.alias("b"))
    return w.select("id", F.size(F.array_intersect("a", "b")).alias("kept"), F.size(F.array_except("a", "b")).alias("lost"), F.size(F.array_except("b", "a")).alias("added"))


def _axes(expected: str, got: str) -> dict:
    """Similarity per block kind that the expected text has, and their mean."""
    a, b = segments.blocks(expected or ""), segments.blocks(got or "")
    out = {}
    for kind in sorted({x["kind"] for x in a}):
        p, q = [x["text"] for x in a if x["kind"] == kind], [x["text"] for x in b if x["kind"] == kind]
        same = sum(j - i for op, i, j, _, _ in similarity.aligned(p, q) if op == "equal")
        out[kind] = 2 * same / (len(p) + len(q))
    return out


@query()
def structure_compare(spark, d):
    """Block structure of each cleaned text against the one of its draft's latest row with the same label: score per axis and the worst axis."""
    from quillspark.operators.tables import last_occurrence

    s = table(spark, d, "standard_sections").where("cleaned_text is not null").select("draft_tag", "stable_label", "id", "cleaned_text")
    last = last_occurrence(s, ["draft_tag", "stable_label"], ["id"]).select("draft_tag", "stable_label", F.col("cleaned_text").alias("expected"))

    @F.pandas_udf("score double, worst string")
    def compare(expected: pd.Series, got: pd.Series) -> pd.DataFrame:
        rows = [_axes(a, b) for a, b in zip(expected, got)]
        return pd.DataFrame({"score": [sum(r.values()) / len(r) if r else 1.0 for r in rows], "worst": [min(r, key=lambda k: (r[k], k)) if r else None for r in rows]})

    j = spread(s).join(last, ["draft_tag", "stable_label"])
    return j.select("id", compare("expected", "cleaned_text").alias("c")).select("id", F.round("c.score", 6).alias("score"), "c.worst")


@query()
def gap_locator(spark, d):
    """Paragraphs of a section's source and cleaned text side by side: wrong, missing or extra, with the place."""

    @F.pandas_udf("array<struct<op:string,at:int,expected:string,got:string>>")
    def gaps(raw: pd.Series, cleaned: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(raw, cleaned):
            p, q = segments.paragraphs(a or ""), segments.paragraphs(b or "")
            name = {"replace": "wrong", "delete": "missing", "insert": "extra"}
            out.append([{"op": name[op], "at": i, "expected": "\n\n".join(p[i:j]), "got": "\n\n".join(q[k:m])} for op, i, j, k, m in similarity.aligned(p, q) if op != "equal"])
        return pd.Series(out)

    s = spread(table(spark, d, "standard_sections").where("raw_latex is not null and cleaned_text is not null").select("id", "raw_latex", "cleaned_text"))
    return s.select("id", F.explode(gaps("raw_latex", "cleaned_text")).alias("g")).select("id", "g.op", "g.at", "g.expected", "g.got")
