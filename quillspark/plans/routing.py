"""Queries of routing, segmentation and retrieval."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillspark.operators import retrieval as v
from quillspark.operators import routing as r
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


@query()
def md_units(spark, d):
    return r.units(docs(spark, d))


@query()
def routed_documents(spark, d):
    return r.route(docs(spark, d))


@query()
def quadrant_scores(spark, d):
    return r.arbitrated(r.quadrant_scores(checkpointed(r.tagged_units(r.units(docs(spark, d))))))


# the SQL engine has no lookahead: what must not follow is taken out of the heading before the rest is looked for
_AFTER = r"(?!\s+of\s+this\s+document)"
_HEADS = [(k, "(?i)" + p.replace(_AFTER, ""), _AFTER in p) for k, p in r.HEADINGS]
_CASES = " ".join(f"WHEN regexp_matches({'e' if cut else 'h'}, '{p}') THEN '{k}'" for k, p, cut in _HEADS)


@query(f"""SELECT section, count(*) AS n FROM (SELECT CASE {_CASES} ELSE 'PREAMBLE' END AS section FROM (SELECT h, regexp_replace(h, '(?i)\\bdesign\\s+of\\s+this\\s+document', '', 'g') AS e FROM (SELECT regexp_replace(line, '^#+\\s*', '') AS h FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) WHERE regexp_matches(line, '^#{{1,6}}\\s')))) GROUP BY 1""")
def section_types(spark, d):
    h = table(spark, d, "documents").where("text is not null").select(F.explode(F.split("text", "\n", -1)).alias("line")).where(F.col("line").rlike(r"^#{1,6}\s"))
    return h.groupBy(r.section_type(F.regexp_replace("line", r"^#+\s*", "")).alias("section")).agg(F.count("*").alias("n"))


# word characters and blanks are ASCII's in the SQL engine, so those beyond it are replaced by ASCII ones there
_PLAIN = "regexp_replace(regexp_replace({0}, '[\\x{{aa}}\\x{{b5}}\\x{{ba}}\\x{{c0}}-\\x{{d6}}\\x{{d8}}-\\x{{f6}}\\x{{f8}}-\\x{{2c1}}\\x{{300}}-\\x{{1fff}}\\x{{fb00}}-\\x{{fb06}}]', '_', 'g'), '[\\x{{85}}\\x{{a0}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]', ' ', 'g')"
_FLAGS = ", ".join("CASE WHEN regexp_matches(line, '" + ("(?i)" if fold else "") + p.replace("'", "''") + f"') THEN '{k}' END" for k, (fold, p) in r.CATALOGUE.items())


@query(f"""SELECT hit, count(*) AS n FROM (SELECT unnest(list_filter([{_FLAGS}], lambda z: z IS NOT NULL)) AS hit FROM (SELECT {_PLAIN.format("unnest(string_split(replace(text, chr(13) || chr(10), chr(10)), chr(10)))")} AS line FROM documents WHERE text IS NOT NULL)) GROUP BY 1""")
def hypothesis_hits(spark, d):
    """Catalogue hits by line of all texts."""
    return docs(spark, d).where("text is not null").select(F.explode(F.split("text", "\r?\n", -1)).alias("line")).withColumn("low", F.lower("line")).select(F.explode(r.hits(F.col("line"), F.col("low"))).alias("hit")).groupBy("hit").agg(F.count("*").alias("n"))


@query("""SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)we propose|this paper proposes|poll') THEN 'analyze' WHEN length(text) > 300000 AND w > 0.5 THEN 'skip_wording' WHEN length(text) > 300000 THEN 'skip_long' ELSE 'analyze' END AS verdict FROM (SELECT doc_id, text, (len(string_split(lower(text), 'shall')) - 1) / greatest(length(text), 1) AS w FROM documents WHERE text IS NOT NULL)""")
def triage(spark, d):
    t = table(spark, d, "documents").where("text is not null")
    ratio = (F.size(F.split(F.lower("text"), "shall", -1)) - 1) / F.greatest(F.length("text"), F.lit(1))
    return t.select("doc_id", r.triage(F.col("text").rlike("(?i)we propose|this paper proposes|poll"), F.length("text"), ratio).alias("verdict"))


@query("""WITH e AS (SELECT user_id, event_type, count(*) AS n, avg((value > 10)::INT) AS a, avg((event_id % 3 = 0)::INT) AS b, avg((event_id % 5 = 0)::INT) AS c FROM events GROUP BY ALL), m AS (SELECT *, n / sum(n) OVER (PARTITION BY user_id) AS mass FROM e)
  SELECT user_id, round(sum(least(a, b) * mass), 9) AS x, round(sum(0.5 * least(a, c) * mass), 9) AS y FROM m GROUP BY 1""")
def weighted_min_density(spark, d):
    e = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.avg((F.col("value") > 10).cast("int")).alias("a"), F.avg((F.col("event_id") % 3 == 0).cast("int")).alias("b"), F.avg((F.col("event_id") % 5 == 0).cast("int")).alias("c"))
    e = e.withColumn("mass", F.col("n") / F.sum("n").over(Window.partitionBy("user_id")))
    return e.groupBy("user_id").agg(F.round(F.sum(F.least("a", "b") * F.col("mass")), 9).alias("x"), F.round(F.sum(0.5 * F.least("a", "c") * F.col("mass")), 9).alias("y"))


_BM = """t AS (SELECT doc_id, {0} AS size, {1} AS t0, {2} AS t1 FROM (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}_:<>]+') AS a, regexp_extract_all(lower(coalesce(source, '')), '[\\p{{L}}\\p{{N}}_:<>]+') AS b FROM documents)),
  s AS (SELECT count(*) AS n, avg(size) AS av, count(*) FILTER (t0 > 0) AS d0, count(*) FILTER (t1 > 0) AS d1 FROM t)""".format(
    "len(a) + len(b)", "len(list_filter(a, lambda z: z = 'allocator')) + 5.0 * len(list_filter(b, lambda z: z = 'allocator'))", "len(list_filter(a, lambda z: z = 'buffer')) + 5.0 * len(list_filter(b, lambda z: z = 'buffer'))"
)


@query(f"""WITH {_BM} SELECT doc_id, round(score, 6) AS score FROM (SELECT doc_id, -(greatest(ln((n - d0 + 0.5) / (d0 + 0.5)), 1e-6) * t0 * 2.2 / (t0 + 1.2 * (0.25 + 0.75 * size / av)) + greatest(ln((n - d1 + 0.5) / (d1 + 0.5)), 1e-6) * t1 * 2.2 / (t1 + 1.2 * (0.25 + 0.75 * size / av))) AS score FROM t, s WHERE t0 > 0 AND t1 > 0) ORDER BY round(score, 9), doc_id LIMIT 25""")
def bm25_topk(spark, d):
    """A top-k report: full-text search over two weighted fields."""
    return v.bm25(spread(table(spark, d, "documents").select("doc_id", "text", "source")), "doc_id", {"text": 1.0, "source": 5.0}, ["allocator", "Buffer"], 25).withColumn("score", F.round("score", 6))


_COS = """q AS (SELECT vec_id AS qid, embedding AS qe FROM embeddings WHERE vec_id % 50 = 0), p AS (SELECT qid, vec_id, label, list_sum(list_transform(list_zip(embedding, qe), lambda z: z[1]::DOUBLE * z[2]::DOUBLE)) / (sqrt(list_sum(list_transform(embedding, lambda z: z::DOUBLE * z::DOUBLE))) * sqrt(list_sum(list_transform(qe, lambda z: z::DOUBLE * z::DOUBLE)))) AS s FROM embeddings, q),
  g AS (SELECT *, row_number() OVER (PARTITION BY qid, label ORDER BY s DESC, vec_id) AS k FROM p WHERE s >= 0.1), t AS (SELECT qid, vec_id, s, row_number() OVER (PARTITION BY qid ORDER BY s DESC, vec_id) AS place FROM g WHERE k <= 2)"""


def _top(spark, d):
    e = spread(table(spark, d, "embeddings").select("vec_id", "embedding", "label"))
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("qid"), "embedding")
    return v.vector_topk(q, "qid", e, "vec_id", "embedding", 8, least=0.1, group="label", per_group=2)


@query(f"WITH {_COS} SELECT qid, vec_id, round(s, 6) AS score, place::INT AS place FROM t WHERE place <= 8")
def topk_cosine_capped(spark, d):
    """A top-k search: every fiftieth vector against all, at most two of a label."""
    return _top(spark, d).withColumn("score", F.round("score", 6))


@query(f"WITH {_COS}, l AS (SELECT qid, vec_id, place FROM t WHERE place <= 8 UNION ALL SELECT qid, vec_id, row_number() OVER (PARTITION BY qid ORDER BY vec_id) FROM t WHERE place <= 8) SELECT qid, vec_id, round(sum(1.0 / (60 + place - 1)), 9) AS score FROM l GROUP BY ALL")
def rrf_fusion(spark, d):
    t = _top(spark, d).select("qid", "vec_id", "place")
    by_id = t.withColumn("place", F.row_number().over(Window.partitionBy("qid").orderBy("vec_id")))
    return v.rank_fusion(t.unionByName(by_id), "qid", "vec_id", "place").withColumn("score", F.round("score", 9))


@query("""SELECT doc_id, CASE WHEN p > 0 THEN substring(text, greatest(1, p - 100), 200) ELSE substring(text, 1, 200) END AS snippet FROM (SELECT doc_id, text, strpos(lower(text), 'allocator') AS p FROM documents WHERE text IS NOT NULL)""")
def snippets(spark, d):
    return table(spark, d, "documents").where("text is not null").select("doc_id", v.snippet(F.col("text"), "allocator").alias("snippet"))
