"""Queries of worklists, decisions over findings, merges of searches and grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions.text import stable_key
from quillspark.operators import decisions as x
from quillspark.operators import grids as g
from quillspark.operators import worklists as k
from quillspark.operators.retrieval import vector_topk
from quillspark.operators.routing import audience_bonus
from quillspark.session import spread, table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# ---------------------------------------------------------------- worklists


@query("""SELECT o_orderkey, status, row_number() OVER (PARTITION BY o_custkey ORDER BY status DESC, o_orderdate DESC, o_orderkey)::INT AS place FROM (SELECT *, (o_orderkey % 6 - 1)::INT AS status FROM orders) WHERE status >= 0 AND status < 3""")
def pending_worklist(spark, d):
    o = table(spark, d, "orders").withColumn("status", (F.col("o_orderkey") % 6 - 1).cast("int"))
    return k.placed(k.pending(o, "status", 3), ["o_custkey"], F.desc("status"), F.desc("o_orderdate"), F.col("o_orderkey")).select("o_orderkey", "status", "place")


@query("""SELECT o_orderkey, -(o_orderkey % 4 + 1) AS status, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 4 END AS failed_in FROM orders""")
def fail_decode(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", k.failed_status(F.col("o_orderkey") % 4).alias("status"))
    return o.select("o_orderkey", "status", k.failed_stage(F.when(F.col("o_orderkey") % 3 == 0, F.col("status")).otherwise(F.col("o_orderkey"))).alias("failed_in"))


_ART = ("source_file", "markdown_path", "dissect_path", "advocatus_path", "agora_path")
_THERE = "CASE " + " ".join(f"WHEN {' AND '.join(f'coalesce({a}, {chr(39)}{chr(39)}) <> {chr(39)}{chr(39)}' for a in _ART[:n])} THEN {n}" for n in range(len(_ART), 0, -1)) + " ELSE 0 END"


@query(f"SELECT scrape_id, coalesce(CAST(status AS VARCHAR), 'stage ' || ({_THERE})) AS status FROM (SELECT * REPLACE (CASE WHEN scrape_id % 2 = 0 THEN status END AS status) FROM papers)")
def status_backfill_case(spark, d):
    p = table(spark, d, "papers").withColumn("status", F.when(F.col("scrape_id") % 2 == 0, F.col("status")))
    return k.widened(p, "status", F.concat(F.lit("stage "), k.reached_stage(list(_ART)))).select("scrape_id", "status")


@query(f"SELECT scrape_id, ({_THERE}) AS reached, (status > ({_THERE}))::VARCHAR AS overstated FROM papers")
def truthful_status(spark, d):
    s = k.reached_stage(list(_ART))
    return table(spark, d, "papers").select("scrape_id", s.alias("reached"), (F.col("status") > s).cast("string").alias("overstated"))


@query("SELECT scrape_id, array_to_string(list_filter([" + ", ".join(f"CASE WHEN scrape_id % 5 <= {i} AND coalesce({a}, '') <> '' THEN '{a}' END" for i, a in enumerate(_ART)) + "], lambda z: z IS NOT NULL), ',') AS changed, CASE WHEN scrape_id % 5 <= 4 AND coalesce(agora_path, '') <> '' THEN '' ELSE agora_path END AS agora_path FROM papers")
def cascade_clear(spark, d):
    c = k.cleared(table(spark, d, "papers"), F.col("scrape_id") % 5, list(_ART))
    return c.select("scrape_id", F.array_join("changed", ",").alias("changed"), "agora_path")


@query("""WITH t AS (SELECT min(draft_tag) AS a, max(draft_tag) AS b FROM standard_sections) SELECT s.id, s.draft_tag, s.title FROM standard_sections s, t WHERE s.draft_tag IS NULL OR s.draft_tag <> t.b
  UNION ALL SELECT -s.id, t.b, upper(s.title) FROM standard_sections s, t WHERE s.draft_tag = t.a""")
def staged_swap(spark, d):
    """The sections of the first draft staged in place of the last one's."""
    s = table(spark, d, "standard_sections").select("id", "draft_tag", "title")
    ends = s.agg(F.min("draft_tag").alias("a"), F.max("draft_tag").alias("b"))
    staged = s.join(F.broadcast(ends), F.col("draft_tag") == F.col("a")).select((-F.col("id")).alias("id"), F.col("b").alias("draft_tag"), F.upper("title").alias("title"))  # one row
    return k.swapped(s, staged, "draft_tag")


@query("SELECT draft_tag, git_sha FROM drafts d WHERE NOT EXISTS (SELECT 1 FROM drafts s WHERE s.draft_tag = d.draft_tag AND CASE WHEN right(s.draft_tag, 1) IN ('0', '2', '4', '6', '8') THEN s.git_sha ELSE 'old' END = d.git_sha)")
def changed_sources(spark, d):
    s = table(spark, d, "drafts").select("draft_tag", "git_sha")
    seen = s.withColumn("git_sha", F.when(F.right("draft_tag", F.lit(1)).isin("0", "2", "4", "6", "8"), F.col("git_sha")).otherwise("old"))
    return k.changed_sources(s, seen, "draft_tag", "git_sha")


@query("SELECT id, draft_tag, stable_label FROM standard_sections WHERE depth = 0")
def chapters(spark, d):
    return table(spark, d, "standard_sections").where("depth = 0").select("id", "draft_tag", "stable_label")


@query("SELECT scrape_id, upper(trim(paper_id)) AS paper, title, 'papers/' || year || '/' || lower(trim(paper_id)) || '.html' AS link FROM papers WHERE coalesce(paper_id, '') <> ''")
def brief_rows(spark, d):
    p = table(spark, d, "papers").where("coalesce(paper_id, '') <> ''")
    return p.select("scrape_id", F.upper(F.trim("paper_id")).alias("paper"), "title", F.concat(F.lit("papers/"), "year", F.lit("/"), F.lower(F.trim("paper_id")), F.lit(".html")).alias("link"))


@query("SELECT event_type, count(*) AS n FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY 1")
def vocabulary_violations(spark, d):
    return k.outside_vocabulary(table(spark, d, "events"), "event_type", ["click", "view"])


@query(r"""SELECT scrape_id, target, CASE WHEN x = 'all' THEN 'all' WHEN regexp_matches(x, '^\d{4}$') THEN 'year' WHEN regexp_matches(x, '^\d{4}-\d{2}$') THEN 'month' WHEN regexp_matches(x, '^[a-z]+\d+(r\d+)?$') THEN 'paper' ELSE 'error' END AS kind
  FROM (SELECT scrape_id, target, lower(trim(target)) AS x FROM (SELECT scrape_id, unnest([year, substring(document_date, 1, 7), paper_id, ' ALL', title]) AS target FROM papers) WHERE target IS NOT NULL)""")
def target_kinds(spark, d):
    p = table(spark, d, "papers").select("scrape_id", F.explode(F.array("year", F.substring("document_date", 1, 7), "paper_id", F.lit(" ALL"), "title")).alias("target")).where("target is not null")
    return p.select("scrape_id", "target", k.target_kind(F.col("target")).alias("kind"))


@query("""SELECT o_orderkey FROM orders o WHERE o_orderstatus <> 'F' AND CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey END IS NULL AND EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'N')""")
def open_questions(spark, d):
    """Claims that are unproven, not merged into another one and have evidence."""
    o = table(spark, d, "orders").where("o_orderstatus <> 'F'").withColumn("merged_into", F.when(F.col("o_orderkey") % 7 == 0, F.col("o_orderkey"))).where("merged_into is null")
    return o.select("o_orderkey").join(table(spark, d, "lineitem").where("l_returnflag = 'N'").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi")


# ---------------------------------------------------------------- findings


@query("""WITH c AS (SELECT DISTINCT l_orderkey AS chunk, l_linenumber AS local FROM lineitem), q AS (SELECT l_orderkey AS chunk, l_linenumber + (l_orderkey % 5 = 0)::INT AS local, bool_or(l_returnflag = 'N') AS yes FROM lineitem WHERE l_linenumber <> 2 GROUP BY ALL)
  SELECT coalesce(c.chunk, q.chunk) AS chunk, coalesce(c.local, q.local) AS local, CASE WHEN c.chunk IS NULL THEN 'hallucinated' WHEN yes IS NULL THEN 'missing' WHEN yes THEN 'supported' ELSE 'unsupported' END AS state FROM c FULL JOIN q ON c.chunk = q.chunk AND c.local = q.local""")
def decided_claims(spark, d):
    li = table(spark, d, "lineitem")
    claims = li.select(F.col("l_orderkey").alias("chunk"), F.col("l_linenumber").alias("local"))
    said = li.where("l_linenumber <> 2").select(F.col("l_orderkey").alias("chunk"), (F.col("l_linenumber") + (F.col("l_orderkey") % 5 == 0).cast("int")).alias("local"), (F.col("l_returnflag") == "N").alias("yes"))
    return x.decided_claims(claims, said, "chunk", "local", "yes")


_SEV = "CASE WHEN substring(o_orderpriority, 1, 1) = '1' THEN 'critical' WHEN substring(o_orderpriority, 1, 1) IN ('2', '3') THEN 'significant' WHEN substring(o_orderpriority, 1, 1) = '4' THEN 'minor' ELSE 'other' END"


def _findings(spark, d):
    p = F.substring("o_orderpriority", 1, 1)
    return table(spark, d, "orders").withColumn("severity", F.when(p == "1", "critical").when(p.isin("2", "3"), "significant").when(p == "4", "minor").otherwise("other"))


@query(f"SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE severity WHEN 'critical' THEN 0 WHEN 'significant' THEN 1 WHEN 'minor' THEN 2 ELSE 3 END, o_orderkey)::INT AS number FROM (SELECT *, {_SEV} AS severity FROM orders)")
def severity_numbering(spark, d):
    return x.severity_numbers(_findings(spark, d), ["o_custkey"], "severity", "o_orderkey").select("o_orderkey", "number")


@query(f"SELECT severity, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, severity)::INT AS place FROM (SELECT {_SEV} AS severity FROM orders) GROUP BY 1")
def severity_counts(spark, d):
    n = _findings(spark, d).groupBy("severity").agg(F.count("*").alias("n"))  # a row for each of a closed set
    return k.placed(n, [], F.desc("n"), F.col("severity"))


@query("""WITH v AS (SELECT l_orderkey AS o_orderkey, bool_and(l_returnflag <> 'R') AS s FROM lineitem WHERE l_linenumber > 1 GROUP BY 1) SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN s IS NULL THEN 'unjudged' WHEN s THEN 'survived' ELSE 'killed' END AS outcome FROM orders LEFT JOIN v USING (o_orderkey)) GROUP BY 1""")
def cross_examined(spark, d):
    v = table(spark, d, "lineitem").where("l_linenumber > 1").select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_returnflag") != "R").alias("s"))
    return x.cross_examined(table(spark, d, "orders").select("o_orderkey"), v, "o_orderkey", "s").groupBy("outcome").agg(F.count("*").alias("n"))


@query(f"""WITH f AS (SELECT o_custkey, {_SEV} AS severity, o_orderkey % 9 = 0 AS touches, CASE WHEN o_orderkey % 4 = 0 THEN o_orderstatus END AS compound FROM orders WHERE o_orderkey % 3 <> 0), c AS (SELECT o_custkey, compound, row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, compound) AS k FROM f WHERE compound IS NOT NULL GROUP BY o_custkey, compound)
  SELECT g.o_custkey, CASE WHEN against THEN 'Undermined' WHEN cr + si > 0 THEN 'Weakened' ELSE 'Sound' END AS verdict, CASE WHEN NOT against AND cr = 0 AND si > 0 THEN 'Medium' ELSE 'High' END AS confidence, major, c.compound AS dominant
  FROM (SELECT o_custkey, count(*) FILTER (severity = 'critical') AS cr, count(*) FILTER (severity = 'significant') AS si, bool_or(severity = 'critical' AND touches) AS against, count(*) FILTER (touches OR compound IS NOT NULL) AS major FROM f GROUP BY 1) g LEFT JOIN c ON c.o_custkey = g.o_custkey AND c.k = 1""")
def verdict_synthesis(spark, d):
    f = _findings(spark, d).where("o_orderkey % 3 <> 0").select("o_custkey", "severity", (F.col("o_orderkey") % 9 == 0).alias("touches"), F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderstatus")).alias("compound"))
    return x.verdicts(f, "o_custkey", "severity", "touches", "compound")


_STOP = "[" + ", ".join(f"'{w}'" for w in ("", *x.STOP_WORDS)) + "]"
_CONTENT = "list_filter(list_distinct(regexp_split_to_array(lower(coalesce({0}, '')), '\\s+')), lambda w: NOT list_contains(" + _STOP + ", w))"


@query(f"""WITH w AS (SELECT id, {_CONTENT.format("title")} AS a, {_CONTENT.format("cleaned_text")} AS b, CASE WHEN id % 3 = 0 THEN 'critical' WHEN id % 3 = 1 THEN 'significant' ELSE 'other' END AS severity FROM standard_sections),
  s AS (SELECT id, severity, CASE WHEN len(a) = 0 OR len(b) = 0 THEN 0.0 ELSE len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) END AS jaccard, len(list_intersect(a, b)) AS shared FROM w)
  SELECT id, round(jaccard, 9) AS jaccard, shared::INT AS shared, CASE WHEN severity = 'significant' AND jaccard >= 0.25 AND shared >= 3 THEN 'critical' ELSE severity END AS severity FROM s""")
def gap_upgrade(spark, d):
    """Severity of each section's gap against its title, by shared words."""
    s = table(spark, d, "standard_sections")
    jaccard, shared = x.word_overlap(F.col("title"), F.col("cleaned_text"))
    sev = F.when(F.col("id") % 3 == 0, "critical").when(F.col("id") % 3 == 1, "significant").otherwise("other")
    return s.select("id", F.round(jaccard, 9).alias("jaccard"), shared.alias("shared"), x.raised_severity(sev, None, jaccard, shared).alias("severity"))


@query(f"SELECT doc_id, len({_CONTENT.format('text')})::INT AS words FROM documents WHERE text IS NOT NULL")
def content_word_counts(spark, d):
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.size(x.content_words(F.col("text"))).alias("words"))


@query("""WITH a AS (SELECT c_custkey, list_distinct(list(o_orderpriority)) AS p, list_distinct(list(o_orderpriority) FILTER (o_orderstatus = 'F')) AS q FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1)
  SELECT c_custkey, round(CASE WHEN len(list_distinct(list_concat(coalesce(list_filter(p, lambda z: z IS NOT NULL), []), coalesce(q, [])))) = 0 THEN 0.0 ELSE len(list_intersect(coalesce(p, []), coalesce(q, []))) / len(list_distinct(list_concat(coalesce(list_filter(p, lambda z: z IS NOT NULL), []), coalesce(q, [])))) END, 9) AS jaccard FROM a""")
def set_similarity(spark, d):
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.collect_set("o_orderpriority").alias("p"), F.collect_set(F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))).alias("q"))
    none = F.array().cast("array<string>")
    return table(spark, d, "customer").join(o, "c_custkey", "left").select("c_custkey", F.round(x.set_jaccard(F.coalesce("p", none), F.coalesce("q", none)), 9).alias("jaccard"))


@query("""SELECT user_id, unnest(list_filter([CASE WHEN p >= 10 AND m < 20 THEN 'unmeasured' END, CASE WHEN e >= 10 AND p < 20 THEN 'unread' END], lambda z: z IS NOT NULL)) AS flag FROM (SELECT user_id, count(*) FILTER (event_type = 'purchase') AS p, count(*) FILTER (event_type = 'click') AS m, count(*) FILTER (event_type = 'error') AS e FROM events GROUP BY 1)""")
def cross_reference_rules(spark, d):
    n = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return x.cross_reference_flags(n, "user_id", "event_type", "n", [("unmeasured", "purchase", 10, "click", 20), ("unread", "error", 10, "purchase", 20)])


@query("SELECT paper_id, count(DISTINCT (doc_id, chunk_index)) AS chunks FROM chunk_entries GROUP BY 1")
def chunk_counts(spark, d):
    return table(spark, d, "chunk_entries").groupBy("paper_id").agg(F.countDistinct("doc_id", "chunk_index").alias("chunks"))


@query("""WITH t AS (SELECT user_id, list_sort(list_distinct(list(event_type) FILTER (value > 10))) AS a, list_sort(list_distinct(list(event_type) FILTER (event_id % 3 = 0))) AS b FROM events GROUP BY 1)
  SELECT count(*) AS users, count(*) FILTER (coalesce(a, []) = coalesce(b, [])) AS exact FROM t""")
def exact_match(spark, d):
    """Users whose predicted label sets are exactly the true ones."""
    e = table(spark, d, "events")
    s = e.groupBy("user_id").agg(F.sort_array(F.collect_set(F.when(F.col("value") > 10, F.col("event_type")))).alias("a"), F.sort_array(F.collect_set(F.when(F.col("event_id") % 3 == 0, F.col("event_type")))).alias("b"))
    return s.agg(F.count("*").alias("users"), F.count_if(F.col("a") == F.col("b")).alias("exact"))


# ---------------------------------------------------------------- searches

_COS = """q AS (SELECT vec_id AS qid, embedding AS qe FROM embeddings WHERE vec_id % 50 = 0), p AS (SELECT qid, vec_id, label, list_sum(list_transform(list_zip(embedding, qe), lambda z: z[1]::DOUBLE * z[2]::DOUBLE)) / (sqrt(list_sum(list_transform(embedding, lambda z: z::DOUBLE * z::DOUBLE))) * sqrt(list_sum(list_transform(qe, lambda z: z::DOUBLE * z::DOUBLE)))) AS s FROM embeddings, q),
  g AS (SELECT *, row_number() OVER (PARTITION BY qid, label ORDER BY s DESC, vec_id) AS k FROM p WHERE s >= 0.1), t AS (SELECT qid, vec_id, s, row_number() OVER (PARTITION BY qid ORDER BY s DESC, vec_id) AS place FROM g WHERE k <= 2)"""


@query(f"WITH {_COS}, m AS (SELECT qid % 100 AS batch, vec_id, max(s) AS s FROM t WHERE place <= 3 GROUP BY ALL) SELECT batch, vec_id, round(s, 6) AS score, place FROM (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY s DESC, vec_id)::INT AS place FROM m) WHERE place <= 5")
def multi_query_merge(spark, d):
    """A top-k search: the hits of several queries merged, the five best of each batch."""
    e = spread(table(spark, d, "embeddings").select("vec_id", "embedding", "label"))
    t = vector_topk(e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("qid"), "embedding"), "qid", e, "vec_id", "embedding", 3, least=0.1, group="label", per_group=2)
    return x.merged_hits(t.withColumn("batch", F.col("qid") % 100), "batch", "vec_id", "score", 5).withColumn("score", F.round("score", 6))


@query("SELECT DISTINCT from_label, to_label FROM section_xrefs WHERE from_label <> to_label AND to_label IN (SELECT stable_label FROM standard_sections WHERE stable_label IS NOT NULL)")
def indexed_targets(spark, d):
    s = table(spark, d, "standard_sections").select(F.col("stable_label").alias("to_label"))
    return x.indexed_targets(table(spark, d, "section_xrefs"), "from_label", "to_label", s)


_BUDGET = "SELECT doc_id, chunk_index, greatest(coalesce(max(char_count), 0), 0) AS n FROM chunk_entries GROUP BY ALL"


@query(f"""WITH r AS (SELECT doc_id, sum(n) OVER (PARTITION BY doc_id ORDER BY chunk_index ROWS UNBOUNDED PRECEDING) AS s FROM ({_BUDGET})), b AS (SELECT unnest(['research', 'challenge', 'check']) AS budget, unnest([3000, 600, 4000]) AS most)
  SELECT doc_id, budget, count(*) FILTER (s <= most) AS n, coalesce(max(s) FILTER (s <= most), 0)::BIGINT AS used FROM r, b GROUP BY ALL""")
def evidence_budgets(spark, d):
    c = table(spark, d, "chunk_entries").groupBy("doc_id", "chunk_index").agg(F.greatest(F.coalesce(F.max("char_count"), F.lit(0)), F.lit(0)).cast("long").alias("n"))
    return x.within_budgets(c, ["doc_id"], ["chunk_index"], "n", {"research": 3000, "challenge": 600, "check": 4000})


def _phrase(*words: str) -> str:
    return "(" + " OR ".join(f"regexp_matches(a, '(^|[^A-Z0-9_]){w}($|[^A-Z0-9_])')" for w in words) + ")"


@query(f"""SELECT scrape_id, round(CASE WHEN {_phrase("LIBRARY EVOLUTION", "LEWG")} THEN 0.20 WHEN {_phrase("LIBRARY", "LWG")} THEN 0.15 ELSE 0.0 END, 9) AS "LEWG", round(CASE WHEN {_phrase("LIBRARY EVOLUTION", "LEWG", "LIBRARY", "LWG")} THEN 0.10 ELSE 0.0 END, 9) AS "LWG",
  round(CASE WHEN {_phrase("CORE", "CWG")} THEN 0.10 WHEN {_phrase("EVOLUTION", "EWG")} AND NOT {_phrase("LIBRARY EVOLUTION")} THEN 0.20 ELSE 0.0 END, 9) AS "EWG", round(CASE WHEN {_phrase("CORE", "CWG")} THEN 0.15 ELSE 0.0 END, 9) AS "CWG" FROM (SELECT scrape_id, upper(coalesce(target_group, '')) AS a FROM papers)""")
def audience_additions(spark, d):
    p = table(spark, d, "papers").select("scrape_id", "target_group", *[F.lit(0.0).alias(c) for c in ("LEWG", "LWG", "EWG", "CWG")])
    return audience_bonus(p, "target_group").select("scrape_id", *[F.round(c, 9).alias(c) for c in ("LEWG", "LWG", "EWG", "CWG")])


_CLAIMS = [("c1", "the argument is complete"), ("c2", "an implementation may annotate the object"), ("c3", "the rule and the wording of the list"), ("c4", "zebra quilt")]
_CLAIM_SQL = " UNION ALL ".join(f"SELECT '{k_}' AS claim, '{t}' AS c" for k_, t in _CLAIMS)


@query(f"""WITH c AS ({_CLAIM_SQL}), p AS (SELECT item_id, claim, {_CONTENT.format("text")} AS a, {_CONTENT.format("c")} AS b FROM benchmark, c) SELECT item_id, claim, round(score, 9) AS score FROM (SELECT item_id, claim, CASE WHEN len(a) = 0 OR len(b) = 0 THEN 0.0 ELSE len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) END AS score FROM p) WHERE score >= 0.02""")
def scored_claims(spark, d):
    """Items against a small set of claims by the scorer of shared words, in place of a model."""
    c = spark.createDataFrame(_CLAIMS, "claim string, c string")
    s = x.scored_pairs(table(spark, d, "benchmark"), "item_id", "text", c, "claim", "c", lambda a, b: x.word_overlap(a, b)[0], 0.02)
    return s.withColumn("score", F.round("score", 9))


# ---------------------------------------------------------------- threads

_ROLE = "CASE event_type WHEN 'purchase' THEN 'teaser' WHEN 'click' THEN 'signal' ELSE 'noise' END"


def _slots(spark, d):
    role = F.when(F.col("event_type") == "purchase", "teaser").when(F.col("event_type") == "click", "signal").otherwise("noise")
    chain = F.when(F.col("event_id") % 5 == 0, F.col("event_id") % 3)
    return table(spark, d, "events").select("user_id", "event_id", role.alias("role"), chain.alias("chain"), (F.col("event_id") % 7).alias("turn"), (F.col("event_id") - F.col("event_id") % 1000).alias("parent"))


@query(f"SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN chain IS NOT NULL THEN 1 WHEN role = 'teaser' THEN 0 WHEN role = 'signal' THEN 2 ELSE 3 END, chain NULLS FIRST, turn, event_id)::INT AS place FROM (SELECT user_id, event_id, {_ROLE} AS role, CASE WHEN event_id % 5 = 0 THEN event_id % 3 END AS chain, event_id % 7 AS turn FROM events)")
def generation_order(spark, d):
    return x.generation_order(_slots(spark, d), "user_id", "event_id", "role", "chain", "turn").select("event_id", "place")


@query(f"WITH s AS (SELECT event_id, (event_id // 1000) AS t, {_ROLE} AS role FROM events) SELECT a.event_id, min(b.event_id) AS child FROM s a JOIN s b ON b.t = a.t AND b.event_id - b.event_id % 1000 = a.event_id AND b.role IN ('signal', 'teaser') WHERE a.role = 'noise' GROUP BY 1")
def trap_pairs(spark, d):
    s = _slots(spark, d).withColumn("t", F.floor(F.col("event_id") / 1000))
    return x.first_children(s, "t", "event_id", "parent", F.col("role") == "noise", F.col("role").isin("signal", "teaser")).select("event_id", "child")


_KEY = "('0x' || substr(sha256({0}), 1, 16))::UBIGINT"


@query(f"""WITH s AS (SELECT user_id, event_id, {_KEY.format("user_id || ':edited'")} AS k, {_KEY.format("user_id || ':edited:' || event_id")} AS h FROM events WHERE event_type = 'click') SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY h, event_id) AS n FROM s WHERE k % 2 = 0) WHERE n = 1""")
def edited_slots(spark, d):
    return x.marked_slots(_slots(spark, d), "user_id", "event_id", F.col("role") == "signal", stable_key)


_NEAR = {0: 1, 1: 2, 2: 0, 3: 4, 4: 3}


@query("SELECT n_nationkey, CASE n_regionkey WHEN 0 THEN 2 WHEN 1 THEN 2 WHEN 2 THEN 2 END AS pool FROM nation")
def nearest_pool(spark, d):
    """The pool of each nation's region, found along the fallback map; null where the way turns round."""
    way = {r: x.nearest_known(_NEAR, {2}, r) for r in _NEAR}
    m = F.create_map(*[F.lit(v).cast("int") for r, p in way.items() for v in (r, p)])
    return table(spark, d, "nation").select("n_nationkey", m[F.col("n_regionkey")].alias("pool"))


# ---------------------------------------------------------------- grids


def _grid(spark, d):
    """Each order's lines as a grid of four columns."""
    li = table(spark, d, "lineitem")
    one = F.when(F.col("l_linenumber") == 3, "").otherwise(F.col("l_returnflag"))
    cols = F.array(F.concat(F.lit("["), F.col("l_partkey") % 9, F.lit("]")), one, F.when(F.col("l_orderkey") % 4 == 0, F.lit("a rather long text of more than twelve words that stands in a cell of this grid")).otherwise(F.col("l_linestatus")), F.col("l_quantity").cast("int").cast("string"))
    cells = li.select(F.col("l_orderkey").alias("t"), (F.col("l_linenumber") - 1).alias("r"), F.posexplode(F.when(F.col("l_orderkey") % 8 == 0, F.slice(cols, 2, 2)).otherwise(cols)).alias("c", "text"))
    return cells


_CELLS = """(SELECT l_orderkey AS t, l_linenumber - 1 AS r, unnest(range(len(v))) AS c, unnest(v) AS text FROM (SELECT *, CASE WHEN l_orderkey % 8 = 0 THEN u[2:3] ELSE u END AS v FROM (SELECT *, ['[' || l_partkey % 9 || ']', CASE WHEN l_linenumber = 3 THEN '' ELSE l_returnflag END, CASE WHEN l_orderkey % 4 = 0 THEN 'a rather long text of more than twelve words that stands in a cell of this grid' ELSE l_linestatus END, floor(l_quantity)::INT::VARCHAR] AS u FROM lineitem)))"""


@query(f"""WITH x AS (SELECT *, CASE WHEN trim(text) = '' THEN 0 ELSE len(regexp_split_to_array(trim(text), '\\s+')) END AS w FROM {_CELLS}), z AS (SELECT t, count(*) AS rows_, max(n) AS cols, count(DISTINCT n) AS widths FROM (SELECT t, r, count(*) AS n FROM x GROUP BY ALL) GROUP BY 1),
  a AS (SELECT t, count(*) FILTER (w = 0) / count(*) AS e, max(w) AS most, max(w) FILTER (c = 0) AS kw, count(*) FILTER (c = 0 AND w > 0 AND regexp_matches(trim(text), '^\\[[^\\[\\]]+\\]$')) / greatest(count(*) FILTER (c = 0 AND w > 0), 1) AS lab FROM x GROUP BY 1)
  SELECT t, CASE WHEN e > 0.5 OR widths > 2 THEN 'false_positive' WHEN lab >= 0.6 AND rows_ >= 2 THEN 'bibliography' WHEN cols = 2 AND kw <= 4 AND most > 12 THEN 'key_value' WHEN most > 12 THEN 'prose' ELSE 'matrix' END AS kind FROM a JOIN z USING (t)""")
def table_kinds(spark, d):
    return g.table_kinds(_grid(spark, d), "t")


@query("""SELECT t, r, 0 AS c FROM (SELECT l_orderkey AS t, l_linenumber - 1 AS r, max(l_returnflag) AS f, max(CASE WHEN l_returnflag = 'R' THEN 'A' ELSE l_returnflag END) AS o FROM lineitem WHERE l_orderkey % 6 = 0 GROUP BY ALL) WHERE f <> o""")
def reading_differences(spark, d):
    """A second reading that has 'A' for 'R', of every third table and of another shape for the odd ones."""
    li = table(spark, d, "lineitem").where("l_orderkey % 3 = 0").select(F.col("l_orderkey").alias("t"), (F.col("l_linenumber") - 1).alias("r"), F.lit(0).alias("c"), F.col("l_returnflag").alias("text"))
    other = li.select("t", F.when(F.col("t") % 2 == 0, F.col("r")).otherwise(F.col("r") + 1).alias("r"), "c", F.when(F.col("text") == "R", "A").otherwise(F.concat(F.lit(" "), "text")).alias("text"))
    return g.reading_differences(li.withColumn("reading", F.lit(0)).unionByName(other.withColumn("reading", F.lit(1))), "t", "reading")


@query("""SELECT event_id, CASE WHEN value > 30 THEN 'L0' WHEN event_type = 'error' THEN 'L4' WHEN user_id % 3 = 0 THEN 'L3' WHEN event_type = 'view' THEN 'L1' ELSE 'L2' END AS level FROM events""")
def trust_levels(spark, d):
    lvl = g.trust_level(F.col("value") > 30, F.col("event_type") == "error", F.col("user_id") % 3 == 0, F.col("event_type") == "view")
    return table(spark, d, "events").select("event_id", lvl.alias("level"))


@query("""WITH p AS (SELECT l_orderkey AS doc, l_linenumber AS page, l_suppkey % 2 AS cols, CASE WHEN l_quantity > 25 THEN l_linestatus END AS header, l_returnflag = 'A' AS gap, l_partkey * 100000 + l_suppkey AS place FROM lineitem),
  f AS (SELECT *, coalesce(page = lag(page) OVER w + 1 AND cols = lag(cols) OVER w AND NOT gap AND (header IS NULL OR coalesce(header = lag(header) OVER w, false)), false) AS follows, coalesce(header = lag(header) OVER w, false) AS same FROM p WINDOW w AS (PARTITION BY doc ORDER BY page, place))
  SELECT doc, page, (follows AND same)::VARCHAR AS repeats, sum((NOT follows)::INT) OVER (PARTITION BY doc ORDER BY page, place)::BIGINT AS tab FROM f""")
def stitched_tables(spark, d):
    p = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("page"), (F.col("l_partkey") * 100000 + F.col("l_suppkey")).alias("place"), (F.col("l_suppkey") % 2).alias("cols"), F.when(F.col("l_quantity") > 25, F.col("l_linestatus")).alias("header"), (F.col("l_returnflag") == "A").alias("gap"))
    return g.stitched(p, "doc", "page", "place", "cols", "header", "gap").select("doc", "page", F.col("repeats").cast("string").alias("repeats"), F.col("table").alias("tab"))


@query()
def flagged_tables(spark, d):
    """Sanity flags of each order's grid."""
    return g.flagged_tables(_grid(spark, d), "t")
