"""Ordered-sequence queries over lines, sections and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.operators import sequence as s
from quillspark.session import spread, table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_LINES = "(SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS pos FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL))"
_NONEMPTY = f"(SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k FROM {_LINES} WHERE line <> '')"


def lines(spark, d):
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))


@query(f"""SELECT doc_id, section, count(*) AS n, sum(length(line))::BIGINT AS chars FROM (SELECT doc_id, line, coalesce(last_value(CASE WHEN regexp_matches(line, '^#{{1,6}} ') THEN regexp_replace(line, '^#+ +', '') END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos), 'PREAMBLE') AS section FROM {_LINES}) GROUP BY ALL""")
def carry_forward(spark, d):
    x = lines(spark, d).withColumn("head", F.when(F.col("line").rlike("^#{1,6} "), F.regexp_replace("line", "^#+ +", "")))
    x = s.carry_forward(x, ["doc_id"], ["pos"], "head", "section", "PREAMBLE")
    return x.groupBy("doc_id", "section").agg(F.count("*").alias("n"), F.sum(F.length("line")).alias("chars"))


@query(f"""SELECT doc_id, count(*) AS blanked FROM (SELECT doc_id, coalesce(last_value(CASE WHEN regexp_matches(lower(line), '^#+ .*(references|acknowledg|appendix)') THEN true WHEN regexp_matches(line, '^#+ ') THEN false END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos), false) AS b FROM {_LINES}) WHERE b GROUP BY doc_id""")
def blanking_fill(spark, d):
    head, aside = F.col("line").rlike("^#+ "), F.lower("line").rlike("^#+ .*(references|acknowledg|appendix)")
    x = s.open_blocks(lines(spark, d), ["doc_id"], ["pos"], aside, head & ~aside, "b")
    return x.where("b").groupBy("doc_id").agg(F.count("*").alias("blanked"))


@query("""SELECT user_id, event_id FROM (SELECT *, (a AND b) OR (coalesce(lag(event_type) OVER w = event_type, false) AND coalesce((a AND lag(b) OVER w) OR (b AND lag(a) OVER w), false)) OR (coalesce(lead(event_type) OVER w = event_type, false) AND coalesce((a AND lead(b) OVER w) OR (b AND lead(a) OVER w), false)) AS hit
  FROM (SELECT *, value > 10 AS a, event_id % 3 = 0 AS b FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE hit""")
def sustained_cofire(spark, d):
    e = table(spark, d, "events").withColumn("a", F.col("value") > 10).withColumn("b", F.col("event_id") % 3 == 0)
    return s.neighbours_cofire(e, ["user_id"], ["ts", "event_id"], "event_type", "a", "b", "hit").where("hit").select("user_id", "event_id")


@query("""SELECT draft_tag, id, level, previous FROM (SELECT draft_tag, id, depth + 1 AS level, lag(depth + 1) OVER (PARTITION BY draft_tag ORDER BY id) AS previous FROM standard_sections WHERE depth IS NOT NULL) WHERE level > previous + 1""")
def heading_jumps(spark, d):
    """Sections that lie more than a level below the one before them."""
    h = table(spark, d, "standard_sections").where("depth is not null").select("draft_tag", "id", (F.col("depth") + 1).alias("level"))
    return s.level_jumps(h, ["draft_tag"], ["id"], "level")


@query("SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS k FROM events) WHERE k <= 3")
def stratified_prefix(spark, d):
    return s.prefix_sample(table(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"], 3).select("user_id", "event_id")


@query("""WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL), a AS (SELECT *, sum(n) OVER (PARTITION BY user_id)::BIGINT AS alln FROM c), b AS (SELECT *, least(30, alln) AS seats FROM a),
  f AS (SELECT *, (seats * n) // alln AS fl, (seats * n) % alln AS rem FROM b), k AS (SELECT *, seats - sum(fl) OVER (PARTITION BY user_id) AS lft, row_number() OVER (PARTITION BY user_id ORDER BY rem DESC, event_type) AS k FROM f)
  SELECT user_id, event_type, n, least(n, fl + CASE WHEN k <= lft THEN 1 ELSE 0 END)::BIGINT AS quota FROM k""")
def hamilton_quota(spark, d):
    c = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return s.largest_remainder(c, ["user_id"], "event_type", "n", 30)


@query("""WITH o AS (SELECT DISTINCT doc_id, start_line, end_line FROM chunk_entries), m AS (SELECT *, max(end_line) OVER (PARTITION BY doc_id ORDER BY start_line, end_line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM o),
  i AS (SELECT *, sum(CASE WHEN reach IS NULL OR start_line > reach + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY start_line, end_line ROWS UNBOUNDED PRECEDING) AS island FROM m)
  SELECT doc_id, min(start_line) AS start_line, max(end_line) AS end_line, count(*) AS n FROM i GROUP BY doc_id, island""")
def merge_intervals(spark, d):
    return s.merge_intervals(table(spark, d, "chunk_entries").select("doc_id", "start_line", "end_line").distinct(), ["doc_id"], "start_line", "end_line", gap=1)


@query(f"""WITH p AS (SELECT *, lag(line) OVER (PARTITION BY doc_id ORDER BY pos) AS prev FROM {_LINES}), q AS (SELECT * FROM p WHERE prev IS DISTINCT FROM line), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) AS k FROM q)
  SELECT doc_id, count(*) AS kept FROM r WHERE length(line) < 40 OR k <= 10 GROUP BY doc_id""")
def paragraph_dedup(spark, d):
    return s.collapse_repeats(lines(spark, d), ["doc_id"], ["pos"], "line").groupBy("doc_id").agg(F.count("*").alias("kept"))


@query(f"""WITH f AS (SELECT doc_id, pos + 1 AS p FROM {_LINES} WHERE regexp_matches(line, '^([-*•]|[0-9]+[.)]) ')), g AS (SELECT *, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 4 THEN 0 ELSE 1 END AS nw FROM f),
  i AS (SELECT *, sum(nw) OVER (PARTITION BY doc_id ORDER BY p ROWS UNBOUNDED PRECEDING) AS r FROM g) SELECT doc_id, min(p)::INT AS first, max(p)::INT AS last, count(*) AS n FROM i GROUP BY doc_id, r HAVING count(*) >= 3""")
def list_runs(spark, d):
    x = lines(spark, d).withColumn("f", F.col("line").rlike("^([-*•]|[0-9]+[.)]) "))
    return s.runs(x, ["doc_id"], ["pos"], "f", least=3, bridge=3)


@query(f"""WITH k AS (SELECT doc_id, pos, CASE WHEN regexp_matches(line, '^[|]') THEN 'cells' WHEN regexp_matches(line, '^[0-9]+$') THEN 'num' WHEN line = '' THEN 'blank' WHEN regexp_matches(line, '^#') THEN 'head' ELSE 'text' END AS kind FROM {_LINES}),
  m AS (SELECT doc_id, p.period, CASE WHEN kind = lag(kind, p.period) OVER (PARTITION BY doc_id, p.period ORDER BY pos) THEN 1 ELSE 0 END AS hit FROM k, (SELECT unnest(range(2, 9))::INT AS period) p)
  SELECT doc_id, period, sum(hit)::BIGINT AS matches FROM m GROUP BY ALL HAVING sum(hit) >= period * 2""")
def periodic_lines(spark, d):
    line = F.col("line")
    kind = F.when(line.rlike("^[|]"), "cells").when(line.rlike("^[0-9]+$"), "num").when(line == "", "blank").when(line.rlike("^#"), "head").otherwise("text")
    return s.periodic(lines(spark, d).withColumn("kind", kind), ["doc_id"], ["pos"], "kind")


@query(f"""WITH RECURSIVE x AS (SELECT doc_id, k, length(line) AS n FROM {_NONEMPTY}), r AS (SELECT doc_id, k, n, 0 AS pack, n AS used FROM x WHERE k = 1
  UNION ALL SELECT x.doc_id, x.k, x.n, CASE WHEN r.used + x.n <= 600 THEN r.pack ELSE r.pack + 1 END, CASE WHEN r.used + x.n <= 600 THEN r.used + x.n ELSE x.n END FROM r JOIN x ON x.doc_id = r.doc_id AND x.k = r.k + 1)
  SELECT doc_id, pack, count(*) AS n, sum(n)::BIGINT AS chars FROM r GROUP BY ALL""")
def greedy_pack(spark, d):
    x = lines(spark, d).where("line <> ''").withColumn("n", F.length("line"))
    return s.greedy_pack(x, ["doc_id"], ["pos"], "n", 600).groupBy("doc_id", "pack").agg(F.count("*").alias("n"), F.sum("n").alias("chars"))


@query(f"SELECT doc_id, count(*) AS n, max(used)::BIGINT AS used FROM (SELECT doc_id, sum(length(line)) OVER (PARTITION BY doc_id ORDER BY k ROWS UNBOUNDED PRECEDING) AS used FROM {_NONEMPTY}) WHERE used <= 3000 GROUP BY doc_id")
def evidence_pack(spark, d):
    x = lines(spark, d).where("line <> ''").withColumn("n", F.length("line"))
    return s.budget_prefix(x, ["doc_id"], ["pos"], "n", 3000).groupBy("doc_id").agg(F.count("*").alias("n"), F.max("used").alias("used"))


@query("""WITH s AS (SELECT draft_tag, id, coalesce(depth, 0) AS d, stable_label AS k FROM standard_sections WHERE draft_tag IS NOT NULL), v AS (SELECT DISTINCT draft_tag, d FROM s), l AS (SELECT a.draft_tag, a.id, v.d AS lv FROM s a JOIN v ON v.draft_tag = a.draft_tag AND v.d <= a.d),
  b AS (SELECT l.*, (SELECT max(q.id) FROM s q WHERE q.draft_tag = l.draft_tag AND q.id <= l.id AND q.d < l.lv) AS cut FROM l), c AS (SELECT b.*, (SELECT count(*) FROM s q WHERE q.draft_tag = b.draft_tag AND q.id <= b.id AND q.d = b.lv AND q.id > coalesce(b.cut, -1)) AS n FROM b),
  p AS (SELECT a.draft_tag, a.id, max_by(q.k, q.id) AS parent FROM s a JOIN s q ON q.draft_tag = a.draft_tag AND q.id < a.id AND q.d < a.d GROUP BY ALL)
  SELECT c.draft_tag, c.id, string_agg(n::VARCHAR, '.' ORDER BY lv) FILTER (n > 0) AS number, any_value(p.parent) AS parent FROM c LEFT JOIN p ON p.draft_tag = c.draft_tag AND p.id = c.id GROUP BY c.draft_tag, c.id""")
def outline_numbers(spark, d):
    """Section numbers and parents from the depths of a draft's sections in order."""
    return s.number_outline(table(spark, d, "standard_sections").where("draft_tag is not null"), "draft_tag", "id", "depth", "stable_label")


@query("""SELECT doc_id, coalesce((p1 = 0 OR p2 = 0 OR p1 < p2) AND (p2 = 0 OR p3 = 0 OR p2 < p3) AND (p1 = 0 OR p3 = 0 OR p2 > 0 OR p1 < p3), true)::VARCHAR AS ordered FROM (SELECT doc_id, strpos(text, 'title:') AS p1, strpos(text, '## ') AS p2, strpos(text, 'Reference') AS p3 FROM documents WHERE text IS NOT NULL)""")
def ordered_containment(spark, d):
    return table(spark, d, "documents").where("text is not null").select("doc_id", s.ordered_places(F.col("text"), ["title:", "## ", "Reference"]).cast("string").alias("ordered"))


_WORDS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]+')"


@query(f"""WITH w AS (SELECT id, {_WORDS.format("raw_latex")} AS a, {_WORDS.format("cleaned_text")} AS b FROM standard_sections WHERE raw_latex IS NOT NULL AND cleaned_text IS NOT NULL),
  g AS (SELECT id, list_distinct([array_to_string(a[i:i+4], ' ') FOR i IN range(1, len(a) - 3)]) AS x, list_distinct([array_to_string(b[i:i+4], ' ') FOR i IN range(1, len(b) - 3)]) AS y FROM w)
  SELECT id, len(x)::INT AS n_raw, len(y)::INT AS n_clean, len(list_intersect(x, y))::INT AS n_both FROM g""")
def shingle5_overlap(spark, d):
    w = lambda c: F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    df = spread(table(spark, d, "standard_sections").where("raw_latex is not null and cleaned_text is not null"))
    g = df.select("id", F.array_distinct(s.shingles(w("raw_latex"), 5)).alias("x"), F.array_distinct(s.shingles(w("cleaned_text"), 5)).alias("y"))
    return g.select("id", F.size("x").alias("n_raw"), F.size("y").alias("n_clean"), F.size(F.array_intersect("x", "y")).alias("n_both"))


_HALF = "substring(text, 1, (length(text) // 2)::INT)"


@query(f"""WITH w AS (SELECT doc_id, {_WORDS.format("text")} AS a, {_WORDS.format(_HALF)} AS b FROM documents WHERE text IS NOT NULL),
  k AS (SELECT doc_id, a, b, unnest(range(0, greatest(len(a) - 100, 1), 100)) AS st FROM w WHERE len(a) > 0), c AS (SELECT doc_id, st, list_distinct(a[st + 1:st + 200]) AS x, b FROM k)
  SELECT doc_id, st AS start, round(len(list_intersect(x, b)) / len(x), 6) AS coverage FROM c WHERE len(list_intersect(x, b)) / len(x) < 0.6""")
def local_coverage_windows(spark, d):
    """Windows of 200 words, half overlapping, of each text that the first half of it covers by less than 0.6."""
    w = lambda c: F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    t = spread(table(spark, d, "documents").where("text is not null").select("doc_id", "text"))
    df = t.select("doc_id", w("text").alias("a"), w(F.expr("substring(text, 1, int(length(text) div 2))")).alias("b"))
    k = df.where("size(a) > 0").withColumn("start", F.explode(F.expr("sequence(0, greatest(size(a) - 100, 1) - 1, 100)")))
    x = F.array_distinct(F.expr("slice(a, start + 1, 200)"))
    cov = F.size(F.array_intersect(x, "b")) / F.size(x)
    return k.select("doc_id", F.col("start").cast("long").alias("start"), F.round(cov, 6).alias("coverage"), cov.alias("c")).where("c < 0.6").drop("c")


@query("SELECT id, row_number() OVER (ORDER BY draft_tag, chapter_file, id) AS gid FROM standard_sections")
def global_ids(spark, d):
    return s.global_ids(table(spark, d, "standard_sections").select("id", "draft_tag", "chapter_file"), [F.col("draft_tag").asc_nulls_last(), F.col("chapter_file").asc_nulls_last(), "id"]).select("id", "gid")


@query("SELECT doc_id, chunk_index, start_line, (row_number() OVER (PARTITION BY doc_id ORDER BY start_line, chunk_index, end_line, surveyed_at) % 2)::INT AS turn, surveyed_at::VARCHAR AS at FROM chunk_entries")
def alternating_turns(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("doc_id").orderBy("start_line", "chunk_index", "end_line", "surveyed_at")
    at = F.regexp_replace(F.date_format("surveyed_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"), r"\.?0+$", "")
    return table(spark, d, "chunk_entries").select("doc_id", "chunk_index", "start_line", (F.row_number().over(w) % 2).alias("turn"), at.alias("at"))


@query("SELECT c_custkey FROM (SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY sha256('regular:' || c_custkey)) AS k FROM customer) WHERE k <= 5")
def hash_order_first(spark, d):
    c = table(spark, d, "customer").withColumn("h", F.sha2(F.concat(F.lit("regular:"), F.col("c_custkey")), 256))
    return s.prefix_sample(c, ["c_nationkey"], ["h"], 5).select("c_custkey")


@query("""SELECT date_trunc('hour', ts)::VARCHAR AS hour, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL""")
def tumbling_counts(spark, d):
    e = table(spark, d, "events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return e.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("hour"), "event_type", "n", "total")
