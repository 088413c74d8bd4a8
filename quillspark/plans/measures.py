"""Queries of recall, agreement, calibration, guards and summary statistics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillspark.operators import measures as m
from quillspark.session import spread, table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_W = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]+')"
_RECALL = f"""r AS (SELECT item_id, t AS token, count(*) AS n FROM (SELECT item_id, unnest({_W.format("text")}) AS t FROM benchmark) GROUP BY ALL), z AS (SELECT item_id, sum(n) AS size FROM r GROUP BY 1),
  h AS (SELECT doc_id, t AS token, count(*) AS m FROM (SELECT doc_id, unnest({_W.format("text")}) AS t FROM documents WHERE text IS NOT NULL) GROUP BY ALL),
  p AS (SELECT item_id, doc_id, sum(least(n, m))::BIGINT AS matched FROM r JOIN h USING (token) GROUP BY ALL)"""


def _recall(spark, d, **how):
    return m.multiset_recall(table(spark, d, "benchmark"), "item_id", "text", spread(table(spark, d, "documents").select("doc_id", "text")), "doc_id", "text", **how)


@query(f"WITH {_RECALL} SELECT doc_id, item_id, matched, matched / size AS recall FROM p JOIN z USING (item_id) WHERE matched / size >= 0.8")
def recall_doc_benchmark(spark, d):
    """Documents that hold at least four fifths of an item's words."""
    return _recall(spark, d, least=0.8)


@query(f"WITH {_RECALL}, q AS (SELECT item_id, doc_id, matched / size AS recall FROM p JOIN z USING (item_id)) SELECT item_id, doc_id, recall FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY recall DESC, doc_id) AS k FROM q) WHERE k = 1")
def containment_best_match(spark, d):
    return _recall(spark, d, best=True).select("item_id", "doc_id", "recall")


@query(f"""WITH s AS (SELECT id, t, count(*) AS n FROM (SELECT id, unnest({_W.format("raw_latex")}) AS t FROM standard_sections) GROUP BY ALL), c AS (SELECT id, t, count(*) AS m FROM (SELECT id, unnest({_W.format("cleaned_text")}) AS t FROM standard_sections) GROUP BY ALL),
  j AS (SELECT coalesce(s.id, c.id) AS id, sum(least(coalesce(n, 0), coalesce(m, 0))) AS b, coalesce(sum(n), 0) AS x, coalesce(sum(m), 0) AS y FROM s FULL JOIN c ON s.id = c.id AND s.t = c.t GROUP BY 1)
  SELECT q.id, round(CASE WHEN coalesce(x, 0) = 0 THEN 1.0 ELSE b / x END, 9) AS coverage, round(CASE WHEN coalesce(y, 0) = 0 THEN 0.0 ELSE (y - b) / y END, 9) AS drift FROM standard_sections q LEFT JOIN j ON j.id = q.id""")
def pairwise_coverage(spark, d):
    out = m.pairwise_coverage(spread(table(spark, d, "standard_sections").select("id", "raw_latex", "cleaned_text")), "id", "raw_latex", "cleaned_text")
    return out.select("id", F.round("coverage", 9).alias("coverage"), F.round("drift", 9).alias("drift"))


@query("""WITH a AS (SELECT id, c, count(*) AS n FROM (SELECT id, unnest(string_split(regexp_replace(raw_latex, '\\s', '', 'g'), '')) AS c FROM standard_sections) WHERE c <> '' GROUP BY ALL),
  b AS (SELECT id, c, count(*) AS m FROM (SELECT id, unnest(string_split(regexp_replace(cleaned_text, '\\s', '', 'g'), '')) AS c FROM standard_sections) WHERE c <> '' GROUP BY ALL),
  j AS (SELECT coalesce(a.id, b.id) AS id, sum(greatest(coalesce(n, 0) - coalesce(m, 0), 0))::BIGINT AS lost, sum(greatest(coalesce(m, 0) - coalesce(n, 0), 0))::BIGINT AS extra FROM a FULL JOIN b ON a.id = b.id AND a.c = b.c GROUP BY 1)
  SELECT q.id, coalesce(lost, 0) AS lost, coalesce(extra, 0) AS extra FROM standard_sections q LEFT JOIN j USING (id)""")
def char_conservation(spark, d):
    return m.char_conservation(table(spark, d, "standard_sections"), "id", "raw_latex", "cleaned_text")


@query(f"SELECT t AS token, count(*) AS n, count(DISTINCT doc_id) AS docs FROM (SELECT doc_id, unnest({_W.format('text')}) AS t FROM documents) GROUP BY 1 HAVING count(*) >= 5")
def token_frequency(spark, d):
    per = m.word_counts(table(spark, d, "documents").where("text is not null"), "doc_id", "text")
    return per.groupBy("token").agg(F.sum("n").alias("n"), F.count("*").alias("docs")).where("n >= 5")


_REF = r"\b[PDN]\d{4,5}(?:R\d+)?\b"


@query(rf"""WITH l AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)), r AS (SELECT doc_id, pos, unnest(regexp_extract_all(line, '{_REF}')) AS ref FROM l)
  SELECT doc_id, ref, count(*) AS n, min(pos) AS first_line, count(DISTINCT pos) AS lines FROM r GROUP BY ALL""")
def reference_lines(spark, d):
    """Papers mentioned by each document: how often, the first line, on how many lines."""
    x = table(spark, d, "documents").where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("p", "line"))
    r = x.select("doc_id", (F.col("p") + 1).cast("long").alias("pos"), F.explode(F.regexp_extract_all("line", F.lit(_REF), F.lit(0))).alias("ref"))
    return r.groupBy("doc_id", "ref").agg(F.count("*").alias("n"), F.min("pos").alias("first_line"), F.countDistinct("pos").alias("lines"))


@query("SELECT year, avg(line_count) AS line_count_mean, count(line_count) AS line_count_n, avg(status) AS status_mean, count(status) AS status_n FROM papers GROUP BY year")
def eligible_means(spark, d):
    return m.eligible_means(table(spark, d, "papers"), ["line_count", "status"], ["year"])


_PRF = "count(*) FILTER (t AND f) AS tp, count(*) FILTER (NOT t AND f) AS fp, count(*) FILTER (t AND NOT f) AS fn"
_LAB = "SELECT user_id, event_type = 'error' AS t, value < 8 AS f FROM events"


def _prf(spark, d, *by):
    return m.precision_recall(table(spark, d, "events"), F.col("event_type") == "error", F.col("value") < 8, list(by))


@query(f"""WITH c AS (SELECT user_id, {_PRF} FROM ({_LAB}) GROUP BY 1), r AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall FROM c)
  SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM r""")
def prf_label(spark, d):
    return _prf(spark, d, "user_id")


@query(f"""WITH c AS (SELECT user_id, {_PRF} FROM ({_LAB}) GROUP BY 1), r AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS p, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS q FROM c), f AS (SELECT *, CASE WHEN p + q = 0 THEN 0 ELSE 2 * p * q / (p + q) END AS f1 FROM r)
  SELECT sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn, round(avg(f1), 9) AS macro_f1, count(*) AS labels, round(2 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)), 9) AS micro_f1 FROM f""")
def prf_micro_macro(spark, d):
    return m.micro_macro(_prf(spark, d, "user_id")).withColumns({c: F.round(c, 9) for c in ("macro_f1", "micro_f1")})


_ROC = """c AS (SELECT round(value) AS v, count(*) FILTER (event_type = 'error') AS p, count(*) FILTER (event_type <> 'error') AS n FROM events GROUP BY 1 UNION ALL SELECT max(round(value)) + 1, 0, 0 FROM events),
  k AS (SELECT v, coalesce(sum(p) OVER w, 0)::BIGINT AS tp, coalesce(sum(n) OVER w, 0)::BIGINT AS fp, sum(p) OVER () AS np, sum(n) OVER () AS nn FROM c WINDOW w AS (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  roc AS (SELECT v AS threshold, tp + fp AS flagged, tp, fp, tp / np AS tpr, fp / nn AS fpr FROM k)"""


def _roc(spark, d):
    e = table(spark, d, "events").select(F.round("value").alias("v"), (F.col("event_type") == "error").alias("bad"))
    return m.roc_curve(e, "v", "bad")


@query(f"WITH {_ROC} SELECT threshold, flagged, tp, fp, round(tpr, 9) AS tpr, round(fpr, 9) AS fpr FROM roc")
def roc_curve(spark, d):
    return _roc(spark, d).withColumns({"tpr": F.round("tpr", 9), "fpr": F.round("fpr", 9)})


@query(f"WITH {_ROC} SELECT threshold, round(tpr, 9) AS tpr, round(fpr, 9) AS fpr FROM roc WHERE fpr <= 0.2 AND flagged > 0 ORDER BY roc.tpr DESC, tp / flagged DESC, threshold DESC LIMIT 1")
def operating_point(spark, d):
    return m.operating_point(_roc(spark, d), 0.2).select("threshold", F.round("tpr", 9).alias("tpr"), F.round("fpr", 9).alias("fpr"))


_GRID = [round(0.05 * k, 2) for k in range(1, 20)]


def _scored(spark, d):
    s = (F.col("event_id") * 37 % 101 / 101).alias("score")
    return table(spark, d, "events").select((F.col("user_id") % 10).alias("label"), s, ((F.col("event_id") * 37 % 101) + (F.col("event_id") % 7) * 8 > 80).alias("truth"))


@query(f"""WITH s AS (SELECT user_id % 10 AS label, event_id * 37 % 101 / 101 AS score, (event_id * 37 % 101) + (event_id % 7) * 8 > 80 AS t FROM events), g AS (SELECT *, unnest({_GRID}::DOUBLE[]) AS thr FROM s),
  c AS (SELECT label, thr, count(*) FILTER (t AND score >= thr) AS tp, count(*) FILTER (NOT t AND score >= thr) AS fp, count(*) FILTER (t AND NOT score >= thr) AS fn FROM g GROUP BY ALL), r AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS p, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS q FROM c),
  f AS (SELECT *, CASE WHEN p + q = 0 THEN 0 ELSE 2 * p * q / (p + q) END AS f1 FROM r), b AS (SELECT label, max(f1) FILTER (thr = 0.5) AS f0, max(f1) AS fb FROM f GROUP BY 1)
  SELECT f.label, CASE WHEN fb > f0 THEN min(thr) FILTER (f1 = fb) ELSE 0.5 END AS threshold, round(greatest(max(fb), max(f0)), 9) AS f1 FROM f JOIN b USING (label) GROUP BY f.label, fb, f0""")
def best_f1_threshold(spark, d):
    return m.best_thresholds(_scored(spark, d), "label", "score", "truth", _GRID, 0.5).withColumn("f1", F.round("f1", 9))


@query(f"""WITH s AS (SELECT user_id % 10 AS label, event_id * 37 % 101 / 101 AS score, (event_id * 37 % 101) + (event_id % 7) * 8 > 80 AS t FROM events), g AS (SELECT *, unnest({_GRID}::DOUBLE[]) AS thr FROM s)
  SELECT label, thr, count(*) FILTER (t AND score >= thr) AS tp, count(*) FILTER (NOT t AND score >= thr) AS fp, count(*) FILTER (t AND NOT score >= thr) AS fn FROM g GROUP BY ALL""")
def grid_sweep(spark, d):
    t = _scored(spark, d).withColumn("thr", F.explode(F.array(*[F.lit(g) for g in _GRID])))
    return m.precision_recall(t, F.col("truth"), F.col("score") >= F.col("thr"), ["label", "thr"]).select("label", "thr", "tp", "fp", "fn")


@query("""WITH a AS (SELECT draft_tag, count(DISTINCT chapter_file) AS allp FROM standard_sections GROUP BY 1), p AS (SELECT draft_tag, title, chapter_file, count(*) AS n FROM standard_sections GROUP BY ALL), q AS (SELECT draft_tag, title, count(*) AS pages, max(n) AS most FROM p GROUP BY ALL)
  SELECT draft_tag, title, pages FROM q JOIN a USING (draft_tag) WHERE pages >= 0.15 * allp AND most <= 2""")
def repeat_lines(spark, d):
    return m.repeated_texts(table(spark, d, "standard_sections"), "draft_tag", "chapter_file", "title", 0.15)


@query("""WITH p AS (SELECT source, lang, sum(length(text))::BIGINT AS w FROM documents WHERE text <> '' AND lang IS NOT NULL GROUP BY ALL), t AS (SELECT source, max(w) AS top, sum(w) AS allw FROM p GROUP BY 1)
  SELECT source, min(lang) AS mode, round(top / allw, 9) AS share FROM p JOIN t USING (source) WHERE w = top GROUP BY source, top, allw""")
def modal_value(spark, d):
    df = table(spark, d, "documents").where("text <> '' and lang is not null")
    return m.weighted_mode(df, ["source"], "lang", F.length("text")).withColumn("share", F.round("share", 9))


@query("SELECT event_type, round(CASE WHEN avg(value) = 0 THEN 0 ELSE stddev_pop(value) / avg(value) END, 6) AS cv, count(value) AS n FROM events GROUP BY 1")
def dispersion(spark, d):
    return m.dispersion(table(spark, d, "events"), ["event_type"], "value").withColumn("cv", F.round("cv", 6))


@query("""WITH x AS (SELECT doc_id, len(string_split(text, chr(65533))) - 1 AS broken, len(string_split(text, chr(10) || '```')) - 1 AS fences, len(string_split(text, chr(10) || '#')) - 1 AS heads FROM documents WHERE text IS NOT NULL)
  SELECT doc_id, greatest(0, 100 - (least(broken * 5.0, 20.0) + least((fences % 2) * 15.0, 30.0) + CASE WHEN heads = 0 THEN 25.0 ELSE 0.0 END)) AS score FROM x""")
def qa_score(spark, d):
    n = lambda s: F.size(F.split("text", s, -1)) - 1
    p = [(n("�"), 5.0, 20.0), (n("\n```") % 2, 15.0, 30.0), (F.when(n("\n#") == 0, 1).otherwise(0), 25.0, 25.0)]
    return table(spark, d, "documents").where("text is not null").select("doc_id", m.capped_score(p).alias("score"))


@query("""SELECT o_orderkey, CASE WHEN n_flags = 0 THEN 'pass' WHEN n_flags > 1 THEN 'fail' ELSE 'review' END AS verdict, n_flags FROM (SELECT l_orderkey AS o_orderkey, (CASE WHEN sum(l_quantity) > 150 THEN 1 ELSE 0 END + CASE WHEN round(avg(l_discount), 6) > 0.06 THEN 1 ELSE 0 END + CASE WHEN count(DISTINCT l_returnflag) > 2 THEN 1 ELSE 0 END)::INT AS n_flags FROM lineitem GROUP BY 1)""")
def verdict_flags(spark, d):
    g = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("q"), F.avg("l_discount").alias("a"), F.countDistinct("l_returnflag").alias("f"))
    flags = F.array_compact(F.array(F.when(F.col("q") > 150, "long"), F.when(F.round("a", 6) > 0.06, "cut"), F.when(F.col("f") > 2, "mixed")))
    n = F.size(flags)
    return g.select("o_orderkey", F.when(n == 0, "pass").when(n > 1, "fail").otherwise("review").alias("verdict"), n.alias("n_flags"))


@query("""WITH b AS (SELECT l_orderkey AS k, round(avg(l_discount), 4) AS x, round(avg(l_tax), 4) AS y FROM lineitem WHERE l_orderkey % 11 <> 0 GROUP BY 1), c AS (SELECT l_orderkey AS k, round(avg(l_discount) - CASE WHEN l_orderkey % 3 = 0 THEN 0.03 ELSE 0 END, 4) AS x, round(avg(l_tax), 4) AS y FROM lineitem WHERE l_orderkey % 13 <> 0 GROUP BY 1)
  SELECT coalesce(b.k, c.k) AS k, CASE WHEN c.k IS NULL THEN 'vanished' WHEN b.k IS NULL AND c.x < 0.02 THEN 'new_below_floor' WHEN b.k IS NULL THEN 'new' WHEN round(b.x - c.x, 4) > 0.025 OR round(b.y - c.y, 4) > 0.025 THEN 'regressed' WHEN b.x >= 0.02 AND c.x < 0.02 THEN 'crossed_floor' ELSE 'ok' END AS status FROM b FULL JOIN c ON b.k = c.k""")
def guard_status(spark, d):
    g = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.avg("l_discount").alias("x"), F.avg("l_tax").alias("y"))
    now = g.where("k % 13 <> 0").withColumn("x", F.col("x") - F.when(F.col("k") % 3 == 0, 0.03).otherwise(0.0))
    return m.guard_status(g.where("k % 11 <> 0"), now, "k", ["x", "y"], 0.025, {"x": 0.02})


@query("""SELECT paper_id, CASE WHEN min(t) IS NULL THEN 'empty' WHEN count(DISTINCT t) = 1 THEN 'same' ELSE 'changed' END AS status, count(*) AS n FROM (SELECT paper_id, nullif(regexp_replace(regexp_replace(replace(title, chr(13), ''), '[ \\t]+', ' ', 'g'), '^ | $', '', 'g'), '') AS t FROM papers) GROUP BY 1""")
def golden_status(spark, d):
    t = F.expr("nullif(trim(regexp_replace(replace(title, '\\r', ''), '[ \\\\t]+', ' ')), '')")
    g = table(spark, d, "papers").select("paper_id", t.alias("t")).groupBy("paper_id").agg(F.countDistinct("t").alias("k"), F.count("*").alias("n"))
    return g.select("paper_id", F.when(F.col("k") == 0, "empty").when(F.col("k") == 1, "same").otherwise("changed").alias("status"), "n")


@query("SELECT user_id, min(CASE event_type WHEN 'error' THEN 0 WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 ELSE 3 END) AS severity, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1")
def least_severity(spark, d):
    s = F.when(F.col("event_type") == "error", 0).when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "click", 2).otherwise(3)
    return table(spark, d, "events").groupBy("user_id").agg(F.min(s).alias("severity"), F.count_if(F.col("event_type") == "error").alias("errors"))


@query("""SELECT user_id, event_type, n / sum(n) OVER (PARTITION BY user_id) AS mass, high / n AS density FROM (SELECT user_id, event_type, count(*) AS n, count(*) FILTER (value > 10) AS high FROM events GROUP BY ALL)""")
def section_mass_density(spark, d):
    g = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.count_if(F.col("value") > 10).alias("high"))
    return g.select("user_id", "event_type", (F.col("n") / F.sum("n").over(Window.partitionBy("user_id"))).alias("mass"), (F.col("high") / F.col("n")).alias("density"))


@query("SELECT CASE WHEN length(text) = 0 THEN 'empty' WHEN length(text) < 500 THEN 'short' WHEN length(text) < 5000 THEN 'medium' ELSE 'long' END AS bucket, lang, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY ALL")
def bucket_distribution(spark, d):
    n = F.length("text")
    b = F.when(n == 0, "empty").when(n < 500, "short").when(n < 5000, "medium").otherwise("long")
    return table(spark, d, "documents").where("text is not null").groupBy(b.alias("bucket"), "lang").agg(F.count("*").alias("n"))


@query("SELECT doc_id, n_chars FROM (SELECT doc_id, n_chars, row_number() OVER (ORDER BY n_chars DESC NULLS LAST, doc_id) AS k FROM documents) WHERE k <= 20")
def worst_list(spark, d):
    """A top-k report: the 20 largest documents by recorded size."""
    return table(spark, d, "documents").select("doc_id", "n_chars").orderBy(F.desc_nulls_last("n_chars"), "doc_id").limit(20)


@query("""SELECT flag, count(*) AS n FROM (SELECT regexp_replace(lower(event_type) || ':' || round(value)::INT, '[0-9]+', '', 'g') AS flag FROM events) GROUP BY 1""")
def flag_rollup(spark, d):
    f = F.regexp_replace(F.concat_ws(":", F.lower("event_type"), F.round("value").cast("int")), r"\d+", "")
    return table(spark, d, "events").groupBy(f.alias("flag")).agg(F.count("*").alias("n"))


@query("""SELECT vec_id, greatest(a, b, c) AS best, least(a, b, c) AS worst, round((a + b + c) / 3, 6) AS mean, CASE WHEN greatest(a, b, c) - (a + b + c - greatest(a, b, c) - least(a, b, c)) > 0.1 THEN 'sure' ELSE 'open' END AS decision FROM (SELECT vec_id, embedding[1]::DOUBLE AS a, embedding[2]::DOUBLE AS b, embedding[3]::DOUBLE AS c FROM embeddings)""")
def ensemble_decision(spark, d):
    a, b, c = (F.col("embedding")[k].cast("double") for k in range(3))
    hi, lo = F.greatest(a, b, c), F.least(a, b, c)
    return table(spark, d, "embeddings").select("vec_id", hi.alias("best"), lo.alias("worst"), F.round((a + b + c) / 3, 6).alias("mean"), F.when(hi - (a + b + c - hi - lo) > 0.1, "sure").otherwise("open").alias("decision"))
