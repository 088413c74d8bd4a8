"""Scans, merges, set comparisons, joins and picks over the stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators import tables as t
from quillspark.session import table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def P(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "papers")


@query("SELECT scrape_id, paper_id, title FROM papers WHERE year = '2022'")
def scan_year(spark, d):
    return t.require_rows(P(spark, d).where(F.col("year") == "2022"), "2022").select("scrape_id", "paper_id", "title")


@query("SELECT DISTINCT paper_id FROM papers")
def scan_keys(spark, d):
    return P(spark, d).select("paper_id").distinct()


@query("SELECT scrape_id, year FROM papers WHERE upper(trim(paper_id)) = 'P0999R0'")
def point_lookup(spark, d):
    return t.point_lookup(P(spark, d), "paper_id", " p0999r0").select("scrape_id", "year")


@query("SELECT year, count(*) AS n FROM papers WHERE year <> '' GROUP BY year")
def years_count(spark, d):
    return P(spark, d).where("year <> ''").groupBy("year").agg(F.count("*").alias("n"))


@query("SELECT c.c_custkey FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'O')")
def exists_semi(spark, d):
    o = table(spark, d, "orders").where("o_orderstatus = 'O'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").select("c_custkey").join(o, "c_custkey", "left_semi")


@query("""SELECT kind, count(*) AS n FROM (SELECT CASE WHEN regexp_matches(u, '\\.[a-z]+\\.json$') THEN 'thread' WHEN regexp_matches(u, '\\.json$') THEN 'record' WHEN regexp_matches(u, '\\.(debug|trace)\\.md$') THEN 'log'
  WHEN regexp_matches(u, '\\.md$') THEN 'markdown' WHEN regexp_matches(u, '\\.pdf$') THEN 'pdf' WHEN regexp_matches(u, '\\.html?$') THEN 'html' ELSE 'other' END AS kind
  FROM (SELECT lower(url) AS u FROM papers WHERE url <> '' AND NOT lower(url) LIKE '%.partial')) GROUP BY kind""")
def suffix_kinds(spark, d):
    from quillspark.sources.files import suffix_kind

    urls = P(spark, d).where("url <> '' and not lower(url) like '%.partial'")
    return urls.groupBy(suffix_kind(F.col("url")).alias("kind")).agg(F.count("*").alias("n"))


@query("""SELECT doc_id, array_to_string(l[3:6], chr(10)) AS lines, len(l) AS n_lines FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)""")
def line_window(spark, d):
    ls = F.split("text", "\n", -1)
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.array_join(F.slice(ls, 3, 4), "\n").alias("lines"), F.size(ls).cast("long").alias("n_lines"))


@query("""SELECT event_id, json_object('event_type', event_type, 'value', round(value, 2)) AS j FROM events WHERE false
  UNION ALL SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) FROM events""")
def json_field(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("j"))


_FEED = "SELECT c_custkey, c_name || '*' AS c_name, 'NEW' AS c_mktsegment FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT c_custkey + 10000000, c_name, 'NEW' FROM customer WHERE c_custkey % 3 = 1"
_STORE = "SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN '' ELSE c_mktsegment END AS c_mktsegment, c_acctbal FROM customer"


def _store(spark, d):
    c = table(spark, d, "customer")
    store = c.select("c_custkey", "c_name", F.when(F.col("c_custkey") % 2 == 0, "").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"), "c_acctbal")
    hit = c.where("c_custkey % 3 = 0").select("c_custkey", F.concat("c_name", F.lit("*")).alias("c_name"), F.lit("NEW").alias("c_mktsegment"))
    new = c.where("c_custkey % 3 = 1").select((F.col("c_custkey") + 10000000).alias("c_custkey"), "c_name", F.lit("NEW").alias("c_mktsegment"))
    return store, hit.unionByName(new)


@query(f"""SELECT coalesce(s.c_custkey, f.c_custkey) AS c_custkey, CASE WHEN f.c_custkey IS NOT NULL THEN f.c_name ELSE s.c_name END AS c_name,
  CASE WHEN f.c_custkey IS NOT NULL AND coalesce(s.c_mktsegment, '') = '' THEN f.c_mktsegment ELSE s.c_mktsegment END AS c_mktsegment, s.c_acctbal FROM ({_STORE}) s FULL JOIN ({_FEED}) f ON s.c_custkey = f.c_custkey""")
def upsert_policy(spark, d):
    store, feed = _store(spark, d)
    return t.upsert(store, feed, "c_custkey", ["c_name"], ["c_mktsegment"])


@query(f"SELECT c_custkey, c_name FROM customer UNION ALL SELECT c_custkey, c_name FROM ({_FEED}) f WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = f.c_custkey)")
def insert_or_ignore(spark, d):
    store, feed = _store(spark, d)
    return t.insert_or_ignore(store.select("c_custkey", "c_name"), feed, "c_custkey")


@query(f"SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS (SELECT 1 FROM ({_FEED}) f WHERE c.c_custkey = f.c_custkey) UNION ALL SELECT c_custkey, c_name FROM ({_FEED})")
def insert_or_replace(spark, d):
    store, feed = _store(spark, d)
    return t.insert_or_replace(store.select("c_custkey", "c_name"), feed, "c_custkey")


@query("""SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey % 7 <> 0
  UNION ALL SELECT l_orderkey, l_linenumber, l_quantity + 100 FROM lineitem WHERE l_orderkey % 7 = 0 AND l_linenumber = 1
  UNION ALL SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem l WHERE l_orderkey % 7 = 0 AND NOT EXISTS (SELECT 1 FROM lineitem f WHERE f.l_orderkey = l.l_orderkey AND f.l_linenumber = 1)""")
def replace_partition(spark, d):
    store = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    feed = store.where("l_orderkey % 7 = 0 and l_linenumber = 1").withColumn("l_quantity", F.col("l_quantity") + 100)
    return t.replace_partition(store, feed, "l_orderkey")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 AND o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 5 <> 0 THEN '' WHEN o_orderstatus = 'O' THEN 'won' ELSE 'lost' END AS won FROM orders""")
def compare_and_set(spark, d):
    store = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    wanted = store.where("o_orderkey % 5 = 0").select("o_orderkey", F.lit("O").alias("old"), F.lit("F").alias("new"))
    out = t.compare_and_set(store, wanted, "o_orderkey", "o_orderstatus")
    return out.withColumn("won", F.when(F.col("won").isNull(), "").when(F.col("won"), "won").otherwise("lost"))


@query("SELECT draft_tag, section_count, CASE WHEN section_count > 100 THEN 'large' WHEN section_count IS NULL THEN 'unknown' ELSE 'small' END AS size_class, CAST(section_count AS VARCHAR) AS section_text FROM drafts")
def migrated_columns(spark, d):
    df = table(spark, d, "drafts")
    size = F.when(F.col("section_count") > 100, "large").when(F.col("section_count").isNull(), "unknown").otherwise("small")
    out = t.add_columns(df, {"size_class": size, "section_text": F.col("section_count").cast("string"), "draft_tag": F.lit("")})
    return out.select("draft_tag", "section_count", "size_class", "section_text")


@query("SELECT n_nationkey, to_json({'name': n_name, 'region': n_regionkey}) AS j FROM nation")
def json_export(spark, d):
    return table(spark, d, "nation").select("n_nationkey", F.to_json(F.struct(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))).alias("j"))


@query("SELECT doc_id, sha256(text) AS sha256, CASE WHEN doc_id % 4 = 0 THEN 'none' WHEN doc_id % 4 = 1 THEN 'false' ELSE 'true' END AS ok FROM documents WHERE text IS NOT NULL")
def digest_check(spark, d):
    df = table(spark, d, "documents").where("text is not null").select("doc_id", "text")
    want = df.where("doc_id % 4 <> 0").select("doc_id", F.when(F.col("doc_id") % 4 == 1, F.sha2(F.concat("text", F.lit("x")), 256)).otherwise(F.sha2("text", 256)).alias("sha256"))
    return t.verified_digests(df, "text", want, "doc_id").withColumn("ok", F.coalesce(F.col("ok").cast("string"), F.lit("none")))


@query("SELECT scrape_id, document_date FROM papers WHERE document_date <> '' AND document_date >= '2022-03'")
def since_month(spark, d):
    return t.since(P(spark, d), "document_date", "2022-03").select("scrape_id", "document_date")


@query("SELECT id, stable_label FROM standard_sections WHERE depth = 0 AND is_deprecated = 0")
def optional_filters(spark, d):
    return t.optional_filters(table(spark, d, "standard_sections"), depth=0, is_deprecated=0, is_synopsis=None).select("id", "stable_label")


@query("SELECT id, title FROM standard_sections WHERE title ILIKE '%mem_ry ord%'")
def like_contains(spark, d):
    return t.like_contains(table(spark, d, "standard_sections"), "title", "MEM_RY ord").select("id", "title")


@query("SELECT n_name, n_nationkey, p AS place FROM (SELECT unnest(['NATION_7', 'NATION_2', 'NOWHERE', 'NATION_11']) AS n, generate_subscripts(['NATION_7', 'NATION_2', 'NOWHERE', 'NATION_11'], 1) - 1 AS p) w JOIN nation ON n_name = n")
def in_list_ordered(spark, d):
    return t.in_list_ordered(table(spark, d, "nation"), "n_name", ["NATION_7", "NATION_2", "NOWHERE", "NATION_11"], "n_nationkey").select("n_name", "n_nationkey", "place")


@query("""SELECT draft_tag, stable_label, id, title FROM standard_sections s WHERE id = (SELECT max(id) FROM standard_sections q WHERE q.draft_tag = s.draft_tag AND q.stable_label = s.stable_label)""")
def last_occurrence(spark, d):
    return t.last_occurrence(table(spark, d, "standard_sections").select("draft_tag", "stable_label", "id", "title"), ["draft_tag", "stable_label"], ["id"])


@query("SELECT paper_id, min(scrape_id) AS scrape_id, count(*) AS n FROM papers GROUP BY paper_id")
def dedup_first_wins(spark, d):
    p = P(spark, d).select("paper_id", "scrape_id")
    return t.first_occurrence(p, ["paper_id"], ["scrape_id"]).join(p.groupBy("paper_id").agg(F.count("*").alias("n")), "paper_id")


@query("SELECT draft_tag, stable_label, count(*) AS n FROM standard_sections GROUP BY ALL HAVING count(*) > 1")
def repeated_keys(spark, d):
    return table(spark, d, "standard_sections").groupBy("draft_tag", "stable_label").agg(F.count("*").alias("n")).where("n > 1")


@query("""SELECT scrape_id, CASE WHEN coalesce(markdown_path, '') = '' THEN 'no_markdown' WHEN coalesce(citations_extracted_at, '') <> '' THEN 'done' ELSE 'process' END AS verdict FROM papers""")
def skip_classes(spark, d):
    v = F.when(t.blank(F.col("markdown_path")), "no_markdown").when(~t.blank(F.col("citations_extracted_at")), "done").otherwise("process")
    return P(spark, d).select("scrape_id", v.alias("verdict"))


@query("""SELECT scrape_id, CASE WHEN coalesce(source_file, '') = '' THEN 0 WHEN coalesce(markdown_path, '') = '' THEN 1 WHEN coalesce(citations_extracted_at, '') = '' THEN 2 ELSE 3 END AS first_missing FROM papers""")
def first_missing_artifact(spark, d):
    cols = ["source_file", "markdown_path", "citations_extracted_at"]
    pos = F.array_position(F.array(*[t.blank(F.col(c)) for c in cols]), True)
    return P(spark, d).select("scrape_id", F.when(pos > 0, (pos - 1).cast("int")).otherwise(len(cols)).alias("first_missing"))


@query("""SELECT target, min(o) AS o FROM (SELECT paper_id AS target, 0 AS o FROM papers WHERE year = '2021' UNION ALL SELECT paper_id, 1 FROM papers WHERE starts_with(document_date, '2021-06') UNION ALL SELECT paper_id, 2 FROM papers WHERE paper_id = 'P0999R0') GROUP BY target""")
def target_union_first_wins(spark, d):
    p = P(spark, d)
    parts = [p.where("year = '2021'"), p.where(F.col("document_date").startswith("2021-06")), p.where("paper_id = 'P0999R0'")]
    u = None
    for k, x in enumerate(parts):
        x = x.select(F.col("paper_id").alias("target"), F.lit(k).alias("o"))
        u = x if u is None else u.unionByName(x)
    return u.groupBy("target").agg(F.min("o").alias("o"))


@query("""WITH s AS (SELECT upper(trim(paper_id)) AS id FROM papers), b AS (SELECT regexp_replace(id, 'R[0-9]+$', '') AS base, CASE WHEN regexp_matches(id, 'R[0-9]+$') THEN CAST(regexp_extract(id, 'R([0-9]+)$', 1) AS INT) ELSE 0 END AS rev, id FROM s)
  SELECT base, max_by(id, rev) AS latest, count(DISTINCT rev) AS revisions FROM b GROUP BY base""")
def latest_revision_numeric(spark, d):
    return t.latest_revision(P(spark, d), "paper_id")


@query("SELECT standard_version, max(draft_tag) AS tag FROM drafts GROUP BY standard_version")
def max_lexicographic(spark, d):
    return table(spark, d, "drafts").groupBy("standard_version").agg(F.max("draft_tag").alias("tag"))


@query("""WITH s AS (SELECT DISTINCT upper(trim(paper_id)) AS id FROM papers), b AS (SELECT regexp_replace(id, 'R[0-9]+$', '') AS base, CASE WHEN regexp_matches(id, 'R[0-9]+$') THEN CAST(regexp_extract(id, 'R([0-9]+)$', 1) AS INT) ELSE 0 END AS rev, id FROM s),
  l AS (SELECT base, max_by(id, rev) AS latest FROM b GROUP BY base), r AS (SELECT DISTINCT previous_version AS ref, upper(trim(previous_version)) AS id, regexp_replace(upper(trim(previous_version)), 'R[0-9]+$', '') AS base FROM papers WHERE previous_version <> '')
  SELECT ref, CASE WHEN s.id IS NOT NULL THEN 'exact' WHEN r.id = r.base AND l.latest IS NOT NULL THEN 'latest' WHEN r.id <> r.base AND x.id IS NOT NULL THEN 'base' ELSE 'none' END AS how,
  CASE WHEN s.id IS NOT NULL THEN r.id WHEN r.id = r.base AND l.latest IS NOT NULL THEN l.latest WHEN r.id <> r.base AND x.id IS NOT NULL THEN r.base END AS resolved
  FROM r LEFT JOIN s ON s.id = r.id LEFT JOIN l ON l.base = r.base LEFT JOIN s x ON x.id = r.base""")
def ref_resolution_fallback(spark, d):
    return t.resolve_references(P(spark, d), "previous_version", P(spark, d), "paper_id")


_SPLIT = "EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')"


@query(f"SELECT o_orderkey FROM orders o WHERE {_SPLIT}")
def semi_verdict(spark, d):
    return _orders(spark, d).join(_returned(spark, d), "o_orderkey", "left_semi")


@query(f"SELECT o_orderkey FROM orders o WHERE NOT {_SPLIT}")
def anti_unjudged(spark, d):
    return _orders(spark, d).join(_returned(spark, d), "o_orderkey", "left_anti")


@query("SELECT DISTINCT to_label, draft_tag FROM section_xrefs x WHERE NOT EXISTS (SELECT 1 FROM standard_sections s WHERE s.draft_tag = x.draft_tag AND s.stable_label = x.to_label)")
def anti_orphan(spark, d):
    s = table(spark, d, "standard_sections").select("draft_tag", F.col("stable_label").alias("to_label"))
    return table(spark, d, "section_xrefs").select("to_label", "draft_tag").distinct().join(s, ["draft_tag", "to_label"], "left_anti").select("to_label", "draft_tag")


def _orders(spark, d):
    return table(spark, d, "orders").select("o_orderkey")


def _returned(spark, d):
    return table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))


@query("""WITH c AS (SELECT draft_tag, stable_label, title FROM (SELECT *, row_number() OVER (PARTITION BY draft_tag, stable_label ORDER BY id DESC) AS k FROM standard_sections) WHERE k = 1),
  a AS (SELECT * FROM c WHERE draft_tag = 'n4001'), b AS (SELECT * FROM c WHERE draft_tag = 'n4002')
  SELECT coalesce(a.stable_label, b.stable_label) AS stable_label, CASE WHEN b.stable_label IS NULL THEN 'missing' WHEN a.stable_label IS NULL THEN 'new' WHEN a.title IS NOT DISTINCT FROM b.title THEN 'same' ELSE 'changed' END AS status, a.title AS "before", b.title AS "after"
  FROM a FULL JOIN b ON a.stable_label = b.stable_label""")
def version_diff(spark, d):
    c = t.last_occurrence(table(spark, d, "standard_sections").where("draft_tag in ('n4001', 'n4002')").select("draft_tag", "stable_label", "id", "title"), ["draft_tag", "stable_label"], ["id"])
    return t.snapshot_diff(c.where("draft_tag = 'n4001'"), c.where("draft_tag = 'n4002'"), "stable_label", "title")


@query("""WITH a AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS k, l_partkey FROM lineitem),
  b AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_partkey, l_suppkey) AS k, l_suppkey FROM lineitem WHERE l_returnflag = 'N')
  SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, coalesce(a.k, b.k)::INT AS k, l_partkey AS left_value, l_suppkey AS right_value FROM a FULL JOIN b ON a.l_orderkey = b.l_orderkey AND a.k = b.k""")
def order_matched_zip(spark, d):
    li = table(spark, d, "lineitem")
    return t.order_matched(li, li.where("l_returnflag = 'N'"), "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], [F.desc("l_extendedprice"), "l_linenumber", "l_partkey", "l_suppkey"], "l_partkey", "l_suppkey")


@query("""WITH r AS (SELECT DISTINCT doc_id, chunk_index, start_line, end_line FROM chunk_entries), h AS (SELECT doc_id, unnest(list_transform(list_filter(list_zip(l, range(1, len(l) + 1)), lambda x: starts_with(x[1], '#')), lambda x: x[2])) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL))
  SELECT h.doc_id, h.line, r.chunk_index, r.start_line, r.end_line FROM h JOIN r ON r.doc_id = h.doc_id AND h.line BETWEEN r.start_line AND r.end_line""")
def chunk_range_join(spark, d):
    lines = table(spark, d, "documents").where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("p", "s")).where(F.col("s").startswith("#"))
    heads = lines.select("doc_id", (F.col("p") + 1).cast("long").alias("line"))
    return t.range_join(heads, table(spark, d, "chunk_entries").select("doc_id", "chunk_index", "start_line", "end_line").distinct(), "doc_id", "line", "start_line", "end_line", 64)


@query("SELECT from_label AS src, to_label AS dst, count(*) AS weight FROM section_xrefs WHERE from_label <> to_label GROUP BY ALL")
def citation_edges(spark, d):
    x = table(spark, d, "section_xrefs").select(F.col("from_label").alias("src"), F.col("to_label").alias("dst"))
    return x.where("src <> dst").groupBy("src", "dst").agg(F.count("*").alias("weight"))


@query("SELECT draft_tag, to_label AS label, count(*) AS incoming, count(DISTINCT from_label) AS sources FROM section_xrefs GROUP BY ALL")
def incoming_edges(spark, d):
    return table(spark, d, "section_xrefs").groupBy("draft_tag", F.col("to_label").alias("label")).agg(F.count("*").alias("incoming"), F.countDistinct("from_label").alias("sources"))


@query("""WITH q AS (SELECT DISTINCT lower(trim(title)) AS k FROM papers WHERE title <> '') SELECT k FROM q a WHERE k = '' OR NOT EXISTS (SELECT 1 FROM q b WHERE b.k <> a.k AND contains(b.k, a.k))""")
def substring_absorb(spark, d):
    from quillspark.operators.containment import maximal_strings

    return maximal_strings(P(spark, d).where("title <> ''").select(F.lower(F.trim("title")).alias("k")), "k")


@query("""SELECT base, sum(CASE WHEN prev IS NULL THEN 1 ELSE 0 END)::BIGINT AS first, sum(CASE WHEN rev = prev + 1 THEN 1 ELSE 0 END)::BIGINT AS next, sum(CASE WHEN rev > prev + 1 THEN 1 ELSE 0 END)::BIGINT AS gap FROM
  (SELECT base, rev, lag(rev) OVER (PARTITION BY base ORDER BY rev) AS prev FROM (SELECT DISTINCT regexp_replace(upper(trim(paper_id)), 'R[0-9]+$', '') AS base, CASE WHEN regexp_matches(upper(trim(paper_id)), 'R[0-9]+$') THEN CAST(regexp_extract(upper(trim(paper_id)), 'R([0-9]+)$', 1) AS INT) ELSE 0 END AS rev FROM papers)) GROUP BY base""")
def revision_lineage(spark, d):
    from pyspark.sql import Window

    base, rev = t.base_and_revision(F.col("paper_id"))
    r = P(spark, d).select(base.alias("base"), rev.alias("rev")).distinct().withColumn("prev", F.lag("rev").over(Window.partitionBy("base").orderBy("rev")))
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return r.groupBy("base").agg(n(F.col("prev").isNull()).alias("first"), n(F.col("rev") == F.col("prev") + 1).alias("next"), n(F.col("rev") > F.col("prev") + 1).alias("gap"))
