"""Queries of the layout passes, on lines laid out from the documents' texts (40 lines a page, 6 points a character)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.convert import layout as y
from quillspark.convert import operators as c
from quillspark.session import spread, table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_L = r"""L AS (SELECT doc, page, line, 72.0 + 6 * (length(text) - length(ltrim(text, ' '))) AS x0, 72.0 + 14 * line AS y0, 72.0 + 6 * length(text) AS x1, 84.0 + 14 * line AS y1, text, CASE WHEN regexp_matches(text, '^#{1,6} ') THEN 20.0 - 2 * length(regexp_extract(text, '^#+')) ELSE 10.0 END AS size,
  regexp_matches(text, '^#{1,6} ') AS bold, regexp_matches(text, '^    |^```|[;{}]$') AS mono FROM (SELECT doc_id AS doc, (k - 1) // 40 AS page, (k - 1) % 40 AS line, text FROM (SELECT doc_id, unnest(l) AS text, generate_subscripts(l, 1) AS k FROM (SELECT doc_id, string_split(replace(text, chr(13), ''), chr(10)) AS l FROM documents WHERE text IS NOT NULL))))"""
_S = "S AS (SELECT * FROM L WHERE trim(text) <> '')"
_W = r"""W AS (SELECT doc, page, line, word, 72.0 + 6 * a AS x0, 72.0 + 6 * (a + length(text)) AS x1, y0, y1, text FROM (SELECT doc, page, line, y0, y1, word, text, coalesce(sum(length(text) + 1) OVER (PARTITION BY doc, page, line ORDER BY word ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM (SELECT doc, page, line, y0, y1, unnest(w) AS text, generate_subscripts(w, 1) - 1 AS word FROM (SELECT *, string_split(text, ' ') AS w FROM L))) WHERE text <> '')"""
_O = "PARTITION BY doc ORDER BY page, y0, x0, line"


def lines(spark, d):
    t = spread(table(spark, d, "documents").where("text is not null").select(F.col("doc_id").alias("doc"), "text"))
    x = t.select("doc", F.posexplode(F.split(F.replace("text", F.lit("\r"), F.lit("")), "\n", -1)).alias("k", "text"))
    x = x.select("doc", F.floor(F.col("k") / 40).cast("long").alias("page"), (F.col("k") % 40).cast("long").alias("line"), "text")
    indent = F.length("text") - F.length(F.ltrim("text"))
    head = F.col("text").rlike("^#{1,6} ")
    return x.select(
        "doc", "page", "line", (72.0 + 6 * indent).alias("x0"), (72.0 + 14 * F.col("line")).alias("y0"), (72.0 + 6 * F.length("text")).alias("x1"), (84.0 + 14 * F.col("line")).alias("y1"), "text",
        F.when(head, 20.0 - 2 * F.length(F.regexp_extract("text", "^#+", 0))).otherwise(10.0).alias("size"), head.alias("bold"), F.col("text").rlike("^    |^```|[;{}]$").alias("mono"),
    )


def words(spark, d):
    x = lines(spark, d).select("doc", "page", "line", "y0", "y1", F.split("text", " ", -1).alias("w"))
    x = x.select("doc", "page", "line", "y0", "y1", "w", F.posexplode("w").alias("word", "text")).where("text <> ''")
    a = F.aggregate(F.slice("w", F.lit(1), F.col("word")), F.lit(0), lambda n, z: n + F.length(z) + 1)
    return x.select("doc", "page", "line", F.col("word").cast("long").alias("word"), (72.0 + 6 * a).alias("x0"), (72.0 + 6 * (a + F.length("text"))).alias("x1"), "y0", "y1", "text")


@query(r"""SELECT id AS doc, list_filter(regexp_split_to_array(title, ' +'), lambda z: z <> '')[i] AS text, i - 1 AS word FROM (SELECT id, title, unnest(range(1, len(list_filter(regexp_split_to_array(title, ' +'), lambda z: z <> '')) + 1)) AS i FROM standard_sections WHERE title IS NOT NULL)""")
def rebuilt_words(spark, d):
    """Words of titles rebuilt from their characters' places."""
    t = table(spark, d, "standard_sections").where("title is not null").select(F.col("id").alias("doc"), F.posexplode(F.split("title", "")).alias("k", "ch")).where("ch <> ''")
    chars = t.select("doc", F.lit(0).alias("page"), F.lit(0).alias("line"), (F.col("k") * 6.0).alias("x0"), (F.col("k") * 6.0 + 5.5).alias("x1"), "ch")
    return y.words_from_characters(chars, 2.0).select("doc", "text", (F.col("word") - 1).cast("long").alias("word"))


@query(f"WITH {_L} SELECT DISTINCT doc, page, line, 'to ' || (line + 1) AS target FROM L WHERE line % 7 = 0 AND x1 > 100 AND x0 < 160 UNION SELECT doc, page, line + 1, 'to ' || (line + 1) FROM (SELECT b.doc, b.page, a.line FROM L a JOIN L b ON a.doc = b.doc AND a.page = b.page AND b.line = a.line + 1 WHERE a.line % 7 = 0 AND b.x1 > 100 AND b.x0 < 160)")
def linked_lines(spark, d):
    """Lines under link boxes that reach from every seventh line into the next."""
    ln = lines(spark, d)
    box = ln.where("line % 7 = 0").select("doc", "page", F.lit(100.0).alias("x0"), F.col("y0"), F.lit(160.0).alias("x1"), (F.col("y1") + 5).alias("y1"), F.concat(F.lit("to "), F.col("line") + 1).alias("target"))
    return y.linked_lines(ln, box)


@query(f"WITH {_L} SELECT doc, page, line, CASE WHEN t <= 3 THEN 'top' ELSE 'bottom' END AS edge FROM (SELECT *, row_number() OVER (PARTITION BY doc, page ORDER BY y0, x0) AS t, row_number() OVER (PARTITION BY doc, page ORDER BY y0 DESC, x0 DESC) AS b FROM L) WHERE t <= 3 OR b <= 3")
def edge_lines(spark, d):
    return c.edge_lines(lines(spark, d)).select("doc", "page", "line", "edge")


_HEADED = "(SELECT doc, page, line, y0, x0, CASE WHEN line = 0 THEN 'Draft ' || doc || ', page ' || page ELSE text END AS text FROM L)"
_RUNNING = f"""E AS (SELECT *, CASE WHEN t <= 3 THEN 'top' ELSE 'bottom' END AS edge, regexp_replace(trim(text), '[0-9]+', '#', 'g') AS mark FROM (SELECT *, row_number() OVER (PARTITION BY doc, page ORDER BY y0, x0) AS t, row_number() OVER (PARTITION BY doc, page ORDER BY y0 DESC, x0 DESC) AS b FROM {_HEADED}) WHERE t <= 3 OR b <= 3),
  M AS (SELECT e.doc, edge, mark FROM E JOIN (SELECT doc, count(DISTINCT page) AS pages FROM L GROUP BY 1) p USING (doc) GROUP BY e.doc, edge, mark, pages HAVING pages >= 2 AND count(DISTINCT page) >= 0.5 * pages)"""


def _headed(spark, d):
    head = F.concat(F.lit("Draft "), "doc", F.lit(", page "), "page")
    return lines(spark, d).withColumn("text", F.when(F.col("line") == 0, head).otherwise(F.col("text"))).withColumn("block", F.lit(0))


@query(f"WITH {_L}, {_RUNNING} SELECT doc, edge, mark FROM M")
def running_texts(spark, d):
    return c.running_texts(_headed(spark, d))


@query(f"WITH {_L}, {_RUNNING} SELECT doc, count(*) AS lines FROM L WHERE (doc, page, line) NOT IN (SELECT doc, page, line FROM E SEMI JOIN M USING (doc, edge, mark)) GROUP BY 1")
def without_running_texts(spark, d):
    return c.without_running_texts(_headed(spark, d)).groupBy("doc").agg(F.count("*").alias("lines"))


@query(f"WITH {_L} SELECT doc, page, line FROM L WHERE page % 2 = 0 AND line BETWEEN 5 AND 8 AND x1 <= 400")
def hidden_lines(spark, d):
    """Lines wholly under a box that covers part of every second page."""
    ln = lines(spark, d).withColumn("block", F.lit(0)).withColumn("span", F.lit(0))
    cover = ln.where("page % 2 = 0").select("doc", "page").distinct().select("doc", "page", F.lit(0.0).alias("x0"), F.lit(140.0).alias("y0"), F.lit(400.0).alias("x1"), F.lit(200.0).alias("y1"))
    return c.hidden_spans(ln, cover).select("doc", "page", "line")


@query(f"""WITH {_L}, {_S}, p AS (SELECT doc, page, max_by(text, line) AS tail, min_by(text, line) AS h FROM S GROUP BY ALL) SELECT doc, page, tail, head FROM (SELECT *, lead(h) OVER (PARTITION BY doc ORDER BY page) AS head, lead(page) OVER (PARTITION BY doc ORDER BY page) AS np FROM p) WHERE np = page + 1 AND NOT regexp_matches(tail, '[.!?:]\\s*$') AND regexp_matches(head, '^\\s*[a-z]')""")
def joined_pages(spark, d):
    return y.joined_across_pages(lines(spark, d))


@query("""SELECT id, span::INT AS span, CASE WHEN span > 0 AND regexp_matches(text, '^[0-9A-Za-z_]') AND regexp_matches(before, '[0-9A-Za-z_]$') THEN span = 0 OR span = 2 ELSE span % 2 = 1 END::VARCHAR AS snapped FROM (SELECT id, span, text, lag(text) OVER (PARTITION BY id ORDER BY span) AS before FROM (SELECT id, unnest([0, 1, 2]) AS span, unnest([substring(title, 1, 5), substring(title, 6, 5), substring(title, 11)]) AS text FROM standard_sections WHERE length(title) > 11)) ORDER BY 1, 2""")
def snapped_styles(spark, d):
    """Titles in three spans of which the middle one is bold, with the style moved to word edges."""
    t = table(spark, d, "standard_sections").where("length(title) > 11").select("id", F.posexplode(F.array(F.substring("title", 1, 5), F.substring("title", 6, 5), F.substring("title", 11, 10_000))).alias("span", "text"))
    s = t.select("id", F.col("id").alias("doc"), F.lit(0).alias("page"), F.lit(0).alias("line"), "span", "text", (F.col("span") % 2 == 1).alias("bold"))
    return y.snapped_style(s, "bold").select("id", "span", F.col("snapped").cast("string").alias("snapped"))


@query("""SELECT font, (regexp_matches(lower(font), 'mono|courier|consol|typewriter|code') OR (n >= 5 AND cv <= 0.05)) AS mono, CASE WHEN regexp_matches(lower(font), 'mono|courier|consol|typewriter|code') THEN 'name' WHEN n >= 5 AND cv <= 0.05 THEN 'widths' ELSE '' END AS why
  FROM (SELECT font, count(*) AS n, stddev_pop(width) / avg(width) AS cv FROM (SELECT CASE l_linenumber WHEN 1 THEN 'Courier' WHEN 2 THEN 'Serif' WHEN 3 THEN 'Plain' ELSE 'Other' || l_linenumber END AS font, CASE l_linenumber WHEN 3 THEN 6.0 ELSE l_quantity END AS width FROM lineitem) GROUP BY 1)""")
def mono_fonts(spark, d):
    n = F.col("l_linenumber")
    li = table(spark, d, "lineitem").select(F.when(n == 1, "Courier").when(n == 2, "Serif").when(n == 3, "Plain").otherwise(F.concat(F.lit("Other"), n)).alias("font"), F.when(n == 3, 6.0).otherwise(F.col("l_quantity")).alias("width"))
    return y.mono_fonts(li)


@query(f"""WITH {_L}, {_S}, x AS (SELECT *, y0 - lag(y0) OVER (PARTITION BY doc, page ORDER BY y0, x0, line) AS dy FROM S), m AS (SELECT doc, x0, row_number() OVER (PARTITION BY doc ORDER BY count(*) DESC, x0) AS k FROM S GROUP BY doc, x0)
  SELECT doc, median(dy) AS pitch, round(avg(regexp_matches(text, '\\p{{L}}-\\s*$')::INT), 9) AS hyphens, min(m.x0) AS margin FROM x JOIN m USING (doc) WHERE m.k = 1 GROUP BY doc""")
def document_measures(spark, d):
    return y.document_measures(lines(spark, d)).withColumn("hyphens", F.round("hyphens", 9))


_FIELDS = " UNION ALL ".join(rf"SELECT doc, k, '{f}' AS field, regexp_extract(text, '(?i)^\s*\**{p}\**\s*:\s*\**\s*(.*?)\s*$', 1) AS value FROM h" for f, p in y.FIELD_LABELS.items())
_META = rf"h AS (SELECT * FROM (SELECT *, row_number() OVER ({_O}) AS k FROM L) WHERE k <= 30), f AS ({_FIELDS}), v AS (SELECT doc, field, min_by(value, k) AS value FROM f WHERE value <> '' GROUP BY ALL)"


@query(f"WITH {_L}, {_META} SELECT doc, field, value FROM v UNION ALL SELECT doc_id, 'source', source FROM documents WHERE coalesce(source, '') <> '' UNION ALL SELECT doc_id, 'document', paper_id FROM documents d WHERE coalesce(paper_id, '') <> '' AND NOT EXISTS (SELECT 1 FROM v WHERE v.doc = d.doc_id AND v.field = 'document')")
def block_metadata(spark, d):
    """Fields of each document: labels of its head, then what the table says."""
    t = table(spark, d, "documents")
    own = t.select(F.col("doc_id").alias("doc"), F.lit("document").alias("field"), F.col("paper_id").alias("value")).unionByName(t.select(F.col("doc_id").alias("doc"), F.lit("source").alias("field"), F.col("source").alias("value")))
    return y.merged_fields(y.labelled_fields(lines(spark, d)), own)


_KEY = "regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}]', '', 'g')"


@query(f"""WITH {_L}, {_META}, q AS (SELECT DISTINCT doc, {_KEY.format("value")} AS key FROM v), t AS (SELECT doc, min(page * 40 + line) AS at FROM L WHERE bold GROUP BY 1) SELECT L.doc, count(*) AS lines FROM (SELECT *, {_KEY.format("CASE WHEN line = 6 AND page = 0 THEN 'P0999R0' ELSE text END")} AS key FROM L) L LEFT JOIN t ON t.doc = L.doc
  WHERE NOT (L.page * 40 + L.line < coalesce(t.at, 1e9) AND L.key <> '' AND EXISTS (SELECT 1 FROM q WHERE q.doc = L.doc AND q.key = L.key)) GROUP BY 1""")
def without_echoes(spark, d):
    """Lines of each document without repeats of its fields before the first heading; the seventh line is put to be one."""
    ln = lines(spark, d)
    f = y.labelled_fields(ln)
    echoed = ln.withColumn("text", F.when((F.col("line") == 6) & (F.col("page") == 0) & ~F.col("bold"), "P0999R0").otherwise(F.col("text")))
    return y.without_echoes(echoed, f).groupBy("doc").agg(F.count("*").alias("lines"))


@query(f"WITH {_L}, n AS (SELECT doc, size, sum(length(text)) AS n FROM L GROUP BY ALL), b AS (SELECT doc, size AS body FROM (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY n DESC, size) AS k FROM n) WHERE k = 1) SELECT doc, size, dense_rank() OVER (PARTITION BY doc ORDER BY size DESC)::INT AS rank FROM n JOIN b USING (doc) WHERE size > body")
def font_ranks(spark, d):
    return y.font_ranks(lines(spark, d))


@query(rf"""WITH {_L}, {_S}, i AS (SELECT *, regexp_matches(text, '^\s*(?:[-*•+]|[0-9]{{1,3}}[.)])\s+\S') AS it FROM S), r AS (SELECT *, sum(n) OVER ({_O})::BIGINT AS run FROM (SELECT *, (it IS DISTINCT FROM lag(it) OVER ({_O}))::INT AS n FROM i))
  SELECT doc, run, page, line, (dense_rank() OVER (PARTITION BY doc, run ORDER BY x0) - 1)::INT AS depth FROM r WHERE it""")
def list_items(spark, d):
    return y.list_items(lines(spark, d))


@query(rf"""WITH {_L}, {_S}, z AS (SELECT *, max(x1) OVER (PARTITION BY doc, page) AS w, lag(page) OVER o AS lp, lag(x0) OVER o AS lx, lag(size) OVER o AS ls, lag(mono) OVER o AS lm, lag(bold) OVER o AS lb, lag(y1) OVER o AS ly, lag(x1) OVER o AS le FROM S WINDOW o AS ({_O})),
  n AS (SELECT *, coalesce(page = lp AND x0 = lx AND size = ls AND mono = lm AND bold = lb AND y0 - ly <= 4 AND NOT regexp_matches(text, '^\s*(?:[-*•+>|#]|[0-9]{{1,3}}[.)]\s)') AND (le >= 0.6 * w OR regexp_matches(text, '^\s*[a-z]')), false) AS on_ FROM z), p AS (SELECT *, sum((NOT on_)::INT) OVER ({_O})::BIGINT AS paragraph FROM n)
  SELECT doc, paragraph, min(page) AS page, min_by(line, page * 40 + line) AS line, count(*) AS lines, string_agg(trim(text, ' '), ' ' ORDER BY page, line) AS text FROM p GROUP BY doc, paragraph""")
def merged_paragraphs(spark, d):
    return y.paragraphs(lines(spark, d))


@query(f"WITH {_L}, {_S}, r AS (SELECT *, sum(n) OVER ({_O})::BIGINT AS run FROM (SELECT *, (mono IS DISTINCT FROM lag(mono) OVER ({_O}))::INT AS n FROM S)) SELECT doc, run, min(page) AS first_page, min_by(line, page * 40 + line) AS first_line, count(*) AS lines FROM r WHERE mono GROUP BY doc, run HAVING count(*) >= 2")
def code_runs(spark, d):
    return y.code_runs(lines(spark, d))


@query()
def tidy_code(spark, d):
    """Fenced code of the documents without common indentation, numbers and trailing blanks."""
    t = spread(table(spark, d, "documents").where("text is not null").select("doc_id", "text"))
    code = t.select("doc_id", F.posexplode(F.regexp_extract_all(F.replace("text", F.lit("\r"), F.lit("")), F.lit(r"(?dms)^```[a-z+]*\n(.*?)^```"), F.lit(1))).alias("k", "c"))
    return code.select("doc_id", "k", y.tidy_code(F.col("c")).alias("code"))


_ENTRY = r"^\s*(?:[0-9]+(?:\.[0-9]+)*\.?\s+)?(\S.*?)(?:\s*\.{3,}\s*|\s{2,})[0-9]{1,4}\s*$"


@query(rf"""WITH {_L}, {_S}, b AS (SELECT doc, page - 1000 AS page, line, x0, y0, regexp_replace(text, '^#+\s*', '') || ' ..... ' || page AS text, false AS bold FROM S WHERE bold UNION ALL SELECT doc, page, line, x0, y0, text, bold FROM S),
  e AS (SELECT *, {_KEY.format(f"regexp_extract(text, '{_ENTRY}', 1)")} AS key FROM b), r AS (SELECT *, sum(n) OVER ({_O}) AS run FROM (SELECT *, ((key <> '') IS DISTINCT FROM (lag(key) OVER ({_O}) <> ''))::INT AS n FROM e)), k AS (SELECT *, count(*) OVER (PARTITION BY doc, run) AS m FROM r WHERE key <> '')
  SELECT doc, page, line FROM k WHERE m >= 3 AND EXISTS (SELECT 1 FROM S h WHERE h.bold AND h.doc = k.doc AND {_KEY.format(r"regexp_replace(h.text, '^#+\s*(?:[0-9]+(?:\.[0-9]+)*\.?\s+)?', '')")} = k.key)""")
def leaked_contents(spark, d):
    """Entries of a list of contents made of each document's headings and put before it."""
    ln = lines(spark, d)
    toc = ln.where("bold").withColumns({"text": F.concat(F.regexp_replace("text", r"^#+\s*", ""), F.lit(" ..... "), "page"), "page": F.col("page") - 1000, "bold": F.lit(False)})
    return y.leaked_contents(ln.unionByName(toc))


@query("""SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'del' WHEN event_id % 11 = 0 THEN 'ins' WHEN s >= 0.4 AND (h < 20 OR h > 340) THEN 'del' WHEN s >= 0.4 AND h BETWEEN 80 AND 260 THEN 'ins' ELSE '' END AS role FROM (SELECT event_id, event_id % 360 AS h, (event_id % 10) / 10.0 AS s FROM events)""")
def wording_roles(spark, d):
    e = F.col("event_id")
    return table(spark, d, "events").select("event_id", y.wording_role(e % 360, (e % 10) / 10.0, e % 7 == 0, e % 11 == 0).alias("role"))


@query(f"""WITH {_L}, {_W}, m AS (SELECT *, (x0 + x1) / 2 AS mx, (y0 + y1) / 2 AS my FROM W WHERE page = 0) SELECT doc, page, r::INT AS r, c::INT AS c, string_agg(text, ' ' ORDER BY y0, x0) AS text FROM (SELECT *, floor((my - 72) / 56) AS r, floor((mx - 72) / 120) AS c FROM m WHERE my >= 72 AND my < 240 AND mx >= 72 AND mx < 432) GROUP BY doc, page, r, c""")
def ruled_cells(spark, d):
    """Words of first pages in a grid of four by four drawn rules."""
    w = words(spark, d).where("page = 0")
    pages = w.select("doc", "page").distinct()
    h = pages.select("doc", "page", F.lit("h").alias("kind"), F.explode(F.array(*[F.lit(72.0 + 56 * k) for k in range(4)])).alias("at"))
    v = pages.select("doc", "page", F.lit("v").alias("kind"), F.explode(F.array(*[F.lit(72.0 + 120 * k) for k in range(4)])).alias("at"))
    return y.ruled_cells(w, h.unionByName(v))


@query("""WITH h AS (SELECT unnest(['SF', 'F', 'N', 'A', 'SA']) AS choice, unnest([100, 140, 180, 220, 260]) AS spot), n AS (SELECT l_orderkey AS doc, 90 + 7 * ((l_partkey + l_linenumber) % 25) AS mid, floor(l_quantity)::INT AS votes FROM lineitem), b AS (SELECT doc, mid, votes, arg_min(choice, abs(mid - spot) * 1000 + spot) AS choice FROM n, h GROUP BY ALL)
  SELECT doc, choice, votes FROM (SELECT *, row_number() OVER (PARTITION BY doc, choice ORDER BY mid, votes) AS k FROM b) WHERE k = 1""")
def poll_counts(spark, d):
    """Votes of each order's lines under the nearest of five choices."""
    li = table(spark, d, "lineitem")
    at = lambda x, half: [x.cast("double") - half, x.cast("double") + half]
    mid = 90 + 7 * ((F.col("l_partkey") + F.col("l_linenumber")) % 25)
    a, b = at(mid, 2)
    num = li.select(F.col("l_orderkey").alias("doc"), F.lit(0).alias("page"), F.lit(1).alias("line"), (a + F.floor(F.col("l_quantity")) / 1000).alias("x0"), (b - F.floor(F.col("l_quantity")) / 1000).alias("x1"), F.floor("l_quantity").cast("string").alias("text"))
    heads = F.array(*[F.struct(F.lit(t).alias("text"), F.lit(x - 3.0).alias("x0"), F.lit(x + 3.0).alias("x1")) for t, x in (("SF", 100), ("F", 140), ("N", 180), ("A", 220), ("SA", 260))])
    head = li.select(F.col("l_orderkey").alias("doc")).distinct().select("doc", F.lit(0).alias("page"), F.lit(0).alias("line"), F.explode(heads).alias("h")).select("doc", "page", "line", "h.x0", "h.x1", "h.text")
    return y.poll_counts(head.unionByName(num)).select("doc", "choice", "votes")


@query(f"""WITH {_L}, {_W}, b AS (SELECT DISTINCT doc, page, line, unnest(range(floor(x0 / 6)::INT, floor((x1 - 0.01) / 6)::INT + 1)) AS b FROM W WHERE page = 0), p AS (SELECT doc, page, count(DISTINCT line) AS n, min(b) AS lo, max(b) AS hi FROM b GROUP BY ALL), u AS (SELECT doc, page, b, count(DISTINCT line) AS k FROM b GROUP BY ALL),
  f AS (SELECT e.doc, e.page, e.b FROM (SELECT doc, page, n, unnest(range(lo, hi + 1)) AS b FROM p) e LEFT JOIN u USING (doc, page, b) WHERE coalesce(k, 0) <= 0.1 * n), g AS (SELECT *, b - row_number() OVER (PARTITION BY doc, page ORDER BY b) AS g FROM f) SELECT doc, page, (min(b) * 6)::BIGINT AS start, ((max(b) + 1) * 6)::BIGINT AS stop FROM g GROUP BY doc, page, g""")
def page_gutters(spark, d):
    return y.gutters(words(spark, d).where("page = 0"))


@query("""WITH r AS (SELECT l_orderkey AS area, 'r' || l_linenumber AS reader, l_returnflag AS digest FROM lineitem), n AS (SELECT area, digest, count(DISTINCT reader) AS agreeing FROM r GROUP BY ALL) SELECT area, reader, agreeing FROM (SELECT area, reader, agreeing, row_number() OVER (PARTITION BY area ORDER BY agreeing DESC, CASE reader WHEN 'r3' THEN 0 WHEN 'r1' THEN 1 ELSE 99 END, reader) AS k FROM r JOIN n USING (area, digest)) WHERE k = 1""")
def chosen_readings(spark, d):
    r = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("area"), F.concat(F.lit("r"), "l_linenumber").alias("reader"), F.col("l_returnflag").alias("digest"))
    return y.chosen_readings(r, "area", "reader", "digest", {"r3": 0, "r1": 1})


@query("SELECT user_id, event_id % 4 AS property, array_to_string(list_sort(list_distinct(list(event_type))), ',') AS sources, count(DISTINCT event_type) AS independent FROM events GROUP BY ALL")
def witnesses(spark, d):
    return y.witnesses(table(spark, d, "events").select("user_id", (F.col("event_id") % 4).alias("property"), "event_type"), ["user_id", "property"], "event_type")


@query(f"WITH {_L}, {_W} SELECT doc, page, count(*) AS words, count(*) FILTER (NOT (x0 >= 72 AND x1 <= 300 AND y0 >= 70 AND y1 <= 300)) AS stray FROM W GROUP BY ALL")
def stray_words(spark, d):
    """Words of each page that don't lie in the one cell drawn there."""
    w = words(spark, d)
    cell = w.select("doc", "page").distinct().select("doc", "page", F.lit(72.0).alias("x0"), F.lit(70.0).alias("y0"), F.lit(300.0).alias("x1"), F.lit(300.0).alias("y1"))
    return y.stray_words(w, cell)


@query("SELECT o_orderkey, CASE WHEN p >= 0.8 THEN 'likely' WHEN p >= 0.4 THEN 'possible' ELSE 'unlikely' END AS band FROM (SELECT o_orderkey, 1 / (1 + exp(-(-2.0 + 0.00001 * o_totalprice + 0.3 * (o_orderkey % 5)))) AS p FROM orders)")
def area_bands(spark, d):
    o = table(spark, d, "orders").withColumn("k", F.col("o_orderkey") % 5)
    return o.select("o_orderkey", y.band(y.likelihood({"o_totalprice": 0.00001, "k": 0.3}, -2.0)).alias("band"))


@query(rf"""WITH {_L}, r AS (SELECT *, len(regexp_split_to_array(trim(text, ' '), ' {{3,}}|\t|\|')) >= 3 AS rl FROM L), i AS (SELECT *, sum(n) OVER (PARTITION BY doc, page ORDER BY y0, x0, line) AS run FROM (SELECT *, (rl IS DISTINCT FROM lag(rl) OVER (PARTITION BY doc, page ORDER BY y0, x0, line))::INT AS n FROM r)) SELECT doc, page, min(line) AS first_line, count(*) AS lines FROM i WHERE rl GROUP BY doc, page, run HAVING count(*) >= 3""")
def possible_tables(spark, d):
    return y.row_like_runs(lines(spark, d))


@query(f"""WITH {_L}, c AS (SELECT doc, page, y0, y1, CASE WHEN line % 9 = 4 THEN 'Figure ' || line ELSE text END AS text FROM L), k AS (SELECT doc, page, y0, y1, trim(text, ' ') AS caption FROM c WHERE regexp_matches(text, '^\\s*(?:Figure|Fig\\.|Table)\\s+[0-9]+')),
  i AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY page, y0) AS n FROM (SELECT doc, page * 100 + line AS image, page, y0, y0 + 20 AS y1 FROM L WHERE line % 13 = 5)),
  j AS (SELECT i.doc, i.image, caption, row_number() OVER (PARTITION BY i.doc, i.image ORDER BY CASE WHEN k.y0 >= i.y1 THEN k.y0 - i.y1 ELSE i.y0 - k.y1 END, k.y0, caption) AS r FROM i JOIN k ON k.doc = i.doc AND k.page = i.page AND CASE WHEN k.y0 >= i.y1 THEN k.y0 - i.y1 ELSE i.y0 - k.y1 END BETWEEN 0 AND 60)
  SELECT i.doc, i.image, 'image-' || lpad(n::VARCHAR, 2, '0') AS name, j.caption FROM i LEFT JOIN j ON j.doc = i.doc AND j.image = i.image AND j.r = 1 WHERE n <= 20""")
def captioned_images(spark, d):
    """At most twenty images of a document (the feature), put to every thirteenth line, with their captions."""
    ln = lines(spark, d)
    img = ln.where("line % 13 = 5").select("doc", "page", (F.col("page") * 100 + F.col("line")).alias("image"), "x0", "y0", "x1", (F.col("y0") + 20).alias("y1"))
    text = F.when(F.col("line") % 9 == 4, F.concat(F.lit("Figure "), "line")).otherwise(F.col("text"))
    return y.captioned_images(img.unionByName(img), ln.withColumn("text", text))


@query(f"WITH {_L} SELECT doc, page * 100 + line AS box FROM L WHERE x1 > x0 AND (least(x1, 300.0) - x0) * greatest(0, least(y1, 400.0) - y0) >= 0.8 * (x1 - x0) * (y1 - y0) AND x0 < 300 AND y0 < 400")
def covered_boxes(spark, d):
    """Line boxes of which four fifths lie in a figure that takes the upper left of each page."""
    ln = lines(spark, d)
    fig = ln.select("doc", "page").distinct().select("doc", "page", F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(300.0).alias("x1"), F.lit(400.0).alias("y1"))
    return y.covered_boxes(ln.withColumn("box", F.col("page") * 100 + F.col("line")), fig, "box", 0.8)


@query(f"WITH {_L}, p AS (SELECT doc, count(DISTINCT page) AS pages, sum(length(text)) AS chars, avg(length(text)) AS w FROM L GROUP BY 1) SELECT doc, CASE WHEN pages = 0 THEN 'empty' WHEN chars < 20 * pages THEN 'unreadable' WHEN w < 12 THEN 'slides' WHEN doc % 50 = 0 THEN 'draft' ELSE '' END AS reason FROM p")
def skip_reasons(spark, d):
    p = lines(spark, d).groupBy("doc").agg(F.countDistinct("page").alias("pages"), F.sum(F.length("text")).alias("chars"), F.avg(F.length("text")).alias("w"))
    return p.select("doc", y.skip_reason(F.col("pages"), F.col("chars"), F.col("w") < 12, F.col("doc") % 50 == 0).alias("reason"))


@query("""SELECT draft_tag, string_agg(s, '' ORDER BY id) AS markdown FROM (SELECT draft_tag, id, CASE WHEN k IS NULL THEN '' WHEN k = 'list' AND kind = 'list' THEN chr(10) ELSE chr(10) || chr(10) END || CASE kind WHEN 'heading' THEN '## ' || t WHEN 'list' THEN '- ' || t WHEN 'code' THEN '```cpp' || chr(10) || t || chr(10) || '```' WHEN 'quote' THEN '> ' || replace(t, chr(10), chr(10) || '> ') ELSE t END AS s
  FROM (SELECT *, lag(kind) OVER (PARTITION BY draft_tag ORDER BY id) AS k FROM (SELECT draft_tag, id, CASE id % 5 WHEN 0 THEN 'heading' WHEN 1 THEN 'list' WHEN 2 THEN 'list' WHEN 3 THEN 'code' ELSE CASE WHEN id % 2 = 0 THEN 'quote' ELSE 'paragraph' END END AS kind, CASE WHEN id % 5 < 3 THEN coalesce(title, '') ELSE coalesce(cleaned_text, '') END AS t FROM standard_sections))) GROUP BY 1""")
def emitted_markdown(spark, d):
    """Sections of a draft written as Markdown, with kinds put to them by their ids."""
    k = F.col("id") % 5
    kind = F.when(k == 0, "heading").when(k < 3, "list").when(k == 3, "code").when(F.col("id") % 2 == 0, "quote").otherwise("paragraph")
    s = table(spark, d, "standard_sections").select("draft_tag", "id", kind.alias("kind"), F.when(k == 0, 2).otherwise(1).alias("level"), F.coalesce(F.when(k < 3, F.col("title")).otherwise(F.col("cleaned_text")), F.lit("")).alias("text"), F.lit("cpp").alias("language"))
    return y.emitted_markdown(s, "draft_tag", ["id"])


@query("""WITH b AS (SELECT c_custkey, c_acctbal AS x FROM customer WHERE c_custkey % 3 <> 0), c AS (SELECT c_custkey, c_acctbal + 1 AS x FROM customer WHERE c_custkey % 2 = 0) SELECT 'raised' AS run, c_custkey, round(x, 6) AS x FROM c UNION ALL SELECT 'raised', c_custkey, round(x, 6) FROM b WHERE c_custkey % 2 <> 0 UNION ALL SELECT 'dropped', c_custkey, round(x, 6) FROM b""")
def blessed_baselines(spark, d):
    """A baseline after two new blessings: one that raises all rows it has, and one that drops some of them."""
    cu = table(spark, d, "customer").select("c_custkey", F.col("c_acctbal").alias("x"))
    b = cu.where("c_custkey % 3 <> 0")
    good = y.ratchet(b, cu.where("c_custkey % 2 = 0").withColumn("x", F.col("x") + 1), "c_custkey", ["x"])
    bad = y.ratchet(b, cu.where("c_custkey % 2 = 0").withColumn("x", F.col("x") - (F.col("c_custkey") % 10 == 0).cast("int")), "c_custkey", ["x"])
    return good.withColumn("run", F.lit("raised")).unionByName(bad.withColumn("run", F.lit("dropped"))).select("run", "c_custkey", F.round("x", 6).alias("x"))
