"""Queries of lines and blocks: authors, facts, code, comments, references and runs."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from quillspark.functions import blocks as b
from quillspark.functions import udfs
from quillspark.operators import facts as fa
from quillspark.operators import routing as r
from quillspark.operators import sequence as s
from quillspark.operators.gates import handles_unknown
from quillspark.operators.measures import rounded
from quillspark.operators.simulate import thread_violations as violations
from quillspark.search import SectionIndex
from quillspark.session import ship, spread, table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def docs(spark, d):
    return spread(table(spark, d, "documents").where("text is not null").select("doc_id", "text"))


def lines(spark, d):
    return docs(spark, d).select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))


@query()
def author_lines(spark, d):
    """Names and addresses of the authors of each paper, from its field cut at semicolons and line ends."""
    ship(spark)

    def pair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            yield pd.DataFrame([(k, n, a) for k, ls in zip(x["scrape_id"], x["l"]) for n, a in enumerate(b.author_lines(list(ls)), 1)], columns=["scrape_id", "place", "author"])

    p = table(spark, d, "papers").where("authors is not null").select("scrape_id", F.split("authors", "[;\n]|<br>").alias("l"))
    return p.mapInPandas(pair, "scrape_id long, place int, author string")


_LABEL = r"\*{0,2}(?:" + "|".join(r.LABELS) + r")\*{0,2}\s*:"
# lines of wording put to the texts, which have few of their own
_WORDING = "CASE doc_id % 4 WHEN 0 THEN chr(10) || '*Effects:* none' WHEN 1 THEN chr(10) || 'item-list: item item-list' WHEN 2 THEN chr(10) || 'add: more' || chr(10) || 'note: See it.' ELSE '' END"
_ALL = f"(SELECT doc_id, unnest(string_split(text || {_WORDING}, chr(10))) AS line FROM documents WHERE text IS NOT NULL)"


@query(rf"""SELECT kind, count(*) AS n FROM (SELECT CASE WHEN regexp_matches(line, '(?i)^\s*{_LABEL}') THEN 'label' WHEN regexp_matches(line, '^\s*[a-z][a-z0-9_-]*\s*:\s*.') AND NOT regexp_matches(line, '^\s*(?:{"|".join(r.NO_RULES)})\s*:')
  AND NOT regexp_matches(regexp_extract(line, '^\s*[a-z][a-z0-9_-]*\s*:\s*(.+)$', 1), '[A-Z]|[.!?](?:\s|$)') THEN 'rule' ELSE 'text' END AS kind FROM (SELECT replace(line, chr(13), '') AS line FROM {_ALL})) GROUP BY 1""")
def labelled_lines(spark, d):
    """Lines that are labels of normative elements or rules of grammars, with some put to the texts."""
    own = F.expr(_WORDING.replace("chr(10)", "char(10)"))
    x = docs(spark, d).select(F.explode(F.split(F.replace(F.concat("text", own), F.lit("\r"), F.lit("")), "\n", -1)).alias("line"))
    kind = F.when(r.is_label_line(F.col("line")), "label").when(r.is_rule_line(F.col("line")), "rule").otherwise("text")
    return x.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


@query(r"""SELECT doc_id, sha256(regexp_replace(translate(text, '①②③④⑤⑥⑦⑧⑨', '123456789'), '[^\p{L}\p{N}_]', '', 'g')) AS digest FROM documents WHERE text IS NOT NULL""")
def content_digest(spark, d):
    return docs(spark, d).select("doc_id", F.sha2(b.content_only(F.col("text")), 256).alias("digest"))


_FENCE = "'```'"
_DRAWN = f"CASE doc_id % 5 WHEN 0 THEN chr(10) || {_FENCE} || chr(10) || '$ make' || chr(10) || '$ ctest' || chr(10) || {_FENCE} WHEN 1 THEN chr(10) || {_FENCE} || chr(10) || 'list ::= item' || chr(10) || {_FENCE} WHEN 2 THEN chr(10) || {_FENCE} || chr(10) || '[1, {{\"a\": 2}}]' || chr(10) || {_FENCE} WHEN 3 THEN chr(10) || {_FENCE} || chr(10) || '+---+' || chr(10) || {_FENCE} ELSE '' END"
_BLOCK = "regexp_extract_all(replace(text || " + _DRAWN + r", chr(13), ''), '(?ms)^```[a-z+]*\n(.*?)^```', 1)"


@query(rf"""SELECT kind, count(*) AS n FROM (SELECT CASE WHEN regexp_matches(regexp_extract(c, '^\s*([^\n]*)', 1), '^(?:#!|[$>] |(?:{b._COMMANDS})\s)') OR len(regexp_extract_all(c, '(?m)^\s*\$ ')) >= 2 THEN 'shell' WHEN contains(c, '::=') THEN 'grammar' WHEN regexp_matches(c, '^\s*[\[{{]') AND regexp_matches(c, '"[^"\n]*"\s*:') THEN 'json'
  WHEN regexp_matches(c, '(?m)^\s*\+-[-+]*-\+\s*$') OR regexp_matches(c, '[\x{{2500}}-\x{{257f}}]') THEN 'diagram' ELSE 'code' END AS kind FROM (SELECT unnest({_BLOCK}) AS c FROM documents WHERE text IS NOT NULL)) GROUP BY 1""")
def block_kinds(spark, d):
    """What code blocks look like, with a block put to most texts."""
    drawn = F.expr(_DRAWN.replace("chr(10)", "char(10)"))
    c = docs(spark, d).select(F.explode(F.regexp_extract_all(F.replace(F.concat("text", drawn), F.lit("\r"), F.lit("")), F.lit(r"(?dms)^```[a-z+]*\n(.*?)^```"), F.lit(1))).alias("c"))
    return c.groupBy(b.block_kind(F.col("c")).alias("kind")).agg(F.count("*").alias("n"))


_RULES = ", ".join(f"CASE WHEN regexp_matches(t, '{p}'){' AND NOT contains(t, chr(96) || chr(96) || chr(96))' if code else ''} THEN '{n}' END" for n, p, code in b.RULES)
_COMMENT = "text || CASE doc_id % 5 WHEN 0 THEN ' A typo, as @someone said.' WHEN 1 THEN ' Only idiots would; my brief says so, @NATION_1.' ELSE '' END"


@query(f"""SELECT doc_id, unnest(list_filter([{_RULES}], lambda z: z IS NOT NULL)) AS rule FROM (SELECT doc_id, {_COMMENT} AS t FROM documents WHERE text IS NOT NULL)
  UNION ALL SELECT doc_id, 'unknown-handle:someone' FROM documents WHERE text IS NOT NULL AND doc_id % 5 = 0""")
def content_rules(spark, d):
    """Content rules that texts with a remark put to some of them break."""
    remark = F.when(F.col("doc_id") % 5 == 0, " A typo, as @someone said.").when(F.col("doc_id") % 5 == 1, " Only idiots would; my brief says so, @NATION_1.").otherwise("")
    t = docs(spark, d).select("doc_id", F.concat("text", remark).alias("t"))
    own = t.select("doc_id", F.explode(b.broken_rules(F.col("t"))).alias("rule"))
    roster = table(spark, d, "nation").select("n_name")
    handles = handles_unknown(t.select("doc_id", F.regexp_extract("t", r"(?:A typo|Only idiots)[^\n]*$", 0).alias("t")), "doc_id", "t", roster, "n_name")
    return own.unionByName(handles.select("doc_id", F.concat(F.lit("unknown-handle:"), "handle").alias("rule")))


_QUOTES = r"list_transform(regexp_extract_all({0}, '(?m)(?:^[ \t]*>[^\n]*(?:\n|\z))+'), lambda q: trim(regexp_replace(regexp_replace(q, '(?m)^[ \t]*[> ]+', '', 'g'), '\s+', ' ', 'g')))"


@query(rf"""WITH x AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '> ' || substring(text, 1, 40) || chr(10) || 'So it is.' WHEN 1 THEN '> not what it says' || chr(10) || '> ' || chr(10) ELSE 'No quote.' END AS t, regexp_replace(text, '\s+', ' ', 'g') AS source FROM (SELECT doc_id, replace(text, chr(13), '') AS text FROM documents WHERE text IS NOT NULL AND NOT starts_with(ltrim(text), '>')))
  SELECT doc_id, len(q)::INT AS quotes, (len(list_filter(q, lambda z: z <> '' AND contains(source, z))) > 0)::VARCHAR AS verbatim FROM (SELECT doc_id, source, {_QUOTES.format("t")} AS q FROM x)""")
def quote_check(spark, d):
    """Whether a comment's blockquotes are verbatim text of the document it is about (which doesn't start with one)."""
    t = docs(spark, d).where(~F.ltrim("text").startswith(">")).select("doc_id", F.replace("text", F.lit("\r"), F.lit("")).alias("text"))
    comment = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("> "), F.substring("text", 1, 40), F.lit("\nSo it is."))).when(F.col("doc_id") % 3 == 1, "> not what it says\n> \n").otherwise("No quote.")
    x = t.select("doc_id", b.quoted_blocks(comment).alias("q"), F.regexp_replace("text", r"\s+", " ").alias("source"))
    return x.select("doc_id", F.size("q").alias("quotes"), F.exists("q", lambda z: (z != "") & F.col("source").contains(z)).cast("string").alias("verbatim"))


_REF = r"\b(?:[PD][0-9]{4,5}R[0-9]+|N[0-9]{4,5})\b"


@query(rf"""WITH l AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS pos FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)), m AS (SELECT doc_id, pos, regexp_extract(line, 'https?://[^\s<>\)\]"'']+') AS url, unnest(regexp_extract_all(line, '{_REF}')) AS ref FROM l)
  SELECT doc_id, ref, count(*) AS n, coalesce(min_by(url, pos) FILTER (url <> ''), '') AS first_url, array_to_string(list_sort(list_distinct(list(pos))), ',') AS lines FROM m GROUP BY ALL""")
def reference_details(spark, d):
    """Papers named in each document: how often, the first address beside one, and the lines."""
    m = lines(spark, d).select("doc_id", "pos", F.regexp_extract("line", r"https?://[^\s<>\)\]\"']+", 0).alias("url"), F.explode(F.regexp_extract_all("line", F.lit(_REF), F.lit(0))).alias("ref"))
    return m.groupBy("doc_id", "ref").agg(
        F.count("*").alias("n"), F.coalesce(F.min_by(F.when(F.col("url") != "", F.col("url")), F.when(F.col("url") != "", F.col("pos"))), F.lit("")).alias("first_url"),
        F.array_join(F.sort_array(F.collect_set("pos")), ",").alias("lines"),
    )


@query("""SELECT l_partkey, l_suppkey, n, row_number() OVER (PARTITION BY l_partkey ORDER BY n DESC, l_suppkey)::INT AS place FROM (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL)""")
def edge_ranks(spark, d):
    e = table(spark, d, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("n"))
    from quillspark.operators.worklists import placed

    return placed(e, ["l_partkey"], F.desc("n"), F.col("l_suppkey"))


@query("""WITH k AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos, event_type AS kind FROM events), m AS (SELECT user_id, p.period, pos, coalesce(kind = lag(kind, p.period) OVER (PARTITION BY user_id, p.period ORDER BY pos), false) AS hit FROM k, (SELECT unnest(range(2, 9))::INT AS period) p),
  i AS (SELECT *, pos - row_number() OVER (PARTITION BY user_id, period ORDER BY pos) AS island FROM m WHERE hit) SELECT user_id, period, (min(pos) - period)::BIGINT AS start, max(pos)::BIGINT AS stop FROM i GROUP BY user_id, period, island HAVING count(*) >= period * 2""")
def periodic_runs(spark, d):
    """Stretches of at least three records of two to eight rows that repeat."""
    from quillspark.operators.worklists import placed

    e = placed(table(spark, d, "events").select("user_id", "event_id", "ts", "event_type"), ["user_id"], F.col("ts"), F.col("event_id"))
    return s.periodic_runs(e.withColumn("pos", F.col("place").cast("long")), ["user_id"], "pos", "event_type")


@query("""WITH c AS (SELECT user_id, event_id AS slot, CASE WHEN event_id % 11 = 0 THEN event_id + 1 WHEN event_id >= 1000 THEN event_id - 1000 END AS up, CASE WHEN event_id < 1000 THEN 0 ELSE 1 + (event_id % 17 = 0)::INT END AS depth FROM events), j AS (SELECT c.*, p.depth AS pd FROM c LEFT JOIN c p ON p.user_id = c.user_id AND p.slot = c.up)
  SELECT DISTINCT user_id, slot, unnest(list_filter([CASE WHEN up IS NOT NULL AND pd IS NULL THEN 'no_parent' END, CASE WHEN pd IS NOT NULL AND depth <> pd + 1 THEN 'wrong_depth' END, CASE WHEN up IS NULL AND depth <> 0 THEN 'deep_root' END], lambda z: z IS NOT NULL)) AS rule FROM j""")
def thread_violations(spark, d):
    e = table(spark, d, "events")
    up = F.when(F.col("event_id") % 11 == 0, F.col("event_id") + 1).when(F.col("event_id") >= 1000, F.col("event_id") - 1000)
    depth = F.when(F.col("event_id") < 1000, 0).otherwise(1 + (F.col("event_id") % 17 == 0).cast("int"))
    return violations(e.select("user_id", F.col("event_id").alias("slot"), up.alias("up"), depth.alias("depth")), "user_id", "slot", "up", "depth")


def _index(spark, d):
    return SectionIndex(*[table(spark, d, t) for t in ("standard_sections", "section_xrefs", "drafts")])


_TAG = "(SELECT max(draft_tag) FROM standard_sections)"
_NORMAL = r"regexp_replace(lower({0}), '^[\s\[\]]+|[\s\[\]]+$', '', 'g')"


@query(f"SELECT id, draft_tag, stable_label, section_number, title, depth FROM standard_sections WHERE draft_tag = {_TAG} AND depth <= 1")
def index_sections(spark, d):
    return _index(spark, d).list_sections(depth=1)


@query(f"SELECT {_NORMAL.format('from_label')} AS label, count(*) AS n FROM section_xrefs WHERE draft_tag = {_TAG} AND {_NORMAL.format('to_label')} = 'glos.terms' AND {_NORMAL.format('from_label')} <> '' GROUP BY 1")
def index_references(spark, d):
    return _index(spark, d).references_to("[glos.terms]")


@query(rf"SELECT id, stable_label, term FROM (SELECT id, stable_label, unnest(list_distinct(regexp_extract_all(raw_latex, '\\index(?:text|library|libraryglobal|defn)?\{{([^{{}}]+)\}}', 1))) AS term FROM standard_sections WHERE draft_tag = {_TAG}) WHERE contains(lower(term), 'e')")
def index_entries(spark, d):
    return _index(spark, d).index_entries("E")


@query()
def sliding_ned(spark, d):
    """Least edit distance of each title with a window of its source file's name, over the title's length."""
    p = spread(table(spark, d, "papers").where("title <> '' and source_file <> ''").select("scrape_id", "title", "source_file"))
    return p.select("scrape_id", rounded(udfs.window_ned("title", "source_file"), 6).alias("ned"))


@query()
def title_similarity(spark, d):
    """Symmetric likeness of a section's title and its parent's."""
    x = table(spark, d, "standard_sections").where("title <> ''")
    up = x.groupBy("draft_tag", F.col("stable_label").alias("parent_label")).agg(F.min("title").alias("up"))
    return x.join(up, ["draft_tag", "parent_label"]).select("id", F.round(udfs.symmetric_ratio("title", "up"), 6).alias("likeness"))


@query("""SELECT doc_id, 3::BIGINT AS facts, 2::BIGINT AS verified, (CASE WHEN contains(t, 'allocator') THEN 0 ELSE 1 END + CASE WHEN contains(t, 'zebraquilt') THEN 1 ELSE 0 END)::BIGINT AS failed FROM (SELECT doc_id, regexp_replace(lower(text), '[^a-z0-9_]', '', 'g') AS t FROM documents WHERE text IS NOT NULL AND regexp_matches(text, '^[\\x00-\\x7f]*$'))""")
def fact_gates(spark, d):
    """Three facts of every ASCII text, two of them verified: a word that is there, one that isn't, and a draft of a third."""
    t = docs(spark, d).where(F.col("text").rlike(r"^[\x00-\x7f]*$"))
    records = [{"id": "a", "type": "present", "text": "Allocator", "checked": True}, {"id": "b", "type": "absent", "text": "zebra quilt", "checked": True}, {"id": "c", "type": "present", "text": "not yet"}]
    f = t.select("doc_id", F.explode(F.array(*[F.lit(json.dumps(x)) for x in records])).alias("record"))
    return fa.fact_gate(fa.check_facts(t, "doc_id", "text", f, "record"), "doc_id").select("doc_id", "facts", "verified", "failed")
