"""Queries of the scalar text functions, on titles, authors, sections and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions import text as x
from quillspark.session import table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def docs(spark, d):
    return table(spark, d, "documents").where("text is not null")


@query("""SELECT scrape_id, regexp_matches(upper(trim(paper_id)), '^[A-QS-Z]+[0-9]+(R[0-9]+)?$')::VARCHAR AS valid, regexp_replace(upper(trim(paper_id)), 'R[0-9]+$', '') AS base FROM papers""")
def id_parts(spark, d):
    return table(spark, d, "papers").select("scrape_id", x.valid_id(F.col("paper_id")).cast("string").alias("valid"), F.regexp_replace(F.upper(F.trim("paper_id")), r"R\d+$", "").alias("base"))


@query(r"""SELECT doc_id, unnest(list_distinct(regexp_extract_all(regexp_replace(text, '\]\([^)]*\)', ']', 'g'), '\b(?:[PD][0-9]{4,5}R[0-9]+|N[0-9]{4,5})\b'))) AS ref FROM documents WHERE text IS NOT NULL""")
def paper_mentions(spark, d):
    return docs(spark, d).select("doc_id", F.explode(x.paper_ids(F.col("text"))).alias("ref"))


@query(r"""SELECT doc_id, unnest(list_distinct(regexp_extract_all(text, '\[([a-z][a-z0-9]*(?:\.[a-z0-9]+)+)\]', 1))) AS label FROM documents WHERE text IS NOT NULL""")
def label_mentions(spark, d):
    return docs(spark, d).select("doc_id", F.explode(x.stable_labels(F.col("text"))).alias("label"))


@query(r"""SELECT name, count(*) AS n FROM (SELECT doc_id, unnest(list_distinct(regexp_extract_all(text, '`([^`\n]+)`', 1))) AS name FROM documents WHERE text IS NOT NULL) GROUP BY 1""")
def backtick_names(spark, d):
    return docs(spark, d).select("doc_id", F.explode(x.backtick_names(F.col("text"))).alias("name")).groupBy("name").agg(F.count("*").alias("n"))


@query(r"""SELECT scrape_id, unnest(list_distinct(list_transform(regexp_extract_all(url, 'https?://[^\s<>\)\]"'']+'), lambda u: regexp_replace(u, '[.,;:)>"'']+$', '')))) AS link FROM papers WHERE url <> ''""")
def links(spark, d):
    return table(spark, d, "papers").where("url <> ''").select("scrape_id", F.explode(x.urls(F.col("url"))).alias("link"))


@query("SELECT doc_id, greatest(1, floor(length(text) / 3.25))::INT AS tokens, CASE WHEN length(text) > 60 THEN substring(text, 1, 60) || '...' ELSE text END AS head FROM documents WHERE text IS NOT NULL")
def token_estimate(spark, d):
    return docs(spark, d).select("doc_id", x.token_estimate(F.col("text")).alias("tokens"), x.truncated(F.col("text")).alias("head"))


@query(r"""SELECT doc_id, sha256(regexp_replace(regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '(?m)[ \t]+$', '', 'g'), '\n+$', '') || chr(10)) AS digest FROM documents WHERE text IS NOT NULL""")
def near_exact_digest(spark, d):
    return docs(spark, d).select("doc_id", F.sha2(x.near_exact(F.col("text")), 256).alias("digest"))


@query(r"""SELECT id, trim(regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace(translate(replace(x, chr(65533), ''), '‘’“”–—' || chr(160), '''''""-- '), '(?i)\b(self|non|well|cross)-\n', '\1 - ', 'g'), '(\p{L})-\n(\p{Ll})', '\1\2', 'g')), '[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g')) AS t FROM (SELECT id, cleaned_text || CASE id % 3 WHEN 0 THEN ' imple-' || chr(10) || 'mentation self-' || chr(10) || 'contained' WHEN 1 THEN ' Type-' || chr(10) || 'Id' ELSE '' END AS x FROM standard_sections WHERE cleaned_text IS NOT NULL)""")
def coverage_text(spark, d):
    """Cleaned texts with line-end hyphens put to two thirds of them, as the data has none."""
    end = F.when(F.col("id") % 3 == 0, " imple-\nmentation self-\ncontained").when(F.col("id") % 3 == 1, " Type-\nId").otherwise("")
    return table(spark, d, "standard_sections").where("cleaned_text is not null").select("id", x.coverage_text(F.concat("cleaned_text", end)).alias("t"))


@query("""SELECT scrape_id, trim(regexp_replace(authors, '\\s+', ' ', 'g')) AS collapsed FROM papers WHERE authors <> ''""")
def whitespace_collapse(spark, d):
    return table(spark, d, "papers").where("authors <> ''").select("scrape_id", x.collapse(F.col("authors")).alias("collapsed"))


@query(r"""SELECT scrape_id, lower(regexp_extract(regexp_replace(regexp_replace(authors, '\s*\(\s*at\s*\)\s*|\s+at\s+', '@', 'g'), '\s+dot\s+', '.', 'g'), '[a-zA-Z0-9_.+-]+@[a-zA-Z0-9_-]+(?:\.[a-zA-Z0-9_-]+)+')) AS mail FROM papers WHERE regexp_matches(authors, ' at [a-z]+ dot |@')""")
def email_deobfuscate(spark, d):
    p = table(spark, d, "papers").where("authors rlike ' at [a-z]+ dot |@'")
    return p.select("scrape_id", x.plain_email(F.col("authors")).alias("mail"))


_MONTH = "list_position(['" + "', '".join(x.MONTHS) + "'], lower({0}))"
_NAMED = "(?i)(" + "|".join(x.MONTHS) + ")"


@query(rf"""WITH a AS (SELECT scrape_id, trim(document_date) AS s FROM papers UNION ALL SELECT -scrape_id, strftime(mailing, '%B %-d, %Y') FROM (SELECT scrape_id, TRY_CAST(document_date AS DATE) AS mailing FROM papers WHERE regexp_matches(document_date, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')) WHERE mailing IS NOT NULL),
  p AS (SELECT scrape_id, CASE WHEN regexp_matches(s, '^[0-9]{{4}}[-/][0-9]{{1,2}}[-/][0-9]{{1,2}}$') THEN list_transform(string_split(replace(s, '/', '-'), '-'), lambda z: z::INT)
    WHEN regexp_matches(s, '^{_NAMED} [0-9]{{1,2}},? [0-9]{{4}}$') THEN [regexp_extract(s, '([0-9]{{4}})$', 1)::INT, {_MONTH.format("string_split(s, ' ')[1]")}::INT, regexp_extract(s, ' ([0-9]{{1,2}}),? ', 1)::INT]
    WHEN regexp_matches(s, '^[0-9]{{1,2}} {_NAMED},? [0-9]{{4}}$') THEN [regexp_extract(s, '([0-9]{{4}})$', 1)::INT, {_MONTH.format("replace(string_split(s, ' ')[2], ',', '')")}::INT, string_split(s, ' ')[1]::INT] END AS v FROM a)
  SELECT scrape_id, CASE WHEN v[1] BETWEEN 1900 AND 2100 AND v[2] BETWEEN 1 AND 12 AND v[3] BETWEEN 1 AND 31 THEN printf('%04d-%02d-%02d', v[1], v[2], v[3]) ELSE 'other' END AS day FROM p""")
def date_normalise(spark, d):
    """Dates as typed, and (under the negative id) the ISO ones written with the month's name."""
    p = table(spark, d, "papers")
    iso = F.expr(r"case when document_date rlike '^[0-9]{4}-[0-9]{2}-[0-9]{2}$' then try_cast(document_date as date) end")
    named = p.where(iso.isNotNull()).select((-F.col("scrape_id")).alias("scrape_id"), F.date_format(iso, "MMMM d, yyyy").alias("s"))
    rows = p.select("scrape_id", F.col("document_date").alias("s")).unionByName(named)
    return rows.select("scrape_id", F.coalesce(x.normal_date(F.col("s")), F.lit("other")).alias("day"))


@query(r"""SELECT scrape_id, (regexp_matches(upper(target_group), '(^|[^A-Z0-9_])LIBRARY EVOLUTION($|[^A-Z0-9_])') OR regexp_matches(upper(target_group), '(^|[^A-Z0-9_])LEWG($|[^A-Z0-9_])'))::VARCHAR AS lewg, regexp_matches(upper(target_group), '(^|[^A-Z0-9_])CORE($|[^A-Z0-9_])')::VARCHAR AS core FROM papers WHERE target_group IS NOT NULL""")
def phrase_flags(spark, d):
    g = F.col("target_group")
    flag = lambda c: c.cast("string")
    return table(spark, d, "papers").where("target_group is not null").select("scrape_id", flag(x.has_phrase(g, "LIBRARY EVOLUTION") | x.has_phrase(g, "LEWG")).alias("lewg"), flag(x.has_phrase(g, "CORE")).alias("core"))


@query(r"""SELECT scrape_id, coalesce(list_filter(list_transform(regexp_split_to_array(target_group, '[^A-Za-z0-9]+'), lambda t: CASE WHEN starts_with(lower(t), 'lewg') THEN 'lewg' WHEN starts_with(lower(t), 'lwg') THEN 'lwg' WHEN starts_with(lower(t), 'ewg') THEN 'ewg' WHEN starts_with(lower(t), 'cwg') THEN 'cwg' WHEN starts_with(lower(t), 'sg') THEN 'sg' END), lambda z: z IS NOT NULL)[1], 'ewg') AS room FROM papers WHERE target_group IS NOT NULL""")
def route_first_token(spark, d):
    tokens = F.split("target_group", "[^A-Za-z0-9]+", -1)
    return table(spark, d, "papers").where("target_group is not null").select("scrape_id", x.first_prefixed(tokens, ("lewg", "lwg", "ewg", "cwg", "sg"), "ewg").alias("room"))


@query(r"""SELECT doc_id, kind, count(*) AS n FROM (SELECT doc_id, CASE WHEN regexp_matches(t, '^[DPN][0-9]{4,5}(R[0-9]+)?$') THEN 'id' WHEN regexp_matches(t, '^[0-9]{4}-[0-9]{2}(-[0-9]{2})?$') THEN 'date' WHEN regexp_matches(t, '^[0-9.,%+-]*[0-9][0-9.,%+-]*$') THEN 'num' WHEN t <> '' AND NOT regexp_matches(t, '[0-9a-zA-Z_\s]') THEN 'mark'
  WHEN regexp_matches(t, '[;{}]$|::|^#include') THEN 'code' WHEN regexp_matches(t, '^[\p{L} ''-]+$') THEN 'word' ELSE 'mixed' END AS kind FROM (SELECT doc_id, regexp_replace(unnest(string_split(text, chr(10))), '^\s+|\s+$', '', 'g') AS t FROM documents WHERE text IS NOT NULL)) GROUP BY ALL""")
def line_kinds(spark, d):
    return docs(spark, d).select("doc_id", F.explode(F.split("text", "\n", -1)).alias("t")).groupBy("doc_id", x.line_kind(F.col("t")).alias("kind")).agg(F.count("*").alias("n"))


@query(r"""SELECT id, array_to_string(list_sort(list_distinct(list_transform(flatten(list_transform(regexp_extract_all(raw_latex, '\\i?ref\{([^{}]+)\}', 1), lambda z: string_split(z, ','))), lambda y: trim(y)))), ',') AS refs FROM standard_sections WHERE raw_latex IS NOT NULL""")
def latex_xrefs(spark, d):
    return table(spark, d, "standard_sections").where("raw_latex is not null").select("id", F.array_join(F.sort_array(x.latex_xrefs(F.col("raw_latex"))), ",").alias("refs"))


@query(r"""SELECT term, count(*) AS n FROM (SELECT unnest(list_distinct(regexp_extract_all(raw_latex, '\\index(?:text|library|libraryglobal|defn)?\{([^{}]+)\}', 1))) AS term FROM standard_sections) GROUP BY 1""")
def index_terms(spark, d):
    return table(spark, d, "standard_sections").select(F.explode(x.latex_index_terms(F.col("raw_latex"))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))


@query(r"""SELECT draft_tag, term, min(id) AS first_id FROM (SELECT draft_tag, id, unnest(list_distinct(regexp_extract_all(raw_latex, '\\defnx?\{([^{}]+)\}', 1))) AS term FROM standard_sections) GROUP BY ALL""")
def defined_terms(spark, d):
    """Terms of each draft, the first definition wins."""
    s = table(spark, d, "standard_sections").select("draft_tag", "id", F.explode(x.latex_definitions(F.col("raw_latex"))).alias("term"))
    return s.groupBy("draft_tag", "term").agg(F.min("id").alias("first_id"))


@query(r"""SELECT id, pos, CASE WHEN contains(p, '\begin{note}') THEN 'note' WHEN contains(p, '\begin{example}') THEN 'example' WHEN contains(lower(p), 'behavior is undefined') THEN 'undefined' WHEN contains(lower(p), 'no diagnostic is required') THEN 'ill-formed-ndr' WHEN contains(lower(p), 'ill-formed') THEN 'ill-formed'
  WHEN regexp_matches(lower(p), 'implementation-defined|unspecified') THEN 'implementation' WHEN regexp_matches(lower(p), '\bshall\b') THEN 'requirement' ELSE 'normative' END AS force FROM (SELECT id, unnest(l) AS p, generate_subscripts(l, 1) - 1 AS pos FROM (SELECT id, string_split(raw_latex, '\pnum') AS l FROM standard_sections WHERE raw_latex IS NOT NULL)) WHERE trim(p, chr(10) || ' ') <> ''""")
def paragraph_force(spark, d):
    s = table(spark, d, "standard_sections").where("raw_latex is not null").select("id", F.posexplode(F.split("raw_latex", r"\\pnum", -1)).alias("pos", "p"))
    return s.where(F.trim(F.col("p"), F.lit("\n ")) != "").select("id", F.col("pos").cast("long").alias("pos"), x.normative_force(F.col("p")).alias("force"))


def _macros(c: str) -> str:
    for _ in range(2):
        for pattern, put in x.MACROS:
            c = f"regexp_replace({c}, '{pattern.replace(chr(39), chr(39) * 2)}', '{put.replace('$1', chr(92) + '1').replace(chr(39), chr(39) * 2)}', 'g')"
    return c


@query(f"SELECT id, {_macros('raw_latex')} AS text FROM standard_sections WHERE raw_latex IS NOT NULL")
def macro_expansion(spark, d):
    return table(spark, d, "standard_sections").where("raw_latex is not null").select("id", x.expand_macros(F.col("raw_latex")).alias("text"))


@query(r"""SELECT intent, count(*) AS n FROM (SELECT CASE WHEN regexp_matches(q, '^\[?[a-z]+(\.[a-z0-9]+)+\]?$') THEN 'label' WHEN regexp_matches(q, '^(is there|does .* exist|exists)\b') THEN 'exist' WHEN regexp_matches(q, '^(define|definition of|what is)\b') THEN 'define' WHEN regexp_matches(q, '\b(grammar|production|bnf)\b') THEN 'grammar'
  WHEN regexp_matches(q, '\b(effects|returns|requires|preconditions|complexity)\b') THEN 'spec' WHEN regexp_matches(q, '\b(refers to|references|cited by|uses of)\b') THEN 'xref' ELSE 'search' END AS intent FROM (SELECT lower(trim(to_label)) AS q FROM section_xrefs UNION ALL SELECT lower(trim(title)) FROM papers)) WHERE intent IS NOT NULL GROUP BY 1""")
def query_intents(spark, d):
    q = table(spark, d, "section_xrefs").select(F.col("to_label").alias("q")).unionByName(table(spark, d, "papers").select(F.col("title").alias("q")))
    return q.select(x.query_intent(F.col("q")).alias("intent")).groupBy("intent").agg(F.count("*").alias("n"))


_U = "('0x' || substr(sha256({0}), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0"


@query(f"""WITH v AS (SELECT c_nationkey, o_orderkey % 50 AS target, {_U.format("'vote:' || c_custkey || ':' || o_orderkey")} AS u, {_U.format("'side:' || c_custkey || ':' || o_orderkey")} AS w FROM customer JOIN orders ON o_custkey = c_custkey)
  SELECT target, count(*) FILTER (u < 0.45) AS votes, count(*) FILTER (u < 0.45 AND w < 0.7) AS up FROM v GROUP BY 1""")
def vote_totals(spark, d):
    """Draws from hashes alone: the same on every machine and in any order."""
    v = table(spark, d, "customer").select("c_custkey").join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"))
    u, w = x.stable_uniform(F.lit("vote"), F.col("c_custkey"), F.col("o_orderkey")), x.stable_uniform(F.lit("side"), F.col("c_custkey"), F.col("o_orderkey"))
    v = v.select((F.col("o_orderkey") % 50).alias("target"), u.alias("u"), w.alias("w"))
    return v.groupBy("target").agg(F.count_if(F.col("u") < 0.45).alias("votes"), F.count_if((F.col("u") < 0.45) & (F.col("w") < 0.7)).alias("up"))


@query(f"SELECT c_custkey, ('0x' || substr(sha256('user:' || c_custkey), 1, 16))::UBIGINT::VARCHAR AS key FROM customer")
def stable_keys(spark, d):
    return table(spark, d, "customer").select("c_custkey", x.stable_key(F.lit("user"), F.col("c_custkey")).cast("string").alias("key"))


@query(r"""SELECT id, lower(trim(regexp_replace(regexp_replace(regexp_replace(l, '(?:\s*\.){5,}\s*[0-9]*\s*$|(?:\s+\.){3,}\s*[0-9]*\s*$', ''), '^\s*(?:[0-9]+(?:\.[0-9]+)*\.?|[A-Z]\.)\s+', ''), '\s+', ' ', 'g'))) AS entry, regexp_matches(l, '\.{5,}|(?:\. ){3,}')::VARCHAR AS leader
  FROM (SELECT id, section_number || ' ' || title || CASE id % 4 WHEN 0 THEN ' ........ ' || id WHEN 1 THEN ' . . . . ' || id WHEN 2 THEN ' ... and so on' ELSE '' END AS l FROM standard_sections WHERE section_number IS NOT NULL AND title IS NOT NULL)""")
def toc_entries(spark, d):
    s = table(spark, d, "standard_sections").where("section_number is not null and title is not null")
    end = F.when(F.col("id") % 4 == 0, F.concat(F.lit(" ........ "), "id")).when(F.col("id") % 4 == 1, F.concat(F.lit(" . . . . "), "id")).when(F.col("id") % 4 == 2, " ... and so on").otherwise("")
    line = F.concat("section_number", F.lit(" "), "title", end)
    return s.select("id", x.toc_entry(line).alias("entry"), x.has_leader(line).cast("string").alias("leader"))


@query("""SELECT scrape_id, regexp_replace(title, '\\s*::\\s*', '::', 'g') AS title, CASE WHEN starts_with(lower(trim(title)), 'info:') THEN 'info' WHEN starts_with(lower(trim(title)), 'ask:') OR starts_with(lower(trim(title)), 'draft:') OR starts_with(lower(trim(title)), 'd:') THEN 'ask' ELSE '' END AS intent FROM papers WHERE title IS NOT NULL""")
def title_intents(spark, d):
    p = table(spark, d, "papers").where("title is not null")
    return p.select("scrape_id", x.joined_colons(F.col("title")).alias("title"), x.intent(F.col("title")).alias("intent"))


@query("""SELECT lang, count(*) AS n, sum((t <> e)::INT)::BIGINT AS changed FROM (SELECT lang, text AS t, array_to_string(list_transform(string_split(text, ''), lambda c: CASE WHEN unicode(c) > 127 THEN '&#' || unicode(c) || ';' ELSE c END), '') AS e FROM documents WHERE text IS NOT NULL) GROUP BY 1""")
def entity_escapes(spark, d):
    t = docs(spark, d).where("text is not null").select("lang", F.col("text").alias("t"))
    return t.groupBy("lang").agg(F.count("*").alias("n"), F.sum((F.col("t") != x.entities(F.col("t"))).cast("int")).alias("changed"))


@query(r"""SELECT doc_id, len(regexp_extract_all(regexp_replace(replace(text, chr(13) || chr(10), chr(10)), '(?ms)^\s*```.*?^\s*```\s*$', '', 'g'), chr(65533) || '|[ÃÂâ][' || chr(128) || '-' || chr(191) || '€™œ“”¦]'))::INT AS broken FROM documents WHERE text IS NOT NULL""")
def mojibake_counts(spark, d):
    return docs(spark, d).where("text is not null").select("doc_id", x.broken_chars(F.col("text")).alias("broken"))


@query(r"""SELECT CASE WHEN l IN ('c++', 'cc', 'cxx', 'hpp', 'h', 'cpp') THEN 'cpp' WHEN l IN ('py', 'python3', 'python') THEN 'python' WHEN l IN ('sh', 'shell', 'console', 'bash') THEN 'bash' WHEN l = 'js' THEN 'javascript' WHEN l = 'yml' THEN 'yaml' WHEN l = 'txt' THEN 'text' ELSE l END AS language, count(*) AS n
  FROM (SELECT lower(trim(unnest(regexp_extract_all(text, '(?m)^```([\w+#-]+)', 1)))) AS l FROM documents WHERE text IS NOT NULL) GROUP BY 1""")
def code_languages(spark, d):
    f = docs(spark, d).select(F.explode(F.regexp_extract_all("text", F.lit(r"(?m)^```([\w+#-]+)"), F.lit(1))).alias("l"))
    return f.groupBy(x.code_language(F.col("l")).alias("language")).agg(F.count("*").alias("n"))


@query(r"""SELECT id, (len(regexp_extract_all(replace(replace(raw_latex, '\{', ''), '\}', ''), '\{')) = len(regexp_extract_all(replace(replace(raw_latex, '\{', ''), '\}', ''), '\}')) AND len(regexp_extract_all(raw_latex, '\\begin\{')) = len(regexp_extract_all(raw_latex, '\\end\{')) AND len(regexp_extract_all(replace(raw_latex, '\$', ''), '\$')) % 2 = 0 AND len(regexp_extract_all(raw_latex, '\\\(')) = len(regexp_extract_all(raw_latex, '\\\)')))::VARCHAR AS balanced FROM standard_sections WHERE raw_latex IS NOT NULL""")
def latex_guards(spark, d):
    return table(spark, d, "standard_sections").where("raw_latex is not null").select("id", x.balanced_latex(F.col("raw_latex")).cast("string").alias("balanced"))


@query(r"""SELECT scrape_id, array_to_string(list_transform(regexp_extract_all(title, '`[^`\n]*`|[^`]+|`'), lambda p: CASE WHEN regexp_matches(p, '^`.*`$') THEN p ELSE regexp_replace(p, '([\\*_\[\]<>])', '\\\1', 'g') END), '') AS title FROM papers WHERE title IS NOT NULL""")
def markdown_escapes(spark, d):
    return table(spark, d, "papers").where("title is not null").select("scrape_id", x.escaped_markdown(F.col("title")).alias("title"))


@query(r"""WITH p AS (SELECT DISTINCT title, trim(regexp_replace(title, '[^\p{L}\p{N}_:]+', ' ', 'g')) AS plain FROM papers WHERE title IS NOT NULL), b AS (SELECT *, regexp_replace(plain, '\bstd::', '', 'g') AS bare FROM p), v AS (SELECT title, [trim(title), plain, bare, regexp_extract(bare, '([0-9A-Za-z_]+)[^0-9A-Za-z_]*$', 1)] AS l FROM b),
  f AS (SELECT title, list_filter(l, lambda z, i: z <> '' AND NOT list_contains(l[1:i - 1], z)) AS l FROM v) SELECT title, generate_subscripts(l, 1) - 1 AS place, unnest(l) AS variant FROM f""")
def search_variants(spark, d):
    return table(spark, d, "papers").where("title is not null").select("title").distinct().select("title", F.posexplode(x.search_variants(F.col("title"))).alias("place", "variant"))


@query("""WITH c AS (SELECT draft_tag, stable_label, list(DISTINCT id ORDER BY id) AS a FROM standard_sections GROUP BY ALL), e AS (SELECT draft_tag, to_label AS stable_label, list(DISTINCT xref_id ORDER BY xref_id) AS b FROM section_xrefs GROUP BY ALL)
  SELECT draft_tag, stable_label, len(list_distinct(list_concat(a, coalesce(b, []))))::INT AS ids FROM c LEFT JOIN e USING (draft_tag, stable_label)""")
def evidence_union(spark, d):
    """Ids of the rows and of the references of each label, without repeats."""
    c = table(spark, d, "standard_sections").select("draft_tag", "stable_label", "id")
    e = table(spark, d, "section_xrefs").select("draft_tag", F.col("to_label").alias("stable_label"), F.col("xref_id").alias("id"))
    known = c.select("draft_tag", "stable_label").distinct()
    ids = c.unionByName(e.join(known, ["draft_tag", "stable_label"], "left_semi").select("draft_tag", "stable_label", "id")).distinct()
    return ids.groupBy("draft_tag", "stable_label").agg(F.count("*").cast("int").alias("ids"))
