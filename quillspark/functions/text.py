"""Scalar functions over text columns, all inside the JVM; the few that need Python are in `functions.udfs`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of ids, addresses and labels.
PAPER_ID = r"\b(?:[PD]\d{4,5}R\d+|N\d{4,5})\b"
LOOSE_ID = r"\b[DPN]\d{4,5}(?:R\d+)?\b"
URL = r"https?://[^\s<>\)\]\"']+"
LABEL = r"\[([a-z][a-z0-9]*(?:\.[a-z0-9]+)+)\]"

# Months by name.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
# Intents by the first words of a title.
INTENTS = (("info:", "info"), ("ask:", "ask"), ("draft:", "ask"), ("d:", "ask"))


def valid_id(c: Column) -> Column:
    return F.upper(F.trim(c)).rlike(r"^[A-QS-Z]+\d+(R\d+)?$")


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def without_link_targets(c: Column) -> Column:
    return F.regexp_replace(c, r"\]\([^)]*\)", "]")


def paper_ids(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(without_link_targets(c), F.lit(PAPER_ID), F.lit(0)))


def loose_ids(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit(LOOSE_ID), F.lit(0)))


def urls(c: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(URL), F.lit(0)), lambda u: F.regexp_replace(u, r"[.,;:)>\"']+$", "")))


def stable_labels(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit(LABEL), F.lit(1)))


def backtick_names(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"`([^`\n]+)`"), F.lit(1)))


def token_estimate(c: Column, chars_per_token: float = 3.25) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(c) / chars_per_token)).cast("int")


def truncated(c: Column, most: int = 60) -> Column:
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most), F.lit("..."))).otherwise(c)


def joined_colons(c: Column) -> Column:
    return F.regexp_replace(c, r"\s*::\s*", "::")


def near_exact(c: Column) -> Column:
    """Line feeds only, no blanks at line ends, exactly one final line feed."""
    x = F.regexp_replace(F.regexp_replace(c, r"\r\n?", "\n"), r"(?m)[ \t]+$", "")
    return F.concat(F.regexp_replace(x, r"\n+$", ""), F.lit("\n"))


def folded_quotes(c: Column) -> Column:
    return F.translate(c, "‘’“”–—\u00a0", "''\"\"-- ")


def coverage_text(c: Column) -> Column:
    """Lower case, plain quotes, line-end hyphens joined (but after self, non, well and cross), punctuation to blanks."""
    x = folded_quotes(F.replace(c, F.lit("\ufffd"), F.lit("")))
    x = F.regexp_replace(x, r"(?<!\b(?i:self))(?<!\b(?i:non))(?<!\b(?i:well))(?<!\b(?i:cross))(?<=\p{L})-\n(?=\p{Ll})", "")
    return collapse(F.regexp_replace(F.lower(x), r"[^\p{L}\p{N}_\s]", " "))


def without_format_chars(c: Column) -> Column:
    return F.regexp_replace(c, r"\p{Cf}", "")


def entities(c: Column) -> Column:
    """Characters beyond ASCII as decimal entities."""
    plain = ~c.rlike(r"[^\x00-\x7f]")  # nothing to do, as in most long texts
    return F.when(plain, c).otherwise(F.array_join(F.transform(F.split(c, ""), lambda x: F.when(F.ascii(x) > 127, F.concat(F.lit("&#"), F.ascii(x), F.lit(";"))).otherwise(x)), ""))


def plain_email(c: Column) -> Column:
    """`name at host dot tld` and `name (at) host (dot) tld` as an address; others stay."""
    x = F.regexp_replace(c, r"(?i)\s*[\[(]\s*at\s*[\])]\s*|\s+at\s+", "@")
    x = F.regexp_replace(x, r"(?i)\s*[\[(]\s*dot\s*[\])]\s*|\s+dot\s+", ".")
    mail = F.regexp_extract(x, r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+", 0)
    return F.when(mail != "", F.lower(mail))


def normal_date(c: Column) -> Column:
    """ISO date of the usual ways of writing one; days to 31 and years 1900-2100, no calendar check; null otherwise."""
    x = F.trim(c)
    name = "(" + "|".join(m for m in MONTHS) + ")"
    month = lambda s: F.lpad(F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(s)).cast("string"), 2, "0")
    part = lambda p, k: F.regexp_extract(x, p, k)
    iso, mdy, dmy = r"^(\d{4})[-/](\d{1,2})[-/](\d{1,2})$", rf"(?i)^{name} (\d{{1,2}}),? (\d{{4}})$", rf"(?i)^(\d{{1,2}}) {name},? (\d{{4}})$"
    pick = lambda k: F.when(x.rlike(iso), (part(iso, 1), F.lpad(part(iso, 2), 2, "0"), part(iso, 3))[k]).when(x.rlike(mdy), (part(mdy, 3), month(part(mdy, 1)), part(mdy, 2))[k]).when(x.rlike(dmy), (part(dmy, 3), month(part(dmy, 2)), part(dmy, 1))[k])
    y, mo, dd = pick(0), pick(1), F.lpad(pick(2), 2, "0")
    return F.when(y.between("1900", "2100") & mo.between("01", "12") & dd.between("01", "31"), F.concat_ws("-", y, mo, dd))


def intent(title: Column) -> Column:
    out = F.lit("")
    for prefix, name in reversed(INTENTS):
        out = F.when(F.lower(F.trim(title)).startswith(prefix), name).otherwise(out)
    return out


def has_phrase(blob: Column, phrase: str) -> Column:
    """Whole words, upper case."""
    return F.upper(blob).rlike(rf"(?<![A-Z0-9_]){phrase.upper()}(?![A-Z0-9_])")


def first_prefixed(tokens: Column, prefixes: tuple[str, ...], default: str) -> Column:
    """The prefix of the first token that starts with one of them."""
    hit = lambda t: F.coalesce(*[F.when(F.lower(t).startswith(p), p) for p in prefixes])
    return F.coalesce(F.try_element_at(F.filter(F.transform(tokens, hit), lambda x: x.isNotNull()), F.lit(1)), F.lit(default))


def toc_entry(c: Column) -> Column:
    """A contents entry without its number, dot leader and page."""
    x = F.regexp_replace(c, r"(?:\s*\.){5,}\s*\d*\s*$|(?:\s+\.){3,}\s*\d*\s*$", "")
    return F.lower(collapse(F.regexp_replace(x, r"^\s*(?:\d+(?:\.\d+)*\.?|[A-Z]\.)\s+", "")))


def has_leader(c: Column) -> Column:
    return c.rlike(r"\.{5,}|(?:\. ){3,}")


def line_kind(c: Column) -> Column:
    """id, date, num, mark, code, word or mixed."""
    x = F.regexp_replace(c, r"^\s+|\s+$", "")
    return (
        F.when(x.rlike(rf"^{LOOSE_ID}$"), "id").when(x.rlike(r"^\d{4}-\d{2}(-\d{2})?$"), "date").when(x.rlike(r"^[\d.,%+-]*\d[\d.,%+-]*$"), "num")
        .when(x.rlike(r"^[^\w\s]+$"), "mark").when(x.rlike(r"[;{}]$|::|^\s*#include"), "code").when(x.rlike(r"^[\p{L} '-]+$"), "word").otherwise("mixed")
    )


# Language names of code fences and what they mean.
CODE_LANGUAGES = {"c++": "cpp", "cc": "cpp", "cxx": "cpp", "hpp": "cpp", "h": "cpp", "cpp": "cpp", "c": "c", "py": "python", "python3": "python", "python": "python", "sh": "bash", "shell": "bash", "console": "bash", "bash": "bash", "js": "javascript", "javascript": "javascript", "json": "json", "yml": "yaml", "yaml": "yaml", "text": "text", "txt": "text"}


def code_language(c: Column) -> Column:
    m = F.create_map(*[F.lit(x) for kv in CODE_LANGUAGES.items() for x in kv])
    return F.coalesce(m[F.lower(F.trim(c))], F.lower(F.trim(c)))


# Macros of the standard's sources and their text, in order of replacement.
MACROS = ((r"\\(?:tcode|keyword|grammarterm|defn|textit|texttt|textbf|emph|placeholder|exposid)\{([^{}]*)\}", "$1"), (r"\\i?ref\{([^{}]*)\}", "[$1]"), (r"\\Cpp(?:\{\})?", "C++"), (r"\\(?:ldots|dots)", "..."), (r"\\textbackslash ?", "\\\\"), (r"\\([_&%#{}$])", "$1"), (r"``([^`']*)''", '"$1"'), (r"~", " "))


def expand_macros(c: Column, passes: int = 2) -> Column:
    for _ in range(passes):
        for pattern, text in MACROS:
            c = F.regexp_replace(c, pattern, text)
    return c


def latex_xrefs(c: Column) -> Column:
    """Labels of all references, comma lists taken apart."""
    lists = F.regexp_extract_all(c, F.lit(r"\\i?ref\{([^{}]+)\}"), F.lit(1))
    return F.array_distinct(F.flatten(F.transform(lists, lambda x: F.transform(F.split(x, ","), lambda y: F.trim(y)))))


def latex_index_terms(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"\\index(?:text|library|libraryglobal|defn)?\{([^{}]+)\}"), F.lit(1)))


def latex_definitions(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"\\defnx?\{([^{}]+)\}"), F.lit(1)))


def normative_force(c: Column) -> Column:
    x = F.lower(c)
    return (
        F.when(c.contains("\\begin{note}"), "note").when(c.contains("\\begin{example}"), "example").when(x.contains("behavior is undefined"), "undefined")
        .when(x.contains("no diagnostic is required"), "ill-formed-ndr").when(x.contains("ill-formed"), "ill-formed").when(x.rlike(r"implementation-defined|unspecified"), "implementation")
        .when(x.rlike(r"\bshall\b"), "requirement").otherwise("normative")
    )


def query_intent(q: Column) -> Column:
    """What a search query asks for; the first rule that fits."""
    x = F.lower(F.trim(q))
    return (
        F.when(x.rlike(r"^\[?[a-z]+(\.[a-z0-9]+)+\]?$"), "label").when(x.rlike(r"^(is there|does .* exist|exists)\b"), "exist").when(x.rlike(r"^(define|definition of|what is)\b"), "define")
        .when(x.rlike(r"\b(grammar|production|bnf)\b"), "grammar").when(x.rlike(r"\b(effects|returns|requires|preconditions|complexity)\b"), "spec").when(x.rlike(r"\b(refers to|references|cited by|uses of)\b"), "xref").otherwise("search")
    )


def stable_key(*parts: Column) -> Column:
    """First 8 bytes of the SHA-256 of the parts joined by colons, as an unsigned number."""
    h = F.sha2(F.concat_ws(":", *[p.cast("string") for p in parts]), 256)
    return F.conv(F.substring(h, 1, 16), 16, 10).cast("decimal(20,0)")


def stable_uniform(*parts: Column) -> Column:
    return stable_key(*parts).cast("double") / float(1 << 64)


def broken_chars(c: Column) -> Column:
    """Replacement characters and UTF-8 read as one byte each, outside fenced code; a line ends with LF or CR LF."""
    plain = F.regexp_replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), r"(?dms)^\s*```.*?^\s*```\s*$", "")
    return F.size(F.regexp_extract_all(plain, F.lit("\ufffd|[ÃÂâ][\u0080-\u00bf€™œ\u201c\u201d¦]"), F.lit(0)))


def balanced_latex(c: Column) -> Column:
    """Braces, environments and math delimiters come in pairs."""
    n = lambda p: F.size(F.regexp_extract_all(c, F.lit(p), F.lit(0)))
    return (n(r"(?<!\\)\{") == n(r"(?<!\\)\}")) & (n(r"\\begin\{") == n(r"\\end\{")) & (n(r"(?<!\\)\$") % 2 == 0) & (n(r"\\\(") == n(r"\\\)"))


def escaped_markdown(c: Column) -> Column:
    """Markdown's own characters escaped, code spans left as they are."""
    parts = F.regexp_extract_all(c, F.lit(r"`[^`\n]*`|[^`]+|`"), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r"^`.*`$"), p).otherwise(F.regexp_replace(p, r"([\\*_\[\]<>])", r"\\$1"))), "")


def search_variants(q: Column) -> Column:
    """A query as typed, without punctuation, without std::, and its last name alone; distinct, in that order."""
    plain = collapse(F.regexp_replace(q, r"[^\p{L}\p{N}_:]+", " "))
    bare = F.regexp_replace(plain, r"\bstd::", "")
    return F.filter(F.array_distinct(F.array(F.trim(q), plain, bare, F.regexp_extract(bare, r"(\w+)\W*$", 1))), lambda x: x != "")
