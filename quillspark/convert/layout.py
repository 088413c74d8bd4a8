"""Layout passes over lines, words and boxes of pages, as window and join plans.

Lines: (doc, page, line, x0, y0, x1, y1, text, size, bold, mono); y grows
downwards.  Words: (doc, page, line, word, x0, x1, text).  Rules: (doc, page,
kind, at, lo, hi), kind 'h' at a height or 'v' at a side.  Every pass works
within one document or page; none gathers more than that.

Defined results
  null or empty text     no words; an empty line separates
  single page            no running text, nothing continues
  empty tables           empty results
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PLACE = ("page", "y0", "x0", "line")


def by_doc() -> Window:
    return Window.partitionBy("doc").orderBy(*PLACE)


def islands(df: DataFrame, new: Column, name: str, window) -> DataFrame:
    """Rows numbered by runs: `new` starts one."""
    return df.withColumn("_n", F.when(F.coalesce(new, F.lit(True)), 1).otherwise(0)).withColumn(name, F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, 0))).drop("_n")


def words_from_characters(chars: DataFrame, gap: float) -> DataFrame:
    """(doc, page, line, word, x0, x1, text) from characters (doc, page, line, x0, x1, ch): a gap or a blank ends a word."""
    w = Window.partitionBy("doc", "page", "line").orderBy("x0")
    solid = chars.where(F.trim("ch") != "")
    x = islands(solid, F.col("x0") - F.lag("x1").over(w) > gap, "word", w)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "ch"))), lambda s: s["ch"]), "")
    return x.groupBy("doc", "page", "line", "word").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"), text.alias("text"))


def linked_lines(lines: DataFrame, links: DataFrame) -> DataFrame:
    """(doc, page, line, target): the targets of link boxes (doc, page, x0, y0, x1, y1, target) that a line's box meets."""
    k = links.select("doc", "page", "target", *[F.col(c).alias(f"k_{c}") for c in ("x0", "y0", "x1", "y1")])
    j = lines.join(k, ["doc", "page"]).where("least(x1, k_x1) > greatest(x0, k_x0) and least(y1, k_y1) > greatest(y0, k_y0)")
    return j.select("doc", "page", "line", "target").distinct()


def joined_across_pages(lines: DataFrame) -> DataFrame:
    """(doc, page, tail, head): the last line of a page and the first of the next that run on: no end of a sentence, then a small letter."""
    solid = lines.where(F.trim("text") != "")
    ends = solid.groupBy("doc", "page").agg(F.max_by("text", F.struct(*PLACE)).alias("tail"), F.min_by("text", F.struct(*PLACE)).alias("_h"))
    w = Window.partitionBy("doc").orderBy("page")
    x = ends.withColumn("head", F.lead("_h").over(w)).withColumn("_p", F.lead("page").over(w))
    return x.where((F.col("_p") == F.col("page") + 1) & ~F.col("tail").rlike(r"[.!?:]\s*$") & F.col("head").rlike(r"^\s*[a-z]")).select("doc", "page", "tail", "head")


def snapped_style(spans: DataFrame, style: str) -> DataFrame:
    """Spans (doc, page, line, span, text, style) with the style moved to word edges: a span that starts within a word takes the style of the one before it."""
    w = Window.partitionBy("doc", "page", "line").orderBy("span")
    inside = F.col("text").rlike(r"^\w") & F.lag("text").over(w).rlike(r"\w$")
    return spans.withColumn("snapped", F.when(F.coalesce(inside, F.lit(False)), F.lag(style).over(w)).otherwise(F.col(style)))


def mono_fonts(widths: DataFrame, least: int = 5, cv: float = 0.05) -> DataFrame:
    """(font, mono, why): by a keyword of the name, else by how little the widths of at least `least` characters vary."""
    g = widths.groupBy("font").agg(F.count("*").alias("n"), (F.stddev_pop("width") / F.avg("width")).alias("cv"))
    named = F.lower("font").rlike("mono|courier|consol|typewriter|code")
    even = (F.col("n") >= least) & (F.col("cv") <= cv)
    return g.select("font", (named | even).alias("mono"), F.when(named, "name").when(even, "widths").otherwise("").alias("why"))


def document_measures(lines: DataFrame) -> DataFrame:
    """(doc, pitch, margin, hyphens): median line pitch within pages, the most used left edge (ties: the least), share of lines that end in a hyphen."""
    w = Window.partitionBy("doc", "page").orderBy("y0", "x0", "line")
    x = lines.where(F.trim("text") != "").withColumn("_d", F.col("y0") - F.lag("y0").over(w))
    m = x.groupBy("doc", "x0").agg(F.count("*").alias("n")).groupBy("doc").agg(F.min_by("x0", F.struct(-F.col("n"), "x0")).alias("margin"))
    return x.groupBy("doc").agg(F.median("_d").alias("pitch"), F.avg(F.col("text").rlike(r"\p{L}-\s*$").cast("int")).alias("hyphens")).join(m, "doc")


# Labels of a page's head and the fields they give.
FIELD_LABELS = {"document": r"(?:document(?: number)?|doc\.? no\.?)", "date": "date", "audience": r"(?:audience|project|sub-?group)", "reply-to": r"(?:reply[- ]to|authors?)", "title": "title"}


def labelled_fields(lines: DataFrame, head: int = 30) -> DataFrame:
    """(doc, field, value): the first value of each label among the first `head` lines of a document."""
    x = lines.withColumn("_k", F.row_number().over(by_doc())).where(F.col("_k") <= head)
    pairs = [F.struct(F.lit(f).alias("field"), F.regexp_extract("text", rf"(?i)^\s*\**{p}\**\s*:\s*\**\s*(.*?)\s*$", 1).alias("value")) for f, p in FIELD_LABELS.items()]
    y = x.select("doc", "_k", F.explode(F.array(*pairs)).alias("f")).where("f.value <> ''")
    return y.groupBy("doc", F.col("f.field").alias("field")).agg(F.min_by("f.value", "_k").alias("value"))


def merged_fields(*sources: DataFrame) -> DataFrame:
    """(doc, field, value) of several sources, the first that has a field wins."""
    x = None
    for k, s in enumerate(sources):
        y = s.where("value <> ''").select("doc", "field", "value", F.lit(k).alias("_k"))
        x = y if x is None else x.unionByName(y)
    return x.groupBy("doc", "field").agg(F.min_by("value", F.struct("_k", "value")).alias("value"))


def without_echoes(lines: DataFrame, fields: DataFrame) -> DataFrame:
    """Lines but for those before the first heading that only repeat a field's value."""
    key = lambda c: F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "")
    first = lines.where(F.col("text").rlike(r"^#{1,6}\s")).groupBy("doc").agg(F.min(F.struct(*PLACE)).alias("_first"))
    echo = fields.select("doc", key("value").alias("_key")).where("_key <> ''").distinct().withColumn("_echo", F.lit(True))
    x = lines.withColumn("_key", key("text")).join(first, "doc", "left").join(echo, ["doc", "_key"], "left")
    before = F.coalesce(F.struct(*PLACE) < F.col("_first"), F.lit(True))
    return x.where(~(before & F.coalesce("_echo", F.lit(False)))).select(*lines.columns)


def font_ranks(lines: DataFrame) -> DataFrame:
    """(doc, size, rank): sizes above the one of most characters (ties: the least), the largest first."""
    n = lines.groupBy("doc", "size").agg(F.sum(F.length("text")).alias("n"))
    body = n.groupBy("doc").agg(F.max_by("size", F.struct("n", -F.col("size"))).alias("body"))
    return n.join(body, "doc").where("size > body").select("doc", "size", F.dense_rank().over(Window.partitionBy("doc").orderBy(F.desc("size"))).alias("rank"))


def list_items(lines: DataFrame) -> DataFrame:
    """(doc, run, page, line, depth): bulleted or numbered lines in runs, with their depth by the left edges that occur in the run."""
    item = F.col("text").rlike(r"^\s*(?:[-*•+]|\d{1,3}[.)])\s+\S")
    x = lines.where(F.trim("text") != "").withColumn("_i", item)
    x = islands(x, F.col("_i") != F.lag("_i").over(by_doc()), "run", by_doc()).where("_i")
    return x.select("doc", "run", "page", "line", (F.dense_rank().over(Window.partitionBy("doc", "run").orderBy("x0")) - 1).alias("depth"))


def paragraphs(lines: DataFrame) -> DataFrame:
    """(doc, paragraph, page, line, lines, text): solid lines merged where one runs on: same page, edge, size and style, one pitch apart, no list mark, and no short line before."""
    w = by_doc()
    x = lines.where(F.trim("text") != "")
    before = lambda c: F.lag(c).over(w)
    wide = F.max("x1").over(Window.partitionBy("doc", "page"))
    x = x.withColumn("_w", wide)
    on = (
        (F.col("page") == before("page")) & (F.col("x0") == before("x0")) & (F.col("size") == before("size")) & (F.col("mono") == before("mono")) & (F.col("bold") == before("bold"))
        & (F.col("y0") - before("y1") <= 4) & ~F.col("text").rlike(r"^\s*(?:[-*•+>|#]|\d{1,3}[.)]\s)") & ((before("x1") >= 0.6 * F.col("_w")) | F.col("text").rlike(r"^\s*[a-z]"))
    )
    x = islands(x, ~on, "paragraph", w)
    parts = F.transform(F.array_sort(F.collect_list(F.struct("page", "y0", "x0", "line", "text"))), lambda s: F.trim(s["text"]))
    return x.groupBy("doc", "paragraph").agg(F.min("page").alias("page"), F.min_by("line", F.struct(*PLACE)).alias("line"), F.count("*").alias("lines"), F.array_join(parts, " ").alias("text"))


def code_runs(lines: DataFrame, least: int = 2) -> DataFrame:
    """(doc, run, first_page, first_line, lines): runs of monospaced lines, over empty ones, of at least `least` solid lines."""
    w = by_doc()
    x = lines.where(F.trim("text") != "")
    x = islands(x, F.col("mono") != F.lag("mono").over(w), "run", w).where("mono")
    return x.groupBy("doc", "run").agg(F.min("page").alias("first_page"), F.min_by("line", F.struct(*PLACE)).alias("first_line"), F.count("*").alias("lines")).where(F.col("lines") >= least)


def tidy_code(c: Column) -> Column:
    """A code text without tabs, trailing blanks, line numbers in front of every line, and common indentation."""
    ls = F.transform(F.split(F.replace(F.replace(c, F.lit("\r"), F.lit("")), F.lit("\t"), F.lit("    ")), "\n", -1), lambda x: F.rtrim(x))
    numbered = F.forall(ls, lambda x: (x == "") | x.rlike(r"^\s*\d{1,4}(?:\s|$)"))
    ls = F.when(numbered, F.transform(ls, lambda x: F.regexp_replace(x, r"^\s*\d{1,4} ?", ""))).otherwise(ls)
    solid = F.filter(ls, lambda x: x != "")
    indent = F.coalesce(F.array_min(F.transform(solid, lambda x: F.length(x) - F.length(F.ltrim(x)))), F.lit(0))
    return F.array_join(F.transform(ls, lambda x: F.substring(x, indent + 1, F.length(x))), "\n")


def leaked_contents(lines: DataFrame, least: int = 3) -> DataFrame:
    """(doc, page, line): entries of contents (number, title, page, or dot leaders) in runs of at least `least`, whose titles are headings later on."""
    w = by_doc()
    entry = r"^\s*(?:\d+(?:\.\d+)*\.?\s+)?(\S.*?)(?:\s*\.{3,}\s*|\s{2,})\d{1,4}\s*$"
    key = lambda c: F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "")
    x = lines.where(F.trim("text") != "").withColumn("_k", key(F.regexp_extract("text", entry, 1))).withColumn("_e", F.col("_k") != "")
    x = islands(x, F.col("_e") != F.lag("_e").over(w), "_run", w).where("_e").withColumn("_n", F.count("*").over(Window.partitionBy("doc", "_run"))).where(F.col("_n") >= least)
    heads = lines.where(F.col("text").rlike(r"^#{1,6}\s")).select("doc", key(F.regexp_replace("text", r"^#+\s*(?:\d+(?:\.\d+)*\.?\s+)?", "")).alias("_k")).distinct()
    return x.join(heads, ["doc", "_k"], "left_semi").select("doc", "page", "line")


def wording_role(hue: Column, saturation: Column, struck: Column, underlined: Column) -> Column:
    """del or ins of a span by a line drawn through or under it, else by its colour (red, green or blue); '' without either."""
    red, green = (hue < 20) | (hue > 340), hue.between(80, 260)
    coloured = saturation >= 0.4
    return F.when(struck, "del").when(underlined, "ins").when(coloured & red, "del").when(coloured & green, "ins").otherwise("")


def ruled_cells(words: DataFrame, rules: DataFrame) -> DataFrame:
    """(doc, page, r, c, text): words put into the cells between drawn rules, by their middle."""
    w = lambda k: Window.partitionBy("doc", "page").orderBy(k)
    band = lambda kind, n: rules.where(F.col("kind") == kind).select("doc", "page", "at").distinct().select("doc", "page", (F.row_number().over(w("at")) - 1).alias(n), F.col("at").alias(f"{n}0"), F.lead("at").over(w("at")).alias(f"{n}1")).where(F.col(f"{n}1").isNotNull())
    x = words.withColumn("_x", (F.col("x0") + F.col("x1")) / 2).withColumn("_y", (F.col("y0") + F.col("y1")) / 2)
    x = x.join(band("h", "r"), ["doc", "page"]).where("_y >= r0 and _y < r1").join(band("v", "c"), ["doc", "page"]).where("_x >= c0 and _x < c1")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y0", "x0", "text"))), lambda s: s["text"]), " ")
    return x.groupBy("doc", "page", "r", "c").agg(text.alias("text"))


def poll_counts(words: DataFrame) -> DataFrame:
    """(doc, page, line, choice, votes): numbers of the line below a head of SF F N A SA, each under the nearest choice (ties: the left one)."""
    head = words.where(F.col("text").isin("SF", "F", "N", "A", "SA")).select("doc", "page", "line", F.col("text").alias("choice"), ((F.col("x0") + F.col("x1")) / 2).alias("at"))
    full = head.groupBy("doc", "page", "line").agg(F.countDistinct("choice").alias("n")).where("n = 5")
    head = head.join(full.select("doc", "page", "line"), ["doc", "page", "line"]).withColumn("line", F.col("line") + 1)
    number = words.where(F.col("text").rlike(r"^\d{1,4}$")).select("doc", "page", "line", "x0", ((F.col("x0") + F.col("x1")) / 2).alias("mid"), F.col("text").cast("int").alias("votes"))
    near = number.join(head, ["doc", "page", "line"]).groupBy("doc", "page", "line", "x0", "votes").agg(F.min_by("choice", F.struct(F.abs(F.col("mid") - F.col("at")), "at")).alias("choice"))
    return near.groupBy("doc", "page", "line", "choice").agg(F.min_by("votes", "x0").alias("votes"))


def gutters(words: DataFrame, width: int = 6, share: float = 0.1) -> DataFrame:
    """(doc, page, start, stop): columns of `width` points between the first and the last word that at most `share` of the page's lines cross."""
    cell = words.select("doc", "page", "line", F.explode(F.sequence(F.floor(F.col("x0") / width), F.floor((F.col("x1") - 0.01) / width))).alias("b"))
    page = cell.groupBy("doc", "page").agg(F.countDistinct("line").alias("lines"), F.min("b").alias("lo"), F.max("b").alias("hi"))
    used = cell.groupBy("doc", "page", "b").agg(F.countDistinct("line").alias("n"))
    every = page.select("doc", "page", "lines", F.explode(F.sequence("lo", "hi")).alias("b"))
    w = Window.partitionBy("doc", "page").orderBy("b")
    free = every.join(used, ["doc", "page", "b"], "left").where(F.coalesce("n", F.lit(0)) <= share * F.col("lines"))
    return islands(free, F.col("b") != F.lag("b").over(w) + 1, "_g", w).groupBy("doc", "page", "_g").agg((F.min("b") * width).alias("start"), ((F.max("b") + 1) * width).alias("stop")).drop("_g")


def chosen_readings(readings: DataFrame, area: str, reader: str, digest: str, priority: dict[str, int]) -> DataFrame:
    """(area, reader, agreeing): of each area the reading that most readers share, then the one of the best reader."""
    n = readings.groupBy(area, digest).agg(F.countDistinct(reader).alias("agreeing"))
    rank = F.coalesce(*[F.when(F.col(reader) == r, p) for r, p in priority.items()], F.lit(99))
    return readings.join(n, [area, digest]).groupBy(area).agg(F.min_by(F.struct(reader, "agreeing"), F.struct(-F.col("agreeing"), rank, reader)).alias("b")).select(area, "b.*")


def witnesses(found: DataFrame, key: list[str], source: str) -> DataFrame:
    """(key, sources, independent): the distinct sources that tell a property, and how many they are."""
    return found.groupBy(*key).agg(F.array_join(F.sort_array(F.collect_set(source)), ",").alias("sources"), F.countDistinct(source).alias("independent"))


def stray_words(words: DataFrame, cells: DataFrame) -> DataFrame:
    """(doc, page, words, stray): how many words of a page's table lie in none of its cells (doc, page, x0, y0, x1, y1) as a whole."""
    c = cells.select("doc", "page", *[F.col(k).alias(f"c_{k}") for k in ("x0", "y0", "x1", "y1")])
    held = words.join(c, ["doc", "page"]).where("x0 >= c_x0 and x1 <= c_x1 and y0 >= c_y0 and y1 <= c_y1").select("doc", "page", "line", "word").distinct().withColumn("_in", F.lit(1))
    x = words.join(held, ["doc", "page", "line", "word"], "left")
    return x.groupBy("doc", "page").agg(F.count("*").alias("words"), F.count_if(F.col("_in").isNull()).alias("stray"))


def likelihood(features: dict[str, float], bias: float) -> Column:
    """Logistic likelihood of weighted feature columns."""
    z = F.lit(bias)
    for name, weight in features.items():
        z = z + F.col(name) * weight
    return 1 / (1 + F.exp(-z))


def band(p: Column) -> Column:
    return F.when(p >= 0.8, "likely").when(p >= 0.4, "possible").otherwise("unlikely")


def row_like_runs(lines: DataFrame, least: int = 3) -> DataFrame:
    """(doc, page, first_line, lines): runs of at least `least` lines on a page that have cells: gaps of three blanks or more, tabs or pipes."""
    w = Window.partitionBy("doc", "page").orderBy("y0", "x0", "line")
    x = lines.withColumn("_r", F.size(F.split(F.trim("text"), r" {3,}|\t|\|")) >= 3)
    x = islands(x, F.col("_r") != F.lag("_r").over(w), "_run", w).where("_r")
    return x.groupBy("doc", "page", "_run").agg(F.min("line").alias("first_line"), F.count("*").alias("lines")).where(F.col("lines") >= least).drop("_run")


def captioned_images(images: DataFrame, lines: DataFrame, most: int = 20, reach: float = 60.0) -> DataFrame:
    """(doc, image, name, caption): images (doc, page, image, x0, y0, x1, y1) of distinct ids in reading order, at most `most` a document, with the nearest caption line below or above within `reach`."""
    first = images.groupBy("doc", "image").agg(F.min(F.struct("page", "y0", "x0", "y1")).alias("at"))
    x = first.withColumn("k", F.row_number().over(Window.partitionBy("doc").orderBy("at", "image"))).where(F.col("k") <= most).select("doc", "image", "k", F.col("at.page").alias("page"), F.col("at.y0").alias("i0"), F.col("at.y1").alias("i1"))
    cap = lines.where(F.col("text").rlike(r"^\s*(?:Figure|Fig\.|Table)\s+\d+")).select("doc", "page", "y0", "y1", F.trim("text").alias("caption"))
    far = F.when(F.col("y0") >= F.col("i1"), F.col("y0") - F.col("i1")).otherwise(F.col("i0") - F.col("y1"))
    near = x.join(cap, ["doc", "page"]).withColumn("_d", far).where((F.col("_d") >= 0) & (F.col("_d") <= reach)).groupBy("doc", "image").agg(F.min_by("caption", F.struct("_d", "y0", "caption")).alias("caption"))
    return x.join(near, ["doc", "image"], "left").select("doc", "image", F.format_string("image-%02d", "k").alias("name"), "caption")


def covered_boxes(boxes: DataFrame, others: DataFrame, key: str, share: float) -> DataFrame:
    """(doc, key): boxes of which at least `share` of the area lies in one of the others of the page."""
    o = others.select("doc", "page", *[F.col(k).alias(f"o_{k}") for k in ("x0", "y0", "x1", "y1")])
    part = F.greatest(F.lit(0.0), F.least("x1", "o_x1") - F.greatest("x0", "o_x0")) * F.greatest(F.lit(0.0), F.least("y1", "o_y1") - F.greatest("y0", "o_y0"))
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    return boxes.join(o, ["doc", "page"]).where((area > 0) & (part >= share * area)).select("doc", key).distinct()


def skip_reason(pages: Column, chars: Column, slides: Column, draft: Column) -> Column:
    """Why a document is not converted: empty, unreadable, slides or draft; '' if it is."""
    return F.when(pages == 0, "empty").when(chars < 20 * pages, "unreadable").when(slides, "slides").when(draft, "draft").otherwise("")


def emitted_markdown(sections: DataFrame, doc: str, order: list[str]) -> DataFrame:
    """(doc, markdown) of section rows (doc, kind, level, text, language): headings, lists, code, quotes and paragraphs in order."""
    text, level = F.col("text"), F.coalesce(F.col("level"), F.lit(1))
    md = (
        F.when(F.col("kind") == "heading", F.concat(F.repeat(F.lit("#"), level), F.lit(" "), text)).when(F.col("kind") == "code", F.concat(F.lit("```"), F.coalesce("language", F.lit("")), F.lit("\n"), text, F.lit("\n```")))
        .when(F.col("kind") == "list", F.concat(F.repeat(F.lit("  "), level - 1), F.lit("- "), text)).when(F.col("kind") == "quote", F.concat(F.lit("> "), F.replace(text, F.lit("\n"), F.lit("\n> ")))).otherwise(text)
    )
    parts = F.array_sort(F.collect_list(F.struct(*order, F.col("kind").alias("_kind"), md.alias("_md"))))
    # items of one list follow one another, all else is set apart by an empty line
    joined = F.aggregate(parts, F.struct(F.lit("").alias("s"), F.lit("").alias("k")), lambda a, p: F.struct(F.concat(a["s"], F.when(a["k"] == "", "").when((a["k"] == "list") & (p["_kind"] == "list"), "\n").otherwise("\n\n"), F.coalesce(p["_md"], F.lit(""))).alias("s"), p["_kind"].alias("k")))
    return sections.groupBy(doc).agg(joined["s"].alias("markdown"))


def ratchet(baseline: DataFrame, current: DataFrame, key: str, axes: list[str], forced: bool = False) -> DataFrame:
    """The baseline after a new blessing: all current rows if no axis of any of them drops (or it is forced), else the baseline as it was."""
    drops = baseline.join(current.select(key, *[F.col(a).alias(f"_{a}") for a in axes]), key)
    worse = F.lit(False)
    for a in axes:
        worse = worse | F.coalesce(F.col(f"_{a}") < F.col(a), F.lit(False))
    refused = drops.agg(F.coalesce(F.bool_or(worse), F.lit(False)).alias("refused"))  # one row
    old = baseline.select(key, *axes).crossJoin(F.broadcast(refused)).where(F.col("refused") & ~F.lit(forced))
    kept = baseline.join(current, key, "left_anti").select(key, *axes).crossJoin(F.broadcast(refused)).where(~F.col("refused") | F.lit(forced))
    new = current.select(key, *axes).crossJoin(F.broadcast(refused)).where(~F.col("refused") | F.lit(forced))
    return old.unionByName(kept).unionByName(new).select(key, *axes)
