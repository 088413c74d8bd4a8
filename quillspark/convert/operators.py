"""Conversion as DataFrame operators, and layout passes over tables of spans."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.convert import html as h
from quillspark.session import checkpointed, lookup_join, ship


def html_documents(df: DataFrame, key: str, html: str) -> DataFrame:
    """(key, markdown, generator, skipped)."""
    ship(df.sparkSession)

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(k, *h.to_markdown(t)) for k, t in zip(b["k"], b["t"])], columns=["k", "markdown", "generator", "skipped"])

    kind = dict(df.dtypes)[key]
    return df.select(F.col(key).alias("k"), F.col(html).alias("t")).mapInPandas(convert, f"k {kind}, markdown string, generator string, skipped string").withColumnRenamed("k", key)


INDEX = "mailing_id string, paper_id string, title string, authors array<string>, document_date string, subgroup string, previous_version string, disposition string, url string"


def index_pages(df: DataFrame, html: str, origin: str = "") -> DataFrame:
    """Rows of index pages; of a paper's repeated rows the first of a page is kept by the caller's order."""
    ship(df.sparkSession)

    def scrape(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([r for t in b["t"] for r in h.index_rows(t or "", origin)], columns=[c.split()[0] for c in INDEX.split(", ")])

    return df.select(F.col(html).alias("t")).mapInPandas(scrape, INDEX)


# ---------------------------------------------------------------- layout: spans(doc, page, block, line, span, x0, y0, x1, y1, text, font, size, bold, mono)

LINE = ["doc", "page", "block", "line"]


def lines_of(spans: DataFrame) -> DataFrame:
    """Spans put together to lines with their box and the share of bold and monospaced characters."""
    n = F.length("text")
    g = spans.groupBy(*LINE).agg(
        F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.max("size").alias("size"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("span", "text"))), lambda s: s["text"]), "").alias("text"),
        (F.sum(F.when(F.col("bold"), n).otherwise(0)) / F.greatest(F.sum(n), F.lit(1))).alias("bold"), (F.sum(F.when(F.col("mono"), n).otherwise(0)) / F.greatest(F.sum(n), F.lit(1))).alias("mono"),
    )
    return g


def body_size(spans: DataFrame) -> DataFrame:
    """(doc, size): the font size of most characters."""
    per = spans.groupBy("doc", F.round("size", 1).alias("size")).agg(F.sum(F.length("text")).alias("n"))
    return per.groupBy("doc").agg(F.max_by("size", F.struct("n", -F.col("size"))).alias("body"))


def edge_lines(lines: DataFrame, n: int = 3) -> DataFrame:
    """The first and last lines of each page."""
    w = Window.partitionBy("doc", "page")
    x = lines.withColumn("_t", F.row_number().over(w.orderBy("y0", "x0"))).withColumn("_b", F.row_number().over(w.orderBy(F.desc("y0"), F.desc("x0"))))
    return x.where((F.col("_t") <= n) | (F.col("_b") <= n)).withColumn("edge", F.when(F.col("_t") <= n, "top").otherwise("bottom")).drop("_t", "_b")


def running_texts(lines: DataFrame, share: float = 0.5) -> DataFrame:
    """(doc, edge, mark): texts (digits masked) that stand at an edge of at least `share` of a document's pages."""
    pages = lines.groupBy("doc").agg(F.countDistinct("page").alias("pages"))
    marks = edge_lines(lines).withColumn("mark", F.regexp_replace(F.trim("text"), r"\d+", "#"))
    per = marks.groupBy("doc", "edge", "mark").agg(F.countDistinct("page").alias("n")).join(pages, "doc")
    return per.where((F.col("pages") >= 2) & (F.col("n") >= share * F.col("pages"))).select("doc", "edge", "mark")


def without_running_texts(lines: DataFrame, share: float = 0.5) -> DataFrame:
    gone = edge_lines(lines).withColumn("mark", F.regexp_replace(F.trim("text"), r"\d+", "#")).join(running_texts(lines, share), ["doc", "edge", "mark"], "left_semi").select(*LINE)
    return lines.join(gone, LINE, "left_anti")


def hidden_spans(spans: DataFrame, covers: DataFrame) -> DataFrame:
    """Spans that lie within a covering rectangle (doc, page, x0, y0, x1, y1) of their page."""
    c = covers.select("doc", "page", *[F.col(k).alias(f"c_{k}") for k in ("x0", "y0", "x1", "y1")])
    j = spans.join(c, ["doc", "page"]).where("x0 >= c_x0 and y0 >= c_y0 and x1 <= c_x1 and y1 <= c_y1")
    return j.select(*LINE, "span").distinct()


def overlaps(a: DataFrame, b: DataFrame, id_a: str, id_b: str) -> DataFrame:
    """(doc, page, id_a, id_b, iou) of boxes that meet on a page."""
    box = ("x0", "y0", "x1", "y1")
    l = a.select("doc", "page", F.col(id_a), *[F.col(k).alias(f"a_{k}") for k in box])  # noqa: E741
    r = b.select("doc", "page", F.col(id_b), *[F.col(k).alias(f"b_{k}") for k in box])
    w = F.least("a_x1", "b_x1") - F.greatest("a_x0", "b_x0")
    t = F.least("a_y1", "b_y1") - F.greatest("a_y0", "b_y0")
    area = lambda p: (F.col(f"{p}_x1") - F.col(f"{p}_x0")) * (F.col(f"{p}_y1") - F.col(f"{p}_y0"))
    j = l.join(r, ["doc", "page"]).withColumn("_i", w * t).where((w > 0) & (t > 0))
    return j.select("doc", "page", id_a, id_b, (F.col("_i") / (area("a") + area("b") - F.col("_i"))).alias("iou"))


def columns(lines: DataFrame, least: float = 0.3) -> DataFrame:
    """Lines with their column (0 or 1): a page has two where at least `least` of its lines lie wholly on either side of its middle."""
    mid = lines.groupBy("doc", "page").agg(((F.min("x0") + F.max("x1")) / 2).alias("mid"))
    x = lines.join(mid, ["doc", "page"])
    side = F.when(F.col("x1") <= F.col("mid"), 0).when(F.col("x0") >= F.col("mid"), 1)
    share = x.groupBy("doc", "page").agg(F.avg((side == 0).cast("int")).alias("l"), F.avg((side == 1).cast("int")).alias("r"), F.count("*").alias("n"))
    n = lambda c: F.count_if(side == c)
    share = x.groupBy("doc", "page").agg((n(0) / F.count("*")).alias("l"), (n(1) / F.count("*")).alias("r"))
    two = (F.col("l") >= least) & (F.col("r") >= least)
    return x.join(share, ["doc", "page"]).withColumn("column", F.when(two, F.coalesce(side, F.lit(0))).otherwise(0)).drop("mid", "l", "r")


def reading_order(lines: DataFrame) -> DataFrame:
    """Lines with their place in the document: page, column, height, left edge."""
    return columns(lines).withColumn("place", F.row_number().over(Window.partitionBy("doc").orderBy("page", "column", "y0", "x0")))


def dehyphenated(lines: DataFrame) -> DataFrame:
    """Line-end hyphens with the document's own evidence: `join` if the joined word occurs elsewhere in it (and the hyphenated one does not), else `keep`."""
    x = reading_order(lines)
    w = Window.partitionBy("doc").orderBy("place")
    left = F.regexp_extract("text", r"(\p{L}+)-\s*$", 1)
    pair = x.withColumn("left", left).withColumn("right", F.regexp_extract(F.lead("text").over(w), r"^\s*(\p{Ll}+)", 1)).where("left <> '' and right <> ''")
    vocab = lines.select("doc", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}]+(?:-[\p{L}]+)*(?!-?\s*$)"), F.lit(0))).alias("word")).distinct()
    p = pair.select("doc", "place", F.lower(F.concat("left", "right")).alias("joined"), F.lower(F.concat("left", F.lit("-"), "right")).alias("hyphened"))
    p = p.join(vocab.select("doc", F.col("word").alias("joined"), F.lit(1).alias("j")), ["doc", "joined"], "left").join(vocab.select("doc", F.col("word").alias("hyphened"), F.lit(1).alias("h")), ["doc", "hyphened"], "left")
    return p.select("doc", "place", "joined", "hyphened", F.when(F.col("j").isNotNull() & F.col("h").isNull(), "join").otherwise("keep").alias("decision"))


def heading_levels(lines: DataFrame, spans: DataFrame) -> DataFrame:
    """Lines above body size, or bold ones with a number, with a level by font rank or by the number's parts, and how sure that is."""
    x = lookup_join(lines, checkpointed(body_size(spans)), ["doc"], "inner")
    number = F.regexp_extract("text", r"^\s*(\d+(?:\.\d+)*)\.?\s+\S", 1)
    large = F.round("size", 1) > F.col("body")
    x = x.where((large | ((F.col("bold") > 0.8) & (number != ""))))
    rank = F.dense_rank().over(Window.partitionBy("doc").orderBy(F.desc(F.round("size", 1))))
    by_number = F.size(F.split(number, r"\."))
    level = F.when(number != "", by_number + 1).otherwise(F.least(rank + 1, F.lit(6)))
    sure = F.when((number != "") & large, "high").when((number != "") | (large & (F.col("bold") > 0.8)), "medium").otherwise("low")
    return x.select(*LINE, F.trim("text").alias("text"), level.cast("int").alias("level"), sure.alias("confidence"))


def grid_rows(lines: DataFrame, gap: float = 12.0) -> DataFrame:
    """Spans of a line put into cells wherever a horizontal gap exceeds `gap`: (LINE, cell, x0, x1, text)."""
    w = Window.partitionBy("doc", "page", "block", "line").orderBy("x0")
    x = lines.withColumn("_new", F.when(F.col("x0") - F.lag("x1").over(w) > gap, 1).otherwise(0)).withColumn("cell", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return x.groupBy(*LINE, "cell").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "text"))), lambda s: s["text"]), " ").alias("text"))


def table_trust(conserved: Column, agreed: Column, ragged: Column, empty_share: Column) -> Column:
    """L0 (best) to L4: the most severe finding decides."""
    return F.when(~conserved, "L4").when(ragged, "L3").when(empty_share > 0.5, "L2").when(~agreed, "L1").otherwise("L0")
