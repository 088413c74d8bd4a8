"""Tables as grids of cells: kinds, sanity flags, levels of trust, differences of readings, stitching over pages.

A grid is (table, r, c, text) with r and c from 0.

Defined results
  null or '' cell        empty
  table without cells    no row
  repeated cells         cells of their own; of readings, the last text by alphabet is compared
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.session import ship

# Thresholds of the kinds.
EMPTY_SHARE, MONO_SHARE, PROSE_WORDS, KEY_WORDS, BALLOTS, LABELS = 0.5, 0.85, 12, 4, 0.5, 0.6


def table_kinds(cells: DataFrame, table: str, mono: str | None = None) -> DataFrame:
    """(table, kind): false_positive, code_comparison, spec_table, ballot, bibliography, key_value, prose or matrix; the first that fits."""
    t = F.trim(F.coalesce("text", F.lit("")))
    words = F.when(t == "", 0).otherwise(F.size(F.split(t, r"\s+")))
    rows = cells.groupBy(table, "r").agg(F.count("*").alias("_w")).groupBy(table).agg(F.countDistinct("_w").alias("widths"), F.count("*").alias("rows"), F.max("_w").alias("cols"))
    first, filled, code = F.col("c") == 0, t != "", (F.col(mono) if mono else F.lit(False))
    head = lambda c: F.max(F.when((F.col("r") == 0) & (F.col("c") == c), F.lower(t)))
    share = lambda pattern: F.count_if(first & filled & t.rlike(pattern)) / F.greatest(F.count_if(first & filled), F.lit(1))
    x = cells.groupBy(table).agg(
        (F.count_if(~filled) / F.count("*")).alias("empty"), (F.count_if(filled & code) / F.greatest(F.count_if(filled), F.lit(1))).alias("mono"), F.max(words).alias("most"),
        F.max(F.when(first, words)).alias("key_words"), share(r"^\[[A-Z]{2}(-\d{1,3})?\]$").alias("ballots"), share(r"^\[[^\[\]]+\]$").alias("labels"), head(0).alias("h0"), head(1).alias("h1"),
    )
    spec = (F.col("cols") == 3) & F.col("h0").rlike("expression|operation") & F.col("h1").rlike("return|type")
    kind = (
        F.when((F.col("empty") > EMPTY_SHARE) | (F.col("widths") > 2), "false_positive").when((F.col("mono") >= MONO_SHARE) & (F.col("cols") <= 3) & (F.col("rows") >= 4), "code_comparison")
        .when(spec, "spec_table").when((F.col("ballots") >= BALLOTS) & (F.col("rows") >= 3), "ballot").when((F.col("labels") >= LABELS) & (F.col("rows") >= 2), "bibliography")
        .when((F.col("cols") == 2) & (F.col("key_words") <= KEY_WORDS) & (F.col("most") > PROSE_WORDS), "key_value").when(F.col("most") > PROSE_WORDS, "prose").otherwise("matrix")
    )
    return x.join(rows, table).select(table, kind.alias("kind"))


def reading_differences(grids: DataFrame, table: str, reading: str) -> DataFrame:
    """(table, r, c): cells in which a reading of the same shape differs from the first one (reading 0) in more than blanks."""
    shape = grids.groupBy(table, reading).agg(F.sort_array(F.collect_set(F.struct("r", "c"))).alias("shape"))
    first = shape.where(F.col(reading) == 0).select(table, F.col("shape").alias("shape0"))
    same = shape.where(F.col(reading) > 0).join(first, table).where("shape = shape0").select(table, reading)
    t = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " "))
    cell = [table, reading, "r", "c"]
    last = grids.withColumn("_t", t).groupBy(*cell).agg(F.max("_t").alias("_t"))
    a = last.where(F.col(reading) == 0).select(table, "r", "c", F.col("_t").alias("a"))
    b = last.join(same, [table, reading]).select(table, "r", "c", F.col("_t").alias("b"))
    return b.join(a, [table, "r", "c"]).where("a <> b").select(table, "r", "c").distinct()


def trust_level(agreed: Column, worst: Column, doubtful: Column, fits: Column) -> Column:
    """L0 sources agree, L4 something is lost or doubled, L3 the layout is in doubt, L1 words fit the drawn cells, else L2; agreement comes first, then the most severe."""
    return F.when(agreed, "L0").when(worst, "L4").when(doubtful, "L3").when(fits, "L1").otherwise("L2")


def stitched(pieces: DataFrame, doc: str, page: str, place: str, cols: str, header: str, gap: str) -> DataFrame:
    """The pieces of tables with the number of the table they belong to in their document.

    A piece continues the one before if it starts the next page, has as many
    columns, brings no header of its own and no text stands between (`gap` is
    false); then a repeated header is `repeats`.
    """
    w = Window.partitionBy(doc).orderBy(page, place)
    before = lambda c: F.lag(c).over(w)
    same_header = F.coalesce(F.col(header) == before(header), F.lit(False))
    follows = (F.col(page) == before(page) + 1) & (F.col(cols) == before(cols)) & ~F.col(gap) & (F.col(header).isNull() | same_header)
    follows = F.coalesce(follows, F.lit(False))
    x = pieces.withColumn("_new", F.when(follows, 0).otherwise(1)).withColumn("repeats", follows & same_header)
    return x.withColumn("table", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


_PAGE = re.compile(r"\d{1,4}")
_SECTION = re.compile(r"\d+(?:\.\d+)+\.?")
_LABEL = re.compile(r"\[[^\[\]]{1,24}\]\s*$")
_BULLETS = "•●◦▪‣-*"


def sanity_flags(rows: list[list[str]]) -> list[str]:
    """What speaks against a grid being a table: empty, sparse columns or cells, ragged rows, and look-alikes of tables."""
    if not rows:
        return ["empty"]
    n = max(len(r) for r in rows)
    full = [[*r, *[""] * (n - len(r))] for r in rows]
    body = full[1:] if len(full) > 2 else full
    dense = [j for j in range(n) if sum(bool(r[j]) for r in body) >= len(body) / 2]
    flags = ["sparse-columns"] if n >= 3 and len(dense) < n / 2 else []
    filled = [sum(bool(r[j]) for j in dense) for r in body]
    usual = Counter(filled).most_common(1)[0][0]
    keyed = sum(bool(r[0]) for r in body) >= len(body) / 2
    ragged = [f > usual or (keyed and not r[0]) or (n >= 3 and sum(map(bool, r)) == 1) for r, f in zip(body, filled)]
    cells = [c for r in full for c in r]
    first, last = [r[0] for r in full if r[0]], [r[-1] for r in full if r[-1]]
    pages = [int(c) for c in last if _PAGE.fullmatch(c)]
    tests = {
        "ragged-columns": sum(ragged) > 0.2 * len(body),
        "sparse-two-rows": len(full) == 2 and not all(cells),
        "empty-cells": cells.count("") > 0.4 * len(cells),
        "constant-first-column": len(full) >= 4 and bool(first) and Counter(first).most_common(1)[0][1] >= 0.7 * len(full),
        "single-cell-rows": n >= 2 and len(full) > 2 and all(f == 1 for f in filled),
        "toc-like": n >= 2 and len(full) >= 2 and len(pages) >= (1 if n == 2 else 0.8) * len(full) and pages == sorted(pages),
        "bullet-list": bool(first) and all(c[0] in _BULLETS for c in first),
        "numbered-list": bool(first) and (n == 2 and len(first) == len(full) and all(_SECTION.fullmatch(c) for c in first) or bool(_SECTION.fullmatch(full[0][0]))),
        "ascii-art": sum(bool(re.search(r"\+-{2,}\+|[│┌┐└┘├┤]", c)) for c in cells) >= 2,
        "code-comment-column": len(last) >= 2 and all(c.startswith("//") for c in last),
        "reference-list": bool(first) and len(first) >= 0.5 * len(full) and all(_LABEL.search(c) for c in first),
    }
    return flags + [f for f, hit in tests.items() if hit]


def flagged_tables(cells: DataFrame, table: str) -> DataFrame:
    """(table, flag) of every grid; a grid's cells are one row before they are looked at, as wide as the table itself."""
    ship(cells.sparkSession)
    t = F.trim(F.coalesce("text", F.lit("")))
    rows = cells.groupBy(table).agg(F.sort_array(F.collect_list(F.struct("r", "c", t.alias("t")))).alias("cells"))

    def flags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = []
            for key, grid in zip(b["k"], b["cells"]):
                lines: dict[int, dict[int, str]] = {}
                for x in grid:
                    lines.setdefault(x["r"], {})[x["c"]] = x["t"]
                full = [[line.get(c, "") for c in range(max(line) + 1)] for _, line in sorted(lines.items())]
                got += [(key, f) for f in sanity_flags(full)]
            yield pd.DataFrame(got, columns=[table, "flag"])

    return rows.select(F.col(table).alias("k"), "cells").mapInPandas(flags, f"{table} {dict(cells.dtypes)[table]}, flag string")
