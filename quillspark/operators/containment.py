"""Strings that are not contained in another one, without comparing all pairs, and quotes in texts.

A string is contained in another if a part of the other, from some character
to its end, begins with it.  All strings and such parts are sorted together;
then the one that follows a string begins with it if any does, so each string
is compared with its neighbour only.  Nothing is joined but the heads of the
strings (their first N characters), by which parts that begin as no string
does are left out, if the measured size of the heads allows; beyond it all
parts are sorted, n * n / 2 bytes of a string of n characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.session import BROADCAST_BYTES, broadcast_if_small, checkpointed, measured_bytes, ship, spread

N = 8


_WORDS = re.compile(r"[^ \t\n\x0b\f\r]+")
#: Words of a quote by which the lines that may hold it are found.
ANCHOR = 3


def quote_lines(docs: DataFrame, key: str, text: str, quotes: DataFrame, quote_key: str, quote: str, spans: int = 2) -> DataFrame:
    """(quote_key, key, line, lines): the first line of each text that holds a quote, or else the first of `spans` lines that hold it together.

    Quotes and lines are compared in lower case with single blanks.  The quotes
    (a stated set, in blocks of a measured size) are found through words of
    theirs that must stand whole in the line, the second to the fourth; those of
    fewer words are looked for in every line.
    """
    ship(docs.sparkSession)
    kinds = {**dict(docs.dtypes), "_q": dict(quotes.dtypes)[quote_key]}
    squeeze = F.trim(F.regexp_replace(F.lower(F.col(quote)), r"\s+", " "))
    stated = quotes.select(F.col(quote_key).alias("q"), squeeze.alias("s")).where("s <> ''")
    blocks = max(1, -(-measured_bytes(stated) // BROADCAST_BYTES))
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).where("t is not null")
    out = None
    for i in range(blocks):
        found = stated.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == i).collect()
        part = rows.mapInPandas(_quote_finder([(r.q, r.s) for r in found], spans, (quote_key, key)), f"{quote_key} {kinds['_q']}, {key} {kinds[key]}, line int, lines int")
        out = part if out is None else out.unionByName(part)
    return out


def _quote_finder(stated: list[tuple], spans: int, names: tuple[str, str]):
    anchored: dict[tuple, list[tuple]] = {}
    short = []
    for q, s in stated:
        words = s.split(" ")
        if len(words) >= ANCHOR + 2:
            anchored.setdefault(tuple(words[1 : ANCHOR + 1]), []).append((q, s))
        else:
            short.append((q, s))

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = []
            for key, text in zip(b["k"], b["t"]):
                words = [_WORDS.findall(line.lower()) for line in text.split("\n")]
                have: dict = {}
                for n in range(1, spans + 1):
                    for k in range(len(words) - n + 1):
                        run = words[k] if n == 1 else [w for x in words[k : k + n] for w in x]
                        line = ""
                        may = [c for a in zip(run, run[1:], run[2:]) if a in anchored for c in anchored[a]]
                        for q, s in (*may, *short):
                            line = line or " ".join(run)
                            if q not in have and s in line:
                                have[q] = (k + 1, n)
                got += [(q, key, *at) for q, at in have.items()]
            yield pd.DataFrame(got, columns=[*names, "line", "lines"])

    return find


def maximal_strings(df: DataFrame, column: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The distinct strings of `column` that no other one contains, and '' if it is there."""
    s = checkpointed(df.select(F.col(column).alias("s")).where("s is not null").distinct())
    filled = s.where("s <> ''")
    heads, small = broadcast_if_small(filled.select(F.substring("s", 1, N).alias("h")).distinct(), limit)
    at = spread(filled).select("s", F.explode(F.expr("sequence(1, length(s))")).alias("i"))
    if small:  # only parts that begin as a string does; a string shorter than N is its own head
        sizes = sorted(r[0] for r in heads.select(F.length("h")).distinct().collect())
        at = at.select("s", "i", F.explode(F.array(*[F.expr(f"substring(s, i, {k})") for k in sizes])).alias("h")).join(heads, "h", "left_semi")
        parts = at.select("s", F.expr(f"if(length(h) = {N}, substring(s, i), h)").alias("t"))
    else:
        parts = at.select("s", F.expr("substring(s, i)").alias("t"))
    both = filled.select(F.col("s").alias("t"), F.lit(True).alias("own")).unionByName(parts.where("t <> s").select("t", F.lit(False).alias("own")))
    each = both.groupBy("t").agg(F.bool_and("own").alias("own"))
    # what follows a string in the order begins with it if anything does
    o = checkpointed(each.sort("t").withColumn("_part", F.spark_partition_id()).withColumn("_m", F.monotonically_increasing_id()))
    first = o.groupBy("_part").agg(F.min("t").alias("t")).select("_part", F.lead("t").over(Window.orderBy("_part")).alias("_first"))  # a row per partition
    after = o.withColumn("_next", F.lead("t").over(Window.partitionBy("_part").orderBy("_m"))).where("own").join(F.broadcast(first), "_part")
    kept = after.where("not coalesce(startswith(coalesce(_next, _first), t), false)").select(F.col("t").alias("s"))
    return kept.unionByName(s.where("s = ''")).select(F.col("s").alias(column))
