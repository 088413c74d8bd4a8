"""Checks of documents against anchors, structure and one another, as flags and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.operators.measures import word_counts
from quillspark.operators.retrieval import vector_topk
from quillspark.operators.sequence import ordered_places


def anchor_report(df: DataFrame, key: str, text: str, must: list[str], must_not: list[str], ordered: list[str], patterns: dict[str, str]) -> DataFrame:
    """(key, failures): names of what is wrong, in the order of the rules; an empty list is a pass."""
    t = F.col(text)
    rules = [F.when(~t.contains(m), f"missing:{m}") for m in must] + [F.when(t.contains(m), f"forbidden:{m}") for m in must_not]
    rules += [F.when(~ordered_places(t, ordered), "order")] if ordered else []
    rules += [F.when(~t.rlike(p), f"pattern:{k}") for k, p in patterns.items()]
    return df.where(t.isNotNull()).select(key, F.array_compact(F.array(*rules)).alias("failures"))


def fence_parity(text: Column) -> Column:
    """Whether a fence is left open."""
    return (F.size(F.regexp_extract_all(text, F.lit(r"(?dm)^\s*```"), F.lit(0))) % 2) == 1


def structural_gates(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, flags): open_fence, no_heading, front_matter_only, ragged_table, replacement_chars; a line ends with LF or CR LF."""
    t = F.replace(F.col(text), F.lit("\r\n"), F.lit("\n"))
    body = F.regexp_replace(t, r"^---\n(?s:.*?)\n---\n?", "")
    rows = F.regexp_extract_all(t, F.lit(r"(?dm)^\|.*\|[ \t]*$"), F.lit(0))
    widths = F.array_distinct(F.transform(rows, lambda r: F.length(F.regexp_replace(F.replace(r, F.lit("\\|"), F.lit("")), r"[^|]", ""))))
    flags = F.array_compact(F.array(
        F.when(fence_parity(t), "open_fence"), F.when(~t.rlike(r"(?dm)^#{1,6}\s"), "no_heading"), F.when(F.trim(body) == "", "front_matter_only"),
        F.when(F.size(widths) > 1, "ragged_table"), F.when(t.contains("\ufffd"), "replacement_chars"),
    ))
    return df.where(t.isNotNull()).select(key, flags.alias("flags"))


def agreement_at(df: DataFrame, grains: list[str], left: str, right: str) -> DataFrame:
    """(grain values, agreement): common words over the larger multiset, of all rows of each grain value."""
    key = F.to_json(F.struct(*grains))
    x = df.where(F.col(left).isNotNull() & F.col(right).isNotNull()).withColumn("_k", key)
    whole = lambda c: word_counts(x, "_k", c).groupBy("_k", "token").agg(F.sum("n").alias("n"))
    a, b = whole(left), whole(right).withColumnRenamed("n", "m")
    j = a.join(b, ["_k", "token"], "full").fillna(0, ["n", "m"]).groupBy("_k").agg(F.sum(F.least("n", "m")).alias("both"), F.greatest(F.sum("n"), F.sum("m")).alias("all"))
    names = x.select("_k", *grains).distinct()
    return names.join(j, "_k").select(*grains, (F.col("both") / F.col("all")).alias("agreement"))


def ngram_overlap(a: Column, b: Column, n: int = 3) -> Column:
    """Jaccard similarity of the character n-grams; 0 if neither has one."""
    g = lambda c: F.when(F.length(c) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - (n - 1)), lambda i: F.substring(c, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))
    x, y = g(a), g(b)
    return F.when(F.size(F.array_union(x, y)) == 0, 0.0).otherwise(F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))


def nearest_known(vectors: DataFrame, candidates: DataFrame, key: str, vector: str, known: float) -> DataFrame:
    """(key, best, verdict): the best cosine of each candidate with another vector; known if it reaches `known`, else new."""
    top = vector_topk(candidates, key, vectors.withColumnRenamed(key, "_other"), "_other", vector, 2, least=-2.0)  # itself and another one
    best = top.where(F.col(key) != F.col("_other")).groupBy(key).agg(F.max("score").alias("best"))
    return best.select(key, "best", F.when(F.col("best") < known, "new").otherwise("known").alias("verdict"))


def handles_unknown(df: DataFrame, key: str, text: str, roster: DataFrame, name: str) -> DataFrame:
    """(key, handle) of @handles outside code fences that no roster row has."""
    plain = F.regexp_replace(text, r"(?ms)^\s*```.*?^\s*```\s*$", "")
    h = df.where(F.col(text).isNotNull()).select(key, F.explode(F.array_distinct(F.regexp_extract_all(plain, F.lit(r"(?<![\w.])@([A-Za-z]\w+)"), F.lit(1)))).alias("handle"))
    return h.join(roster.select(F.col(name).alias("handle")), "handle", "left_anti").select(key, "handle")
