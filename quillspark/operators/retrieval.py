"""Retrieval: BM25 over weighted fields, vector top-k with caps, rank fusion, snippets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.session import against, checkpointed

K1, B = 1.2, 0.75
TOKEN = r"[\p{L}\p{N}_:<>]+"


def _tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN), F.lit(0))


def _count(tokens: Column, term: str) -> Column:
    return F.size(F.filter(tokens, lambda x: x == F.lit(term)))


def bm25(docs: DataFrame, key: str, fields: dict[str, float], terms: list[str], k: int, phrase: str | None = None) -> DataFrame:
    """(key, score) of the k best documents that have all terms (and the phrase); more negative is better, ties by key.

    Field frequencies are weighted before saturation, as full-text stores do.
    The texts are cut into words once; their sizes and the terms' frequencies,
    a narrow row each, are kept for the statistics and the scores.
    """
    wanted = sorted({t.lower() for t in terms})
    toks = {f: _tokens(F.coalesce(F.col(f), F.lit(""))) for f in fields}
    size = reduce(lambda a, b: a + b, [F.size(t) for t in toks.values()])
    tf = [reduce(lambda a, b: a + b, [_count(toks[f], t) * F.lit(w) for f, w in fields.items()]).alias(f"t{i}") for i, t in enumerate(wanted)]
    rows = docs.select(key, size.alias("size"), *tf, *([F.lower(F.concat_ws(" ", *fields)).contains(phrase.lower()).alias("_p")] if phrase else []))
    rows = checkpointed(rows)
    stats = rows.agg(F.count("*").alias("n"), F.avg("size").alias("avg"), *[F.count_if(F.col(f"t{i}") > 0).alias(f"d{i}") for i in range(len(wanted))])
    hit = reduce(lambda a, b: a & b, [F.col(f"t{i}") > 0 for i in range(len(wanted))])
    if phrase:
        hit = hit & F.col("_p")
    x = rows.where(hit).crossJoin(F.broadcast(stats))  # one row
    norm = K1 * (1 - B + B * F.col("size") / F.col("avg"))
    idf = lambda i: F.greatest(F.log((F.col("n") - F.col(f"d{i}") + 0.5) / (F.col(f"d{i}") + 0.5)), F.lit(1e-6))
    score = reduce(lambda a, b: a + b, [idf(i) * F.col(f"t{i}") * (K1 + 1) / (F.col(f"t{i}") + norm) for i in range(len(wanted))])
    return x.select(key, (-score).alias("score")).orderBy("score", key).limit(k)


def snippet(text: Column, term: str, width: int = 200) -> Column:
    at = F.locate(term.lower(), F.lower(text))
    start = F.greatest(F.lit(1), at - width // 2)
    return F.when(at > 0, F.substring(text, start, F.lit(width))).otherwise(F.substring(text, 1, width))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def cosine(a: Column, b: Column) -> Column:
    n = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(n == 0, 0.0).otherwise(dot(a, b) / n)


def vector_topk(queries: DataFrame, q_key: str, docs: DataFrame, d_key: str, vector: str, k: int, least: float = 0.3, group: str | None = None, per_group: int = 2, adjust: Column | None = None) -> DataFrame:
    """(q_key, d_key, score, place): the k best by adjusted cosine, at least `least` before adjustment, at most `per_group` of a group.

    The queries are a stated set and go against all documents in blocks, whose
    measured size bounds what is broadcast.  Of the pairs at or above `least` each
    partition keeps its best `k` (of a group its best `per_group`) by a window
    that Spark cuts off early, before they are shuffled by query.
    """
    q = queries.select(F.col(q_key).alias("_q"), F.col(vector).alias("_v"))
    pairs = against(docs, q)
    pairs = pairs.withColumn("_raw", cosine(F.col(vector), F.col("_v"))).where(F.col("_raw") >= least)
    score = F.col("_raw") + (adjust if adjust is not None else F.lit(0.0))
    entry = F.struct((-score).alias("s"), F.col(d_key).alias("d"))
    if group:
        best = pairs.select("_q", F.col(group).alias("_g"), entry.alias("e")).withColumn("_k", F.row_number().over(Window.partitionBy("_q", "_g").orderBy("e"))).where(F.col("_k") <= per_group)
    else:
        best = pairs.select("_q", entry.alias("e"))
    best = best.withColumn("place", F.row_number().over(Window.partitionBy("_q").orderBy("e"))).where(F.col("place") <= k)
    return best.select(F.col("_q").alias(q_key), F.col("e.d").alias(d_key), (-F.col("e.s")).alias("score"), "place")


def rank_fusion(lists: DataFrame, query: str, item: str, place: str, c: int = 60) -> DataFrame:
    """(query, item, score): sum of 1 / (c + rank), rank from 0, over all lists of a query."""
    return lists.groupBy(query, item).agg(F.sum(1 / (F.lit(c) + F.col(place) - 1)).alias("score"))
