"""Arrow UDFs over the Python functions, and their registration as SQL functions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.functions import similarity as s
from quillspark.functions.text import stable_uniform
from quillspark.operators import segments
from quillspark.session import ship


MATCH = T.StructType([T.StructField("nid", T.DoubleType()), T.StructField("matched", T.IntegerType()), T.StructField("order", T.DoubleType()), T.StructField("whole_text", T.BooleanType())])


def _pairs(f):
    return lambda a, b: pd.Series([None if x is None or y is None else f(x, y) for x, y in zip(a, b)], dtype=object)


@F.pandas_udf(T.DoubleType())
def difflib_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return _pairs(s.ratio)(a, b)


@F.pandas_udf(T.DoubleType())
def symmetric_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return _pairs(s.symmetric_ratio)(a, b)


@F.pandas_udf(T.IntegerType())
def near_substring(needle: pd.Series, text: pd.Series) -> pd.Series:
    return _pairs(s.near_substring)(needle, text)


@F.pandas_udf(T.DoubleType())
def window_ned(small: pd.Series, large: pd.Series) -> pd.Series:
    return _pairs(s.window_ned)(small, large)


@F.pandas_udf(T.StringType())
def nfkc(a: pd.Series) -> pd.Series:
    return a.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


@F.pandas_udf(MATCH)
def block_match(ref: pd.Series, hyp: pd.Series) -> pd.DataFrame:
    """Block matching of two Markdown texts by paragraphs."""
    got = [s.block_match(segments.paragraphs(a or ""), segments.paragraphs(b or "")) for a, b in zip(ref, hyp)]
    return pd.DataFrame(got, columns=["nid", "matched", "order", "whole_text"])


@F.pandas_udf(T.DoubleType())
def heading_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Similarity of the heading trees of two Markdown texts."""

    def one(x, y):
        p, q = (segments.headings(t or "") for t in (x, y))
        return s.tree_similarity(s.heading_tree(*p), s.heading_tree(*q), lambda u, v: s.ned(u, v))

    return pd.Series([one(x, y) for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def table_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Mean similarity of the k-th table of one text with the k-th of the other; 1 without tables."""

    def one(x, y):
        p, q = segments.pipe_tables(x or ""), segments.pipe_tables(y or "")
        n = max(len(p), len(q))
        pad = lambda t, k: t[k] if k < len(t) else []
        return sum(s.table_similarity(pad(p, k), pad(q, k)) for k in range(n)) / n if n else 1.0

    return pd.Series([one(x, y) for x, y in zip(a, b)], dtype="float64")


SQL_FUNCTIONS = {f.__name__ if hasattr(f, "__name__") else n: f for n, f in (("difflib_ratio", difflib_ratio), ("symmetric_ratio", symmetric_ratio), ("near_substring", near_substring), ("window_ned", window_ned), ("nfkc", nfkc), ("heading_similarity", heading_similarity), ("table_similarity", table_similarity))}


def register(spark: SparkSession) -> list[str]:
    """Make the functions known to SQL under their names; `ned` and `stable_uniform` stay built-in expressions."""
    ship(spark)
    for name, f in SQL_FUNCTIONS.items():
        spark.udf.register(name, f)
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION ned(a STRING, b STRING) RETURNS DOUBLE RETURN CASE WHEN greatest(length(a), length(b)) = 0 THEN 0D ELSE levenshtein(a, b) / greatest(length(a), length(b)) END")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION stable_uniform(a STRING) RETURNS DOUBLE RETURN CAST(CAST(conv(substring(sha2(a, 256), 1, 16), 16, 10) AS DECIMAL(20, 0)) AS DOUBLE) / 18446744073709551616D")
    return [*SQL_FUNCTIONS, "ned", "stable_uniform"]


__all__ = ["SQL_FUNCTIONS", "register", "stable_uniform"]
