"""Worklists over a store of staged records: what is pending, what failed, what has to be cleared, swapped or read again.

Defined results
  null status            not pending, not failed; its stage is null
  null or '' artifact    not there
  empty tables           empty results
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pending(df: DataFrame, status: str, through: int) -> DataFrame:
    """Rows that have not failed and have not come through stage `through`."""
    return df.where((F.col(status) >= 0) & (F.col(status) < through))


def placed(df: DataFrame, group: list[str], *order: Column) -> DataFrame:
    """Rows with their place (from 1) in the order of work within their group."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


def failed_status(stage: Column) -> Column:
    """The status of a record that failed in a stage."""
    return -(stage + 1)


def failed_stage(status: Column) -> Column:
    """The stage in which a record failed; null if it didn't."""
    return F.when(status < 0, F.abs(status) - 1)


def reached_stage(artifacts: list[str]) -> Column:
    """The number of stages whose artifacts are there without a gap, from the first on."""
    there = [F.coalesce(F.col(a), F.lit("")) != "" for a in artifacts]
    out = F.lit(0)
    for k in range(1, len(artifacts) + 1):
        out = F.when(reduce(lambda a, b: a & b, there[:k]), k).otherwise(out)
    return out


def cleared(df: DataFrame, stage: Column, artifacts: list[str]) -> DataFrame:
    """Artifacts of the stages after `stage` emptied, with the names of those that changed."""
    gone = {a: (stage <= k) & (F.coalesce(F.col(a), F.lit("")) != "") for k, a in enumerate(artifacts)}
    changed = F.array_compact(F.array(*[F.when(c, a) for a, c in gone.items()]))
    return df.withColumn("changed", changed).withColumns({a: F.when(c, "").otherwise(F.col(a)) for a, c in gone.items()})


def swapped(store: DataFrame, staged: DataFrame, partition: str) -> DataFrame:
    """The store with every partition that is staged replaced as a whole by its staged rows."""
    return store.join(staged.select(partition).distinct(), partition, "left_anti").unionByName(staged.select(*store.columns))


def changed_sources(sources: DataFrame, seen: DataFrame, key: str, digest: str) -> DataFrame:
    """Sources that are new or whose digest is not the one seen last."""
    return sources.join(seen.select(key, digest).distinct(), [key, digest], "left_anti")


def target_kind(c: Column) -> Column:
    """What a typed target names: all, a year, a month, a record, or error."""
    x = F.lower(F.trim(c))
    return F.when(x == "all", "all").when(x.rlike(r"^\d{4}$"), "year").when(x.rlike(r"^\d{4}-\d{2}$"), "month").when(x.rlike(r"^[a-z]+\d+(r\d+)?$"), "paper").otherwise("error")


def outside_vocabulary(df: DataFrame, column: str, words: list[str]) -> DataFrame:
    """(column, n): values beyond a closed vocabulary, and how often they stand."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*words)).groupBy(column).agg(F.count("*").alias("n"))


def widened(df: DataFrame, column: str, backfill: Column) -> DataFrame:
    """A number column as text, null ones filled by a rule."""
    return df.withColumn(column, F.coalesce(F.col(column).cast("string"), backfill.cast("string")))
