"""Connected components: forests of each partition, merged by least-neighbour hooks and pointer jumps.

Every partition first reduces its links to a disjoint-set forest, one link for
each node it saw.  Then every round is a partial-aggregated minimum over the
links that are left and lookups in maps of distinct nodes; links whose ends
have met are dropped, so later rounds shrink.  No component is ever gathered in
one task, and a node that a third of all links meet makes no hot task
(`lookup_join`).

Defined results
  self links, repeated links, both directions    count once
  null ends                                      ignored
  nodes without links                            not in the result
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.session import checkpointed, lookup_join, ship


def least_members(links: Iterator[tuple], up: dict | None = None) -> dict:
    """node -> the least node of its set, for the nodes of `links`."""
    up = {} if up is None else up

    def find(x):
        top = x
        while up.setdefault(top, top) != top:
            top = up[top]
        while up[x] != top:
            up[x], x = top, up[x]
        return top

    for a, b in links:
        x, y = find(a), find(b)
        if x != y:
            up[max(x, y)] = min(x, y)
    for x in list(up):
        find(x)
    return up


def _renamed(df: DataFrame, column: str, names: DataFrame) -> DataFrame:
    """`column` looked up in names (from, to); what isn't there stays."""
    j = lookup_join(df, names.withColumnRenamed("from", column), [column])
    return j.withColumn(column, F.coalesce("to", column)).drop("to")


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) with component the least node of each component."""
    ship(edges.sparkSession)
    kind = dict(edges.dtypes)[src]
    pairs = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null and a <> b")

    def forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        up: dict = {}
        for b in batches:
            least_members(zip(b["a"], b["b"]), up)
        yield pd.DataFrame(list(up.items()), columns=["a", "b"])

    work = checkpointed(pairs.mapInPandas(forest, f"a {kind}, b {kind}").distinct())
    label = work.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    work = work.where("a <> b")
    while True:
        both = work.unionByName(work.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = checkpointed(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("from"), F.least("a", "m").alias("to")).where("`from` <> `to`"))
        if hook.isEmpty():
            return label.select("node", "component")
        while True:  # follow the pointers to their ends
            far = hook.select("to").distinct().join(hook.select(F.col("from").alias("to"), F.col("to").alias("top")), "to").select(F.col("to").alias("from"), F.col("top").alias("to"))
            far = checkpointed(far)
            if far.isEmpty():
                break
            hook = checkpointed(_renamed(hook.withColumnRenamed("to", "top"), "top", far).withColumnRenamed("top", "to"))
        label = checkpointed(_renamed(label, "component", hook))
        left = _renamed(_renamed(work, "a", hook), "b", hook)
        work = checkpointed(left.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
