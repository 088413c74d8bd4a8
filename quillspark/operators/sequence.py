"""Ordered-sequence operators: fills, islands, neighbours, quotas, packing, numbering.

Windows are always partitioned by a document-like key.  What depends on a running
state that no window expresses (stacks, stop rules, packing) runs over one
group's rows in order, as an aggregate over a sorted array or in applyInPandas.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _before(group: list[str], order: list) -> Window:
    return Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def carry_forward(df: DataFrame, group: list[str], order: list, value: str, out: str, default) -> DataFrame:
    """The last value that isn't null so far, `default` before the first."""
    return df.withColumn(out, F.coalesce(F.last(value, ignorenulls=True).over(_before(group, order)), F.lit(default)))


def open_blocks(df: DataFrame, group: list[str], order: list, opens: Column, closes: Column, out: str) -> DataFrame:
    """True from an opening row to the row before the next closing one; other rows continue."""
    mark = F.when(opens, True).when(closes, False)
    return df.withColumn(out, F.coalesce(F.last(mark, ignorenulls=True).over(_before(group, order)), F.lit(False)))


def neighbours_cofire(df: DataFrame, group: list[str], order: list, section: str, a: str, b: str, out: str) -> DataFrame:
    """Rows where a and b meet: in the row itself, or one here and the other in an adjacent row of the same section."""
    w = Window.partitionBy(*group).orderBy(*order)
    hit = F.col(a) & F.col(b)
    for shift in (F.lag, F.lead):
        same = shift(section).over(w).eqNullSafe(F.col(section))
        hit = hit | (same & F.coalesce((F.col(a) & shift(b).over(w)) | (F.col(b) & shift(a).over(w)), F.lit(False)))
    return df.withColumn(out, F.coalesce(hit, F.lit(False)))


def level_jumps(df: DataFrame, group: list[str], order: list, level: str) -> DataFrame:
    """Rows whose level is more than one deeper than the row before."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("previous", F.lag(level).over(w)).where(F.col(level) > F.col("previous") + 1)


def prefix_sample(df: DataFrame, group: list[str], order: list, quota: Column | int) -> DataFrame:
    """The first rows of each group up to a quota."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("_k") <= quota).drop("_k")


def largest_remainder(df: DataFrame, group: list[str], part: str, size: str, total: int) -> DataFrame:
    """Hamilton apportionment of `total` seats (no more than there are) over the parts of a group; ties by part name."""
    g = Window.partitionBy(*group)
    all_ = F.sum(size).over(g)
    seats = F.least(F.lit(total), all_)
    x = df.withColumn("_all", all_).withColumn("_seats", seats).withColumn("_floor", F.floor(F.col("_seats") * F.col(size) / F.col("_all")))
    x = x.withColumn("_rem", (F.col("_seats") * F.col(size)) % F.col("_all")).withColumn("_left", F.col("_seats") - F.sum("_floor").over(g))
    x = x.withColumn("_k", F.row_number().over(g.orderBy(F.desc("_rem"), part)))
    quota = F.least(F.col(size), F.col("_floor") + F.when(F.col("_k") <= F.col("_left"), 1).otherwise(0)).cast("long")
    return x.withColumn("quota", quota).select(*df.columns, "quota")


def merge_intervals(df: DataFrame, group: list[str], start: str, end: str, gap: int = 0) -> DataFrame:
    """(group, start, end, n): overlapping or touching intervals joined (at most `gap` apart)."""
    w = Window.partitionBy(*group).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    x = df.withColumn("_new", F.when(reach.isNull() | (F.col(start) > reach + gap), 1).otherwise(0))
    x = x.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return x.groupBy(*group, "_island").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n")).drop("_island")


def collapse_repeats(df: DataFrame, group: list[str], order: list, text: str, long_from: int = 40, most: int = 10) -> DataFrame:
    """Consecutive equal rows once, and of equal long rows the first `most`."""
    w = Window.partitionBy(*group).orderBy(*order)
    kept = df.withColumn("_prev", F.lag(text).over(w)).where(~F.col("_prev").eqNullSafe(F.col(text))).drop("_prev")
    kept = kept.withColumn("_k", F.row_number().over(Window.partitionBy(*group, text).orderBy(*order)))
    return kept.where((F.length(text) < long_from) | F.col(text).isNull() | (F.col("_k") <= most)).drop("_k")


def runs(df: DataFrame, group: list[str], order: list, flag: str, least: int, bridge: int = 0) -> DataFrame:
    """(group, first, last, n) of runs of flagged positions; gaps of up to `bridge` rows are bridged, shorter runs dropped."""
    w = Window.partitionBy(*group).orderBy(*order)
    x = df.withColumn("_p", F.row_number().over(w)).where(F.col(flag))
    v = Window.partitionBy(*group).orderBy("_p")
    x = x.withColumn("_new", F.when(F.col("_p") - F.lag("_p").over(v) <= bridge + 1, 0).otherwise(1)).withColumn("_r", F.sum("_new").over(v.rowsBetween(Window.unboundedPreceding, 0)))
    out = x.groupBy(*group, "_r").agg(F.min("_p").alias("first"), F.max("_p").alias("last"), F.count("*").alias("n"))
    return out.where(F.col("n") >= least).drop("_r")


def periodic(df: DataFrame, group: list[str], order: list, kind: str, periods: range = range(2, 9), records: int = 3) -> DataFrame:
    """(group, period, matches): how many rows equal the row one period before, where that is at least `records` - 1 periods long."""
    w = Window.partitionBy(*group).orderBy(*order)
    out = None
    flagged = df.select(*group, *[F.when(F.col(kind).eqNullSafe(F.lag(kind, k).over(w)) & F.lag(kind, k).over(w).isNotNull(), 1).otherwise(0).alias(f"_{k}") for k in periods])
    sums = flagged.groupBy(*group).agg(*[F.sum(f"_{k}").alias(f"_{k}") for k in periods])
    packed = F.array(*[F.struct(F.lit(k).alias("period"), F.col(f"_{k}").alias("matches")) for k in periods])
    out = sums.select(*group, F.explode(packed).alias("m")).select(*group, "m.period", "m.matches")
    return out.where(F.col("matches") >= F.col("period") * (records - 1))


def periodic_runs(df: DataFrame, group: list[str], pos: str, kind: str, periods: range = range(2, 9), records: int = 3) -> DataFrame:
    """(group, period, start, stop): stretches in which every row equals the one a period before, of at least `records` records; pos counts the group's rows without gaps."""
    w = Window.partitionBy(*group).orderBy(pos)
    hits = F.array_compact(F.array(*[F.when(F.col(kind) == F.lag(kind, k).over(w), F.lit(k)) for k in periods]))
    x = df.withColumn("_p", hits).select(*group, pos, F.explode("_p").alias("period"))
    x = x.withColumn("_i", F.col(pos) - F.row_number().over(Window.partitionBy(*group, "period").orderBy(pos)))
    runs = x.groupBy(*group, "period", "_i").agg((F.min(pos) - F.col("period")).alias("start"), F.max(pos).alias("stop"), F.count("*").alias("_n"))
    return runs.where(F.col("_n") >= F.col("period") * (records - 1)).drop("_i", "_n")


def greedy_pack(df: DataFrame, group: list[str], order: list[str], size: str, budget: int) -> DataFrame:
    """Adjacent rows put together while their sizes stay within the budget: a pack number per row, from 0.

    A fold over each group's sorted sizes; an item beyond the budget gets a pack of its own.
    """
    rows = df.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct(*order, F.col(size).cast("long").alias("_s")))).alias("r"))
    zero = F.struct(F.array().cast("array<int>").alias("packs"), F.lit(-1).alias("p"), F.lit(0).cast("long").alias("used"))

    def step(acc: Column, r: Column) -> Column:
        fits = (acc["p"] >= 0) & (acc["used"] + r["_s"] <= budget)
        p = F.when(fits, acc["p"]).otherwise(acc["p"] + 1)
        return F.struct(F.concat(acc["packs"], F.array(p)).alias("packs"), p.alias("p"), F.when(fits, acc["used"] + r["_s"]).otherwise(r["_s"]).alias("used"))

    packed = rows.select(*group, F.arrays_zip("r", F.aggregate("r", zero, step, lambda a: a["packs"]).alias("p")).alias("z"))
    return packed.select(*group, F.explode("z").alias("z")).select(*group, *[F.col(f"z.r.{c}").alias(c) for c in order], F.col("z.r._s").alias(size), F.col("z.p").alias("pack"))


def budget_prefix(df: DataFrame, group: list[str], order: list, size: str, budget: int) -> DataFrame:
    """Rows up to, not including, the first that overflows the budget."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("used", F.sum(size).over(w)).where(F.col("used") <= budget)


def number_outline(df: DataFrame, group: str, order: str, depth: str, key: str) -> DataFrame:
    """(group, order, number, parent): numbers like 6.7.7 and the nearest shallower row before, by a stack of depths."""

    def outline(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        stack: list[tuple[int, str]] = []
        count: dict[int, int] = {}
        numbers, parents = [], []
        for d, k in zip(pdf[depth], pdf[key]):
            d = 0 if pd.isna(d) else int(d)
            count[d] = count.get(d, 0) + 1
            for deeper in [x for x in count if x > d]:
                del count[deeper]
            while stack and stack[-1][0] >= d:
                stack.pop()
            parents.append(stack[-1][1] if stack else None)
            stack.append((d, k))
            numbers.append(".".join(str(count[x]) for x in sorted(count)))
        return pd.DataFrame({group: pdf[group], order: pdf[order], "number": numbers, "parent": parents})

    kinds = dict(df.dtypes)
    return df.select(group, order, depth, key).groupBy(group).applyInPandas(outline, f"{group} {kinds[group]}, {order} {kinds[order]}, number string, parent string")


def ordered_places(text: Column, needles: list[str]) -> Column:
    """Whether the needles' first places rise strictly; one that is missing is passed over."""
    places = F.filter(F.array(*[F.locate(n, text) for n in needles]), lambda p: p > 0)
    return F.aggregate(places, F.struct(F.lit(True).alias("ok"), F.lit(0).alias("at")), lambda a, p: F.struct((a["ok"] & (p > a["at"])).alias("ok"), p.alias("at")), lambda a: a["ok"])


def shingles(tokens: Column, n: int) -> Column:
    """All runs of n tokens as texts; none if there are fewer."""
    return F.when(F.size(tokens) >= n, F.transform(F.sequence(F.lit(1), F.size(tokens) - (n - 1)), lambda i: F.array_join(F.slice(tokens, i, n), " "))).otherwise(F.array().cast("array<string>"))


def running_totals(df: DataFrame, order: list, sums: dict[str, str]) -> DataFrame:
    """Sums of all rows before each row in a global order, by name {out: column}.

    Totals run within the range partitions of a sort and are shifted by the
    sums of the partitions before, so no task sees all rows.
    """
    from quillspark.session import checkpointed

    s = checkpointed(df.sort(*order).withColumn("_part", F.spark_partition_id()).withColumn("_m", F.monotonically_increasing_id()))
    whole = s.groupBy("_part").agg(*[F.sum(c).alias(f"_s_{o}") for o, c in sums.items()])
    first = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    shift = whole.select("_part", *[F.coalesce(F.sum(f"_s_{o}").over(first), F.lit(0)).alias(f"_b_{o}") for o in sums])
    inner = Window.partitionBy("_part").orderBy("_m").rowsBetween(Window.unboundedPreceding, -1)
    x = s.join(F.broadcast(shift), "_part")
    return x.select(*df.columns, *[(F.coalesce(F.sum(c).over(inner), F.lit(0)) + F.col(f"_b_{o}")).alias(o) for o, c in sums.items()])


def global_ids(df: DataFrame, order: list, out: str = "gid", prefix: str = "") -> DataFrame:
    """Consecutive ids from 1 over all rows in order.

    Ranks are taken within the range partitions of a sort and shifted by the
    sizes of the partitions before, so no task sees all rows.
    """
    s = df.sort(*order).withColumn("_part", F.spark_partition_id()).withColumn("_m", F.monotonically_increasing_id())
    from quillspark.session import checkpointed

    s = checkpointed(s)
    sizes = s.groupBy("_part").agg(F.count("*").alias("_n"))
    shift = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # a row per partition
    ranked = s.withColumn("_k", F.row_number().over(Window.partitionBy("_part").orderBy("_m")))
    n = (F.col("_k") + F.col("_before")).cast("long")
    return ranked.join(F.broadcast(shift.select("_part", "_before")), "_part").withColumn(out, F.concat(F.lit(prefix), n.cast("string")) if prefix else n).drop("_part", "_m", "_k", "_before")
