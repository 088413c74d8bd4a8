"""Store-like operators on immutable tables: lookups, merges, snapshots, version picks.

Everything is a plain DataFrame plan: merges are full outer joins or unions with
a partially aggregated pick, never row-by-row updates.  Missing text is '' in
these stores, and '' is not null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def blank(c: Column) -> Column:
    """True for null and ''."""
    return c.isNull() | (c == "")


def normal_key(c: Column) -> Column:
    return F.upper(F.trim(c))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """The same rows; an empty set is an error, as for a year that isn't there."""
    if df.isEmpty():
        raise LookupError(f"no rows for {what}")
    return df


def point_lookup(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.where(normal_key(F.col(key)) == value.strip().upper())


def exists(df: DataFrame, condition: Column) -> bool:
    return not df.where(condition).isEmpty()


def since(df: DataFrame, text_date: str, cutoff: str) -> DataFrame:
    """Lexical cut on a text date; '' and null fall out."""
    return df.where((F.col(text_date) != "") & (F.col(text_date) >= cutoff))


def optional_filters(df: DataFrame, **wanted) -> DataFrame:
    """Equality on each column whose wanted value is not None."""
    for name, value in wanted.items():
        if value is not None:
            df = df.where(F.col(name) == value)
    return df


def like_contains(df: DataFrame, column: str, needle: str) -> DataFrame:
    """Case-insensitive containment; % and _ of the needle stay wildcards."""
    return df.where(F.col(column).ilike(f"%{needle}%"))


def in_list_ordered(df: DataFrame, key: str, wanted: list, order: str) -> DataFrame:
    """Rows of the wanted keys with their place in the list; of repeated keys the last row by `order`; absent keys are dropped."""
    latest = df.where(F.col(key).isin(wanted)).groupBy(key).agg(F.max_by(F.struct(*df.columns), F.col(order)).alias("r")).select("r.*")
    place = F.array_position(F.array(*[F.lit(w) for w in wanted]), F.col(key)) - 1
    return latest.withColumn("place", place.cast("int"))


def last_occurrence(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key; a partial aggregate, so a hot key costs no sort."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*keys, "r.*")


def first_occurrence(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*keys, "r.*")


# ---------------------------------------------------------------- merges


def upsert(store: DataFrame, feed: DataFrame, key: str, overwrite: list[str], keep_if_set: list[str] = ()) -> DataFrame:
    """Insert new keys; on a conflict overwrite some columns, fill others only where they are blank, leave the rest."""
    s, f = store.alias("s"), feed.alias("f")
    hit = F.col(f"f.{key}").isNotNull()
    cols = []
    for c in store.columns:
        old = F.col(f"s.{c}")
        new = F.col(f"f.{c}") if c in feed.columns else F.lit(None)
        if c == key:
            cols.append(F.coalesce(old, new).alias(c))
        elif c in overwrite:
            cols.append(F.when(hit, new).otherwise(old).alias(c))
        elif c in keep_if_set:
            cols.append(F.when(hit & blank(old), new).otherwise(old).alias(c))
        else:
            cols.append(old.alias(c))
    return s.join(f, F.col(f"s.{key}") == F.col(f"f.{key}"), "full").select(*cols)


def insert_or_ignore(store: DataFrame, feed: DataFrame, key: str) -> DataFrame:
    return store.unionByName(feed.join(store.select(key), key, "left_anti").select(*store.columns))


def insert_or_replace(store: DataFrame, feed: DataFrame, key: str) -> DataFrame:
    return store.join(feed.select(key), key, "left_anti").select(*store.columns).unionByName(feed.select(*store.columns))


def replace_partition(store: DataFrame, feed: DataFrame, partition: str) -> DataFrame:
    """Delete every partition that the feed has, insert the feed."""
    return store.join(feed.select(partition).distinct(), partition, "left_anti").select(*store.columns).unionByName(feed.select(*store.columns))


def compare_and_set(store: DataFrame, wanted: DataFrame, key: str, column: str) -> DataFrame:
    """wanted: (key, old, new).  The store with a `won` flag on the rows that were asked for (null on the others)."""
    j = store.join(wanted, key, "left")
    won = F.col(column) == F.col("old")
    return j.withColumn("won", F.when(F.col("old").isNotNull(), won)).withColumn(column, F.when(won, F.col("new")).otherwise(F.col(column))).drop("old", "new")


def add_columns(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Additive migration: columns that are missing get their default."""
    return df.withColumns({c: d for c, d in defaults.items() if c not in df.columns})


def verified_digests(df: DataFrame, content: str, recorded: DataFrame, key: str) -> DataFrame:
    """(key, sha256, ok): content against recorded digests; ok is null where none is recorded."""
    have = df.select(key, F.sha2(F.col(content), 256).alias("sha256"))
    return have.join(recorded.select(key, F.col("sha256").alias("want")), key, "left").select(key, "sha256", (F.col("sha256") == F.col("want")).alias("ok"))


# ---------------------------------------------------------------- comparison of snapshots


def snapshot_diff(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """(key, status, before, after) with status missing, new, changed or same (nulls are equal)."""
    b, a = before.select(F.col(key), F.col(value).alias("before"), F.lit(1).alias("_b")), after.select(F.col(key), F.col(value).alias("after"), F.lit(1).alias("_a"))
    status = F.when(F.col("_a").isNull(), "missing").when(F.col("_b").isNull(), "new").when(F.col("before").eqNullSafe(F.col("after")), "same").otherwise("changed")
    return b.join(a, key, "full").select(key, status.alias("status"), "before", "after")


def order_matched(left: DataFrame, right: DataFrame, group: str, left_order: list, right_order: list, left_value: str, right_value: str) -> DataFrame:
    """The k-th of the left with the k-th of the right in each group, padded with null."""
    l = left.select(group, F.row_number().over(Window.partitionBy(group).orderBy(*left_order)).alias("k"), F.col(left_value).alias("left_value"))  # noqa: E741
    r = right.select(group, F.row_number().over(Window.partitionBy(group).orderBy(*right_order)).alias("k"), F.col(right_value).alias("right_value"))
    return l.join(r, [group, "k"], "full")


# ---------------------------------------------------------------- versions


def base_and_revision(c: Column) -> tuple[Column, Column]:
    """P1234R5 -> (P1234, 5); without a revision 0."""
    x = normal_key(c)
    return F.regexp_replace(x, r"R\d+$", ""), F.when(x.rlike(r"R\d+$"), F.regexp_extract(x, r"R(\d+)$", 1).cast("int")).otherwise(0)


def latest_revision(df: DataFrame, column: str) -> DataFrame:
    """(base, latest, revisions): the highest revision by number (R10 after R9)."""
    base, rev = base_and_revision(F.col(column))
    rows = df.where(~blank(F.col(column))).select(base.alias("base"), rev.alias("rev"), normal_key(F.col(column)).alias("id"))
    return rows.groupBy("base").agg(F.max_by("id", "rev").alias("latest"), F.countDistinct("rev").alias("revisions"))


def resolve_references(refs: DataFrame, ref: str, store: DataFrame, key: str) -> DataFrame:
    """(ref, resolved, how): exact, the latest revision of a bare number, or the bare number of a revision."""
    base, _ = base_and_revision(F.col(ref))
    r = refs.select(F.col(ref).alias("ref"), normal_key(F.col(ref)).alias("id"), base.alias("base")).where(~blank(F.col("ref"))).distinct()
    ids = store.where(~blank(F.col(key))).select(normal_key(F.col(key)).alias("id")).distinct()
    last = latest_revision(store, key).select("base", "latest")
    j = r.join(ids.withColumn("exact", F.lit(True)), "id", "left").join(last, "base", "left").join(ids.select(F.col("id").alias("base"), F.lit(True).alias("bare")), "base", "left")
    how = F.when(F.col("exact"), "exact").when((F.col("id") == F.col("base")) & F.col("latest").isNotNull(), "latest").when((F.col("id") != F.col("base")) & F.col("bare"), "base").otherwise("none")
    return j.select("ref", how.alias("how"), F.when(how == "exact", F.col("id")).when(how == "latest", F.col("latest")).when(how == "base", F.col("base")).alias("resolved"))


def range_join(points: DataFrame, ranges: DataFrame, group: str, at: str, first: str, last: str, width: int) -> DataFrame:
    """Points within ranges of the same group, by buckets of `width`, so that a group is never a cross product."""
    p = points.withColumn("_bucket", F.floor(F.col(at) / width))
    r = ranges.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(first) / width), F.floor(F.col(last) / width))))
    return p.join(r, [group, "_bucket"]).where(F.col(at).between(F.col(first), F.col(last))).drop("_bucket")
