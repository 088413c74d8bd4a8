"""References to records that are not there.

Referring and existing rows become signed deltas per key: +1 reference, +1 or
-1 existence.  The ledger keeps, per key, both counts and the earliest times;
it is maintained by adding up deltas (`apply_deltas`), so a new batch costs
its own size.  Keys with references and either no existence or one that began
after the first reference are the candidates; only their references are
looked at row by row.  Sums are pre-aggregated before the shuffle, so a key
that holds a third of all rows stays one row per task.

Defined results
  null, blank or placeholder reference    refers to nothing
  null time of the reference              not reported, it belongs to no period
  null time of a target                   the target isn't there at any time
  repeated references                     a row each (their ids differ)
  empty tables                            no rows; with no targets at all every reference is reported
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.operators.hierarchy import label_key
from quillspark.session import checkpointed, lookup_join

KEYS = ["kind", "scope", "key"]


def paper_key(c: Column) -> Column:
    """Without blanks, letter case and file suffix; null for texts that name no paper (no digit in them)."""
    x = F.regexp_replace(F.regexp_replace(F.upper(c), r"[\s ]+", ""), r"\.(PDF|HTML?|MD|TXT|DOCX?)$", "")
    return F.when(x.rlike(r"\d"), x)


def references(df: DataFrame, kind: str, table: str, fields: list[str], row_id: str, time: str, scope: Column, key) -> DataFrame:
    """(kind, scope, key, table, field, row_id, t), a row for each field that refers to something."""
    packed = F.array(*[F.struct(F.lit(f).alias("field"), key(F.col(f"`{f}`")).alias("key")) for f in fields])
    return (
        df.select(F.lit(kind).alias("kind"), scope.alias("scope"), F.lit(table).alias("source_table"), F.col(row_id).alias("row_id"), F.col(time).alias("t"), F.explode(packed).alias("r"))
        .select("kind", "scope", F.col("r.key").alias("key"), "source_table", F.col("r.field").alias("field"), "row_id", "t")
        .where("key is not null and t is not null")
    )


def existence(df: DataFrame, kind: str, time: str, scope: Column, key: Column) -> DataFrame:
    """(kind, scope, key, t) of the rows that are there."""
    return df.select(F.lit(kind).alias("kind"), scope.alias("scope"), key.alias("key"), F.col(time).alias("t")).where("key is not null and t is not null")


def deltas(refs: DataFrame, exist: DataFrame) -> DataFrame:
    """Signed counts per key of one batch of changes."""
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("timestamp")
    r = refs.select(*KEYS, F.lit(1).cast("long").alias("refs"), zero.alias("exists"), F.col("t").cast("timestamp").alias("first_ref"), none.alias("first_exist"))
    e = exist.select(*KEYS, zero.alias("refs"), F.lit(1).cast("long").alias("exists"), none.alias("first_ref"), F.col("t").cast("timestamp").alias("first_exist"))
    return r.unionByName(e)


def apply_deltas(ledger: DataFrame | None, change: DataFrame) -> DataFrame:
    """The ledger after a batch of deltas: (kind, scope, key, refs, exists, first_ref, first_exist)."""
    rows = change if ledger is None else ledger.unionByName(change)
    return rows.groupBy(*KEYS).agg(F.sum("refs").alias("refs"), F.sum("exists").alias("exists"), F.min("first_ref").alias("first_ref"), F.min("first_exist").alias("first_exist"))


def orphan_keys(ledger: DataFrame) -> DataFrame:
    """Keys with positive references that were not there for at least one of them."""
    return ledger.where("refs > 0 and (exists <= 0 or first_exist > first_ref)")


def orphans(refs: DataFrame, exist: DataFrame, removed: DataFrame) -> DataFrame:
    """(source_table, field, row_id, period, state) of the references whose target was not there.

    removed: (kind, scope, key) of records taken out.
    """
    keys = checkpointed(orphan_keys(apply_deltas(None, deltas(refs, exist))).select(*KEYS, "exists", "first_exist"))
    gone = removed.select(*KEYS).where("key is not null").distinct().withColumn("gone", F.lit(True))
    keys = keys.join(gone, KEYS, "left")
    state = F.when(F.col("exists") > 0, "late").when(F.col("gone"), "deleted").otherwise("missing")
    return (
        lookup_join(refs, checkpointed(keys), KEYS, "inner")
        .where("first_exist is null or first_exist > t")
        .select("source_table", "field", F.col("row_id").cast("long").alias("row_id"), F.date_format("t", "yyyy-MM").alias("period"), state.alias("state"))
        .distinct()
    )


def document_orphans(papers: DataFrame, sections: DataFrame, xrefs: DataFrame, removed: DataFrame) -> DataFrame:
    """Orphan references of section_xrefs and papers."""
    none = F.lit("")
    refs = references(xrefs, "section", "section_xrefs", ["from_label", "to_label"], "xref_id", "extracted_at", F.coalesce("draft_tag", none), label_key).unionByName(
        references(papers, "paper", "papers", ["previous_version"], "scrape_id", "scraped_at", none, paper_key)
    )
    exist = existence(sections, "section", "ingested_at", F.coalesce("draft_tag", none), label_key(F.col("stable_label"))).unionByName(
        existence(papers, "paper", "scraped_at", none, paper_key(F.col("paper_id")))
    )
    taken = removed.select(
        F.when(F.col("source_table") == "papers", "paper").otherwise("section").alias("kind"),
        F.when(F.col("source_table") == "papers", none).otherwise(F.coalesce("scope", none)).alias("scope"),
        F.when(F.col("source_table") == "papers", paper_key(F.col("record_key"))).otherwise(label_key(F.col("record_key"))).alias("key"),
    )
    return orphans(refs, exist, taken)
