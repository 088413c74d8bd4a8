"""Structured Streaming counterparts: incremental mentions, windowed counts, a state machine per key."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quillspark.functions.text import paper_ids


def stream_table(spark: SparkSession, folder: str, schema, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def new_mentions(docs: DataFrame, time: str = "fetched_at", late: str = "1 hour") -> DataFrame:
    """(doc_id, ref) as texts arrive, each pair once within the watermark."""
    d = docs.withWatermark(time, late).where("text is not null")
    return d.select("doc_id", time, F.explode(paper_ids(F.col("text"))).alias("ref")).dropDuplicatesWithinWatermark(["doc_id", "ref"])


def windowed_counts(events: DataFrame, time: str, group: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    w = events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), group).agg(F.count("*").alias("n"))
    return w.select(F.col("w.start").alias("start"), group, "n")


def session_counts(events: DataFrame, time: str, group: str, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    w = events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), group).agg(F.count("*").alias("n"))
    return w.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), group, "n")


def state_machine(changes: DataFrame, key: str = "id") -> DataFrame:
    """changes: (key, seq long, old int, new int).  (key, seq, won, status): compare-and-set in order of seq within a batch; a key starts at 0."""

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (now,) = state.get if state.exists else (0,)
        rows = pd.concat(list(batches)).sort_values("seq")
        out = []
        for seq, old, new in rows[["seq", "old", "new"]].itertuples(index=False):
            won = now == old
            now = int(new) if won else now
            out.append((k[0], int(seq), bool(won), now))
        state.update((now,))
        yield pd.DataFrame(out, columns=[key, "seq", "won", "status"])

    kind = dict(changes.dtypes)[key]
    return changes.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, seq long, won boolean, status int", "status int", "append", GroupStateTimeout.NoTimeout)


def run_once(df: DataFrame, name: str, mode: str = "append", checkpoint: str | None = None) -> DataFrame:
    """All that is there now, through the streaming engine, as a table."""
    w = df.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    w.start().awaitTermination()
    return df.sparkSession.table(name)
