"""Filling fixed-capacity containers with documents, sized in tokens.

A document above the capacity is divided into full pieces and a rest; nothing
else is.  Documents are spread over shards by a hash, so many that a shard has
about `SHARD_CONTAINERS` containers however large the corpus, and each shard is
packed in one task: items above a third of the capacity are matched greedily,
at most two in a container (the largest with the largest that still fits); the
smaller ones follow in falling size, each into the container with the
least space that still takes it.

Defined results
  null or empty text     no tokens; it lies in a container of its shard, piece 0 of 1
  repeated texts         packed like others, by their own ids
  repeated ids           each row is packed; give unique ids for unique rows
  empty table            no rows
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.token_counts import TOKENIZERS, VOCABULARY, counter
from quillspark.session import checkpointed, ship

CAPACITY = 2048
SHARD_CONTAINERS = 4096


def token_sizes(docs: DataFrame, key: str, text: str, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, tokens) of whole texts."""
    ship(docs.sparkSession)

    def sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter(folder, vocabulary).count
        for b in batches:
            yield pd.DataFrame({"k": b["k"], "tokens": count(["" if t is None else t for t in b["t"]])})

    kind = dict(docs.dtypes)[key]
    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(sizes, f"k {kind}, tokens long").withColumnRenamed("k", key)


class Gaps:
    """Open containers by free space; a bit mask finds the least sufficient gap at once."""

    def __init__(self, capacity: int) -> None:
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = 0

    def put(self, free: int, container: int) -> None:
        self.at[free].append(container)
        self.mask |= 1 << free

    def take(self, size: int) -> tuple[int, int] | None:
        """The container with the least space of at least `size`, and that space."""
        above = self.mask >> size
        if not above:
            return None
        free = size + (above & -above).bit_length() - 1
        c = self.at[free].pop()
        if not self.at[free]:
            self.mask ^= 1 << free
        return c, free


def pack(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Container of each item; no item is larger than the capacity."""
    out = np.full(len(sizes), -1, np.int64)
    order = np.argsort(-sizes, kind="stable")
    gaps, n = Gaps(capacity), 0
    n_large = int(np.searchsorted(-sizes[order], -(capacity // 3), side="left"))
    large = Gaps(capacity)  # unmatched large items, by size
    for i in order[:n_large][::-1]:
        large.put(int(sizes[i]), int(i))
    matched: set[int] = set()
    for i in map(int, order[:n_large]):
        if i in matched:
            continue
        s = int(sizes[i])
        large.at[s].remove(i)
        if not large.at[s]:
            large.mask ^= 1 << s
        out[i], free = n, capacity - s
        fits = large.mask & ((1 << (free + 1)) - 1)
        if fits:
            t = fits.bit_length() - 1
            j, _ = large.take(t)
            matched.add(j)
            out[j], free = n, free - t
        gaps.put(free, n)
        n += 1
    for i in map(int, order[n_large:]):
        s = int(sizes[i])
        got = gaps.take(s)
        if got is None:
            got, n = (n, capacity), n + 1
        out[i] = got[0]
        gaps.put(got[1] - s, got[0])
    return out


def pack_documents(sizes: DataFrame, key: str, capacity: int = CAPACITY, shard_containers: int = SHARD_CONTAINERS) -> DataFrame:
    """(key, piece, n_pieces, first_token, tokens, container) from (key, tokens)."""
    sizes = checkpointed(sizes.select(key, "tokens"))
    total, rows = sizes.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.count("*")).first()
    # a shard also holds no more than a few hundred small items for each container
    shards = max(1, -(-total // (capacity * shard_containers)), -(-rows // (64 * shard_containers)))
    whole = F.floor(F.col("tokens") / capacity)
    n = F.greatest(F.lit(1), F.ceil(F.col("tokens") / capacity)).cast("int")
    items = (
        sizes.withColumn("n_pieces", n)
        .withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("n_pieces") - 1)))
        .withColumn("first_token", F.col("piece").cast("long") * capacity)
        .withColumn("tokens", F.when(F.col("piece") < whole, F.lit(capacity)).otherwise(F.col("tokens") - F.col("first_token")).cast("int"))
        .withColumn("shard", F.pmod(F.xxhash64(F.col(key), F.col("piece")), F.lit(shards)))
    )
    kind = dict(sizes.dtypes)[key]

    def pack_shard(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([key, "piece"], kind="stable")
        where = pack(pdf["tokens"].to_numpy(np.int64), capacity)
        return pdf.assign(container=(pdf["shard"].to_numpy(np.int64) << 32) | where)[[key, "piece", "n_pieces", "first_token", "tokens", "container"]]

    return items.groupBy("shard").applyInPandas(pack_shard, f"{key} {kind}, piece int, n_pieces int, first_token long, tokens int, container long")
