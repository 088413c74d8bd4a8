"""Runs of tokens that pages of one host share, by suffix arrays.

The token streams of a host's pages are concatenated, with an end of its own
after each page, and their suffixes are sorted to a depth of `run` tokens by
prefix doubling.  Neighbours in that order with equal prefixes are repeated runs;
those on at least `pages` distinct pages are shared.  What shared runs cover is
boilerplate, the rest are the unique runs of a page.

A host of more than `BLOCK_TOKENS` tokens is cut into blocks of pages.  Each
block sorts its own suffixes and hands on one row for each distinct prefix with
its number of pages; the blocks' numbers are added up, and each block gets back
the prefixes of its own that are shared in the whole host.  So no host is
gathered in one task, and the result doesn't depend on the blocks.

Defined results
  null host              a host of its own (null)
  null or empty text     no runs; the unique text is as it was
  repeated page keys     their texts are pages of their own
  page shorter than run  nothing of it can be shared
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm import textscan as ts
from quillspark.session import broadcast_if_small, checkpointed, ship

#: Tokens of a run that counts as shared, at least.
RUN = 16
#: Tokens that one suffix array holds, about.
BLOCK_TOKENS = 1_000_000

_TOKEN = re.compile(r"\w+|[^\w\s]")


def token_stream(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of each token."""
    spans = np.array([m.span() for m in _TOKEN.finditer(text)], np.int64).reshape(-1, 2)
    return spans[:, 0], spans[:, 1]


def suffix_classes(tokens: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array to the depth of `run` tokens, class of each suffix by its first `run` tokens)."""
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    depth, n = 1, len(rank)
    while depth < run and n:
        step = min(depth, run - depth)
        after = np.full(n, -1, np.int64)
        after[: n - step] = rank[step:]
        rank = np.unique(rank * np.int64(n + 1) + after + 1, return_inverse=True)[1].astype(np.int64)
        depth += step
    return np.argsort(rank, kind="stable"), rank


class Block:
    """Pages of one host, their tokens, and the prefix of `run` tokens from each place within a page."""

    def __init__(self, texts: list[str], run: int) -> None:
        self.texts, self.run = texts, run
        self.spans = [token_stream(t) for t in texts]
        sizes = np.array([len(a) for a, _ in self.spans], np.int64)
        codes, at = ts.code_points(texts)
        first = np.concatenate([a + s for (a, _), s in zip(self.spans, at)]) if texts else np.zeros(0, np.int64)
        last = np.concatenate([b + s for (_, b), s in zip(self.spans, at)]) if texts else np.zeros(0, np.int64)
        self.page = np.repeat(np.arange(len(texts)), sizes)
        self.tokens = ts.run_hashes(codes, first, last) if len(first) else np.zeros(0, np.uint64)
        self.offset = np.concatenate([[0], np.cumsum(sizes)])
        end = np.minimum(np.arange(len(self.page)) + run - 1, max(len(self.page) - 1, 0))
        self.whole = (self.page[end] == self.page) & (np.arange(len(self.page)) + run <= len(self.page)) if len(self.page) else np.zeros(0, bool)

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """(key of each distinct prefix, number of pages that have it)."""
        order, rank = suffix_classes(self.tokens, self.run)
        order = order[self.whole[order]]
        pair = np.unique(np.stack([rank[order], self.page[order]]), axis=1) if len(order) else np.zeros((2, 0), np.int64)
        _, first = np.unique(rank[order], return_index=True)
        return self.prefixes()[order[first]], np.unique(pair[0], return_counts=True)[1]

    def prefixes(self) -> np.ndarray:
        """A hash of the `run` tokens from each place on."""
        h = np.zeros(len(self.tokens), np.uint64)
        padded = np.append(self.tokens, np.zeros(self.run, np.uint64))
        for k in range(self.run):
            h = ts.mix(h ^ padded[k : k + len(h)])
        return h

    def covered(self, shared: np.ndarray) -> np.ndarray:
        """Whether a token lies in a prefix that is shared."""
        hit = self.whole & np.isin(self.prefixes(), shared)
        step = np.zeros(len(hit) + self.run + 1, np.int64)
        at = np.nonzero(hit)[0]
        np.add.at(step, at, 1)
        np.add.at(step, at + self.run, -1)
        return np.cumsum(step)[: len(hit)] > 0

    def runs(self, shared: np.ndarray) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        """(page, covered ranges of characters)."""
        inside = self.covered(shared)
        for p, (a, b) in enumerate(self.spans):
            own = inside[self.offset[p] : self.offset[p + 1]]
            edge = np.diff(own.astype(np.int8), prepend=0, append=0)
            yield p, [(int(a[x]), int(b[y - 1])) for x, y in zip(np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0])]


def unique_text(text: str, ranges: list[tuple[int, int]]) -> str:
    """The text without the ranges."""
    out, at = [], 0
    for a, b in ranges:
        out.append(text[at:a])
        at = b
    return "".join([*out, text[at:]])


def shared_runs(df: DataFrame, host: str, page: str, text: str, run: int = RUN, pages: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(host, page, start_char, end_char, shared, piece): the shared and the unique runs of every page."""
    ship(df.sparkSession)
    kinds = dict(df.dtypes)
    rows = df.select(F.col(host).alias("host"), F.col(page).alias("page"), F.col(text).alias("t")).where("t is not null and t <> ''")
    # a token has a character at least, so the blocks hold no more tokens than this
    size = rows.groupBy("host").agg(F.ceil(F.sum(F.length("t")) / (3 * block_tokens)).alias("blocks"))
    size = checkpointed(size.where("blocks > 1"))
    rows = rows.join(broadcast_if_small(size)[0], "host", "left")
    rows = rows.withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", F.pmod(F.xxhash64("page", "t"), F.col("blocks")))
    rows = checkpointed(rows.withColumn("_group", F.xxhash64("host", F.col("host").isNull(), "block")))

    def keys(pdf: pd.DataFrame) -> pd.DataFrame:
        k, n = Block(pdf["t"].tolist(), run).keys()
        if pdf["blocks"].iloc[0] == 1:  # nothing to be added by other blocks
            k, n = k[n >= pages], n[n >= pages]
        return pd.DataFrame({"_group": pdf["_group"].iloc[0], "host": pdf["host"].iloc[0], "key": k.view(np.int64), "n": n})

    found = checkpointed(rows.groupBy("_group").applyInPandas(keys, f"_group long, host {kinds[host]}, key long, n long"))
    shared = found.groupBy("host", "key").agg(F.sum("n").alias("n")).where(F.col("n") >= pages).select(F.col("host").alias("h"), "key")
    shared = found.join(shared, F.col("host").eqNullSafe(F.col("h")) & (found["key"] == shared["key"]), "left_semi").select("_group", "key")

    def cut(pdf: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        block, got = Block(pdf["t"].tolist(), run), []
        for p, ranges in block.runs(np.sort(known["key"].to_numpy(np.int64)).view(np.uint64)):
            t, at, key, h = block.texts[p], 0, pdf["page"].iloc[p], pdf["host"].iloc[p]
            for a, b in [*ranges, (len(t), len(t))]:
                if at < a:
                    got.append((h, key, at, a, False, t[at:a]))
                if a < b:
                    got.append((h, key, a, b, True, t[a:b]))
                at = b
        return pd.DataFrame(got, columns=["host", "page", "start_char", "end_char", "shared", "piece"])

    schema = f"host {kinds[host]}, page {kinds[page]}, start_char int, end_char int, shared boolean, piece string"
    return rows.groupBy("_group").cogroup(shared.groupBy("_group")).applyInPandas(cut, schema)
