"""Oversized entries cut into overlapping pieces at natural boundaries.

An entry is a range of lines of a text.  Offsets of all lines (prefix sums) and
sorted arrays of boundaries, one for each rank (before a heading, after a blank
line, after a line, after a line of fenced code, after a sentence, after a
word), are prefix data of the text; each piece ends at the last boundary of the
best rank that leaves it at least half full, found by binary search, and
otherwise at the last boundary under the limit of any rank; without one it is
cut hard at the limit.  The next piece steps back by up to `overlap`
characters, to a boundary if there is one.

The entries, much smaller than the texts, are broadcast to the texts while
their measured size allows.  Beyond that the texts still don't move for entries
that fit: line offsets alone are joined with the ranges, and only texts with an
entry to divide are joined with those.

Defined results
  null text, or no such document     no pieces
  range beyond the text              ends with the last line; a range that starts beyond it is empty
  end before start, null range       no pieces
  short entry                        one piece
  repeated entries                   one result for each distinct (key, index, range)
  CR LF                              the carriage return is a character
"""

from __future__ import annotations

import bisect
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.session import BROADCAST_BYTES, checkpointed, ship

LIMIT, OVERLAP = 6500, 200
#: Entries of one document that travel with one copy of its text.
SPANS = 512

_SENTENCE = re.compile(r"[.!?:;][\"')\]]?(?=\s)")
_WORD = re.compile(r"\s(?=\S)")
_HEADING = re.compile(r"#{1,6}\s")


class Lines:
    """Prefix sums of a text's lines, and its boundaries by rank, made when first needed."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.lines = text.split("\n")
        self.start = array("q", accumulate((len(line) + 1 for line in self.lines), initial=0))
        self._ranks: list[array] | None = None

    def span(self, first: int, last: int) -> tuple[int, int]:
        """Characters of lines first..last (from 1), each with one line feed."""
        last = min(last, len(self.lines))
        first = max(first, 1)
        return (self.start[first - 1], self.start[last]) if first <= last else (0, 0)

    @property
    def ranks(self) -> list[array]:
        """Sorted places after which one may cut, from the best rank to the least."""
        if self._ranks is None:
            heads, blanks, ends, code = array("q"), array("q"), array("q"), array("q")
            fenced = False
            for k, line in enumerate(self.lines):
                bare = line.strip()
                fence = bare.startswith(("```", "~~~"))
                if fence:
                    fenced = not fenced
                if fence and not fenced:
                    ends.append(self.start[k + 1])
                elif fence or fenced:
                    code.append(self.start[k + 1])
                else:
                    if bare.startswith("#") and _HEADING.match(bare):
                        heads.append(self.start[k])
                    (ends if bare else blanks).append(self.start[k + 1])
            sentences, words = (array("q", (m.end() for m in p.finditer(self.text))) for p in (_SENTENCE, _WORD))
            self._ranks = [heads, blanks, ends, code, sentences, words]
        return self._ranks


def cut(lines: Lines, first: int, last: int, limit: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of lines first..last; ends count the line feed after the last line."""
    a, b = lines.span(first, last)
    if b - a <= limit:
        return [(a, b)] if b > a else []
    out, p = [], a
    while b - p > limit:
        top = p + limit
        floor = (out[-1][1] if out else p) + 1  # every piece gets beyond the one before
        best = next((e for low in (max(floor, p + limit // 2), floor) for r in lines.ranks if (e := _last(r, low, top)) >= 0), top)
        out.append((p, best))
        p = _step_back(lines.ranks, max(best - overlap, p + 1), best)
    out.append((p, b))
    return out


def _last(rank: array, low: int, top: int) -> int:
    """The last boundary in low..top, or -1."""
    k = bisect.bisect_right(rank, top) - 1
    return rank[k] if k >= 0 and rank[k] >= low else -1


def _step_back(ranks: list[array], low: int, end: int) -> int:
    """The first boundary in low..end from which the overlap may start."""
    for r in ranks[1:]:
        k = bisect.bisect_left(r, low)
        if k < len(r) and r[k] < end:
            return r[k]
    return low


def split_entries(entries: DataFrame, docs: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, only_cut: bool = False, broadcast_limit: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, chunk_index, heading, start_line, end_line, chars, piece, n_pieces, start_char, end_char, text).

    only_cut: just the entries that had to be divided, without headings and texts.
    """
    ship(docs.sparkSession)
    cols = ["doc_id", "chunk_index", *([] if only_cut else ["heading"]), "start_line", "end_line"]
    lists = checkpointed(_grouped(entries.select(*cols).where("doc_id is not null and start_line <= end_line").distinct(), cols))
    texts = docs.select("doc_id", "text").where("text is not null")
    small = _list_bytes(lists, only_cut) <= broadcast_limit
    if not small and only_cut:  # what has to be divided is told by the line offsets
        lists = checkpointed(_grouped(_oversized(lists, texts, limit), cols))
        small = _list_bytes(lists, only_cut) <= broadcast_limit
    joined = texts.join(F.broadcast(lists) if small else lists, "doc_id")
    return joined.mapInPandas(_divider(limit, overlap, only_cut), _PIECES)


def _grouped(spans: DataFrame, cols: list[str]) -> DataFrame:
    """(doc_id, spans); a document with very many entries gets several rows, each with a copy of its text."""
    n = spans.groupBy("doc_id").agg(F.count("*").alias("n"))
    parts = spans.join(n, "doc_id").withColumn("part", F.pmod(F.xxhash64(*cols[1:]), F.ceil(F.col("n") / SPANS)))
    return parts.groupBy("doc_id", "part").agg(F.collect_list(F.struct(*cols[1:])).alias("spans")).drop("part")


def _list_bytes(lists: DataFrame, bare: bool) -> int:
    """Bytes of the grouped entries as they travel."""
    width = "size(spans) * 40L" if bare else "aggregate(spans, 0L, (n, s) -> n + 64 + coalesce(octet_length(s.heading), 0))"
    return lists.agg(F.sum(F.expr(f"48L + {width}"))).first()[0] or 0


def _oversized(lists: DataFrame, texts: DataFrame, limit: int) -> DataFrame:
    """The entries of more than `limit` characters, from line offsets made where the texts lie."""

    def offsets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "starts": [list(Lines(t).start) for t in b["text"]]})

    starts = texts.mapInPandas(offsets, "doc_id long, starts array<int>")
    s = lists.join(starts, "doc_id").select("doc_id", "starts", F.explode("spans").alias("s")).select("doc_id", "starts", "s.*")
    last, first = F.least(F.col("end_line"), F.size("starts") - 1), F.greatest(F.col("start_line"), F.lit(1))
    chars = F.when(first <= last, F.get("starts", last) - F.get("starts", first - 1))
    return s.where(chars > limit).drop("starts")


_PIECES = "doc_id long, chunk_index int, heading string, start_line int, end_line int, chars int, piece int, n_pieces int, start_char int, end_char int, text string"


def _divider(limit: int, overlap: int, only_cut: bool):
    names = [c.split()[0] for c in _PIECES.split(", ")]

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = []
            for doc, t, spans in zip(b["doc_id"], b["text"], b["spans"]):
                lines = Lines(t)
                whole = t + "\n"
                for s in spans:
                    first, last = s["start_line"], s["end_line"]
                    x, y = lines.span(first, last)
                    if only_cut and y - x <= limit:
                        continue
                    cuts = cut(lines, first, last, limit, overlap)
                    for k, (p, q) in enumerate(cuts):
                        got.append((doc, s["chunk_index"], None if only_cut else s["heading"], first, last, y - x, k, len(cuts), p, q, None if only_cut else whole[p:q]))
            yield pd.DataFrame(got, columns=names)

    return pieces
