"""Facts that a converted document must meet: text present or absent, order, formulas, and neighbours of table cells.

Defined results
  null or empty document        nothing is present
  unverified facts              evaluated and reported, but they don't fail a document
  document without facts        no row
  text of no letters or digits  is present everywhere
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions.similarity import near_substring
from quillspark.operators.segments import pipe_tables
from quillspark.session import lookup_join, ship

KINDS = ("present", "absent", "order", "table", "math")
# Steps to a neighbour of a cell.
STEPS = {"up": (-1, 0), "down": (1, 0), "left": (0, -1), "right": (0, 1)}


@dataclass(frozen=True)
class Fact:
    id: str
    kind: str
    text: str = ""
    sequence: tuple[str, ...] = ()
    neighbours: tuple[tuple[str, str], ...] = ()
    most_edits: int = 0
    verified: bool = False


def parse_fact(line: str) -> Fact:
    """A fact from its JSON record; ValueError for an unknown kind or a missing field."""
    r = json.loads(line)
    kind = r.get("type")
    if kind not in KINDS:
        raise ValueError(f"unknown type {kind!r}")
    text = r.get("cell" if kind == "table" else "text") or ""
    if kind == "order" and len(r.get("sequence") or []) < 2 or kind != "order" and not text:
        raise ValueError(f"fact {r.get('id')!r} lacks what its type needs")
    return Fact(str(r["id"]), kind, text, tuple(r.get("sequence") or ()), tuple(sorted((r.get("neighbors") or {}).items())), int(r.get("max_diffs") or 0), bool(r.get("checked")))


def bare(text: str) -> str:
    """Only letters, digits and underscores, in their compatibility form and small."""
    return re.sub(r"[^\w]", "", unicodedata.normalize("NFKC", text).lower())


def formula(text: str) -> str:
    """A formula without dollar signs and blanks."""
    return re.sub(r"[\s$]", "", unicodedata.normalize("NFKC", text))


def place(needle: str, text: str, most_edits: int) -> int:
    """Where a needle stands within so many edits, or -1."""
    if not most_edits or not needle:
        return text.find(needle)
    exact = text.find(needle)
    if exact >= 0:
        return exact
    for k in range(len(text)):
        if near_substring(needle, text[k : k + len(needle) + most_edits]) <= most_edits:
            return k
    return -1


def failure(md: str, fact: Fact) -> str:
    """Why a document doesn't meet a fact; '' if it does."""
    if fact.kind in ("present", "absent", "math"):
        surface = formula if fact.kind == "math" else bare
        have = near_substring(surface(fact.text), surface(md)) <= fact.most_edits
        return "" if have != (fact.kind == "absent") else "there" if have else "missing"
    if fact.kind == "order":
        text, at = bare(md), -1
        for item in fact.sequence:
            k = place(bare(item), text, fact.most_edits)
            if k <= at:
                return f"missing: {item}" if k < 0 else f"too early: {item}"
            at = k
        return ""
    squeeze = lambda c: " ".join(c.split())
    for grid in pipe_tables(md):
        for r, row in enumerate(grid):
            for c, cell in enumerate(row):
                if squeeze(cell) == squeeze(fact.text):
                    return _neighbours(grid, r, c, fact, squeeze)
    return "no such cell"


def _neighbours(grid: list[list[str]], r: int, c: int, fact: Fact, squeeze) -> str:
    for side, want in fact.neighbours:
        y, x = (0, c) if side == "heading" else (r + STEPS[side][0], c + STEPS[side][1])
        if not (0 <= y < len(grid) and 0 <= x < len(grid[y])):
            return f"nothing {side}"
        have = squeeze(grid[y][x])
        if have != squeeze(want) and near_substring(squeeze(want), have) + max(0, len(have) - len(squeeze(want))) > fact.most_edits:
            return f"{side} is {have}"
    return ""


def check_facts(docs: DataFrame, key: str, text: str, facts: DataFrame, record: str) -> DataFrame:
    """(key, fact, verified, passed, detail) of each fact of each document; facts: (key, record), a JSON record each."""
    ship(docs.sparkSession)
    own = facts.groupBy(key).agg(F.sort_array(F.collect_list(record)).alias("_facts"))
    rows = lookup_join(docs.select(key, F.coalesce(F.col(text), F.lit("")).alias("_t")), own, [key], "inner")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = []
            for k, t, records in zip(b[key], b["_t"], b["_facts"]):
                for f in map(parse_fact, records):
                    why = failure(t, f)
                    got.append((k, f.id, f.verified, not why, why))
            yield pd.DataFrame(got, columns=[key, "fact", "verified", "passed", "detail"])

    return rows.mapInPandas(check, f"{key} {dict(docs.dtypes)[key]}, fact string, verified boolean, passed boolean, detail string")


def fact_gate(checks: DataFrame, key: str) -> DataFrame:
    """(key, facts, verified, failed, passed): a document passes if none of its verified facts fails."""
    failed = F.count_if(F.col("verified") & ~F.col("passed"))
    return checks.groupBy(key).agg(F.count("*").alias("facts"), F.count_if("verified").alias("verified"), failed.alias("failed"), (failed == 0).alias("passed"))
