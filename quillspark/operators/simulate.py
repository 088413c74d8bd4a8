"""Deterministic simulation: draws from hashes, and casting with usage caps."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import stable_uniform
from quillspark.session import against, ship


def votes(voters: DataFrame, targets: DataFrame, voter: str, target: str, participation: Column, upvote: Column, seed: str = "") -> DataFrame:
    """(voter, target, direction) of every voter and target of which the first draw says that the vote is cast.

    Draws depend on the ids alone.  The voters are a stated set, taken in blocks
    whose measured size bounds what is broadcast; every task makes the draws of
    its own targets.
    """
    j = against(targets, voters)
    u = stable_uniform(F.lit(f"{seed}vote"), F.col(voter), F.col(target))
    w = stable_uniform(F.lit(f"{seed}side"), F.col(voter), F.col(target))
    return j.where(u < participation).select(voter, target, F.when(w < upvote, 1).otherwise(-1).alias("direction"))


def depth_rate(rate: Column, depth: Column, falloff: float = 0.85, cap: float = 0.90) -> Column:
    return F.least(F.lit(cap), rate) * F.pow(F.lit(falloff), depth)


def cast_roles(slots: DataFrame, people: pd.DataFrame, group: str, order: str, domain: str, cap: int = 3) -> DataFrame:
    """(group, order, person): each slot in order gets the least used person of its domain (any domain if there is none) below the cap, ties by hash.

    people: (person, domain), a small roster; the state lives within one group.
    """
    ship(slots.sparkSession)
    roster = list(people[["person", "domain"]].itertuples(index=False, name=None))

    def cast(pdf: pd.DataFrame) -> pd.DataFrame:
        used: dict[str, int] = {}
        out = []
        for g, o, d in pdf.sort_values(order, kind="stable")[[group, order, domain]].itertuples(index=False):
            free = [p for p, _ in roster if used.get(p, 0) < cap]
            fit = [p for p, x in roster if x == d and used.get(p, 0) < cap] or free
            who = min(fit, key=lambda p: (used.get(p, 0), hashlib.sha256(f"{g}:{o}:{p}".encode()).hexdigest()), default=None)
            if who is not None:
                used[who] = used.get(who, 0) + 1
            out.append((g, o, who))
        return pd.DataFrame(out, columns=[group, order, "person"])

    kinds = dict(slots.dtypes)
    return slots.select(group, order, domain).groupBy(group).applyInPandas(cast, f"{group} {kinds[group]}, {order} {kinds[order]}, person string")


def thread_violations(comments: DataFrame, thread: str, slot: str, parent: str, depth: str) -> DataFrame:
    """(thread, slot, rule): parent missing, depth not the parent's + 1, repeated slot, root not at depth 0."""
    p = comments.select(thread, F.col(slot).alias(parent), F.col(depth).alias("_pd")).groupBy(thread, parent).agg(F.max("_pd").alias("_pd"))
    x = comments.join(p, [thread, parent], "left")
    n = comments.groupBy(thread, slot).agg(F.count("*").alias("_n"))
    x = x.join(n, [thread, slot])
    rules = F.array_compact(F.array(
        F.when(F.col(parent).isNotNull() & F.col("_pd").isNull(), "no_parent"), F.when(F.col("_pd").isNotNull() & (F.col(depth) != F.col("_pd") + 1), "wrong_depth"),
        F.when(F.col("_n") > 1, "repeated_slot"), F.when(F.col(parent).isNull() & (F.col(depth) != 0), "deep_root"),
    ))
    return x.select(thread, slot, F.explode(rules).alias("rule")).distinct()
