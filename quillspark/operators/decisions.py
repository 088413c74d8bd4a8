"""Decisions over findings and units: overlap with a claim, severity, survival, verdicts, numbering, merges of searches.

Defined results
  empty or null texts      no words; their similarity is 0
  ties                     by the key columns named in each docstring
  empty tables             empty results
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Words that carry no content.
STOP_WORDS = ("a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "have", "in", "is", "it", "its", "of", "on", "or", "that", "the", "this", "to", "was", "were", "which", "with")
# Thresholds of a finding that touches the claim, by vectors and by words.
TOUCHES, WORD_SHARE, SHARED_WORDS = 0.65, 0.25, 3
SEVERITIES = ("critical", "significant", "minor")


def content_words(text: Column) -> Column:
    """Distinct words in lower case, split at blanks, without stop words."""
    words = F.array_distinct(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"))
    return F.array_except(words, F.array(F.lit(""), *[F.lit(w) for w in STOP_WORDS]))


def set_jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays as sets; 0 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def word_overlap(a: Column, b: Column) -> tuple[Column, Column]:
    """(similarity, number of shared words) of two texts by their content words; 0 if either has none."""
    x, y = content_words(a), content_words(b)
    return F.when((F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(set_jaccard(x, y)), F.size(F.array_intersect(x, y))


def raised_severity(severity: Column, cosine: Column | None, similarity: Column, shared: Column) -> Column:
    """Critical where a lesser finding touches the claim: by cosine where there is one, else by words."""
    by_words = (similarity >= WORD_SHARE) & (shared >= SHARED_WORDS)
    touches = by_words if cosine is None else F.coalesce(cosine >= TOUCHES, by_words)
    return F.when(severity.isin("significant", "minor") & touches, "critical").otherwise(severity)


def cross_examined(findings: DataFrame, verdicts: DataFrame, key: str, survived: str) -> DataFrame:
    """The findings with an outcome: survived, killed or unjudged; of several verdicts one that kills decides."""
    v = verdicts.groupBy(key).agg(F.bool_and(survived).alias("_s"))
    outcome = F.when(F.col("_s").isNull(), "unjudged").when(F.col("_s"), "survived").otherwise("killed")
    return findings.join(v, key, "left").withColumn("outcome", outcome).drop("_s")


def verdicts(findings: DataFrame, group: str, severity: str, touches: str, compound: str) -> DataFrame:
    """(group, verdict, confidence, major, dominant): the verdict of each group of surviving findings.

    touches: whether a finding shares enough words with the claim; compound: the
    name of the compound it belongs to, or null.  Both make it a major one;
    dominant is the compound of most findings (ties: the least name).
    """
    crit = F.col(severity) == "critical"
    x = findings.groupBy(group).agg(
        F.count_if(crit).alias("critical"), F.count_if(F.col(severity) == "significant").alias("significant"),
        F.coalesce(F.bool_or(crit & F.col(touches)), F.lit(False)).alias("against"), F.count_if(F.col(touches) | F.col(compound).isNotNull()).alias("major"),
    )
    c = findings.where(F.col(compound).isNotNull()).groupBy(group, compound).agg(F.count("*").alias("n"))
    c = c.groupBy(group).agg(F.min_by(compound, F.struct(-F.col("n"), compound)).alias("dominant"))
    verdict = F.when(F.col("against"), "Undermined").when(F.col("critical") + F.col("significant") > 0, "Weakened").otherwise("Sound")
    sure = F.when(~F.col("against") & (F.col("critical") == 0) & (F.col("significant") > 0), "Medium").otherwise("High")
    return x.join(c, group, "left").select(group, verdict.alias("verdict"), sure.alias("confidence"), "major", "dominant")


def severity_numbers(df: DataFrame, group: list[str], severity: str, key: str) -> DataFrame:
    """The rows of each group numbered from the most severe on (unknown ones last, ties by key)."""
    rank = F.coalesce(*[F.when(F.col(severity) == s, k) for k, s in enumerate(SEVERITIES)], F.lit(len(SEVERITIES)))
    return df.withColumn("number", F.row_number().over(Window.partitionBy(*group).orderBy(rank, key)))


def decided_claims(claims: DataFrame, decisions: DataFrame, chunk: str, local: str, supported: str) -> DataFrame:
    """(chunk, local, state): claims by what their chunk's decision says: supported, unsupported, missing (none), and hallucinated for decisions without a claim."""
    d = decisions.groupBy(chunk, local).agg(F.bool_or(supported).alias("_yes"))
    j = claims.select(chunk, local, F.lit(True).alias("_claim")).distinct().join(d, [chunk, local], "full")
    state = F.when(F.col("_claim").isNull(), "hallucinated").when(F.col("_yes").isNull(), "missing").when(F.col("_yes"), "supported").otherwise("unsupported")
    return j.select(chunk, local, state.alias("state"))


def merged_hits(hits: DataFrame, group: str, item: str, score: str, k: int) -> DataFrame:
    """(group, item, score, place): hits of all queries of a group, each item once with its best score, the k best (ties by item)."""
    best = hits.groupBy(group, item).agg(F.max(score).alias(score))
    w = Window.partitionBy(group).orderBy(F.desc(score), item)
    return best.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def indexed_targets(edges: DataFrame, source: str, target: str, known: DataFrame) -> DataFrame:
    """Distinct edges to known targets other than the source itself."""
    return edges.where(F.col(source) != F.col(target)).select(source, target).distinct().join(known.select(target).distinct(), target, "left_semi").select(source, target)


def within_budgets(df: DataFrame, group: list[str], order: list, size: str, budgets: dict[str, int]) -> DataFrame:
    """(group, budget, n, used) for each named budget: leading rows until the first that would overflow it."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    x = df.withColumn("_sum", F.sum(size).over(w))
    fits = [F.struct(F.lit(b).alias("budget"), F.count_if(F.col("_sum") <= n).alias("n"), F.coalesce(F.max(F.when(F.col("_sum") <= n, F.col("_sum"))), F.lit(0)).cast("long").alias("used")) for b, n in budgets.items()]
    return x.groupBy(*group).agg(F.array(*fits).alias("b")).select(*group, F.explode("b").alias("b")).select(*group, "b.*")


def generation_order(slots: DataFrame, thread: str, slot: str, role: str, chain: str, turn: str) -> DataFrame:
    """The slots of each thread with the place they are written at: teasers, chains in turn order, signal, the rest."""
    in_chain = F.col(chain).isNotNull()
    rank = F.when(in_chain, 1).when(F.col(role) == "teaser", 0).when(F.col(role) == "signal", 2).otherwise(3)
    w = Window.partitionBy(thread).orderBy(rank, F.col(chain), F.col(turn), slot)
    return slots.withColumn("place", F.row_number().over(w))


def first_children(slots: DataFrame, thread: str, slot: str, parent: str, parents: Column, children: Column) -> DataFrame:
    """(thread, slot, child): the first child (by slot) among `children` of each slot among `parents`."""
    up = slots.where(parents).select(thread, slot)
    down = slots.where(children).select(thread, F.col(parent).alias(slot), F.col(slot).alias("child")).groupBy(thread, slot).agg(F.min("child").alias("child"))
    return up.join(down, [thread, slot])


def marked_slots(slots: DataFrame, thread: str, slot: str, wanted: Column, key) -> DataFrame:
    """(thread, slot): of every second thread (by hash) the slot among `wanted` with the least hash; key: a function of columns to a stable number."""
    even = F.pmod(key(F.col(thread), F.lit("edited")), F.lit(2)) == 0
    return slots.where(even & wanted).groupBy(thread).agg(F.min_by(slot, F.struct(key(F.col(thread), F.lit("edited"), F.col(slot)), slot)).alias(slot))


def nearest_known(fallback: dict[int, int], known: set[int], start: int) -> int | None:
    """The first known number on the way from `start` through the fallback map; None if the way ends or turns round."""
    seen: set[int] = set()
    while start not in seen:
        if start in known:
            return start
        seen.add(start)
        if start not in fallback:
            return None
        start = fallback[start]
    return None


def cross_reference_flags(per_section: DataFrame, group: str, kind: str, n: str, rules: list[tuple[str, str, int, str, int]]) -> DataFrame:
    """(group, flag): rules (flag, kind, at least, other kind, fewer than) over the counts of a group's kinds."""
    total = lambda k: F.sum(F.when(F.col(kind) == k, F.col(n)).otherwise(0))
    x = per_section.groupBy(group).agg(F.array_compact(F.array(*[F.when((total(a) >= least) & (total(b) < fewer), flag) for flag, a, least, b, fewer in rules])).alias("flags"))
    return x.select(group, F.explode("flags").alias("flag"))


def scored_pairs(units: DataFrame, unit: str, text: str, stated: DataFrame, key: str, claim: str, scorer, least: float) -> DataFrame:
    """(unit, key, score): every unit against a small stated set by a scorer of two text columns, where it reaches `least`.

    The scorer is the place to plug a model in: a function of two columns to a
    score, a Pandas UDF for instance.
    """
    from quillspark.session import against

    pairs = against(units.select(F.col(unit), F.col(text).alias("_t")), stated.select(F.col(key), F.col(claim).alias("_c")))
    return pairs.select(unit, key, scorer(F.col("_t"), F.col("_c")).alias("score")).where(F.col("score") >= least)
