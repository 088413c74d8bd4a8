"""Aggregates of evaluation: recall, agreement, calibration, guards.

Ratios follow one convention: an empty reference counts as fully covered, an
undefined precision or recall as 0, and null axes leave a mean together with
their place in its denominator.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.operators.sequence import running_totals
from quillspark.session import BROADCAST_BYTES, broadcast_if_small, checkpointed, lookup_join, measured_bytes, ship

WORD = r"[\p{L}\p{N}_]+"
_WORD = re.compile(r"\w+")  # letters, numbers and underscores


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def counted(text: str) -> Counter:
    return Counter(_WORD.findall(text.lower()))


def word_counts(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, token, n), counted within each row where it lies; a repeated key has rows of its own."""
    ship(df.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [(k, w, n) for k, t in zip(b["k"], b["t"]) for w, n in counted(t).items()]
            yield pd.DataFrame(got, columns=[key, "token", "n"])

    rows = df.select(F.col(key).alias("k"), F.col(text).alias("t")).where("t is not null")
    return rows.mapInPandas(count, f"{key} {dict(df.dtypes)[key]}, token string, n long")


def multiset_recall(refs: DataFrame, ref_key: str, ref_text: str, hyps: DataFrame, hyp_key: str, hyp_text: str, least: float = 0.0, best: bool = False, limit: int = BROADCAST_BYTES) -> DataFrame:
    """(ref_key, hyp_key, matched, recall) of the pairs with a recall of at least `least`: sum of least counts over the reference's size.

    best: of each reference, only the pair of the highest recall (ties: the
    smallest hyp_key), of which a task gives on no more than one a batch.
    Pairs without a shared token have no row.  The references are the small side (a stated set of queries).  While
    their counts, measured, stay within `limit` bytes they go to the tasks,
    which score each text where it lies, without any shuffle; beyond that the
    counts are joined by token, from which a hot token is taken apart.
    """
    r = checkpointed(word_counts(refs, ref_key, ref_text).groupBy(ref_key, "token").agg(F.sum("n").alias("n")))
    size = checkpointed(r.groupBy(ref_key).agg(F.sum("n").alias("size")))
    if measured_bytes(r) <= limit:
        pairs = _scored_in_place(r, size, ref_key, hyps, hyp_key, hyp_text, least, best)
    else:
        h = word_counts(hyps, hyp_key, hyp_text).withColumnRenamed("n", "m")
        by_token = checkpointed(r.groupBy("token").agg(F.collect_list(F.struct(ref_key, "n")).alias("refs")))
        pairs = lookup_join(h, by_token, ["token"], "inner", limit).select(hyp_key, "m", F.explode("refs").alias("r")).select("r.*", hyp_key, "m")
        pairs = pairs.groupBy(ref_key, hyp_key).agg(F.sum(F.least("n", "m")).alias("matched"))
    side, _ = broadcast_if_small(size, limit)
    out = pairs.join(side, ref_key).select(ref_key, hyp_key, "matched", (F.col("matched") / F.col("size")).alias("recall")).where(F.col("recall") >= least)
    if not best:
        return out
    top = out.groupBy(ref_key).agg(F.min_by(F.struct(hyp_key, "matched", "recall"), F.struct(-F.col("recall"), hyp_key)).alias("b"))
    return top.select(ref_key, "b.*")


def _scored_in_place(counts: DataFrame, sizes: DataFrame, ref_key: str, hyps: DataFrame, hyp_key: str, hyp_text: str, least: float, best: bool) -> DataFrame:
    """Scores by an inverted index of the references' counts, whose size has been measured."""
    pdf, size = counts.toPandas(), dict(sizes.toPandas().itertuples(index=False))
    names, row = np.unique(pdf[ref_key].to_numpy(), return_inverse=True)
    total_of = np.array([size[x] for x in names], float)
    known = {t: k for k, t in enumerate(sorted(set(pdf["token"])))}
    col = pdf["token"].map(known).to_numpy(int) if len(pdf) else np.zeros(0, int)
    by_word = np.argsort(col, kind="stable")
    start = np.searchsorted(col[by_word], np.arange(len(known) + 1))
    row, n = row[by_word], pdf["n"].to_numpy(np.int64)[by_word]

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got: list[tuple] = []
            top: dict[int, tuple] = {}
            for key, text in zip(b["k"], b["t"]):
                have = [(known[w], m) for w, m in counted(text).items() if w in known]
                if not have:
                    continue
                k, m = (np.array(x) for x in zip(*have))
                width = start[k + 1] - start[k]
                at = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width) + np.repeat(start[k], width)
                total = np.bincount(row[at], weights=np.minimum(n[at], np.repeat(m, width)), minlength=len(names))
                for i in np.nonzero((total > 0) & (total >= least * total_of - 1e-9))[0]:
                    if not best:
                        got.append((names[i], key, int(total[i])))
                    elif i not in top or (-total[i], key) < top[i]:
                        top[i] = (-total[i], key)
            got += [(names[i], key, int(-t)) for i, (t, key) in top.items()]
            yield pd.DataFrame(got, columns=[ref_key, hyp_key, "matched"])

    rows = hyps.select(F.col(hyp_key).alias("k"), F.col(hyp_text).alias("t")).where("t is not null")
    return rows.mapInPandas(score, f"{ref_key} {dict(counts.dtypes)[ref_key]}, {hyp_key} {dict(hyps.dtypes)[hyp_key]}, matched long")


def _compared(df: DataFrame, key: str, a: str, b: str, result: str, of) -> DataFrame:
    """(key, *result) of two texts per row, where the row lies; null texts are empty."""
    ship(df.sparkSession)
    names = [key, *(c.split()[0] for c in result.split(", "))]

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            yield pd.DataFrame([(k, *of(p or "", q or "")) for k, p, q in zip(x["k"], x["a"], x["b"])], columns=names)

    return df.select(F.col(key).alias("k"), F.col(a).alias("a"), F.col(b).alias("b")).mapInPandas(each, f"{key} {dict(df.dtypes)[key]}, {result}")


def pairwise_coverage(df: DataFrame, key: str, source: str, target: str) -> DataFrame:
    """(key, coverage, drift) of two texts per row, by word multisets: lost from the source, and added by the target."""

    def of(a: str, b: str) -> tuple[float, float]:
        x, y = counted(a), counted(b)
        n, m, both = x.total(), y.total(), (x & y).total()
        return both / n if n else 1.0, (m - both) / m if m else 0.0

    return _compared(df, key, source, target, "coverage double, drift double", of)


def char_conservation(df: DataFrame, key: str, before: str, after: str) -> DataFrame:
    """(key, lost, extra): characters (without blanks, tabs and line ends) by multiset."""
    blank = str.maketrans("", "", " \t\n\x0b\x0c\r")

    def of(a: str, b: str) -> tuple[int, int]:
        x, y = Counter(a.translate(blank)), Counter(b.translate(blank))
        return (x - y).total(), (y - x).total()

    return _compared(df, key, before, after, "lost long, extra long", of)


def eligible_means(df: DataFrame, axes: list[str], group: list[str] = ()) -> DataFrame:
    """Mean of each axis over the rows that have it, and how many those are."""
    aggs = [x for a in axes for x in (F.avg(a).alias(f"{a}_mean"), F.count(a).alias(f"{a}_n"))]
    return df.groupBy(*group).agg(*aggs)


def safe_ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, 0.0).otherwise(a / b)


def precision_recall(df: DataFrame, truth: Column, flag: Column, group: list[str] = ()) -> DataFrame:
    x = df.select(*group, truth.alias("t"), flag.alias("f")).groupBy(*group).agg(
        F.count_if(F.col("t") & F.col("f")).alias("tp"), F.count_if(~F.col("t") & F.col("f")).alias("fp"), F.count_if(F.col("t") & ~F.col("f")).alias("fn")
    )
    p, r = safe_ratio(F.col("tp"), F.col("tp") + F.col("fp")), safe_ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return x.withColumn("precision", p).withColumn("recall", r).withColumn("f1", safe_ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def micro_macro(per_label: DataFrame) -> DataFrame:
    """One row of micro and macro F1 over labels with tp, fp, fn and f1."""
    s = per_label.agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"), F.avg("f1").alias("macro_f1"), F.count("*").alias("labels"))
    return s.withColumn("micro_f1", safe_ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")))


def roc_curve(df: DataFrame, score: str, bad: str) -> DataFrame:
    """(threshold, flagged, tp, fp, tpr, fpr): a row per distinct value and one above the largest; a row is flagged if its value is below.

    Counts per value are aggregated first; the running sums then go over
    distinct values only.
    """
    per = df.groupBy(F.col(score).alias("v")).agg(F.count_if(F.col(bad)).alias("p"), F.count_if(~F.col(bad)).alias("n"))
    top = per.agg((F.max("v") + 1).alias("v")).select("v", F.lit(0).cast("long").alias("p"), F.lit(0).cast("long").alias("n"))
    per = checkpointed(per.unionByName(top).where("v is not null"))
    c = running_totals(per, ["v"], {"tp": "p", "fp": "n"}).crossJoin(F.broadcast(per.agg(F.sum("p").alias("all_bad"), F.sum("n").alias("all_good"))))  # one row
    return c.select(F.col("v").alias("threshold"), (F.col("tp") + F.col("fp")).alias("flagged"), "tp", "fp", safe_ratio(F.col("tp"), F.col("all_bad")).alias("tpr"), safe_ratio(F.col("fp"), F.col("all_good")).alias("fpr"))


def operating_point(curve: DataFrame, most_fpr: float = 0.05) -> DataFrame:
    """The threshold with the best TPR at an FPR of at most `most_fpr` (ties: precision, then threshold); without one the best TPR - FPR."""
    within = F.col("fpr") <= most_fpr
    c = curve.withColumn("precision", safe_ratio(F.col("tp"), F.col("flagged")))
    best = lambda cond, *by: F.max_by(F.struct("threshold", "tpr", "fpr"), F.when(cond, F.struct(*by)))
    one = c.agg(best(within & (F.col("flagged") > 0), F.col("tpr"), F.col("precision"), F.col("threshold")).alias("a"), best(F.lit(True), F.col("tpr") - F.col("fpr"), F.col("precision"), F.col("threshold")).alias("b"))
    return one.select(F.coalesce("a", "b").alias("r")).select("r.*")


def best_thresholds(df: DataFrame, label: str, score: str, truth: str, grid: list[float], default: float, support: int = 1) -> DataFrame:
    """(label, threshold, f1): the grid's threshold with the best F1 per label, kept at `default` unless strictly better and supported."""
    t = df.select(label, score, truth, F.explode(F.array(*[F.lit(g) for g in sorted({*grid, default})])).alias("thr"))
    per = precision_recall(t, F.col(truth), F.col(score) >= F.col("thr"), [label, "thr"])
    d = per.groupBy(label).agg(F.max(F.when(F.col("thr") == default, F.col("f1"))).alias("f0"), F.max_by(F.struct("thr", "f1"), F.struct("f1", -F.col("thr"))).alias("b"), F.max(F.col("tp") + F.col("fn")).alias("support"))
    better = (F.col("b.f1") > F.col("f0")) & (F.col("support") >= support)
    return d.select(label, F.when(better, F.col("b.thr")).otherwise(default).alias("threshold"), F.when(better, F.col("b.f1")).otherwise(F.col("f0")).alias("f1"))


def repeated_texts(df: DataFrame, doc: str, page: str, text: str, ratio: float, most_per_page: int = 2) -> DataFrame:
    """(doc, text, pages): texts on at least `ratio` of a document's pages and no more than `most_per_page` times on one."""
    pages = df.groupBy(doc).agg(F.countDistinct(page).alias("all_pages"))
    per = df.groupBy(doc, text, page).agg(F.count("*").alias("n")).groupBy(doc, text).agg(F.count("*").alias("pages"), F.max("n").alias("most"))
    return per.join(pages, doc).where((F.col("pages") >= ratio * F.col("all_pages")) & (F.col("most") <= most_per_page)).select(doc, text, "pages")


def weighted_mode(df: DataFrame, group: list[str], value: str, weight: Column) -> DataFrame:
    """(group, mode, share): the value of the largest weight (ties: the smallest value) and its share of all weight."""
    per = df.groupBy(*group, value).agg(F.sum(weight).alias("w"))
    top = per.groupBy(*group).agg(F.max("w").alias("_w"), F.sum("w").alias("_all"))
    return per.join(top, group).where("w = _w").groupBy(*group).agg(F.min(value).alias("mode"), (F.max("_w") / F.max("_all")).alias("share"))


def dispersion(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """(group, cv): population standard deviation over the mean; 0 where the mean is 0."""
    return df.groupBy(*group).agg(F.when(F.avg(value) == 0, 0.0).otherwise(F.stddev_pop(value) / F.avg(value)).alias("cv"), F.count(value).alias("n"))


def capped_score(penalties: list[tuple[Column, float, float]], start: float = 100.0) -> Column:
    """start minus the sum of count * weight, each capped; never below 0."""
    total = F.lit(0.0)
    for n, weight, cap in penalties:
        total = total + F.least(n * weight, F.lit(cap))
    return F.greatest(F.lit(0.0), F.lit(start) - total)


def rounded(c: Column, digits: int = 4) -> Column:
    """Half away from zero on both sides."""
    return F.signum(c) * F.round(F.abs(c), digits)


def guard_status(baseline: DataFrame, current: DataFrame, key: str, axes: list[str], slack: float = 0.02, floors: dict[str, float] | None = None) -> DataFrame:
    """(key, status): invalid, new, new_below_floor, vanished, regressed, crossed_floor or ok.

    Axes are compared at 4 digits; a null axis on either side is skipped; NaN
    and infinities make a row invalid.
    """
    floors = floors or {}
    b = baseline.select(key, *[rounded(F.col(a)).alias(f"b_{a}") for a in axes], F.lit(1).alias("_b"))
    c = current.select(key, *[F.col(a).alias(f"r_{a}") for a in axes], *[rounded(F.col(a)).alias(f"c_{a}") for a in axes], F.lit(1).alias("_c"))
    any_ = lambda xs: F.coalesce(F.array_max(F.array(*xs)), F.lit(False)) if xs else F.lit(False)
    bad = any_([F.coalesce(F.isnan(f"r_{a}") | (F.abs(f"r_{a}") == float("inf")), F.lit(False)) for a in axes])
    low = any_([F.coalesce(F.col(f"c_{a}") < f, F.lit(False)) for a, f in floors.items()])
    worse = any_([F.coalesce(rounded(F.col(f"b_{a}") - F.col(f"c_{a}")) > slack, F.lit(False)) for a in axes])
    crossed = any_([F.coalesce((F.col(f"b_{a}") >= f) & (F.col(f"c_{a}") < f), F.lit(False)) for a, f in floors.items()])
    status = (
        F.when(F.col("_c").isNull(), "vanished").when(bad, "invalid").when(F.col("_b").isNull() & low, "new_below_floor").when(F.col("_b").isNull(), "new")
        .when(worse, "regressed").when(crossed, "crossed_floor").otherwise("ok")
    )
    return b.join(c, key, "full").select(key, status.alias("status"))
