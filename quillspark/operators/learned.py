"""A learned head for routing: section densities as features, one boosted-tree model per group, a threshold per group."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.operators.routing import AXES, DESIGN_WEIGHTS, GROUPS

SECTIONS = tuple(DESIGN_WEIGHTS)
FEATURES = tuple([f"{s}_{a}" for s in SECTIONS for a in AXES] + [f"{s}_mass" for s in SECTIONS] + ["log_units"])


def routing_features(tagged: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, *FEATURES): density of each axis and share of units per section type, and the log of the number of units; absent sections are 0."""
    in_ = lambda s: F.col("section") == s
    n = F.count("*")
    cols = [F.coalesce(F.avg(F.when(in_(s), F.col(a).cast("int"))), F.lit(0.0)).alias(f"{s}_{a}") for s in SECTIONS for a in AXES]
    cols += [(F.count_if(in_(s)) / n).alias(f"{s}_mass") for s in SECTIONS]
    return tagged.groupBy(key).agg(*cols, F.log1p(n).alias("log_units"))


def train_heads(features: DataFrame, labels: DataFrame, key: str = "doc_id", iterations: int = 20, depth: int = 3) -> dict[str, PipelineModel]:
    """labels: (key, groups array).  A model per group that has both kinds of documents."""
    x = features.join(labels, key)
    vector = VectorAssembler(inputCols=list(FEATURES), outputCol="_x")
    out = {}
    for g in GROUPS:
        y = x.withColumn("_y", F.array_contains("groups", g).cast("double"))
        if y.select("_y").distinct().count() == 2:
            model = GBTClassifier(featuresCol="_x", labelCol="_y", maxIter=iterations, maxDepth=depth, seed=1).fit(vector.transform(y))
            out[g] = PipelineModel([vector, model])
    return out


def predicted_groups(features: DataFrame, heads: dict[str, PipelineModel], thresholds: dict[str, float], key: str = "doc_id") -> DataFrame:
    """(key, group, probability) of the groups at or above their threshold."""
    out = None
    for g, model in heads.items():
        p = model.transform(features).select(key, F.lit(g).alias("group"), vector_to_array("probability")[1].alias("probability"))
        out = p if out is None else out.unionByName(p)
    if out is None:
        return features.select(key, F.lit("").alias("group"), F.lit(0.0).alias("probability")).limit(0)
    floor = F.create_map(*[F.lit(v) for kv in thresholds.items() for v in kv])[F.col("group")]
    return out.where(F.col("probability") >= F.coalesce(floor, F.lit(0.5)))
