"""Session, table access and the few helpers that every operator shares."""

from __future__ import annotations

import os
import tempfile
import zipfile
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only if its measured size stays below this.
BROADCAST_BYTES = 32 << 20


def local_session(cores: int | str = "*", memory: str = "8g", **conf: str) -> SparkSession:
    """A session for tests and benches; on a cluster the caller brings its own."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quillspark")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Give the Python workers of this session the package, once."""
    sc = spark.sparkContext
    if getattr(sc, "_quillspark_shipped", False):
        return
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(batch) == "10000":  # the default is too many whole documents at once
        spark.conf.set(batch, "2000")
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="quillspark-"), "quillspark.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join("quillspark", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._quillspark_shipped = True


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{base}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of `df` in the shared folder named by spark.checkpoint.dir.

    The session's own setting is used; where it is unset a temporary folder is
    taken if all runs in one process, and it is an error on a cluster, whose
    executors would not see each other's folders.
    """
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(folder or tempfile.mkdtemp(prefix="quillspark-"))
    return df.checkpoint(eager=True)


def measured_bytes(df: DataFrame) -> int:
    """Bytes that the rows of `df` need, measured over all rows (strings by length, the rest by width)."""
    width = F.lit(16)
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind == "string":
            size = F.octet_length(c) + 16
        elif kind == "array<string>":
            size = F.aggregate(c, F.lit(16), lambda n, x: n + 16 + F.coalesce(F.octet_length(x), F.lit(0)))
        else:
            size = F.size(c) * 16 + 16 if kind.startswith("array") else F.lit(16)
        width = width + F.coalesce(size, F.lit(16))
    return df.agg(F.sum(width.cast("long"))).first()[0] or 0


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """`df` with a broadcast hint if its measured size allows, and whether it does.

    `df` should be checkpointed or cheap, since it is measured by an action.
    """
    small = measured_bytes(df) <= limit
    return (F.broadcast(df) if small else df), small


def spread(df: DataFrame) -> DataFrame:
    """`df` over at least as many partitions as there are cores, for much work a row on few files.

    A table of many files or row groups is left as it is, so a large scan is never shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < cores else df


def salted_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "left", salts: int = 32) -> DataFrame:
    """An equi join that spreads every key of `big` over `salts` partitions; `small` is repeated per salt."""
    spread = big.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in big.columns]), F.lit(salts)).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(copies, [*on, "_salt"], how).drop("_salt")


#: Rows of one key from which a join takes the key apart from the others.
HEAVY_ROWS = 200_000


def lookup_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "left", limit: int = BROADCAST_BYTES, heavy: int = HEAVY_ROWS) -> DataFrame:
    """`big` joined with a side of distinct keys, without a hot task.

    The side is broadcast if its measured size allows.  Else keys with more than
    `heavy` rows in `big` (at most all rows / heavy of them) are joined apart,
    by broadcast or with salts, and only the rest is shuffled by key.
    Both sides should be checkpointed or cheap.
    """
    side, is_small = broadcast_if_small(small, limit)
    if is_small:
        return big.join(side, on, how)
    hot = checkpointed(big.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > heavy).select(*on).dropna())
    if hot.isEmpty():
        return big.join(small, on, how)
    keys, _ = broadcast_if_small(hot, limit)
    few, is_small = broadcast_if_small(checkpointed(small.join(keys, on, "left_semi")), limit)
    of_hot = big.join(keys, on, "left_semi")
    return (of_hot.join(few, on, how) if is_small else salted_join(of_hot, few, on, how)).unionByName(big.join(keys, on, "left_anti").join(small, on, how))


def against(df: DataFrame, stated: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """All rows of `df` with all of a stated set, in blocks of the set that stay below the broadcast limit."""
    blocks = max(1, -(-measured_bytes(stated) // limit))
    if blocks == 1:
        return df.crossJoin(F.broadcast(stated))
    cols = [F.col(f"`{c}`") for c in stated.columns]
    stated = checkpointed(stated.withColumn("_block", F.pmod(F.xxhash64(*cols), F.lit(blocks))))
    return reduce(DataFrame.unionByName, [df.crossJoin(F.broadcast(stated.where(F.col("_block") == i).drop("_block"))) for i in range(blocks)])


def read_size(path: str) -> int:
    """Bytes under a local path; 0 if it isn't local."""
    if os.path.isfile(path):
        return os.path.getsize(path)
    return sum(os.path.getsize(os.path.join(r, f)) for r, _, fs in os.walk(path) for f in fs)
