"""File sources and sinks: typed listings, whole texts, JSON lines, image manifests, LaTeX trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def suffix_kind(path: Column) -> Column:
    """Kind of a file by its suffix, the longest suffix first."""
    p = F.lower(path)
    return (
        F.when(p.rlike(r"\.[a-z]+\.json$"), "thread").when(p.rlike(r"\.json$"), "record").when(p.rlike(r"\.(debug|trace)\.md$"), "log")
        .when(p.rlike(r"\.md$"), "markdown").when(p.rlike(r"\.pdf$"), "pdf").when(p.rlike(r"\.html?$"), "html").otherwise("other")
    )


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """(path, name, kind, size, modified) of all files but unfinished ones; contents are not read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length", "modificationTime")
    name = F.element_at(F.split("path", "/"), -1)
    return df.select("path", name.alias("name"), suffix_kind(name).alias("kind"), F.col("length").alias("size"), F.col("modificationTime").alias("modified")).where(~F.col("name").endswith(".partial"))


def images(spark: SparkSession, folder: str) -> DataFrame:
    """(paper_id, page, number, path) of figure files named ID-figPAGE-NUMBER.EXT."""
    pattern = r"^(.+)-fig(\d+)-(\d+)\.(png|jpe?g|gif|svg|webp)$"
    part = lambda k: F.regexp_extract("name", pattern, k)
    return listing(spark, folder).where(F.col("name").rlike(pattern)).select(part(1).alias("paper_id"), part(2).cast("int").alias("page"), part(3).cast("int").alias("number"), "path")


def texts(spark: SparkSession, folder: str, glob: str = "*.md") -> DataFrame:
    """(path, text) of whole files."""
    return spark.read.text(folder, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Replace exactly the partitions that `df` has."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


MANIFEST = "struct<version:int,paper_id:string,images:array<struct<name:string,page:int,caption:string>>>"


def manifests(df: DataFrame, text: str, newest: int = 1) -> DataFrame:
    """Parsed image manifests and why one is refused: not JSON, no version, or a version of the future."""
    m = df.withColumn("m", F.from_json(text, MANIFEST))
    bad = F.when(F.col("m").isNull() | F.col("m.paper_id").isNull(), "not a manifest").when(F.col("m.version").isNull(), "no version").when(F.col("m.version") > newest, "version of the future")
    return m.select("m.*", bad.alias("refused"))


def data_uris(df: DataFrame, text: str, key: str) -> DataFrame:
    """(key, pos, mime, bytes) of base64 data URIs."""
    found = F.regexp_extract_all(F.col(text), F.lit(r"data:([\w/+.-]+);base64,([A-Za-z0-9+/=]+)"), F.lit(0))
    x = df.select(key, F.posexplode(found).alias("pos", "u"))
    return x.select(key, "pos", F.regexp_extract("u", r"data:([\w/+.-]+);", 1).alias("mime"), F.try_to_binary(F.regexp_extract("u", r"base64,(.*)$", 1), F.lit("base64")).alias("bytes"))


def latex_tree(spark: SparkSession, folder: str, root: str = "std.tex") -> DataFrame:
    """(file, text, place): files in the order the root includes them, then the rest by name."""
    t = texts(spark, folder, "*.tex").withColumn("file", F.regexp_extract("path", r"([^/]+)\.tex$", 1))
    inc = t.where(F.col("file") == root.removesuffix(".tex")).select(F.posexplode(F.regexp_extract_all("text", F.lit(r"(?m)^[^%\n]*?\\(?:include|input)\{([^}]+?)(?:\.tex)?\}"), F.lit(1))).alias("place", "file"))
    inc = inc.groupBy("file").agg(F.min("place").alias("place"))
    return t.where(F.col("file") != root.removesuffix(".tex")).join(inc, "file", "left").select("file", "text", "place")
