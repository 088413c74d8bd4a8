"""Queries of the training-text operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.leakage import find_leaks
from quillspark.llm.markup import clean_texts, find_residue
from quillspark.llm.name_variants import variant_links, variant_pairs
from quillspark.llm.packing import CAPACITY, pack_documents, token_sizes
from quillspark.llm.quality import document_kinds, document_stats
from quillspark.llm.shared_runs import shared_runs
from quillspark.llm.splitting import LIMIT, split_entries
from quillspark.operators.packed_fields import AUTHORS, split_packed
from quillspark.session import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Entries that the splitter had to divide."""
    pieces = split_entries(table(spark, d, "chunk_entries"), table(spark, d, "documents"), only_cut=True)
    return pieces.where("piece = 0 and n_pieces > 1").select("doc_id", "chunk_index").distinct()


def p2_pieces(spark: SparkSession, d: str) -> DataFrame:
    """All pieces of all entries, with their texts."""
    return split_entries(table(spark, d, "chunk_entries"), table(spark, d, "documents"))


def _authors(spark: SparkSession, d: str) -> DataFrame:
    return split_packed(table(spark, d, "papers"), "scrape_id", [AUTHORS]).select("value")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return variant_pairs(_authors(spark, d))


def p3_entities(spark: SparkSession, d: str) -> DataFrame:
    """Each spelling with its entity and the number of its other spellings."""
    return variant_links(_authors(spark, d))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return find_residue(table(spark, d, "standard_sections"), "id", "cleaned_text")


def p5_texts(spark: SparkSession, d: str) -> DataFrame:
    """Clean text of every section, converted from its source."""
    return clean_texts(table(spark, d, "standard_sections"), "id", "raw_latex", "cleaned_text").select("id", "clean_text")


def p5_shared(spark: SparkSession, d: str) -> DataFrame:
    """How much of every cleaned section stands in runs that other sections of its draft have too."""
    runs = shared_runs(table(spark, d, "standard_sections"), "draft_tag", "id", "cleaned_text")
    size = F.col("end_char") - F.col("start_char")
    return runs.groupBy(F.col("host").alias("draft_tag"), F.col("page").alias("id")).agg(F.sum(F.when(F.col("shared"), size).otherwise(0)).alias("shared_chars"), F.sum(size).alias("chars"))


def p7_packed(spark: SparkSession, d: str) -> DataFrame:
    """The container of every document."""
    return pack_documents(token_sizes(table(spark, d, "documents"), "doc_id", "text"), "doc_id")


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    """Containers by how full they are, in steps of an eighth."""
    used = p7_packed(spark, d).groupBy("container").agg(F.sum("tokens").alias("used"))
    return used.groupBy(F.floor(F.col("used") * 8 / CAPACITY).cast("int").alias("eighths")).agg(F.count("*").alias("containers"), F.sum("used").alias("tokens"))


#: Word edits within a window of ten that the search for passages allows.
EDITS = 1


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return find_leaks(table(spark, d, "documents"), table(spark, d, "benchmark"), edits=EDITS)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents and the items that leaked into them, of the passages found those that stand there word for word."""
    return _leaks(spark, d).where(F.col("matched_words") * 3 >= F.col("item_words")).select("doc_id", "item_id")


def p8_near(spark: SparkSession, d: str) -> DataFrame:
    """Leaked passages with those in which a word was changed, put in or left out, and how much of the item they cover."""
    return _leaks(spark, d)


def p8_items(spark: SparkSession, d: str) -> DataFrame:
    """How many documents each item leaked into, word for word or nearly, and how much of it at most."""
    exact = F.when(F.col("matched_words") * 3 >= F.col("item_words"), F.col("doc_id"))
    return _leaks(spark, d).groupBy("item_id").agg(F.countDistinct(exact).alias("documents"), F.countDistinct("doc_id").alias("near_documents"), F.max(F.col("near_words") / F.col("item_words")).alias("most"))


def _common_words(spark: SparkSession, d: str) -> list[str]:
    """The frequent words, a fixed table of a few hundred rows."""
    return [r.word for r in table(spark, d, "common_words").where("word is not null").select("word").distinct().collect()]


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return document_kinds(table(spark, d, "documents"), _common_words(spark, d)).where("kind <> 'prose'").select("doc_id", "kind")


def p9_stats(spark: SparkSession, d: str) -> DataFrame:
    """Text statistics of every document."""
    return document_stats(table(spark, d, "documents"), _common_words(spark, d))


QUERIES = {f.__name__: f for f in (p2_found, p2_pieces, p3_found, p3_entities, p5_found, p5_texts, p5_shared, p7_packed, p7_fill, p8_found, p8_near, p8_items, p9_found, p9_stats)}

ORACLES = {
    "p2_found": f"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)
SELECT DISTINCT e.doc_id, e.chunk_index FROM chunk_entries e JOIN d USING (doc_id)
WHERE list_sum(list_transform(d.l[greatest(e.start_line, 1):least(e.end_line, len(d.l))], lambda x: length(x) + 1)) > {LIMIT}""",
}
