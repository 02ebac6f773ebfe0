"""Documents to training sequences: language, near copies, repeats, secrets, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from weekgrid.llm import jaccard, language, packing, secret_scan, substrings
from weekgrid.llm.common import stored

ORACLE_SQL = None  # rank-order profiles, set joins and token ids are not SQL; tests compare with brute force


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go."""
    return language.spoken(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each linked group one row stays, that with the smallest id, then text (null
    ids last). A row is a document of its own, whatever its id: rows that share one
    but do not link all stay. ``docs`` is a Parquet table, so a row's number is the
    same in every scan."""
    counts = docs.groupBy(F.col("doc_id").alias("of")).agg(F.count(F.lit(1)).alias("n")).where("n > 1 AND of IS NOT NULL")
    clashing = stored(counts.select("of"), "clashing")  # its size is known, so joins with few ids do not shuffle texts
    numbered = docs.select(
        F.monotonically_increasing_id().alias("number"), F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64("text").alias("hash"), "text"
    ).join(clashing, F.col("doc_id") == F.col("of"), "left")
    # A row is known by its id where that is its own, else by a number below zero.
    own = F.when(F.col("of").isNull() & (F.col("doc_id") >= 0), F.col("doc_id").cast("long")).otherwise(-1 - F.col("number"))
    numbered = numbered.withColumn("row", own).drop("of", "number")
    groups = jaccard.jaccard_join(numbered.select("row", "text"), id_col="row")
    linked = groups.select(F.col("doc_id").alias("row"), F.col("component_id").alias("group"))
    shared = linked.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("group")
    members = linked.join(shared, "group").join(numbered.drop("text"), "row")
    order = F.struct("none", "doc_id", "hash", "row")
    first = members.groupBy("group").agg(F.min(order).alias("kept")).select("kept.row", F.lit(True).alias("kept"))
    copies = members.select("row").join(first, "row", "left").where(F.col("kept").isNull()).select("row")
    whole = docs.select(
        F.monotonically_increasing_id().alias("number"), F.col("doc_id").alias("id"), F.struct(*[F.col(c) for c in docs.columns]).alias("whole")
    ).join(clashing, F.col("id") == F.col("of"), "left")
    whole = whole.select(F.when(F.col("of").isNull() & (F.col("id") >= 0), F.col("id").cast("long")).otherwise(-1 - F.col("number")).alias("row"), "whole")
    return whole.join(copies.hint("shuffle_hash"), "row", "left_anti").select("whole.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated passages go from all but their first place."""
    found = substrings.without_repeats(docs)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return found.select(*[new.get(c, F.col(f"row.{c}")).alias(c) for c in docs.columns])


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Credentials that few owners have are replaced by a mark; n_chars follows."""
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("jaccard_join", jaccard_join),
    ("substring_dedup", substring_dedup),
    ("secret_scan", secrets),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
