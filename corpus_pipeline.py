"""A training corpus from raw documents: quality rules, near duplicates, repeated passages, personal data, packing.

Every stage works on all documents that the one before kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.abspath(__file__))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from trackloom.llm import jaccard, packing, private, rules, substring  # noqa: E402
from trackloom.llm.queries import byte_bpe  # noqa: E402
from trackloom.session import ship_package, shared_path  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go."""
    ship_package(spark)
    return rules.keep_clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked texts one row stays: the one with the smallest doc_id, rows without one coming last.

    Decided per row, not per doc_id: texts are the nodes, so an id that comes with two texts, or none, takes no other text
    with it. Of rows with that id and text one stays. Texts without a word are linked with nothing, and all their rows stay.
    """
    ship_package(spark)
    node = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = docs.select("doc_id", node.alias("doc_node"), "text")
    groups = jaccard.jaccard_components(rows.select(F.col("doc_node").alias("doc_id"), "text")).where("n_shingles > 0")
    groups = groups.select(F.col("doc_id").alias("doc_node"), F.col("component_id").alias("component")).distinct()
    repeats = rows.groupBy("doc_id", "doc_node").agg(F.count("*").alias("n")).join(groups, "doc_node")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "doc_node")
    first = repeats.groupBy("component").agg(F.min(place).alias("first"))
    repeats = repeats.join(first, "component").withColumn("wins", F.col("first") == place)
    gone = repeats.where(~F.col("wins") | (F.col("n") > 1)).select(F.col("doc_id").alias("its_id"), F.col("doc_node").alias("its_node"), "wins")
    one = docs.withColumn("its_text", node)

    def same(marks: DataFrame):
        return (one["its_text"] == marks["its_node"]) & one["doc_id"].eqNullSafe(marks["its_id"])

    # rows that come more than once and stay: one of each
    often = gone.where("wins")
    several = one.join(often, same(often), "left_semi").drop("its_text").dropDuplicates(["doc_id", "text"])
    return one.join(gone, same(gone), "left_anti").drop("its_text").union(several)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has go out of the texts; every document stays."""
    ship_package(spark)
    return substring.remove_repeats(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the name of its kind."""
    ship_package(spark)
    return private.mask_private(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces of training sequences."""
    ship_package(spark)
    return packing.pack_documents(docs, byte_bpe())


STAGES = [("quality_rules", quality), ("jaccard_join", near_duplicates), ("substring_dedup", passages), ("private_data", personal_data), ("best_fit_packing", sequences)]
#: Loopy inference and packing have no SQL; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of sf_dir, each written and read back as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
