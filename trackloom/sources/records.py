"""Caption-record readers, and the flattening of all record shapes to one long table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from trackloom.functions import paths, scalars
from trackloom.model import CHUNK_RECORD, ERROR, FLAT_RECORD, KEYED_RECORD, OK, ORDERED_RECORD, RESPONSES

CORRUPT = "_corrupt"


def _parsed(spark: SparkSession, path: str, schema: T.StructType, pretty: bool) -> DataFrame:
    """One row per record document: the parsed record, and its text when it does not parse."""
    options = {"pathGlobFilter": "*.caption.json"} if pretty else {}
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    documents = spark.read.options(**options).text(path, wholetext=pretty)
    record = F.from_json("value", with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return documents.select(record.alias("r")).select("r.*")


def read_records(
    spark: SparkSession, path: str, schema: T.StructType, pretty: bool = True
) -> DataFrame:
    """The ``*.caption.json`` records of a folder; documents that do not parse are skipped.

    ``pretty`` reads one indented document per file. Exports of this package
    are JSON lines, read with ``pretty=False`` so that files split.
    """
    return _parsed(spark, path, schema, pretty).where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def count_corrupt(spark: SparkSession, path: str, schema: T.StructType, pretty: bool = True) -> DataFrame:
    """One row: records read, and how many of them do not parse or lack their body."""
    bad = F.col(CORRUPT).isNotNull()
    if "categories" in schema.names:
        bad = bad | F.col("categories").isNull()
    return _parsed(spark, path, schema, pretty).agg(
        F.count("*").alias("records"), F.count_if(bad).alias("corrupt")
    )


def read_done_files(spark: SparkSession, path: str, pretty: bool = True) -> DataFrame:
    """Distinct (file, path) values of any ``.json`` below a folder; documents with neither are skipped."""
    found = (
        spark.read.schema("file string, path string")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.json")
        .option("multiLine", str(pretty).lower())
        .json(path)
    )
    return found.where(F.col("file").isNotNull() | F.col("path").isNotNull()).distinct()


def _conform(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return rows.select(*[
        columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RESPONSES.fields
    ])


def flatten_keyed(records: DataFrame) -> DataFrame:
    """Records with a ``categories`` map. A null or absent map yields no rows."""
    rows = records.select("file", "path", "model_id", "last_updated", F.explode("categories"))
    v = F.col("value")
    return _conform(rows, {
        "track_id": F.coalesce("path", "file"), "file": F.col("file"), "path": F.col("path"),
        "model_id": F.col("model_id"), "category": F.col("key"), "updated_at": F.col("last_updated"),
        **{n: v[n] for n in (
            "status", "output", "error", "processing_time_sec", "audio_windows",
            "audio_covered_sec", "output_truncated", "prompt_used",
        )},
    })


def flatten_ordered(records: DataFrame) -> DataFrame:
    """Records with a ``responses`` array in prompt order."""
    rows = records.select("file", "model_id", F.explode("responses").alias("r"))
    r = F.col("r")
    return _conform(rows, {
        "track_id": F.col("file"), "file": F.col("file"), "model_id": F.col("model_id"),
        "prompt_ord": r["prompt_index"], "prompt_used": r["prompt"], "output": r["raw_output"],
        "status": r["status"], "error": r["error"], "processing_time_sec": r["processing_time_sec"],
    })


def flatten_flat(records: DataFrame) -> DataFrame:
    """Records with one answer each."""
    return _conform(records, {
        "track_id": F.col("file"), "output": F.col("raw_output"), "category": F.col("prompt_mode"),
        "prompt_ord": F.lit(0),
        **{n: F.col(n) for n in ("file", "model_id", "prompt_used", "status", "error", "processing_time_sec")},
    })


def flatten_chunks(records: DataFrame) -> DataFrame:
    """Records with time windows. In-band error answers become status and error columns."""
    chunk = records.select("metadata", F.explode("chunks").alias("c"))
    rows = chunk.select("metadata", "c.chunk_index", F.explode("c.captions"))
    reason = scalars.error_text("value")
    path = F.col("metadata.audio_file")
    return _conform(rows, {
        "track_id": path, "path": path, "file": paths.file_name(path), "model_id": F.col("metadata.model"),
        "chunk_index": F.col("chunk_index"), "category": F.col("key"),
        "status": F.when(reason.isNull(), OK).otherwise(ERROR),
        "output": F.when(reason.isNull(), F.col("value")), "error": reason,
        "updated_at": F.col("metadata.generated_at"),
    })


FLATTENERS = {
    "keyed": (KEYED_RECORD, flatten_keyed),
    "ordered": (ORDERED_RECORD, flatten_ordered),
    "flat": (FLAT_RECORD, flatten_flat),
    "chunks": (CHUNK_RECORD, flatten_chunks),
}


def read_responses(spark: SparkSession, path: str, shape: str, pretty: bool = True) -> DataFrame:
    """Records of one shape as the long response table."""
    schema, flatten = FLATTENERS[shape]
    return flatten(read_records(spark, path, schema, pretty))


def union_responses(*tables: DataFrame) -> DataFrame:
    """All batches together, whatever columns each of them has."""
    merged = tables[0]
    for table in tables[1:]:
        merged = merged.unionByName(table, allowMissingColumns=True)
    return merged
