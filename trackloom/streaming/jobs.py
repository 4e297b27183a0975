"""Mirroring a response log and crash-resumable annotation."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from trackloom.operators.resume import pending_prompts
from trackloom.session import ship_package
from trackloom.sinks.log import read_log, write_batch
from trackloom.sources.catalog import Catalog
from trackloom.sources.files import read_file
from trackloom.sources.scan import changed_files


def _start(writer, every: str | None) -> StreamingQuery:
    """Drain what is there when ``every`` is None, else run on a schedule."""
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return writer.trigger(**trigger).start()


def mirror(
    spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str,
    every: str | None = "30 seconds", format: str = "parquet", **options: str,
) -> StreamingQuery:
    """Copy new files of an append-only folder to a Parquet target.

    Each file is taken once, and the file sink's log keeps replays out. A
    stream ignores a file that is rewritten in place: for folders of rewritten
    records use ``changed_files`` on two scans.
    """
    stream = spark.readStream.format(format).schema(schema).options(**options).load(source)
    return _start(
        stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint), every
    )


def refresh(spark: SparkSession, source: str, target: str, glob: str = "*.caption.json") -> int:
    """Take over the files of a folder that are new or were rewritten since the last refresh; returns how many.

    The listing is compared by path and time with what the target has, so only
    changed files are opened, by the workers. Each refresh adds a folder, and
    ``read_refreshed`` gives the newest text of each path.
    """
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
        .load(source).select("path", "modificationTime")
    )

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # one file at a time
                row = batch.slice(i, 1)
                text = read_file(row.column("path")[0].as_py()).decode(errors="replace")
                yield row.append_column("value", pa.array([text]))

    ship_package(spark)
    out = f"{target}/refresh={uuid.uuid4().hex}"
    changed_files(listed, _refreshed(spark, target)).select("path", "modificationTime").mapInArrow(
        texts, "path string, modificationTime timestamp, value string"
    ).write.parquet(out)
    return spark.read.schema("path string").parquet(out).count()


def _refreshed(spark: SparkSession, target: str) -> DataFrame:
    schema = "path string, modificationTime timestamp, value string, refresh string"
    try:
        return spark.read.schema(schema).parquet(target)
    except Exception as exc:
        if "PATH_NOT_FOUND" in str(exc):
            return spark.createDataFrame([], schema)
        raise


def read_refreshed(spark: SparkSession, target: str) -> DataFrame:
    """path, modificationTime and text (``value``) of the newest state of each file."""
    newest = _refreshed(spark, target).groupBy("path").agg(F.max(F.struct("modificationTime", "value")).alias("n"))
    return newest.select("path", "n.*")


def resume_annotation(
    spark: SparkSession, tracks: DataFrame, catalog: Catalog, log_path: str, run_id: str, checkpoint: str,
    annotate: Callable[[DataFrame], DataFrame], every: str | None = None, overwrite: bool = False,
) -> StreamingQuery:
    """Annotate a stream of tracks, losing at most the batch in flight.

    ``tracks`` is a streaming DataFrame with ``track_id``; bound its batches
    with ``maxFilesPerTrigger``. ``annotate`` maps rows with a ``prompts``
    array to result rows. Per batch: drop pairs that the log has as ok, run
    the rest, and write the batch's own folder, which carries the id that the
    stream has from its checkpoint. A replayed batch looks at the log without
    its own folder and replaces it, so it gives the same rows; a stream with
    another checkpoint never touches it.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not stream:
            raise RuntimeError("a batch needs the id of its stream")
        others = read_log(spark, log_path).where(
            ~((F.col("run_id") == run_id) & (F.col("batch_id") == batch_id) & (F.col("attempt") == stream))
        ).select("track_id", "category", "status", "updated_at", "run_id", "batch_id")
        # only the batch's tracks matter: the log is cut to them before it is aggregated
        arrived = batch.select("track_id").distinct()
        others = others.join(arrived, "track_id", "left_semi")
        todo = pending_prompts(batch, others, catalog, overwrite, ("updated_at", "batch_id"))
        results = annotate(todo).withColumn("updated_at", F.current_timestamp())
        write_batch(results, log_path, run_id, batch_id, stream)

    return _start(tracks.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint), every)
