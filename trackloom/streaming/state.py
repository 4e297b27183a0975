"""Annotation of a stream with its progress as keyed state.

What is done of a track is state of the stream, kept by Spark beside the checkpoint and partitioned by track. A batch looks
up the state of the tracks that arrive and reads no log; the log is read once, before the first batch of a new checkpoint,
to start the state from what earlier runs did.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from trackloom.model import ERROR, FATAL_ERROR_PATTERN, LOG, MESSAGES, OK, RESULT
from trackloom.operators import annotate as an
from trackloom.operators.resume import ok_categories
from trackloom.session import ship_package
from trackloom.sinks.log import STATE_ORDER, read_state, write_batch
from trackloom.sources.catalog import Catalog
from trackloom.sources.files import child_names, read_file

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ANSWERED = T.StructType([
    T.StructField("track_id", T.StringType()), T.StructField("category", T.StringType()),
    T.StructField("prompt_used", T.StringType()), *RESULT.fields,
])


class Progress(StatefulProcessor):
    """The categories of a track that are done, and the annotator for those that are not.

    A track that arrives twice in a batch is annotated once. A failed category is left out of the state, so that it is tried
    again when its track arrives again. After an error that matches ``fatal`` the worker's remaining prompts are skipped.

    A track's state is one value: each call of the state store crosses to the JVM, so a track reads it once and writes it once
    at most, however many prompts there are.
    """

    def __init__(self, prompts: list[tuple[str, str]], make_annotator: Callable[[], Any] | None, content: str | None, fatal: str | None):
        self.prompts, self.make_annotator, self.content, self.fatal = prompts, make_annotator, content, fatal

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.done = handle.getValueState("done", "categories array<string>")
        self.annotator = self.make_annotator() if self.make_annotator else None
        self.stopped = False

    def handleInitialState(self, key: Any, initialState: Row, timerValues: Any) -> None:
        if initialState["ok_categories"]:
            self.done.update((list(initialState["ok_categories"]),))

    def _answer(self, prepared: Any, broken: dict | None, category: str, prompt: str) -> dict:
        if self.stopped:
            return {"status": ERROR, "error": MESSAGES["skipped"]}
        if self.annotator is None:
            return an.dry_result(category)
        result = broken or an.answer(self.annotator, prepared, prompt)
        self.stopped = bool(self.fatal and result.get("error") and re.search(self.fatal, result["error"]))
        return result

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        first = next(rows)
        for _ in rows:  # repeats of the track
            pass
        known = self.done.get()
        done = set(known[0]) if known else set()
        before = len(done)
        todo = [(c, p) for c, p in self.prompts if c not in done]
        prepared = broken = None
        if todo and self.annotator is not None and not self.stopped:
            try:
                prepared = self.annotator.prepare(read_file(first[self.content]))
            except Exception as exc:
                broken = an.failure(exc)
        for category, prompt in todo:
            result = self._answer(prepared, broken, category, prompt)
            if result["status"] == OK:
                done.add(category)
            told = {"track_id": key[0], "category": category, "prompt_used": prompt, **result}
            yield Row(**{f: told.get(f) for f in ANSWERED.names})
        if len(done) > before:
            self.done.update((sorted(done),))

    def close(self) -> None:
        pass


def _others(spark: SparkSession, log_path: str, checkpoint: str) -> DataFrame:
    """The log's state that a stream starts from: nothing once its first batch is done, and never rows of its own.

    A first batch that died after it wrote its folder is done again; from its own rows it would take itself as done.
    """
    if "0" in child_names(f"{checkpoint}/commits"):
        return spark.createDataFrame([], LOG)
    rows = read_state(spark, log_path)
    if "metadata" in child_names(checkpoint):
        rows = rows.where(F.col("attempt") != json.loads(read_file(f"{checkpoint}/metadata"))["id"])
    return rows


def annotate_stream(
    spark: SparkSession, tracks: DataFrame, catalog: Catalog, log_path: str, run_id: str, checkpoint: str,
    make_annotator: Callable[[], an.Annotator] | None = None, content: str = "uri", every: str | None = None,
) -> StreamingQuery:
    """Annotate a stream of tracks, losing at most the batch in flight; no batch reads the log.

    ``tracks`` is a streaming DataFrame with ``track_id`` and, for an annotator,
    the path of its file in ``content``; bound its batches with
    ``maxFilesPerTrigger``. Each batch is a folder of the log that carries the
    stream's id: state and folder belong to the same batch, so a replay starts
    from the state before it and replaces the folder. A stream with a fresh
    checkpoint takes up the log's newest state; while it runs, it is the one
    that knows what is done, and other writers of the same tracks are not seen.
    """
    ship_package(spark)
    known = ok_categories(_others(spark, log_path, checkpoint), catalog, STATE_ORDER)
    processor = Progress(list(catalog.entries), make_annotator, content if make_annotator else None, FATAL_ERROR_PATTERN)
    wanted = tracks.select("track_id", *([content] if make_annotator else []))
    answers = wanted.groupBy("track_id").transformWithState(
        statefulProcessor=processor, outputStructType=ANSWERED, outputMode="Append", timeMode="None", initialState=known.groupBy("track_id")
    )

    def keep(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not stream:
            raise RuntimeError("a batch needs the id of its stream")
        write_batch(batch.withColumn("updated_at", F.current_timestamp()), log_path, run_id, batch_id, stream)

    writer = answers.writeStream.foreachBatch(keep).outputMode("append").option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)  # the store that keeps maps per key; a query takes its own copy when it starts
    try:
        return writer.trigger(**trigger).start()
    finally:
        spark.conf.set(STATE_STORE, before) if before is not None else spark.conf.unset(STATE_STORE)
