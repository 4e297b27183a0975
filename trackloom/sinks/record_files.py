"""One JSON file per track, replaced whole.

A custom batch sink: tasks write the files, each under a name that its row gives. A file is staged and moved over the old
one, so that a task that is killed, retried or run twice leaves whole files only, the last of which counts. Commit and
abort drop what was staged and not moved.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from trackloom.functions import paths
from trackloom.model import RECORD_SUFFIX
from trackloom.session import ship_package
from trackloom.sources.files import check_openable, drop_folder, replace_file

#: Bytes of a stem that a file name keeps; with the suffix and a mark it stays below what file systems allow.
STEM_BYTES = 180


@dataclass
class Written(WriterCommitMessage):
    files: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")
        self.staging = f"{self.folder}/_staging-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files = 0
        for batch in iterator:
            for name, value in zip(batch.column(0), batch.column(1), strict=True):
                replace_file(f"{self.folder}/{name.as_py()}", value.as_py().encode(), self.staging)
                files += 1
        return Written(files)

    def commit(self, messages: list) -> None:
        drop_folder(self.staging)

    def abort(self, messages: list) -> None:
        drop_folder(self.staging)


class RecordFiles(DataSource):
    """``df.write.format("track_records").mode("append").option("folder", …)`` for (name, value) rows."""

    @classmethod
    def name(cls) -> str:
        return "track_records"

    def schema(self) -> str:
        return "name string, value string"

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        return _Writer(self.options["folder"])


def with_record_names(tracks: DataFrame, path: str = "path", key: tuple[str, ...] = ("path",), name: str = "record") -> DataFrame:
    """The file name of each track's record: ``<stem>.caption.json``.

    Tracks that share a stem, as in two albums or under two suffixes, each get a mark made of their ``key`` after it, and
    so does a stem that is too long for a file name. The stems are counted before the join; one that a third of all tracks
    have is a skewed join side, which Spark splits.
    """
    stem = F.coalesce(paths.stem(path), F.lit(""))
    counts = tracks.groupBy(stem.alias("_stem")).agg(F.count("*").alias("_same"))
    long = F.octet_length("_stem") > STEM_BYTES
    mark = F.concat(F.lit("~"), F.lower(F.lpad(F.hex(F.xxhash64(*key)), 16, "0")))
    short = F.when(long, F.left("_stem", F.lit(STEM_BYTES // 4))).otherwise(F.col("_stem"))
    # a stem that ends like a mark could be taken for another track's
    marked = (F.col("_same") > 1) | long | (F.col("_stem") == "") | F.col("_stem").rlike("~[0-9a-f]{16}$")
    named = F.concat(short, F.when(marked, mark).otherwise(F.lit("")), F.lit(RECORD_SUFFIX))
    return tracks.withColumn("_stem", stem).join(counts, "_stem").withColumn(name, named).drop("_stem", "_same")


def write_record_files(records: DataFrame, folder: str, name: Column | str = "record") -> None:
    """Every row as one JSON file of the folder, null fields kept. The column that names the file is not part of it."""
    check_openable(folder)
    ship_package(records.sparkSession)
    named = F.col(name) if isinstance(name, str) else name
    body = F.struct(*[c for c in records.columns if c != name])
    rows = records.select(named.alias("name"), F.to_json(body, {"ignoreNullFields": "false", "pretty": "true"}).alias("value"))
    rows.sparkSession.dataSource.register(RecordFiles)
    rows.write.format("track_records").mode("append").option("folder", folder).save()
