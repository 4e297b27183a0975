"""Audio file scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trackloom.functions import paths
from trackloom.model import AUDIO_SUFFIXES


def suffix_glob(suffixes: list[str]) -> str:
    """A file glob for the suffixes in any case."""
    either = ["".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in s) for s in suffixes]
    return "*." + ("{" + ",".join(either) + "}" if len(either) > 1 else either[0])


def scan_audio(
    spark: SparkSession,
    directory: str,
    suffixes: list[str] | None = None,
    recursive: bool = True,
    with_content: bool = False,
) -> DataFrame:
    """One row per audio file below ``directory``: path, file, length, modificationTime.

    ``content`` is left out unless asked for, so a listing reads no file bodies;
    jobs open the files they need by path. The suffixes prune the listing, so
    other files are not even looked at, whatever their size. Spark's file
    sources skip names that start with ``.`` or ``_``.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", str(recursive).lower())
        .option("pathGlobFilter", suffix_glob(suffixes or AUDIO_SUFFIXES["keyed"]))
        .load(directory)
    )
    wanted = ["path", "length", "modificationTime"] + (["content"] if with_content else [])
    return (
        files.select(*wanted)
        .where(paths.has_suffix("path", suffixes or AUDIO_SUFFIXES["keyed"]))
        .withColumn("file", paths.file_name("path"))
    )


SCAN_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def stream_audio(
    spark: SparkSession, directory: str, suffixes: list[str] | None = None, max_files: int = 1000,
    with_content: bool = True,
) -> DataFrame:
    """New audio files as a stream, at most ``max_files`` per micro-batch."""
    files = (
        spark.readStream.format("binaryFile").schema(SCAN_SCHEMA)
        .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files)
        .option("pathGlobFilter", suffix_glob(suffixes or AUDIO_SUFFIXES["keyed"]))
        .load(directory)
    )
    wanted = ["path", "length", "modificationTime"] + (["content"] if with_content else [])
    return (
        files.select(*wanted)
        .where(paths.has_suffix("path", suffixes or AUDIO_SUFFIXES["keyed"]))
        .withColumn("file", paths.file_name("path"))
    )


def changed_files(scan: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Files that are new or rewritten since the snapshot, by (path, modificationTime)."""
    seen = snapshot.select("path", "modificationTime")
    return scan.join(seen, ["path", "modificationTime"], "left_anti")
