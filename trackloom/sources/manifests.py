"""Job manifest readers: one row per track, with its index and the job's globals."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trackloom.model import MANIFEST, TEXT_MAP
from trackloom.sinks.documents import BODY_ROW, FOOTER, HEADER_END
from trackloom.sources.files import locate
from trackloom.sources.split_json import SPLIT_BYTES, Document


def parse_manifest(document: Column) -> Column:
    """struct<globals, tracks>; explicit nulls stay in the maps, so key presence is visible."""
    return F.from_json(document, MANIFEST)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Tracks of hand-sized manifest documents (each one JSON file, read by one task).

    Large ones go through ``read_manifest_entries``, which cuts a document at
    its elements, or have the line-framed form of ``read_manifest_lines``.
    Columns: manifest, track_index, globals, track.
    """
    documents = spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("manifest"), parse_manifest(F.col("value")).alias("doc")
    )
    return documents.select(
        "manifest",
        F.coalesce("doc.globals", F.expr("map()").cast(TEXT_MAP)).alias("globals"),
        F.posexplode_outer("doc.tracks").alias("track_index", "track"),
    )


def is_framed(spark: SparkSession, path: str) -> bool:
    """Whether the manifest is of the form of ``write_manifest``: its header stands on a line of its own."""
    header = F.col("value").startswith(BODY_ROW) & F.col("value").endswith(f'"tracks":{HEADER_END}')
    return bool(spark.read.text(path).where(header).take(1))


def framed_header(spark: SparkSession, path: str) -> str:
    """The header line of a line-framed manifest; a folder with several manifests is an error."""
    headers = spark.read.text(path).where(F.col("value").endswith(f'"tracks":{HEADER_END}')).take(2)
    if len(headers) != 1:
        raise ValueError(f"{path} holds {'several manifests' if headers else 'no manifest'}")
    return headers[0]["value"]


def _as_text(entry: str) -> Column:
    """An element as the JSON reader gives it as text."""
    return F.from_json(F.concat(F.lit('{"t":['), entry, F.lit("]}")), "t array<string>")["t"][0]


def _one_large_file(path: str, most: int) -> str | None:
    """The file of a manifest, if it is a single one and larger than that."""
    store, name = locate(path)
    info = store.get_file_info(name)
    if info.type == fs.FileType.Directory:
        inside = [i for i in store.get_file_info(fs.FileSelector(name)) if not i.base_name.startswith(("_", "."))]
        if len(inside) != 1 or inside[0].type != fs.FileType.File:
            return None
        path, info = f"{path.rstrip('/')}/{inside[0].base_name}", inside[0]
    return path if info.type == fs.FileType.File and info.size > most else None


def read_manifest_entries(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> tuple[DataFrame, str]:
    """The tracks of a manifest of either form, as they stand in it; and the JSON text of its globals.

    A document of more than ``split_bytes`` that is not line-framed is cut at its elements and read by many tasks.

    Columns: place (unique, in the order of the file), path, entry (JSON text).
    A manifest that has no tracks gives no rows.
    """
    if is_framed(spark, path):
        settings = F.get_json_object(F.lit(framed_header(spark, path) + FOOTER), "$.globals")
        globals_text = spark.range(1).select(settings.alias("g")).first()["g"] or "{}"
        lines = spark.read.text(path).select(
            # part files follow each other by name, splits by offset, lines by their number in the task
            F.struct(F.input_file_name().alias("file"), F.input_file_block_start().alias("block"),
                     F.monotonically_increasing_id().alias("line")).alias("place"), "value",
        )
        entries = lines.where(
            F.col("value").startswith(BODY_ROW) & ~F.col("value").endswith(HEADER_END) & (F.col("value") != FOOTER)
        ).select("place", F.rtrim("value", F.lit(",")).alias("entry"))
    elif large := _one_large_file(path, split_bytes):
        document = Document(spark, large, split_bytes)
        globals_text = spark.range(1).select(F.lit(document.text("globals")).alias("g")).select(_as_text("g")).first()[0] or "{}"
        entries = document.elements("tracks").select(
            F.struct(F.lit(large).alias("file"), F.lit(0).cast("bigint").alias("block"), F.col("place").alias("line")).alias("place"),
            _as_text("text").alias("entry"),
        )
    else:
        parsed = spark.read.text(path, wholetext=True).select(
            F.input_file_name().alias("file"), F.from_json("value", "globals string, tracks array<string>").alias("doc")
        )
        found = parsed.select("doc.globals").take(2)
        if len(found) != 1:
            raise ValueError(f"{path} holds {'several manifests' if found else 'no manifest'}")
        globals_text = found[0]["globals"] or "{}"
        entries = parsed.select("file", F.posexplode("doc.tracks").alias("line", "entry")).select(
            F.struct("file", F.lit(0).cast("bigint").alias("block"), F.col("line").cast("bigint").alias("line")).alias("place"), "entry"
        )
    return entries.select("place", F.get_json_object("entry", "$.path").alias("path"), "entry"), globals_text


def read_manifest_lines(spark: SparkSession, path: str) -> DataFrame:
    """Tracks of a manifest written by ``write_manifest``: one track per line.

    The file splits on lines, so any number of tasks share it.
    Columns: track.
    """
    line = F.rtrim(F.col("value"), F.lit(","))
    body = spark.read.text(path).where(
        F.col("value").startswith(BODY_ROW) & ~F.col("value").endswith(HEADER_END)
        & (F.col("value") != FOOTER)
    )
    return body.select(F.from_json(line, TEXT_MAP).alias("track"))


def read_manifest_globals(spark: SparkSession, path: str) -> DataFrame:
    """The globals of a line-framed manifest, as one row."""
    header = spark.read.text(path).where(F.col("value").endswith(HEADER_END))
    return header.select(F.from_json(F.concat("value", F.lit(FOOTER)), MANIFEST)["globals"].alias("globals"))


def track_tags(track: Column) -> Column:
    """The track's ``tags`` when they are an object, else an empty map."""
    empty = F.expr("map()").cast(TEXT_MAP)
    return F.coalesce(F.from_json(F.try_element_at(track, F.lit("tags")), TEXT_MAP), empty)
