"""Records of every shape written to files, read back and flattened, with their contents compared."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from trackloom.functions import paths
from trackloom.operators import resume, summarize
from trackloom.plans import adapters as a
from trackloom.plans.registry import query
from trackloom.session import shared_path
from trackloom.sinks.log import export_records
from trackloom.sinks.record_files import with_record_names, write_record_files
from trackloom.sources import records

ANSWER = ("status", "output", "error", "traceback", "processing_time_sec", "audio_windows", "audio_covered_sec",
          "output_truncated", "prompt_used")


def _back(spark: SparkSession, documents: DataFrame, shape: str) -> DataFrame:
    path = shared_path(spark, f"records-{shape}")
    export_records(documents, path, "gzip")
    return records.read_responses(spark, path, shape, pretty=False)


@query(f"""WITH {a.LOG}, {a.LATEST}
SELECT track_id, category, status, output, error, processing_time_sec FROM latest""")
def flatten_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest answers as records with a map of categories; a catalogue of two of them hides no other."""
    rows = a.log(spark, sf_dir)
    for name in ANSWER:
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("string"))
    nested = summarize.nest_by_category(rows, a.EVENT_CATALOG.keys[:2], ("track_id",), ANSWER, a.LOG_ORDER)
    documents = nested.select(
        F.col("track_id").alias("file"), F.col("track_id").alias("path"), F.lit("m1").alias("model_id"),
        F.lit("2026-01-01T00:00:00Z").alias("last_updated"), "categories",
    )
    return _back(spark, documents, "keyed").select("track_id", "category", "status", "output", "error", "processing_time_sec")


@query(f"""WITH {a.LOG}, {a.LATEST}
SELECT '/music/' || CAST(track_id AS INT) % 3 || '/' || CAST(track_id AS INT) // 3 || '.mp3' AS path,
  category, status, output, error, processing_time_sec FROM latest""")
def record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest answers as one file per track, written over the records of a first pass; three albums share every file name."""
    folder, user = shared_path(spark, "record-files"), F.col("track_id").cast("int")
    path = F.concat(F.lit("/music/"), user % 3, F.lit("/"), F.floor(user / 3).cast("int"), F.lit(".mp3"))
    rows = a.log(spark, sf_dir).withColumn("path", path)
    for name in ANSWER:
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("string"))
    named = with_record_names(rows.select("path").distinct())
    for so_far in (rows.where("event_id % 2 = 0"), rows):
        nested = summarize.nest_by_category(so_far, a.EVENT_CATALOG.keys, ("path",), ANSWER, a.LOG_ORDER)
        documents = nested.join(named, "path").select("record", paths.file_name("path").alias("file"), "path", F.lit("m1").alias("model_id"), "categories")
        write_record_files(documents, folder)
    found = records.read_responses(spark, folder, "keyed")
    return found.select("path", "category", "status", "output", "error", "processing_time_sec")


@query("""SELECT CAST(conv_id AS VARCHAR) || '/' || turn AS file, role AS category, text AS output, 'ok' AS status FROM conversations""")
def flatten_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with one answer each."""
    documents = a.table(spark, sf_dir, "conversations").select(
        F.concat_ws("/", a.text("conv_id"), "turn").alias("file"), F.lit("m1").alias("model_id"),
        F.col("role").alias("prompt_mode"), F.col("text").alias("raw_output"), F.lit("ok").alias("status"),
    )
    return _back(spark, documents, "flat").select("file", "category", "output", "status")


@query(f"""WITH {a.CAPTIONS}
SELECT CAST(track_id AS VARCHAR) AS track_id, chunk_index, category, max(output) AS output, 'ok' AS status FROM captions GROUP BY ALL""")
def flatten_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with time windows, those beyond the labelled four among them."""
    rows = a.captions(spark, sf_dir).withColumns({"start_seconds": F.lit(0.0), "end_seconds": F.lit(1.0)})
    keys = ["genre_style", "instruments", "vocals", "tempo_key"]
    nested = summarize.nest_windows(rows, keys, ("track_id",))
    documents = nested.select(
        F.struct(F.lit("m1").alias("model"), a.text("track_id").alias("audio_file"), "total_chunks").alias("metadata"), "chunks"
    )
    return _back(spark, documents, "chunks").select("track_id", "chunk_index", "category", "output", "status")


@query(f"WITH {a.TAKES} SELECT DISTINCT file, path FROM takes WHERE doc_id IN (SELECT doc_id FROM labels)")
def done_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Done records, some of them twice, written as files and read as a list of what is done."""
    path = shared_path(spark, "done")
    done = a.done_takes(spark, sf_dir)
    export_records(done.union(done.where("length(path) % 2 = 0")).select("file", "path"), path)
    return records.read_done_files(spark, path, pretty=False).select("file", "path")


@query(f"""WITH {a.LOG}, {a.LATEST}
SELECT track_id, string_agg(category || '=' || coalesce(output, '?'), ',' ORDER BY category) AS body FROM latest GROUP BY 1""")
def nest_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of the newest answer of each category, whatever the catalogue lists."""
    nested = summarize.nest_by_category(a.log(spark, sf_dir), a.EVENT_CATALOG.keys[:1], order=a.LOG_ORDER)
    entries = F.transform(
        F.array_sort(F.map_entries("categories")),
        lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"]["output"], F.lit("?"))),
    )
    return nested.select("track_id", F.array_join(entries, ",").alias("body"))


@query(f"""WITH {a.LOG}, {a.LATEST}, {a.LISTENERS}
SELECT l.track_id, coalesce(string_agg(s.category, ',' ORDER BY s.category), '') AS categories
FROM listeners l LEFT JOIN latest s ON s.track_id = l.track_id GROUP BY 1""")
def state_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each track's categories so far, unlisted ones too."""
    state = resume.latest_state(a.log(spark, sf_dir).select("track_id", "category", "updated_at", "event_id", "status"), order=a.LOG_ORDER)
    loaded = resume.load_state(a.listeners(spark, sf_dir).select("track_id"), state, a.EVENT_CATALOG.subset(a.EVENT_CATALOG.keys[:1]))
    return loaded.select("track_id", F.array_join(F.array_sort(F.map_keys("categories")), ",").alias("categories"))
