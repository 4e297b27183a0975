"""State, pending pairs, missing files, cut-off, annotation and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from trackloom.operators import annotate as an, resume
from trackloom.plans import adapters as a
from trackloom.plans.registry import query
from trackloom.session import shared_path
from trackloom.sinks.log import STATE_KEYS, STATE_ORDER, compact_log, read_log, read_state, vacuum_log, write_batch
from trackloom.streaming import jobs
from trackloom.streaming.state import annotate_stream

PENDING = f"""{a.LOG}, {a.LATEST}, {a.LISTENERS}, {a.CATALOG},
pending AS (SELECT l.track_id, l.content, l.path, c.ord, c.category, c.prompt FROM listeners l, catalog c
  WHERE NOT EXISTS (SELECT 1 FROM latest s WHERE s.track_id = l.track_id AND s.category = c.category AND s.status = 'ok'))"""


@query(f"WITH {a.LOG}, {a.LATEST} SELECT track_id, category, event_id, status, error FROM latest")
def latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = a.log(spark, sf_dir).select("track_id", "category", "updated_at", "event_id", "status", "error")
    return resume.latest_state(log, order=a.LOG_ORDER).drop("updated_at")


@query(f"""WITH {a.LOG}, {a.LATEST} SELECT track_id, category, event_id, status FROM latest""")
def state_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of the succeeded rows, then upserted with all others."""
    log = a.log(spark, sf_dir).select("track_id", "category", "updated_at", "event_id", "status")
    good = F.coalesce(F.col("status") == "ok", F.lit(False))
    state = resume.latest_state(log.where(good), order=a.LOG_ORDER)
    return resume.upsert_state(state, log.where(~good), order=a.LOG_ORDER).drop("updated_at")


@query(f"WITH {PENDING} SELECT track_id, ord, category FROM pending")
def pending_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pending = resume.pending_pairs(
        a.listeners(spark, sf_dir).select("track_id"), a.log(spark, sf_dir), a.EVENT_CATALOG, order=a.LOG_ORDER
    )
    return pending.select("track_id", "ord", "category")


@query(f"WITH {a.TRACKS}, {a.CATALOG} SELECT path, ord, category, prompt FROM tracks, catalog")
def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resume.fan_out(a.tracks(spark, sf_dir).select("path"), a.EVENT_CATALOG)


@query(f"WITH {a.LOG}, {a.CATALOG} SELECT event_id, prompt FROM log JOIN catalog USING (category)")
def prompt_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.log(spark, sf_dir).select("event_id", a.EVENT_CATALOG.prompt_for("category").alias("prompt"))


@query(f"""WITH {a.LOG}, {a.LATEST}, {a.LISTENERS}
SELECT l.track_id, count(s.category) AS categories, count(*) FILTER (s.status = 'ok') AS ok
FROM listeners l LEFT JOIN latest s ON s.track_id = l.track_id GROUP BY 1""")
def state_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = resume.latest_state(
        a.log(spark, sf_dir).select("track_id", "category", "updated_at", "event_id", "status"), order=a.LOG_ORDER
    )
    loaded = resume.load_state(a.listeners(spark, sf_dir).select("track_id"), state, a.EVENT_CATALOG)
    values = F.map_values("categories")
    return loaded.select(
        "track_id", F.size("categories").cast("bigint").alias("categories"),
        F.size(F.filter(values, lambda s: s == "ok")).cast("bigint").alias("ok"),
    )


def _ordered_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scan: files that exist, many times each."""
    return a.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))


@query("""SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS "exists" FROM customer""")
def file_existence(spark: SparkSession, sf_dir: str) -> DataFrame:
    tracks = a.listeners(spark, sf_dir).select("c_custkey")
    return resume.with_existence(tracks, _ordered_by(spark, sf_dir), "c_custkey", "c_custkey")


@query(f"""WITH {a.LISTENERS}, {a.CATALOG},
found AS (SELECT path FROM listeners WHERE c_custkey IN (SELECT o_custkey FROM orders))
SELECT l.path, c.category, 'error' AS status, 'File not found: ''' || l.path || '''' AS error
FROM listeners l, catalog c WHERE l.path NOT IN (SELECT path FROM found)""")
def missing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    tracks = a.listeners(spark, sf_dir)
    scan = tracks.join(_ordered_by(spark, sf_dir), "c_custkey", "left_semi")
    errors = resume.missing_file_errors(tracks, scan, a.EVENT_CATALOG)
    return errors.select("path", "category", "status", "error")


@query(f"""WITH {a.LOG},
first AS (SELECT track_id, min(struct_pack(u := updated_at, e := event_id)) AS f FROM log WHERE error LIKE 'CUDA%' GROUP BY 1),
marked AS (SELECT log.*, coalesce(struct_pack(u := updated_at, e := event_id) > f, false) AS skipped
  FROM log LEFT JOIN first USING (track_id))
SELECT event_id, skipped, CASE WHEN skipped THEN 'error' ELSE status END AS status,
  CASE WHEN skipped THEN 'Skipped: CUDA context poisoned earlier in this run. Restart and re-run to resume.' ELSE error END AS error
FROM marked""")
def fatal_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = a.log(spark, sf_dir).select("track_id", "event_id", "updated_at", "status", "error")
    cut = resume.fatal_cutoff(results, "track_id", a.LOG_ORDER, resume.is_fatal())
    return cut.select("event_id", "skipped", "status", "error")


@query(f"""WITH {PENDING}
SELECT track_id, category, '[DRY RUN placeholder output for ''' || category || ''']' AS output, 'ok' AS status,
  CAST(0.1 AS DOUBLE) AS processing_time_sec, 1 AS audio_windows, 30 AS audio_covered_sec, false AS output_truncated FROM pending""")
def dry_run_annotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    pending = resume.pending_pairs(
        a.listeners(spark, sf_dir).select("track_id"), a.log(spark, sf_dir), a.EVENT_CATALOG, order=a.LOG_ORDER
    )
    return an.dry_run(pending).select(
        "track_id", "category", "output", "status", "processing_time_sec", "audio_windows",
        "audio_covered_sec", "output_truncated",
    )


@query(f"WITH {a.LOG} SELECT track_id, category, updated_at, status FROM log")
def log_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches written under one run id and number, and all rows read back."""
    path = shared_path(spark, "attempts")
    rows = a.log(spark, sf_dir).drop("event_id")
    good = F.coalesce(F.col("status") == "ok", F.lit(False))
    for part in (rows.where(good), rows.where(~good)):
        write_batch(part, path, "run", 0)
    return read_log(spark, path).select("track_id", "category", "updated_at", "status")


class EchoAnnotator:
    """A stand-in for a model: answers with what it was given, and fails on some media."""

    def prepare(self, content: str) -> str:
        if content == "MACHINERY":
            raise ValueError(f"no decoder for {content}")
        return content.lower()

    def annotate(self, prepared: str, prompt: str) -> dict:
        if prepared == "furniture" and "view" in prompt:
            raise RuntimeError("device-side assert")
        return {"output": f"{prepared}: {prompt}", "processing_time_sec": 0.1, "output_truncated": False}


@query(f"""WITH {PENDING},
answered AS (SELECT *, CASE WHEN content = 'MACHINERY' THEN 'no decoder for MACHINERY'
    WHEN content = 'FURNITURE' AND category = 'view' THEN 'device-side assert' END AS error FROM pending)
SELECT track_id, ord, category, CASE WHEN error IS NULL THEN 'ok' ELSE 'error' END AS status, error,
  CASE WHEN error IS NULL THEN lower(content) || ': ' || prompt END AS output,
  CASE WHEN error IS NULL THEN CAST(0.1 AS DOUBLE) END AS processing_time_sec, error IS NOT NULL AS has_traceback FROM answered""")
def annotate_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    pending = resume.pending_prompts(
        a.listeners(spark, sf_dir).select("track_id", "content"), a.log(spark, sf_dir), a.EVENT_CATALOG, order=a.LOG_ORDER
    )
    results = an.annotate(pending, EchoAnnotator, tasks=spark.sparkContext.defaultParallelism)
    return results.select(
        "track_id", "ord", "category", "status", "error", "output", "processing_time_sec",
        F.col("traceback").isNotNull().alias("has_traceback"),
    )


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_mirror(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events mirrored by a stream that drains its source; run again, it adds nothing."""
    schema = a.table(spark, sf_dir, "events").schema
    target, checkpoint = shared_path(spark, "mirror"), shared_path(spark, "mirror-checkpoint")
    for _ in range(2):
        jobs.mirror(spark, sf_dir, schema, target, checkpoint, every=None, pathGlobFilter="events.parquet").awaitTermination()
    return spark.read.parquet(target).select("event_id", "user_id", "event_type", "value")


@query(f"""WITH {PENDING}
SELECT track_id, category, 'ok' AS status, '[DRY RUN placeholder output for ''' || category || ''']' AS output FROM pending""")
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotate in micro-batches on top of an earlier log, twice; the second run finds nothing to do."""
    inbox, log_path = shared_path(spark, "inbox"), shared_path(spark, "log")
    a.listeners(spark, sf_dir).select("track_id").repartition(3).write.parquet(inbox)
    write_batch(resume.latest_state(a.log(spark, sf_dir).drop("event_id")), log_path, "earlier", 0)

    def answer(todo: DataFrame) -> DataFrame:
        return an.dry_run(todo.select("track_id", F.inline("prompts"))).withColumnRenamed("prompt", "prompt_used")

    for run in ("first", "second"):
        stream = spark.readStream.schema("track_id string").option("maxFilesPerTrigger", 2).parquet(inbox)
        jobs.resume_annotation(
            spark, stream, a.EVENT_CATALOG, log_path, run, shared_path(spark, f"resume-{run}"), answer
        ).awaitTermination()
    done = read_log(spark, log_path).where(F.col("run_id") != "earlier")
    return done.select("track_id", "category", "status", "output")


@query(f"""WITH {PENDING}
SELECT track_id, category, 'ok' AS status, '[DRY RUN placeholder output for ''' || category || ''']' AS output FROM pending""")
def stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the progress as keyed state: the log is read once, to start the state, and its snapshot only."""
    inbox, log_path, checkpoint = (shared_path(spark, name) for name in ("inbox", "log", "state"))
    a.listeners(spark, sf_dir).select("track_id").repartition(3).write.parquet(inbox)
    write_batch(resume.latest_state(a.log(spark, sf_dir).drop("event_id")), log_path, "earlier", 0)
    compact_log(spark, log_path)
    for _ in range(2):
        stream = spark.readStream.schema("track_id string").option("maxFilesPerTrigger", 2).parquet(inbox)
        annotate_stream(spark, stream, a.EVENT_CATALOG, log_path, "run", checkpoint).awaitTermination()
    done = read_log(spark, log_path).where(F.col("run_id") != "earlier")
    return done.select("track_id", "category", "status", "output")


@query(f"""WITH {a.LOG}, {a.LATEST}
SELECT track_id, category, status, output, error, processing_time_sec FROM latest""")
def compacted_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log that is written in three attempts, two of them folded into a snapshot: its newest rows from snapshot and tail."""
    log_path = shared_path(spark, "log")
    rows = a.log(spark, sf_dir).withColumn("part", F.pmod("event_id", F.lit(3)))
    for part in range(3):
        write_batch(rows.where(F.col("part") == part), log_path, "run", part)
        if part < 2:
            compact_log(spark, log_path)
    vacuum_log(log_path)
    newest = resume.latest_state(read_state(spark, log_path), STATE_KEYS, STATE_ORDER)
    return newest.select("track_id", "category", "status", "output", "error", "processing_time_sec")
