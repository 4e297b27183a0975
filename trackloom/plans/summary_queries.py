"""Roll-ups, summaries, pivots, nested records and their files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from trackloom.functions import text as tx
from trackloom.model import ORDERED_RECORD
from trackloom.operators import consensus, summarize
from trackloom.operators.resume import with_existence
from trackloom.plans import adapters as a
from trackloom.plans.registry import query
from trackloom.session import shared_path
from trackloom.sinks.documents import write_summary_csv, write_summary_document
from trackloom.sinks.log import export_records
from trackloom.sources import records

ROLLUP = f"""{a.RESPONSES},
sums AS (SELECT track_id, count(*) AS n, count(*) FILTER (status = 'ok') AS k,
    sum(CAST(processing_time_sec AS DECIMAL(18,3))) AS s FROM responses GROUP BY 1),
rollup_rows AS (SELECT o_orderkey AS track_id, coalesce(n, 0) AS prompts_total, coalesce(k, 0) AS prompts_ok,
    CAST(round(coalesce(s, 0), 1) AS DOUBLE) AS total_processing_time_sec,
    CASE WHEN coalesce(n, 0) = coalesce(k, 0) THEN 'ok' WHEN k = 0 THEN 'error' ELSE 'partial' END AS status
  FROM orders LEFT JOIN sums ON o_orderkey = track_id)"""


def _rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    everything = a.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("track_id"))
    return summarize.track_rollup(a.responses(spark, sf_dir), everything)


@query(f"WITH {ROLLUP} SELECT * FROM rollup_rows")
def track_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rollup(spark, sf_dir)


@query(f"""WITH {ROLLUP}
SELECT count(*) AS total_tracks, count(*) FILTER (status = 'ok') AS ok_count,
  count(*) FILTER (status = 'partial') AS partial_count, count(*) FILTER (status = 'error') AS fail_count,
  7 AS prompts_per_track FROM rollup_rows""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize.run_summary(_rollup(spark, sf_dir), 7)


@query("""SELECT l_linenumber AS prompt_ord, count(*) AS responses, CAST(round(sum(CAST(l_quantity AS DECIMAL(18,1))) / count(*), 3) AS DOUBLE) AS mean_sec,
  min(l_quantity) AS min_sec, median(l_quantity) AS median_sec, max(l_quantity) AS max_sec
FROM lineitem GROUP BY 1""")
def prompt_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize.prompt_timing(a.responses(spark, sf_dir), ("prompt_ord",)).withColumn(
        "prompt_ord", F.col("prompt_ord").cast("int")
    )


CELL = f"""trim(CASE WHEN status = 'ok' THEN replace(coalesce(output, ''), chr(10), ' ')
    ELSE '[' || coalesce(status, 'missing') || '] ' || coalesce(error, '') END)"""


@query(f"WITH {a.LOG} SELECT event_id, {CELL} AS cell FROM log")
def summary_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.log(spark, sf_dir).select("event_id", tx.cell_text("status", "output", "error").alias("cell"))


PIVOT = f"""WITH {a.LOG}, {a.LATEST}
SELECT track_id, """ + ", ".join(
    f"coalesce(max(CASE WHEN category = '{k}' THEN {CELL} END), '[missing]') AS \"{k}\"" for k in a.EVENT_CATALOG.keys
) + " FROM latest GROUP BY 1"


@query(PIVOT)
def summary_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize.summary_pivot(a.log(spark, sf_dir), a.EVENT_CATALOG.keys, ("track_id",), a.LOG_ORDER)


@query(PIVOT)
def summary_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pivot written as CSV and read back."""
    path = shared_path(spark, "csv")
    pivoted = summarize.summary_pivot(a.log(spark, sf_dir), a.EVENT_CATALOG.keys, ("track_id",), a.LOG_ORDER)
    write_summary_csv(pivoted, path)
    return spark.read.schema(pivoted.schema).option("header", True).option("escape", '"').csv(path)


@query(f"""WITH {ROLLUP}
SELECT CAST(track_id AS VARCHAR) AS file, status, prompts_ok, (SELECT count(*) FROM rollup_rows) AS total_tracks FROM rollup_rows""")
def summary_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary document written line by line, and its lines read back."""
    path = shared_path(spark, "summary")
    rollup = _rollup(spark, sf_dir)
    rows = rollup.select(a.text("track_id").alias("file"), "status", "prompts_ok")
    write_summary_document(summarize.run_summary(rollup), rows, path)
    lines = spark.read.text(path)
    body = lines.where(F.col("value").startswith('{"file"')).select(
        F.from_json(F.rtrim("value", F.lit(",")), rows.schema).alias("r")
    ).select("r.*")
    total = lines.where(F.col("value").startswith('{"total_tracks"')).select(
        F.regexp_extract("value", '"total_tracks":([0-9]+)', 1).cast("bigint").alias("total_tracks"), F.lit(1).alias("_one")
    )
    return body.withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one").drop("_one")  # one row


@query("""SELECT CAST(conv_id AS VARCHAR) AS track_id, turn // 10000 AS part, count(*) AS n,
  string_agg(turn || ':' || text, ',' ORDER BY turn) AS body FROM conversations GROUP BY 1, 2""")
def nest_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = summarize.nest_ordered(a.turns(spark, sf_dir), part_size=10_000)
    body = F.transform("responses", lambda r: F.concat_ws(":", r["prompt_ord"], r["output"]))
    return nested.select(
        "track_id", "part", F.size("responses").cast("bigint").alias("n"), F.array_join(body, ",").alias("body")
    )


@query("""SELECT CAST(conv_id AS VARCHAR) AS file, turn AS prompt_ord, text AS output, 'ok' AS status FROM conversations""")
def flatten_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses nested into records, written, read with the record schema and flattened."""
    path = shared_path(spark, "records")
    nested = summarize.nest_ordered(a.turns(spark, sf_dir))
    response = lambda r: F.struct(
        r["prompt_ord"].alias("prompt_index"), F.lit(None).cast("string").alias("prompt"),
        r["output"].alias("raw_output"), F.lit(None).cast("double").alias("processing_time_sec"),
        r["status"].alias("status"), r["error"].alias("error"),
    )
    documents = nested.select(
        F.col("track_id").alias("file"), F.lit("m1").alias("model_id"), F.lit("ok").alias("status"),
        F.transform("responses", response).alias("responses"),
    )
    export_records(documents, path)
    back = records.flatten_ordered(records.read_records(spark, path, ORDERED_RECORD, pretty=False))
    return back.select("file", "prompt_ord", "output", "status")


@query(f"""WITH {a.LOG}, {a.LATEST}
SELECT track_id, string_agg(category || '=' || coalesce(status, '?'), ',' ORDER BY category) AS body
FROM latest GROUP BY 1""")
def nest_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = summarize.nest_by_category(
        a.log(spark, sf_dir), a.EVENT_CATALOG.keys, fields=("status", "error"), order=a.LOG_ORDER
    )
    entries = F.transform(
        F.array_sort(F.map_entries("categories")),
        lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"]["status"], F.lit("?"))),
    )
    return nested.select("track_id", F.array_join(entries, ",").alias("body"))


@query("""SELECT CAST(event_id AS VARCHAR) AS file, event_type AS category, NULL::BIGINT AS prompt_ord FROM events
UNION ALL SELECT CAST(conv_id AS VARCHAR), role, turn FROM conversations""")
def union_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches with different columns in one table."""
    first = a.table(spark, sf_dir, "events").select(a.text("event_id").alias("file"), F.col("event_type").alias("category"))
    second = a.turns(spark, sf_dir).select(F.col("track_id").alias("file"), "category", "prompt_ord")
    return records.union_responses(first, second)


@query("""SELECT l_orderkey AS file, CAST(sum(CAST(l_quantity AS DECIMAL(18,3))) FILTER (l_returnflag = 'A') AS DOUBLE) AS "sec_A",
  CAST(sum(CAST(l_quantity AS DECIMAL(18,3))) FILTER (l_returnflag = 'R') AS DOUBLE) AS "sec_R",
  CAST(sum(CAST(l_quantity AS DECIMAL(18,3))) FILTER (l_returnflag = 'R')
    - sum(CAST(l_quantity AS DECIMAL(18,3))) FILTER (l_returnflag = 'A') AS DOUBLE) AS delta_sec
FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1""")
def run_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = a.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("file"), F.col("l_returnflag").alias("run_id"),
        F.col("l_quantity").alias("processing_time_sec"),
    )
    return consensus.run_comparison(timed, ["A", "R"])


@query("""SELECT count(*) AS total_tracks, count(*) FILTER (l_returnflag <> 'R') AS success_count,
  count(*) FILTER (l_returnflag = 'R') AS fail_count FROM lineitem""")
def flat_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize.flat_summary(a.responses(spark, sf_dir))


@query(f"""WITH {a.LISTENERS}, {a.LOG},
sums AS (SELECT track_id, count(*) AS n, count(*) FILTER (status = 'ok') AS k,
  CAST(round(sum(CAST(processing_time_sec AS DECIMAL(18,3))), 1) AS DOUBLE) AS s FROM log GROUP BY 1),
found AS (SELECT *, c_custkey IN (SELECT o_custkey FROM orders) AS there FROM listeners LEFT JOIN sums USING (track_id))
SELECT track_id, regexp_extract(path, '[^/]+$') AS file,
  CASE WHEN NOT there OR n IS NULL OR k = 0 THEN 'error' WHEN n = k THEN 'ok' ELSE 'partial' END AS status,
  CASE WHEN there THEN s END AS total_processing_time_sec, CASE WHEN there THEN coalesce(k, 0) ELSE 0 END AS prompts_ok,
  6 AS prompts_total, CASE WHEN NOT there THEN 'File not found: ''' || path || '''' END AS error,
  CASE WHEN there THEN 'out/' || regexp_replace(regexp_extract(path, '[^/]+$'), '[.]mp3$', '') || '.caption.json' END AS output_file
FROM found""")
def job_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    scan = a.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    tracks = with_existence(a.listeners(spark, sf_dir), scan, "c_custkey", "c_custkey")
    rollup = summarize.track_rollup(a.log(spark, sf_dir)).drop("prompts_total")
    return summarize.job_summary(tracks, rollup, len(a.EVENT_CATALOG.keys), "out")
