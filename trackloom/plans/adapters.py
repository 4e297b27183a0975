"""Track, log, manifest and caption tables derived from the driver's tables.

Each adapter has its SQL twin as a CTE, so that a query and its check start
from the same rows. All of them are projections: they read whole tables and
only the columns they need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trackloom.sources.catalog import Catalog

EVENT_CATALOG = Catalog("events", tuple(
    (k, f"Describe the {k} step.") for k in ("click", "view", "purchase", "signup", "error", "refund")
))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(c: str) -> Column:
    return F.col(c).cast("string")


# --- tracks: one per document ----------------------------------------------------


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique paths with mixed-case suffixes, some of them not audio."""
    lang, doc, n = F.col("lang"), text("doc_id"), text("n_chars")
    name = (
        F.when(lang == "en", F.concat(n, F.lit(". Doc "), doc))
        .when(lang == "fr", F.concat(n, F.lit(" - Doc "), doc))
        .when(lang == "de", F.concat(n, F.lit("_Doc "), doc))
        .otherwise(F.concat(F.lit("Doc "), doc))
    )
    album = F.when(lang == "en", F.col("source")).otherwise(F.concat("source", F.lit(" "), "lang"))
    ext = F.when(lang == "en", "mp3").when(lang == "fr", "FLAC").when(lang == "de", "Wav").otherwise("txt")
    return table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", "n_chars",
        F.concat(album, F.lit("/"), name, F.lit("."), ext).alias("path"),
    )


TRACKS = """tracks AS (
  SELECT doc_id, lang, source, n_chars,
    CASE WHEN lang = 'en' THEN source ELSE source || ' ' || lang END || '/' ||
    CASE lang WHEN 'en' THEN n_chars || '. Doc ' || doc_id WHEN 'fr' THEN n_chars || ' - Doc ' || doc_id
      WHEN 'de' THEN n_chars || '_Doc ' || doc_id ELSE 'Doc ' || doc_id END || '.' ||
    CASE lang WHEN 'en' THEN 'mp3' WHEN 'fr' THEN 'FLAC' WHEN 'de' THEN 'Wav' ELSE 'txt' END AS path
  FROM documents)"""


def takes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths whose file names repeat over albums."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.concat("source", F.lit("/"), text("doc_id"), F.lit("/"), text("n_chars"), F.lit(". Take.mp3")).alias("path")
    )


TAKES = """takes AS (
  SELECT doc_id, source || '/' || doc_id || '/' || n_chars || '. Take.mp3' AS path,
    n_chars || '. Take.mp3' AS file FROM documents)"""


def done_takes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A take with a label counts as done."""
    labelled = table(spark, sf_dir, "labels").select("doc_id").distinct()
    return takes(spark, sf_dir).join(labelled, "doc_id", "left_semi").select(
        "path", F.substring_index("path", "/", -1).alias("file")
    )


# --- response log: one row per event ---------------------------------------------


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        text("user_id").alias("track_id"), F.col("event_type").alias("category"),
        F.col("ts").alias("updated_at"), "event_id",
        F.when(k < 5, F.lit(None)).when(k < 70, "ok").otherwise("error").alias("status"),
        F.when(k.between(5, 69), F.concat(F.lit(" answer "), k.cast("string"), F.lit("\n"), "event_type", F.lit(" "))).alias("output"),
        F.when(k >= 97, F.concat(F.lit("CUDA error "), k.cast("string")))
        .when(k >= 70, F.concat(F.lit("timeout "), k.cast("string"))).alias("error"),
        F.col("value").alias("processing_time_sec"),
    )


LOG_ORDER = ("updated_at", "event_id")

LOG = """raw AS (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INT) AS k FROM events),
log AS (
  SELECT CAST(user_id AS VARCHAR) AS track_id, event_type AS category, ts AS updated_at, event_id,
    CASE WHEN k < 5 THEN NULL WHEN k < 70 THEN 'ok' ELSE 'error' END AS status,
    CASE WHEN k BETWEEN 5 AND 69 THEN ' answer ' || k || chr(10) || event_type || ' ' END AS output,
    CASE WHEN k >= 97 THEN 'CUDA error ' || k WHEN k >= 70 THEN 'timeout ' || k END AS error,
    value AS processing_time_sec
  FROM raw)"""

LATEST = """latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY track_id, category
      ORDER BY updated_at DESC, event_id DESC) AS rn FROM log) WHERE rn = 1)"""

CATALOG = "catalog AS (SELECT * FROM (VALUES {}) AS c(ord, category, prompt))".format(", ".join(
    f"({i}, '{c}', '{p}')" for i, (c, p) in enumerate(EVENT_CATALOG.entries)
))


def listeners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks that the log speaks about, and many that it does not: one per customer."""
    return table(spark, sf_dir, "customer").select(
        text("c_custkey").alias("track_id"), F.col("c_mktsegment").alias("content"),
        F.concat(F.lit("cust/"), "c_name", F.lit(".mp3")).alias("path"), "c_custkey",
    )


LISTENERS = """listeners AS (
  SELECT CAST(c_custkey AS VARCHAR) AS track_id, c_mktsegment AS content,
    'cust/' || c_name || '.mp3' AS path, c_custkey FROM customer)"""


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses in prompt order: one per order line."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("track_id"), F.col("l_linenumber").cast("bigint").alias("prompt_ord"),
        F.when(F.col("l_returnflag") == "R", "error").otherwise("ok").alias("status"),
        F.col("l_quantity").alias("processing_time_sec"),
    )


RESPONSES = """responses AS (
  SELECT l_orderkey AS track_id, CAST(l_linenumber AS BIGINT) AS prompt_ord,
    CASE WHEN l_returnflag = 'R' THEN 'error' ELSE 'ok' END AS status,
    l_quantity AS processing_time_sec FROM lineitem)"""


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses with long texts: one per conversation turn."""
    return table(spark, sf_dir, "conversations").select(
        text("conv_id").alias("track_id"), F.col("turn").alias("prompt_ord"),
        F.col("role").alias("category"), F.col("text").alias("output"),
        F.lit("ok").alias("status"), F.lit(None).cast("string").alias("error"),
    )


# --- window captions: one window per order line -----------------------------------


def _hundredths(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("int")


def captions(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    """Captions of all four kinds, or of the given ones, as comma-separated noun phrases."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    genre = F.when(flag == "A", "Arabic pop, contemporary").when(flag == "N", "Folk , traditional ").otherwise("Jazz fusion")
    instruments = F.concat(
        F.lit("Oud, "), F.when(status == "F", "Qanun").otherwise("Darbuka with rolls"),
        F.lit(", synth pad "), _hundredths("l_tax").cast("string"), F.lit(","),
    )
    vocals = F.concat(F.when(F.col("l_quantity") < 10, "female alto").otherwise("male baritone"), F.lit(", melismatic"))
    tempo = F.concat(
        (F.col("l_quantity") + 60).cast("int").cast("string"), F.lit("\u202fBPM, "),
        F.substr(F.lit("ABCDEFGABCD"), _hundredths("l_discount") + 1, F.lit(1)),
        F.when(status == "F", "♯ minor").otherwise(" major"),
        F.when(flag == "R", ", 6/8").otherwise(", 4/4"),
    )
    rows = F.array(*[
        F.struct(F.lit(k).alias("category"), v.alias("output"))
        for k, v in (("genre_style", genre), ("instruments", instruments), ("vocals", vocals), ("tempo_key", tempo))
        if not kinds or k in kinds
    ])
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_tax", "l_discount", "l_quantity"
    )
    return lines.select(
        F.col("l_orderkey").alias("track_id"), F.col("l_linenumber").alias("chunk_index"), F.inline(rows)
    )


CAPTIONS = """lines AS (
  SELECT l_orderkey AS track_id, l_linenumber AS chunk_index,
    CASE l_returnflag WHEN 'A' THEN 'Arabic pop, contemporary' WHEN 'N' THEN 'Folk , traditional '
      ELSE 'Jazz fusion' END AS genre_style,
    'Oud, ' || CASE WHEN l_linestatus = 'F' THEN 'Qanun' ELSE 'Darbuka with rolls' END
      || ', synth pad ' || CAST(round(l_tax * 100) AS INT) || ',' AS instruments,
    CASE WHEN l_quantity < 10 THEN 'female alto' ELSE 'male baritone' END || ', melismatic' AS vocals,
    CAST(l_quantity + 60 AS INT) || chr(8239) || 'BPM, '
      || substr('ABCDEFGABCD', CAST(round(l_discount * 100) AS INT) + 1, 1)
      || CASE WHEN l_linestatus = 'F' THEN '♯ minor' ELSE ' major' END
      || CASE WHEN l_returnflag = 'R' THEN ', 6/8' ELSE ', 4/4' END AS tempo_key
  FROM lineitem),
captions AS (
  SELECT track_id, chunk_index, unnest(['genre_style', 'instruments', 'vocals', 'tempo_key']) AS category,
    unnest([genre_style, instruments, vocals, tempo_key]) AS output FROM lines)"""

TAGS = CAPTIONS + """,
split AS (SELECT track_id, chunk_index, category AS dimension, unnest(string_split(output, ',')) AS t FROM captions),
tags AS (SELECT track_id, chunk_index, dimension, lower(trim(t)) AS tag FROM split WHERE trim(t) <> ''),
votes AS (SELECT track_id, dimension, tag, count(DISTINCT chunk_index) AS windows FROM tags GROUP BY ALL)"""

FACTS = CAPTIONS + r""",
facts AS (
  SELECT track_id, chunk_index,
    CAST(nullif(regexp_extract(output, '([0-9]{2,3})[\s\p{Zs}]*BPM', 1), '') AS DOUBLE) AS bpm,
    nullif(regexp_extract(output, '([A-G])♯? (major|minor)', 1)
      || CASE WHEN output LIKE '%♯%' THEN '#' ELSE '' END || ' '
      || regexp_extract(output, '([A-G])♯? (major|minor)', 2), ' ') AS music_key,
    nullif(regexp_extract(output, '[0-9]/[0-9]'), '') AS signature
  FROM captions WHERE category = 'tempo_key')"""


# --- manifest entries: one per part ------------------------------------------------

GLOBALS = '{"model_id": "m1", "precision": "bf16", "max_new_tokens": 512, "output_dir": "./out/"}'


def manifest_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Track entries as JSON objects; overrides are present on some, null on others."""
    size, kind = F.col("p_size"), F.col("p_type")

    def part(condition: Column, *pieces: Column | str) -> Column:
        made = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in pieces])
        return F.when(condition, made).otherwise("")

    entry = F.concat(
        F.lit('{"n": '), text("p_partkey"),
        part(kind != "LARGE", ', "path": "', F.col("p_brand"), "/", F.col("p_name"), " ", text("p_partkey"), '.mp3"'),
        part(size > 25, ', "max_new_tokens": ', (size * 20).cast("string")),
        part(size == 20, ', "max_new_tokens": "many"'),
        part(size == 21, ', "max_new_tokens": null'),
        part(size <= 10, ', "precision": null'),
        part(size > 40, ', "precision": "4bit"'),
        part(kind == "PROMO", ', "prompt_mode": "custom", "custom_prompt": "', F.col("p_name"), '"'),
        part(kind == "MEDIUM", ', "prompt_mode": "custom"'),
        part(kind == "SMALL", ', "prompt_mode": "verbose"'),
        part(kind == "ECONOMY", ', "prompt_mode": "default", "tags": {"title": "', F.col("p_name"), '"}'),
        part(kind == "STANDARD", ', "tags": "none"'),
        F.lit("}"),
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("track_index"), F.col("p_brand").alias("job"),
        F.from_json(F.lit(GLOBALS), "map<string,string>").alias("globals"),
        F.from_json(entry, "map<string,string>").alias("track"),
    )


SETTINGS = """settings AS (
  SELECT p_partkey AS track_index, p_brand AS job,
    CASE WHEN p_type <> 'LARGE' THEN p_brand || '/' || p_name || ' ' || p_partkey || '.mp3' END AS path,
    'm1' AS model_id,
    CASE WHEN p_size <= 10 THEN NULL WHEN p_size > 40 THEN '4bit' ELSE 'bf16' END AS precision,
    CASE WHEN p_type IN ('PROMO', 'MEDIUM') THEN 'custom' WHEN p_type = 'SMALL' THEN 'verbose'
      WHEN p_type = 'ECONOMY' THEN 'default' ELSE 'minimal' END AS prompt_mode,
    CASE WHEN p_type = 'PROMO' THEN p_name END AS custom_prompt,
    './out/' AS output_dir,
    CASE WHEN p_size > 25 THEN p_size * 20 WHEN p_size NOT IN (20, 21) THEN 512 END AS asked, p_size = 20 AS unreadable,
    CASE WHEN p_type = 'ECONOMY' THEN p_name END AS title
  FROM part)"""
