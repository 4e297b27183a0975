"""Layered settings, prompt modes and request rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from trackloom.operators import config
from trackloom.plans import adapters as a
from trackloom.plans.registry import query
from trackloom.sources.catalog import MODE_PROMPTS

CARRY = ("track_index", "job")


def _settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return config.resolve_settings(a.manifest_entries(spark, sf_dir), carry=CARRY)


@query(f"""WITH {a.SETTINGS}
SELECT track_index, job, path, model_id, precision, prompt_mode, output_dir, custom_prompt,
  CASE WHEN asked IS NOT NULL THEN least(asked, 512) END AS max_new_tokens, title FROM settings""")
def layered_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _settings(spark, sf_dir).withColumn("title", F.try_element_at("tags", F.lit("title"))).drop("tags", "clamped")


@query(f"WITH {a.SETTINGS} SELECT track_index, CASE WHEN asked IS NOT NULL THEN least(asked, 512) END AS max_new_tokens, coalesce(asked > 512, false) AS clamped FROM settings")
def config_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _settings(spark, sf_dir).select("track_index", "max_new_tokens", "clamped")


@query(f"""WITH {a.SETTINGS}
SELECT track_index, job, 'Entry ' || track_index || CASE WHEN path IS NULL THEN ' of the manifest has no path.'
  ELSE ' asks for a number of tokens that is not a whole number.' END AS reason
FROM settings WHERE path IS NULL OR unreadable""")
def config_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return config.manifest_rejects(a.manifest_entries(spark, sf_dir), CARRY)


@query(f"""WITH {a.SETTINGS}
SELECT track_index, CASE prompt_mode WHEN 'minimal' THEN '{MODE_PROMPTS["minimal"]}'
    WHEN 'default' THEN '{MODE_PROMPTS["default"]}' WHEN 'custom' THEN custom_prompt END AS prompt,
  CASE WHEN prompt_mode = 'custom' AND custom_prompt IS NULL
      THEN 'Prompt mode ''custom'' needs a custom prompt.'
    WHEN prompt_mode = 'verbose'
      THEN 'Prompt mode ''verbose'' is not known; use minimal, default or custom.' END AS reason
FROM settings""")
def prompt_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompt, reason = config.prompt_for_mode()
    return _settings(spark, sf_dir).select("track_index", prompt.alias("prompt"), reason.alias("reason"))


@query(f"""WITH {a.SETTINGS}
SELECT job, arg_min_null(precision, track_index) AS used, count(DISTINCT coalesce(precision, 'none')) AS n_values,
  count(DISTINCT coalesce(precision, 'none')) > 1 AS mixed FROM settings GROUP BY job""")
def mixed_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return config.mixed_settings(_settings(spark, sf_dir), "precision", "job")


@query(f"WITH {a.SETTINGS} SELECT precision AS value, count(*) AS tracks FROM settings GROUP BY 1")
def setting_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return config.setting_values(_settings(spark, sf_dir), "precision")


@query("""SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN 'tempo' WHEN 'FURNITURE' THEN 'mood,tempo' ELSE '' END AS unknown
FROM customer""")
def unknown_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    asked = (
        F.when(segment == "MACHINERY", "click, tempo").when(segment == "FURNITURE", " mood,,tempo ,view, mood")
        .otherwise("view,click")
    )
    names = config.requested_categories(asked)
    return a.table(spark, sf_dir, "customer").select(
        "c_custkey", F.array_join(config.unknown_categories(names, a.EVENT_CATALOG.keys), ",").alias("unknown")
    )


@query("""WITH requests AS (
  SELECT l_orderkey, l_linenumber, l_quantity * 10 AS duration, CAST(round(l_tax * 100) AS INT) AS guidance,
    l_returnflag AS f, l_linestatus AS s FROM lineitem)
SELECT l_orderkey, l_linenumber, concat_ws(',',
  CASE WHEN duration > 300 THEN 'duration' END, CASE WHEN guidance < 1 THEN 'guidance' END,
  CASE WHEN s = 'F' THEN 'steps' END, CASE WHEN f = 'R' THEN 'key_scale' END,
  CASE WHEN l_linenumber NOT IN (2, 3, 4, 6) THEN 'time_signature' END,
  CASE WHEN f = 'A' AND s = 'F' THEN 'custom_prompt' END) AS violations FROM requests""")
def rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    lines = a.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_returnflag", "l_linestatus"
    )
    requests = lines.select(
        "l_orderkey", "l_linenumber",
        (F.col("l_quantity") * 10).cast("int").cast("string").alias("duration"),
        F.round(F.col("l_tax") * 100).cast("int").cast("string").alias("guidance"),
        F.when(status == "F", "abc").otherwise(" 12 ").alias("steps"),
        F.when(flag == "A", "C major").when(flag == "N", " D minor ").otherwise("H major").alias("key_scale"),
        F.concat(a.text("l_linenumber"), F.lit("/4")).alias("time_signature"),
        F.when(flag == "A", "custom").otherwise("minimal").alias("prompt_mode"),
        F.when(status == "F", "").otherwise("Say it.").alias("custom_prompt"),
    )
    rules = {
        "duration": config.breaks_int_range("duration", 10, 300),
        "guidance": config.breaks_float_range("guidance", 1.0, 20.0),
        "steps": config.breaks_int_range("steps", 1, 100),
        "key_scale": config.breaks_choice("key_scale", ["C major", "D minor"]),
        "time_signature": config.breaks_time_signature("time_signature", [2, 3, 4, 6]),
        "custom_prompt": config.breaks_custom_prompt(),
    }
    return requests.select("l_orderkey", "l_linenumber", F.array_join(config.violations(rules), ",").alias("violations"))
