"""Text rules over whole documents and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from trackloom.functions import text as tx
from trackloom.operators import config
from trackloom.model import ABSENCE_WORDS, SUBJECT_WORDS
from trackloom.plans import adapters as a
from trackloom.plans.registry import query

SENTENCE = r"[^.!?]*[.!?]+|[^.!?]+"
BLANK = r"[\s\x0b\x85\x1c-\x1f\p{Z}]"


def _drop_sql(source: str, pattern: str) -> str:
    kept = f"array_to_string([s FOR s IN regexp_extract_all({source}, '{SENTENCE}') IF NOT regexp_matches(s, '{pattern}')], '')"
    stripped = f"regexp_replace(regexp_replace({kept}, '^{BLANK}+', ''), '{BLANK}+$', '')"
    return f"CASE WHEN regexp_matches({source}, '{pattern}') THEN {stripped} ELSE {source} END"


@query(f"""WITH spoken AS (SELECT doc_id, CASE lang WHEN 'en' THEN 'The tempo is Not specified. ' || text
    WHEN 'fr' THEN text || ' Lyrics were not provided in the source.' ELSE text END AS t FROM documents)
SELECT doc_id, {_drop_sql('t', '(?i)not (?:available|provided|described|supplied|specified)')} AS cleaned FROM spoken""")
def refusal_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    lang = F.col("lang")
    spoken = (
        F.when(lang == "en", F.concat(F.lit("The tempo is Not specified. "), "text"))
        .when(lang == "fr", F.concat("text", F.lit(" Lyrics were not provided in the source.")))
        .otherwise(F.col("text"))
    )
    rows = a.table(spark, sf_dir, "documents").select("doc_id", spoken.alias("t"))
    return rows.select("doc_id", tx.drop_refusals("t").alias("cleaned"))


EVASIONS = {"en": "Explicit tempo data is absent. ", "de": "Lyrics? Unavailable to this model. The KEY signature remains undisclosed! ",
            "fr": "The drums are absent at first, and after a long and slow build the tempo is 90. ", "es": "A missing link is the key change"}


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


@query(f"""WITH spoken AS (SELECT doc_id, CASE lang {' '.join(f"WHEN '{k}' THEN '{v}' || text" for k, v in EVASIONS.items())} ELSE text END AS t FROM documents),
parts AS (SELECT doc_id, unnest(regexp_extract_all(t, '{SENTENCE}')) AS s, unnest(range(len(regexp_extract_all(t, '{SENTENCE}')))) AS p FROM spoken),
words AS (SELECT *, regexp_extract_all(lower(s), '[\\p{{L}}\\p{{N}}_]+') AS w FROM parts),
judged AS (SELECT *, len([i FOR i IN range(1, len(w) + 1) IF list_contains({_list(SUBJECT_WORDS)}, w[i])
  AND list_has_any(w[greatest(1, i - 4) : i + 4], {_list(ABSENCE_WORDS)})]) > 0 AS evades FROM words),
kept AS (SELECT doc_id, bool_or(evades) AS cut, coalesce(string_agg(s, '' ORDER BY p) FILTER (NOT evades), '') AS k FROM judged GROUP BY 1)
SELECT doc_id, CASE WHEN cut THEN regexp_replace(regexp_replace(k, '^{BLANK}+', ''), '{BLANK}+$', '') ELSE t END AS cleaned
FROM spoken LEFT JOIN kept USING (doc_id)""")
def evasion_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evasions that name no refusal phrase, and near misses: a subject far from an absence word, an absence without a subject."""
    spoken = F.col("text")
    for lang, said in EVASIONS.items():
        spoken = F.when(F.col("lang") == lang, F.concat(F.lit(said), "text")).otherwise(spoken)
    rows = a.table(spark, sf_dir, "documents").select("doc_id", spoken.alias("t"))
    return rows.select("doc_id", tx.drop_evasions("t").alias("cleaned"))


@query(f"SELECT doc_id, {_drop_sql('text', '(?i)licen[cs]e')} AS cleaned FROM documents")
def pattern_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same filter with a pattern that the documents really hold."""
    return a.table(spark, sf_dir, "documents").select("doc_id", tx.drop_sentences("text", "(?i)licen[cs]e").alias("cleaned"))


@query(f"""WITH spoken AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN text || ' The duration of the song is ' || turn || ' s.'
    ELSE text END AS t FROM conversations)
SELECT conv_id, turn, {_drop_sql('t', '(?i)duration of the (?:piece|track|song)')} AS cleaned FROM spoken""")
def duration_leak(spark: SparkSession, sf_dir: str) -> DataFrame:
    leak = F.concat("text", F.lit(" The duration of the song is "), a.text("turn"), F.lit(" s."))
    spoken = F.when(F.col("role") == "user", leak).otherwise(F.col("text"))
    return a.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", tx.drop_duration_leaks(spoken).alias("cleaned")
    )


@query(rf"""WITH answers AS (SELECT conv_id, turn, '- Speaker: ' || role || chr(10) || replace(text, chr(10), chr(10) || ' • Line: ') AS t
  FROM conversations),
lines AS (SELECT conv_id, turn, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) - 1 AS position FROM answers)
SELECT conv_id, turn, CAST(position AS INT) AS position, regexp_extract(line, '^\s*[-•*]\s+([^:\n]+?)\s*:\s*(.*)$', 1) AS label,
  regexp_replace(regexp_extract(line, '^\s*[-•*]\s+([^:\n]+?)\s*:\s*(.*)$', 2), '{BLANK}+$', '') AS answer
FROM lines WHERE regexp_extract(line, '^\s*[-•*]\s+([^:\n]+?)\s*:\s*(.*)$', 1) <> ''""")
def bullet_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    answer = F.concat(F.lit("- Speaker: "), "role", F.lit("\n"), F.replace("text", F.lit("\n"), F.lit("\n • Line: ")))
    rows = a.table(spark, sf_dir, "conversations").select("conv_id", "turn", answer.alias("t"))
    return rows.select("conv_id", "turn", F.inline(tx.bullet_fields("t")))


@query(rf"""WITH bare AS (SELECT doc_id, regexp_replace(regexp_replace(text, '^{BLANK}+', ''), '{BLANK}+$', '') AS t FROM documents),
counted AS (SELECT doc_id, t, CASE WHEN t = '' THEN 0 ELSE len(string_split_regex(t, '[\s\x0b\x85\p{{Z}}]+')) END AS words FROM bare)
SELECT doc_id, words, words BETWEEN 60 AND 120 AS in_rule, length(t) > 4096 AS too_long FROM counted""")
def word_count_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.table(spark, sf_dir, "documents").select(
        "doc_id", tx.word_count("text").cast("bigint").alias("words"), tx.in_length_rule("text").alias("in_rule"),
        config.breaks_max_length("text").alias("too_long"),
    )


@query(rf"""SELECT doc_id, regexp_replace(regexp_replace(text, '^{BLANK}+', ''), '{BLANK}+$', '') AS stripped FROM documents""")
def strip_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.table(spark, sf_dir, "documents").select("doc_id", tx.strip("text").alias("stripped"))
