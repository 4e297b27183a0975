"""Durations, landmark windows, coverage and waveforms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trackloom.functions import scalars
from trackloom.model import MESSAGES
from trackloom.operators import annotate, quality, summarize, windows
from trackloom.plans import adapters as a
from trackloom.plans.registry import query
from trackloom.sources.catalog import DETAILED
from trackloom.sources.wav import decode_wav

AUDIO = """audio AS (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) * 44 AS total_frames, 44100 AS sample_rate,
  floor(o_totalprice) / 10 AS seconds FROM orders)"""


def _audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Track lengths from a second to minutes, in frames and in seconds."""
    price = F.floor("o_totalprice")
    return a.table(spark, sf_dir, "orders").select(
        "o_orderkey", (price * 44).alias("total_frames"), F.lit(44100).alias("sample_rate"), (price / 10).alias("seconds")
    )


WINDOWS = f"""{AUDIO},
spans AS (SELECT *, total_frames / sample_rate AS len FROM audio),
four AS (SELECT *, unnest([0, 1, 2, 3]) AS chunk_index, unnest(['start', 'early', 'pre_mid', 'post_mid']) AS label,
  unnest([0, 40, len / 2 - 40, len / 2]) AS s0, unnest([40, 80, len / 2, len / 2 + 40]) AS e0 FROM spans),
cut AS (SELECT *, greatest(0, s0) AS s, least(len, e0) AS e FROM four),
windows AS (SELECT o_orderkey, chunk_index, label, round_even(s, 3) AS start_seconds,
  round_even(least(CAST(floor(e * sample_rate) AS BIGINT), total_frames) / sample_rate, 3) AS end_seconds FROM cut WHERE e > s)"""


@query(f"WITH {WINDOWS} SELECT * FROM windows")
def landmark_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = windows.landmark_windows(_audio(spark, sf_dir))
    return cut.select("o_orderkey", "chunk_index", "label", "start_seconds", "end_seconds")


_ANSWERS = "/".join(MESSAGES["dry_run"] % key for key in DETAILED.keys)


@query(f"""WITH {WINDOWS}
SELECT o_orderkey, count(*) AS total_chunks, string_agg(label, ',' ORDER BY chunk_index) AS labels, 4 * count(*) AS captions,
  string_agg(concat(chunk_index, '|', CAST(round(start_seconds * 1000) AS BIGINT), '|', CAST(round(end_seconds * 1000) AS BIGINT),
    '|', '{_ANSWERS.replace("'", "''")}'), ';' ORDER BY chunk_index) AS content
FROM windows GROUP BY 1""")
def nest_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows x prompts, answered by the dry run and nested into chunk records."""
    cut = windows.landmark_windows(_audio(spark, sf_dir)).select(
        "o_orderkey", "chunk_index", "label", "start_seconds", "end_seconds", F.inline(DETAILED.as_array())
    )
    nested = summarize.nest_windows(annotate.dry_run(cut), DETAILED.keys, ("o_orderkey",))
    captions = F.aggregate("chunks", F.lit(0), lambda n, c: n + F.size(c["captions"]))
    ms = lambda seconds: F.round(seconds * 1000).cast("bigint").cast("string")
    content = F.transform("chunks", lambda c: F.concat_ws(
        "|", c["chunk_index"].cast("string"), ms(c["start_seconds"]), ms(c["end_seconds"]), F.array_join(F.map_values(c["captions"]), "/"),
    ))
    return nested.select(
        "o_orderkey", F.col("total_chunks").cast("bigint").alias("total_chunks"),
        F.array_join(F.transform("chunks", lambda c: c["label"]), ",").alias("labels"),
        captions.cast("bigint").alias("captions"), F.array_join(content, ";").alias("content"),
    )


@query(f"WITH {AUDIO} SELECT o_orderkey, least(seconds, 300) AS capped, seconds AS uncapped FROM audio")
def effective_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audio(spark, sf_dir).select(
        "o_orderkey", scalars.effective_duration("seconds").alias("capped"),
        scalars.effective_duration("seconds", 0).alias("uncapped"),
    )


@query("""SELECT vec_id, least(len(embedding), 40) AS kept,
  array_to_string([CAST(floor(CAST(x AS DOUBLE) * 65536) AS BIGINT) FOR x IN embedding[1:40]], ',') AS samples FROM embeddings""")
def trim_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = a.table(spark, sf_dir, "embeddings")
    kept = scalars.trim_samples("embedding", F.lit(10), 4)
    whole = F.transform(kept, lambda x: F.floor(x.cast("double") * 65536).cast("bigint").cast("string"))
    return rows.select("vec_id", F.size(kept).cast("bigint").alias("kept"), F.array_join(whole, ",").alias("samples"))


@query("""SELECT l_orderkey, l_linenumber, l_linenumber * 30 AS covered_sec,
  l_linenumber * 30 < l_quantity * 6 - 30 AS gap FROM lineitem""")
def coverage_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", scalars.covered_seconds("l_linenumber").alias("covered_sec"),
        scalars.has_coverage_gap("l_linenumber", F.col("l_quantity") * 6).alias("gap"),
    )


@query("SELECT l_orderkey, l_linenumber, l_quantity >= l_linenumber * 6 AS truncated FROM lineitem")
def truncation_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", scalars.is_truncated("l_quantity", F.col("l_linenumber") * 6).alias("truncated")
    )


@query(f"""WITH {AUDIO}
SELECT o_orderkey, CASE WHEN seconds < 60 THEN printf('%.1fs', seconds)
  WHEN seconds < 3600 THEN printf('%dm %.1fs', CAST(floor(seconds / 60) AS INT), seconds % 60)
  ELSE printf('%dh %dm %.1fs', CAST(floor(seconds / 3600) AS INT), CAST(floor((seconds % 3600) / 60) AS INT), seconds % 60) END AS duration
FROM audio""")
def duration_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audio(spark, sf_dir).select("o_orderkey", scalars.duration_text("seconds").alias("duration"))


@query("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS with_offset,
  strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') || 'Z' AS zulu FROM events""")
def utc_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.table(spark, sf_dir, "events").select(
        "event_id", scalars.iso_utc("ts").alias("with_offset"),
        scalars.iso_utc(F.date_trunc("second", "ts").cast("timestamp_ntz"), zulu=True).alias("zulu"),
    )


@query(f"""WITH {a.LOG}
SELECT event_id, CASE WHEN error IS NULL THEN 'ok' ELSE 'error' END AS status, error,
  CASE WHEN error IS NULL THEN coalesce(output, '') END AS output FROM log""")
def inband_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors hidden in the answer text, as the windowed tool writes them."""
    answered = a.log(spark, sf_dir).select(
        "event_id", F.coalesce(F.concat(F.lit("ERROR: "), "error"), "output", F.lit("")).alias("output")
    )
    return annotate.split_error_answers(answered)


def _samples() -> Column:
    return (
        F.when(F.col("label") == 1, F.concat("embedding", F.array(F.lit(float("nan")).cast("float"))))
        .when(F.col("label") == 2, F.concat("embedding", F.array(F.lit(float("-inf")).cast("float"))))
        .when(F.col("label") == 3, F.array().cast("array<float>"))
        .otherwise(F.col("embedding"))
    )


@query("""SELECT vec_id, CASE WHEN label = 3 THEN 'Decoded audio waveform is empty.'
  WHEN label = 1 THEN 'Audio waveform contains NaN values.' WHEN label = 2 THEN 'Audio waveform contains infinite values.'
  WHEN vec_id = 0 THEN 'Invalid audio duration: 0.00s.'
  WHEN vec_id * 5 > 1200 THEN printf('Audio duration (%.2fs) exceeds the model''s maximum of 1200s (20 minutes). Trim the file and retry.', vec_id * 5.0::DOUBLE)
  END AS error FROM embeddings""")
def waveform_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = a.table(spark, sf_dir, "embeddings").select(
        "vec_id", _samples().alias("samples"), (F.col("vec_id") * 5.0).alias("duration")
    )
    return rows.select("vec_id", quality.waveform_error("samples", "duration").alias("error"))


def _little_endian(value: Column, width: int) -> Column:
    """The low bytes of a whole number as hex text, lowest byte first."""
    digits = F.lpad(F.hex(value.bitwiseAND(F.lit(256**width - 1))), 2 * width, "0")
    return F.concat(*[F.substr(digits, F.lit(2 * i - 1), F.lit(2)) for i in range(width, 0, -1)])


def _wav_bytes(samples: Column, sample_rate: int) -> Column:
    """A mono 16-bit PCM WAV file around whole-number samples."""
    size = F.size(samples).cast("bigint") * 2
    number = lambda v, width: _little_endian(F.lit(v).cast("bigint") if isinstance(v, int) else v, width)
    tag = lambda s: F.lit(s.encode().hex())
    header = [
        tag("RIFF"), number(size + 36, 4), tag("WAVEfmt "), number(16, 4), number(1, 2), number(1, 2),
        number(sample_rate, 4), number(sample_rate * 2, 4), number(2, 2), number(16, 2), tag("data"), number(size, 4),
    ]
    body = F.array_join(F.transform(samples, lambda x: _little_endian(x, 2)), "")
    return F.unhex(F.concat(*header, body))


@query("""SELECT CAST(vec_id AS VARCHAR) AS path, 16000 AS sample_rate, len(embedding) AS n_frames,
  len(embedding) / 16000 AS duration_sec,
  CAST(list_sum([floor(CAST(x AS DOUBLE) * 10000) FOR x IN embedding]) AS BIGINT) AS pcm_sum
FROM embeddings""")
def wav_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors written as WAV bytes and decoded again."""
    pcm = F.transform("embedding", lambda x: F.floor(x.cast("double") * 10000).cast("bigint"))
    files = a.table(spark, sf_dir, "embeddings").select(
        a.text("vec_id").alias("path"), _wav_bytes(pcm, 16000).alias("content")
    )
    total = F.aggregate("samples", F.lit(0).cast("bigint"), lambda s, x: s + F.round(x * 32768).cast("bigint"))
    return decode_wav(files).select("path", "sample_rate", "n_frames", "duration_sec", total.alias("pcm_sum"))
