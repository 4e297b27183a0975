"""Consensus over windows, and pairing of passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trackloom.operators import consensus as c
from trackloom.plans import adapters as a
from trackloom.plans.registry import query


def _tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.caption_tags(c.by_track(a.captions(spark, sf_dir)))


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.window_facts(c.by_track(a.captions(spark, sf_dir, "tempo_key")))


@query("""SELECT CAST(conv_id AS VARCHAR) AS track_id, turn AS chunk_index, tag FROM (SELECT conv_id, turn,
  lower(trim(unnest(string_split(text, ',')), ' ' || chr(9) || chr(10) || chr(13))) AS tag FROM conversations) WHERE tag <> ''""")
def caption_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = a.turns(spark, sf_dir).withColumnRenamed("prompt_ord", "chunk_index")
    return c.caption_tags(turns).select("track_id", "chunk_index", "tag")


@query(f"WITH {a.TAGS} SELECT track_id, dimension, tag, windows, windows >= 2 AS kept FROM votes")
def tag_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.tag_consensus(_tags(spark, sf_dir))


TOP = "top AS (SELECT track_id, max(windows) AS m FROM votes WHERE dimension = '{}' GROUP BY 1)"


@query(f"""WITH {a.TAGS}, {TOP.format('genre_style')}
SELECT v.track_id, tag AS genre, windows FROM votes v JOIN top USING (track_id) WHERE dimension = 'genre_style' AND windows = m""")
def genre_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.genre_consensus(a.captions(spark, sf_dir, "genre_style"))


@query(f"""WITH {a.TAGS}, {TOP.format('vocals')}
SELECT v.track_id, tag AS voice, windows, windows = m AS dominant FROM votes v JOIN top USING (track_id)
WHERE dimension = 'vocals' AND (windows = m OR windows >= 2)""")
def vocal_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.voice_consensus(a.captions(spark, sf_dir, "vocals"))


@query(f"WITH {a.TAGS} SELECT track_id, tag AS instrument, windows FROM votes WHERE dimension = 'instruments'")
def instrument_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.instrument_union(a.captions(spark, sf_dir, "instruments"))


@query("""WITH said AS (SELECT l_orderkey AS track_id, l_linenumber AS w, unnest(['guitar', 'acoustic guitar', 'acoustic guitar with fingerpicking',
    'pad', 'synth pad ' || CAST(round(l_tax * 100) AS INT)]) AS instrument, unnest([l_linenumber % 3 = 0, l_linenumber % 3 = 1,
    l_linenumber % 3 = 2, l_returnflag = 'A', true]) AS named FROM lineitem),
votes AS (SELECT track_id, instrument, count(DISTINCT w) AS windows, string_split(instrument, ' ') AS words FROM said WHERE named GROUP BY 1, 2)
SELECT track_id, instrument, windows FROM votes v WHERE NOT EXISTS (SELECT 1 FROM votes o WHERE o.track_id = v.track_id
  AND o.instrument <> v.instrument AND (list_has_all(o.words, v.words) OR list_has_all(v.words, o.words))
  AND (o.windows > v.windows OR (o.windows = v.windows AND (len(o.words) > len(v.words)
    OR (len(o.words) = len(v.words) AND o.instrument < v.instrument)))))""")
def instrument_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guitars and pads that the windows of a track describe at different length, settled to one description each."""
    line = F.col("l_linenumber")
    guitar = F.element_at(F.array(F.lit("guitar"), F.lit("Acoustic guitar"), F.lit("acoustic guitar with fingerpicking")), (line % 3 + 1).cast("int"))
    pads = F.concat(F.when(F.col("l_returnflag") == "A", F.lit(", Pad")).otherwise(F.lit("")), F.lit(", synth pad "), F.round(F.col("l_tax") * 100).cast("int"))
    said = a.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("track_id"), line.alias("chunk_index"), F.lit("instruments").alias("category"), F.concat(guitar, pads).alias("output")
    )
    return c.settle_variants(c.instrument_union(said))


@query(f"WITH {a.FACTS} SELECT * FROM facts")
def window_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.window_facts(a.captions(spark, sf_dir, "tempo_key"))


TEMPO = """seen AS (SELECT DISTINCT track_id, chunk_index, bpm FROM facts WHERE bpm IS NOT NULL),
tempo AS (SELECT track_id, min(bpm) AS low, max(bpm) AS high, median(bpm) AS median_bpm FROM seen GROUP BY 1)"""


@query(f"""WITH {a.FACTS}, {TEMPO}
SELECT *, high - low <= 5 AS consistent, CASE WHEN high - low <= 5 THEN printf('%.1f BPM', median_bpm)
  ELSE printf('%.1f', low) || '–' || printf('%.1f BPM', high) END AS tempo FROM tempo""")
def tempo_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.tempo_consensus(_facts(spark, sf_dir))


@query(f"""WITH {a.FACTS}, {TEMPO},
per_key AS (SELECT f.track_id, music_key, count(DISTINCT chunk_index) AS votes, min(abs(bpm - median_bpm)) AS distance
  FROM facts f JOIN tempo USING (track_id) GROUP BY 1, 2),
ranked AS (SELECT *, rank() OVER (PARTITION BY track_id ORDER BY votes DESC, distance) AS r FROM per_key),
best AS (SELECT track_id, CASE WHEN count(*) FILTER (r = 1) = 1 THEN min(music_key) FILTER (r = 1) END AS music_key,
  count(*) AS keys_named FROM ranked GROUP BY 1)
SELECT best.*, s.signature FROM best JOIN (SELECT track_id,
  CASE WHEN min(signature) = max(signature) THEN min(signature) ELSE '4/4' END AS signature FROM facts GROUP BY 1) s USING (track_id)""")
def key_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.key_consensus(_facts(spark, sf_dir))


def _pass(spark: SparkSession, sf_dir: str, role: str, before: str, after: str) -> DataFrame:
    """Each turn of one role, with tempo and key around its text."""
    said = a.turns(spark, sf_dir).where(F.col("category") == role)
    return said.select(
        F.col("track_id").alias("file"), F.col("prompt_ord").alias("updated_at"),
        F.concat(F.lit(before), "output", F.lit(after)).alias("output"),
    )


PASS_A = ("user", "Near 82 BPM in D minor. ", " The key is not available here.")
PASS_B = ("assistant", "The duration of the piece is long. ", " Near 104 BPM in C# major.")


def _pass_sql(name: str, role: str, before: str, after: str) -> str:
    return f"""{name} AS (SELECT CAST(conv_id AS VARCHAR) AS file, '{before}' || arg_max(text, turn) || '{after}' AS raw
  FROM conversations WHERE role = '{role}' GROUP BY 1)"""


PAIRS = f"""{_pass_sql('a', *PASS_A)}, {_pass_sql('b', *PASS_B)},
pairs AS (SELECT coalesce(a.file, b.file) AS file, a.raw AS pass_a_raw, b.raw AS pass_b_raw,
  CASE WHEN a.file IS NULL OR b.file IS NULL THEN 'error' ELSE 'ok' END AS status,
  CASE WHEN a.file IS NULL THEN 'pass A is missing' WHEN b.file IS NULL THEN 'pass B is missing' END AS error
  FROM a FULL JOIN b ON a.file = b.file)"""


@query(f"WITH {PAIRS} SELECT * FROM pairs")
def pair_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.pair_passes(_pass(spark, sf_dir, *PASS_A), _pass(spark, sf_dir, *PASS_B))


@query(f"""WITH {PAIRS},
trusted AS (SELECT *, coalesce(length(pass_a_raw) > length(pass_b_raw), false) AS longer FROM pairs)
SELECT file, status, error, CASE WHEN pass_b_raw IS NULL OR (longer AND pass_a_raw IS NOT NULL) THEN 82.0::DOUBLE ELSE 104.0::DOUBLE END AS bpm,
  CASE WHEN pass_b_raw IS NULL THEN 'D minor' ELSE 'C# major' END AS music_key,
  length(pass_a_raw) AS raw_a_chars, length(pass_b_raw) AS raw_b_chars,
  CASE WHEN pass_a_raw IS NOT NULL THEN pass_a_raw NOT LIKE '%BPM%' ELSE pass_b_raw NOT LIKE '%BPM%' END AS lost_tempo,
  false AS has_refusal
FROM trusted""")
def unified_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = c.pair_passes(_pass(spark, sf_dir, *PASS_A), _pass(spark, sf_dir, *PASS_B))
    longer = F.length("pass_a_raw") > F.length("pass_b_raw")
    routed = pairs.withColumn("reliable_dimensions", F.when(longer, F.array(F.lit("tempo"), F.lit("texture"))))
    description = F.col("description")
    return c.unified_record(routed).select(
        "file", "status", "error", "bpm", "music_key", F.length("pass_a_raw").cast("bigint").alias("raw_a_chars"),
        F.length("pass_b_raw").cast("bigint").alias("raw_b_chars"),
        (~F.contains(description, F.lit("BPM"))).alias("lost_tempo"),
        (F.contains(description, F.lit("not available")) | F.contains(description, F.lit("duration of"))).alias("has_refusal"),
    )


@query("""WITH a AS (SELECT CAST(conv_id AS VARCHAR) AS file, max(turn) AS t FROM conversations WHERE role = 'user' GROUP BY 1),
b AS (SELECT CAST(conv_id AS VARCHAR) AS file, max(turn) AS t FROM conversations WHERE role = 'assistant' GROUP BY 1),
p AS (SELECT coalesce(a.file, b.file) AS file, a.t AS ta, b.t AS tb FROM a FULL JOIN b ON a.file = b.file)
SELECT file, file || '!' AS tags, CASE WHEN ta % 2 = 0 AND tb IS NOT NULL THEN 'drum ' || tb WHEN ta IS NOT NULL THEN 'oud ' || ta
    WHEN tb IS NOT NULL THEN 'drum ' || tb END AS instruments,
  CASE WHEN tb IS NOT NULL THEN 'alto ' || tb END AS vocals, CASE WHEN ta IS NOT NULL THEN 'dry' END AS texture,
  CASE WHEN tb IS NOT NULL THEN 'i-iv ' || tb END AS harmony, CASE WHEN tb IS NOT NULL THEN '6/8' ELSE '4/4' END AS signature
FROM p""")
def unified_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled answers of two passes, routed by dimension; an even turn says that pass A is not to be trusted for instruments."""
    turn = a.text("prompt_ord")

    def told(role: str, *lines: Column | str) -> DataFrame:
        said = a.turns(spark, sf_dir).where(F.col("category") == role)
        return said.select(F.col("track_id").alias("file"), F.col("prompt_ord").alias("updated_at"), F.concat(
            *[F.lit(x) if isinstance(x, str) else x for x in lines]).alias("output"))

    first = told("user", "In 4/4.\n- Instruments: oud ", turn, "\n- Vocals: not available\n- Texture: dry")
    second = told("assistant", "- Instruments: drum ", turn, "\n- Vocals: alto ", turn, "\n- Harmony: i-iv ", turn, "\n6/8")
    pairs = c.pair_passes(first, second).withColumn("tags", F.concat("file", F.lit("!")))
    ord_a = F.regexp_extract("pass_a_raw", "oud ([0-9]+)", 1).try_cast("int")
    routed = pairs.withColumn("reliable_dimensions", F.when(ord_a % 2 == 0, F.array(F.lit("vocals"), F.lit("texture"))))
    return c.unified_record(routed, keep=("tags",)).select(
        "file", "tags", "instruments", "vocals", "texture", "harmony", "signature"
    )
