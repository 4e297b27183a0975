"""Manifest maintenance: scan filter, paths, tags, what is left to do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from trackloom.functions import paths
from trackloom.model import AUDIO_SUFFIXES
from trackloom.operators import json_keys, quality, resume, windows
from trackloom.plans import adapters as a
from trackloom.plans.registry import query
from trackloom.session import shared_path
from trackloom.sinks.documents import write_manifest
from trackloom.sources.manifests import read_manifest_globals, read_manifest_lines, track_tags


@query(f"""WITH {a.TAKES},
done AS (SELECT DISTINCT file FROM takes WHERE doc_id IN (SELECT doc_id FROM labels))
SELECT doc_id, path FROM takes WHERE NOT EXISTS (SELECT 1 FROM done WHERE done.file = takes.file)""")
def manifest_remaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resume.remaining_tracks(a.takes(spark, sf_dir), a.done_takes(spark, sf_dir))


@query(f"""WITH {a.TAKES}
SELECT doc_id, path FROM takes WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def manifest_remaining_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resume.remaining_tracks(a.takes(spark, sf_dir), a.done_takes(spark, sf_dir), key="path")


@query(f"""WITH {a.TAKES},
flagged AS (SELECT file IN (SELECT file FROM takes WHERE doc_id IN (SELECT doc_id FROM labels)) AS d FROM takes)
SELECT count(*) AS total_before, count(*) FILTER (d) AS total_done, count(*) FILTER (NOT d) AS total_left,
  true AS balanced FROM flagged""")
def manifest_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resume.conservation(a.takes(spark, sf_dir), a.done_takes(spark, sf_dir))


@query(f"""WITH {a.TAKES}
SELECT DISTINCT file FROM takes WHERE doc_id IN (SELECT doc_id FROM labels)""")
def done_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.done_takes(spark, sf_dir).select("file").distinct()


@query(f"""WITH {a.TRACKS}
SELECT path, lower(regexp_extract(path, '[.]([^.]+)$', 1)) IN ('mp3', 'wav', 'flac') AS in_ordered,
  lower(regexp_extract(path, '[.]([^.]+)$', 1)) IN ('mp3', 'wav') AS in_windowed
FROM tracks WHERE lower(regexp_extract(path, '[.]([^.]+)$', 1)) IN ('mp3', 'wav', 'flac', 'm4a', 'ogg')""")
def scan_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = a.tracks(spark, sf_dir).where(paths.has_suffix("path", AUDIO_SUFFIXES["keyed"]))
    return found.select(
        "path", paths.has_suffix("path", AUDIO_SUFFIXES["ordered"]).alias("in_ordered"),
        paths.has_suffix("path", AUDIO_SUFFIXES["windowed"]).alias("in_windowed"),
    )


@query(f"""WITH {a.TRACKS}
SELECT path, regexp_extract(path, '[^/]+$') AS file, regexp_replace(regexp_extract(path, '[^/]+$'), '[.][^.]+$', '') AS stem,
  lower(regexp_extract(path, '[.][^./]+$')) AS suffix, regexp_extract(path, '^(.*)/', 1) AS folder,
  CASE WHEN path LIKE 'src1/%' THEN substr(path, 6) END AS below_src1
FROM tracks""")
def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.tracks(spark, sf_dir).select(
        "path", paths.file_name("path").alias("file"), paths.stem("path").alias("stem"),
        paths.suffix("path").alias("suffix"), paths.parent("path").alias("folder"),
        paths.relative_to("path", "src1").alias("below_src1"),
    )


@query(r"""SELECT page_id, regexp_extract(url, '[^/]*$') AS file,
  lower(regexp_extract(regexp_extract(url, '[^/]*$'), '^.+([.][^.]+)$', 1)) AS suffix FROM pages""")
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path parts of names this package did not make: page addresses."""
    return a.table(spark, sf_dir, "pages").select(
        "page_id", paths.file_name("url").alias("file"), paths.suffix("url").alias("suffix")
    )


@query(f"""WITH {a.TRACKS},
named AS (SELECT path, regexp_replace(regexp_extract(path, '[^/]+$'), '[.][^.]+$', '') AS stem FROM tracks)
SELECT path, TRY_CAST(nullif(regexp_extract(stem, '^([0-9]+)[.\\s_-]+(.+)$', 1), '') AS BIGINT) AS track_number,
  CASE WHEN regexp_matches(stem, '^([0-9]+)[.\\s_-]+(.+)$')
    THEN trim(regexp_extract(stem, '^([0-9]+)[.\\s_-]+(.+)$', 2)) ELSE stem END AS title
FROM named""".replace("\\\\", "\\"))
def filename_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    stem = paths.stem("path")
    return a.tracks(spark, sf_dir).select(
        "path", paths.name_track_number(stem).alias("track_number"), paths.name_title(stem).alias("title")
    )


def _embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    lang = F.col("lang")
    return a.tracks(spark, sf_dir).withColumns({
        "artist": F.col("source"),
        "own_title": F.when(lang.isin("fr", "es"), F.concat(F.lit("Title "), a.text("doc_id"))),
        "own_number": F.when(lang == "en", F.concat(F.lit(" 7/"), a.text("n_chars"))).when(lang == "fr", "x/9"),
    })


@query(f"""WITH {a.TRACKS}
SELECT path, source AS artist,
  CASE WHEN lang IN ('fr', 'es') THEN 'Title ' || doc_id ELSE 'Doc ' || doc_id END AS title,
  CASE lang WHEN 'en' THEN '7' WHEN 'fr' THEN CAST(n_chars AS VARCHAR) WHEN 'de' THEN CAST(n_chars AS VARCHAR) END AS track_number
FROM tracks""")
def tag_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    stem = paths.stem("path")
    own = F.create_map(
        F.lit("artist"), F.col("artist"), F.lit("title"), F.col("own_title"),
        F.lit("track_number"), paths.position_number("own_number").cast("string"),
    )
    from_name = F.create_map(
        F.lit("title"), paths.name_title(stem), F.lit("track_number"), paths.name_track_number(stem).cast("string")
    )
    merged = _embedded(spark, sf_dir).select("path", paths.merge_tags(own, from_name).alias("tags"))
    return merged.select("path", *[
        F.try_element_at("tags", F.lit(k)).alias(k) for k in ("artist", "title", "track_number")
    ])


@query(f"""WITH {a.TRACKS},
numbers AS (SELECT source, CASE lang WHEN 'en' THEN 7 WHEN 'fr' THEN 8 WHEN 'de' THEN n_chars END AS track_number,
    CASE WHEN lang <> 'es' THEN n_chars END AS name_number FROM tracks),
per AS (SELECT source, track_number, count(*) AS n,
    count(*) FILTER (track_number <> name_number) AS d FROM numbers GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, track_number) AS rn
    FROM per WHERE track_number IS NOT NULL),
totals AS (SELECT source, CAST(sum(n) AS BIGINT) AS tracks, CAST(sum(d) AS BIGINT) AS differing FROM per GROUP BY source)
SELECT totals.source, tracks, differing, track_number AS common_number, n AS common_count
FROM totals LEFT JOIN ranked ON totals.source = ranked.source AND rn = 1""")
def tag_number_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    lang = F.col("lang")
    numbered = a.tracks(spark, sf_dir).select(
        "source",
        F.when(lang == "en", F.lit(7)).when(lang == "fr", F.lit(8)).when(lang == "de", F.col("n_chars"))
        .cast("bigint").alias("track_number"),
        paths.name_track_number(paths.stem("path")).alias("name_number"),
    )
    return quality.tag_number_check(numbered, "source")


@query(f"""WITH {a.TRACKS}
SELECT path, 'out/' || regexp_replace(regexp_extract(path, '[^/]+$'), '[.][^.]+$', '') || '.caption.json' AS record_path,
  regexp_replace(path, '[.][^./]+$', '') || '.json' AS sibling,
  CASE WHEN path LIKE 'src1/%' THEN 'mp3s/' || regexp_replace(substr(path, 6), '[.][^./]+$', '') || '.mp3' END AS mirrored
FROM tracks""")
def output_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.tracks(spark, sf_dir).select(
        "path", paths.record_path("path", "out/").alias("record_path"),
        paths.sibling_path("path", ".json").alias("sibling"),
        paths.mirrored_path("path", "src1", "mp3s", ".mp3").alias("mirrored"),
    )


@query(f"""WITH {a.TAKES}
SELECT n AS name, tracks, first_path, last_path FROM (
  SELECT regexp_replace(file, '[.][^.]+$', '') AS n, count(*) AS tracks, min(path) AS first_path, max(path) AS last_path
  FROM takes GROUP BY 1) WHERE tracks > 1""")
def name_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.name_collisions(a.takes(spark, sf_dir))


@query(f"""WITH {a.TAKES}
SELECT file AS name, path, tracks FROM (SELECT file, path, count(*) OVER (PARTITION BY file) AS tracks FROM takes)
WHERE tracks > 1""")
def collision_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.collision_members(a.takes(spark, sf_dir), by="basename")


@query(f"""WITH {a.TRACKS}
SELECT path, row_number() OVER (ORDER BY path) AS by_text,
  row_number() OVER (ORDER BY string_split(path, '/')) AS by_folder FROM tracks""")
def order_by_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = a.tracks(spark, sf_dir).select("path")
    by_text = windows.positions(listed, ["path"], "by_text").drop("total")
    return windows.positions(by_text, [windows.by_components()], "by_folder").drop("total")


@query(f"""WITH {a.TRACKS}
SELECT path, '[' || row_number() OVER (ORDER BY path) || '/' || count(*) OVER () || ']' AS label FROM tracks""")
def progress_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.progress_index(a.tracks(spark, sf_dir).select("path")).select("path", "label")


@query("""SELECT 0 AS position, 'doc_id' AS column_name, 'bigint' AS type, count(*) AS rows, count(doc_id) AS non_null,
  CAST(NULL AS INT) AS min_length, CAST(NULL AS INT) AS max_length FROM documents
UNION ALL SELECT 1, 'text', 'string', count(*), count(text), min(length(text)), max(length(text)) FROM documents
UNION ALL SELECT 2, 'lang', 'string', count(*), count(lang), min(length(lang)), max(length(lang)) FROM documents
UNION ALL SELECT 3, 'source', 'string', count(*), count(source), min(length(source)), max(length(source)) FROM documents
UNION ALL SELECT 4, 'n_chars', 'bigint', count(*), count(n_chars), NULL, NULL FROM documents""")
def profile_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.profile_collection(a.table(spark, sf_dir, "documents"))


_DOC = """CASE WHEN event_id % 11 = 0 THEN '{"cut": ' WHEN event_id % 17 <> 0 THEN
  concat('{"id": ', event_id, ', "', event_type, '": ', props, ', "value": ', CASE event_id % 4 WHEN 0 THEN concat(user_id, '')
  WHEN 1 THEN concat('"', event_type, '"') WHEN 2 THEN 'null' ELSE concat('[', user_id, ', "', event_type, '"]') END, '}') END"""


@query(f"""WITH docs AS (SELECT {_DOC} AS doc FROM events),
good AS (SELECT json(doc) AS j FROM docs WHERE json_valid(doc)),
one AS (SELECT key AS path, json_extract(j, '$."' || key || '"') AS j FROM (SELECT j, unnest(json_keys(j)) AS key FROM good)),
two AS (SELECT path || '.' || key AS path, json_extract(j, '$."' || key || '"') AS j
  FROM (SELECT path, j, unnest(json_keys(j)) AS key FROM one WHERE json_type(j) = 'OBJECT')
  UNION ALL SELECT path || '[]', unnest(json_extract(j, '$[*]')) FROM one WHERE json_type(j) = 'ARRAY'),
every AS (SELECT '' AS path, j FROM good UNION ALL SELECT * FROM one UNION ALL SELECT * FROM two),
typed AS (SELECT path, CASE json_type(j) WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'string'
  WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' ELSE 'number' END AS kind,
  CASE json_type(j) WHEN 'OBJECT' THEN len(json_keys(j)) WHEN 'ARRAY' THEN json_array_length(j)
  WHEN 'VARCHAR' THEN length(json_extract_string(j, '$')) END AS length FROM every
  UNION ALL SELECT '', CASE WHEN doc IS NULL THEN 'missing' ELSE 'invalid' END, NULL FROM docs WHERE doc IS NULL OR NOT json_valid(doc))
SELECT path, count(*) AS "values", {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in (*json_keys.KINDS, 'invalid', 'missing'))},
  CAST(min(length) AS INT) AS min_length, CAST(max(length) AS INT) AS max_length FROM typed GROUP BY path""")
def json_key_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose keys and types differ from row to row; some are cut short and some are missing."""
    docs = a.table(spark, sf_dir, "events").select(F.expr(_DOC).alias("doc"))
    return json_keys.json_key_profile(docs, "doc")


@query(f"""WITH {a.TRACKS} SELECT path FROM tracks ORDER BY path LIMIT 1""")
def first_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.first_item(a.tracks(spark, sf_dir).select("path"), ["path"])


@query(f"""WITH {a.TAKES}
SELECT path, source AS artist, CAST(n_chars AS VARCHAR) AS track_number, 'm1' AS model_id
FROM takes JOIN documents USING (doc_id)""")
def manifest_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a manifest in parallel, read it back in parallel."""
    path = shared_path(spark, "manifest")
    tags = F.struct(F.col("source").alias("artist"), F.col("n_chars").alias("track_number"))
    entries = a.table(spark, sf_dir, "documents").select(
        F.concat("source", F.lit("/"), a.text("doc_id"), F.lit("/"), a.text("n_chars"), F.lit(". Take.mp3")).alias("path"),
        tags.alias("tags"),
    )
    settings = spark.range(1).select(F.lit("m1").alias("model_id"), F.lit(512).alias("max_new_tokens"))
    write_manifest(settings, entries, path)
    model = F.broadcast(read_manifest_globals(spark, path).select(F.col("globals")["model_id"].alias("model_id")))
    back = read_manifest_lines(spark, path)
    tag = track_tags(F.col("track"))
    rows = back.select(
        F.col("track")["path"].alias("path"), tag["artist"].alias("artist"), tag["track_number"].alias("track_number"),
        F.lit(1).alias("_one"),
    )
    return rows.join(model.withColumn("_one", F.lit(1)), "_one").drop("_one")
