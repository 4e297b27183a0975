"""What is done, what is pending, and the current state of a response log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from trackloom.functions import paths
from trackloom.functions.text import quoted
from trackloom.model import ERROR, FATAL_ERROR_PATTERN, MESSAGES, OK
from trackloom.sources.catalog import Catalog


def remaining_tracks(tracks: DataFrame, done: DataFrame, path: str = "path", key: str = "basename") -> DataFrame:
    """Manifest entries that are not done yet.

    ``key="basename"`` compares file names, as older done lists do, and drops
    same-named tracks of other albums too; ``key="path"`` compares whole paths.
    One basename may be on a third of all tracks; an anti-join is one that Spark splits when it is skewed.
    """
    mine, theirs = _done_key(path, key)
    finished = done.select(theirs.alias("_key")).where(F.col("_key").isNotNull()).distinct()
    return tracks.withColumn("_key", mine).join(finished, "_key", "left_anti").drop("_key")


def with_done(tracks: DataFrame, done: DataFrame, path: str = "path", key: str = "basename") -> DataFrame:
    """All manifest entries, with ``is_done``: what ``remaining_tracks`` drops, so that one pass can count and filter."""
    mine, theirs = _done_key(path, key)
    finished = done.select(theirs.alias("_key")).where(F.col("_key").isNotNull()).distinct().withColumn("_found", F.lit(True))
    flagged = tracks.withColumn("_key", mine).join(finished, "_key", "left")
    return flagged.withColumn("is_done", F.coalesce("_found", F.lit(False))).drop("_key", "_found")


def _done_key(path: str, key: str) -> tuple[Column, Column]:
    """What is compared, of a track and of a done row."""
    if key not in ("basename", "path"):
        raise ValueError(f"key is 'basename' or 'path', not {key!r}")
    return (F.col(path), F.col("path")) if key == "path" else (paths.file_name(path), F.col("file"))


def conservation(
    tracks: DataFrame, done: DataFrame, path: str = "path", key: str = "basename", left: DataFrame | None = None,
) -> DataFrame:
    """Counts before, done and remaining. ``balanced`` holds if the done and the remaining make up all.

    The remaining are counted in ``left``, such as a manifest that was written,
    or else in the result of ``remaining_tracks``; the done by a join of their
    own, which sees each key once.
    """
    mine, theirs = _done_key(path, key)
    per_key = tracks.groupBy(mine.alias("_key")).agg(F.count("*").alias("n"))
    finished = done.select(theirs.alias("_key")).where(F.col("_key").isNotNull()).distinct().withColumn("is_done", F.lit(True))
    left = remaining_tracks(tracks, done, path, key) if left is None else left
    zero = F.lit(0).cast("bigint")
    parts = per_key.join(finished, "_key", "left").select(
        "n", F.when(F.col("is_done"), F.col("n")).otherwise(zero).alias("done"), zero.alias("left")
    ).union(left.agg(F.count("*").alias("left")).select(zero, zero, "left"))
    totals = parts.agg(
        F.sum("n").alias("total_before"), F.sum("done").alias("total_done"), F.sum("left").alias("total_left")
    )
    return totals.withColumn("balanced", F.col("total_before") == F.col("total_done") + F.col("total_left"))


def latest_state(
    log: DataFrame, keys: tuple[str, ...] = ("track_id", "category"),
    order: tuple[str, ...] = ("updated_at",),
) -> DataFrame:
    """The newest row per key of an append-only log.

    ``max`` over a struct that starts with the order columns: partial results
    are made before the shuffle, so a pair with a third of all rows is a few
    rows by then. A ranking window would send all of them to one task.
    """
    rest = [c for c in log.columns if c not in keys and c not in order]
    newest = log.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_n"))
    return newest.select(*keys, *[F.col("_n")[c].alias(c) for c in log.columns if c not in keys])


def upsert_state(
    state: DataFrame, results: DataFrame, keys: tuple[str, ...] = ("track_id", "category"),
    order: tuple[str, ...] = ("updated_at",),
) -> DataFrame:
    """State after new results: the newest per key wins, other keys are kept."""
    return latest_state(state.unionByName(results, allowMissingColumns=True), keys, order)


def fan_out(tracks: DataFrame, catalog: Catalog) -> DataFrame:
    """Every track with every prompt, in catalogue order. Narrow: no join, no shuffle."""
    return tracks.select("*", F.inline(catalog.as_array()))


def ok_categories(log: DataFrame, catalog: Catalog, order: tuple[str, ...] = ("updated_at",)) -> DataFrame:
    """Per track, the catalogue categories whose newest row is ok. One shuffle, by track.

    The array is no longer than the catalogue.
    """
    newest = [
        F.max_by("status", F.when(F.col("category") == k, F.struct(*order))).alias(f"_s{i}")
        for i, k in enumerate(catalog.keys)
    ]
    wide = log.where(F.col("category").isin(catalog.keys)).groupBy("track_id").agg(*newest)
    return wide.select("track_id", F.array_compact(F.array(*[
        F.when(F.col(f"_s{i}") == OK, F.lit(k)) for i, k in enumerate(catalog.keys)
    ])).alias("ok_categories"))


def pending_prompts(
    tracks: DataFrame, log: DataFrame, catalog: Catalog, overwrite: bool = False,
    order: tuple[str, ...] = ("updated_at",),
) -> DataFrame:
    """Tracks with the prompts still to run, one row per track and ``prompts`` array.

    Failed and missing categories are retried; ``overwrite`` keeps all. The
    join is at track grain, one row per track on both sides, before any
    fan-out. Tracks with nothing to do are dropped.
    """
    if overwrite:
        return tracks.withColumn("prompts", catalog.as_array())
    done = ok_categories(log, catalog, order)
    none = F.array().cast("array<string>")
    joined = tracks.join(done, "track_id", "left").withColumn("ok_categories", F.coalesce("ok_categories", none))
    todo = F.filter(catalog.as_array(), lambda p: ~F.array_contains(F.col("ok_categories"), p["category"]))
    return joined.withColumn("prompts", todo).drop("ok_categories").where(F.size("prompts") > 0)


def pending_pairs(
    tracks: DataFrame, log: DataFrame, catalog: Catalog, overwrite: bool = False,
    order: tuple[str, ...] = ("updated_at",),
) -> DataFrame:
    """``pending_prompts`` as (track, ord, category, prompt) rows."""
    pending = pending_prompts(tracks, log, catalog, overwrite, order)
    others = [c for c in pending.columns if c != "prompts"]
    return pending.select(*others, F.inline("prompts"))


def load_state(tracks: DataFrame, state: DataFrame, catalog: Catalog) -> DataFrame:
    """Each track with its record so far; an empty map of statuses for a new one.

    Categories that the catalogue does not list stay in the map. ``state`` holds
    each (track, category) once.
    """
    per_track = state.where(F.col("category").isNotNull()).groupBy("track_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "status")))).alias("categories")
    )
    empty = F.expr("map()").cast("map<string,string>")
    return tracks.join(per_track, "track_id", "left").withColumn("categories", F.coalesce("categories", empty))


def with_existence(tracks: DataFrame, scan: DataFrame, path: str = "path", scan_path: str = "path") -> DataFrame:
    """Tracks with ``exists``: whether the scan has their path."""
    found = scan.select(F.col(scan_path).alias(path)).distinct().withColumn("_hit", F.lit(True))
    return tracks.join(found, path, "left").withColumn("exists", F.col("_hit").isNotNull()).drop("_hit")


def missing_file_errors(tracks: DataFrame, scan: DataFrame, catalog: Catalog, path: str = "path") -> DataFrame:
    """An error row per prompt of each track whose file is not there; the run goes on."""
    found = scan.select(F.col("path").alias(path)).distinct()
    lost = tracks.join(found, path, "left_anti")
    message = F.concat(F.lit(MESSAGES["not_found"].removesuffix("%s")), quoted(path))
    return fan_out(lost, catalog).withColumns({"status": F.lit(ERROR), "error": message})


def is_fatal(error: Column | str = "error", pattern: str = FATAL_ERROR_PATTERN) -> Column:
    error = F.col(error) if isinstance(error, str) else error
    return F.coalesce(error.rlike(pattern), F.lit(False))


def fatal_cutoff(
    results: DataFrame, run: str, order: tuple[str, ...], fatal: Column | str = "fatal",
) -> DataFrame:
    """Every row of a run after its first fatal error becomes a skipped error row.

    The first fatal position is a minimum per run (partial before the shuffle),
    joined back: one row per run, which Spark broadcasts when it is small. No
    window over a run.
    """
    fatal = F.col(fatal) if isinstance(fatal, str) else fatal
    position = F.struct(*order)
    first = results.groupBy(run).agg(F.min(F.when(fatal, position)).alias("_first"))
    joined = results.join(first, run, "left")
    skipped = F.coalesce(position > F.col("_first"), F.lit(False))
    return joined.withColumns({
        "skipped": skipped,
        "status": F.when(skipped, ERROR).otherwise(F.col("status")),
        "error": F.when(skipped, MESSAGES["skipped"]).otherwise(F.col("error")),
    }).drop("_first")
