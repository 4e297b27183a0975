"""Roll-ups, run summaries, pivots and nested records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from trackloom.functions.paths import file_name, record_path
from trackloom.functions.scalars import whole_units
from trackloom.functions.text import cell_text, quoted
from trackloom.model import ERROR, MESSAGES, OK, PARTIAL, WINDOW_LABELS
from trackloom.operators.consensus import by_track
from trackloom.operators.resume import latest_state


def status_of(ok_count: Column | str, total: Column | str) -> Column:
    """ok when all are (no prompts at all included), error when none is, else partial."""
    ok_count = F.col(ok_count) if isinstance(ok_count, str) else ok_count
    total = F.col(total) if isinstance(total, str) else total
    return F.when(ok_count == total, OK).when(ok_count == 0, ERROR).otherwise(PARTIAL)


def track_rollup(responses: DataFrame, tracks: DataFrame | None = None, track: str = "track_id") -> DataFrame:
    """Per track: prompts, ok prompts, total seconds and status.

    Seconds add up as whole milliseconds, so the total does not depend on row order.
    With ``tracks`` the tracks without responses are kept; the join comes
    after the aggregate and has one row per track on both sides.
    """
    rolled = responses.groupBy(track).agg(
        F.count("*").alias("prompts_total"),
        F.count_if(F.col("status") == OK).alias("prompts_ok"),
        F.sum(whole_units("processing_time_sec")).alias("_ms"),
    )
    if tracks is not None:
        rolled = tracks.select(track).join(rolled, track, "left").fillna(0, ["prompts_total", "prompts_ok"])
    return rolled.select(
        track, "prompts_total", "prompts_ok",
        F.round(F.coalesce("_ms", F.lit(0)) / 1000, 1).alias("total_processing_time_sec"),
        status_of("prompts_ok", "prompts_total").alias("status"),
    )


def run_summary(rollup: DataFrame, prompts_per_track: int | None = None) -> DataFrame:
    """One row: tracks in all, ok, partial and failed."""
    totals = rollup.agg(
        F.count("*").alias("total_tracks"),
        F.count_if(F.col("status") == OK).alias("ok_count"),
        F.count_if(F.col("status") == PARTIAL).alias("partial_count"),
    ).withColumn("fail_count", F.col("total_tracks") - F.col("ok_count") - F.col("partial_count"))
    if prompts_per_track is not None:
        totals = totals.withColumn("prompts_per_track", F.lit(prompts_per_track))
    return totals


def summary_pivot(
    log: DataFrame, keys: list[str], by: tuple[str, ...] = ("file", "path"),
    order: tuple[str, ...] = ("updated_at",),
) -> DataFrame:
    """One row per track, one column per catalogue key with the newest cell text.

    Conditional aggregates instead of latest-then-pivot: one shuffle by track,
    with partial results before it, and all keys in one pass.
    """
    cells = log.select(*by, *order, "category", cell_text("status", "output", "error").alias("cell"))
    newest = [
        F.coalesce(F.max_by("cell", F.when(F.col("category") == k, F.struct(*order))), F.lit("[missing]")).alias(k)
        for k in keys
    ]
    return cells.groupBy(*by).agg(*newest)


def prompt_timing(responses: DataFrame, by: tuple[str, ...] = ("category",)) -> DataFrame:
    """Count, mean, min, median and max of seconds per prompt.

    Rows collapse to (prompt, seconds) counts first, and the median weighs the
    different values. Seconds add up as whole microseconds.
    """
    micros = whole_units("processing_time_sec", 1_000_000).alias("micros")
    counts = (
        responses.where(F.col("processing_time_sec").isNotNull())
        .groupBy(*by, micros).agg(F.count("*").alias("n"))
    )
    sec = F.col("micros") / 1_000_000
    return counts.groupBy(*by).agg(
        F.sum("n").alias("responses"),
        F.round(F.sum(F.col("micros") * F.col("n")) / (F.sum("n") * 1_000_000), 3).alias("mean_sec"),
        F.min(sec).alias("min_sec"),
        F.percentile(sec, 0.5, F.col("n")).alias("median_sec"),
        F.max(sec).alias("max_sec"),
    )


def nest_ordered(
    responses: DataFrame, track: str = "track_id", ord_col: str = "prompt_ord",
    fields: tuple[str, ...] = ("status", "output", "error"), order: tuple[str, ...] = (),
    part_size: int | None = None,
) -> DataFrame:
    """Responses back into arrays in prompt order: (track, part, responses).

    Each (track, prompt) is reduced to its newest row first. With ``part_size``
    a record holds so many prompts at most, and a track with more continues in
    the next part; without it a track is one record, part 0.
    """
    wanted = responses.select(track, ord_col, *fields, *[o for o in order if o not in fields])
    newest = latest_state(wanted, (track, ord_col), order or fields)
    part = F.expr(f"cast({ord_col} div {part_size} as bigint)") if part_size else F.lit(0).cast("bigint")
    return newest.groupBy(track, part.alias("part")).agg(
        F.array_sort(F.collect_list(F.struct(ord_col, *fields))).alias("responses")
    )


def nest_by_category(
    log: DataFrame, keys: list[str], by: tuple[str, ...] = ("track_id",),
    fields: tuple[str, ...] = ("status", "output", "error"), order: tuple[str, ...] = ("updated_at",),
) -> DataFrame:
    """The newest response of each category as a ``categories`` map.

    The categories of ``keys`` come first, in that order, then all others that
    the log has. Each (track, category) is reduced to its newest row before
    anything is gathered, so a map has one entry per category.
    """
    newest = latest_state(log.select(*by, "category", *fields, *[o for o in order if o not in fields]), (*by, "category"), order)
    known = F.array(*[F.lit(k) for k in keys]).cast("array<string>")
    place = F.coalesce(F.nullif(F.array_position(known, F.col("category")), F.lit(0)), F.lit(len(keys) + 1))
    entry = F.struct(place.alias("place"), "category", F.struct(*fields).alias("answer"))
    gathered = newest.where(F.col("category").isNotNull()).groupBy(*by).agg(F.array_sort(F.collect_list(entry)).alias("_e"))
    pairs = F.transform("_e", lambda e: F.struct(e["category"], e["answer"]))
    return gathered.select(*by, F.map_from_entries(pairs).alias("categories"))


def nest_windows(
    captions: DataFrame, keys: list[str], by: tuple[str, ...] = ("path",), order: tuple[str, ...] = (),
) -> DataFrame:
    """Window captions into ``chunks``, windows in order.

    A window beyond the labelled ones has no label. Of several answers of one
    window and prompt the newest by ``order`` counts, of equals the greatest
    text. A window's captions are one aggregate per prompt, and a track collects
    each of its windows once, whatever repeats the input holds.

    Captions move to their track's task once; the greatest texts need an order,
    which fits the memory of these tasks, but not always that of the tasks that
    read the captions.
    """
    newest = F.struct(*order, F.col("output"))
    used = captions.where(F.col("chunk_index").isNotNull()).select(
        *dict.fromkeys((*by, "chunk_index", "start_seconds", "end_seconds", "category", *order, "output"))
    )
    per_window = by_track(used, *by).groupBy(*by, "chunk_index").agg(
        F.min("start_seconds").alias("start_seconds"), F.min("end_seconds").alias("end_seconds"),
        *[F.max(F.when(F.col("category") == k, newest))["output"].alias(f"_{j}") for j, k in enumerate(keys)],
    )
    texts = F.map_filter(
        F.map_from_arrays(F.array(*[F.lit(k) for k in keys]), F.array(*[F.col(f"_{j}") for j in range(len(keys))])),
        lambda k, v: v.isNotNull(),
    )
    label = F.get(F.array(*[F.lit(w) for w in WINDOW_LABELS]), F.col("chunk_index"))
    chunk = F.struct("chunk_index", label.alias("label"), "start_seconds", "end_seconds", texts.alias("captions"))
    nested = per_window.groupBy(*by).agg(F.collect_list(chunk).alias("chunks"))
    in_order = F.array_sort("chunks", lambda x, y: x["chunk_index"] - y["chunk_index"])
    return nested.select(*by, in_order.alias("chunks"), F.size("chunks").alias("total_chunks"))


def flat_summary(results: DataFrame) -> DataFrame:
    """One row for runs of one prompt per track: tracks, succeeded, failed."""
    return results.agg(
        F.count("*").alias("total_tracks"), F.count_if(F.col("status") == OK).alias("success_count"),
    ).withColumn("fail_count", F.col("total_tracks") - F.col("success_count"))


def job_summary(
    tracks: DataFrame, rollup: DataFrame, prompts: int, output_dir: str, path: str = "path", key: str = "track_id",
    record: str | None = None,
) -> DataFrame:
    """One row per manifest entry. A missing file is an error row with no time and no record.

    ``tracks`` carries ``exists``; ``rollup`` has one row per ``key``. ``record``
    is the column with the names of the record files, if they were named before.
    """
    named = F.concat(F.lit(output_dir.rstrip("/") + "/"), F.col(record)) if record else record_path(path, output_dir)
    joined = tracks.join(rollup, key, "left")
    there = F.col("exists")
    missing = F.concat(F.lit(MESSAGES["not_found"].removesuffix("%s")), quoted(path))
    return joined.select(
        "track_id", file_name(path).alias("file"),
        F.when(there, F.coalesce("status", F.lit(ERROR))).otherwise(ERROR).alias("status"),
        F.when(there, F.col("total_processing_time_sec")).alias("total_processing_time_sec"),
        F.when(there, F.coalesce("prompts_ok", F.lit(0))).otherwise(0).alias("prompts_ok"),
        F.lit(prompts).alias("prompts_total"),
        F.when(~there, missing).alias("error"),
        F.when(there, named).alias("output_file"),
    )
