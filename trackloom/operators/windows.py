"""Positions in sorted order, and landmark windows within a track."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from trackloom.model import LANDMARK_SEC, WINDOW_LABELS
from trackloom.session import shared_dir

ROWS_PER_TASK = 2**33  # monotonically_increasing_id keeps the row offset in the low 33 bits


def positions(df: DataFrame, order: list[str | Column], name: str = "idx") -> DataFrame:
    """Number the rows 1..n in the given order, and add ``total``.

    A range sort, then offsets: every task numbers its own rows and adds the
    row counts of the tasks before it. A ranking window without partitions
    would put all rows in one task. Eager: the sorted rows are checkpointed in
    the shared folder, so both reads below see the same split.
    """
    shared_dir(df.sparkSession)
    ranged = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()).checkpoint()
    located = ranged.withColumn("_task", F.shiftright("_mid", 33))
    counts = located.groupBy("_task").agg(F.count("*").alias("_n"))  # one row per task of the sort
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = counts.select(
        "_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(everything).alias("total"),
    )
    numbered = located.join(F.broadcast(offsets), "_task")
    index = F.col("_before") + F.col("_mid") % F.lit(ROWS_PER_TASK) + 1
    return numbered.withColumn(name, index).drop("_mid", "_task", "_before")


def progress_index(tracks: DataFrame, path: str = "path") -> DataFrame:
    """``[idx/total]`` labels in path order."""
    label = F.concat(F.lit("["), F.col("idx"), F.lit("/"), F.col("total"), F.lit("]"))
    return positions(tracks, [path]).withColumn("label", label)


def by_components(path: str = "path") -> Column:
    """Sort key that compares paths folder by folder instead of as one string."""
    return F.split(path, "/")


def landmark_windows(
    tracks: DataFrame, total_frames: str = "total_frames", sample_rate: str = "sample_rate",
    window_sec: float = LANDMARK_SEC,
) -> DataFrame:
    """Four windows per track: its start, the next one, and both sides of its middle.

    Windows are cut to the track and empty ones dropped, keeping their index.
    Ends fall on whole frames. Row generation only: no shuffle.
    """
    frames, rate = F.col(total_frames), F.col(sample_rate)
    length = frames / rate
    mid, w = length / 2.0, F.lit(float(window_sec))
    starts = [F.lit(0.0), w, mid - w, mid]
    candidates = F.array(*[
        F.struct(
            F.lit(i).alias("chunk_index"), F.lit(label).alias("label"),
            F.greatest(F.lit(0.0), start).alias("_start"), F.least(length, end).alias("_end"),
        )
        for i, (label, start, end) in enumerate(zip(
            WINDOW_LABELS, starts, [w, F.lit(2.0 * window_sec), mid, mid + w]
        ))
    ])
    end_frame = F.least(F.floor(F.col("_end") * rate), frames)
    return (
        tracks.select("*", F.inline(candidates))
        .where(F.col("_end") > F.col("_start"))
        .withColumns({
            "start_frame": F.floor(F.col("_start") * rate),
            "end_frame": end_frame,
            "start_seconds": F.bround("_start", 3),
            "end_seconds": F.bround(end_frame / rate, 3),
        })
        .drop("_start", "_end")
    )
