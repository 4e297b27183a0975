"""Data-quality checks: waveforms, tags, name collisions, column profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from trackloom.functions import paths
from trackloom.model import MESSAGES, MODEL_MAX_SEC


def waveform_error(samples: Column | str, duration: Column | str, decode_error: Column | str | None = None) -> Column:
    """The first rule a waveform breaks, as text; null when it is valid."""
    s = F.col(samples) if isinstance(samples, str) else samples
    d = F.col(duration) if isinstance(duration, str) else duration
    inf = float("inf")
    checks = (
        F.when(F.coalesce(F.size(s), F.lit(0)) <= 0, MESSAGES["empty"])
        .when(F.exists(s, lambda x: F.isnan(x)), MESSAGES["nan"])
        .when(F.exists(s, lambda x: F.abs(x) == inf), MESSAGES["infinite"])
        .when(d <= 0, F.format_string(MESSAGES["bad_duration"], d))
        .when(d > MODEL_MAX_SEC, F.format_string(MESSAGES["too_long"], d))
    )
    return checks if decode_error is None else F.coalesce(decode_error, checks)


def tag_number_check(tracks: DataFrame, group: str) -> DataFrame:
    """Per group: tracks whose embedded number differs from the file name's, and the
    number most tracks carry (smallest on a tie).

    Two aggregates: the first collapses each (group, number), so a number that
    sits on a third of all tracks is one row before the second.
    """
    per_number = tracks.groupBy(group, "track_number").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("track_number") != F.col("name_number")).alias("differing"),
    )
    known = F.col("track_number").isNotNull()
    return per_number.groupBy(group).agg(
        F.sum("n").alias("tracks"),
        F.sum("differing").alias("differing"),
        F.max_by(
            F.when(known, F.col("track_number")), F.when(known, F.struct("n", -F.col("track_number")))
        ).alias("common_number"),
        F.max(F.when(known, F.col("n"))).alias("common_count"),
    )


def name_collisions(tracks: DataFrame, path: str = "path", by: str = "stem") -> DataFrame:
    """Stems (or file names) that more than one track shares. Bounded output per name."""
    name = paths.stem(path) if by == "stem" else paths.file_name(path)
    return (
        tracks.groupBy(name.alias("name"))
        .agg(F.count("*").alias("tracks"), F.min(path).alias("first_path"), F.max(path).alias("last_path"))
        .where(F.col("tracks") > 1)
    )


def collision_members(tracks: DataFrame, path: str = "path", by: str = "stem") -> DataFrame:
    """Every track of a shared name, as rows. A name may be on a third of all tracks: the join is one Spark can split."""
    name = paths.stem(path) if by == "stem" else paths.file_name(path)
    named = tracks.select(name.alias("name"), F.col(path).alias("path"))
    shared = name_collisions(tracks, path, by).select("name", "tracks")
    return named.join(shared, "name")


def _length(name: str, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return F.length(name)
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return F.size(name)
    return F.lit(None).cast("int")


def profile_collection(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, non-null count, smallest and largest length.

    All columns in one pass over the data, then one narrow unpivot.
    """
    stats = df.agg(
        F.count("*").alias("rows"),
        *[F.count(f.name).alias(f"n_{i}") for i, f in enumerate(df.schema.fields)],
        *[F.min(_length(f.name, f.dataType)).alias(f"lo_{i}") for i, f in enumerate(df.schema.fields)],
        *[F.max(_length(f.name, f.dataType)).alias(f"hi_{i}") for i, f in enumerate(df.schema.fields)],
    )
    rows = F.array(*[
        F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("type"), F.col("rows"),
            F.col(f"n_{i}").alias("non_null"), F.col(f"lo_{i}").alias("min_length"),
            F.col(f"hi_{i}").alias("max_length"),
        )
        for i, f in enumerate(df.schema.fields)
    ])
    return stats.select(F.inline(rows))


def key_profile(df: DataFrame, map_column: str) -> DataFrame:
    """Keys of a map column with the rows that have them and how many values are non-null."""
    entries = df.select(F.explode(map_column).alias("key", "value"))
    return entries.groupBy("key").agg(F.count("*").alias("present"), F.count("value").alias("non_null"))


def first_item(df: DataFrame, order: list[str]) -> DataFrame:
    """One sample row, the first in the given order."""
    return df.orderBy(*order).limit(1)
