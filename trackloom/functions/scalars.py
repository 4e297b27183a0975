"""Numeric, duration and time expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from trackloom.model import AUDIO_CAP_SEC, WINDOW_SEC


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whole_units(seconds: Column | str, per_second: int = 1000) -> Column:
    """Seconds as a whole number of milliseconds (or other units).

    Whole numbers add up exactly in any order, as decimals do, and much faster.
    """
    return F.floor(_col(seconds) * per_second + F.lit(0.5))


def clamp(value: Column | str, ceiling: int) -> Column:
    """The value, or the ceiling if it is above; an unknown value stays unknown."""
    value = _col(value)
    return F.when(value.isNotNull(), F.least(value, F.lit(ceiling)))


def over_ceiling(value: Column | str, ceiling: int) -> Column:
    return _col(value) > F.lit(ceiling)


def is_truncated(new_tokens: Column | str, budget: Column | str) -> Column:
    return _col(new_tokens) >= _col(budget)


def covered_seconds(windows: Column | str) -> Column:
    return _col(windows) * F.lit(WINDOW_SEC)


def has_coverage_gap(windows: Column | str, effective_sec: Column | str) -> Column:
    return covered_seconds(windows) < _col(effective_sec) - F.lit(WINDOW_SEC)


def effective_duration(duration: Column | str, cap: int = AUDIO_CAP_SEC) -> Column:
    """Duration after the cap; a cap of 0 switches it off. An unknown duration stays unknown."""
    duration = _col(duration)
    return duration if cap == 0 else F.when(duration.isNotNull(), F.least(duration, F.lit(float(cap))))


def trim_samples(samples: Column | str, sample_rate: Column | str, cap: int = AUDIO_CAP_SEC) -> Column:
    samples = _col(samples)
    if cap == 0:
        return samples
    return F.slice(samples, F.lit(1), (F.lit(cap) * _col(sample_rate)).cast("int"))


def duration_text(seconds: Column | str) -> Column:
    """``12.3s``, ``2m 3.0s`` or ``1h 2m 3.0s``."""
    s = _col(seconds)
    rest = s % F.lit(60.0)
    hours = F.floor(s / 3600)
    minutes = F.floor((s % F.lit(3600.0)) / 60)
    return (
        F.when(s < 60, F.format_string("%.1fs", s))
        .when(s < 3600, F.format_string("%dm %.1fs", minutes, rest))
        .otherwise(F.format_string("%dh %dm %.1fs", hours, minutes, rest))
    )


def iso_utc(wall_clock: Column | str, zulu: bool = False) -> Column:
    """ISO-8601 text of a UTC wall-clock time (timestamp_ntz), in any session time zone.

    The fraction has six digits and is left out when zero.
    """
    shown = _col(wall_clock).cast("string")
    whole = F.replace(F.left(shown, F.lit(19)), F.lit(" "), F.lit("T"))
    fraction = F.when(F.length(shown) > 19, F.rpad(F.substr(shown, F.lit(20)), 7, "0")).otherwise("")
    return F.concat(whole, fraction, F.lit("Z" if zulu else "+00:00"))


def now_utc() -> Column:
    """The query's start time as a UTC wall-clock (timestamp_ntz), whatever the session time zone."""
    local = F.current_timestamp().cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)


def error_text(output: Column | str) -> Column:
    """The reason in an in-band ``ERROR: …`` answer, else null."""
    output = _col(output)
    return F.when(output.startswith("ERROR: "), F.substr(output, F.lit(8)))
