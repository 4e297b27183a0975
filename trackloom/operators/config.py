"""Layered settings, prompt resolution and request validation."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from trackloom.functions.scalars import clamp, over_ceiling
from trackloom.functions.text import strip, to_int
from trackloom.model import LYRICS_MAX_CHARS, TEXT_MAP, TOKEN_CEILING
from trackloom.sources.catalog import MODE_PROMPTS
from trackloom.sources.manifests import track_tags

# --- fixed values: script defaults, lowest layer --------------------------------
DEFAULTS = {
    "model_id": "annotator",
    "precision": "bf16",
    "max_new_tokens": "256",
    "prompt_mode": "minimal",
    "custom_prompt": None,
    "output_dir": "./captions/",
}
# --------------------------------------------------------------------------------


def layered(key: str, layers: list[Column], default: str | None) -> Column:
    """The value in the last layer that has the key, a null there included."""
    value = F.lit(default).cast("string")
    for layer in layers:
        value = F.when(F.map_contains_key(layer, F.lit(key)), F.try_element_at(layer, F.lit(key))).otherwise(value)
    return value


def merge_layers(*layers: Column) -> Column:
    """Open-ended merge of maps, the rightmost present key winning."""

    def over(below: Column, above: Column) -> Column:
        kept = F.map_filter(below, lambda k, v: ~F.map_contains_key(above, k))
        return F.map_concat(kept, above)

    return reduce(over, layers)


def resolve_settings(
    tracks: DataFrame,
    defaults: Mapping[str, str | None] = DEFAULTS,
    ceiling: int = TOKEN_CEILING["ordered"],
    carry: tuple[str, ...] = ("track_index",),
) -> DataFrame:
    """Settings per track from script defaults, manifest globals and the track entry.

    Needs ``globals`` and ``track`` maps. Presence decides, not null: a track
    may null a global. ``max_new_tokens`` is cast and clamped.
    """
    layers = [F.coalesce("globals", F.expr("map()").cast(TEXT_MAP)), F.col("track")]
    value = {k: layered(k, layers, default) for k, default in defaults.items()}
    tokens = to_int(value["max_new_tokens"])
    texts = [k for k in defaults if k not in ("max_new_tokens", "custom_prompt")]
    return tracks.select(
        *carry,
        layered("path", layers, None).alias("path"),
        *[value[k].alias(k) for k in texts],
        F.nullif(value["custom_prompt"], F.lit("")).alias("custom_prompt"),
        clamp(tokens, ceiling).alias("max_new_tokens"),
        F.coalesce(over_ceiling(tokens, ceiling), F.lit(False)).alias("clamped"),
        track_tags(F.col("track")).alias("tags"),
    )


def manifest_rejects(tracks: DataFrame, keys: tuple[str, ...] = ("track_index",)) -> DataFrame:
    """Entries that reject their job: no tracks at all, an entry without ``path``, or a token number that is none.

    ``max_new_tokens`` may be null, which means that it is not known.
    """
    layers = [F.coalesce("globals", F.expr("map()").cast(TEXT_MAP)), F.col("track")]
    asked = layered("max_new_tokens", layers, None)
    entry = lambda text: F.concat(F.lit("Entry "), F.col("track_index"), F.lit(text))
    reason = (
        F.when(F.col("track").isNull(), "The manifest lists no tracks.")
        .when(F.try_element_at("track", F.lit("path")).isNull(), entry(" of the manifest has no path."))
        .when(asked.isNotNull() & to_int(asked).isNull(), entry(" asks for a number of tokens that is not a whole number."))
    )
    return tracks.select(*keys, reason.alias("reason")).where(F.col("reason").isNotNull())


def mixed_settings(settings: DataFrame, name: str, job: str | None = None) -> DataFrame:
    """Per job: the first track's value, and how many values there are.

    One aggregate with partial results; the values themselves are rows of
    ``setting_values``, not a list.
    """
    # no value is one of the values
    values = F.count_distinct(name) + F.max(F.col(name).isNull().cast("int"))
    return settings.groupBy(*([job] if job else [])).agg(
        F.min_by(name, "track_index").alias("used"),
        values.alias("n_values"),
        (values > 1).alias("mixed"),
    )


def setting_values(settings: DataFrame, name: str) -> DataFrame:
    return settings.groupBy(F.col(name).alias("value")).agg(F.count("*").alias("tracks"))


def prompt_for_mode(
    mode: Column | str = "prompt_mode",
    custom: Column | str = "custom_prompt",
    prompts: Mapping[str, str] = MODE_PROMPTS,
) -> tuple[Column, Column]:
    """(prompt, reject reason): exactly one of the two is non-null."""
    mode = F.col(mode) if isinstance(mode, str) else mode
    custom = F.col(custom) if isinstance(custom, str) else custom
    given = F.coalesce(custom, F.lit("")) != ""
    prompt, reason = F.when((mode == "custom") & given, custom), F.when(
        (mode == "custom") & ~given, "Prompt mode 'custom' needs a custom prompt."
    )
    for name, text in prompts.items():
        prompt = prompt.when(mode == name, text)
    known = mode.isin("custom", *prompts)
    unknown = F.concat(
        F.lit("Prompt mode '"), F.coalesce(mode, F.lit("None")),
        F.lit("' is not known; use minimal, default or custom."),
    )
    return prompt, reason.when(~F.coalesce(known, F.lit(False)), unknown)


def unknown_categories(requested: Column, known: list[str]) -> Column:
    return F.array_except(requested, F.array(*[F.lit(k) for k in known]))


def requested_categories(names: Column) -> Column:
    """``"a, b"`` as an array: stripped, no blanks, each name once."""
    parts = F.transform(F.split(names, ","), lambda n: strip(n))
    return F.array_distinct(F.filter(parts, lambda n: n != ""))


# --- request rules: each gives a Column that is true when the row breaks the rule --


def breaks_int_range(name: str, low: int, high: int) -> Column:
    value = to_int(name)
    return F.col(name).isNotNull() & ~F.coalesce(value.between(low, high), F.lit(False))


def breaks_float_range(name: str, low: float, high: float) -> Column:
    value = strip(name).try_cast("double")
    return F.col(name).isNotNull() & ~F.coalesce(
        value.between(low, high) & ~F.isnan(value), F.lit(False)
    )


def breaks_choice(name: str, allowed: list[str]) -> Column:
    value = strip(name)
    return (F.coalesce(F.col(name), F.lit("")) != "") & ~value.isin(allowed)


def breaks_time_signature(name: str, numerators: list[int]) -> Column:
    top = to_int(F.substring_index(strip(name), "/", 1))
    return (F.coalesce(F.col(name), F.lit("")) != "") & ~F.coalesce(top.isin(numerators), F.lit(False))


def breaks_max_length(name: str, limit: int = LYRICS_MAX_CHARS) -> Column:
    return F.coalesce(F.length(strip(name)) > limit, F.lit(False))


def breaks_custom_prompt(mode: str = "prompt_mode", custom: str = "custom_prompt") -> Column:
    return (F.col(mode) == "custom") & (F.coalesce(F.col(custom), F.lit("")) == "")


def violations(rules: Mapping[str, Column]) -> Column:
    """Names of the broken rules, in rule order."""
    return F.array_compact(F.array(*[
        F.when(F.coalesce(broken, F.lit(False)), F.lit(name)) for name, broken in rules.items()
    ]))
