"""Path and tag expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from trackloom.functions.text import strip, to_int
from trackloom.model import RECORD_SUFFIX

NUMBERED_STEM = r"(?U)^(\d+)[.\s_-]+(.+)$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def file_name(path: Column | str) -> Column:
    return F.substring_index(_col(path), "/", -1)


def _suffix_length(name: Column) -> Column:
    """Characters of the last suffix with its dot, by string search instead of a pattern."""
    tail = F.length(F.substring_index(name, ".", -1))
    real = (tail > 0) & (F.length(name) - tail > 1)  # neither ``name.`` nor ``.hidden`` nor without a dot
    return F.when(real, tail + 1).otherwise(0)


def without_scheme(path: Column | str) -> Column:
    """A plain absolute path from a URI such as ``file:/music/a.mp3``."""
    return F.regexp_replace(_col(path), r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?(?=/)", "")


def suffix(path: Column | str) -> Column:
    """Last suffix in lower case with its dot; empty for ``.hidden`` and ``name.``."""
    name = file_name(path)
    return F.lower(F.right(name, _suffix_length(name)))


def stem(path: Column | str) -> Column:
    """File name without its last suffix."""
    name = file_name(path)
    return F.left(name, F.length(name) - _suffix_length(name))


def parent(path: Column | str) -> Column:
    path = _col(path)
    cut = F.length(path) - F.length(file_name(path)) - 1
    return F.left(path, F.greatest(cut, F.lit(0)))


def relative_to(path: Column | str, base: str) -> Column:
    """Path below ``base``, or null when it is not below it."""
    root = base.rstrip("/") + "/"
    path = _col(path)
    return F.when(path.startswith(root), F.substr(path, F.lit(len(root) + 1)))


def has_suffix(path: Column | str, allowed: list[str]) -> Column:
    return F.ltrim(suffix(path), F.lit(".")).isin([s.lower() for s in allowed])


def name_track_number(stem_col: Column | str) -> Column:
    return to_int(F.regexp_extract(_col(stem_col), NUMBERED_STEM, 1))


def name_title(stem_col: Column | str) -> Column:
    c = _col(stem_col)
    return F.when(c.rlike(NUMBERED_STEM), strip(F.regexp_extract(c, NUMBERED_STEM, 2))).otherwise(c)


def position_number(text: Column | str) -> Column:
    """``3`` from ``3/12``; null when the left part is not a whole number."""
    return to_int(F.substring_index(_col(text), "/", 1))


def merge_tags(embedded: Column, from_name: Column) -> Column:
    """Embedded tags win; the file name fills the gaps. Null values count as absent."""
    own = F.map_filter(F.coalesce(embedded, F.expr("map()").cast("map<string,string>")), lambda k, v: v.isNotNull())
    gaps = F.map_filter(from_name, lambda k, v: v.isNotNull() & ~F.map_contains_key(own, k))
    return F.map_concat(gaps, own)


def record_path(path: Column | str, output_dir: str) -> Column:
    return F.concat(F.lit(output_dir.rstrip("/") + "/"), stem(path), F.lit(RECORD_SUFFIX))


def sibling_path(path: Column | str, new_suffix: str) -> Column:
    """Same folder and stem, other suffix."""
    path = _col(path)
    return F.concat(F.left(path, F.length(path) - _suffix_length(file_name(path))), F.lit(new_suffix))


def mirrored_path(path: Column | str, source_root: str, target_root: str, new_suffix: str) -> Column:
    """The same relative place under another root; null when not below the source root."""
    below = relative_to(path, source_root)
    return F.concat(F.lit(target_root.rstrip("/") + "/"), sibling_path(below, new_suffix))
