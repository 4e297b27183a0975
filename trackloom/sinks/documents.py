"""Whole JSON documents and CSV reports, written in parallel.

A document such as ``{"globals": …, "tracks": [ … ]}`` would need one row that
holds the whole catalogue. Here each element is one text line, range-sorted,
with the frame as first and last line: the part files in name order, read one
after the other, are the document, and each line can be read on its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from trackloom.session import shared_dir

BODY_ROW = "{"
HEADER_END = "["
FOOTER = "]}"


def write_framed(
    header: DataFrame, field: str, body: DataFrame, order: list[str], element: Column, path: str, lead: str | None = None,
    counted: Observation | None = None,
) -> None:
    """Write ``{<header fields>, "<field>": [<one element per line>]}``.

    ``header`` has one row with the leading fields; ``lead`` gives them as JSON
    text instead. Elements that are equal in ``order`` are told apart by
    a number of their own; the last element is the one without a comma.
    ``counted`` gets the number of elements, as ``written``, from the job that writes them.
    """
    lead = header.select((F.to_json(F.struct("*")) if lead is None else F.lit(lead)).alias("_h")).select(
        F.concat(F.expr("left(_h, length(_h) - 1)"), F.when(F.col("_h") != "{}", F.lit(",")).otherwise(""),
                 F.lit(f'"{field}":{HEADER_END}')).alias("value")
    )
    # the numbers are written down, so that all readers below see the same ones
    shared_dir(body.sparkSession)
    numbered = body.select(
        element.alias("value"), F.struct(*order).alias("o"), F.monotonically_increasing_id().alias("i")
    ).select("value", F.struct("o", "i").alias("k")).checkpoint()
    last = numbered.agg(F.max("k").alias("last"))
    lines = numbered.join(F.broadcast(last), F.col("k") == F.col("last"), "left").select(  # one row
        F.lit(1).alias("section"), "k",
        F.concat("value", F.when(F.col("last").isNull(), F.lit(",")).otherwise("")).alias("value"),
    )
    no_key = F.lit(None).cast(lines.schema["k"].dataType).alias("k")
    framed = (
        lead.select(F.lit(0).alias("section"), no_key, "value")
        .unionByName(lines)
        .unionByName(header.select(F.lit(2).alias("section"), no_key, F.lit(FOOTER).alias("value")))
    )
    lines = framed.orderBy("section", "k")
    if counted is not None:  # above the sort, whose sampling would count a second time
        lines = lines.observe(counted, F.count_if(F.col("section") == 1).alias("written"))
    lines.select("value").write.text(path)


def write_manifest(globals_row: DataFrame, tracks: DataFrame, path: str, order: list[str] | None = None) -> None:
    """A manifest from (path, tags) rows and a one-row table of globals, to a new path.

    The globals are one column each, or one ``globals`` map as read from a manifest.
    """
    element = F.to_json(F.struct("path", "tags"))
    header = globals_row if globals_row.columns == ["globals"] else globals_row.select(F.struct("*").alias("globals"))
    write_framed(header, "tracks", tracks, order or ["path"], element, path)


def write_entries(globals_text: str, entries: DataFrame, path: str, counted: Observation | None = None) -> None:
    """A manifest of entries that are JSON text already, ordered by ``place``, with the globals as they stood."""
    header = entries.sparkSession.range(1)
    write_framed(header, "tracks", entries, ["place"], F.col("entry"), path, f'{{"globals":{globals_text}}}', counted)


def write_summary_document(header: DataFrame, records: DataFrame, path: str, field: str = "tracks") -> None:
    """The run summary: totals first, then every record in file order."""
    write_framed(header, field, records, ["file", "path"] if "path" in records.columns else ["file"],
                 F.to_json(F.struct("*")), path)


def write_summary_csv(pivoted: DataFrame, path: str) -> None:
    """The pivoted report as CSV with a header and doubled quotes."""
    pivoted.write.option("header", True).option("quote", '"').option("escape", '"').option(
        "emptyValue", ""
    ).csv(path)
