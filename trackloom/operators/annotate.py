"""The annotator step: user code per track, errors as rows."""

from __future__ import annotations

import re
import time
import traceback
from collections.abc import Callable, Iterator, Mapping
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from trackloom.model import DRY_RUN, ERROR, MESSAGES, OK, RESULT
from trackloom.session import ship_package
from trackloom.sources.files import read_file


class Annotator(Protocol):
    """User code. It sees the media content, the prompt and, with a ``configure`` method, its track's settings; nothing else."""

    def prepare(self, content: Any) -> Any:
        """Decode one track; called once for all of its prompts."""

    def annotate(self, prepared: Any, prompt: str) -> Mapping[str, Any]:
        """Answer one prompt: ``output`` and any other fields of ``RESULT``."""


def _configure(annotator: Annotator, settings: Mapping[str, Any]) -> None:
    """Settings such as a token limit reach an annotator that asks for them, before each track."""
    if settings and hasattr(annotator, "configure"):
        annotator.configure(settings)


def failure(exc: Exception) -> dict:
    """An exception as a result."""
    return {"status": ERROR, "error": str(exc), "traceback": traceback.format_exc()}


def answer(annotator: Annotator, prepared: Any, prompt: str) -> dict:
    """The result of one prompt, timed, an exception included."""
    start = time.time()
    try:
        given = dict(annotator.annotate(prepared, prompt))
    except Exception as exc:
        return failure(exc)
    given.setdefault("processing_time_sec", round(time.time() - start, 1))
    return {"status": OK, **given}


def annotate(
    pending: DataFrame, make_annotator: Callable[[], Annotator],
    carry: tuple[str, ...] = ("track_id",), content: str = "content", tasks: int | None = None,
    opened: bool = False, fatal: str | None = None, settings: tuple[str, ...] = (),
) -> DataFrame:
    """Run an annotator over tracks with a ``prompts`` array; one result row per prompt.

    ``make_annotator`` runs once per partition, before the first batch. Content
    is decoded once per track. Only content and prompt reach the annotator;
    key and tag columns are carried around it. An exception is an error row of
    its prompt (of all prompts, when decoding fails), so a task never fails on
    bad media and a retried task gives the same rows.

    With ``opened`` the content column has the files' paths: the worker opens
    each file when its turn comes, so only pending files are read and no content
    is shuffled. A file that can't be read is an error row like bad media.

    After an error that matches ``fatal`` the worker is taken as broken: its
    remaining prompts are not tried, and become skipped error rows that a later
    run takes up again.

    ``settings`` names columns whose values an annotator with a ``configure``
    method gets as a mapping before each track.

    ``tasks`` deals the tracks out evenly first: worth a shuffle when the
    annotator is slow and the pending tracks sit in few partitions.
    """
    ship_package(pending.sparkSession)
    if tasks is not None:
        pending = pending.repartition(tasks)
    carried = [pending.schema[c] for c in carry]
    results = pa.schema([
        ("ord", pa.int32()), ("category", pa.string()), ("prompt_used", pa.string()), ("status", pa.string()),
        ("output", pa.string()), ("error", pa.string()), ("traceback", pa.string()),
        ("processing_time_sec", pa.float64()), ("audio_windows", pa.int32()), ("audio_covered_sec", pa.int32()),
        ("output_truncated", pa.bool_()),
    ])
    extra = [T.StructField("ord", T.IntegerType()), T.StructField("category", T.StringType()),
             T.StructField("prompt_used", T.StringType())]
    schema = T.StructType(carried + extra + RESULT.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        annotator, stopped = make_annotator(), False
        for batch in batches:
            out = pa.schema([batch.schema.field(c) for c in carry] + list(results))
            rows = []
            samples = {i: f.name for i, f in enumerate(batch.schema) if pa.types.is_list(f.type) and pa.types.is_floating(f.type.value_type)}
            plain = batch.select([f.name for i, f in enumerate(batch.schema) if i not in samples])
            for i, row in enumerate(plain.to_pylist()):
                for name in samples.values():  # numbers stay in Arrow's memory
                    cell = batch.column(name)[i]
                    row[name] = cell.values.to_numpy(zero_copy_only=False) if cell.is_valid else None
                key = {c: row[c] for c in carry}
                if stopped:
                    rows += [{**key, "ord": p["ord"], "category": p["category"], "prompt_used": p["prompt"],
                              "status": ERROR, "error": MESSAGES["skipped"]} for p in row["prompts"]]
                    continue
                try:
                    _configure(annotator, {c: row[c] for c in settings})
                    given = read_file(row[content]) if opened else row[content]
                    prepared, broken = annotator.prepare(given), None
                except Exception as exc:
                    prepared, broken = None, failure(exc)
                for p in row["prompts"]:
                    if stopped:
                        result = {"status": ERROR, "error": MESSAGES["skipped"]}
                    else:
                        result = broken or answer(annotator, prepared, p["prompt"])
                        stopped = bool(fatal and result.get("error") and re.search(fatal, result["error"]))
                    rows.append({**key, "ord": p["ord"], "category": p["category"],
                                 "prompt_used": p["prompt"], **result})
            yield pa.RecordBatch.from_pylist(rows, schema=out)

    return pending.select(*dict.fromkeys((*carry, content, *settings, "prompts"))).mapInArrow(run, schema)


def dry_result(category: str) -> dict:
    """The placeholder result of one prompt."""
    return {"status": OK, "output": MESSAGES["dry_run"].replace("%s", category), "output_truncated": False, **DRY_RUN}


def dry_run(pairs: DataFrame, category: str = "category") -> DataFrame:
    """Placeholder results as plain column expressions: no Python worker starts."""
    lead, tail = MESSAGES["dry_run"].split("%s")
    return pairs.withColumns({
        "status": F.lit(OK),
        "output": F.concat(F.lit(lead), F.col(category), F.lit(tail)),
        "error": F.lit(None).cast("string"),
        "traceback": F.lit(None).cast("string"),
        "processing_time_sec": F.lit(DRY_RUN["processing_time_sec"]),
        "audio_windows": F.lit(DRY_RUN["audio_windows"]),
        "audio_covered_sec": F.lit(DRY_RUN["audio_covered_sec"]),
        "output_truncated": F.lit(False),
    })


def split_error_answers(captions: DataFrame, output: str = "output") -> DataFrame:
    """Turn in-band ``ERROR: …`` answers into status and error columns."""
    from trackloom.functions.scalars import error_text

    reason = error_text(output)
    return captions.withColumns({
        "status": F.when(reason.isNull(), OK).otherwise(ERROR),
        "error": reason,
        output: F.when(reason.isNull(), F.col(output)),
    })
