"""The append-only response log, its snapshots, and nested record exports.

A log is a folder of attempts, ``run_id=…/batch_id=…/attempt=…``. A snapshot is a table of the newest rows of the attempts
that it covers. A pointer file, replaced whole, names the snapshot that counts and what it covers; until it is replaced,
readers see the one before. The state of a log is then the snapshot and the attempts written since.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from trackloom.model import LOG
from trackloom.operators.resume import latest_state
from trackloom.sources.files import child_names, drop_folder, read_file, replace_file

#: What a state has one newest row of, and what newest means.
STATE_KEYS, STATE_ORDER = ("track_id", "category", "entry"), ("updated_at", "run_id", "batch_id")
SNAPSHOTS = "_snapshots"


def write_batch(
    responses: DataFrame, log_path: str, run_id: str, batch_id: int, attempt: str | None = None,
) -> str:
    """Write one batch of the log to a folder of its own; returns the attempt's id.

    Without ``attempt`` a fresh one is made, so a run that is started again
    under its old id adds rows and never replaces any. A stream names its own
    id: only a replay of the same batch of the same stream is written again
    in place, so that it leaves no duplicates.
    """
    mode = "overwrite" if attempt else "errorifexists"
    attempt = attempt or uuid.uuid4().hex
    body = [f for f in LOG.fields if f.name not in ("run_id", "batch_id", "attempt")]
    present = set(responses.columns)
    responses.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in body
    ]).write.mode(mode).parquet(f"{log_path}/run_id={run_id}/batch_id={batch_id}/attempt={attempt}")
    return attempt


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    """The log, pruned by run_id, batch_id and attempt; empty when nothing was written yet."""
    try:
        return spark.read.schema(LOG).parquet(log_path)
    except Exception as exc:
        if "PATH_NOT_FOUND" in str(exc):
            return spark.createDataFrame([], LOG)
        raise


def list_attempts(log_path: str) -> list[str]:
    """The folders of finished attempts, below the log's."""
    found = []
    for run in child_names(log_path):
        if run.startswith("run_id="):
            for batch in child_names(f"{log_path}/{run}"):
                for attempt in child_names(f"{log_path}/{run}/{batch}"):
                    folder = f"{run}/{batch}/{attempt}"
                    if "_SUCCESS" in child_names(f"{log_path}/{folder}"):
                        found.append(folder)
    return found


def read_attempts(spark: SparkSession, log_path: str, folders: list[str]) -> DataFrame:
    """The rows of some attempts; no other folder is listed or read."""
    if not folders:
        return spark.createDataFrame([], LOG)
    return spark.read.schema(LOG).option("basePath", log_path).parquet(*[f"{log_path}/{f}" for f in folders])


def current_snapshot(log_path: str) -> tuple[str | None, list[str]]:
    """The snapshot that counts, and the attempts that it covers."""
    if "CURRENT" not in child_names(f"{log_path}/{SNAPSHOTS}"):
        return None, []
    pointer = json.loads(read_file(f"{log_path}/{SNAPSHOTS}/CURRENT"))
    return pointer["snapshot"], pointer["attempts"]


def _snapshot(spark: SparkSession, log_path: str, name: str | None) -> DataFrame:
    return spark.read.schema(LOG).parquet(f"{log_path}/{SNAPSHOTS}/{name}") if name else spark.createDataFrame([], LOG)


def read_state(spark: SparkSession, log_path: str) -> DataFrame:
    """The rows that tell the newest state: the snapshot's and those of attempts it doesn't cover. Without one, the log's.

    What ``latest_state`` makes of them is what it makes of the whole log.
    """
    name, covered = current_snapshot(log_path)
    if name is None:
        return read_log(spark, log_path)
    tail = sorted(set(list_attempts(log_path)) - set(covered))
    snapshot = _snapshot(spark, log_path, name)
    return snapshot.union(read_attempts(spark, log_path, tail)) if tail else snapshot


def compact_log(spark: SparkSession, log_path: str) -> str | None:
    """Fold the finished attempts into a new snapshot and point to it; returns its name, None for an empty log.

    The old snapshot and the attempts since are merged, so a compaction costs the state and the tail, not the history.
    Rows are sorted by track: a lookup of some tracks skips the other row groups. Writers may go on meanwhile; what they
    finish after the listing is tail of the new snapshot.
    """
    name, covered = current_snapshot(log_path)
    there = list_attempts(log_path)
    tail = sorted(set(there) - set(covered))
    if not tail:
        return name
    rows = _snapshot(spark, log_path, name).union(read_attempts(spark, log_path, tail))
    newest = latest_state(rows, STATE_KEYS, STATE_ORDER).select(*LOG.names)
    fresh = uuid.uuid4().hex
    newest.repartitionByRange("track_id").sortWithinPartitions("track_id").write.parquet(f"{log_path}/{SNAPSHOTS}/{fresh}")
    # attempts that were removed since need no mention any more
    pointer = {"snapshot": fresh, "attempts": sorted(set(there) & (set(covered) | set(tail)))}
    replace_file(f"{log_path}/{SNAPSHOTS}/CURRENT", json.dumps(pointer).encode())
    return fresh


def vacuum_log(log_path: str) -> int:
    """Remove the attempts that the snapshot covers, and older snapshots; returns how many folders went. History goes with them."""
    name, covered = current_snapshot(log_path)
    if name is None:
        return 0
    gone = [f"{log_path}/{f}" for f in list_attempts(log_path) if f in set(covered)]
    gone += [f"{log_path}/{SNAPSHOTS}/{f}" for f in child_names(f"{log_path}/{SNAPSHOTS}") if f not in (name, "CURRENT")]
    for folder in gone:
        drop_folder(folder)
    return len(gone)


def export_records(records: DataFrame, path: str, compression: str = "none") -> None:
    """Nested records as JSON lines, null fields kept.

    With ``compression="gzip"`` they take a small part of the disk, and a file is read by one task: for exports of many files.
    """
    records.write.option("ignoreNullFields", "false").option("compression", compression).json(path)
