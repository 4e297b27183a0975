import json

import pytest
from pyspark.sql import functions as F

from trackloom.operators.resume import latest_state, pending_prompts
from trackloom.sinks import log as logs
from trackloom.sources.catalog import Catalog

SCHEMA = "track_id string, category string, status string, output string, updated_at timestamp"


def batch(spark, log, run, number, rows):
    frame = spark.createDataFrame([(t, c, s, o, at) for t, c, s, o, at in rows], "track_id string, category string, status string, output string, at long")
    return logs.write_batch(frame.withColumn("updated_at", F.timestamp_seconds("at")).drop("at"), log, run, number)


def state(rows):
    newest = latest_state(rows, logs.STATE_KEYS, logs.STATE_ORDER)
    return sorted((r.track_id, r.category, r.status, r.output, r.run_id, r.batch_id, r.attempt) for r in newest.collect())


@pytest.fixture
def log(spark, tmp_path):
    path = str(tmp_path / "log")
    batch(spark, path, "a", 0, [(f"t{i}", c, "error" if i % 3 else "ok", f"a{i}", 10) for i in range(30) for c in ("genre", "vocals")])
    batch(spark, path, "a", 1, [(f"t{i}", "genre", "ok", f"b{i}", 20) for i in range(5, 20)])
    return path


def test_snapshot_and_tail_give_the_log(spark, log):
    whole = state(logs.read_log(spark, log))
    assert state(logs.read_state(spark, log)) == whole
    first = logs.compact_log(spark, log)
    assert logs.compact_log(spark, log) == first  # nothing new
    assert state(logs.read_state(spark, log)) == whole == state(logs.read_log(spark, log))
    assert all("_snapshots" in f for f in logs.read_state(spark, log).inputFiles())
    tail = batch(spark, log, "b", 0, [("t1", "genre", "ok", "new", 30), ("t99", "genre", "ok", "n", 5), ("t2", "genre", "error", "old", 1)])
    assert state(logs.read_state(spark, log)) == state(logs.read_log(spark, log)) != whole
    read = logs.read_state(spark, log).inputFiles()
    assert {"_snapshots" in f or tail in f for f in read} == {True} and any(tail in f for f in read)
    second = logs.compact_log(spark, log)
    assert second != first and state(logs.read_state(spark, log)) == state(logs.read_log(spark, log))
    assert all(second in f for f in logs.read_state(spark, log).inputFiles())


def test_a_compaction_that_dies_changes_nothing(spark, log, monkeypatch):
    logs.compact_log(spark, log)
    batch(spark, log, "b", 0, [("t1", "genre", "ok", "new", 30)])
    before = state(logs.read_state(spark, log))

    def dies(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(logs, "replace_file", dies)
    with pytest.raises(KeyboardInterrupt):
        logs.compact_log(spark, log)
    monkeypatch.undo()
    assert state(logs.read_state(spark, log)) == before
    logs.compact_log(spark, log)
    assert state(logs.read_state(spark, log)) == before


def test_attempts_without_an_end_are_not_covered(spark, log, tmp_path):
    broken = tmp_path / "log" / "run_id=z" / "batch_id=0" / "attempt=x"
    broken.mkdir(parents=True)
    assert logs.list_attempts(log) and not any("run_id=z" in f for f in logs.list_attempts(log))
    logs.compact_log(spark, log)
    pointer = json.loads((tmp_path / "log" / "_snapshots" / "CURRENT").read_text())
    assert sorted(pointer["attempts"]) == logs.list_attempts(log)


def test_vacuum_keeps_the_state(spark, log):
    assert logs.vacuum_log(log) == 0
    logs.compact_log(spark, log)
    batch(spark, log, "b", 0, [("t1", "genre", "ok", "new", 30)])
    logs.compact_log(spark, log)
    batch(spark, log, "c", 0, [("t2", "genre", "ok", "newer", 40)])
    before = state(logs.read_state(spark, log))
    assert logs.vacuum_log(log) == 4  # three attempts and the first snapshot
    assert state(logs.read_state(spark, log)) == before and len(logs.list_attempts(log)) == 1
    logs.compact_log(spark, log)
    assert state(logs.read_state(spark, log)) == before


def test_pending_work_from_a_compacted_log(spark, log):
    catalog = Catalog("c", (("genre", "G?"), ("vocals", "V?")))
    tracks = spark.createDataFrame([(f"t{i}",) for i in range(32)], "track_id string")
    todo = lambda rows: sorted((r.track_id, [p.category for p in r.prompts]) for r in pending_prompts(tracks, rows, catalog, order=logs.STATE_ORDER).collect())
    before = todo(logs.read_log(spark, log))
    logs.compact_log(spark, log)
    assert todo(logs.read_state(spark, log)) == before


def test_empty_log(spark, tmp_path):
    path = str(tmp_path / "none")
    assert logs.compact_log(spark, path) is None and logs.list_attempts(path) == []
    assert logs.read_state(spark, path).count() == 0
