import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from trackloom.operators import resume, windows
from trackloom.sources.catalog import Catalog, read_catalog

CATALOG = Catalog("c", (("genre", "G?"), ("vocals", "V?"), ("mastering", "M?")))
LOG = "track_id string, category string, status string, error string, updated_at int"


def test_fan_out_is_narrow(spark):
    tracks = spark.createDataFrame([("a",), ("b",)], "track_id string")
    out = resume.fan_out(tracks, CATALOG)
    assert [(r.track_id, r.category) for r in out.collect()] == [(t, k) for t in "ab" for k in CATALOG.keys]
    assert "Exchange" not in plan_of(out) and "Cartesian" not in plan_of(out) and "NestedLoop" not in plan_of(out)


def test_pending_retries_errors_and_new_categories(spark):
    tracks = spark.createDataFrame([("a",), ("b",), ("done",)], "track_id string")
    log = spark.createDataFrame(
        [("a", "genre", "error", None, 1), ("a", "genre", "ok", None, 2), ("a", "vocals", "ok", None, 1), ("a", "vocals", "error", None, 2),
         ("a", "other", "ok", None, 1)] + [("done", k, "ok", None, 1) for k in CATALOG.keys], LOG)
    pairs = resume.pending_pairs(tracks, log, CATALOG)
    got = sorted((r.track_id, r.category, r.prompt) for r in pairs.collect())
    assert got == [("a", "mastering", "M?"), ("a", "vocals", "V?"), ("b", "genre", "G?"), ("b", "mastering", "M?"), ("b", "vocals", "V?")]
    assert resume.pending_pairs(tracks, log, CATALOG, overwrite=True).count() == 9
    # annotating everything that is pending leaves nothing
    after = log.unionByName(pairs.selectExpr("track_id", "category", "'ok' status", "string(null) error", "9 updated_at"))
    assert resume.pending_pairs(tracks, after, CATALOG).count() == 0


def test_state_is_newest_per_pair_and_upsert_keeps_the_rest(spark):
    old = spark.createDataFrame([("a", "genre", "ok", None, 5), ("a", "vocals", "ok", None, 1)], LOG)
    new = spark.createDataFrame([("a", "genre", "error", "x", 3), ("a", "vocals", "error", "y", 2), ("b", "genre", "ok", None, 1)], LOG)
    state = {(r.track_id, r.category): r.status for r in resume.upsert_state(old, new).collect()}
    assert state == {("a", "genre"): "ok", ("a", "vocals"): "error", ("b", "genre"): "ok"}
    loaded = {r.track_id: r.categories for r in resume.load_state(
        spark.createDataFrame([("a",), ("z",)], "track_id string"), resume.upsert_state(old, new), CATALOG).collect()}
    assert loaded == {"a": {"genre": "ok", "vocals": "error"}, "z": {}}


def test_basename_and_path_keys(spark):
    tracks = spark.createDataFrame([("A/01.mp3",), ("B/01.mp3",), ("B/02.mp3",)], "path string")
    done = spark.createDataFrame([("01.mp3", "A/01.mp3"), ("01.mp3", "A/01.mp3")], "file string, path string")
    assert [r.path for r in resume.remaining_tracks(tracks, done).collect()] == ["B/02.mp3"]
    assert sorted(r.path for r in resume.remaining_tracks(tracks, done, key="path").collect()) == ["B/01.mp3", "B/02.mp3"]
    row = resume.conservation(tracks, done).first()
    assert (row.total_before, row.total_done, row.total_left, row.balanced) == (3, 2, 1, True)


def test_missing_files(spark):
    tracks = spark.createDataFrame([("t1", "/m/it's.mp3"), ("t2", "/m/b.mp3")], "track_id string, path string")
    there = spark.createDataFrame([("/m/b.mp3",)], "path string")
    rows = resume.missing_file_errors(tracks, there, CATALOG).collect()
    assert len(rows) == 3 and {r.error for r in rows} == {"File not found: \"/m/it's.mp3\""}
    flags = {r.track_id: r.exists for r in resume.with_existence(tracks, there).collect()}
    assert flags == {"t1": False, "t2": True}


def test_missing_files_looks_at_every_order(spark, tmp_path):
    from trackloom.plans.resume_queries import missing_files

    customers = [(1, "a", "X"), (2, "b", "X"), (3, "c", "X")]
    spark.createDataFrame(customers, "c_custkey bigint, c_name string, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    orders = [(1, "1-URGENT"), (2, "5-LOW"), (2, None)]
    spark.createDataFrame(orders, "o_custkey bigint, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    rows = missing_files(spark, str(tmp_path)).collect()
    assert {r.path for r in rows} == {"cust/c.mp3"} and len(rows) == 6


def test_fatal_cutoff_matches_a_loop(spark):
    rng = random.Random(1)
    rows = [(f"r{0 if rng.random() < .4 else rng.randrange(1, 6)}", i, rng.choice(["CUDA bad", "slow", None, None, None, None])) for i in range(400)]
    df = spark.createDataFrame(rows, "run string, pos int, error string").withColumn("status", F.when(F.col("error").isNull(), "ok").otherwise("error"))
    got = {(r.run, r.pos): (r.skipped, r.status) for r in resume.fatal_cutoff(df, "run", ("pos",), resume.is_fatal()).collect()}
    poisoned, want = set(), {}
    for run, pos, error in rows:
        want[run, pos] = (run in poisoned, "error" if run in poisoned or error else "ok")
        if error and "CUDA" in error:
            poisoned.add(run)
    assert got == want


def test_positions_match_sorting(spark):
    paths = [f"{a}/{i}" for a in ("a b", "a.b", "a", "a-") for i in range(50)]
    random.Random(3).shuffle(paths)
    df = spark.createDataFrame([(p,) for p in paths], "path string").repartition(5)
    by_text = {r.path: (r.idx, r.total) for r in windows.positions(df, ["path"]).collect()}
    assert by_text == {p: (i + 1, len(paths)) for i, p in enumerate(sorted(paths))}
    by_folder = {r.path: r.idx for r in windows.positions(df, [windows.by_components()]).collect()}
    assert by_folder == {p: i + 1 for i, p in enumerate(sorted(paths, key=lambda p: p.split("/")))}
    assert sorted(paths) != sorted(paths, key=lambda p: p.split("/"))  # the two orders differ
    assert {r.label for r in windows.progress_index(df).collect()} >= {"[1/200]", "[200/200]"}


def test_catalog_from_file(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"prompt_set":"s","ord":1,"category":"b","prompt":"B"}\n{"prompt_set":"s","ord":0,"category":"a","prompt":"A"}\n')
    assert read_catalog(spark, str(tmp_path), "s").entries == (("a", "A"), ("b", "B"))
    assert [tuple(r) for r in CATALOG.to_df(spark).collect()][0] == ("c", 0, "genre", "G?")
    with pytest.raises(ValueError):
        Catalog("d", (("a", "1"), ("a", "2")))
