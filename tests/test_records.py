import csv
import json

import pytest
from pyspark.sql import functions as F

from trackloom.model import CHUNK_RECORD, FLAT_RECORD, KEYED_RECORD, ORDERED_RECORD
from trackloom.operators import quality, summarize
from trackloom.sinks.documents import write_summary_csv
from trackloom.sinks.log import export_records, read_log, write_batch
from trackloom.sources import records, scan

OKAY = {"status": "ok", "output": 'said "hi",\n 90 BPM‑ish ', "error": None, "traceback": None,
        "processing_time_sec": 1.5, "audio_windows": 1, "audio_covered_sec": 30, "output_truncated": False, "prompt_used": "p"}
SHORT = {"status": "error", "output": None, "error": "gone"}  # written on early failure: three keys only


@pytest.fixture
def folder(tmp_path):
    def put(**documents):
        for name, document in documents.items():
            text = document if isinstance(document, str) else json.dumps(document, indent=2, ensure_ascii=False)
            (tmp_path / f"{name}.caption.json").write_text(text, encoding="utf-8")
        return str(tmp_path)

    return put


def test_keyed_records(spark, folder):
    path = folder(
        a={"file": "a.mp3", "path": "/x/a.mp3", "model_id": "m", "categories": {"genre": OKAY, "vocals": SHORT}},
        b={"file": "b.mp3", "path": "/x/b.mp3", "categories": {}},
        c={"file": "c.mp3", "path": "/x/c.mp3", "categories": None},
        d="{ torn", e={"file": "e.mp3"},
    )
    (scan_path := folder()) and open(f"{scan_path}/other.json", "w").write('{"file": "no"}')
    rows = {r.category: r for r in records.read_responses(spark, path, "keyed").collect()}
    assert set(rows) == {"genre", "vocals"}
    assert rows["genre"].output == OKAY["output"] and rows["genre"].audio_covered_sec == 30
    assert (rows["vocals"].status, rows["vocals"].error, rows["vocals"].processing_time_sec) == ("error", "gone", None)
    counts = records.count_corrupt(spark, path, KEYED_RECORD).first()
    assert (counts.records, counts.corrupt) == (5, 3)


def test_ordered_flat_and_chunk_records(spark, folder):
    ordered = folder(o={"file": "o.mp3", "model_id": "m", "status": "partial", "tags": {"n": 1}, "total_processing_time_sec": 3.0,
                        "responses": [{"prompt_index": 0, "prompt": "p", "raw_output": "x", "processing_time_sec": 3.0, "status": "ok", "error": None},
                                      {"prompt_index": 1, "prompt": "q", "raw_output": None, "processing_time_sec": None, "status": "error", "error": "bad"}]})
    rows = records.read_responses(spark, ordered, "ordered").orderBy("prompt_ord").collect()
    assert [(r.prompt_ord, r.output, r.status) for r in rows] == [(0, "x", "ok"), (1, None, "error")]
    rolled = summarize.track_rollup(records.read_responses(spark, ordered, "ordered")).first()
    assert (rolled.status, rolled.total_processing_time_sec, rolled.prompts_ok) == ("partial", 3.0, 1)

    flat = spark.createDataFrame([("f.mp3", "m", "minimal", "p", "x", 2.0, {"a": "b"}, "ok", None)], FLAT_RECORD)
    assert records.flatten_flat(flat).first().output == "x"

    chunks = spark.createDataFrame([((("m", "2025", "/x/w.wav", 90.0, 40.0, 2, "quick")),
                                     [(0, "start", 0.0, 40.0, {"summary": "oud"}), (3, "post_mid", 45.0, 85.0, {"summary": "ERROR: full"})])], CHUNK_RECORD)
    got = {r.chunk_index: r for r in records.flatten_chunks(chunks).collect()}
    assert (got[0].status, got[0].output, got[3].status, got[3].error, got[3].output) == ("ok", "oud", "error", "full", None)
    everything = records.union_responses(records.flatten_flat(flat), records.flatten_chunks(chunks))
    assert everything.count() == 3


def test_nest_then_flatten_is_identity(spark, tmp_path):
    rows = [(t, i, f"out {t} {i}\n", "ok" if i % 2 else "error", None) for t in ("a", "b") for i in range(25)]
    long = spark.createDataFrame(rows, "track_id string, prompt_ord bigint, output string, status string, error string")
    nested = summarize.nest_ordered(long, part_size=10)
    assert sorted((r.track_id, r.part, len(r.responses)) for r in nested.collect()) == [
        (t, p, n) for t in ("a", "b") for p, n in ((0, 10), (1, 10), (2, 5))
    ]
    back = nested.select("track_id", F.inline("responses"))
    assert sorted(back.select("track_id", "prompt_ord", "output", "status").collect()) == sorted(
        long.select("track_id", "prompt_ord", "output", "status").collect()
    )


def test_export_keeps_nulls_and_reads_back(spark, tmp_path):
    documents = spark.createDataFrame([("a.mp3", "/a.mp3", "m", "2025", {"genre": None})], KEYED_RECORD)
    export_records(documents, str(tmp_path / "out"))
    line = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    assert json.loads(line)["categories"] == {"genre": None}
    assert records.read_records(spark, str(tmp_path / "out"), KEYED_RECORD, pretty=False).count() == 1
    assert ORDERED_RECORD["responses"] is not None


def test_summary_csv_is_plain_csv(spark, tmp_path):
    log = spark.createDataFrame(
        [("a.mp3", "/a.mp3", "genre", "ok", OKAY["output"], None, 1), ("a.mp3", "/a.mp3", "vocals", "error", None, "no, \"go\"", 1),
         ("a.mp3", "/a.mp3", "genre", "error", None, "older", 0)],
        "file string, path string, category string, status string, output string, error string, updated_at int",
    )
    pivot = summarize.summary_pivot(log, ["genre", "vocals", "mastering"])
    write_summary_csv(pivot, str(tmp_path / "csv"))
    part = max((tmp_path / "csv").glob("part-*"), key=lambda p: p.stat().st_size)
    with open(part, encoding="utf-8", newline="") as f:
        rows = list(csv.reader(f))
    assert rows == [["file", "path", "genre", "vocals", "mastering"],
                    ["a.mp3", "/a.mp3", 'said "hi",  90 BPM‑ish', '[error] no, "go"', "[missing]"]]


def test_only_a_replay_of_a_stream_replaces_its_batch(spark, tmp_path):
    path = str(tmp_path / "log")
    assert read_log(spark, path).count() == 0
    batch = spark.createDataFrame([("t", "genre", "ok")], "track_id string, category string, status string")
    for _ in range(2):
        write_batch(batch, path, "run", 0, "stream")
    write_batch(batch, path, "run", 1, "stream")
    rows = read_log(spark, path).collect()
    assert sorted((r.run_id, r.batch_id, r.attempt) for r in rows) == [("run", 0, "stream"), ("run", 1, "stream")]
    for _ in range(2):
        write_batch(batch, path, "run", 0)
    assert read_log(spark, path).where("run_id = 'run' and batch_id = 0").count() == 3


def test_scan_reads_no_content_unless_asked(spark, tmp_path):
    from conftest import plan_of

    for name in ["b/B.MP3", "a.wav", "notes.txt", "._a.mp3", "c.m4a", "d.aac"]:
        f = tmp_path / name
        f.parent.mkdir(exist_ok=True)
        f.write_bytes(b"xyz")
    found = scan.scan_audio(spark, str(tmp_path))
    assert sorted(r.file for r in found.collect()) == ["B.MP3", "a.wav", "c.m4a"]
    assert "content:" not in plan_of(found)
    flat = scan.scan_audio(spark, str(tmp_path), ["wav", "mp3"], recursive=False)
    assert [r.file for r in flat.collect()] == ["a.wav"]
    snapshot = found.where(F.col("file") != "a.wav")
    assert [r.file for r in scan.changed_files(found, snapshot).collect()] == ["a.wav"]
    assert scan.scan_audio(spark, str(tmp_path), ["opus"]).count() == 0


def test_rollup_of_nothing_is_ok(spark):
    none = spark.createDataFrame([], "track_id string, status string, processing_time_sec double")
    tracks = spark.createDataFrame([("t",)], "track_id string")
    row = summarize.track_rollup(none, tracks).first()
    assert (row.status, row.prompts_total, row.total_processing_time_sec) == ("ok", 0, 0.0)
    totals = summarize.run_summary(summarize.track_rollup(none, tracks)).first()
    assert (totals.total_tracks, totals.ok_count, totals.fail_count) == (1, 1, 0)


def test_profiles(spark):
    df = spark.createDataFrame([("ab", [1, 2], {"k": "v"}), (None, None, {"k": None, "z": "1"})], "s string, a array<int>, m map<string,string>")
    rows = {r.column_name: r for r in quality.profile_collection(df).collect()}
    assert (rows["s"].rows, rows["s"].non_null, rows["s"].max_length) == (2, 1, 2)
    assert (rows["a"].min_length, rows["m"].max_length, rows["a"].type) == (2, 2, "array<int>")
    keys = {r.key: (r.present, r.non_null) for r in quality.key_profile(df, "m").collect()}
    assert keys == {"k": (2, 1), "z": (1, 1)}


def test_windows_move_once_and_their_records_are_compressed(spark, tmp_path):
    from conftest import plan_of
    from trackloom.operators import summarize

    rows = [("t", w, float(w), w + 1.0, k, f"{k}{w}{n}", n) for w in (1, 0, 7) for k in ("a", "b", "c") for n in (2, 1)] + [("t", None, 0.0, 1.0, "a", "lost", 9), ("u", 0, 0.0, 1.0, "a", None, 1)]
    captions = spark.createDataFrame(rows, "path string, chunk_index int, start_seconds double, end_seconds double, category string, output string, at int")
    nested = summarize.nest_windows(captions, ["a", "b"], order=("at",))
    plan = plan_of(nested).split("\n\n\n")[0]
    tree = plan[:plan.index("\n\n(1)")] if "\n\n(1)" in plan else plan
    assert tree.count("Exchange (") == 1 and "Sort" not in tree[tree.index("Exchange ("):]
    got = {r.path: [(x.chunk_index, x.start_seconds, x.captions) for x in r.chunks] for r in nested.collect()}
    assert got == {"t": [(w, float(w), {"a": f"a{w}2", "b": f"b{w}2"}) for w in (0, 1, 7)], "u": [(0, 0.0, {})]}

    from pyspark.sql import functions as F
    documents = nested.select(F.struct(F.lit("m").alias("model"), F.col("path").alias("audio_file"), "total_chunks").alias("metadata"), "chunks")
    export_records(documents, str(tmp_path / "packed"), "gzip")
    assert any((tmp_path / "packed").glob("*.json.gz")) and not any((tmp_path / "packed").glob("*.json"))
    read = records.read_responses(spark, str(tmp_path / "packed"), "chunks", pretty=False)
    assert {(r.track_id, r.chunk_index, r.category, r.output) for r in read.collect()} == {("t", w, k, f"{k}{w}2") for w in (0, 1, 7) for k in "ab"}
