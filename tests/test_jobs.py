import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_annotate import wav
from trackloom.operators import annotate as an
from trackloom.plans import jobs
from trackloom.sinks.log import read_log
from trackloom.sources import records
from trackloom.sources.catalog import Catalog
from trackloom.sources.scan import stream_audio
from trackloom.sources.wav import checked_samples
from trackloom.streaming import jobs as streams

CATALOG = Catalog("c", (("genre", "G?"), ("vocals", "V?")))


class Loudness:
    def prepare(self, content):
        return checked_samples(content)

    def annotate(self, prepared, prompt):
        samples, rate = prepared
        return {"output": f"{prompt} {len(samples) / rate:.1f}s", "processing_time_sec": 0.2}


def music(tmp_path, names):
    root = tmp_path / "music"
    for i, name in enumerate(names):
        f = root / name
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_bytes(b"junk" if "bad" in name else wav(np.zeros(100 * (i + 1), "<i2").tobytes()))
    return str(root)


def test_directory_job_resumes_and_summarises(spark, tmp_path):
    root, log = music(tmp_path, ["A/1.wav", "B/1.wav", "B/bad.wav"]), str(tmp_path / "log")
    jobs.caption_directory(spark, root, log, "r1", CATALOG, Loudness)
    rows = read_log(spark, log).collect()
    assert len(rows) == 6  # same-named tracks of two albums do not share a record
    assert {r.status for r in rows if "bad" in r.track_id} == {"error"}
    jobs.caption_directory(spark, root, log, "r2", CATALOG, Loudness)
    again = read_log(spark, log).where(F.col("run_id") == "r2").collect()
    assert {(r.track_id[-7:], r.status) for r in again} == {("bad.wav", "error")} and len(again) == 2
    jobs.caption_directory(spark, root, log, "r3", CATALOG, overwrite=True)
    assert read_log(spark, log).where("run_id = 'r3' and output like '[DRY RUN%'").count() == 6

    out = tmp_path / "out"
    jobs.summarize_log(spark, log, str(out), CATALOG, run_id="r1")
    document = json.loads("".join(p.read_text() for p in sorted((out / "results_summary.json").glob("part-*"))))
    assert document["total_tracks"] == 3 and document["categories"] == ["genre", "vocals"]
    assert [t["file"] for t in document["tracks"]] == ["1.wav", "1.wav", "bad.wav"]
    assert document["tracks"][0]["categories"]["genre"]["output"] == "G? 1.0s"
    table = spark.read.option("header", True).csv(str(out / "results_summary.csv"))
    assert table.columns == ["file", "path", "genre", "vocals"] and table.count() == 3


def test_stream_annotates_new_files_only(spark, tmp_path):
    root, log, mark = music(tmp_path, ["A/1.wav", "A/2.wav", "A/3.wav"]), str(tmp_path / "log"), str(tmp_path / "mark")

    def annotate(todo):
        return an.annotate(todo, Loudness)

    def drain(run):
        tracks = stream_audio(spark, root, max_files=2).withColumn("track_id", F.col("path"))
        streams.resume_annotation(spark, tracks, CATALOG, log, run, mark, annotate).awaitTermination()

    drain("r1")
    assert read_log(spark, log).count() == 6
    assert read_log(spark, log).select("batch_id").distinct().count() == 2
    music(tmp_path, ["A/4.wav"])
    drain("r1")
    assert read_log(spark, log).count() == 8
    drain("r1")
    assert read_log(spark, log).count() == 8


def test_mirror_adds_each_file_once(spark, tmp_path):
    source, target, mark = tmp_path / "src", str(tmp_path / "dst"), str(tmp_path / "mark")
    source.mkdir()
    (source / "a.json").write_text('{"file": "a"}\n')
    schema = spark.createDataFrame([], "file string").schema

    def drain():
        streams.mirror(spark, str(source), schema, target, mark, every=None, format="json").awaitTermination()
        return sorted(r.file for r in spark.read.parquet(target).collect())

    assert drain() == ["a"]
    (source / "b.json").write_text('{"file": "b"}\n')
    assert drain() == ["a", "b"]
    assert drain() == ["a", "b"]


def test_manifest_job(spark, tmp_path):
    root, log = music(tmp_path, ["A/1.wav", "A/2.wav"]), str(tmp_path / "log")
    manifest = tmp_path / "job.json"
    manifest.write_text(json.dumps({"globals": {"prompt_mode": "custom", "custom_prompt": "Say."}, "tracks": [
        {"path": "A/2.wav"}, {"path": "A/gone.wav"}, {"path": "A/1.wav", "prompt_mode": "minimal"}, {"path": "A/1.wav"}]}))
    jobs.caption_job(spark, str(manifest), root, log, "j1", str(tmp_path / "out"), make_annotator=Loudness)
    rows = {r.entry: r for r in read_log(spark, log).collect()}
    assert {e: r.track_id[-5:] for e, r in rows.items()} == {0: "2.wav", 2: "1.wav", 3: "1.wav"}
    # the same file twice: each entry has its own prompt
    assert rows[0].output == "Say. 2.0s" and rows[2].category == "minimal" and rows[3].output == "Say. 1.0s"
    document = json.loads("".join(p.read_text() for p in sorted((tmp_path / "out" / "results_summary.json").glob("part-*"))))
    assert (document["total_tracks"], document["ok_count"], document["fail_count"]) == (4, 3, 1)
    gone = [r for r in document["results"] if r["file"] == "gone.wav"][0]
    assert gone["error"] == "File not found: 'A/gone.wav'" and "output_file" not in gone and gone["prompts_ok"] == 0

    jobs.caption_job(spark, str(manifest), root, log, "j2", str(tmp_path / "out2"), catalog=CATALOG)
    assert read_log(spark, log).where("run_id = 'j2'").count() == 6
    written = {p.name: json.loads(p.read_text()) for p in (tmp_path / "out2" / "records").iterdir() if p.suffix == ".json"}
    assert sorted(r["entry"] for r in written.values()) == [0, 2, 3]
    assert all(set(r["categories"]) == {"genre", "vocals"} and r["status"] == "ok" for r in written.values())
    # every record that the summary names is there; the entry without a file has none
    for folder in ("out", "out2"):
        document = json.loads("".join(p.read_text() for p in sorted((tmp_path / folder / "results_summary.json").glob("part-*"))))
        named = [r["output_file"] for r in document["results"] if "output_file" in r]
        assert len(set(named)) == 3 and "records/2.caption.json" in named
        assert all(json.loads((tmp_path / folder / name).read_text())["file"] in ("1.wav", "2.wav") for name in named)
    assert (document["precision"], document["mixed_precision"]) == ("bf16", False)
    assert "timestamp" in document
    manifest.write_text(json.dumps({"tracks": [{"path": "A/1.wav", "prompt_mode": "custom"}]}))
    with pytest.raises(ValueError, match="needs a custom prompt"):
        jobs.caption_job(spark, str(manifest), root, log, "j3", str(tmp_path / "out3"))


class Window:
    def prepare(self, content):
        return len(content)

    def annotate(self, prepared, prompt):
        if prepared < 100 and prompt == "V?":
            raise RuntimeError("too short")
        return {"output": f" {prompt}{prepared} "}


def test_window_job(spark, tmp_path):
    root = music(tmp_path, ["1.wav", "2.wav", "bad.wav", "3.wav", "4.wav"])
    jobs.caption_windows(spark, root, str(tmp_path / "out"), CATALOG, Window, window_sec=1.5)
    long = records.read_responses(spark, str(tmp_path / "out"), "chunks", pretty=False)
    rows = {(r.file, r.chunk_index, r.category): r for r in long.collect()}
    assert {f for f, _, _ in rows} == {"1.wav", "2.wav", "3.wav", "4.wav"} - {"bad.wav"}
    # one second, windows of 1.5: the second window is empty, the middle halves are short
    assert {i for f, i, _ in rows if f == "1.wav"} == {0, 2, 3}
    assert rows["1.wav", 2, "genre"].output == "G?50"
    assert (rows["1.wav", 2, "vocals"].status, rows["1.wav", 2, "vocals"].error) == ("error", "too short")
    assert rows["4.wav", 1, "vocals"].output == "V?150"


def test_runs_under_one_id_lose_nothing(spark, tmp_path):
    root, log = music(tmp_path, ["A/1.wav", "A/2.wav"]), str(tmp_path / "log")
    for names, total in ((["A/1.wav", "A/2.wav"], 4), ([], 4), (["A/1.wav", "A/2.wav", "A/3.wav"], 6)):
        music(tmp_path, names)
        jobs.caption_directory(spark, root, log, "same", CATALOG, Loudness)
        rows = read_log(spark, log).collect()
        assert len(rows) == total == len({(r.track_id, r.category) for r in rows})


def test_stream_with_a_new_checkpoint_keeps_old_rows(spark, tmp_path):
    root, log = music(tmp_path, ["A/1.wav"]), str(tmp_path / "log")

    def drain(mark):
        tracks = stream_audio(spark, root, with_content=False).withColumn("track_id", F.col("path"))
        streams.resume_annotation(
            spark, tracks, CATALOG, log, "same", str(tmp_path / mark),
            lambda todo: an.annotate(todo, Loudness, content="path", opened=True),
        ).awaitTermination()

    drain("one")
    music(tmp_path, ["A/1.wav", "A/2.wav"])
    drain("two")
    rows = read_log(spark, log).collect()
    assert len(rows) == 4 and {r.status for r in rows} == {"ok"}


def test_only_pending_files_are_read(spark, tmp_path):
    import os

    root, log = music(tmp_path, ["A/1.wav", "A/2.WAV"]), str(tmp_path / "log")
    jobs.caption_directory(spark, root, log, "r", CATALOG, Loudness)
    os.remove(f"{root}/A/1.wav")
    os.symlink("/proc/kcore", f"{root}/A/big.zip")  # neither readable nor of a size to read
    open(f"{root}/A/1.wav", "wb").close()
    os.chmod(f"{root}/A/1.wav", 0)
    with open(f"{root}/A/3.wav", "wb") as f:
        f.write(wav(np.zeros(100, "<i2").tobytes()))
    jobs.caption_directory(spark, root, log, "r", CATALOG, Loudness)
    rows = read_log(spark, log).collect()
    assert {(r.track_id[-5:], r.status) for r in rows} == {("1.wav", "ok"), ("2.WAV", "ok"), ("3.wav", "ok")}


def test_samples_reach_the_annotator_as_numbers(spark):
    class Mean:
        def prepare(self, content):
            assert isinstance(content, np.ndarray)
            return float(content.mean())

        def annotate(self, prepared, prompt):
            return {"output": f"{prepared:.1f}"}

    todo = spark.createDataFrame([("a", [1.0, 2.0])], "track_id string, content array<float>").withColumn("prompts", CATALOG.as_array())
    assert {r.output for r in an.annotate(todo, Mean).collect()} == {"1.5"}


def test_refresh_takes_rewritten_records(spark, tmp_path):
    import os

    source, target = tmp_path / "src", str(tmp_path / "dst")
    source.mkdir()
    for name in "ab":
        (source / f"{name}.caption.json").write_text(f'{{"file": "{name}", "n": 1}}')
    assert streams.refresh(spark, str(source), target) == 2
    assert streams.refresh(spark, str(source), target) == 0
    (source / "a.caption.json").write_text('{"file": "a", "n": 2}')
    os.utime(source / "a.caption.json", (2_000_000_000, 2_000_000_000))
    assert streams.refresh(spark, str(source), target) == 1
    assert sorted(json.loads(r.value)["n"] for r in streams.read_refreshed(spark, target).collect()) == [1, 2]


class Breaking:
    def prepare(self, content):
        return content

    def annotate(self, prepared, prompt):
        if prepared == b"3":
            raise RuntimeError("CUDA error: out of luck")
        return {"output": prompt}


def test_a_broken_worker_tries_no_more(spark):
    todo = spark.createDataFrame([(i, str(i).encode()) for i in range(6)], "track_id int, content binary").coalesce(1)
    rows = an.annotate(todo.withColumn("prompts", CATALOG.as_array()), Breaking, fatal="CUDA").collect()
    errors = {(r.track_id, r.category): (r.error or "")[:7] for r in rows}
    assert len(rows) == 12 and all(not errors[i, c] for i in (0, 1, 2) for c in ("genre", "vocals"))
    assert errors[3, "genre"] == "CUDA er" and errors[3, "vocals"] == "Skipped" and errors[5, "genre"] == "Skipped"


class Configured:
    def configure(self, settings):
        self.settings = settings

    def prepare(self, content):
        return len(content)

    def annotate(self, prepared, prompt):
        return {"output": f"{self.settings['precision']} {self.settings['max_new_tokens']}"}


def test_settings_reach_annotator_log_and_summary(spark, tmp_path):
    root, log = music(tmp_path, ["1.wav", "2.wav"]), str(tmp_path / "log")
    manifest = tmp_path / "job.json"
    manifest.write_text(json.dumps({"globals": {"precision": "4bit"}, "tracks": [
        {"path": "1.wav", "max_new_tokens": 9999}, {"path": "2.wav", "precision": "bf16", "max_new_tokens": "64"}]}))
    jobs.caption_job(spark, str(manifest), root, log, "j", str(tmp_path / "out"), make_annotator=Configured)
    rows = {r.track_id[-5:]: (r.output, r.precision, r.max_new_tokens) for r in read_log(spark, log).collect()}
    ceiling = rows["1.wav"][2]
    assert rows == {"1.wav": (f"4bit {ceiling}", "4bit", ceiling), "2.wav": ("bf16 64", "bf16", 64)} and ceiling < 9999
    document = json.loads("".join(p.read_text() for p in sorted((tmp_path / "out" / "results_summary.json").glob("part-*"))))
    assert (document["precision"], document["mixed_precision"]) == ("4bit", True)


def test_a_run_that_dies_keeps_its_finished_rounds(spark, tmp_path, monkeypatch):
    names = [f"A/{i}.wav" for i in range(12)]
    root, log, out = music(tmp_path, names), str(tmp_path / "log"), tmp_path / "records"
    real, calls = jobs.write_batch, []

    def dies(*args):
        calls.append(args[3])
        if len(calls) == 3:
            raise KeyboardInterrupt("the driver is lost")
        return real(*args)

    monkeypatch.setattr(jobs, "write_batch", dies)
    with pytest.raises(KeyboardInterrupt):
        jobs.caption_directory(spark, root, log, "r", CATALOG, Loudness, records=str(out), round_tracks=3)
    done = read_log(spark, log).select("track_id", "batch_id").distinct().collect()
    assert {r.batch_id for r in done} == {0, 1} and 2 <= len(done) < 12
    # the records of finished rounds are there, whole
    assert {json.loads(p.read_text())["path"] for p in out.glob("*.caption.json")} == {r.track_id for r in done}
    monkeypatch.setattr(jobs, "write_batch", real)
    again = jobs.caption_directory(spark, root, log, "r2", CATALOG, Loudness, records=str(out), round_tracks=3)
    rows = read_log(spark, log).collect()
    assert again >= 1 and len(rows) == 24 == len({(r.track_id, r.category) for r in rows})
    assert not {r.track_id for r in rows if r.run_id == "r2"} & {r.track_id for r in done}
    found = [json.loads(p.read_text()) for p in out.glob("*.caption.json")]
    assert len(found) == 12 and all(set(r["categories"]) == {"genre", "vocals"} for r in found)
    assert jobs.caption_directory(spark, root, log, "r3", CATALOG, Loudness, records=str(out), round_tracks=3) == 0


def test_rounds_follow_the_clock(spark):
    from trackloom.operators.rounds import in_rounds

    rows = spark.range(2000).select(F.col("id").cast("string").alias("track_id"))
    now, sizes, seen = [0.0], [], []

    def run(part, number):
        got = [r.track_id for r in part.collect()]
        seen.extend(got)
        sizes.append(len(got))
        now[0] += len(got) / 10  # ten tracks a second

    rounds = in_rounds(rows, run, seconds=20, clock=lambda: now[0])
    assert sorted(map(int, seen)) == list(range(2000)) and rounds == len(sizes)
    assert max(sizes) < 300 and sizes[0] < 30 and sum(100 < s < 300 for s in sizes) >= rounds // 2
    assert in_rounds(rows, lambda part, n: None) == 1
    assert in_rounds(rows.limit(0), run) == 0


def test_records_add_up_over_runs(spark, tmp_path):
    """A track's file has the answers of all runs; tracks of one name have files of their own."""
    root, log, out = music(tmp_path, ["A/1.wav", "B/1.wav", "B/2.wav"]), str(tmp_path / "log"), tmp_path / "records"
    one = Catalog("c", (("genre", "G?"),))
    jobs.caption_directory(spark, root, log, "r1", one, Loudness, records=str(out))
    jobs.caption_directory(spark, root, log, "r2", CATALOG, Loudness, records=str(out))
    found = {p.name: json.loads(p.read_text()) for p in out.iterdir()}
    assert len(found) == 3 and "2.caption.json" in found
    assert {r["path"][-7:] for r in found.values()} == {"A/1.wav", "B/1.wav", "B/2.wav"}
    assert all(list(r["categories"]) == ["genre", "vocals"] for r in found.values())


def test_stream_state_knows_what_is_done(spark, tmp_path):
    """Failed prompts are tried again, done ones are not; no batch after the first reads the log."""
    from trackloom.sinks.log import compact_log
    from trackloom.streaming.state import annotate_stream

    root, log, mark, inbox = music(tmp_path, ["1.wav", "2.wav", "bad.wav"]), str(tmp_path / "log"), str(tmp_path / "mark"), tmp_path / "inbox"
    jobs.caption_directory(spark, root, log, "earlier", Catalog("c", (("genre", "G?"),)), Loudness)
    compact_log(spark, log)

    def arrive(*names):
        rows = spark.createDataFrame([(f"{root}/{n}", f"{root}/{n}") for n in names], "track_id string, uri string")
        rows.coalesce(1).write.mode("append").parquet(str(inbox))
        stream = spark.readStream.schema(rows.schema).parquet(str(inbox))
        query = annotate_stream(spark, stream, CATALOG, log, "s", mark, Loudness)
        query.awaitTermination()
        return query

    arrive("1.wav", "1.wav", "bad.wav")
    rows = sorted((r.track_id.rsplit("/", 1)[1], r.category, r.status) for r in read_log(spark, log).where("run_id = 's'").collect())
    assert rows == [("1.wav", "vocals", "ok"), ("bad.wav", "genre", "error"), ("bad.wav", "vocals", "error")]
    music(tmp_path, ["x.wav"])
    (tmp_path / "music" / "bad.wav").write_bytes((tmp_path / "music" / "x.wav").read_bytes())
    query = arrive("1.wav", "bad.wav", "2.wav")
    second = read_log(spark, log).where("run_id = 's' and batch_id = 1").collect()
    assert sorted((r.track_id.rsplit("/", 1)[1], r.category, r.status) for r in second) == [
        ("2.wav", "vocals", "ok"), ("bad.wav", "genre", "ok"), ("bad.wav", "vocals", "ok")]
    plan = query._jsq.explainInternal(False)
    assert log not in plan and "TransformWithState" in plan
    arrive("2.wav", "bad.wav")
    assert read_log(spark, log).where("run_id = 's' and batch_id = 2").count() == 0


def test_a_first_batch_that_died_is_done_again(spark, tmp_path):
    """Its folder is there, its commit is not: the replay gives the same rows and does not take itself as done."""
    import os

    from trackloom.streaming.state import annotate_stream

    log, mark, inbox = str(tmp_path / "log"), tmp_path / "mark", str(tmp_path / "inbox")
    spark.createDataFrame([("a",), ("b",)], "track_id string").coalesce(1).write.parquet(inbox)

    def drain():
        stream = spark.readStream.schema("track_id string").parquet(inbox)
        annotate_stream(spark, stream, CATALOG, log, "s", str(mark)).awaitTermination()
        return sorted((r.track_id, r.category, r.output, r.attempt) for r in read_log(spark, log).collect())

    first = drain()
    assert len(first) == 4
    for name in ("0", ".0.crc"):
        os.remove(mark / "commits" / name)
    assert drain() == first


def test_a_track_reads_and_writes_its_state_once():
    from pyspark.sql import Row
    from trackloom.streaming.state import Progress

    class Value:
        def __init__(self):
            self.value, self.calls = None, 0

        def get(self):
            self.calls += 1
            return self.value

        def update(self, value):
            self.calls += 1
            self.value = value

    value = Value()
    handle = type("Handle", (), {"getValueState": lambda self, name, schema: value})()
    processor = Progress([(f"k{i}", "?") for i in range(9)], None, None, None)
    processor.init(handle)
    processor.handleInitialState(("t",), Row(track_id="t", ok_categories=["k3", "k4"]), None)
    told = list(processor.handleInputRows(("t",), iter([Row(track_id="t"), Row(track_id="t")]), None))
    assert [r.category for r in told] == ["k0", "k1", "k2", "k5", "k6", "k7", "k8"] and value.calls == 3
    assert list(processor.handleInputRows(("t",), iter([Row(track_id="t")]), None)) == [] and value.calls == 4
