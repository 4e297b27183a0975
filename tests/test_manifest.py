import json

import pytest
from pyspark.sql import functions as F

from trackloom.operators import config
from trackloom.plans import jobs
from trackloom.sources import manifests

MANIFEST = {
    "globals": {"model_id": "m9", "precision": "bf16", "max_new_tokens": 600, "output_dir": "./out/", "tags": {"a": "g"}},
    "tracks": [
        {"path": "A/01. One.mp3", "tags": {"title": "One", "year": 1999}},
        {"path": "A/02. Two.mp3", "precision": None, "max_new_tokens": 128},
        {"path": "B/01. One.mp3", "precision": "4bit", "tags": "none"},
    ],
}


@pytest.fixture
def manifest(tmp_path):
    def write(document, name="m.json"):
        path = tmp_path / name
        path.write_text(json.dumps(document, indent=2, ensure_ascii=False))
        return str(path)

    return write


def test_settings_follow_key_presence(spark, manifest):
    rows = config.resolve_settings(manifests.read_manifest(spark, manifest(MANIFEST))).orderBy("track_index").collect()
    assert [r.path for r in rows] == [t["path"] for t in MANIFEST["tracks"]]
    assert [r.model_id for r in rows] == ["m9"] * 3
    assert [r.precision for r in rows] == ["bf16", None, "4bit"]  # an explicit null wins and stays null
    assert [(r.max_new_tokens, r.clamped) for r in rows] == [(512, True), (128, False), (512, True)]
    assert [r.prompt_mode for r in rows] == ["minimal"] * 3
    # a track's tags replace those of the globals as a whole; non-objects become empty
    assert [r.tags for r in rows] == [{"title": "One", "year": "1999"}, {}, {}]


def test_mixed_settings(spark, manifest):
    settings = config.resolve_settings(manifests.read_manifest(spark, manifest(MANIFEST)))
    row = config.mixed_settings(settings, "precision").first()
    assert (row.used, row.n_values, row.mixed) == ("bf16", 3, True)  # no precision is one of them


@pytest.mark.parametrize("document,reason", [
    ({"globals": {}, "tracks": []}, "The manifest lists no tracks."),
    ({"tracks": [{"path": "a"}, {"tags": {}}]}, "Entry 1 of the manifest has no path."),
    ({"tracks": [{"path": None}]}, "Entry 0 of the manifest has no path."),
])
def test_bad_manifests_are_rejected(spark, manifest, document, reason):
    path = manifest(document)
    assert config.manifest_rejects(manifests.read_manifest(spark, path)).first().reason == reason
    with pytest.raises(ValueError, match=reason.split(".")[0]):
        jobs.resolve_job(spark, path)


def test_globals_may_be_absent(spark, manifest):
    assert jobs.resolve_job(spark, manifest({"tracks": [{"path": "a.mp3"}]})).first().max_new_tokens == 256


def test_merge_layers_keeps_open_keys(spark):
    row = spark.sql("select map('a','1','b','2') g, map('b',cast(null as string),'c','3') t")
    assert row.select(config.merge_layers(F.col("g"), F.col("t"))).first()[0] == {"a": "1", "b": None, "c": "3"}


def test_prompt_modes(spark):
    rows = spark.createDataFrame(
        [("minimal", None), ("custom", "Say."), ("custom", ""), ("loud", None), (None, None)], "prompt_mode string, custom_prompt string"
    )
    prompt, reason = config.prompt_for_mode()
    got = rows.select(prompt.alias("p"), reason.alias("r")).collect()
    assert [bool(r.p) for r in got] == [True, True, False, False, False]
    assert all((r.p is None) != (r.r is None) for r in got)


def test_request_rules(spark):
    rows = spark.createDataFrame(
        [("10", "1.0", "4/4", ""), ("x", "nan", "y/4", "long"), (None, None, None, None), ("301", "20.1", "5", "ok")],
        "n string, f string, t string, l string",
    )
    rules = {
        "n": config.breaks_int_range("n", 10, 300), "f": config.breaks_float_range("f", 1.0, 20.0),
        "t": config.breaks_time_signature("t", [2, 3, 4, 6]), "l": config.breaks_max_length("l", 3),
    }
    got = [r[0] for r in rows.select(config.violations(rules)).collect()]
    assert got == [[], ["n", "f", "t", "l"], [], ["n", "f", "t"]]


def test_requested_categories(spark):
    from trackloom.sources.catalog import KEYED

    assert KEYED.subset(" vocals ,genre,,vocals").keys == ["vocals", "genre"]  # duplicates run once
    with pytest.raises(ValueError, match="mood"):
        KEYED.subset("genre,mood")


def test_build_filter_and_reread(spark, tmp_path):
    for name in ["A/02. Two.mp3", "A/01. One.MP3", "A b/01. One.flac", "A/notes.txt", "A/Solo.ogg"]:
        f = tmp_path / "music" / name
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_bytes(b"x")
    settings = spark.range(1).select(F.lit("m1").alias("model_id"), F.lit(512).alias("max_new_tokens"))
    first, second = str(tmp_path / "one"), str(tmp_path / "two")
    jobs.build_manifest(spark, str(tmp_path / "music"), first, settings, recursive=True)
    whole = "".join(p.read_text() for p in sorted((tmp_path / "one").glob("part-*")))
    document = json.loads(whole)  # the parts in name order are one valid document
    assert document["globals"] == {"model_id": "m1", "max_new_tokens": 512}
    assert [t["path"] for t in document["tracks"]] == [
        "music/A/01. One.MP3", "music/A/02. Two.mp3", "music/A/Solo.ogg", "music/A b/01. One.flac",
    ]  # folder by folder, not as text
    assert document["tracks"][0]["tags"] == {"title": "One", "track_number": 1}
    assert document["tracks"][2]["tags"] == {"title": "Solo"}

    done = tmp_path / "done"
    done.mkdir()
    (done / "x.caption.json").write_text(json.dumps({"file": "02. Two.mp3"}, indent=2))
    (done / "results_summary.json").write_text(json.dumps({"total": 1}, indent=2))
    counts = jobs.filter_manifest(spark, first, str(done), second).first()
    assert (counts.total_before, counts.total_done, counts.total_left, counts.balanced) == (4, 1, 3, True)
    left = manifests.read_manifest_lines(spark, second)
    assert left.count() == 3
    settings_again = manifests.read_manifest_globals(spark, second).first()[0]
    assert settings_again == {"model_id": "m1", "max_new_tokens": "512"}
    resolved = jobs.resolve_job(spark, second, framed=True)
    assert {r.model_id for r in resolved.collect()} == {"m1"}


def test_empty_manifest_is_still_a_document(spark, tmp_path):
    from trackloom.sinks.documents import write_manifest

    settings = spark.range(1).select(F.lit("m1").alias("model_id"))
    none = spark.createDataFrame([], "path string, tags struct<title:string>")
    write_manifest(settings, none, str(tmp_path / "m"))
    whole = "".join(p.read_text() for p in sorted((tmp_path / "m").glob("part-*")))
    assert json.loads(whole) == {"globals": {"model_id": "m1"}, "tracks": []}


def test_filter_keeps_entries_as_they_stand(spark, tmp_path, manifest):
    document = {"globals": {"model_id": "m", "max_new_tokens": 512, "deep": {"a": [1, None]}}, "tracks": [
        {"path": "B/2.mp3", "tags": {"track_number": 2, "title": "é, \"x\""}, "precision": None},
        {"path": "A/1.mp3", "max_new_tokens": 128}, {"path": "B/2.mp3", "prompt_mode": "minimal"}, {"path": "C/1.mp3"}, {"path": "C/9.mp3"}]}
    done = tmp_path / "done"
    done.mkdir()
    (done / "x.caption.json").write_text(json.dumps({"file": "1.mp3", "path": "A/1.mp3"}, indent=2))

    def read(folder):
        return json.loads("".join(p.read_text() for p in sorted((tmp_path / folder).glob("part-*"))))

    counts = jobs.filter_manifest(spark, manifest(document), str(done), str(tmp_path / "by_path"), key="path").first()
    want = {**document, "tracks": [t for t in document["tracks"] if t["path"] != "A/1.mp3"]}
    assert read("by_path") == want and tuple(counts) == (5, 1, 4, True)
    # the line-framed form again, by name: C/1.mp3 goes too
    counts = jobs.filter_manifest(spark, str(tmp_path / "by_path"), str(done), str(tmp_path / "by_name")).first()
    assert read("by_name") == {**want, "tracks": [t for t in want["tracks"] if t["path"] != "C/1.mp3"]}
    assert tuple(counts) == (4, 1, 3, True)
    resolved = jobs.resolve_job(spark, str(tmp_path / "by_name"), framed=True).orderBy("track_index").collect()
    assert [(r.track_index, r.path, r.max_new_tokens) for r in resolved] == [(0, "B/2.mp3", 512), (1, "B/2.mp3", 512), (2, "C/9.mp3", 512)]


def test_unreadable_numbers_are_rejected(spark, manifest):
    bad = manifest({"globals": {"max_new_tokens": "many"}, "tracks": [{"path": "a"}, {"path": "b", "max_new_tokens": 5}, {"path": "c", "max_new_tokens": None}]})
    rows = manifests.read_manifest(spark, bad)
    assert [r.track_index for r in config.manifest_rejects(rows).collect()] == [0]
    assert [r.max_new_tokens for r in config.resolve_settings(rows).orderBy("track_index").collect()] == [None, 5, None]


def test_counts_come_from_the_writing_job(spark, tmp_path):
    """Counts of the one pass against those of the operators, with many files, nothing left, and nothing at all."""
    (tmp_path / "done").mkdir()
    (tmp_path / "done" / "d.json").write_text('{"file": "t7.wav", "path": "x/t7.wav"}')
    for name, n in (("many", 5000), ("none_left", 1), ("no_tracks", 0)):
        tracks = [{"path": f"a{i % 3}/t{i + 7 if n == 1 else i % 900}.wav"} for i in range(n)]
        (tmp_path / f"{name}.json").write_text(json.dumps({"globals": {"a": 1}, "tracks": tracks}))
        counts = jobs.filter_manifest(spark, str(tmp_path / f"{name}.json"), str(tmp_path / "done"), str(tmp_path / name)).first()
        gone = sum(t["path"].endswith("/t7.wav") for t in tracks)
        assert counts.asDict() == {"total_before": n, "total_done": gone, "total_left": n - gone, "balanced": True}, name
        lines = "".join(p.read_text() for p in sorted((tmp_path / name).glob("part-*")))
        assert len(json.loads(lines)["tracks"]) == n - gone
