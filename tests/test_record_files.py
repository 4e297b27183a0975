import json
import os

import pytest

from trackloom.sinks.record_files import _Writer, with_record_names, write_record_files
from trackloom.sources import files, records
from trackloom.model import KEYED_RECORD


def test_one_file_per_row_replaced_whole(spark, tmp_path):
    rows = [("a.caption.json", "a", None), ("b.caption.json", "ü\n\"", 2)]
    out = str(tmp_path / "r")
    write_record_files(spark.createDataFrame(rows, "record string, file string, n int"), out)
    write_record_files(spark.createDataFrame([("a.caption.json", "a", 7)], "record string, file string, n int"), out)
    assert sorted(os.listdir(out)) == ["a.caption.json", "b.caption.json"]
    assert json.loads((tmp_path / "r" / "a.caption.json").read_text()) == {"file": "a", "n": 7}
    assert json.loads((tmp_path / "r" / "b.caption.json").read_text()) == {"file": "ü\n\"", "n": 2}
    write_record_files(spark.createDataFrame([], "record string, file string"), out)
    assert len(os.listdir(out)) == 2


def test_written_records_read_back(spark, tmp_path):
    rows = spark.sql("select 'x.caption.json' as record, 'x.mp3' as file, '/m/x.mp3' as path, map('genre', struct('ok' as status, 'Dub' as output)) as categories")
    write_record_files(rows, str(tmp_path / "r"))
    long = records.read_responses(spark, str(tmp_path / "r"), "keyed")
    assert [(r.file, r.category, r.output) for r in long.collect()] == [("x.mp3", "genre", "Dub")]
    assert records.count_corrupt(spark, str(tmp_path / "r"), KEYED_RECORD).first().corrupt == 0


def test_a_task_that_dies_leaves_no_part(spark, tmp_path):
    """The second row can't be written: no half file, nothing staged, and the old file stands."""
    out = tmp_path / "r"
    out.mkdir()
    (out / "a.caption.json").write_text("old")
    rows = spark.createDataFrame([("a\0.caption.json", "x")], "record string, file string")
    with pytest.raises(Exception, match="(?i)null|embedded|a"):
        write_record_files(rows, str(out))
    assert os.listdir(out) == ["a.caption.json"] and (out / "a.caption.json").read_text() == "old"


def test_killed_between_stage_and_move(tmp_path, monkeypatch):
    import pyarrow as pa

    writer = _Writer(str(tmp_path))
    batch = pa.RecordBatch.from_pydict({"name": ["a.json", "b.json"], "value": ["1", "2"]})
    real, moves = files.replace_file, []

    def killed(uri, content, staging=None):
        moves.append(uri)
        if len(moves) == 2:
            store, path = files.locate(staging)
            with store.open_output_stream(f"{path}/.b.json.tmp") as f:
                f.write(b"ha")
            raise SystemExit
        real(uri, content, staging)

    monkeypatch.setattr("trackloom.sinks.record_files.replace_file", killed)
    with pytest.raises(SystemExit):
        writer.write(iter([batch]))
    assert sorted(p.name for p in tmp_path.glob("*.json")) == ["a.json"]
    writer.abort([])
    assert [p.name for p in tmp_path.iterdir()] == ["a.json"]


def test_names_are_distinct_and_fit(spark):
    paths = ["A/x.mp3", "B/x.mp3", "B/x.wav", "C/y.mp3", "C/y~0123456789abcdef.mp3", "D/" + "ü" * 120 + ".mp3", "E/.hidden", None, "F/"]
    named = with_record_names(spark.createDataFrame([(p,) for p in paths], "path string"))
    got = {r.path: r.record for r in named.collect()}
    assert len(got) == len(paths) == len(set(got.values()))
    assert got["C/y.mp3"] == "y.caption.json" and got["B/x.mp3"].startswith("x~") and got["E/.hidden"] == ".hidden.caption.json"
    assert all(len(n.encode()) < 256 and n.endswith(".caption.json") for n in got.values())


def test_paths_and_schemes(tmp_path, monkeypatch):
    from pyarrow import fs

    monkeypatch.setenv("AWS_REGION", "eu-central-1")
    (tmp_path / "a b.txt").write_text("0123456789")
    for uri in (str(tmp_path / "a b.txt"), f"file:{tmp_path}/a b.txt", f"file://{tmp_path}/a b.txt"):
        assert files.read_file(uri) == b"0123456789"
        assert files.read_range(uri, 4, 3) == b"456" and files.read_range(uri, 8, 9) == b"89" and files.read_range(uri, 20, 2) == b""
    assert files.split_uri("s3a://bucket/a/b.mp3") == ("s3a", "bucket", "/a/b.mp3")
    store, path = files.locate("s3a://bucket/a b/c.mp3")
    assert isinstance(store, fs.S3FileSystem) and path == "bucket/a b/c.mp3"
    assert files.locate("s3n://bucket/other")[0] is not store and files.locate("s3a://bucket/d")[0] is store
    store, path = files.locate("wasbs://music@account.blob.core.windows.net/x.mp3")
    assert isinstance(store, fs.AzureFileSystem) and path == "music/x.mp3"
    assert files.locate("dbfs:/mnt/x.mp3")[1] == "/dbfs/mnt/x.mp3"
    files.check_openable(str(tmp_path))
    with pytest.raises(ValueError, match="no file system for"):
        files.check_openable("gopher://host/music")
    assert files.child_names(str(tmp_path)) == ["a b.txt"] and files.child_names(str(tmp_path / "no")) == []
