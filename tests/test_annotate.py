import io
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.operators import annotate as an, quality, resume, windows
from trackloom.sources.catalog import Catalog
from trackloom.sources.wav import checked_samples, decode_wav

CATALOG = Catalog("c", (("genre", "G?"), ("vocals", "V?")))


def wav(samples, rate=100, channels=1, width=2) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels), w.setsampwidth(width), w.setframerate(rate)
        w.writeframes(samples)
    return out.getvalue()


class Strict:
    """Fails when it sees anything but content and prompt; counts its set-ups in its answers."""

    made = 0

    def __init__(self):
        Strict.made += 1

    def prepare(self, content):
        if content == b"bad":
            raise ValueError("cannot decode")
        return content.decode()

    def annotate(self, prepared, prompt):
        if prepared == "odd" and prompt == "V?":
            raise RuntimeError("CUDA out")
        return {"output": f"{prepared}{prompt}#{Strict.made}", "audio_windows": 2}


def test_errors_are_rows_and_keys_go_around(spark):
    tracks = spark.createDataFrame([("t1", b"good", "x"), ("t2", b"bad", "y"), ("t3", b"odd", "z")], "track_id string, content binary, tag string")
    pending = resume.pending_prompts(tracks, spark.createDataFrame([], "track_id string, category string, status string, updated_at int"), CATALOG)
    rows = {(r.track_id, r.category): r for r in an.annotate(pending.repartition(1), Strict, carry=("track_id", "tag")).collect()}
    assert len(rows) == 6
    good = rows["t1", "genre"]
    assert (good.status, good.output, good.tag, good.audio_windows, good.prompt_used) == ("ok", "goodG?#1", "x", 2, "G?")
    assert good.processing_time_sec is not None and good.error is None
    for category in CATALOG.keys:
        bad = rows["t2", category]
        assert (bad.status, bad.error, bad.output) == ("error", "cannot decode", None) and "ValueError" in bad.traceback
    assert rows["t3", "vocals"].error == "CUDA out" and rows["t3", "genre"].status == "ok"
    assert {r.output[-2:] for r in rows.values() if r.output} == {"#1"}  # one set-up for the partition


def test_dry_run_starts_no_python(spark):
    from conftest import plan_of

    pairs = resume.fan_out(spark.createDataFrame([("a",)], "track_id string"), CATALOG)
    out = an.dry_run(pairs)
    assert "InArrow" not in plan_of(out) and "InPandas" not in plan_of(out)
    row = out.first()
    assert row.output == "[DRY RUN placeholder output for 'genre']" and row.audio_covered_sec == 30


def test_wav_decoding(spark):
    left_right = np.array([[1000, 3000], [-2000, 0]], "<i2").tobytes()
    files = [
        ("mono", wav(np.array([0, 16384, -32768], "<i2").tobytes())), ("stereo", wav(left_right, channels=2)),
        ("bytes", wav(bytes([0, 128, 255]), width=1)), ("deep", wav(b"\x00\x00\x40", width=3)), ("empty", wav(b"")), ("text", b"not audio"),
    ]
    rows = {r.path: r for r in decode_wav(spark.createDataFrame(files, "path string, content binary")).collect()}
    assert rows["mono"].samples == [0.0, 0.5, -1.0] and rows["mono"].duration_sec == 0.03
    assert rows["stereo"].samples == pytest.approx([2000 / 32768, -1000 / 32768]) and rows["stereo"].n_frames == 2
    assert rows["bytes"].samples == pytest.approx([-1.0, 0.0, 127 / 128]) and rows["deep"].samples == [0.5]
    assert rows["text"].decode_error.startswith("Failed to load or parse audio file") and rows["text"].n_frames is None
    reasons = {r.path: r.e for r in decode_wav(spark.createDataFrame(files, "path string, content binary")).select(
        "path", quality.waveform_error("samples", "duration_sec", "decode_error").alias("e")).collect()}
    assert reasons["empty"] == "Decoded audio waveform is empty." and reasons["mono"] is None
    assert reasons["text"].startswith("Failed to load")
    header_only = {r.path: r for r in decode_wav(spark.createDataFrame(files[:1], "path string, content binary"), False).collect()}
    assert header_only["mono"].samples is None and header_only["mono"].n_frames == 3


def test_checked_samples():
    samples, rate = checked_samples(wav(np.arange(500, dtype="<i2").tobytes()), cap_sec=2)
    assert (len(samples), rate) == (200, 100)
    with pytest.raises(ValueError, match="empty"):
        checked_samples(wav(b""))
    with pytest.raises(ValueError, match=r"1201\.00s"):
        checked_samples(wav(bytes(2 * 1201), rate=1))


def test_first_broken_rule_wins(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [], 0.0), (2, [inf, nan], 0.0), (3, [inf], 0.0), (4, [0.0], 0.0), (5, [0.0], 1200.5), (6, [0.0], 1200.0), (7, None, 1.0)]
    got = {r.i: r.e for r in spark.createDataFrame(rows, "i int, s array<float>, d double").select(
        "i", quality.waveform_error("s", "d").alias("e")).collect()}
    assert [got[i] and got[i].split()[2] for i in (1, 2, 3)] == ["waveform", "contains", "contains"]
    assert "NaN" in got[2] and "infinite" in got[3] and got[4] == "Invalid audio duration: 0.00s."
    assert "(1200.50s)" in got[5] and got[6] is None and got[7] == got[1]


@pytest.mark.parametrize("seconds,labels", [
    (300.0, ["start", "early", "pre_mid", "post_mid"]), (60.0, ["start", "early", "pre_mid", "post_mid"]),
    (30.0, ["start", "pre_mid", "post_mid"]), (0.0, []),
])
def test_landmarks(spark, seconds, labels):
    tracks = spark.createDataFrame([(int(seconds * 8000), 8000)], "total_frames bigint, sample_rate int")
    rows = windows.landmark_windows(tracks).collect()
    assert [r.label for r in rows] == labels
    assert all(0 <= r.start_seconds < r.end_seconds <= seconds for r in rows)
    assert [r.chunk_index for r in rows] == [["start", "early", "pre_mid", "post_mid"].index(name) for name in labels]  # keeps its index
    if seconds == 300.0:
        assert [(r.start_seconds, r.end_seconds) for r in rows] == [(0, 40), (40, 80), (110, 150), (150, 190)]


def test_landmarks_are_narrow(spark):
    from conftest import plan_of

    assert "Exchange" not in plan_of(windows.landmark_windows(spark.range(5).select(F.col("id").alias("total_frames"), F.lit(1).alias("sample_rate"))))
