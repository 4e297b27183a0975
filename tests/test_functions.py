from pathlib import PurePosixPath

import pytest
from pyspark.sql import functions as F

from trackloom.functions import paths, scalars, text

ODD = ["  a ", "\t\n x \r\n", " wide　", "\x1c\x85y\x1f", " z\xa0", "", "   ", "in ner", "no"]


def test_strip_is_pythons_strip(spark):
    rows = spark.createDataFrame([(s,) for s in ODD], "s string").select("s", text.strip("s").alias("t")).collect()
    assert all(r.t == r.s.strip() for r in rows)


NAMES = ["a/b/01. Song.mp3", "x.MP3", ".hidden", "a/.mp3", "a/name.", "a.b/c", "a/..mp3", "q/two.dots.wav", "e/f g-h.Flac"]


def test_path_parts_are_pathlibs(spark):
    rows = spark.createDataFrame([(n,) for n in NAMES], "p string").select(
        "p", paths.file_name("p").alias("name"), paths.stem("p").alias("stem"), paths.suffix("p").alias("suffix"),
    ).collect()
    for r in rows:
        p = PurePosixPath(r.p)
        if r.p.endswith("."):  # changed between Python versions; the dot stays in the stem here
            assert (r.name, r.stem, r.suffix) == ("name.", "name.", "")
        elif r.p == "a/..mp3":
            assert r.suffix == ".mp3"
        else:
            assert (r.name, r.stem, r.suffix) == (p.name, p.stem, p.suffix.lower()), r.p


@pytest.mark.parametrize("stem,number,title", [
    ("03.Song Title", 3, "Song Title"), ("03 - Song Title", 3, "Song Title"), ("03_Song Title", 3, "Song Title"),
    ("Song Title", None, "Song Title"), ("12", None, "12"), ("7. ", 7, ""), ("٣. Song", 3, "Song"),
    ("1 9 Lives", 1, "9 Lives"), ("99999999999999999999. Long", None, "Long"),
])
def test_name_tags(one, stem, number, title):
    assert one(paths.name_track_number("s"), s=stem) == number
    assert one(paths.name_title("s"), s=stem) == title


@pytest.mark.parametrize("value,number", [("3/12", 3), (" 4 /9", 4), ("x/2", None), ("", None), ("5", 5), ("2.5", None), ("٧/٩", 7)])
def test_position_number(one, value, number):
    assert one(paths.position_number("v"), v=value) == number


def test_tag_merge_prefers_embedded_and_keeps_only_known(spark):
    own = F.create_map(F.lit("title"), F.lit("Own"), F.lit("artist"), F.lit(None).cast("string"))
    name = F.create_map(F.lit("title"), F.lit("Name"), F.lit("track_number"), F.lit("4"))
    assert spark.range(1).select(paths.merge_tags(own, name)).first()[0] == {"title": "Own", "track_number": "4"}


def test_output_locations(one):
    assert one(paths.record_path("p", "out/"), p="a/b.c.mp3") == "out/b.c.caption.json"
    assert one(paths.sibling_path("p", ".json"), p="a.b/c.wav") == "a.b/c.json"
    assert one(paths.sibling_path("p", ".json"), p="a.b/c") == "a.b/c.json"
    assert one(paths.mirrored_path("p", "in", "out", ".mp3"), p="in/x/y.wav") == "out/x/y.mp3"
    assert one(paths.mirrored_path("p", "in", "out", ".mp3"), p="inn/x/y.wav") is None


def test_plain_path_of_a_uri(one):
    assert one(paths.without_scheme("p"), p="file:/a/b c.mp3") == "/a/b c.mp3"
    assert one(paths.without_scheme("p"), p="hdfs://host:9/a/b") == "/a/b"
    assert one(paths.without_scheme("p"), p="/a:/b") == "/a:/b"


@pytest.mark.parametrize("status,output,error,cell", [
    ("ok", " a\nb ", None, "a b"), ("ok", None, None, ""), ("error", None, "boom", "[error] boom"),
    ("error", "x", None, "[error]"), (None, "x", None, "[missing]"),
])
def test_cell_text(spark, status, output, error, cell):
    row = spark.createDataFrame([(status, output, error)], "s string, o string, e string")
    assert row.select(text.cell_text("s", "o", "e")).first()[0] == cell


@pytest.mark.parametrize("seconds,shown", [
    (0.0, "0.0s"), (12.34, "12.3s"), (59.9, "59.9s"), (60.0, "1m 0.0s"), (123.0, "2m 3.0s"), (3723.0, "1h 2m 3.0s"), (7199.5, "1h 59m 59.5s"),
])
def test_duration_text(one, seconds, shown):
    assert one(scalars.duration_text("s"), s=seconds) == shown


def test_iso_utc(one, spark):
    ts = "TIMESTAMP_NTZ'2024-01-02 03:04:05.000670'"
    assert spark.range(1).select(scalars.iso_utc(F.expr(ts))).first()[0] == "2024-01-02T03:04:05.000670+00:00"
    assert spark.range(1).select(scalars.iso_utc(F.expr("TIMESTAMP_NTZ'2024-01-02 03:04:05'"), True)).first()[0] == "2024-01-02T03:04:05Z"
    assert one(scalars.iso_utc(scalars.now_utc())).startswith("20")


def test_caps_and_flags(one):
    assert one(scalars.effective_duration("d"), d=400.0) == 300.0
    assert one(scalars.effective_duration("d", 0), d=400.0) == 400.0
    assert one(scalars.has_coverage_gap("w", "d"), w=2, d=91.0) is True
    assert one(scalars.has_coverage_gap("w", "d"), w=2, d=90.0) is False
    assert one(scalars.is_truncated("n", "b"), n=256, b=256) is True
    assert one(scalars.clamp("n", 512), n=900) == 512
    assert one(scalars.error_text("t"), t="ERROR: no memory") == "no memory"
    assert one(scalars.error_text("t"), t="no ERROR: here") is None


@pytest.mark.parametrize("said,bpm", [
    ("about 111 BPM in", 111.0), ("92.5BPM", 92.5), ("80 to 90 bpm", 90.0), ("1200 BPM", None), ("BPM 90", None),
])
def test_bpm_survives_narrow_blanks(one, said, bpm):
    assert one(text.first_bpm("t"), t=said) == bpm


def test_all_bpm_values(one):
    assert one(text.bpm_values("t"), t="80 BPM then 90 BPM") == [80.0, 90.0]


@pytest.mark.parametrize("said,key", [
    ("in C♯ minor now", "C# minor"), ("B♭ Major", "Bb major"), ("D‑minor", "D minor"), ("A  MINOR", "A minor"),
    ("a minor issue", None), ("C minorish", None), ("key unknown", None),
])
def test_key(one, said, key):
    assert one(text.musical_key("t"), t=said) == key


def test_time_signature(one):
    assert one(text.time_signature("t"), t="feel of 12/8, mostly") == "12/8"
    assert one(text.time_signature("t"), t="on 2024/8/16 recorded") is None


def test_tags(one):
    assert one(text.tag_list("t"), t=" Oud, , Slide Guitar ,\n9/8") == ["oud", "slide guitar", "9/8"]


def test_sentences_are_lossless(one):
    said = "One. Two?! 3.5 is... \nno end"
    assert "".join(one(text.sentences("t"), t=said)) == said


def test_drop_refusals(one):
    said = "Oud leads. The key is Not Specified in the source. Slow tempo."
    assert one(text.drop_refusals("t"), t=said) == "Oud leads. Slow tempo."
    assert one(text.drop_refusals("t"), t=" kept as is ") == " kept as is "
    assert one(text.drop_duration_leaks("t"), t="Calm. The duration of the track is 3 s") == "Calm."


def test_bullets(one):
    said = "- Genre: pop\n• Mood : calm: very\nplain: no\n-  Empty:"
    assert [(f.position, f.label, f.answer) for f in one(text.bullet_fields("t"), t=said)] == [
        (0, "Genre", "pop"), (1, "Mood", "calm: very"), (3, "Empty", ""),
    ]


def test_word_count(one):
    assert one(text.word_count("t"), t="  one two\nthree ") == 3
    assert one(text.word_count("t"), t="  ") == 0
    assert one(text.in_length_rule("t"), t="w " * 60) is True
    assert one(text.in_length_rule("t"), t="w " * 121) is False


@pytest.mark.parametrize("value", ["a/b.mp3", "it's.mp3", 'say "x".mp3', "both ' and \".mp3", "back\\slash"])
def test_quoted_is_repr(one, value):
    assert one(text.quoted("v"), v=value) == repr(value)


@pytest.mark.parametrize("said,evades", [
    ("Explicit tempo data is absent.", True), ("Key: unavailable", True), ("The genre, sadly, is UNKNOWN here", True),
    ("The drums are absent at first", False), ("a missing beat, then many words until the tempo", False), ("tempo 90", False),
    ("", False), ("absent", False), ("missing one two three tempo", True), ("missing one two three four tempo", False),
    ("tempo one two three missing", True), ("tempo one two three four missing", False), ("tempos absent", False),
])
def test_absence_near_a_subject(one, said, evades):
    assert one(text.states_absence("t"), t=said) is evades


def test_evasions_go_as_sentences(one):
    said = "Warm pads. Explicit tempo data is absent! The drums are absent at first. Lyrics? Unavailable."
    assert one(text.drop_evasions("t"), t=said) == "Warm pads. The drums are absent at first. Lyrics? Unavailable."
    assert one(text.drop_evasions("t"), t=" Warm pads. ") == " Warm pads. "
    assert one(text.drop_evasions("t"), t="Tempo is unknown.") == ""
    assert one(text.drop_evasions("t"), t=None) is None
