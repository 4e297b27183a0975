import random
from collections import Counter, defaultdict
from statistics import median

import pytest
from pyspark.sql import functions as F

from trackloom.operators import consensus as c, quality

CAPTIONS = "track_id string, chunk_index int, category string, output string"


@pytest.fixture
def captions(spark):
    """Windows of many tracks, one of which has a third of all rows."""
    rng = random.Random(5)
    rows = []
    for _ in range(900):
        track = "hot" if rng.random() < .34 else f"t{rng.randrange(40)}"
        window = rng.randrange(4)
        rows.append((track, window, "genre_style", rng.choice(["Folk, pop", "folk", "jazz ", "pop,"])))
        rows.append((track, window, "vocals", rng.choice(["male tenor", "female alto, breathy"])))
        rows.append((track, window, "tempo_key", f"{rng.randrange(80, 90)} BPM, {rng.choice(['C', 'D'])} {rng.choice(['minor', 'major'])}, {rng.choice(['4/4', '6/8'])}"))
    return spark.createDataFrame(rows, CAPTIONS)


def votes_of(captions, dimension):
    seen = defaultdict(set)
    for r in captions.collect():
        if r.category == dimension:
            for tag in r.output.split(","):
                if tag.strip():
                    seen[r.track_id, tag.strip().lower()].add(r.chunk_index)
    return {k: len(v) for k, v in seen.items()}


def test_genre_and_voice_against_a_loop(captions):
    for dimension, run, name in (("genre_style", c.genre_consensus, "genre"), ("vocals", c.voice_consensus, "voice")):
        votes = votes_of(captions, dimension)
        top = defaultdict(int)
        for (track, _), n in votes.items():
            top[track] = max(top[track], n)
        want = {(t, tag, n) for (t, tag), n in votes.items() if n == top[t] or (name == "voice" and n >= 2)}
        assert {(r.track_id, r[name], r.windows) for r in run(captions).collect()} == want


def test_tempo_and_key_against_a_loop(captions):
    facts = c.window_facts(captions.where("category = 'tempo_key'"))
    rows = facts.collect()
    by_track = defaultdict(list)
    for r in rows:
        by_track[r.track_id].append(r)
    want = {}
    for track, seen in by_track.items():
        middle = median([b for _, b in {(r.chunk_index, r.bpm) for r in seen}])
        rank = {k: (len({r.chunk_index for r in seen if r.music_key == k}), -min(abs(r.bpm - middle) for r in seen if r.music_key == k))
                for k in {r.music_key for r in seen}}
        best = [k for k, v in rank.items() if v == max(rank.values())]
        signatures = {r.signature for r in seen}
        want[track] = (best[0] if len(best) == 1 else None, len(rank), signatures.pop() if len(signatures) == 1 else "4/4", middle)
    tempo = {r.track_id: r for r in c.tempo_consensus(facts).collect()}
    got = {r.track_id: (r.music_key, r.keys_named, r.signature, tempo[r.track_id].median_bpm) for r in c.key_consensus(facts).collect()}
    assert got == want
    assert all(r.consistent == (r.high - r.low <= 5) for r in tempo.values())


def test_tempo_text(spark):
    rows = [("even", i, b) for i, b in enumerate([90.0, 91.0, 92.0, 95.0])] + [("wide", 0, 80.0), ("wide", 1, 90.0), ("none", 0, None)]
    facts = spark.createDataFrame(rows, "track_id string, chunk_index int, bpm double")
    got = {r.track_id: (r.tempo, r.median_bpm) for r in c.tempo_consensus(facts).collect()}
    assert got == {"even": ("91.5 BPM", 91.5), "wide": ("80.0–90.0 BPM", 85.0)}  # median, never the mean


@pytest.mark.parametrize("keys,best", [
    (["A minor"] * 4, "A minor"), (["A minor"] * 3 + ["C major"], "A minor"), (["A minor", "A minor", "C major", "C major"], "C major"), ([None] * 4, None),
])
def test_key_votes_and_ties(spark, keys, best):
    rows = [("t", i, b, k, "6/8") for i, (b, k) in enumerate(zip([80.0, 81.0, 90.0, 92.0], keys))]
    rows[0] = rows[0][:2] + (70.0,) + rows[0][3:]
    facts = spark.createDataFrame(rows, "track_id string, chunk_index int, bpm double, music_key string, signature string")
    row = c.key_consensus(facts).first()
    if keys.count("A minor") == 2:  # median 85.5: 81 and 90 are equally near, so the tie stays open
        assert row.music_key is None
    else:
        assert row.music_key == best
    assert row.signature == "6/8"


def test_tags_need_two_windows(spark):
    rows = [("t", 0, "instruments", "Oud, drum"), ("t", 1, "instruments", "oud ,"), ("t", 1, "instruments", "drum")]
    got = {r.tag: (r.windows, r.kept) for r in c.tag_consensus(c.caption_tags(spark.createDataFrame(rows, CAPTIONS))).collect()}
    assert got == {"oud": (2, True), "drum": (2, True)}
    many = [("t", i, "x", "a") for i in range(100)] * 2 + [("t", None, "x", "a")]
    assert c.tag_consensus(c.caption_tags(spark.createDataFrame(many, CAPTIONS))).first().windows == 100


def test_pairs_are_one_to_one(spark):
    schema = "file string, output string, updated_at int"
    a = spark.createDataFrame([("x", "old", 1), ("x", "new", 2), ("y", "only a", 1)], schema)
    b = spark.createDataFrame([("x", "b1", 1), ("x", "b2", 2), ("z", "only b", 1)], schema)
    rows = {r.file: r for r in c.pair_passes(a, b).collect()}
    assert (rows["x"].pass_a_raw, rows["x"].pass_b_raw, rows["x"].status) == ("new", "b2", "ok")
    assert rows["y"].error == "pass B is missing" and rows["z"].error == "pass A is missing" and len(rows) == 3


def test_unified_record_routes_and_keeps_raw(spark):
    rows = [("x", "ok", None, "Oud, 80 BPM, A minor. Key not provided.", "Strings, 90 BPM in C major.", None),
            ("y", "ok", None, "Oud at 80 BPM.", "Strings at 90 BPM.", ["tempo"]), ("z", "error", "pass B is missing", "Oud 70 BPM.", None, None)]
    pairs = spark.createDataFrame(rows, "file string, status string, error string, pass_a_raw string, pass_b_raw string, reliable_dimensions array<string>")
    got = {r.file: r for r in c.unified_record(pairs).collect()}
    assert (got["x"].description, got["x"].bpm, got["x"].music_key) == ("Oud, 80 BPM, A minor.", 90.0, "C major")
    assert got["x"].pass_a_raw == rows[0][3]
    assert (got["y"].bpm, got["y"].description) == (80.0, "Strings at 90 BPM.")
    assert (got["z"].bpm, got["z"].status) == (70.0, "error")


def test_run_comparison(spark):
    rows = [("f", "base", 10.0), ("f", "tuned", 7.5), ("g", "base", 3.0)]
    got = {r.file: (r.sec_base, r.sec_tuned, r.delta_sec) for r in c.run_comparison(
        spark.createDataFrame(rows, "file string, run_id string, processing_time_sec double"), ["base", "tuned"]).collect()}
    assert got == {"f": (10.0, 7.5, -2.5), "g": (3.0, None, None)}


def test_collisions_and_number_check(spark):
    rows = [(f"album{i}/01. Intro.mp3", "a", 122 if i < 30 else 1, 1) for i in range(40)] + [("b/02. Solo.wav", "b", 2, 2)]
    tracks = spark.createDataFrame(rows, "path string, album string, track_number bigint, name_number bigint")
    row = quality.name_collisions(tracks).first()
    assert (row["name"], row.tracks) == ("01. Intro", 40)
    assert quality.collision_members(tracks).count() == 40
    got = {r.album: (r.tracks, r.differing, r.common_number, r.common_count) for r in quality.tag_number_check(tracks, "album").collect()}
    assert got == {"a": (40, 30, 122, 30), "b": (1, 0, 2, 1)}
    counts = Counter(r.name for r in quality.collision_members(tracks, by="basename").select("name").collect())
    assert counts == {"01. Intro.mp3": 40}


def test_variants_settle_on_the_most_frequent_then_the_more_specific(spark):
    rows = [(1, "guitar", 1), (1, "acoustic guitar", 3), (1, "acoustic guitar with fingerpicking", 1), (1, "bass guitar", 1), (1, "oud", 1),
            (2, "pad", 2), (2, "synth pad", 2), (2, "warm synth pad", 1), (3, "drum kit", 1), (3, "kit drum", 1), (4, "pad", 5), (4, "synth pad", 1), (4, "soft pad", 1)]
    votes = spark.createDataFrame(rows, "track_id int, instrument string, windows long")
    got = sorted((r.track_id, r.instrument) for r in c.settle_variants(votes).collect())
    # a guitar is part of both kinds, and weaker than one of them and less specific than the other
    assert got == [(1, "acoustic guitar"), (1, "bass guitar"), (1, "oud"), (2, "synth pad"), (3, "drum kit"), (4, "pad")]
    assert c.settle_variants(votes.limit(0)).count() == 0


def test_consensus_moves_captions_once(spark):
    from conftest import plan_of

    captions = spark.createDataFrame([(1, 0, "genre_style", "Dub, Roots"), (1, 1, "genre_style", "dub")], "track_id long, chunk_index int, category string, output string")
    for plan in (c.genre_consensus(captions), c.voice_consensus(captions), c.instrument_union(captions),
                 c.tag_consensus(c.caption_tags(c.by_track(captions))), c.key_consensus(c.window_facts(c.by_track(captions)))):
        assert plan_of(plan).split("\n\n\n")[0].count("Exchange (") == 1


def test_windows_are_counted_without_gathering_them(spark):
    from conftest import plan_of

    rows = [(1, w, "instruments", text) for w in (0, 63, 64, 64, 129, -1, 2**31 - 1, None) for text in ("Oud", "oud, Drum")] + [(None, None, "instruments", "Ney")]
    captions = spark.createDataFrame(rows, "track_id long, chunk_index int, category string, output string")
    tags = c.tag_consensus(c.caption_tags(c.by_track(captions)))
    assert {(r.track_id, r.tag): r.windows for r in tags.collect()} == {(1, "oud"): 6, (1, "drum"): 6, (None, "ney"): 0}
    facts = spark.createDataFrame([(1, w, 80.0) for w in (0, 64, 64, None)], "track_id long, chunk_index int, bpm double")
    assert c.tempo_consensus(facts).first().median_bpm == 80.0
    for frame in (tags, c.instrument_union(captions)):
        assert "ObjectHashAggregate" not in plan_of(frame) and "SortAggregate" not in plan_of(frame)
    assert tags.rdd.getNumPartitions() >= 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_variants_settle_where_the_votes_are(spark):
    from conftest import plan_of

    rows = [(None, "pad", 1, "a"), (None, "synth pad", 2, "b"), (1, None, 1, "c"), (1, " ", 1, "d"), (1, "Pad", 3, "e"), (1, "pad", 3, "f"), (1, "pad", 3, "g"),
            (1, "soft  pad", 1, "h"), (2, "pad pad", 1, "i"), (2, "pad", 1, "j"), (2, "x", None, "k"), (2, "x y", 1, "l")]
    votes = spark.createDataFrame(rows, "track_id int, instrument string, windows long, more string")
    got = sorted(r.more for r in c.settle_variants(votes).collect())
    # without a track nothing is settled; "Pad" sorts before "pad", "pad" before "pad pad"; repeats go and stay together
    assert got == ["a", "b", "c", "d", "e", "j", "l"]
    captions = spark.createDataFrame([(1, 0, "instruments", "pad, synth pad")], "track_id long, chunk_index int, category string, output string")
    settled = c.settle_variants(c.instrument_union(captions))
    plan = plan_of(settled).split("\n\n\n")[0]
    assert plan.count("Exchange (") == 1 and "Join" not in plan
    assert [r.instrument for r in settled.collect()] == ["synth pad"]


def test_key_consensus_gathers_no_windows(spark):
    from conftest import plan_of

    rows = [(1, w, 80.0, "C major", None) for w in (0, 64, 128)] + [(1, w, 82.0, "D minor", "6/8") for w in (0, 1, 1, 64, 65)] + [(1, None, 90.0, "E major", None)]
    facts = spark.createDataFrame(rows, "track_id long, chunk_index int, bpm double, music_key string, signature string")
    best = c.key_consensus(c.by_track(facts))
    assert best.collect() == [(1, "D minor", 3, "6/8")]
    assert "collect_" not in plan_of(best) and "ObjectHashAggregate" not in plan_of(best)
