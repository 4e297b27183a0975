"""Rule-based consensus over the windows of a track, and pairing of passes.

Only the countable part of the synthesis rules is here. Judgements such as
"plausible for the genre" are left to the reader of the candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from trackloom.functions import text
from trackloom.functions.scalars import whole_units
from trackloom.model import REFUSAL_PATTERN
from trackloom.operators.resume import latest_state

TEMPO_SPREAD = 5


#: A caption's tags and facts fill several times the memory of the caption: so many tasks for each that a shuffle has.
TASKS = 4


def by_track(captions: DataFrame, *track: str) -> DataFrame:
    """Captions moved to their track's task, once, before they are split or searched.

    Every later step of a track's consensus finds them there. A caption is smaller than the tags and facts that come out
    of it, and these hardly combine before a shuffle: a tag of a track is in few of its captions. As those are not moved
    any more, the captions are dealt to ``TASKS`` times the usual number of tasks, so that each one's fit its memory.
    """
    usual = int(captions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return captions.repartition(TASKS * usual, *(track or ("track_id",)))


def caption_tags(captions: DataFrame, track: str = "track_id") -> DataFrame:
    """(track, window, dimension, tag) rows from comma-separated captions."""
    return captions.select(
        track, "chunk_index", F.col("category").alias("dimension"), F.explode(text.tag_list("output")).alias("tag")
    )


def _sixty_four() -> Column:
    """Which 64 windows a row's window is one of."""
    return F.shiftright(F.col("chunk_index").cast("bigint"), 6)


def _bits() -> Column:
    """The windows of a group of 64, as bits, as an aggregate; rows without a window have none."""
    place = F.pmod(F.col("chunk_index").cast("bigint"), F.lit(64)).cast("int")
    return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))


def window_votes(rows: DataFrame, *by: str) -> DataFrame:
    """Distinct windows per group. No shuffle for rows that are dealt by one of the columns, else one.

    Numbers of 64 bits are aggregated in place in a hash map, where sets of windows would be sorted and spilled as soon as
    a task has more than a few groups; ``count_distinct`` would shuffle the rows twice. Rows without a window count for none.
    """
    marked = rows.groupBy(*by, _sixty_four().alias("_at")).agg(_bits().alias("_bits"))
    return marked.groupBy(*by).agg(F.coalesce(F.sum(F.bit_count("_bits")), F.lit(0)).alias("windows"))


def tag_votes(tags: DataFrame, track: str = "track_id") -> DataFrame:
    """Distinct windows per (track, dimension, tag). No shuffle for tags of captions that went through ``by_track``, else one."""
    return window_votes(tags, track, "dimension", "tag")


def tag_consensus(tags: DataFrame, min_windows: int = 2, track: str = "track_id") -> DataFrame:
    """Tags with their window count; ``kept`` when enough windows have them."""
    return tag_votes(tags, track).withColumn("kept", F.col("windows") >= min_windows)


def _with_top(captions: DataFrame, dimension: str, track: str) -> DataFrame:
    """Votes of one dimension, with the most windows any tag of the track has.

    One shuffle, of the dimension's captions; votes and their maximum, which
    needs no order, are made where they arrive.
    """
    asked = by_track(captions.where(F.col("category") == dimension), track)
    votes = tag_votes(caption_tags(asked, track), track)
    return votes.withColumn("top_windows", F.max("windows").over(Window.partitionBy(track)))


def voice_consensus(captions: DataFrame, dimension: str = "vocals", track: str = "track_id") -> DataFrame:
    """Voice types that count: those of the majority, and others in two windows or more."""
    joined = _with_top(captions, dimension, track)
    return joined.where((F.col("windows") >= 2) | (F.col("windows") == F.col("top_windows"))).select(
        track, F.col("tag").alias("voice"), "windows",
        (F.col("windows") == F.col("top_windows")).alias("dominant"),
    )


def genre_consensus(captions: DataFrame, dimension: str = "genre_style", track: str = "track_id") -> DataFrame:
    """The label(s) most windows agree on; an even split keeps both."""
    joined = _with_top(captions, dimension, track)
    return joined.where(F.col("windows") == F.col("top_windows")).select(
        track, F.col("tag").alias("genre"), "windows"
    )


def instrument_union(captions: DataFrame, dimension: str = "instruments", track: str = "track_id") -> DataFrame:
    """Every instrument of a track once, with the number of windows that name it."""
    asked = by_track(captions.where(F.col("category") == dimension), track)
    return tag_votes(caption_tags(asked, track), track).select(
        track, F.col("tag").alias("instrument"), "windows"
    )


def settle_variants(votes: DataFrame, name: str = "instrument", track: str = "track_id") -> DataFrame:
    """One description of each thing a track has: of two that hold the same words, one more than the other, one goes.

    ``guitar``, ``acoustic guitar`` and ``acoustic guitar with fingerpicking`` are variants. The one that more windows name
    stays, of equals the more specific one, then the first by name. ``votes`` has (track, name, windows).

    A description is looked for by one of its words, the longest, among the words of its track's others: the descriptions
    of a (track, word) meet in a window, and those that go are marked in a second one. Votes that are dealt by track are
    not moved again, and no track is gathered: of its descriptions only those with the same longest word are.
    """
    def words(said: Column) -> Column:
        return F.array_distinct(F.filter(F.split(F.lower(said), r"\s+"), lambda w: w != ""))

    def rank(side: Column) -> Column:
        return F.struct(side["windows"], F.size(side["words"]))

    longest = F.array_max(F.transform("words", lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    known = votes.select(
        F.struct(*votes.columns).alias("vote"), F.col(track).alias("track"), F.col(name).alias("name"), words(F.col(name)).alias("words"),
    )
    by_word = known.withColumn("longest", longest).select("vote", "track", "name", "longest", F.posexplode_outer("words").alias("place", "word"))
    told = F.struct("name", F.col("vote.windows").alias("windows"), words(F.col("name")).alias("words"))
    part = F.when(F.col("track").isNotNull() & (F.col("word") == F.col("longest")), told)
    met = by_word.withColumns({"parts": F.collect_list(part).over(Window.partitionBy("track", "word")), "whole": told})
    whole = F.col("whole")
    held = F.filter("parts", lambda p: (p["name"] != whole["name"]) & (F.size(F.array_except(p["words"], whole["words"])) == 0))
    goes = F.transform(held, lambda p: F.when((rank(whole) > rank(p)) | ((rank(whole) == rank(p)) & (whole["name"] < p["name"])), p["name"]).otherwise(whole["name"]))
    itself = F.struct(F.when(F.coalesce("place", F.lit(0)) == 0, F.col("vote")).alias("vote"), F.col("name"), F.lit(False).alias("gone"))
    others = F.transform(F.array_distinct(goes), lambda n: F.struct(F.lit(None).cast(by_word.schema["vote"].dataType).alias("vote"), n.alias("name"), F.lit(True).alias("gone")))
    marks = met.select("track", F.inline(F.concat(F.array(itself), others))).where(F.col("vote").isNotNull() | F.col("gone"))
    marked = marks.withColumn("gone", F.max("gone").over(Window.partitionBy("track", "name")))
    return marked.where(F.col("vote").isNotNull() & ~F.col("gone")).select("vote.*")


def tempo_consensus(facts: DataFrame, track: str = "track_id", spread: float = TEMPO_SPREAD) -> DataFrame:
    """Median tempo when the windows are close, else the range. Never the mean.

    Rows collapse to (track, tempo) first. A tempo is a two- or three-digit
    figure with one decimal, so a track has a bounded number of them.
    """
    weights = window_votes(facts, track, "bpm").withColumnRenamed("windows", "n")
    stats = weights.groupBy(track).agg(
        F.min("bpm").alias("low"), F.max("bpm").alias("high"),
        F.percentile("bpm", 0.5, F.col("n")).alias("median_bpm"),
    ).where(F.col("median_bpm").isNotNull())
    close = F.col("high") - F.col("low") <= spread
    return stats.select(
        track, "low", "high", "median_bpm", close.alias("consistent"),
        F.when(close, F.format_string("%.1f BPM", "median_bpm")).otherwise(
            F.format_string("%.1f–%.1f BPM", "low", "high")
        ).alias("tempo"),
    )


def key_consensus(facts: DataFrame, track: str = "track_id") -> DataFrame:
    """Key per track: the one with most windows; on a tie the one nearest the median tempo.

    Still tied: left out. Time signature is 4/4 unless every window that
    names one says otherwise.

    Rows collapse to (track, key, tempo) first: some 40 keys times a few
    thousand tempos at most. With facts of captions that went through
    ``by_track`` no step shuffles. Nulls are handled inside the aggregates: a
    filter would be pushed below and repeat the text searches.
    """
    seen = facts.groupBy(track, "bpm", "music_key", _sixty_four().alias("at")).agg(
        _bits().alias("bits"), F.min("signature").alias("sig_lo"), F.max("signature").alias("sig_hi"),
    )
    same_bpm = Window.partitionBy(track, "bpm", "at")
    once = F.row_number().over(same_bpm.orderBy("music_key")) == 1  # a tempo weighs once, not per key
    windows = F.coalesce(F.bit_count(F.bit_or("bits").over(same_bpm)), F.lit(0))
    weighed = seen.withColumn("n", F.when(once, windows).otherwise(0))
    near = weighed.withColumn(
        "median_bpm", F.percentile("bpm", 0.5, F.col("n")).over(Window.partitionBy(track))
    )
    distance = F.coalesce(F.abs(F.col("bpm") - F.col("median_bpm")), F.lit(float("inf")))
    keyed = near.groupBy(track, "music_key", "at").agg(
        F.bit_or("bits").alias("bits"), F.min(distance).alias("distance"), F.min("sig_lo").alias("sig_lo"), F.max("sig_hi").alias("sig_hi"),
    )
    per_key = keyed.groupBy(track, "music_key").agg(
        F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).alias("votes"), F.min("distance").alias("distance"),
        F.min("sig_lo").alias("sig_lo"), F.max("sig_hi").alias("sig_hi"),
    )
    named = F.col("music_key").isNotNull()
    per_rank = per_key.groupBy(track, F.when(named, F.col("votes")).alias("votes"), "distance").agg(
        F.count("music_key").alias("n"), F.min("music_key").alias("k"),
        F.min("sig_lo").alias("sig_lo"), F.max("sig_hi").alias("sig_hi"),
    )
    ranked = F.when(F.col("votes").isNotNull(), F.struct(F.col("votes"), -F.col("distance")))
    best = per_rank.groupBy(track).agg(
        F.max_by(F.when(F.col("n") == 1, F.col("k")), ranked).alias("music_key"),
        F.sum("n").alias("keys_named"), F.min("sig_lo").alias("sig_lo"), F.max("sig_hi").alias("sig_hi"),
    )
    agreed = F.col("sig_lo") == F.col("sig_hi")
    return best.select(
        track, "music_key", "keys_named", F.when(agreed, F.col("sig_lo")).otherwise("4/4").alias("signature")
    )


def window_facts(captions: DataFrame, track: str = "track_id", source: str = "output") -> DataFrame:
    """Tempo, key and time signature that one window's text states."""
    return captions.select(
        track, "chunk_index",
        text.first_bpm(source).alias("bpm"),
        text.musical_key(source).alias("music_key"),
        text.time_signature(source).alias("signature"),
    )


def pair_passes(
    first: DataFrame, second: DataFrame, order: tuple[str, ...] = ("updated_at",), key: str = "file",
) -> DataFrame:
    """Two passes side by side by file; an unpaired file is an error row, not a failure.

    Each pass is cut to its newest record per file, so the join is one to one.
    """
    a = latest_state(first.select(key, "output", *order), (key,), order).select(key, F.col("output").alias("pass_a_raw"), F.lit(True).alias("_a"))
    b = latest_state(second.select(key, "output", *order), (key,), order).select(key, F.col("output").alias("pass_b_raw"), F.lit(True).alias("_b"))
    paired = a.join(b, key, "full_outer")
    lacking = F.when(F.col("_a").isNull(), "pass A is missing").when(F.col("_b").isNull(), "pass B is missing")
    return paired.select(
        key, "pass_a_raw", "pass_b_raw",
        F.when(lacking.isNull(), "ok").otherwise("error").alias("status"), lacking.alias("error"),
    )


def routed(dimension: str, a: Column, b: Column, default_a: bool, reliable: Column) -> Column:
    """A dimension's value from pass A or B.

    ``reliable`` lists the dimensions pass A is trusted for; null means the
    default. A pass without a value gives way to the other.
    """
    a_first = F.coalesce(F.array_contains(reliable, dimension), F.lit(default_a))
    return F.when(a_first, F.coalesce(a, b)).otherwise(F.coalesce(b, a))


def labelled(source: Column, label: str) -> Column:
    """The answer of the first ``- Label: …`` line of that label; null when there is none or it is a refusal."""
    answer = F.get(F.filter(text.bullet_fields(source), lambda f: F.lower(f["label"]) == label), 0)["answer"]
    return F.when((answer != "") & ~answer.rlike(REFUSAL_PATTERN), answer)


def unified_record(pairs: DataFrame, reliable: str = "reliable_dimensions", keep: tuple[str, ...] = ()) -> DataFrame:
    """One record per file: instruments, vocals and texture from pass A, tempo, key, signature and harmony from pass B.

    A dimension that a pass refuses or lacks comes from the other one; one that
    both lack is null. Refusals and duration sentences are dropped from the
    description; both raw texts stay. ``keep`` names columns, such as tags, that
    pass through.
    """
    cleaned = pairs.withColumns({
        "_ca": F.nullif(text.drop_noise("pass_a_raw"), F.lit("")), "_cb": F.nullif(text.drop_noise("pass_b_raw"), F.lit("")),
    })
    trusted = F.col(reliable)
    a, b = F.col("_ca"), F.col("_cb")
    return cleaned.select(
        "file", *keep, "status", "error", "pass_a_raw", "pass_b_raw",
        *[
            routed(name, labelled(F.col("pass_a_raw"), name), labelled(F.col("pass_b_raw"), name), from_a, trusted).alias(name)
            for name, from_a in (("instruments", True), ("vocals", True), ("texture", True), ("harmony", False))
        ],
        routed("signature", text.time_signature(a), text.time_signature(b), False, trusted).alias("signature"),
        routed("texture", a, b, True, trusted).alias("description"),
        routed("tempo", text.first_bpm(a), text.first_bpm(b), False, trusted).alias("bpm"),
        routed("key", text.musical_key(a), text.musical_key(b), False, trusted).alias("music_key"),
    )


def run_comparison(responses: DataFrame, runs: list[str], file: str = "file", run: str = "run_id") -> DataFrame:
    """Seconds per file under each named run, and the change from the first to the last.

    Conditional aggregates in one shuffle; no self-join.
    """
    ms = whole_units("processing_time_sec")
    sums = responses.where(F.col(run).isin(runs)).groupBy(file).agg(*[
        (F.sum(F.when(F.col(run) == r, ms)) / 1000).alias(f"sec_{r}") for r in runs
    ])
    return sums.withColumn("delta_sec", F.round(F.col(f"sec_{runs[-1]}") - F.col(f"sec_{runs[0]}"), 3))
