"""Whole jobs, as a user runs them: each is a chain of operators from files to files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from trackloom.functions import paths, scalars
from trackloom.functions.text import strip
from trackloom.model import AUDIO_SUFFIXES, FATAL_ERROR_PATTERN, LANDMARK_SEC, TEXT_MAP
from trackloom.operators import annotate as an, config, resume, summarize, windows
from trackloom.operators.rounds import in_rounds
from trackloom.session import shared_dir
from trackloom.sinks.documents import write_entries, write_manifest, write_summary_csv, write_summary_document
from trackloom.sinks.log import STATE_ORDER, export_records, read_attempts, read_log, read_state, write_batch
from trackloom.sinks.record_files import with_record_names, write_record_files
from trackloom.sources import manifests, records
from trackloom.sources.catalog import Catalog
from trackloom.sources.files import check_openable
from trackloom.sources.scan import scan_audio
from trackloom.sources.wav import decode_wav


def _with_track_id(scan: DataFrame) -> DataFrame:
    """The whole path is the key: same-named tracks of two albums stay apart. ``uri`` is what opens the file."""
    return scan.withColumn("uri", F.col("path")).withColumn("path", paths.without_scheme("path")).withColumn("track_id", F.col("path"))


def build_manifest(
    spark: SparkSession, directory: str, out: str, globals_row: DataFrame, base: str | None = None,
    recursive: bool = False, embedded: DataFrame | None = None,
) -> None:
    """Scan a folder and write a manifest with paths relative to ``base`` and tags.

    ``embedded`` may give (path, own) rows, ``own`` being a map of embedded
    tags; they win over the file name's.
    """
    found = _with_track_id(scan_audio(spark, directory, AUDIO_SUFFIXES["manifest"], recursive))
    stem = paths.stem("path")
    from_name = F.create_map(
        F.lit("title"), paths.name_title(stem), F.lit("track_number"), paths.name_track_number(stem).cast("string")
    )
    own = F.lit(None).cast("map<string,string>")
    if embedded is not None:
        found, own = found.join(embedded, "path", "left"), F.col("own")
    tags = paths.merge_tags(own, from_name)
    tag = lambda k: F.try_element_at(F.col("tags"), F.lit(k))
    tracks = found.select(
        paths.relative_to("path", base or directory.rsplit("/", 1)[0]).alias("path"), tags.alias("tags")
    ).select(
        "path", F.split("path", "/").alias("parts"), F.struct(
            tag("artist").alias("artist"), tag("title").alias("title"),
            tag("track_number").cast("bigint").alias("track_number"),
        ).alias("tags"),
    )
    write_manifest(globals_row, tracks, out, order=["parts"])


def filter_manifest(spark: SparkSession, manifest: str, done: str, out: str, key: str = "basename") -> DataFrame:
    """Write a manifest of either form without the finished tracks; returns the counts, the remaining as written.

    Globals and entries are written as they stood, in their order, every key
    and type kept; an entry that is listed twice stays twice. The entries are
    read once: the job that writes counts them as they come in, and the
    remaining once more where they are written.
    """
    tracks, settings = manifests.read_manifest_entries(spark, manifest)
    finished = records.read_done_files(spark, done)
    came, went = Observation("came"), Observation("went")
    flagged = resume.with_done(tracks, finished, key=key).observe(
        came, F.count("*").alias("total_before"), F.count_if("is_done").alias("total_done")
    )
    write_entries(settings, flagged.where(~F.col("is_done")).drop("is_done"), out, went)
    before, is_done, left = came.get["total_before"], came.get["total_done"], went.get["written"]
    return spark.createDataFrame(
        [(before, is_done, left, before == is_done + left)], "total_before long, total_done long, total_left long, balanced boolean"
    )


#: What a record and the log have of one answer.
ANSWER = ("status", "output", "error", "traceback", "processing_time_sec", "audio_windows", "audio_covered_sec",
          "output_truncated", "prompt_used")
#: Settings of a manifest entry that its annotator and its log rows get.
PASSED_ON = ("precision", "max_new_tokens")


def _annotated(pending: DataFrame, make_annotator, tasks: int | None, carry: tuple[str, ...], settings: tuple[str, ...] = ()) -> DataFrame:
    """Result rows of pending tracks; without an annotator those of a dry run."""
    if make_annotator is None:
        return an.dry_run(pending.select(*carry, F.inline("prompts"))).withColumnRenamed("prompt", "prompt_used")
    return an.annotate(
        pending, make_annotator, carry, content="uri", tasks=tasks, opened=True, fatal=FATAL_ERROR_PATTERN, settings=settings
    )


def _committed(
    spark: SparkSession, results: DataFrame, log_path: str, run_id: str, batch_id: int,
) -> tuple[DataFrame, str]:
    """Append a round's results to the log; returns them as read back from there, and their folder."""
    attempt = write_batch(results.withColumn("updated_at", F.current_timestamp()), log_path, run_id, batch_id)
    folder = f"run_id={run_id}/batch_id={batch_id}/attempt={attempt}"
    return read_attempts(spark, log_path, [folder]), folder


def caption_directory(
    spark: SparkSession, directory: str, log_path: str, run_id: str, catalog: Catalog,
    make_annotator: Callable[[], an.Annotator] | None = None, overwrite: bool = False, batch_id: int = 0,
    tasks: int | None = None, records: str | None = None, round_tracks: int | None = None, round_seconds: float | None = None,
) -> int:
    """Annotate what a folder still lacks and append it to the log; returns the number of rounds.

    Without an annotator this is a dry run. A worker opens a file when its turn
    comes, and no other file is read. Every call adds folders of its own to the
    log, whatever its run id.

    ``round_tracks`` or ``round_seconds`` bound what a crash can lose: pending
    tracks are done in rounds, each committed to the log before the next one
    starts, and the next call finds the finished ones done. Rounds count up from
    ``batch_id``. With ``records`` each round also writes one record file per
    track it touched, with all the track's answers so far, to that folder.
    """
    shared_dir(spark)
    listed = _with_track_id(scan_audio(spark, directory)).select("track_id", "uri")
    if make_annotator is not None:
        check_openable(directory)
    if records is not None:
        listed = with_record_names(listed, "track_id", ("track_id",))
    before = read_state(spark, log_path)
    pending = resume.pending_prompts(listed, before, catalog, overwrite, STATE_ORDER)
    if records is not None:
        known = resume.latest_state(before.join(pending.select("track_id"), "track_id", "left_semi"), order=STATE_ORDER).checkpoint()

    def run(part: DataFrame, number: int) -> None:
        answers, _ = _committed(spark, _annotated(part, make_annotator, tasks, ("track_id",)), log_path, run_id, batch_id + number)
        if records is not None:
            of_round = part.select("track_id", "record")
            rows = known.join(of_round, "track_id", "left_semi").unionByName(answers)
            nested = summarize.nest_by_category(rows, catalog.keys, ("track_id",), ANSWER, STATE_ORDER)
            write_record_files(nested.join(of_round, "track_id").select(
                "record", paths.file_name("track_id").alias("file"), F.col("track_id").alias("path"),
                scalars.iso_utc(scalars.now_utc(), zulu=True).alias("last_updated"), "categories",
            ), records)

    return in_rounds(pending, run, round_tracks, round_seconds)


def summarize_log(spark: SparkSession, log_path: str, out: str, catalog: Catalog, run_id: str | None = None) -> None:
    """Write the CSV pivot, the nested records and the summary document of a log.

    Everything in the log counts unless ``run_id`` asks for one run.
    """
    log = read_log(spark, log_path)
    if run_id is not None:
        log = log.where(F.col("run_id") == run_id)
    order = ("updated_at", "run_id", "batch_id")
    named = log.withColumns({"path": F.col("track_id"), "file": paths.file_name("track_id")})
    pivot = summarize.summary_pivot(named, catalog.keys, order=order)
    write_summary_csv(pivot, f"{out}/results_summary.csv")
    fields = ("status", "output", "error", "traceback", "processing_time_sec", "audio_windows",
              "audio_covered_sec", "output_truncated", "prompt_used")
    nested = summarize.nest_by_category(named, catalog.keys, ("file", "path"), fields, order)
    export_records(nested, f"{out}/records")
    header = nested.agg(F.count("*").alias("total_tracks")).select(
        scalars.iso_utc(scalars.now_utc(), zulu=True).alias("timestamp"), "total_tracks", catalog.keys_array().alias("categories")
    )
    write_summary_document(header, nested, f"{out}/results_summary.json")


def resolve_job(spark: SparkSession, manifest: str, framed: bool = False, **settings) -> DataFrame:
    """Resolved settings of every manifest entry; a bad manifest fails here, before any heavy work.

    Looks at one rejected entry to name the reason.
    """
    if framed:
        entries, settings_text = manifests.read_manifest_entries(spark, manifest)
        # the index counts from 0 in the order of the file, as in the other form
        numbered = windows.positions(entries, ["place"], "track_index").withColumn("track_index", F.col("track_index") - 1)
        tracks = numbered.select(
            "track_index", F.from_json(F.lit(settings_text), TEXT_MAP).alias("globals"), F.from_json("entry", TEXT_MAP).alias("track")
        )
    else:
        tracks = manifests.read_manifest(spark, manifest)
    rejects = config.manifest_rejects(tracks).orderBy("track_index").take(1)
    if rejects:
        raise ValueError(rejects[0]["reason"])
    return config.resolve_settings(tracks, **settings)


def _prompts_of(settings: DataFrame, catalog: Catalog | None) -> DataFrame:
    """Every catalogue prompt, or without a catalogue the one prompt of the track's mode."""
    if catalog is not None:
        return settings.withColumn("prompts", catalog.as_array())
    prompt, reason = config.prompt_for_mode()
    bad = settings.where(reason.isNotNull()).select(reason.alias("reason")).take(1)
    if bad:
        raise ValueError(bad[0]["reason"])
    single = F.struct(F.lit(0).alias("ord"), F.col("prompt_mode").alias("category"), prompt.alias("prompt"))
    return settings.withColumn("prompts", F.array(single))


def caption_job(
    spark: SparkSession, manifest: str, base: str, log_path: str, run_id: str, out: str,
    catalog: Catalog | None = None, make_annotator: Callable[[], an.Annotator] | None = None,
    framed: bool = False, tasks: int | None = None, round_tracks: int | None = None, round_seconds: float | None = None,
) -> None:
    """Annotate the tracks of a manifest and write the job's records and summary document.

    A bad manifest or prompt mode fails before any media is read. A missing
    file is an error row of the summary and has no record; the job goes on.
    Every run does all of its tracks again, as job runs do, and adds to the log,
    in rounds as in ``caption_directory``. A file that is listed twice is
    annotated for each of its entries, with that entry's own prompts. Each
    entry's record, with its tags, is one file of ``records``: the summary's
    ``output_file``. An entry's precision and token limit reach an annotator
    that has ``configure``, and the log. The summary says which precision the
    first entry has and whether others differ.
    """
    shared_dir(spark)
    root = base.rstrip("/") + "/"
    settings = _prompts_of(resolve_job(spark, manifest, framed), catalog)
    listed = settings.withColumn("uri", F.concat(F.lit(root), F.col("path"))).withColumn("track_id", paths.without_scheme("uri"))
    scan = _with_track_id(scan_audio(spark, base)).select("track_id")
    if make_annotator is not None:
        check_openable(root)
    named = with_record_names(listed, "path", ("path", "track_index"))
    tracks = resume.with_existence(named, scan, "track_id", "track_id").checkpoint()
    pending = tracks.where("exists").withColumnRenamed("track_index", "entry")
    carry = ("track_id", "entry", "model_id", *PASSED_ON)
    of_tracks = tracks.select(F.col("track_index").alias("entry"), F.col("path"), "tags", "record")
    keys = catalog.keys if catalog else []
    folders: list[str] = []

    def run(part: DataFrame, number: int) -> None:
        answers, folder = _committed(spark, _annotated(part, make_annotator, tasks, carry, PASSED_ON), log_path, run_id, number)
        folders.append(folder)
        nested = summarize.nest_by_category(answers, keys, ("entry", "track_id", "model_id"), ANSWER)
        rolled = summarize.track_rollup(answers, track="entry").select("entry", "total_processing_time_sec", "status")
        write_record_files(nested.join(rolled, "entry").join(of_tracks, "entry").select(
            "record", paths.file_name("path").alias("file"), "path", "entry", "model_id", "tags",
            scalars.iso_utc(scalars.now_utc(), zulu=True).alias("last_updated"), "total_processing_time_sec", "status", "categories",
        ), f"{out}/records")

    in_rounds(pending, run, round_tracks, round_seconds, key=("entry",))
    rollup = summarize.track_rollup(read_attempts(spark, log_path, folders), track="entry").withColumnRenamed("entry", "track_index")
    prompts = len(keys) if catalog else 1
    rows = summarize.job_summary(tracks, rollup.drop("prompts_total"), prompts, "records", key="track_index", record="record")
    used = config.mixed_settings(tracks, "precision").select(F.col("used").alias("precision"), F.col("mixed").alias("mixed_precision"))
    header = summarize.run_summary(rows, prompts).join(used)
    write_summary_document(
        header.select(scalars.iso_utc(scalars.now_utc(), zulu=True).alias("timestamp"), "*"), rows.withColumn("path", F.col("track_id")),
        f"{out}/results_summary.json", "results",
    )


def caption_windows(
    spark: SparkSession, directory: str, out: str, catalog: Catalog, make_annotator: Callable[[], an.Annotator],
    window_sec: float = LANDMARK_SEC, recursive: bool = False, tasks: int | None = None,
) -> None:
    """Annotate the landmark windows of PCM WAV files and write one nested record per file.

    The annotator gets the samples of one window. Errors stay in the answers,
    as ``ERROR: …``; files that do not decode have no record.
    """
    files = scan_audio(spark, directory, AUDIO_SUFFIXES["windowed"], recursive, with_content=True)
    decoded = decode_wav(files.withColumn("path", paths.without_scheme("path"))).where(F.col("decode_error").isNull())
    cut = windows.landmark_windows(decoded, "n_frames", "sample_rate", window_sec)
    length = (F.col("end_frame") - F.col("start_frame")).cast("int")
    pending = cut.select(
        "path", "duration_sec", "chunk_index", "start_seconds", "end_seconds",
        F.slice("samples", (F.col("start_frame") + 1).cast("int"), length).alias("content"),
        catalog.as_array().alias("prompts"),
    )
    answers = an.annotate(
        pending, make_annotator, ("path", "duration_sec", "chunk_index", "start_seconds", "end_seconds"), tasks=tasks
    )
    said = F.coalesce(F.concat(F.lit("ERROR: "), F.col("error")), strip("output"))
    nested = summarize.nest_windows(answers.withColumn("output", said), catalog.keys, ("path", "duration_sec"))
    export_records(nested.select(
        F.struct(
            F.lit("annotator").alias("model"), scalars.iso_utc(scalars.now_utc(), zulu=True).alias("generated_at"),
            F.col("path").alias("audio_file"), F.round("duration_sec", 2).alias("duration_seconds"),
            F.lit(float(window_sec)).alias("window_seconds"), "total_chunks", F.lit(catalog.name).alias("mode"),
        ).alias("metadata"),
        "chunks",
    ), out)
