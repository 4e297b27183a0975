"""Record schemas and the fixed values of the record formats.

Records are written by several generations of tools, and error records carry
only some of the keys, so readers always use these explicit nullable schemas.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: formats shared with existing catalogues --------------------
AUDIO_SUFFIXES = {
    "keyed": ["mp3", "wav", "flac", "m4a", "ogg"],
    "ordered": ["mp3", "wav", "flac"],
    "windowed": ["mp3", "wav"],
    "manifest": ["mp3", "flac", "ogg", "m4a", "aac", "wav", "wma", "opus", "ape", "alac"],
}
CATEGORY_KEYS = ["genre", "vocals", "instrumentation", "production", "mastering"]
DETAIL_KEYS = ["genre_style", "instruments", "vocals", "tempo_key"]
WINDOW_LABELS = ["start", "early", "pre_mid", "post_mid"]
RECORD_SUFFIX = ".caption.json"
OK, PARTIAL, ERROR, MISSING = "ok", "partial", "error", "missing"
AUDIO_CAP_SEC = 300
MODEL_MAX_SEC = 1200
WINDOW_SEC = 30
LANDMARK_SEC = 40.0
TOKEN_CEILING = {"keyed": 4096, "ordered": 512, "flat": 512}
LYRICS_MAX_CHARS = 4096
DRY_RUN = {"processing_time_sec": 0.1, "audio_windows": 1, "audio_covered_sec": 30}
MESSAGES = {
    "empty": "Decoded audio waveform is empty.",
    "nan": "Audio waveform contains NaN values.",
    "infinite": "Audio waveform contains infinite values.",
    "bad_duration": "Invalid audio duration: %.2fs.",
    "too_long": (
        "Audio duration (%.2fs) exceeds the model's maximum of 1200s (20 minutes). "
        "Trim the file and retry."
    ),
    "not_found": "File not found: %s",
    "skipped": (
        "Skipped: CUDA context poisoned earlier in this run. "
        "Restart and re-run to resume."
    ),
    "dry_run": "[DRY RUN placeholder output for '%s']",
}
FATAL_ERROR_PATTERN = "CUDA|device-side assert"
REFUSAL_PATTERN = r"(?i)not (?:available|provided|described|supplied|specified)"
DURATION_LEAK_PATTERN = r"(?i)duration of the (?:piece|track|song)"
#: What an answer may say is absent, and the words that say so; both stand near each other in an evasion.
SUBJECT_WORDS = ["tempo", "bpm", "key", "signature", "duration", "lyrics", "vocals", "vocal", "instrumentation", "instruments",
                 "genre", "metadata", "information", "data", "details"]
ABSENCE_WORDS = ["absent", "unavailable", "missing", "unknown", "unspecified", "undisclosed", "unstated", "undetermined",
                 "lacking", "omitted", "inaccessible"]
# -------------------------------------------------------------------------------


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


STR, LONG, INT, DBL, BOOL = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
TEXT_MAP = T.MapType(STR, STR)

#: What an annotator must return for one prompt, errors included.
RESULT = _struct(
    status=STR, output=STR, error=STR, traceback=STR, processing_time_sec=DBL,
    audio_windows=INT, audio_covered_sec=INT, output_truncated=BOOL,
)

KEYED_RECORD = _struct(
    file=STR, path=STR, model_id=STR, last_updated=STR,
    categories=T.MapType(STR, T.StructType(RESULT.fields + [T.StructField("prompt_used", STR, True)])),
)

ORDERED_RECORD = _struct(
    file=STR, model_id=STR, total_processing_time_sec=DBL, status=STR, tags=TEXT_MAP,
    responses=T.ArrayType(_struct(
        prompt_index=LONG, prompt=STR, raw_output=STR, processing_time_sec=DBL, status=STR, error=STR,
    )),
)

FLAT_RECORD = _struct(
    file=STR, model_id=STR, prompt_mode=STR, prompt_used=STR, raw_output=STR,
    processing_time_sec=DBL, tags=TEXT_MAP, status=STR, error=STR,
)

CHUNK_RECORD = _struct(
    metadata=_struct(
        model=STR, generated_at=STR, audio_file=STR, duration_seconds=DBL,
        window_seconds=DBL, total_chunks=INT, mode=STR,
    ),
    chunks=T.ArrayType(_struct(
        chunk_index=INT, label=STR, start_seconds=DBL, end_seconds=DBL, captions=TEXT_MAP,
    )),
)

#: The long table every record shape flattens to.
RESPONSES = _struct(
    track_id=STR, file=STR, path=STR, model_id=STR, chunk_index=INT, prompt_ord=LONG,
    category=STR, status=STR, output=STR, error=STR, processing_time_sec=DBL,
    audio_windows=INT, audio_covered_sec=INT, output_truncated=BOOL, prompt_used=STR,
    updated_at=STR,
)

MANIFEST = _struct(globals=TEXT_MAP, tracks=T.ArrayType(TEXT_MAP))

#: The append-only response log, stored under run_id=/batch_id=/attempt= folders.
LOG = _struct(
    track_id=STR, category=STR, prompt_used=STR, status=STR, output=STR, error=STR, traceback=STR,
    processing_time_sec=DBL, audio_windows=INT, audio_covered_sec=INT, output_truncated=BOOL,
    updated_at=T.TimestampType(), model_id=STR, entry=LONG, precision=STR, max_new_tokens=LONG, run_id=STR, batch_id=LONG, attempt=STR,
)
