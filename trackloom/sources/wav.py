"""PCM WAV decoding, one file per row, in Arrow batches."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from trackloom.model import AUDIO_CAP_SEC, MESSAGES, MODEL_MAX_SEC
from trackloom.session import ship_package

DECODED = (
    "path string, sample_rate int, channels int, n_frames bigint, duration_sec double, "
    "samples array<float>, decode_error string"
)
FLUSH_BYTES = 32 * 2**20


def _mono(frames: bytes, width: int, channels: int) -> np.ndarray:
    """Samples in [-1, 1), averaged over the channels."""
    if width == 1:
        data = np.frombuffer(frames, np.uint8).astype(np.float32) / 128 - 1
    elif width == 2:
        data = np.frombuffer(frames, "<i2").astype(np.float32) / 32768
    elif width == 3:
        low_padded = np.zeros((len(frames) // 3, 4), np.uint8)
        low_padded[:, 1:] = np.frombuffer(frames, np.uint8).reshape(-1, 3)
        data = low_padded.view("<i4").ravel().astype(np.float32) / 2**31
    else:
        data = np.frombuffer(frames, "<i4").astype(np.float32) / 2**31
    return data.reshape(-1, channels).mean(axis=1)


def _decode(path: str, content: bytes, with_samples: bool) -> tuple:
    try:
        with wave.open(io.BytesIO(content)) as wav:
            rate, channels, n = wav.getframerate(), wav.getnchannels(), wav.getnframes()
            samples = _mono(wav.readframes(n), wav.getsampwidth(), channels) if with_samples else None
        return path, rate, channels, n, n / rate, samples, None
    except Exception as exc:  # one bad file is a row, not a failed job
        return path, None, None, None, None, None, f"Failed to load or parse audio file: {exc}"


def checked_samples(content: bytes, cap_sec: int = AUDIO_CAP_SEC) -> tuple[np.ndarray, int]:
    """(samples, sample rate) cut to the cap, for an annotator's ``prepare``.

    Media an annotator must not see raise ``ValueError`` with the reason, in
    the same order as ``quality.waveform_error``.
    """
    _, rate, _, n, duration, samples, broken = _decode("", content, True)
    if broken:
        raise ValueError(broken)
    if n == 0:
        raise ValueError(MESSAGES["empty"])
    if duration > MODEL_MAX_SEC:
        raise ValueError(MESSAGES["too_long"] % duration)
    return (samples[: int(cap_sec * rate)] if cap_sec else samples), rate


def decode_wav(files: DataFrame, with_samples: bool = True) -> DataFrame:
    """Decode ``content`` of (path, content) rows; failures fill ``decode_error``.

    ``with_samples=False`` gives the header facts only.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [part.split()[0] for part in DECODED.split(", ")]
        ints = {"sample_rate": "Int32", "channels": "Int32", "n_frames": "Int64"}
        for batch in batches:
            rows, held = [], 0
            for path, content in zip(batch["path"], batch["content"]):
                rows.append(_decode(path, content, with_samples))
                held += len(content)
                if held >= FLUSH_BYTES:  # so that a task holds the samples of few files
                    yield pd.DataFrame(rows, columns=names).astype(ints)
                    rows, held = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=names).astype(ints)

    ship_package(files.sparkSession)
    return files.select("path", "content").mapInPandas(run, DECODED)
