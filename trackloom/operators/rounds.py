"""A long batch in rounds, each committed on its own, so that a crash costs one round."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from trackloom.session import shared_path

#: Slots that tracks are hashed to; a round is a range of them.
SLOTS = 1 << 20


def in_rounds(
    pending: DataFrame, run: Callable[[DataFrame, int], None], tracks: int | None = None, seconds: float | None = None,
    key: tuple[str, ...] = ("track_id",), clock: Callable[[], float] = time.monotonic,
) -> int:
    """Call ``run(rows, number)`` for one part of the pending rows after the other; returns how many rounds there were.

    A round has about ``tracks`` keys, or so many that it takes about ``seconds``: it starts with one key per core and
    follows what the last round took, by a factor of four at most. Both bounds hold together; with neither there is one
    round. ``run`` must commit what it did before it returns.

    The pending rows are written once, sorted by slot, so that a round reads its own range and lineage is cut.
    """
    spark = pending.sparkSession
    path = shared_path(spark, "pending")
    slot = F.pmod(F.xxhash64(*key), F.lit(SLOTS)).cast("int")
    pending.withColumn("_slot", slot).repartitionByRange("_slot").sortWithinPartitions("_slot").write.parquet(path)
    table = spark.read.parquet(path)
    total = table.select(*key).distinct().count()
    if not total:
        return 0
    most = SLOTS if tracks is None else max(1, SLOTS * tracks // total)
    width = most if seconds is None else min(most, max(1, SLOTS * spark.sparkContext.defaultParallelism // total))
    low = done = 0
    while low < SLOTS:
        high = min(low + width, SLOTS)
        part = table.where((F.col("_slot") >= low) & (F.col("_slot") < high)).drop("_slot")
        if width == SLOTS or not part.isEmpty():
            began = clock()
            run(part, done)
            done += 1
            if seconds is not None:
                pace = seconds / max(clock() - began, 1e-3)
                width = max(1, min(most, int(width * min(4.0, max(0.25, pace)))))
        low = high
    return done
