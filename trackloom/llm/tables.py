"""Tables between the steps of an operator, in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from trackloom.session import shared_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df below ``spark.checkpoint.dir`` and reads it back: lineage ends here, and an executor's loss costs nothing.

    The shuffle files of the write are of no more use and are dropped at its end.
    """
    spark = df.sparkSession
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        path = shared_path(spark, name)
        # the setting is read when the plan is made, so the rows are planned here
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
