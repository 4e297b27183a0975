"""Session helpers: local sessions for tests and bench, and the shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def local_session(cpus: int | str = "*", name: str = "trackloom", memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks. On a cluster use the session given."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; a cluster without
    the setting is an error, because a machine-local path would be lost with
    its executor.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if configured:
        if current is None:
            sc.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    fallback = tempfile.mkdtemp(prefix="trackloom-")
    sc.setCheckpointDir(fallback)
    return fallback


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    A job submitted with ``--py-files`` has it already; then this changes nothing
    but the copy in use.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="trackloom-code-"), "trackloom.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, for tables written between steps."""
    return os.path.join(shared_dir(spark), "trackloom", f"{name}-{uuid.uuid4().hex}")
