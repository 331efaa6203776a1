"""Session and scratch-space helpers.

Jobs that must cut lineage or stage files write under the shared folder
the cluster names in ``spark.checkpoint.dir``. Only when that setting is
absent (local tests) do we create a folder of our own and register it.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from candela.files import delete_path, path_exists


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "candela") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Window stages are CPU-bound: on small local inputs keep at least one
        # partition per core instead of coalescing to 1 MB pieces.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create one only if none is configured."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if not current:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="candela-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from the driver's copy of it.

    Adds the package's folder to the PYTHONPATH of workers started from now
    on (on a cluster: where the executors see that folder or have the package
    installed).
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


#: Scratch folders that this driver has made and not deleted.
_MADE: list[str] = []


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root (the root's scheme is kept)."""
    path = os.path.join(ensure_checkpoint_dir(spark), "candela", f"{name}-{uuid.uuid4().hex[:12]}")
    _MADE.append(path)
    return path


def clear_scratch(spark: SparkSession, kept: int = 0) -> int:
    """Delete the scratch folders made so far (but for the first ``kept``); returns how many existed.

    Operators return frames that read their scratch tables (calendars, block
    maps, stored stages), so call this when no such frame is in use any more.
    """
    deleted = 0
    while len(_MADE) > kept:
        path = _MADE.pop()
        if path_exists(spark, path):
            delete_path(spark, path)
            deleted += 1
    return deleted


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what was made inside: for jobs whose results are written by then."""
    kept = len(_MADE)
    try:
        yield
    finally:
        clear_scratch(spark, kept)
