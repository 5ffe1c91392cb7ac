"""Session defaults and the shared scratch location."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import SparkSession


def build_session(app: str = "ledgerloom", master: str | None = None, **conf) -> SparkSession:
    """Session with adaptive execution, skew splitting and UTC.

    Shuffle width is left to the cluster settings unless given: adaptive execution
    coalesces small partitions, so a cluster should start from a high number.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # split a hot key even where the split costs one more exchange downstream
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, named by the cluster in spark.checkpoint.dir.

    Where it is unset a temporary folder is used, but only in local mode.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="ledgerloom-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def new_location(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared root; nothing is created yet."""
    return f"{shared_root(spark)}/ledgerloom/{label}-{uuid.uuid4().hex[:12]}"


#: removes an execution's shuffle files when it ends, not when the driver next collects its garbage
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning: dict[str, tuple[int, str | None]] = {}
_guard = threading.Lock()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What a write inside has shuffled is gone when the write has ended, because nobody reads it again.

    The session's setting comes back when the last of the threads inside has left.
    """
    session = spark._jsparkSession.sessionUUID()
    with _guard:
        inside, before = _cleaning.get(session) or (0, spark.conf.get(CLEANUP, None))
        _cleaning[session] = (inside + 1, before)
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _guard:
            inside, before = _cleaning.pop(session)
            if inside > 1:
                _cleaning[session] = (inside - 1, before)
            elif before is None:
                spark.conf.unset(CLEANUP)
            else:
                spark.conf.set(CLEANUP, before)


T = TypeVar("T")


def together(steps: dict[str, Callable[[], T]], most: int = 4) -> dict[str, T]:
    """Results of independent steps by name, up to `most` at a time: small jobs then share the cluster. The first error is raised."""
    if len(steps) == 1:
        return {name: step() for name, step in steps.items()}
    with ThreadPoolExecutor(most) as pool:
        running = {name: pool.submit(step) for name, step in steps.items()}
        return {name: job.result() for name, job in running.items()}
