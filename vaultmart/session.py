"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings every job of the engine relies on.  They are safe to
# apply to an existing session (none of them is a static conf).
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # 128 MiB input splits keep a task's working set small at any scale.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "static",
}


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITING: dict[str, list] = {}  # by session: the writes that run in it, and its setting before the first of them
_WRITING_LOCK = threading.Lock()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """While a table is written: the write's shuffle files go at its end, not when the driver happens to collect garbage.

    Writes may overlap; the session's own setting comes back after the last of them."""
    session = spark._jsparkSession.sessionUUID()
    with _WRITING_LOCK:
        held = _WRITING.setdefault(session, [0, None])
        if held[0] == 0:
            held[1] = spark.conf.get(FREE_SHUFFLES)
            spark.conf.set(FREE_SHUFFLES, "true")
        held[0] += 1
    try:
        yield
    finally:
        with _WRITING_LOCK:
            held[0] -= 1
            if held[0] == 0:
                spark.conf.set(FREE_SHUFFLES, held[1])
                del _WRITING[session]


def get_session(master: str | None = None, app_name: str = "vaultmart",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults; UI stays off."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in SQL_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only a local-mode session without one (tests) gets a folder of our own,
    registered as its checkpoint folder so later reads agree; on a cluster a
    machine-local folder would be wrong, so a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="vaultmart-ckpt-")
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared directory for one pipeline run."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/vaultmart/{app}/{label}-{uuid.uuid4().hex[:12]}"
