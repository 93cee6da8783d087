"""Session helpers: building a session for local tests and finding the shared
checkpoint folder that lineage cuts and streaming state must live in."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # duplicate keys inside one JSON object keep the last value instead of failing
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


#: Shuffle files go when the job that made them ends, not when the driver happens to collect its garbage; for blocks of
#: whole jobs (a written table, a stream), whose shuffles nothing reads later.
NO_OLD_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def get_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "nestwork") -> SparkSession:
    """Return the active session, or build a local one for tests and benches."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("NESTWORK_DRIVER_MEMORY", "16g"))
    for k, v in _LOCAL_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must already point at shared storage and is used
    as is.  Only when it is unset (local tests) do we pick a fresh folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    # the setting itself cannot be changed in a running session; the context keeps the folder
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="nestwork-ckpt-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def with_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings for one block (a stream keeps those that it was started with); the former ones come back."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
