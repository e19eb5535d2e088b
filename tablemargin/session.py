"""Session defaults and the shared folder used for staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# All of these can be set on a running session, so `configure` also works on one we did not build.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A skewed join is split even where that costs one more exchange afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A side is broadcast for its measured size alone: the planner's estimate takes the size on disk and
    # leaves out what explode adds, so it would collect millions of rows on the driver.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    # Shuffles are cut finely and brought together up to this size, so that the number of tasks grows with
    # the data and not what one task holds (rows of few distinct values take twenty times that in memory).
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    # For what is staged (tables are Snappy): a build at 6 times sf0.1 wrote 1426 MB instead of 2035, in the same time.
    "spark.sql.parquet.compression.codec": "zstd",
}
#: Shuffle files go at the end of each execution, not when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(
    app_name: str = "tablemargin", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with our defaults; `conf` adds to them or overrides them."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime defaults to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def own_session(spark: SparkSession) -> SparkSession:
    """A session beside the caller's with its SQL settings and our defaults; the caller's is left as it is."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and session.conf.isModifiable(key):
            session.conf.set(key, value)
    return configure(session)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each execution inside when it ends; what is read again must be staged."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can see, taken from `spark.checkpoint.dir`.

    Only a local session may go without that setting: its executors share the driver's disk,
    so a fresh temporary folder is made once for the application.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    application = spark.sparkContext.applicationId
    if application not in _local_dirs:
        _local_dirs[application] = tempfile.mkdtemp(prefix="tablemargin-")
    return _local_dirs[application]


_local_dirs: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; never reused, so a retry cannot see old files."""
    path = f"{shared_dir(spark)}/tablemargin-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is deleted at the end, so nothing that reads it may be handed out."""
    _scopes.append([])
    try:
        yield
    finally:
        delete_scratch(spark, _scopes.pop())


@contextmanager
def scratch_noted() -> Iterator[list[str]]:
    """The paths of what is staged inside, for `delete_scratch` once nothing reads it any more."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield paths
    finally:
        _scopes.pop()
        if _scopes:
            _scopes[-1].extend(paths)


def delete_scratch(spark: SparkSession, paths: list[str]) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(conf).delete(hpath, True)
