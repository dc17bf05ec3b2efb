"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from reviewmill.sources.storage import delete_folder

# Settings the plans in this package are written for. Nothing here depends on
# the data volume: AQE sizes the partitions, splits skewed join partitions and
# picks broadcast joins from measured sizes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Running aggregates keep one state row per group for ever, so the state
# belongs on disk with incremental checkpoints, not on the JVM heap.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Bytes of one batch of rows on its way to a Python worker. Spark's default of 64 MB is held
# by the executor and by the worker for each task, next to what the worker makes of it.
BATCH_BYTES = 4 << 20

_local_scratch: dict[str, str] = {}


def build_session(app_name: str = "reviewmill", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **STREAM_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stream_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session for streaming queries that shares the caller's context.

    A stateful query keeps the partition count of its first start, so it is set
    here on purpose instead of being inherited from the batch setting.
    """
    session = spark.newSession()
    for key, value in {**SETTINGS, **STREAM_SETTINGS}.items():
        session.conf.set(key, value)
    count = partitions or spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.shuffle.partitions", str(count))
    return session


def bound_batches(spark: SparkSession) -> None:
    """From now on batches for Python workers hold BATCH_BYTES, or one row; a size that the
    session was given stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by spark.checkpoint.dir."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        configured = spark.sparkContext.getCheckpointDir()
    if configured is not None:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder that all executors share"
        )
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        folder = _local_scratch[app] = tempfile.mkdtemp(prefix="reviewmill-")
        # Made here for a local run without a setting, so it goes with the run.
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


# The folder of the operator that is running, if it removes its tables itself.
_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)


def contained(label: str):
    """Runs a function that returns a DataFrame with a scratch folder of its own.

    Tables that ``materialize`` writes meanwhile lie there and go at the end, whether it
    succeeds or not; the result is written beside the folder and read back.
    """

    def wrap(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @wraps(build)
        def run(*args, **options) -> DataFrame:
            spark = SparkSession.active()
            folder = scratch_path(spark, label)
            token = _run_folder.set(folder)
            try:
                found = build(*args, **options)
                _run_folder.reset(token)
                token = None
                return materialize(found, label)
            finally:
                if token is not None:
                    _run_folder.reset(token)
                delete_folder(spark, folder)

        return run

    return wrap


def table_path(spark: SparkSession, label: str, folder: str | None = None) -> str:
    """Where ``materialize`` writes a table of that label."""
    folder = folder or _run_folder.get()
    return f"{folder}/{label}-{uuid.uuid4().hex}" if folder is not None else scratch_path(spark, label)


def materialize(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the
    optimizer the true size of the data. Like checkpoint files, the tables stay
    until their folder is removed; a job that runs again and again gives its
    own ``folder`` below the shared one and removes it at the end, and an operator that
    is ``contained`` does so by itself.
    """
    spark = df.sparkSession
    path = table_path(spark, label, folder)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
