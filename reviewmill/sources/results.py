"""Result tables on shared storage.

A table kept by a streaming query holds one folder ``batch_id=<n>`` per
micro-batch. Spark's writer puts a _SUCCESS file into a folder once it is complete,
and readers take complete folders only: a replayed batch replaces its own folder,
and nobody reads half a table. What a folder holds depends on the table:

* snapshot tables: the whole table. The newest folder counts.
* keyed tables (``RESULT_KEYS``): the rows that changed. The newest row of each key counts.
* ``predictions``: the rows of the batch. All folders count.

Folders of the last two kinds are merged as they come: every FAN_IN batches become one
folder ``span_id=<first>_<last>``, every FAN_IN of those a larger one, and so on. A
reader opens some FAN_IN folders for each digit of the number of batches, and a row
is written again once a digit. ``compact_result`` merges all into one folder
``base_id=<n>``, which stands for all batches up to n. Folders that others have
replaced stay for RETENTION_SECONDS, so that a reader can finish.

Tables that one query keeps together are read together: after each batch the query
writes a version, which names the folders of all its tables, below ``_versions``.
"""

from __future__ import annotations

import time
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.schemas import APPENDED, RESULT_KEYS, result_schema
from reviewmill.sources.storage import delete_folder, exists, matching

# Longer than the longest read of a result table.
RETENTION_SECONDS = 24 * 3600
# Folders of one size that are merged into a larger one.
FAN_IN = 8
# The last batch of a folder, in the path of a file in it.
_LAST_BATCH = r"(?:batch|base|span)_id=(?:[0-9]+_)?([0-9]+)/[^/]*$"


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def _complete(spark: SparkSession, path: str, kind: str) -> dict[int, float]:
    """Number and completion time of each complete folder ``<kind>=<number>``."""
    found = {}
    for file, changed in matching(spark, f"{path}/{kind}=*/_SUCCESS").items():
        found[int(file.split("/")[-2].split("=")[1])] = changed
    return dict(sorted(found.items()))


def complete_batches(spark: SparkSession, path: str) -> list[int]:
    return list(_complete(spark, path, "batch_id"))


def write_batch(df: DataFrame, batch_id: int, path: str) -> None:
    """Write one micro-batch from the executors; a replay replaces it."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def drop_replaced(
    spark: SparkSession, path: str, replaced: dict[str, float], retention: float
) -> None:
    """Delete folders that were replaced (name, time) longer ago than ``retention``."""
    for name, since in replaced.items():
        if time.time() - since >= retention:
            delete_folder(spark, f"{path}/{name}")


def write_snapshot(
    df: DataFrame, batch_id: int, path: str, retention: float = RETENTION_SECONDS
) -> None:
    """Write a whole table; earlier snapshots go once they are old enough."""
    write_batch(df, batch_id, path)
    spark = df.sparkSession
    done = list(_complete(spark, path, "batch_id").items())
    replaced = {f"batch_id={b}": later for (b, _), (_, later) in zip(done, done[1:])}
    drop_replaced(spark, path, replaced, retention)


def _newest(frame: DataFrame, table: str) -> DataFrame:
    """The newest row of each key; ``batch_id`` orders them."""
    keys = RESULT_KEYS[table]
    rest = [c for c in frame.columns if c not in (*keys, "batch_id")]
    newest = F.max_by(F.struct(*rest), "batch_id").alias("row")
    columns = result_schema(table).names
    return frame.groupBy(*keys).agg(newest).select(*keys, "row.*").select(*columns)


def _spans(spark: SparkSession, path: str) -> dict[tuple[int, int], float]:
    """First and last batch of each complete merged folder, and when it was done."""
    found = {}
    for file, changed in matching(spark, f"{path}/span_id=*/_SUCCESS").items():
        first, last = file.split("/")[-2].split("=")[1].split("_")
        found[int(first), int(last)] = changed
    return found


def live_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders that hold the state of a keyed or appended table, oldest first."""
    bases = _complete(spark, path, "base_id")
    done = max(bases, default=-1)
    parts = {(b, b): f"batch_id={b}" for b in _complete(spark, path, "batch_id")}
    parts |= {span: f"span_id={span[0]}_{span[1]}" for span in _spans(spark, path)}
    chosen = {}
    # The largest first; what lies in one that is taken is not needed.
    for first, last in sorted(parts, key=lambda span: (span[0] - span[1], span)):
        inside = any(a <= first and last <= b for a, b in chosen)
        if last > done and not inside:
            chosen[first, last] = parts[first, last]
    base = [f"base_id={done}"] if bases else []
    return base + [chosen[span] for span in sorted(chosen)]


def _state(spark: SparkSession, path: str, table: str, folders: list[str]) -> DataFrame:
    """State of a table from some of its folders."""
    # The file's folder tells the batch, so all are read in one scan.
    frame = spark.read.schema(result_schema(table)).parquet(*[f"{path}/{f}" for f in folders])
    if table not in RESULT_KEYS:
        return frame
    number = F.regexp_extract(F.input_file_name(), _LAST_BATCH, 1)
    return _newest(frame.withColumn("batch_id", number.cast("bigint")), table)


def merge_spans(
    spark: SparkSession, path: str, table: str, batch_id: int, retention: float = RETENTION_SECONDS
) -> None:
    """Merge the folders that the batch has made complete a group of FAN_IN, of any size.

    Depends on the number of the batch alone, so a replayed batch does the same again. Other
    batches do not even list the folders.
    """
    if (batch_id + 1) % FAN_IN:
        return
    size = FAN_IN
    while (batch_id + 1) % size == 0:
        first = batch_id + 1 - size
        parts = [f for f in live_folders(spark, path) if not f.startswith("base") and _first_batch(f) >= first]
        if len(parts) > 1:
            merged = _state(spark, path, table, parts)
            merged.write.mode("overwrite").parquet(f"{path}/span_id={first}_{batch_id}")
        size *= FAN_IN
    spans = _spans(spark, path)
    folders = {f"batch_id={b}": (b, b) for b in _complete(spark, path, "batch_id")}
    folders |= {f"span_id={a}_{b}": (a, b) for a, b in spans}
    replaced = {}
    for name, (first, last) in folders.items():
        over = [t for (a, b), t in spans.items() if a <= first and last <= b and (a, b) != (first, last)]
        if over:
            replaced[name] = min(over)
    drop_replaced(spark, path, replaced, retention)


def _first_batch(folder: str) -> int:
    return int(folder.split("=")[1].split("_")[0])


def commit_version(
    spark: SparkSession,
    root: str,
    group: str,
    batch_id: int,
    tables: Iterable[str],
    retention: float = RETENTION_SECONDS,
) -> None:
    """Name the folders that hold the group's tables after this batch. Call it last."""
    rows = []
    for table in tables:
        path = table_path(root, table)
        kept = table in RESULT_KEYS or table in APPENDED
        folders = live_folders(spark, path) if kept else [f"batch_id={batch_id}"]
        # A replay may find folders of its own later batches only after a loss of checkpoints.
        rows += [(table, f) for f in folders if int(f.split("=")[1].split("_")[-1]) <= batch_id]
    frame = spark.createDataFrame(rows, "table string, folder string")
    write_snapshot(frame.coalesce(1), batch_id, f"{root}/_versions/{group}", retention)


def read_versions(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """Folders of each table that has a version: the newest one of its group."""
    newest: dict[str, int] = {}
    for file in matching(spark, f"{root}/_versions/*/batch_id=*/_SUCCESS"):
        group, number = file.split("/")[-3], int(file.split("/")[-2].split("=")[1])
        newest[group] = max(newest.get(group, -1), number)
    found: dict[str, list[str]] = {}
    for group, number in newest.items():
        # A handful of rows: FAN_IN folders a table for each digit of the batch number.
        for table, folder in spark.read.parquet(f"{root}/_versions/{group}/batch_id={number}").collect():
            found.setdefault(table, []).append(folder)
    return found


def compact_result(
    spark: SparkSession, root: str, table: str, retention: float = RETENTION_SECONDS
) -> None:
    """Merge all complete batches of a keyed or appended table into one folder.

    Runs beside the query and its readers, in a job of its own.
    """
    path = table_path(root, table)
    bases, batches = _complete(spark, path, "base_id"), _complete(spark, path, "batch_id")
    spans = _spans(spark, path)
    last = max([*batches, *(b for _, b in spans)], default=-1)
    if last > max(bases, default=-1):
        merged = _state(spark, path, table, live_folders(spark, path))
        merged.write.mode("overwrite").parquet(f"{path}/base_id={last}")
        bases = _complete(spark, path, "base_id")
    done = list(bases.items())
    replaced = {f"base_id={b}": later for (b, _), (_, later) in zip(done, done[1:])}
    folders = {f"batch_id={b}": b for b in batches} | {f"span_id={a}_{b}": b for a, b in spans}
    for name, b in folders.items():
        covered = [since for base, since in done if base >= b]
        if covered:
            replaced[name] = covered[0]
    drop_replaced(spark, path, replaced, retention)


def read_result(
    spark: SparkSession, root: str, table: str, folders: list[str] | None = None
) -> DataFrame:
    """The latest state of a result table, or that of the ``folders`` which a version names.

    Empty when nothing was written yet. Append tables are read through Spark's own sink log.
    """
    schema = result_schema(table)
    path = table_path(root, table)
    kept = table in RESULT_KEYS or table in APPENDED
    if folders is None:
        batches = _complete(spark, path, "batch_id")
        folders = live_folders(spark, path) if kept else [f"batch_id={max(batches)}"] if batches else []
    if folders:
        return _state(spark, path, table, folders)
    if exists(spark, path) and not matching(spark, f"{path}/*_id=*"):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)
