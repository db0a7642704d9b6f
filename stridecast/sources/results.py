"""Result tables, one partition per execution, written by the executors."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stridecast.functions.dates import Day, as_date, day_column
from stridecast.sources.commits import CommitLog


def results_path(root: str, target: str) -> str:
    return f"{root.rstrip('/')}/{target}_results"


def csv_path(root: str, target: str, kind: str, execution: Day) -> str:
    """Folder of a CSV report, e.g. ``<root>/<target>_results_2001_01_01.csv``."""
    day = as_date(execution).strftime("%Y_%m_%d")
    return f"{root.rstrip('/')}/{target}_{kind}_{day}.csv"


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


_PART = "dt_execution="


def _written_before(log: CommitLog) -> dict[str, str]:
    """Executions of a table without commits, which lie below its path."""
    return {name: name for name in log.folders(prefix=_PART)}


def replace_executions(df: DataFrame, path: str, gather: bool = False, execution: Day = None) -> None:
    """Writes the rows of ``df`` to the table at ``path`` by ``dt_execution``.

    Executions already there stay, but for those written again. These are replaced in one
    step when all rows are written (see ``CommitLog``): a write that fails changes
    nothing, and what has been read before can still be used until the next write.
    ``execution`` names the only one in ``df``; what it has written before goes, also if
    ``df`` has no rows. It is written where its rows are. For a table of many executions
    ``gather`` brings each day together first, so that not every task writes a file per
    day; rebalancing splits large days over many tasks.
    """
    log, version = CommitLog(df.sparkSession, path), f"version=v{uuid.uuid4().hex}"
    if execution is not None:
        part = _PART + as_date(execution).isoformat()
        df.drop("dt_execution").write.parquet(f"{path}/{version}/{part}")
        changed = [part]
    else:
        if gather:
            df = df.hint("rebalance", "dt_execution")
        df.write.partitionBy("dt_execution").parquet(f"{path}/{version}")
        changed = log.folders(version, _PART)
    log.commit({part: f"{version}/{part}" for part in changed}, _written_before(log))


def read_executions(
    spark: SparkSession,
    path: str,
    executions: Sequence[Day] | None = None,
    last_execution: Day = None,
    schema: StructType | None = None,
) -> DataFrame:
    """The given executions of a table, or all up to the last one wanted.

    Both are partition filters: other executions are not read. ``schema`` spares a
    look into the files, of which there may be none yet.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    parts = CommitLog(spark, path).latest()
    if parts is None:
        df = reader.parquet(path)
    elif parts:
        reader = reader.option("basePath", path)
        # Executions that were written before there were commits have no version folder.
        plain = [f"{path}/{f}" for f in sorted(parts.values()) if f.startswith(_PART)]
        versions = [f"{path}/{f}" for f in sorted(parts.values()) if not f.startswith(_PART)]
        frames = [reader.parquet(*folders).drop("version") for folders in (versions, plain) if folders]
        df = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
    else:
        df = spark.createDataFrame([], schema or "dt_execution date")
    if executions is not None:
        df = df.where(F.col("dt_execution").isin([as_date(d) for d in executions]))
    if last_execution is not None:
        df = df.where(F.col("dt_execution") <= day_column(last_execution))
    return df


def write_predictions(
    df: DataFrame, root: str, target: str, gather: bool = False, execution: Day = None
) -> str:
    """Writes predictions by ``dt_execution`` and returns the path; see ``replace_executions``."""
    path = results_path(root, target)
    replace_executions(df, path, gather, execution)
    return path


def read_predictions(
    spark: SparkSession,
    root: str,
    target: str,
    executions: Sequence[Day] | None = None,
    last_execution: Day = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Predictions of the given executions, or of all up to the last one wanted; see
    ``read_executions``."""
    return read_executions(spark, results_path(root, target), executions, last_execution, schema)
