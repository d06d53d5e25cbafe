"""Sinks (SNK1-9). Write errors always propagate.

File sizing (SNK5) is one write: a ``rebalance`` on the partition columns lets
AQE split hot partition values and merge small ones to the advisory size, so
there is no temp copy, no re-read and no single-task ``coalesce``.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R

CSV_WRITE_OPTIONS = {
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_parquet(df: DataFrame | None, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] = ()) -> None:
    """SNK1/SNK4: parquet, optionally partitioned; ``None`` is a no-op."""
    if df is None:
        return
    w = df.write.mode(mode)
    if not partition_by:
        w.parquet(path)
        return
    # a task keeps the files of a few partition values open, instead of sorting its rows by them
    with session_conf(df.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES)}):
        w.partitionBy(*partition_by).parquet(path)


def write_then_read(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as parquet and return the table read back with ``df``'s schema.

    This is how intermediate results are shared between jobs: the lineage is
    cut at the written table, and an empty result still has its schema.
    """
    write_parquet(df, path, partition_by=partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_files(df: DataFrame, fmt: str, path: str, n_files: int | None = None, header: bool = True,
                compression: str | None = None, mode: str = "overwrite") -> None:
    """SNK2: any format with header and codec options, into about ``n_files`` files.

    ``repartition`` (not ``coalesce``) keeps the upstream stages parallel.
    """
    out = df.repartition(n_files) if n_files else df
    w = out.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.options(**CSV_WRITE_OPTIONS).option("header", str(header).lower())
    if compression:
        w = w.option("compression", compression)
    w.save(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", max_records_per_file: int | None = None,
              partition_by: Sequence[str] = (), null_value: str | None = None) -> None:
    """SNK3: CSV with header; large outputs split by ``maxRecordsPerFile``, not one task.

    With the default null marker an empty string and a null both read back as
    null; pass ``null_value`` (e.g. ``\\N``) on both sides for a lossless trip.
    """
    w = df.write.mode(mode).options(**CSV_WRITE_OPTIONS)
    if null_value is not None:
        w = w.option("nullValue", null_value)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


OPEN_FILES = 8  # of a task that writes by partition values; with more values its rows are sorted


@contextmanager
def session_conf(spark: SparkSession, values: dict[str, str]):
    """Temporarily set session SQL confs for one action."""
    old = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def audit_size(spark: SparkSession, path: str, glob: str | None = None) -> tuple[int, int]:
    """SNK6: (files, bytes) of the data files under ``path``, on any Hadoop FS.

    The listing is Spark's own (in parallel for many folders) and is summed by one
    job; files are not opened, and no entry passes through the driver's Python.
    Hidden and ``_``-prefixed files and folders are skipped.
    """
    try:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .option("pathGlobFilter", glob or "*").load(path))
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            return 0, 0
        raise
    n, size = files.agg(F.count(F.lit(1)), F.sum("length")).first()
    return n, size or 0


def write_sized(df: DataFrame, path: str, partition_by: Sequence[str] = (), target_mb: float = R.DEFAULT_TARGET_MB,
                mode: str = "overwrite", output_format: str = "parquet", observe=None) -> tuple[int, int]:
    """SNK5: write ``df`` in files of about ``target_mb`` and return (files, bytes).

    The advisory partition size is measured on shuffle data, which is larger
    than the encoded file, so files come out at or below the target.
    """
    spark = df.sparkSession
    out = df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")
    if observe is not None:  # (Observation, [metric columns])
        out = out.observe(observe[0], *observe[1])
    target = str(int(target_mb * 1024 * 1024))
    with session_conf(spark, {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": target,
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # merge up to the target, not down to one task per core
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        # a hot partition value is split into several files instead of one huge one
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }):
        w = out.write.mode(mode)
        if partition_by:
            w = w.partitionBy(*partition_by)
        if output_format == "csv":
            w.options(**CSV_WRITE_OPTIONS).csv(path)
        else:
            w.format(output_format).save(path)
    glob = "*.csv" if output_format == "csv" else f"*.{output_format}"
    return audit_size(spark, path, glob)


def write_rejects(rejects: DataFrame, path: str, mode: str = "overwrite", output_format: str = "parquet",
                  reason_col: str = "reject_reason", target_mb: float = R.DEFAULT_TARGET_MB,
                  from_files: bool = False) -> tuple[int, int]:
    """SNK7: one quarantine write partitioned by reason, in files of about ``target_mb``; returns (files, bytes).

    ``from_files``: the rejects are a scan of written files, which is split at ``target_mb``, so no file is larger
    and no row is shuffled for its size; a task writes one file for each reason that it reads.
    """
    if not from_files:
        return write_sized(rejects, path, [reason_col], target_mb, mode, output_format)
    spark = rejects.sparkSession
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": str(int(target_mb * 1024 * 1024)),
                              "spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES)}):
        w = rejects.write.mode(mode).partitionBy(reason_col)
        if output_format == "csv":
            w = w.options(**CSV_WRITE_OPTIONS)
        w.format(output_format).save(path)
    return audit_size(spark, path, f"*.{output_format}")


def write_star(tables: dict[str, DataFrame], root: str, mode: str = "overwrite", output_format: str = "parquet",
               partition_by: dict[str, Sequence[str]] | None = None) -> dict[str, str]:
    """SNK8: write each ``{name: frame}`` under ``root/name``; returns the paths."""
    partition_by = partition_by or {}
    paths = {}
    for name, df in tables.items():
        path = f"{root.rstrip('/')}/{name}"
        w = df.write.mode(mode)
        if partition_by.get(name):
            w = w.partitionBy(*partition_by[name])
        if output_format == "csv":
            w.options(**CSV_WRITE_OPTIONS).csv(path)
        else:
            w.format(output_format).save(path)
        paths[name] = path
    return paths


def write_metrics(spark: SparkSession, metrics: dict, path: str) -> DataFrame:
    """SNK9: append one JSON row per run to a metrics table keyed by run_id.

    Nested parts are kept as a JSON string column so runs with different
    metric keys stay appendable.
    """
    flat = {k: v for k, v in metrics.items() if not isinstance(v, dict)}
    row = {
        "run_id": str(metrics.get("run_id")),
        "counts_json": json.dumps(metrics.get("counts", {}), sort_keys=True, default=str),
        "config_json": json.dumps(metrics.get("config", {}), sort_keys=True, default=str),
        "writes_json": json.dumps(metrics.get("writes", {}), sort_keys=True, default=str),
        "step_json": json.dumps(metrics.get("step_sec", {}), sort_keys=True, default=str),
        "elapsed_sec": flat.get("elapsed_sec"),
        "error": flat.get("error"),
    }
    df = spark.createDataFrame([row], "run_id string, counts_json string, config_json string, writes_json string, "
                               "step_json string, elapsed_sec double, error string")
    df.write.mode("append").json(path)
    return df
