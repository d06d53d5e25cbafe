"""Per-file runs over an inbox folder, as a Structured Streaming query (SRC3, SRC4).

Each new file in ``input_dir`` becomes one micro-batch and one full pipeline run
written under ``<output_root>/<run_id>``. The run id is that of the batch, so a batch
that is tried again overwrites its own output and status row. A file that cannot be
read is recorded as failed and the stream goes on; any other error (a lost node, a
full disk) is raised, and the batch is tried again at the next start. The checkpoint
is kept under ``output_root``, so a restarted job resumes behind the finished files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.stage import CleanOptions
from ..plans.pipeline import run_registrations_etl
from ..schema import RAW_SCHEMA
from ..sources.readers import CSV_GLOB, CSV_READ_OPTIONS, PARQUET_GLOB, read_error

STATUS_SCHEMA = ("run_id string, file_name string, batch_id long, rows long, status string, "
                 "error string, finished_at timestamp")


def _status_row(spark: SparkSession, **values) -> DataFrame:
    return spark.createDataFrame([values], STATUS_SCHEMA)


def start_inbox(
    spark: SparkSession,
    input_dir: str,
    output_root: str,
    *,
    fmt: str = "csv",
    schema: StructType = RAW_SCHEMA,
    checkpoint: str | None = None,
    options: CleanOptions = CleanOptions(),
    available_now: bool = True,
    read_options: dict | None = None,
    **etl_kwargs,
) -> StreamingQuery:
    """Start the inbox stream; returns the running query.

    ``fmt`` is ``csv`` or ``parquet`` (one stream per format; the extension
    filter is case-insensitive). With ``available_now`` the query processes
    the files present and stops, like one pass of a batch driver.
    """
    root = output_root.rstrip("/")
    glob = {"csv": CSV_GLOB, "parquet": PARQUET_GLOB}[fmt]
    reader = (
        spark.readStream.format(fmt).schema(schema)
        .option("maxFilesPerTrigger", 1)
        .option("pathGlobFilter", glob)
    )
    if fmt == "csv":
        reader = reader.options(**CSV_READ_OPTIONS)
    if read_options:
        reader = reader.options(**read_options)
    stream = reader.load(input_dir).withColumn("_source_file", F.col("_metadata.file_name"))

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        run_id = f"{fmt}-{batch_id:09d}"
        file_name = f"batch-{batch_id}"  # kept if the file cannot be read; the error then names it
        try:
            # one file per batch (maxFilesPerTrigger), so this collects one name
            file_name = ",".join(sorted(r[0] for r in batch.select("_source_file").distinct().collect()))
            metrics = run_registrations_etl(batch.drop("_source_file"), output_root=f"{root}/{run_id}",
                                            run_id=run_id, options=options, **etl_kwargs)
            row = dict(rows=metrics["counts"]["input_rows"], status="ok", error=None)
        except Exception:
            error = read_error(batch)
            if error is None:  # the file is sound: not its fault
                raise
            row = dict(rows=None, status="failed", error=error)
        _status_row(spark, run_id=run_id, file_name=file_name, batch_id=batch_id,
                    finished_at=None, **row).withColumn("finished_at", F.current_timestamp()) \
            .write.mode("overwrite").parquet(f"{root}/_status/{run_id}")

    writer = (
        stream.writeStream.foreachBatch(run_batch)
        .option("checkpointLocation", checkpoint or f"{root}/_checkpoint-{fmt}")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def inbox_status(spark: SparkSession, output_root: str) -> DataFrame:
    """The status table written by ``start_inbox``."""
    return spark.read.schema(STATUS_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{output_root.rstrip('/')}/_status")
