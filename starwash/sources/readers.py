"""Sources (SRC1-6): parquet and CSV scans, directory ingest by extension,
per-file ingest status, and an ordered preview.

Raw registrations are read with a declared all-string schema; CSV schema
inference is never used (it turns dates and years into other types).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schema import BAD_ROW, RAW_SCHEMA

# Case-insensitive extension globs (pathGlobFilter itself is case-sensitive).
PARQUET_GLOB = "*.[pP][aA][rR][qQ][uU][eE][tT]"
CSV_GLOB = "*.[cC][sS][vV]"

CSV_READ_OPTIONS = {
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "mode": "PERMISSIVE",
    # a declared schema is checked against each file's header instead of being
    # applied by position, so a file with reordered columns fails loudly
    "enforceSchema": "false",
}


def read_parquet(spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None) -> DataFrame:
    """SRC1/SRC5: parquet scan; partition columns come back by discovery.

    Pass the writer's ``schema`` to re-read a table that may hold no rows
    (an empty write leaves nothing to infer a schema from).
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*paths)


def tag_bad_rows(df: DataFrame) -> DataFrame:
    """``df``, read with ``BAD_ROW`` as the column of corrupt records, with that column completed.

    The parser keeps the text of rows with too few or too many fields. A quote that
    is never closed is no error to it: the field keeps the quote and ends at the next
    separator. Such a field (it begins with a quote and has an odd number of them)
    makes the row bad as well, its text put together from the fields.
    """
    values = [F.col(f"`{c}`").cast("string") for c in df.columns if c != BAD_ROW]
    text = [v for c, v in zip([c for c in df.columns if c != BAD_ROW], values) if dict(df.dtypes)[c] == "string"]
    open_quote = F.exists(F.array(*text), lambda v: F.coalesce(v.startswith('"') & (F.regexp_count(v, F.lit('"')) % 2 == 1), F.lit(False))) if text else F.lit(False)
    whole = F.array_join(F.transform(F.array(*values), lambda v: F.coalesce(v, F.lit(""))), ",")
    return df.withColumn(BAD_ROW, F.coalesce(F.col(BAD_ROW), F.when(open_quote, whole)))


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None, bad_rows: bool = False,
             **options) -> DataFrame:
    """SRC2: CSV with a header; never schema inference.

    Without ``schema`` the columns take the header names and are all strings
    (conform them with ``starwash.schema.conform``). With ``schema`` the
    header must match it. With ``bad_rows`` (and a schema) the column ``BAD_ROW``
    holds the text of each row that could not be parsed, null for all others;
    without it such rows have nulls for what is missing.
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.options(**{**CSV_READ_OPTIONS, **options}).option("inferSchema", "false")
    if bad_rows:
        if schema is None:
            raise ValueError("bad rows can be told by a declared schema only")
        return tag_bad_rows(reader.schema(with_bad_row(schema)).option("columnNameOfCorruptRecord", BAD_ROW).csv(paths))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(paths)


def with_bad_row(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(BAD_ROW, StringType())])


def load(spark: SparkSession, fmt: str, path: str, schema: StructType = RAW_SCHEMA, **options) -> DataFrame:
    """Format dispatch; unknown formats are rejected instead of falling through."""
    fmt = fmt.lower()
    if fmt == "parquet":
        return read_parquet(spark, path)
    if fmt == "csv":
        return read_csv(spark, path, schema, **options)
    raise ValueError(f"unsupported format {fmt!r}; expected 'parquet' or 'csv'")


def ingest_dir(spark: SparkSession, directory: str, schema: StructType = RAW_SCHEMA,
               lineage: bool = False, null_value: str | None = None, bad_rows: bool = False) -> DataFrame:
    """SRC3: every ``.parquet`` and ``.csv`` file (any case) in ``directory`` as one frame.

    One scan per format (not one job per file), unioned by name. Files with
    other extensions are skipped. Parquet columns are cast to the declared
    schema so both formats line up. ``lineage`` adds ``_source_file``; ``bad_rows``
    adds ``BAD_ROW`` as in ``read_csv`` (null for parquet rows).
    """
    parts = []
    for glob, fmt in ((PARQUET_GLOB, "parquet"), (CSV_GLOB, "csv")):
        try:
            reader = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "false")
            if fmt == "csv":
                df = reader.schema(with_bad_row(schema) if bad_rows else schema).options(**CSV_READ_OPTIONS)
                if null_value is not None:
                    df = df.option("nullValue", null_value)
                df = df.option("columnNameOfCorruptRecord", BAD_ROW).csv(directory)
            else:
                df = reader.parquet(directory)
                df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields],
                               *([F.lit(None).cast("string").alias(BAD_ROW)] if bad_rows else []))
        except Exception as exc:  # no file of this format
            if "PATH_NOT_FOUND" in str(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc):
                continue
            raise
        if lineage:
            df = df.withColumn("_source_file", F.col("_metadata.file_name"))
        parts.append(tag_bad_rows(df) if bad_rows and fmt == "csv" else df)
    if not parts:
        raise FileNotFoundError(f"no parquet or csv files in {directory}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _none_of_format(exc: Exception) -> bool:
    return "PATH_NOT_FOUND" in str(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc)


def _rows_per_file(df: DataFrame, name: str, columns: Sequence[str] = (), more: Sequence[Column] = ()) -> DataFrame:
    """(file_name, ``name``, ``more``): rows of each file, with all ``columns`` really decoded."""
    # a count of the hashes would do, but Spark knows that they are never null and would read no column
    decoded = F.xxhash64(*[F.col(f"`{c}`") for c in columns]).bitwiseAND(F.lit(0))
    seen = F.sum(decoded + 1) if columns else F.count(F.lit(1))
    return df.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(seen.alias(name), *more)


def read_error(df: DataFrame) -> str | None:
    """The error that decoding every column of ``df`` meets, or None."""
    try:
        df.agg(F.max(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))).collect()
    except Exception as exc:
        return str(exc)
    return None


def ingest_status(spark: SparkSession, directory: str, schema: StructType = RAW_SCHEMA) -> DataFrame:
    """SRC4: (file_name, rows, status, error, bad_rows) of every parquet and csv file.

    ``ok``: all columns of all rows can be read. ``partial``: a csv file with rows
    that could not be parsed, ``bad_rows`` of its ``rows``. ``empty``: readable, without
    rows. ``failed``: unreadable, or readable only in part; ``rows`` is what can be
    read and ``error`` says why.

    All files of a format are read in one scan that skips damage; parquet rows are
    compared with the files' footers. Files that give no rows, or fewer than their
    footer states, are read again one by one, for their errors.
    """
    listed, counted = None, None
    for glob, fmt in ((PARQUET_GLOB, "parquet"), (CSV_GLOB, "csv")):
        try:
            files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(directory)
                     .select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), "path", F.lit(fmt).alias("fmt")))
        except Exception as exc:
            if _none_of_format(exc):
                continue
            raise
        listed = files if listed is None else listed.unionByName(files)
        reader = spark.read.option("pathGlobFilter", glob).option("ignoreCorruptFiles", "true")
        if fmt == "csv":
            df = reader.schema(with_bad_row(schema)).options(**CSV_READ_OPTIONS).option("columnNameOfCorruptRecord", BAD_ROW).csv(directory)
            df = tag_bad_rows(df.select("*", "_metadata"))
            bad = F.count_if(F.col(BAD_ROW).isNotNull()).alias("bad_rows")
            counts = _rows_per_file(df, "rows", [f.name for f in schema.fields], [bad]).withColumn("stated", F.col("rows"))
        else:
            try:  # the files' own columns, from the footers that can be read
                df = reader.option("mergeSchema", "true").parquet(directory)
            except Exception as exc:
                if _none_of_format(exc):
                    continue
                raise
            counts = _rows_per_file(df, "stated").join(_rows_per_file(df, "rows", df.columns), "file_name", "left")
            counts = counts.withColumn("bad_rows", F.lit(0).cast("long"))
        counts = counts.select("file_name", "rows", "stated", "bad_rows")
        counted = counts if counted is None else counted.unionByName(counts)
    if listed is None:
        raise FileNotFoundError(f"no parquet or csv files in {directory}")
    if counted is None:
        counted = spark.createDataFrame([], "file_name string, rows long, stated long, bad_rows long")
    status = listed.join(counted, "file_name", "left").select(
        "file_name", "path", "fmt", F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("stated", F.lit(0)).alias("stated"),
        F.coalesce("bad_rows", F.lit(0)).alias("bad_rows"))
    errors = []
    for f in status.filter("rows = 0 or rows < stated").collect():  # names of suspect files only
        try:
            alone = (read_csv(spark, f.path, schema) if f.fmt == "csv" else read_parquet(spark, f.path))
            error = read_error(alone)
        except Exception as exc:  # not even a schema
            error = str(exc)
        if error is None and f.rows < f.stated:
            error = f"{f.rows} of {f.stated} rows could be read"
        errors.append((f.path, error))
    found = spark.createDataFrame(errors, "path string, error string")
    return status.join(found, "path", "left").select(
        "file_name", "rows",
        F.when(F.col("error").isNotNull(), "failed").when(F.col("rows") == 0, "empty").when(F.col("bad_rows") > 0, "partial")
        .otherwise("ok").alias("status"), "error", "bad_rows")


def preview(df: DataFrame, order_by: Sequence[str], n: int = 20) -> DataFrame:
    """SRC6: the first ``n`` rows under a stated order (a top-n, not a sample)."""
    return df.orderBy(*order_by).limit(n)
