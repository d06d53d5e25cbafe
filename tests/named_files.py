"""Files with names of their own, for tests of directory ingest."""

from pyspark.sql import DataFrame

from starwash.plans.catalog import NULL_MARK
from starwash.sources import sinks


def write_named(df: DataFrame, fmt: str, tmp: str, folder: str, name: str) -> None:
    """Write ``df`` in parallel and move its part files into ``folder``.

    The first part file is named ``name``; further ones ``<stem>-<i><ext>``.
    No single-task funnel: a large frame lands as many files.
    """
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.options(**sinks.CSV_WRITE_OPTIONS).option("nullValue", NULL_MARK).csv(tmp)
    else:
        w.format(fmt).save(tmp)
    jvm = df.sparkSession.sparkContext._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    src_dir = path(tmp)
    fs = src_dir.getFileSystem(conf)
    stem, dot, ext = name.rpartition(".")
    parts = sorted(st.getPath().getName() for st in fs.listStatus(src_dir) if st.getPath().getName().startswith("part-"))
    for i, part in enumerate(parts):
        target = name if i == 0 else f"{stem}-{i}{dot}{ext}"
        fs.rename(path(f"{tmp}/{part}"), path(f"{folder}/{target}"))
    fs.delete(src_dir, True)
