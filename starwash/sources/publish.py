"""Versioned tables with one manifest (SNK8): a run's tables become readable together.

``root/_versions/<table>/_run=<run>`` holds what one run wrote; nothing there is changed
afterwards. ``root/_manifest/<number>.json`` lists, for each table, the version
folders that make it up, with rows, files and bytes, and the fingerprints of all
inputs loaded so far (the ledger). A run writes all its tables first; the new
manifest is written under a hidden name and renamed last, which is the only step
that changes what readers see. A run that dies before it leaves the tables as they
were; its folder is listed nowhere and goes with ``remove_unlisted``.

Two runs at once: the second rename of one number fails, and so does that run,
as its tables were made against a manifest that is no longer the latest.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

VERSIONS, MANIFESTS, RUN = "_versions", "_manifest", "_run"


def version_path(root: str, table: str, run: str) -> str:
    """The folder of what ``run`` (a name of its own) writes of a table."""
    return f"{root}/{VERSIONS}/{table}/{RUN}={re.sub('[^A-Za-z0-9_.-]', '_', run)}"


class PublishConflict(RuntimeError):
    """Another run has published since this one read the manifest."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def current(spark: SparkSession, root: str) -> dict | None:
    """The latest manifest, or None."""
    fs, path = _fs(spark, root)
    folder = path(f"{root}/{MANIFESTS}")
    if not fs.exists(folder):
        return None
    names = [s.getPath().getName() for s in fs.globStatus(path(f"{root}/{MANIFESTS}/[0-9]*.json"))]
    if not names:
        return None
    text = spark.read.text(f"{root}/{MANIFESTS}/{max(names)}", wholetext=True).first()[0]
    return json.loads(text)


def read_published(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table as of the latest manifest: all its parts or none of them."""
    manifest = current(spark, root)
    if manifest is None or table not in manifest["tables"]:
        raise FileNotFoundError(f"no published table {table!r} under {root}")
    return read_table(spark, root, manifest["tables"][table])


def read_table(spark: SparkSession, root: str, entry: dict) -> DataFrame:
    schema = StructType.fromJson(entry["schema"])
    parts = [p for p in entry["parts"] if p["files"]]
    if not parts:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    if entry["format"] == "csv":  # by header names, so partition columns may stand anywhere
        reader = reader.option("header", "true").option("enforceSchema", "false")
    base = f"{root}/{parts[0]['path'].rpartition('/')[0]}"  # the runs are partitions of the table's folder
    return reader.option("basePath", base).format(entry["format"]).load([f"{root}/{p['path']}" for p in parts]).drop(RUN)


def entry_of(df: DataFrame, root: str, path: str, rows: int, files: int, nbytes: int, output_format: str, partition_by=()) -> dict:
    """A table's manifest entry with one part; partition columns stand last, as readers see them."""
    fields = sorted(df.schema.fields, key=lambda f: f.name in partition_by)
    part = {"path": path.removeprefix(root).strip("/"), "rows": rows, "files": files, "bytes": nbytes}
    return {"format": output_format, "schema": StructType(fields).jsonValue(), "parts": [part]}


def publish(spark: SparkSession, root: str, run_id: str, tables: dict[str, dict], *, append: bool = False,
            base: dict | None = None, fingerprint: str | None = None) -> dict:
    """Make ``tables`` (name: entry) the current ones; with ``append`` their parts are added to those of ``base``,
    the manifest that the run started from. Raises ``PublishConflict`` if ``base`` is no longer the latest."""
    number = (base["number"] if base else 0) + 1
    merged, inputs = dict(tables), [fingerprint] if fingerprint else []
    if append and base:
        inputs = base["inputs"] + inputs
        for name, old in base["tables"].items():
            if name in merged and merged[name]["format"] != old["format"]:
                raise ValueError(f"{name} is stored as {old['format']}, not {merged[name]['format']}")
            merged[name] = {**old, "parts": old["parts"] + merged[name]["parts"]} if name in merged else old
    manifest = {"number": number, "run_id": run_id, "tables": merged, "inputs": inputs}
    fs, path = _fs(spark, root)
    final = path(f"{root}/{MANIFESTS}/{number:020d}.json")
    hidden = path(f"{root}/{MANIFESTS}/_{number:020d}-{run_id}.json")
    out = fs.create(hidden, True)
    try:
        out.write(json.dumps(manifest).encode())
    finally:
        out.close()
    if fs.exists(final) or not fs.rename(hidden, final):
        fs.delete(hidden, False)
        raise PublishConflict(f"manifest {number} of {root} was published by another run")
    return manifest


def loaded(base: dict | None, fingerprint: str) -> bool:
    """Whether the ledger has an input of this fingerprint."""
    return bool(base) and fingerprint in base["inputs"]


def input_fingerprint(columns: list[str]) -> list[Column]:
    """Aggregates that tell one input from another whatever the order of its rows: two sums of row hashes."""
    values = [F.col(f"`{c}`") for c in columns]
    return [F.sum(F.xxhash64(F.lit(salt), *values).cast("decimal(38,0)")).alias(f"input_hash_{salt}") for salt in (1, 2)]


def remove_unlisted(spark: SparkSession, root: str) -> int:
    """Delete version folders that the latest manifest does not list; returns the number of runs that
    they are of. For times when no run is on."""
    manifest = current(spark, root)
    listed = {p["path"] for t in (manifest or {"tables": {}})["tables"].values() for p in t["parts"]}
    fs, path = _fs(spark, root)
    found = [s.getPath() for s in fs.globStatus(path(f"{root}/{VERSIONS}/*/{RUN}=*")) or []]
    gone = [p for p in found if f"{VERSIONS}/{p.getParent().getName()}/{p.getName()}" not in listed]
    for p in gone:
        fs.delete(p, True)
    return len({p.getName() for p in gone})
