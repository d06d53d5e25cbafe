"""Readers and sinks."""

from . import readers, sinks
from .readers import ingest_dir, ingest_status, load, preview, read_csv, read_parquet
from .sinks import (
    audit_size,
    write_csv,
    write_files,
    write_metrics,
    write_parquet,
    write_rejects,
    write_sized,
    write_star,
)

__all__ = [
    "readers", "sinks", "ingest_dir", "ingest_status", "load", "preview", "read_csv", "read_parquet",
    "audit_size", "write_csv", "write_files", "write_metrics", "write_parquet", "write_rejects",
    "write_sized", "write_star",
]
