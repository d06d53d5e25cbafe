"""Session helpers: a local session for tests and benches, and the shared
folder (``spark.checkpoint.dir``) where intermediate tables are written.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_FALLBACK_ROOTS: dict[int, str] = {}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "starwash") -> SparkSession:
    """A local session configured like a small cluster (tests and bench only)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # shuffle partitions already equal the local cores; merging them only
        # serialises the CPU-heavy text stages (file sizing turns it on per write)
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(input_bytes: int, partition_bytes: int = 512 << 20, shuffle_expansion: float = 2.0,
               max_shuffle_partitions: int = 200_000) -> dict[str, str]:
    """Session settings for a cluster run over ``input_bytes`` of raw input.

    Shuffle partitions are sized so that the widest shuffle (all rows, ranked
    within their key; decoded rows are about ``shuffle_expansion`` times
    the encoded input) lands near ``partition_bytes`` per task before AQE
    merges small ones, capped so that map x reduce shuffle blocks stay
    manageable (at 100 TB the cap gives about 1 GB per reduce task, which sorts
    with spilling). Scans split at ``partition_bytes``. Skew splitting stays on
    for joins and rebalances. Apply at session build time or with
    ``spark.conf.set`` (all are SQL confs).
    """
    import math

    wanted = math.ceil(input_bytes * shuffle_expansion / partition_bytes)
    shuffle_partitions = min(max(200, wanted), max_shuffle_partitions)
    size = str(partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": size,
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder for intermediate tables.

    Read from ``spark.checkpoint.dir``. Only when that is unset and the master
    is local, a temporary folder is registered; a cluster without it is an error.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    key = id(sc)
    if key not in _FALLBACK_ROOTS:
        _FALLBACK_ROOTS[key] = tempfile.mkdtemp(prefix="starwash-ckpt-")
        sc.setCheckpointDir(_FALLBACK_ROOTS[key])
    return sc.getCheckpointDir().rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared root."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def check_session(spark: SparkSession):
    """Readiness check: run ``select current_date()`` and return the date (SRC7)."""
    return spark.sql("select current_date() as today").collect()[0]["today"]


__all__ = ["local_session", "scale_conf", "shared_root", "work_path", "check_session"]
