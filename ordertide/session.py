"""Session settings and the shared work folder.

The library never creates a session of its own in production code: it takes
the caller's ``SparkSession`` and only sets the SQL options its semantics rely
on (UTC session time zone for epoch/month conversions, dynamic partition
overwrite for idempotent commits, AQE for runtime re-planning and skew).
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Options whose values the pipeline's results depend on.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Options that only affect speed; set when the caller left them at default.
PERFORMANCE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # The tables' files are compact (tens of bytes a row, which are hundreds
    # in a hash aggregate or sort): a split of Spark's 128 MB holds millions
    # of rows and makes a task's aggregate spill.
    "spark.sql.files.maxPartitionBytes": "32m",
    # Tables and raw rows are text columns: a third smaller than by Snappy.
    "spark.sql.parquet.compression.codec": "zstd",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the options the pipeline needs to ``spark`` (idempotent)."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    for key, value in PERFORMANCE_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


_LOCAL_ROOTS: dict[int, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared folder used for files the jobs write.

    On a cluster this is the folder named by ``spark.checkpoint.dir`` (shared
    storage every executor can reach; ``DataFrame.checkpoint()`` uses it too).
    Only when it is unset on a ``local[...]`` master, as in tests, a fresh
    local folder is created once per context and registered with
    ``setCheckpointDir``; on a cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = _LOCAL_ROOTS.get(id(sc))
    if not root and sc.getCheckpointDir():
        # setCheckpointDir(d) stores d/<uuid>; its parent is the shared root.
        root = sc.getCheckpointDir().rstrip("/").rsplit("/", 1)[0]
    if not root:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="ordertide-")
        sc.setCheckpointDir(root)
        _LOCAL_ROOTS[id(sc)] = root
    elif not sc.getCheckpointDir():
        # Named in the configuration but not applied to this context yet.
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "ordertide") -> SparkSession:
    """Session for tests and the local benchmark (UI off, no extra ports)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
