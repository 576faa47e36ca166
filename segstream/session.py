"""Session helpers: a local session for tests and the bench, and the shared
folder where jobs put tables they write and checkpoints they cut lineage with.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names (an
HDFS or object-store URI that every executor sees).  We only pick our own
folder when the session has none, which is the case in unit tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "segstream") -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; set one only where it is unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        # Only reached in tests / local runs: there is no shared folder to use.
        configured = tempfile.mkdtemp(prefix="segstream-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_root(spark: SparkSession) -> str:
    """The shared folder for tables and scratch data (below the checkpoint dir)."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        configured = ensure_checkpoint_dir(spark)
    return configured.rstrip("/")


def fresh_table_root(spark: SparkSession, label: str = "tables") -> str:
    """A new, empty table root under the shared folder (one per run)."""
    return f"{shared_root(spark)}/segstream-{label}/{uuid.uuid4().hex}"
