"""Session settings and the shared work folder.

Every write the library makes (lake, warehouse versions, stream checkpoints,
landing files) goes below one *work root*.  On a cluster that root is the
shared folder named by ``spark.checkpoint.dir``; the library only reads it.
A private folder is created only for local sessions where it is unset
(tests, the bench, the driver's smoke runs).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on: UTC wall clock for timestamp_ntz data,
# adaptive execution for runtime join/skew/coalesce decisions.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tidemark") -> SparkSession:
    """Session for tests and local runs (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library depends on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def work_root(spark: SparkSession) -> str:
    """Shared folder for lake / warehouse / checkpoints.

    Uses ``spark.checkpoint.dir`` when the cluster names one.  Only a local
    session with no setting gets a fresh private folder, which becomes the
    checkpoint folder and so is found again.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        jdir = sc._jsc.sc().getCheckpointDir()
        if jdir.isDefined():
            root = jdir.get()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster run needs a shared folder for the lake")
        root = tempfile.mkdtemp(prefix="tidemark-")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(root.rstrip("/") + "/rdd-checkpoints")
    return root.rstrip("/")


def new_work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the work root for one run of ``name``."""
    safe = "".join(ch if ch.isalnum() or ch in "-_" else "_" for ch in name)
    return f"{work_root(spark)}/{safe}-{uuid.uuid4().hex[:12]}"
