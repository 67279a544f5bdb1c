"""Session helper: the few settings every ledgerflow job relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library expects; callers may override any of them.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # partitioned writes (bronze by gate) keep one writer per value instead of sorting each task
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    # lets decode/encode use the JVM's EBCDIC code pages (faster than translate)
    "spark.sql.legacy.javaCharsets": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "ledgerflow",
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint root named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is only read.
    When it is unset on ``local[...]`` (unit tests, a laptop) a private
    temporary folder is configured instead; on a cluster that is an error, as
    executors would not see it.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset conf raises on some versions
            root = None
    if not root:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="ledgerflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh directory below the shared checkpoint root, unique per call."""
    root = ensure_checkpoint_dir(spark)
    return f"{root}/ledgerflow/{name}-{uuid.uuid4().hex[:12]}"
