"""Session helpers: a sane local session for tests/bench, and shared scratch paths.

On a cluster the caller owns the session; the library only reads settings from it.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings every session of ours gets. AQE re-plans joins and coalesces or
#: splits shuffle partitions at run time from actual sizes, which is what keeps a
#: fixed plan right from sf0.001 up to a 100 TB catalogue.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int | None = None, app: str = "marquee") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(ADAPTIVE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    conf["spark.driver.memory"] = os.environ.get("MARQUEE_DRIVER_MEMORY", "8g")
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and points at shared storage that
    survives executor loss; it is only read here. A bare local session, whose
    executors are one process, gets a fresh folder; any other session without
    the setting is refused, because executors do not share their own disks.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        sc = None
    path = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if not path:
        if sc is None or not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="marquee-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/marquee/{name}-{uuid.uuid4().hex[:12]}"
