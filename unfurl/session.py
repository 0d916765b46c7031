"""Session helpers: a tuned builder for local runs and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings used by tests and the bench. On a cluster the submitting job brings
# its own session; the library only reads from it.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "unfurl", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("UNFURL_DRIVER_MEMORY", "8g")))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _conf(spark: SparkSession, key: str) -> str | None:
    try:
        value = spark.conf.get(key)
    except Exception:  # unset key raises on some versions
        value = None
    if not value:
        value = spark.sparkContext.getConf().get(key, None)
    return value or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Where the session names none, a ``local`` master (tests, bench) gets a
    private folder, once per application. Any other master raises: executors
    of a cluster do not see each other's disks, so a staged table in a
    machine-local folder would be read back incomplete.
    """
    sc = spark.sparkContext
    base = _conf(spark, "spark.checkpoint.dir") or sc.getCheckpointDir()
    if base is None:
        # "local-cluster" starts executors with folders of their own
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all "
                               f"executors share (master {sc.master})")
        base = tempfile.mkdtemp(prefix="unfurl-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared folder; ``unique=True`` adds a fresh run id."""
    segs = [ensure_checkpoint_dir(spark), "unfurl", *parts]
    if unique:
        segs.append(uuid.uuid4().hex[:12])
    return "/".join(s.strip("/") if i else s for i, s in enumerate(segs))
