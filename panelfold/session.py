"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Runtime re-planning: measured sizes pick broadcast joins, hot partitions are split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "panelfold", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; every setting can be overridden by the caller.

    ``spark.sql.shuffle.partitions`` is left to the cluster's own configuration: with adaptive
    execution it is an upper bound that is coalesced to the measured shuffle size.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A local session without that setting gets a folder of its own; a cluster session without it is
    an error, since a machine-local folder would not be visible to the other executors.
    """
    path = spark.conf.get(CHECKPOINT_DIR, None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="panelfold-")
    spark.conf.set(CHECKPOINT_DIR, path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a result is read several times: the copy survives the loss of any executor and later
    passes prune its columns instead of repeating the shuffles before it.
    """
    spark = df.sparkSession
    path = os.path.join(scratch_dir(spark), f"{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


_staged: dict[str, list[str]] = {}


def release_staged(spark: SparkSession) -> int:
    """Delete everything this session has staged; call it when no result that was built on it is read any more."""
    paths = _staged.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return len(paths)
