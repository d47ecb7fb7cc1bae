"""Cutting lineage.

Only reliable checkpoints are used: the data is written to the shared folder
the cluster names in ``spark.checkpoint.dir``, so a lost executor costs a
re-read, not a recomputation of the whole lineage.  The setting is read from
the session and never invented here.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The session's checkpoint folder, from ``spark.checkpoint.dir`` or the
    SparkContext, or None when neither names one."""
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # pragma: no cover - Spark Connect has no SparkContext
        return None


def materialize(df: DataFrame) -> DataFrame:
    """Eager reliable checkpoint of ``df`` into the session's checkpoint folder."""
    if checkpoint_dir(df.sparkSession) is None:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before materialising a DataFrame")
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder name under the session's checkpoint folder.  Where none is
    set, a local session gets one in the temp folder; a cluster must name one."""
    base = checkpoint_dir(spark)
    if base is None:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="barlab-")
        spark.sparkContext.setCheckpointDir(base)
    if base.startswith("/"):
        base = "file://" + base
    return f"{base.rstrip('/')}/{what}-{uuid.uuid4().hex}"
