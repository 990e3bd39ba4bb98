"""The shared folder for checkpoints and work files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def use_checkpoint_dir(spark: SparkSession) -> str:
    """Folder from ``spark.checkpoint.dir``. Where that is unset, a temporary one on a single
    machine, and an error on a cluster, whose executors would not see it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if folder is None:
        folder = current or _own_folder(spark)
    if current is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def _own_folder(spark: SparkSession) -> str:
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="tidemark-")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{use_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
