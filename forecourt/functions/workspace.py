"""Where intermediate files go: a folder every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where the setting is absent, a fresh folder is used in local mode (one
    machine, so it is shared by definition); elsewhere that is an error, since a
    machine-local folder would lose data with its executor.
    """
    root = spark.conf.get(_CONF, None) or spark.sparkContext.getConf().get(_CONF, None)
    if root:
        return root.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0]
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_CONF} to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="forecourt-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused folder name below the shared root."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write the frame once to the shared folder and go on from the files.

    The written rows stay the same however often they are read, also when an
    executor is lost; upstream work is not repeated. ``compression`` is the codec of the
    files, the session's if it is not given.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "cut")
    writer = df.write.option("compression", compression) if compression else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
