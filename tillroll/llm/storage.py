"""Shared intermediate storage: checkpoints and named folders under one root."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without one gets a folder of its own; elsewhere a missing
    setting is an error, because no machine-local folder is seen by all executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
    return str(context.getCheckpointDir()).rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name under the shared root."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint; a lost executor costs a file read."""
    root = shared_root(df.sparkSession)
    if not df.sparkSession.sparkContext.getCheckpointDir():
        df.sparkSession.sparkContext.setCheckpointDir(root)
    return df.checkpoint(eager=True)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder that ``new_folder`` named, once nothing reads it any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until the table has no such column in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
