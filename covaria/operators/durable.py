"""Intermediate results that later jobs read many times."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[str] = []


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        context.setCheckpointDir(named)
    elif context.master.split("[")[0] == "local":
        context.setCheckpointDir(tempfile.mkdtemp(prefix="covaria-checkpoint-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")


def settle(df: DataFrame) -> DataFrame:
    """``df`` computed once and stored where it outlives the executors that wrote it."""
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table_folder(spark: SparkSession) -> str:
    """The folder that all executors share, for tables between jobs."""
    _ensure_checkpoint_dir(spark)
    return spark.sparkContext.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once and written as a Parquet table in the shared checkpoint folder.

    Unlike ``settle``, later reads fetch only the columns they need. The files stay until
    ``forget`` removes them.
    """
    spark = df.sparkSession
    path = f"{table_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession) -> None:
    """Remove every table ``stored`` wrote; results not yet computed from them are lost."""
    context = spark.sparkContext
    while _written:
        path = context._jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
