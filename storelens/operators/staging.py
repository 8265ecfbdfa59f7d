"""Intermediate tables in the folder that all machines share, and their removal."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: folders written by this process, by session
_STAGED: dict[str, list[str]] = {}


def checkpoint_home(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where that is unset (tests, a laptop), a folder below the session's
    warehouse is taken, which executors share as well.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
            "spark.checkpoint.dir"
        )
        sc.setCheckpointDir(
            named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"
        )
    return sc.getCheckpointDir()


def staging_path(spark: SparkSession, kind: str = "stage") -> str:
    """A new folder name below the checkpoint folder, removed by ``drop_staged``."""
    path = f"{checkpoint_home(spark)}/{kind}-{uuid.uuid4().hex}"
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stage(df: DataFrame, **options: str) -> DataFrame:
    """A result that is read more than once, written as a table to the checkpoint folder.

    The table survives the loss of executors, is read column by column, and its
    size is known to the planner, which then picks joins by it.
    """
    spark = df.sparkSession
    path = staging_path(spark)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> int:
    """Removes all tables staged so far; results that still read them must be written first."""
    paths = _STAGED.pop(spark.sparkContext.applicationId, [])
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
    return len(paths)
