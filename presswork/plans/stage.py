"""Intermediate tables in the shared checkpoint folder.

A staged table cuts the lineage, outlives lost executors, and, unlike an RDD
checkpoint, gives Catalyst exact file sizes for its join choices.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_local_folders: list[tempfile.TemporaryDirectory] = []


def checkpoint_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.TemporaryDirectory(prefix="presswork-", ignore_cleanup_errors=True)
    _local_folders.append(folder)
    spark.sparkContext.setCheckpointDir(folder.name)
    return folder.name


def stage_folder(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/presswork-{spark.sparkContext.applicationId}"


def staged(df: DataFrame, label: str = "stage", schema: StructType | None = None) -> DataFrame:
    """Write ``df`` once and return the written table, read with ``schema`` if given."""
    spark = df.sparkSession
    path = f"{stage_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    files, spark = table.inputFiles(), table.sparkSession
    if files:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear(spark: SparkSession) -> None:
    """Delete the staged tables of this application; results not yet read are lost."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(stage_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
