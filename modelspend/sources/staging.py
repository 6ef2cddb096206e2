"""Storing an intermediate result that several parts of a plan read.

Nothing is stored unless a caller passes a :class:`Stages` where a function takes
``stage``.  A result is written once, as Parquet in a folder that all executors
share, so it survives lost executors and readers load only the columns they use.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"


class Stages:
    """Stores results below ``folder``; :meth:`clear` deletes what it stored."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = f"{folder.rstrip('/')}/stages-{uuid.uuid4().hex}"

    def __call__(self, df: DataFrame) -> DataFrame:
        """Compute ``df`` now and return it as a stored table."""
        path = f"{self.folder}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def shared_stages(spark: SparkSession) -> Stages:
    """Stages in the folder that ``spark.checkpoint.dir`` names; an error without one."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        raise ValueError(f"staging needs {CHECKPOINT_DIR}, a folder that all executors share")
    return Stages(spark, folder)


def unstaged(df: DataFrame) -> DataFrame:
    """Keep ``df`` lazy; readers recompute it."""
    return df
