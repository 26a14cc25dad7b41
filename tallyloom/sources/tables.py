"""Access to tables by folder, and what Python workers need to import this package."""

import os

from pyspark.sql import DataFrame, SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Puts this package's folder on the path of Python workers that see the same disk. On a cluster, send it by --py-files."""
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if _ROOT not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [path, _ROOT]))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
