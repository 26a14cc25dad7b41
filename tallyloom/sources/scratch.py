"""Intermediate tables in the folder that the driver and all executors share, and joins that spread hot keys."""

import functools
import tempfile
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources.tables import importable

#: A key with more than 1 of HOT of the rows is dealt to PARTS parts of a join.
HOT, PARTS = 1024, 32

_own: list[str] = []


def folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Only a local master may lack one; it then gets its own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own:
        _own.append("file://" + tempfile.mkdtemp(prefix="spark-"))
    return _own[0]


def kept(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read back: they are worked out once, and lost executors cost nothing."""
    spark = df.sparkSession
    importable(spark)
    path = f"{folder(spark)}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def finer(df: DataFrame, times: int = 4) -> DataFrame:
    """df, a table read from files, in about so many times as many tasks: Spark sizes a scan's tasks by all its files and the cores, which gives little more than a task a core where much is packed into few bytes."""
    files = sorted(map(unquote, df.inputFiles()))
    parts = [df.sparkSession.read.schema(df.schema).parquet(*files[k::times]) for k in range(min(times, len(files)))]
    return functools.reduce(DataFrame.unionByName, parts) if parts else df


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """left join right on keys. Rows of left whose key holds more than 1 of HOT of them are dealt to PARTS parts by hash and meet a copy of right's rows in each. There are
    HOT such keys at most, so their list is sent to all tasks. left is read three times, so it should be a table."""
    total = left.count()
    often = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_how_often")).filter(F.col("_how_often") * HOT > max(total, HOT)).select(*keys, F.lit(True).alias("_is_hot"))
    hot = F.broadcast(often)
    rest = [F.col(f"`{c}`") for c in left.columns if c not in keys] or [F.lit(0)]
    dealt = left.join(hot, keys, "left").withColumn("_spread", F.when(F.col("_is_hot"), F.pmod(F.xxhash64(*rest), F.lit(PARTS)).cast("int")).otherwise(0)).drop("_is_hot")
    copied = right.join(hot, keys, "left").withColumn("_spread", F.explode(F.sequence(F.lit(0), F.when(F.col("_is_hot"), PARTS - 1).otherwise(0)))).drop("_is_hot")
    return dealt.join(copied, [*keys, "_spread"], how).drop("_spread")
