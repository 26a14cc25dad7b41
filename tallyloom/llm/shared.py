"""What the operators share: table access, durable intermediate tables, words, row keys."""

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources.tables import importable, table

__all__ = ["BLANKS", "UPPER", "ascii_lower", "discard", "durable", "importable", "written", "partitions", "shared_folder", "spread_join", "table"]

#: The characters that separate words and are stripped from line ends: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: A key with more than 1 of HOT of the rows is spread over PARTS parts of a join.
HOT, PARTS = 1024, 64

_own_folder: list[str] = []
_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Only a local master may lack one; it then gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own_folder:
        _own_folder.append("file://" + tempfile.mkdtemp(prefix="spark-"))
    return _own_folder[0]


def durable(df: DataFrame, *partition_by: str) -> DataFrame:
    """Writes the rows to the shared folder and reads them back: lineage ends here, and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tallyloom-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def written(since: int = 0) -> list[str]:
    """Folders of durable tables that this process has written and not discarded, in order."""
    return _written[since:]


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Deletes folders of durable tables. What reads them must be done, or be written itself."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        _written.remove(path)


def ascii_lower(c: Column) -> Column:
    """A-Z only. lower() would also fold letters beyond ASCII, so it serves pure ASCII strings alone."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", counted: DataFrame | None = None) -> DataFrame:
    """left join right on keys, of which right has each at most once, without gathering a hot key's rows in one task.

    Keys that hold more than 1 of HOT of the rows of `counted` (by default left, which is then read twice) are at most HOT, so that
    list is broadcast. Rows of such a key are dealt to PARTS parts, to which the right row is copied.
    """
    counted = left if counted is None else counted
    total = counted.count()
    hot = F.broadcast(counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") * HOT > F.greatest(F.lit(total), F.lit(HOT))).select(*keys, F.lit(True).alias("_hot")))
    rest = [F.col(c) for c in left.columns if c not in keys] or [F.rand(1)]
    dealt = left.join(hot, keys, "left").withColumn("_part", F.when(F.col("_hot"), F.pmod(F.xxhash64(*rest), F.lit(PARTS)).cast("int")).otherwise(0)).drop("_hot")
    copied = right.join(hot, keys, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.when(F.col("_hot"), PARTS - 1).otherwise(0)))).drop("_hot")
    return dealt.join(copied, [*keys, "_part"], how).drop("_part")
