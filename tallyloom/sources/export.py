"""A store's resources as snapshots: files of pages of JSON read as one table, with what belongs to each joined on, and all kinds under one schema."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.sources import files

METAFIELD = "struct<namespace:string,key:string,value:string,type:string>"
#: What every kind of resource has here; a kind that lacks a column has nulls in it.
RESOURCE = f"kind string, id string, handle string, title string, body_html string, metafields array<{METAFIELD}>"


def snapshot(spark: SparkSession, folder: str, kind: str, schema: str) -> DataFrame:
    """The rows of all page files of a kind, <folder>/<kind>/*.json, each a JSON array or one object a line. A file is read by one task, through Spark, wherever it lies. Fields that a page lacks are null, others are ignored; a kind
    without files has no rows. A file that is no JSON fails the job rather than losing its rows."""
    path = f"{folder.rstrip('/')}/{kind}/*.json"
    if not files.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def with_metafields(rows: DataFrame, metafields: DataFrame) -> DataFrame:
    """rows: (id, ...); metafields: (owner_id, namespace, key, value, type). Adds metafields, an array in order of namespace and key, empty for none: one join for all rows instead of a call for each. Of several of one key the largest counts."""
    once = metafields.groupBy("owner_id", "namespace", "key").agg(F.max(F.struct("value", "type")).alias("_v"))
    listed = once.groupBy(F.col("owner_id").cast("string").alias("_owner")).agg(F.array_sort(F.collect_list(F.struct("namespace", "key", "_v.value", "_v.type"))).alias("metafields"))
    met = rows.join(listed, rows["id"].cast("string") == F.col("_owner"), "left").drop("_owner")
    return met.withColumn("metafields", F.coalesce(F.col("metafields"), F.array().cast(f"array<{METAFIELD}>")))


def all_resources(kinds: dict[str, DataFrame]) -> DataFrame:
    """(kind, id, handle, title, body_html, metafields) of all kinds, whatever columns each has; ids are texts. A kind without rows adds none."""
    empty = None
    for kind, rows in kinds.items():
        own = rows.withColumn("kind", F.lit(kind)).withColumn("id", F.col("id").cast("string"))
        columns = T._parse_datatype_string(RESOURCE)
        shaped = own.select(*[(F.col(f.name) if f.name in own.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in columns])
        empty = shaped if empty is None else empty.unionByName(shaped)
    if empty is None:
        raise ValueError("no kinds of resources")
    return empty
