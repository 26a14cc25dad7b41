"""Connected components of an edge table by alternating large-star and small-star rounds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import discard, durable, spread_join, written

MAX_ROUNDS = 60


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): every node of the edges, its root being the smallest node that it can reach.

    Nodes are of any type that has an order. A round hangs every node's larger neighbours, then its smaller ones, under the smallest of
    them. Edges never grow in number, a node with very many neighbours is summed map-side before its minimum meets
    them in a join that spreads it over many parts, and each round is written to the shared folder. Rounds end when the edges no longer
    change, after a logarithmic number. Null ends and loops are no edges. Without edges there are no rows.
    """
    first = edges.select(F.greatest(a, b).alias("_u"), F.least(a, b).alias("_v")).filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    spark, mark = edges.sparkSession, len(written())
    now = durable(first.distinct())
    before = None
    for _ in range(MAX_ROUNDS):
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("_u", "_v").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("_u").alias("node"), F.col("_v").alias("root")).unionByName(now.select(F.col("_v").alias("node"), F.col("_v").alias("root")).distinct())
        before = state
        both = now.unionByName(now.select(F.col("_v").alias("_u"), F.col("_u").alias("_v")))
        least = both.groupBy("_u").agg(F.min("_v").alias("_m")).select("_u", F.least("_m", "_u").alias("_m"))
        large = durable(spread_join(both, least, ["_u"]).filter("_v > _u").select(F.col("_v").alias("_u"), F.col("_m").alias("_v")).distinct())
        smallest = large.groupBy("_u").agg(F.min("_v").alias("_m"))
        small = spread_join(large, smallest, ["_u"]).filter("_v != _m").select(F.col("_v").alias("_u"), F.col("_m").alias("_v"))
        now = durable(small.unionByName(smallest.select("_u", F.col("_m").alias("_v"))).distinct())
        discard(spark, written(mark)[:-1])  # rounds before
    raise RuntimeError("components did not settle")
