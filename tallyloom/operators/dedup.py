"""Deterministic choice of one row per key."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.match import whole_row


def first_wins(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The first row of each key by `order`, which must tell rows apart. A minimum, so it is taken map-side and a hot key is no burden."""
    return df.groupBy(*keys).agg(F.min_by(whole_row(df), order).alias("_row")).select("_row.*")


def last_wins(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.max_by(whole_row(df), order).alias("_row")).select("_row.*")


def best_by(df: DataFrame, keys: list[str], score: Column, order: Column) -> DataFrame:
    """The row of the highest score of each key, the first by `order` (a number) of several."""
    return df.groupBy(*keys).agg(F.max_by(whole_row(df), F.struct(score, -order)).alias("_row")).select("_row.*")


def repeated_values(df: DataFrame, value: str) -> DataFrame:
    """(value, n, wasted) of values that occur more than once."""
    return df.groupBy(value).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").withColumn("wasted", F.col("n") - 1)
