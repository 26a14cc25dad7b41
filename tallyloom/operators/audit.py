"""Counts, coverage, differences between runs, and profiles of semi-structured values."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def status_rollup(df: DataFrame, group: str, status: Column, good: str) -> DataFrame:
    """(group, n, n_good, percent_good) by group and, under the null group, for all; 100 percent of nothing."""
    counted = df.withColumn("_good", (status == good).cast("int")).rollup(group).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_good"), F.lit(0)).alias("n_good"))
    return counted.withColumn("percent_good", F.when(F.col("n") > 0, 100.0 * F.col("n_good") / F.col("n")).otherwise(100.0))


def coverage(df: DataFrame, group: str, bucket: Column) -> DataFrame:
    """bucket: empty, not_text, keep, translated or gap. Coverage is translated of translated and gaps, 100 percent of none."""
    names = ("empty", "not_text", "keep", "translated", "gap")
    counted = df.withColumn("_b", bucket).groupBy(group).agg(*[F.count_if(F.col("_b") == x).alias(f"n_{x}") for x in names])
    there = F.col("n_translated") + F.col("n_gap")
    return counted.withColumn("coverage", F.when(there > 0, 100.0 * F.col("n_translated") / there).otherwise(100.0))


def run_delta(before: DataFrame, after: DataFrame, status: str) -> DataFrame:
    """(status, before, after, delta) of two runs."""
    count = lambda df, name: df.groupBy(status).agg(F.count(F.lit(1)).alias(name))
    both = count(before, "before").join(count(after, "after"), status, "full_outer").fillna(0, ["before", "after"])
    return both.withColumn("delta", F.col("after") - F.col("before"))


def json_profile(df: DataFrame, column: str) -> DataFrame:
    """Profile of the top-level keys of JSON objects: (path, n, n_filled, longest, n_distinct)."""
    pairs = df.select(F.explode(F.from_json(column, "map<string,string>")).alias("path", "_v"))
    zero = F.col("_v").isNull() | (F.col("_v") == "")
    return pairs.groupBy("path").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~zero).alias("n_filled"), F.max(F.length("_v")).cast("long").alias("longest"), F.count_distinct("_v").alias("n_distinct")
    )


def section_score(findings: DataFrame) -> DataFrame:
    """findings: (section, verdict). Passes, failures and warnings by section, and passes of passes and failures."""
    counts = findings.groupBy("section").agg(*[F.count_if(F.col("verdict") == v).alias(f"n_{v}") for v in ("pass", "fail", "warn")])
    return counts.withColumn("score", F.col("n_pass") / F.greatest(F.col("n_pass") + F.col("n_fail"), F.lit(1)))


def strongest_finding(findings: DataFrame, key: str, ranks: dict[str, int]) -> DataFrame:
    """One finding per key: the source of the smallest rank wins, unknown sources come last."""
    rank = F.coalesce(*[F.when(F.col("source") == s, r) for s, r in ranks.items()], F.lit(999))
    return findings.groupBy(key).agg(F.min_by(F.struct("source", "reason"), F.struct(rank, "source", "reason")).alias("_f")).select(key, "_f.*")
