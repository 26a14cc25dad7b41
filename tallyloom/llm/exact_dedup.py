"""Exact dedup by a tree-merge of sorted digest runs, in DataFrame operations only."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import durable, partitions

#: How many runs one merge joins; there are as many runs as its power that the partitions reach.
FAN_IN = 8

_DIGEST = ["_sha", "_len", "_alt"]


def tree(spark, fan_in: int = FAN_IN) -> tuple[int, int]:
    """(rounds, runs): as many runs as the session has partitions, rounded up to a power of fan_in."""
    rounds, runs = 1, fan_in
    while runs < partitions(spark):
        rounds, runs = rounds + 1, runs * fan_in
    return rounds, runs


def _sorted_runs(rows: DataFrame, runs: int) -> DataFrame:
    """A partition for each run, sorted by digest; what groups by run and digest above needs neither exchange nor sort."""
    return rows.repartitionById(runs, F.col("_run")).sortWithinPartitions("_run", *_DIGEST)


def merge_round(merged: DataFrame, level: int, fan_in: int, runs: int, pick) -> DataFrame:
    """One round: every run trades with the fan_in - 1 runs that differ from it in one digit of their number. It keeps the digests
    with its own digit and merges them with what it is sent, retaining the extreme id, so the digests of a run grow fewer in
    kind but come from fan_in times as many leaves."""
    place = fan_in**level
    digit = F.pmod(F.shiftright("_alt", 7), F.lit(runs)) if runs > 1 else F.lit(0)
    own = F.expr(f"(_run div {place}) % {fan_in}")
    sent = merged.withColumn("_run", (F.col("_run") + (F.floor(digit / place) % fan_in - own) * place).cast("int"))
    return _sorted_runs(sent, runs).groupBy("_run", *_DIGEST).agg(pick("_keep").alias("_keep"), F.sum("_n").alias("_n"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise=None, keep: str = "largest", fan_in: int = FAN_IN) -> DataFrame:
    """One verdict per row: (id, keep_id, group_size, kept, text_sha256).

    Texts are read and hashed once: their digests are dealt to runs by row, and each run is sorted and written to the shared
    folder, each of its digests once. Then runs are merged in binomial rounds: in round k, runs that agree in all but the k-th digit of their number exchange
    sorted parts and merge them, keeping of equal digests the one with the extreme id, until each run holds all there is of its own
    digests. A merge meets a digest at most fan_in times, however many copies it has. SHA-256, length in bytes and a second hash
    must all agree to be merged. The verdicts go down the same way: the merged runs answer each leaf run's
    digests, and these answer the rows, so copies meet their verdict spread over all runs.

    A null text counts as empty; the length of a text does not matter beyond its hashing. Rows that repeat id and text have a row each, all kept or
    all dropped, and count in group_size. A null id is smaller than any other for `keep="largest"` and never chosen for
    `keep="smallest"` while another is there; a group of null ids alone has a null keep_id and keeps them. Extra columns are
    ignored, whatever they are called. An empty table gives no rows.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(keep)
    spark = docs.sparkSession
    rounds, runs = tree(spark, fan_in)
    text = F.coalesce(F.col(text_col), F.lit(""))
    text = normalise(text) if normalise else text
    # A struct orders null ids as wanted, and its buffers make Spark merge by sorted order rather than by hash tables.
    absent = F.col("_id").isNotNull() if keep == "largest" else F.col("_id").isNull()
    pick = F.max if keep == "largest" else F.min
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text")).select(
        "_id",
        F.unhex(F.sha2("_text", 256)).alias("_sha"),
        F.octet_length("_text").alias("_len"),
        F.xxhash64("_text").alias("_alt"),
    )
    dealt = rows.withColumn("_run", F.pmod(F.xxhash64("_id", F.monotonically_increasing_id()), F.lit(runs)).cast("int"))
    leaves = durable(dealt)
    both = F.struct(absent.alias("there"), F.col("_id").alias("id"))
    merged = level = durable(_sorted_runs(leaves, runs).groupBy("_run", *_DIGEST).agg(pick(both).alias("_keep"), F.count(F.lit(1)).alias("_n")))
    for k in range(rounds):
        merged = merge_round(merged, k, fan_in, runs, pick)
    answers = level.select("_run", *_DIGEST).join(merged.drop("_run"), _DIGEST)
    return leaves.join(answers, ["_run", *_DIGEST]).select(
        F.col("_id").alias(id_col),
        F.col("_keep.id").alias("keep_id"),
        F.col("_n").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep.id")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that exact_dedup keeps, with all their columns; of rows that repeat id and text, one stays."""
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
        F.xxhash64(id_col).alias("_kept_id"),
        F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("_kept_sha"),
    )
    kept = exact_dedup(docs, id_col, text_col).filter("kept").select(F.xxhash64(id_col).alias("_kept_id"), F.col("text_sha256").alias("_kept_sha")).distinct()
    return whole.join(kept, ["_kept_id", "_kept_sha"]).dropDuplicates(["_kept_id", "_kept_sha"]).select("_doc.*")
