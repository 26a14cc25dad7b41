"""Operators that depend on the order of rows: shifts against neighbours, batches, greedy packing."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyloom.sources.scratch import kept, partitions

MAX_OFFSET = 5


def shifted_rows(df: DataFrame, group: list[str], order: str, source_tokens: Column, target_tokens: Column, least: int = 3, offset: int = MAX_OFFSET, own_tokens: Column | None = None, keep: str | None = None) -> DataFrame:
    """Rows whose target shares more tokens with a neighbour's source than with its own: (group, pos, offset, own, other).
    own_tokens: what the row's own source offers, if other than source_tokens. keep: a column that comes along.

    Neighbours stand up to `offset` rows away within the group. Rows are shuffled once, as they come, by their group; tokens are taken and neighbours looked at behind that. The neighbour with the largest overlap wins, the
    nearest and then the earlier one of several. Rows of a null group have no neighbours.
    """
    also = [keep] if keep else []
    placed = df.na.drop(subset=group).withColumn("_at", F.row_number().over(Window.partitionBy(*group).orderBy(order)))
    placed = placed.select(*group, *also, F.col("_at").alias("pos"), source_tokens.alias("_s"), target_tokens.alias("_t"), (source_tokens if own_tokens is None else own_tokens).alias("_own"))
    shifts = [k for k in range(-offset, offset + 1) if k]
    around = Window.partitionBy(*group).orderBy("pos")
    seen = placed.select(*group, *also, "pos", "_t", "_own", *[F.lead("_s", k).over(around).alias(f"_s{k}") for k in shifts])
    own = F.size(F.array_intersect("_own", "_t")).alias("own")
    each = F.array(*[F.struct(F.size(F.array_intersect("_t", f"_s{k}")).alias("other"), F.lit(-abs(k)).alias("near"), F.lit(-k).alias("first")) for k in shifts])
    best = seen.select(*group, *also, "pos", own, F.array_max(F.filter(each, lambda x: x["other"].isNotNull())).alias("_b"))
    good = best.filter((F.col("_b.other") >= least) & (F.col("_b.other") > F.col("own")))
    return good.select(*group, *also, "pos", (-F.col("_b.first")).alias("offset"), "own", F.col("_b.other").alias("other"))


def fixed_batches(df: DataFrame, group: list[str], order: str, size: int) -> DataFrame:
    """Adds batch: rows of a group in order, `size` to a batch, from 0."""
    place = F.row_number().over(Window.partitionBy(*group).orderBy(order)) - 1
    return df.withColumn("batch", F.floor(place / size).cast("long"))


#: Rows of a block that is looked at together, and blocks (or groups of them) whose effects are put together in one task.
BLOCK_ROWS, FAN_IN = 8192, 512


def next_starts(weights: np.ndarray, alone: np.ndarray, most_weight: float, most_rows: int) -> np.ndarray:
    """For each row, where the batch that begins there ends: the next batch's first row, or the number of rows."""
    n = len(weights)
    sums = np.r_[0, np.cumsum(weights)]
    after = np.searchsorted(sums, sums[:-1] + most_weight, side="right") - 1
    barriers = np.r_[np.flatnonzero(alone), n]
    here = np.arange(n)
    barrier = barriers[np.searchsorted(barriers, here, side="right")]  # the next row that is a batch of its own
    after = np.minimum(np.minimum(after, here + most_rows), barrier)
    return np.where(alone, here + 1, np.maximum(after, here + 1))


def passages(starts: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row of a block of `rows` as a batch's first row: how many batches begin in the block from there on, and how far beyond the block the one after them begins."""
    to = np.r_[starts[:rows], np.arange(rows, len(starts) + 1)]
    begun = np.r_[np.ones(rows, np.int64), np.zeros(len(to) - rows, np.int64)]
    while (to[:rows] < rows).any():
        begun = begun + begun[to]
        to = to[to]
    return begun[:rows], to[:rows] - rows


def _composed(blocks: list[tuple[list[int], list[int]]]) -> tuple[list[int], list[int]]:
    """The effect of several blocks in turn, each given as (batches begun, how far beyond) by where it is entered."""
    begun, beyond = (np.array(x, np.int64) for x in blocks[0])
    for more, further in blocks[1:]:
        n, f = np.array(more, np.int64), np.array(further, np.int64)
        at = np.minimum(beyond, len(n) - 1)  # only a group's last block has fewer entries than asked for
        inside = beyond < len(n)
        begun, beyond = begun + np.where(inside, n[at], 0), np.where(inside, f[at], 0)
    return begun.tolist(), beyond.tolist()


def _numbered(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """(_g, _at, _row): each row with its place in its group, from 0. Rows are dealt by ranges of group and order, so a group may lie in any number of tasks; each range is sorted and written once."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
    ranged = df.select(row, F.col(group).alias("_g")).repartitionByRange(partitions(df.sparkSession), "_g", *[f"_row.`{c}`" for c in order])
    placed = kept(ranged.sortWithinPartitions("_g", *[f"_row.`{c}`" for c in order]).withColumn("_place", F.monotonically_increasing_id()))
    placed = placed.withColumn("_range", F.shiftright("_place", 33))
    parts = placed.groupBy("_g", "_range").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_g").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))  # a row for each range of a group
    starts = parts.select(F.col("_g").alias("_of"), F.col("_range").alias("_in"), "_first", F.coalesce(before, F.lit(0)).alias("_start"))
    met = placed.join(starts, F.col("_g").eqNullSafe(F.col("_of")) & (F.col("_range") == F.col("_in")))
    return met.select("_g", (F.col("_start") + F.col("_place") - F.col("_first")).alias("_at"), "_row")


def greedy_batches(df: DataFrame, group: str, order: str | list[str], weight: str, most_weight: int, most_rows: int, alone: str | None = None, block_rows: int = BLOCK_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """Adds batch (from 0 in each group): rows of a group in order; a new batch begins when the next row would exceed either limit. A row over the limit by itself is a batch.
    alone: a column of booleans; such rows are batches of their own. Weights are whole numbers of at least 0, null counts as 0. `order` (one or more columns) has no ties within a group.

    The state starts anew at each overflow, which no window function expresses. But where the next batch begins is told by the row that one begins at and the
    `most_rows` after it. So a group, however large, is cut into blocks of block_rows; a block, with the first rows of the next one, gives for each row at which it may be entered how many batches begin there
    and where the next block is entered. These effects are put together by fan_in blocks, and these again, until a group is one; then entries go back down and each block numbers
    its own batches. No task holds more than a block or fan_in effects. A null group is a group. An empty table gives no rows.
    """
    if "batch" in df.columns:
        raise ValueError("there is a column batch already")
    order, size = [order] if isinstance(order, str) else order, max(block_rows, most_rows)
    schema = T.StructType([*df.schema.fields, T.StructField("batch", T.LongType())])
    flag = F.coalesce(F.col(f"_row.`{alone}`"), F.lit(False)) if alone else F.lit(False)
    rows = _numbered(df, group, order).withColumns({"_block": F.floor(F.col("_at") / size).cast("long"), "_w": F.coalesce(F.col(f"_row.`{weight}`").cast("long"), F.lit(0)), "_alone": flag})
    rows = kept(rows)
    ahead = rows.filter((F.col("_at") % size < most_rows) & (F.col("_block") > 0)).withColumn("_block", F.col("_block") - 1)
    seen = rows.select("_g", "_block", "_at", "_w", "_alone").unionByName(ahead.select("_g", "_block", "_at", "_w", "_alone"))

    def starts_of(at: np.ndarray, weights: np.ndarray, lonely: np.ndarray) -> tuple[np.ndarray, int]:
        by = np.argsort(at, kind="stable")
        return next_starts(weights[by], lonely[by], most_weight, most_rows), int((at // size == at[by[0]] // size).sum())

    def effect(key: tuple, block: pa.Table) -> pa.Table:
        starts, n = starts_of(*(block.column(c).to_numpy() for c in ("_at", "_w", "_alone")))
        begun, beyond = passages(starts, n)
        entries = min(most_rows, n)
        return pa.table({"_g": block.column("_g")[:1], "_block": block.column("_block")[:1], "_begun": [begun[:entries].tolist()], "_beyond": [beyond[:entries].tolist()]}, schema=effects)

    group_kind = df.schema[group].dataType
    spark_effects = T.StructType([T.StructField("_g", group_kind), *[T.StructField(n, t) for n, t in (("_block", T.LongType()), ("_begun", T.ArrayType(T.LongType())), ("_beyond", T.ArrayType(T.LongType())))]])
    spark_entries = T.StructType([T.StructField("_g", group_kind), *[T.StructField(n, T.LongType()) for n in ("_block", "_entry", "_base")]])
    effects, entries_of = to_arrow_schema(spark_effects), to_arrow_schema(spark_entries)

    def put_together(key: tuple, blocks: pa.Table) -> pa.Table:
        found = sorted(zip(*(blocks.column(c).to_pylist() for c in ("_block", "_begun", "_beyond")), strict=True))
        begun, beyond = _composed([x[1:] for x in found])
        return pa.table({"_g": blocks.column("_g")[:1], "_block": [found[0][0] // fan_in], "_begun": [begun], "_beyond": [beyond]}, schema=effects)

    def handed_down(key: tuple, entries: pa.Table, blocks: pa.Table) -> pa.Table:
        at, base = entries.column("_entry")[0].as_py(), entries.column("_base")[0].as_py()
        out = []
        for block, begun, beyond in sorted(zip(*(blocks.column(c).to_pylist() for c in ("_block", "_begun", "_beyond")), strict=True)):
            out.append((block, at, base))
            if at < len(begun):
                base, at = base + begun[at], beyond[at]
            else:
                at = 0
        group_values = pa.concat_arrays([blocks.column("_g").combine_chunks()]) if blocks.num_rows else blocks.column("_g")
        return pa.table({"_g": group_values, **{n: [x[k] for x in out] for k, n in enumerate(("_block", "_entry", "_base"))}}, schema=entries_of)

    levels = [kept(seen.groupBy("_g", "_block").applyInArrow(effect, spark_effects))]
    while levels[-1].filter("_block > 0").limit(1).count():
        levels.append(kept(levels[-1].groupBy("_g", F.expr(f"_block div {fan_in}")).applyInArrow(put_together, spark_effects)))
    entries = levels[-1].select("_g", "_block", F.lit(0).cast("long").alias("_entry"), F.lit(0).cast("long").alias("_base"))
    for level in reversed(levels[:-1]):
        entries = kept(entries.groupBy("_g", "_block").cogroup(level.groupBy("_g", F.expr(f"_block div {fan_in}"))).applyInArrow(handed_down, spark_entries))

    def number(key: tuple, entry: pa.Table, block: pa.Table) -> pa.Table:
        block = block.take(pa.array(np.argsort(block.column("_at").to_numpy(), kind="stable")))
        own = block.filter(block.column("_mine"))
        starts, n = next_starts(*(block.column(c).to_numpy() for c in ("_w", "_alone")), most_weight, most_rows), own.num_rows
        first, at, base = [], entry.column("_entry")[0].as_py(), entry.column("_base")[0].as_py()
        while at < n:
            first.append(at)
            at = int(starts[at])
        batch = base - 1 + np.searchsorted(np.array(first, np.int64), np.arange(n), side="right")
        fields = own.column("_row").combine_chunks()
        return pa.Table.from_arrays([*fields.flatten(), pa.array(batch, pa.int64())], names=schema.names)

    blank = F.lit(None).cast(rows.schema["_row"].dataType)
    whole = rows.withColumn("_mine", F.lit(True)).unionByName(ahead.withColumn("_row", blank).withColumn("_mine", F.lit(False)))
    return entries.groupBy("_g", "_block").cogroup(whole.groupBy("_g", "_block")).applyInArrow(number, schema)
