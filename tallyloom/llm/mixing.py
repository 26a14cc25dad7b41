"""Mixing sources to target weights over fixed-length token blocks, in DataFrame operations only."""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.shared import durable, partitions

WEIGHTS, TOTAL_SHARE, MAX_REPEATS = (3, 1, 2), 1.5, 2.0
BLOCK_WORDS, SHARD_BLOCKS, SLOT_RUN, SEED = 64, 4096, 8192, 20240229
#: Coin throws that are counted one by one; more are drawn by inverting the binomial law.
THROWS = 1024
#: Feistel rounds, and how often a value outside the domain is sent through again.
ROUNDS, WALKS = 4, 24


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Adds each row's place in the order, from 0, without one task for all: rows are dealt by ranges of the order, numbered there, and moved on by what lies
    before. Written to the shared folder, as ranges come from a sample."""
    count = partitions(rows.sparkSession)
    dealt = durable(rows.repartitionByRange(count, *order).withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))  # a row for each partition
    placed = dealt.withColumn("_place", F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1)
    return placed.join(F.broadcast(starts), "_range").withColumn(name, F.col("_start") + F.col("_place")).drop("_range", "_n", "_start", "_place")


def source_targets(sizes: DataFrame, weights=WEIGHTS, total_share: float = TOTAL_SHARE, max_repeats: float = MAX_REPEATS) -> DataFrame:
    """sizes: (_source, _source_size). Adds _target, the share of a total of total_share times all words.

    Weights repeat over the sources by code point, null last. A target stops at max_repeats times its source's size and
    what it leaves is shared again by weight, until none is above. Each time, all sources over their stop are found by one aggregate; only
    sums go to the driver, however many sources there are.
    """
    ranked = numbered(sizes, [F.col("_source").isNull(), F.col("_source")], "_rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    weighed = durable(ranked.withColumn("_weight", weight).withColumn("_cap", F.col("_source_size") * F.lit(float(max_repeats))))
    total = (weighed.agg(F.sum("_source_size")).first()[0] or 0) * total_share
    level, stopped = 0.0, -1
    while True:
        free = F.col("_cap") > F.col("_weight") * F.lit(level)
        held, open_, n = weighed.agg(F.sum(F.when(~free, F.col("_cap"))), F.sum(F.when(free, F.col("_weight"))), F.count_if(~free)).first()
        if n == stopped or not open_:
            break
        level, stopped = (total - (held or 0.0)) / open_, n
    return weighed.select("_source", "_source_size", F.least("_cap", F.col("_weight") * F.lit(level) if open_ else F.col("_cap")).alias("_target"))


def permuted(index: Column, size: Column, key: Column) -> Column:
    """A pseudorandom permutation of 0..size-1 that `key` selects: a Feistel network over a rectangle of just over `size`
    cells, entered again while the result lies outside. Fewer than sqrt(size) + 1 cells lie outside, so for up to 256
    rows no walk can be longer than WALKS and beyond that one in 16**WALKS at most is."""
    wide = F.ceil(F.sqrt(size.cast("double"))).cast("long")
    high = F.ceil(size / wide).cast("long")

    def once(x: Column) -> Column:
        left, right = F.expr("0L") + F.floor(x / high).cast("long"), F.pmod(x, high)
        for r in range(ROUNDS):
            if r % 2:
                left = F.pmod(left + F.pmod(F.xxhash64(right, key, F.lit(r)), wide), wide)
            else:
                right = F.pmod(right + F.pmod(F.xxhash64(left, key, F.lit(r)), high), high)
        return left * high + right

    # One step at a time in a lambda: nested, the expression would grow with each walk.
    return F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), F.lit(-1).cast("long"), lambda acc, _: F.when((acc >= 0) & (acc < size), acc).otherwise(once(F.when(acc < 0, index).otherwise(acc))))


def chunk_count(n: int) -> int:
    """Into so many chunks each source is dealt: the root of the number of rows, so that neither a chunk nor a source's list of chunks grows with all of it."""
    return max(1, math.isqrt(n))


def _offsets(docs: DataFrame, chunks: int, seed: int) -> DataFrame:
    """Adds _start, each document's place in the word stream of its source, without bringing a source into one task:
    documents go to pseudorandom chunks, chunk totals are summed up per source, documents within their chunk."""
    chunked = docs.withColumn("_chunk", F.pmod(F.xxhash64("_id", "_text_key", F.lit(seed)), F.lit(chunks)))
    totals = chunked.groupBy("_source", "_chunk").agg(F.sum("_size").alias("_chunk_size"))
    first = totals.select(
        F.col("_source").alias("_s"),
        F.col("_chunk").alias("_c"),
        (F.sum("_chunk_size").over(Window.partitionBy("_source").orderBy("_chunk")) - F.col("_chunk_size")).alias("_chunk_start"),
    )
    inside = Window.partitionBy("_source", "_chunk").orderBy("_id", "_text_key").rowsBetween(Window.unboundedPreceding, 0)
    placed = chunked.withColumn("_before", F.sum("_size").over(inside) - F.col("_size"))
    return placed.join(first, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_chunk") == F.col("_c"))).select(
        *docs.columns, (F.col("_chunk_start") + F.col("_before")).alias("_start")
    )


def heads(throws: Column, *key: Column) -> Column:
    """A draw from the binomial law of this many fair throws, the same for the same key. Up to THROWS, bits are counted. Beyond, the law is inverted from
    its middle outwards: a side by one bit, and how far by adding up the probabilities, exact to double precision, until they exceed a uniform
    number. That takes some root of the number of throws in steps, ten deviations at most."""
    word = lambda k: F.xxhash64(*key, k)
    few = F.least(throws, F.lit(THROWS))
    full, rest = F.floor(few / 64).cast("int"), (few % 64).cast("int")
    last = F.when(rest > 0, F.bit_count(F.call_function("shiftrightunsigned", word(full), 64 - rest))).otherwise(0)
    whole = last + F.aggregate(F.filter(F.sequence(F.lit(0), full), lambda k: k < full), F.lit(0), lambda acc, k: acc + F.bit_count(word(k)))
    uniform = (F.pmod(word(F.lit(-1)), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    odd, middle = throws % 2, F.expr("0L") + F.floor(throws / 2)
    even = (throws + odd).cast("double")
    central = F.sqrt(2 / (F.lit(math.pi) * even)) * F.exp(-1 / (4 * even) + 1 / (24 * even * even * even))  # that of the middle, or of either middle
    steps = F.when(throws > THROWS, F.ceil(5 * F.sqrt(throws.cast("double")))).otherwise(1).cast("int")
    start = F.struct(F.lit(0).cast("long").alias("away"), central.alias("one"), (central * (1 + odd)).alias("sum"))

    def outwards(acc: Column, j: Column) -> Column:
        one = acc["one"] * (middle - j + 1) / (middle + odd + j)
        there = acc["sum"] >= uniform
        return F.when(there, acc).otherwise(F.struct(j.cast("long").alias("away"), one.alias("one"), (acc["sum"] + 2 * one).alias("sum")))

    away = F.aggregate(F.sequence(F.lit(1), steps), start, outwards)["away"]
    upper = F.pmod(word(F.lit(-2)), F.lit(2)) == 1
    return F.when(throws <= THROWS, whole.cast("long")).otherwise(F.when(upper, middle + odd + away).otherwise(middle - away))


def shard_counts(sources: DataFrame, depth: int, seed: int) -> DataFrame:
    """sources: (_source, _takes). A row (_source, _shard, _first_take, _count) for each of 2 ** depth shards that takes from the source.

    A source's takes are dealt to shards by halving: of those in a range of shards, a binomial draw goes to its first half. So, given what all
    shards take of each source, a shard's counts by source are multinomial in the targets. Halves bring their places along: takes are numbered by shard without a sum over shards.
    """
    now = sources.filter("_takes > 0").select("_source", F.lit(0).cast("long").alias("_shard"), F.lit(0).cast("long").alias("_first_take"), F.col("_takes").alias("_count"))
    for level in range(depth):
        left = heads(F.col("_count"), F.xxhash64("_source"), F.col("_shard"), F.lit(level), F.lit(seed))
        split = now.withColumn("_left", left)
        half = lambda k, first, n: F.struct((F.col("_shard") * 2 + k).alias("_shard"), first.alias("_first_take"), n.alias("_count"))
        both = F.array(half(0, F.col("_first_take"), F.col("_left")), half(1, F.col("_first_take") + F.col("_left"), F.col("_count") - F.col("_left")))
        now = split.select("_source", F.explode(both).alias("_h")).select("_source", "_h.*").filter("_count > 0")
        if level % 8 == 7 or level == depth - 1:
            now = now.repartition(partitions(sources.sparkSession), "_source", "_shard")  # what one source's row has grown to is spread
    return now


def mix_plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    total_share: float = TOTAL_SHARE,
    max_repeats: float = MAX_REPEATS,
    block: int = BLOCK_WORDS,
    shard_blocks: int = SHARD_BLOCKS,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with their place, sources with target and blocks, ranges of takes by source and output shard; see slots).

    A document's words stand at _start in its source's stream, which is cut into blocks of `block` words. The mix has
    one slot per block taken, in output shards of about `shard_blocks` slots: how many each source fills of each shard is drawn by shard_counts. Numbered by shard within their source,
    the slots run through a permutation of the source's blocks, a new one for every pass over the source. Words are
    counted once, into a table in the shared folder.
    """
    base = durable(docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_text_key"), F.col(source_col).alias("_source"), word_count(F.col(text_col)).alias("_size")))
    sizes = base.groupBy("_source").agg(F.sum("_size").alias("_source_size"))
    blocks = F.ceil(F.col("_source_size") / block).cast("long")
    takes = F.least(F.round(F.col("_target") / F.col("_source_size") * blocks), F.floor(F.lit(float(max_repeats)) * blocks))
    targets = durable(
        source_targets(sizes, weights, total_share, max_repeats).withColumn("_blocks", blocks).withColumn("_takes", F.when(F.col("_source_size") > 0, takes).otherwise(0).cast("long"))
    )
    n, total = base.count(), targets.agg(F.sum("_takes")).first()[0] or 0
    depth = max(0, math.ceil(math.log2(total / shard_blocks))) if total > shard_blocks else 0
    counts = shard_counts(targets, depth, seed)
    shards = counts.join(targets.select(F.col("_source").alias("_s"), "_blocks", "_takes"), F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
    return _offsets(base, chunk_count(n), seed), targets, shards


def slots(shards: DataFrame, broken_only: bool = False, seed: int = SEED) -> DataFrame:
    """(_source, _shard, _slot, _pass, _block): which block stands in each slot of the mix. A pass over a source takes each of its blocks once, in
    an order of its own, so with broken_only there are rows for the slots of its last, broken pass alone."""
    before = F.floor(F.col("_takes") / F.col("_blocks")).cast("long") * F.col("_blocks") if broken_only else F.lit(0).cast("long")
    rest = shards.withColumn("_skip", F.greatest(before - F.col("_first_take"), F.lit(0).cast("long"))).filter("_skip < _count")
    runs = rest.select("*", F.explode(F.sequence(F.col("_skip"), F.col("_count") - 1, F.lit(SLOT_RUN).cast("long"))).alias("_from"))
    each = runs.select("*", F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + SLOT_RUN, F.col("_count")) - 1)).alias("_slot"))
    return (
        each.withColumn("_take", F.col("_first_take") + F.col("_slot"))
        .withColumn("_pass", F.floor(F.col("_take") / F.col("_blocks")).cast("long"))
        .withColumn("_block", permuted(F.pmod(F.col("_take"), F.col("_blocks")), F.col("_blocks"), F.xxhash64("_source", "_pass", F.lit(seed))))
        .select("_source", "_shard", "_slot", "_pass", "_block")
    )


def _taken(docs: DataFrame, id_col: str, text_col: str, source_col: str, block: int, seed: int = SEED, **how) -> DataFrame:
    """(_id, _text_key, _source, _size, _taken, _source_size, _target) of each row. Whole passes over its source take a document's words once each; the slots of the broken
    pass are joined by block index with the pieces of documents in that block."""
    placed, targets, shards = mix_plan(docs, id_col, text_col, source_col, block=block, seed=seed, **how)
    takes = slots(shards, True, seed).select(F.col("_source").alias("_s"), F.col("_block").alias("_b"), F.lit(1).alias("_times"))
    last = F.expr(f"(_start + _size - 1) div {block}")
    pieces = placed.filter("_size > 0").select("*", F.explode(F.sequence(F.expr(f"_start div {block}"), last)).alias("_block"))
    words = F.least(F.col("_start") + F.col("_size"), (F.col("_block") + 1) * block) - F.greatest(F.col("_start"), F.col("_block") * block)
    taken = (
        pieces.withColumn("_words", words)
        .join(takes, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_block") == F.col("_b")), "left")
        .groupBy("_id", "_text_key", "_source", "_size", "_start")
        .agg(F.sum(F.col("_words") * F.coalesce("_times", F.lit(0))).alias("_broken"))
        .select("_id", "_text_key", "_source", "_size", "_broken")
        .unionByName(placed.filter("_size = 0").select("_id", "_text_key", "_source", "_size", F.lit(0).cast("long").alias("_broken")))
    )
    passes = F.when(F.col("_blocks") > 0, F.floor(F.col("_takes") / F.col("_blocks"))).otherwise(0).cast("long")
    about = targets.select(F.col("_source").alias("_s"), "_source_size", "_target", passes.alias("_passes"))
    both = taken.join(about, F.col("_source").eqNullSafe(F.col("_s")))
    return both.select("_id", "_text_key", "_source", "_size", (F.col("_broken") + F.col("_passes") * F.col("_size")).alias("_taken"), "_source_size", "_target")


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK_WORDS, **how) -> DataFrame:
    """One row per document: (id, size, source_size, target, taken), taken being the words that the mix takes from it.

    Each whole pass of the mix over a source takes all its words once; the slots of the last, broken pass are joined by block index with the pieces of documents that stand in that block.
    Target and source size are those of the document's source. A source's taken words differ from its target by less
    than two blocks, and as no block is taken more than max_repeats times, no document is either.

    A null or blank text has size 0 and is never taken; a text of any length spans as many blocks as it needs. A null source is a source of its own, the last. Rows that repeat
    an id each have their own place. With no words at all, targets are 0. Extra columns are ignored, whatever they are called. An empty table gives no rows.
    """
    return _taken(docs, id_col, text_col, source_col, block, **how).select(
        F.col("_id").alias(id_col),
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        F.col("_taken").alias("taken"),
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK_WORDS, seed: int = SEED, **how) -> DataFrame:
    """The documents of the mix with all their columns: each as often as the mix takes its words, the broken part of that
    number rounded up or down so that a chunk of a source keeps its target to within one document.

    Rounding goes along a chain: within a source's chunk of documents, in an order drawn by hash, a document gets as many copies as keep the copied words
    nearest to the words taken so far. No document is copied more than max_repeats times, rounded up. Documents
    without words stay once. Rows that repeat id and text are taken alike, as often as the first of them. Null sources, empty tables and long texts as for mix_documents.
    """
    taken = _taken(docs, id_col, text_col, source_col, block, seed=seed, **how)
    one = durable(taken.groupBy("_id", "_text_key", "_source", "_size").agg(F.min("_taken").alias("_taken")).withColumn("_draw", F.xxhash64("_id", "_text_key", F.lit(seed + 1))))
    n = one.count()
    chunk = F.pmod(F.col("_draw"), F.lit(chunk_count(n)))
    order = Window.partitionBy("_source", chunk).orderBy("_draw", "_id", "_text_key").rowsBetween(Window.unboundedPreceding, 0)
    # With shares below one another's size, the copies owed are the rise of the rounded running sum of shares.
    share = F.when(F.col("_size") > 0, F.col("_taken") / F.col("_size")).otherwise(0.0)
    begin = F.pmod(F.xxhash64("_source", chunk, F.lit(seed + 2)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    upto = F.sum(share).over(order) + begin
    times = (
        one.withColumn("_upto", upto)
        .withColumn("_times", F.when(F.col("_size") == 0, 1).otherwise(F.floor(F.col("_upto") + 1e-9) - F.floor(F.col("_upto") - share + 1e-9)).cast("int"))
        .filter("_times > 0")
        .select(F.xxhash64("_id").alias("_k"), F.col("_text_key").alias("_t"), F.xxhash64("_source").alias("_s"), "_times")
        .groupBy("_k", "_t", "_s")
        .agg(F.max("_times").alias("_times"))
    )
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.xxhash64(id_col).alias("_k"), F.xxhash64(text_col).alias("_t"), F.xxhash64(source_col).alias("_s"))
    return whole.join(times, ["_k", "_t", "_s"]).select("_doc", F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("_time")).select("_doc.*")
