"""Nearest neighbours by low-dimensional stable projections in kd-trees, verified until a chi-square test stops the search."""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.shared import durable, importable

NEIGHBOURS, PROJECTED, LEAF, CONFIDENCE, SEED = 10, 32, 64, 0.95, 17
#: Vectors under one tree, queries that one task answers from it, cells of the upper levels, sampled vectors that place each cell.
BLOCK, QUERY_CHUNK, MAX_CELLS, CELL_SAMPLE = 16_384, 8_192, 1024, 64
#: Leaves that are opened, and vectors that are verified, between two tests.
LEAVES, STEP, SALTS = 8, 16, 16


def chi_square(x: float, degrees: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    half = x / 2
    term = total = 1.0
    for k in range(1, degrees // 2):
        term *= half / k
        total += term
    return 1.0 - math.exp(-half) * total if half < 700 else 1.0


def stopping_ratio(degrees: int, confidence: float) -> float:
    """How many times a vector's distance its projected distance is with this probability at most."""
    low, high = 0.0, 100.0 * degrees
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (low, middle) if chi_square(middle, degrees) >= confidence else (middle, high)
    return math.sqrt(high)


def directions(length: int, projected: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([seed, length])).standard_normal((length, projected))


class Cells:
    """Upper levels of the kd-tree: a complete tree of median splits along the widest side of a sample."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        self.axis, self.at = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
        parts = [sample]
        for node in range(2**depth - 1):
            own = parts[node]
            if len(own):
                self.axis[node] = (own.max(0) - own.min(0)).argmax()
                self.at[node] = np.median(own[:, self.axis[node]])
            right = own[:, self.axis[node]] > self.at[node]
            parts += [own[~right], own[right]]

    def of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[np.arange(len(points)), self.axis[node]] > self.at[node])
        return node - (2**self.depth - 1)


def outside(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Distance of q from each box."""
    apart = np.maximum(np.maximum(low - q, q - high), 0.0)
    return np.sqrt((apart * apart).sum(-1))


class KdTree:
    """Lower levels: median splits along the widest side until a leaf has at most LEAF points; the leaves' boxes."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points, self.order, self.leaves = points, np.arange(len(points)), []
        todo = [(0, len(points))]
        while todo:
            a, b = todo.pop()
            own = points[self.order[a:b]]
            side = own.max(0) - own.min(0)
            if b - a > leaf and (side > 0).any():
                middle = (b - a) // 2
                self.order[a:b] = self.order[a:b][np.argpartition(own[:, int(side.argmax())], middle)]
                todo += [(a, a + middle), (a + middle, b)]
            else:
                self.leaves.append((a, b))
        self.low, self.high = (np.array([f(points[self.order[a:b]], 0) for a, b in self.leaves]) for f in (np.min, np.max))


def search(tree: KdTree, vectors: np.ndarray, ids: np.ndarray, q: np.ndarray, p: np.ndarray, k: int, bound: float, ratio: float) -> tuple[np.ndarray, np.ndarray, int]:
    """(distances, ids, verified) of up to k nearest, q's own row among them.

    Leaves open in the order of their boxes, as a descent that always takes the nearest node would open them; the points that have come out are
    verified in the order of their projected distance, once no closed leaf can hold one that is nearer. The search stops when a vector as near as
    the k-th best (or as bound, the k-th best elsewhere) would have been projected nearer than the next point is, with the wanted
    confidence: the squared ratio of the two distances is chi-square distributed.
    """
    far = outside(p, tree.low, tree.high)
    turn = np.argsort(far, kind="stable")
    far = np.append(far[turn], np.inf)
    ahead, rows = np.zeros(0), np.zeros(0, np.int64)
    best, best_id = np.zeros(0), np.zeros(0, np.int64)
    opened = verified = 0
    slack = 1e-9 * (1.0 + float(np.abs(p).max(initial=0.0)))  # of two equal vectors' projections
    while True:
        worst = min(bound, best[k - 1] if len(best) == k else math.inf)
        ready = int(np.searchsorted(ahead, far[opened], "right"))
        next_ = ahead[0] if ready else min(far[opened], ahead[0] if len(ahead) else math.inf)
        if next_ == math.inf or next_ > ratio * worst + slack:
            return best, best_id, verified
        if not ready:
            some = np.concatenate([tree.order[slice(*tree.leaves[x])] for x in turn[opened : opened + LEAVES]])
            opened = min(opened + LEAVES, len(turn))
            apart = tree.points[some] - p
            ahead, rows = np.append(ahead, np.sqrt((apart * apart).sum(1))), np.append(rows, some)
            by = np.argsort(ahead, kind="stable")
            ahead, rows = ahead[by], rows[by]
            continue
        now = min(ready, STEP)
        apart = vectors[rows[:now]] - q
        best, best_id = np.append(best, np.sqrt((apart * apart).sum(1))), np.append(best_id, ids[rows[:now]])
        by = np.lexsort((best_id, best))[:k]
        best, best_id, verified = best[by], best_id[by], verified + now
        ahead, rows = ahead[now:], rows[now:]


def usable(vector: Column) -> Column:
    """Neither null, empty nor zero, and without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(t: pa.Table | pa.RecordBatch, name: str) -> np.ndarray:
    column = t.column(name)
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)


def _placed(rows: DataFrame, cells: Cells | None, projected: int, seed: int) -> DataFrame:
    """Adds _p, the projection, and _cell."""
    schema = f"{rows._jdf.schema().toDDL()}, _p array<double>, _cell int"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("_v")
            lengths = np.diff(vectors.offsets.to_numpy())
            low = np.zeros((len(lengths), projected))
            for length in np.unique(lengths).tolist():
                mine = np.flatnonzero(lengths == length)
                with np.errstate(over="ignore", invalid="ignore"):
                    low[mine] = _matrix(batch.take(pa.array(mine)), "_v") @ directions(length, projected, seed)
            low = np.nan_to_num(low)
            cell = cells.of(low) if cells else np.zeros(len(low), np.int64)
            listed = pa.ListArray.from_arrays(pa.array(np.arange(0, low.size + 1, projected, dtype=np.int32)), pa.array(low.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, listed, pa.array(cell.astype(np.int32))], names=[*batch.schema.names, "_p", "_cell"])

    return rows.mapInArrow(place, schema)


def _answers(index: DataFrame, asked: DataFrame, sizes: dict, k: int, ratio: float, block: int, query_chunk: int) -> DataFrame:
    """index: (_id, _v, _d, _cell, _p); asked: (_qa, _qb, _v, _d, _cell, _p, _bound), durable. (_qa, _qb, _id, _score, _seen): each
    query's nearest from each part of the cell that it asks, and rows without id that tell how many vectors were verified there."""
    spark = index.sparkSession
    visits = {(r["_d"], r["_cell"]): r["n"] for r in asked.groupBy("_d", "_cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each cell and length
    how = [(d, c, -(-sizes[d, c] // block), -(-n // query_chunk)) for (d, c), n in visits.items() if (d, c) in sizes]
    plan = F.broadcast(spark.createDataFrame(how, "_d int, _cell int, _parts int, _chunks int"))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    base = index.join(plan, ["_d", "_cell"]).select("_d", "_cell", "_id", "_v", "_p", F.pmod(F.xxhash64("_v"), F.col("_parts")).cast("int").alias("_part"), every("_chunks").alias("_chunk"))
    queries = asked.join(plan, ["_d", "_cell"]).select("_d", "_cell", "_qa", "_qb", "_v", "_p", "_bound", F.pmod("_qa", F.col("_chunks")).cast("int").alias("_chunk"), every("_parts").alias("_part"))

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            vectors, low, ids = _matrix(left, "_v"), _matrix(left, "_p"), left.column("_id").to_numpy()
            tree = KdTree(low)
            with np.errstate(over="ignore", invalid="ignore"):
                for a, b, q, p, bound in zip(right.column("_qa").to_pylist(), right.column("_qb").to_pylist(), _matrix(right, "_v"), _matrix(right, "_p"), right.column("_bound").to_pylist(), strict=True):
                    score, found, seen = search(tree, vectors, ids, q, p, k, bound, ratio)
                    out.append((a, b, None, None, seen))
                    out += [(a, b, i, d, 0) for i, d in zip(found.tolist(), score.tolist(), strict=True)]
        columns = zip(*out, strict=True) if out else [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["_qa", "_qb", "_id", "_score", "_seen"])

    keys = ["_d", "_cell", "_part", "_chunk"]
    return base.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(answer, "_qa long, _qb long, _id long, _score double, _seen long")


def nearest_neighbours(
    table: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = NEIGHBOURS,
    projected: int = PROJECTED,
    confidence: float = CONFIDENCE,
    block: int = BLOCK,
    query_chunk: int = QUERY_CHUNK,
    max_cells: int = MAX_CELLS,
    seed: int = SEED,
) -> DataFrame:
    """(query_id, rank, vec_id, score, n_verified): for each row that is a query its k nearest other rows by Euclidean distance.

    All vectors are projected on `projected` normal (2-stable) directions and dealt to the cells of a kd-tree's upper levels, which a sample
    of CELL_SAMPLE vectors a cell places (at most max_cells cells, so at most 65,536 sampled vectors; every vector is indexed). A cell's vectors form parts of about `block`, by a
    hash, each with the lower levels as a tree of its own. A query first searches its own cell. What it finds bounds its distances, and in a second
    round it goes to just those other cells whose boxes the chi-square test does not rule out. Within a tree, vectors are verified on the
    originals in the order of their projected distance until the test holds, so a nearest neighbour is missed with a probability of at
    most 1 - confidence. n_verified is how many vectors were looked at for the query.

    Ties go to the smaller id. Every row but the query's own is a candidate, also one that repeats id or vector or both. Of equal vectors only
    those with the k + 1 smallest ids can be among the nearest, so the others are left out before the shuffle, and equal queries are searched once. Null
    ids are no queries and no candidates. Vectors that are null, empty, zero or hold null or non-finite components take no part; vectors of another
    length than the query's are no candidates. With fewer than k candidates all are returned, and an empty table gives no rows. Extra
    columns are ignored, whatever they are called.
    """
    importable(table.sparkSession)
    if projected % 2:
        raise ValueError("projected: an even number")
    ratio = stopping_ratio(projected, confidence)
    plain = F.transform(F.col(vector_col).cast("array<double>"), lambda x: x + F.lit(0.0))  # no negative zero
    rows = table.select(F.col(id_col).cast("long").alias("_id"), plain.alias("_v"), F.coalesce(is_query, F.lit(False)).alias("_is_query"))
    good = durable(rows.filter(F.col("_id").isNotNull() & usable(F.col("_v"))))
    n = good.count()
    depth = max(0, min(int(math.log2(max_cells)), math.ceil(math.log2(max(n, 1) / block)) if n > block else 0))
    cells = None
    if depth:
        share = min(1.0, CELL_SAMPLE * 2**depth / n)
        drawn = good.filter(F.pmod(F.xxhash64("_id", "_v", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30)) < share)
        sample = _placed(drawn.select("_v"), None, projected, seed).select("_p").toArrow()
        cells = Cells(_matrix(sample, "_p"), depth)
    same = Window.partitionBy("_v").orderBy("_id")
    few = good.select("_id", "_v").withColumn("_r", F.row_number().over(same)).filter(F.col("_r") <= k + 1).drop("_r")
    index = durable(_placed(few, cells, projected, seed).withColumn("_d", F.size("_v")))
    box = [f(F.get("_p", F.lit(j))).alias(f"{name}{j}") for name, f in (("_low", F.min), ("_high", F.max)) for j in range(projected)]
    held = index.groupBy("_d", "_cell").agg(F.count(F.lit(1)).alias("_n"), *box).collect()  # a row for each cell and length
    sizes = {(r["_d"], r["_cell"]): r["_n"] for r in held}
    boxes: dict[int, list] = {}
    for d in sorted({r["_d"] for r in held}):
        own = [r for r in held if r["_d"] == d]
        boxes[d] = [np.array([r["_cell"] for r in own]), *[np.array([[r[f"{x}{j}"] for j in range(projected)] for r in own]) for x in ("_low", "_high")]]
    who = [F.xxhash64("_v").alias("_qa"), F.xxhash64("_v", F.lit(seed)).alias("_qb")]
    vectors = good.filter("_is_query").select("_v").distinct()
    asked = durable(_placed(vectors, cells, projected, seed).select(*who, "_v", F.size("_v").alias("_d"), "_cell", "_p", F.lit(float("inf")).alias("_bound")))
    found = near = durable(_answers(index, asked, sizes, k + 1, ratio, block, query_chunk))
    if depth:
        best = Window.partitionBy("_qa", "_qb").orderBy("_score", "_id")
        first = near.filter("_id is not null").withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= k + 1)
        bound = first.groupBy("_qa", "_qb").agg(F.when(F.count(F.lit(1)) > k, F.max("_score")).otherwise(float("inf")).alias("_bound"))
        shared = table.sparkSession.sparkContext.broadcast(boxes)  # max_cells boxes a length

        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at, to = [], []
                for k, (d, own, p, worst) in enumerate(zip(*[batch.column(x).to_pylist() for x in ("_d", "_cell", "_p", "_bound")], strict=True)):
                    names, low, high = shared.value[d]
                    reach = names[(outside(np.array(p), low, high) <= ratio * worst) & (names != own)]
                    at += [k] * len(reach)
                    to += reach.tolist()
                out = batch.take(pa.array(at, pa.int64()))
                yield out.set_column(out.schema.get_field_index("_cell"), "_cell", pa.array(to, pa.int32()))

        further = asked.drop("_bound").join(bound, ["_qa", "_qb"])
        further = durable(further.mapInArrow(visit, further.schema))
        found = durable(near.unionByName(_answers(index, further, sizes, k + 1, ratio, block, query_chunk)))
    best = Window.partitionBy("_qa", "_qb").orderBy("_score", "_id")
    top = found.filter("_id is not null").withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= k + 1)
    listed = top.groupBy("_qa", "_qb").agg(F.array_sort(F.collect_list(F.struct("_score", "_id"))).alias("_top"))  # k + 1 at most
    seen = found.filter("_id is null").groupBy("_qa", "_qb").agg(F.sum("_seen").alias("n_verified"))
    copied = listed.join(seen, ["_qa", "_qb"]).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    each = good.filter("_is_query").select("_id", *who, F.pmod(F.xxhash64("_id", F.lit(seed)), F.lit(SALTS)).cast("int").alias("_salt")).withColumnRenamed("_id", "query_id")
    place = F.array_position("_top", F.struct(F.lit(0.0).alias("_score"), F.col("query_id").alias("_id"))).cast("int")
    others = F.when(place > 0, F.concat(F.slice("_top", 1, place - 1), F.slice("_top", place + 1, k + 1))).otherwise(F.col("_top"))
    answered = each.join(copied, ["_qa", "_qb", "_salt"]).select("query_id", "n_verified", F.posexplode(F.slice(others, 1, k)).alias("_pos", "_hit"))
    return answered.select("query_id", (F.col("_pos") + 1).alias("rank"), F.col("_hit._id").alias("vec_id"), F.col("_hit._score").alias("score"), "n_verified")
