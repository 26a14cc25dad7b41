"""SimHash near-dedup over a Gray-ordered hierarchical index of fingerprints."""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.components import connected_components
from tallyloom.llm.shared import durable, importable, spread_join

SHINGLE_WORDS, SIMILARITY, SEED = 5, 0.8, 42
#: 64-bit words of the fingerprint of the general operator: 512 bits tell a Jaccard similarity to about 0.03.
WORDS = 8
#: With more differing bits than blocks, so many 16-bit blocks are bands, each with and without its least certain bit turned over; so
#: many standard deviations beyond the mean a pair of the wanted similarity may lie.
BANDS, DEVIATIONS = 20, 2.5
#: Fingerprints under one node; rows that are looked at together; (fingerprint, node) pairs held at once.
FANOUT, BATCH_ROWS, FRONTIER = 8, 40_000, 2_000_000
#: A bucket with more distinct 64-bit fingerprints is dealt out again by its other bits.
HOT_BUCKET = 200_000

_U = np.uint64
_ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x94D049BB133111EB]


def max_differences(similarity: float, words: int, deviations: float = DEVIATIONS) -> int:
    """Bits that may differ between the fingerprints of two sets of shingles of this Jaccard similarity: the mean, and some deviations."""
    n, p = 64 * words, math.acos(min(1.0, 2 * similarity / (1 + similarity))) / math.pi
    return round(n * p + deviations * math.sqrt(n * p * (1 - p)))


def _majority(digests: bytes, words: int) -> tuple[bytes, bytes]:
    """Fingerprint of 64-bit hashes (big-endian, joined): a bit is 1 if it is set in over half of them. And the same with the
    bit of each 16-bit block turned over that was decided by the smallest margin."""
    h = np.frombuffer(digests, ">u8").astype(_U)
    n, total = len(h), np.zeros(64 * words, np.int64)
    with np.errstate(over="ignore"):
        for at in range(0, n, 2040):
            part = h[at : at + 2040]
            planes = np.empty((len(part), words), ">u8")
            planes[:, 0] = part
            for w in range(1, words):
                x = (part ^ (part >> _U(29))) * _U(_ODD[(w - 1) % len(_ODD)] + 2 * (w - 1))
                planes[:, w] = x ^ (x >> _U(32))
            bits = np.unpackbits(planes.view(np.uint8), axis=1)
            for a in range(0, len(bits), 255):  # a sum of 255 bits fits a byte
                total += bits[a : a + 255].sum(0, dtype=np.uint8)
    bits, weakest = 2 * total > n, np.abs(2 * total - n).reshape(-1, 16).argmin(1)
    other = bits.copy()
    other[16 * np.arange(4 * words) + weakest] ^= True
    return np.packbits(bits).tobytes(), np.packbits(other).tobytes()


def shingles(text: bytes | None, shingle: int) -> list[bytes]:
    found = (text or b"").lower().split()  # on bytes: A-Z, and white space U+0009 to U+000D and U+0020
    if len(found) < shingle:
        return [b" ".join(found)] if found else []
    return list(map(b" ".join, zip(*[found[k:] for k in range(shingle)], strict=False)))


def fingerprint(text: bytes | None, shingle: int = SHINGLE_WORDS, words: int = 1, seed: int = SEED) -> tuple[bytes, bytes]:
    """64 * words bits, big-endian, and the same with each block's least certain bit turned over. The first word comes from the XXH64 values
    themselves, others from mixed copies."""
    import xxhash

    found = shingles(text, shingle)
    if not found:
        return bytes(8 * words), bytes(8 * words)
    digest = xxhash.xxh64_digest
    return _majority(b"".join([digest(s, seed) for s in found]), words)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS, words: int = 1, seed: int = SEED) -> DataFrame:
    """(_id, _hash, _fp, _weak): a row for each document, _hash of its text, _fp of 8 * words bytes, _weak with bits turned over."""
    importable(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            found = [fingerprint(t.as_py(), shingle, words, seed) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array([f[k] for f in found], pa.binary()) for k in (0, 1)]], names=["_id", "_hash", "_fp", "_weak"])

    return docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_hash"), F.col(text_col).alias("_text")).mapInArrow(make, f"_id {id_type}, _hash long, _fp binary, _weak binary")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each 64-bit value in the reflected Gray order."""
    out = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> _U(shift)
    return out


class GrayIndex:
    """Fingerprints of several buckets, sorted by bucket and Gray rank, under a tree of nodes of up to FANOUT parts.

    A node holds the bits that all fingerprints below it share and that its parent does not hold yet. A search goes down
    level by level, adds up the differences from those bits and leaves a node as soon as they exceed the limit. A node
    whose fingerprints already are in the searching one's component has no link to add and is left as well, so a dense
    group costs little more than a sparse one.
    """

    def __init__(self, bucket: np.ndarray, turn: np.ndarray, fps: np.ndarray):
        """bucket: numbers; turn: the 16-bit block by which the bucket was made, which leads the Gray order; fps: (n, words)."""
        self.fps, n = fps, len(fps)
        lead = fps[np.arange(n), turn // 4]
        shift = ((turn % 4) * 16).astype(_U)
        lead = np.where(shift == 0, lead, (lead << shift) | (lead >> ((_U(64) - shift) % _U(64))))
        self.order = np.lexsort((gray_rank(lead), bucket))
        self.codes, self.bucket = fps[self.order], bucket[self.order]
        self.label, self.pairs = np.arange(n), []
        self.levels: list[dict] = []
        start = np.arange(n)
        both_and, both_or = self.codes, self.codes
        while True:
            group = self.bucket[start]
            first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            seat = np.arange(len(start)) - np.repeat(first, np.diff(np.r_[first, len(start)]))
            heads = np.flatnonzero(seat % FANOUT == 0)
            both_and, both_or = np.bitwise_and.reduceat(both_and, heads, axis=0), np.bitwise_or.reduceat(both_or, heads, axis=0)
            shared = ~(both_and ^ both_or)
            level = {"start": start[heads], "child": heads, "children": np.diff(np.r_[heads, len(start)]), "shared": shared, "value": both_and & shared}
            level["end"] = np.r_[level["start"][1:], n]
            self.levels.append(level)
            start = level["start"]
            if len(heads) == len(first):
                break
        for child, parent in zip(self.levels, self.levels[1:], strict=False):
            child["shared"] = child["shared"] & ~np.repeat(parent["shared"], parent["children"], axis=0)
            child["value"] &= child["shared"]

    def _join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Puts rows a and b, pairwise, into one component; labels are smallest rows. Of the pairs a spanning forest is kept."""
        label = self.label
        while True:
            apart = label[a] != label[b]
            a, b = a[apart], b[apart]
            if not len(a):
                break
            low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
            hung, one = np.unique(high, return_index=True)
            self.pairs.append((a[one], b[one]))
            label[hung] = low[one]
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label[:] = up

    def _search(self, rows: np.ndarray, roots: np.ndarray, limit: int) -> None:
        codes, label, k = self.codes, self.label, len(self.levels) - 1
        spent = np.zeros(len(rows), np.int64)
        nodes = roots
        while True:
            level = self.levels[k]
            spent = spent + np.bitwise_count((codes[rows] ^ level["value"][nodes]) & level["shared"][nodes]).sum(1, dtype=np.int64)
            low, high = self.low[k][nodes], self.high[k][nodes]
            go = (spent <= limit) & (level["end"][nodes] > rows + 1) & ~((low == high) & (low == label[rows]))
            rows, nodes, spent = rows[go], nodes[go], spent[go]
            if not len(rows):
                return
            many = level["children"][nodes]
            part = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            below = np.repeat(level["child"][nodes], many) + part
            rows, spent = np.repeat(rows, many), np.repeat(spent, many)
            if k == 0:
                ahead = below > rows
                rows, below = rows[ahead], below[ahead]
                near = np.bitwise_count(codes[rows] ^ codes[below]).sum(1, dtype=np.int64) <= limit
                self._join(rows[near], below[near])
                return
            nodes, k = below, k - 1

    def _ranges(self) -> None:
        """Smallest and largest label under each node."""
        low = high = self.label
        self.low, self.high = [], []
        for level in self.levels:
            low, high = np.minimum.reduceat(low, level["child"]), np.maximum.reduceat(high, level["child"])
            self.low.append(low)
            self.high.append(high)

    def links(self, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows a and b (as given) of pairs with up to `limit` differing bits that span the components of all such pairs. Nearer pairs
        come first, limit by limit, where limits are wide."""
        for now in sorted({limit, limit // 2, 3 * limit // 4}) if limit > 16 else (limit,):
            self._pass(now)
        a, b = (np.concatenate([p[k] for p in self.pairs]) if self.pairs else np.zeros(0, np.int64) for k in (0, 1))
        return self.order[a], self.order[b]

    def _pass(self, limit: int) -> None:
        top = self.levels[-1]
        root = np.repeat(np.arange(len(top["start"])), top["end"] - top["start"])
        cost = np.cumsum((top["end"] - top["start"])[root])
        cuts = np.searchsorted(cost, np.arange(FRONTIER, cost[-1] + FRONTIER, FRONTIER))
        at = 0
        for cut in cuts.tolist():
            rows = np.arange(at, max(min(cut, len(root)), at + 1)) if at < len(root) else np.arange(0)
            if not len(rows):
                break
            self._ranges()
            whole = (self.low[-1] == self.high[-1])[root[rows]]
            at = int(rows[-1]) + 1
            rows = rows[~whole]
            if len(rows):
                self._search(rows, root[rows], limit)


def _neighbours(words: int, limit: int):
    """mapInArrow function over (_b, _key, _fp) sorted by _b and _key: rows (a, b) that link fingerprints."""

    def link(b: np.ndarray, bucket: np.ndarray, fps: list[bytes]) -> pa.RecordBatch:
        x = np.frombuffer(b"".join(fps), ">u8").reshape(-1, words).astype(_U)
        left, right = GrayIndex(bucket, b, x).links(limit)
        return pa.RecordBatch.from_arrays([pa.array([fps[k] for k in side.tolist()], pa.binary()) for side in (left, right)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, last = [], 0, None
        for batch in batches:
            b, key = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            new = np.flatnonzero(np.r_[last is not None and last != (b[0], key[0]), (b[1:] != b[:-1]) | (key[1:] != key[:-1])])
            if len(new) and rows + new[-1] >= BATCH_ROWS:  # the last bucket may go on in the next batch
                yield from whole(pa.Table.from_batches([*held, batch.slice(0, int(new[-1]))]))
                held, rows, batch = [], 0, batch.slice(int(new[-1]))
            held.append(batch)
            rows, last = rows + batch.num_rows, (b[-1], key[-1])
        if held:
            yield from whole(pa.Table.from_batches(held))

    def whole(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if table.num_rows < 2:
            return
        b, key = table.column(0).to_numpy().astype(np.int64), table.column(1).to_numpy(zero_copy_only=False)
        new = np.r_[False, (b[1:] != b[:-1]) | (key[1:] != key[:-1])]
        bucket = np.cumsum(new)
        alone = np.r_[new[1:], True] & np.r_[True, new[1:]]
        some = ~alone
        if some.any():
            fps = table.column(2).filter(pa.array(some)).to_pylist()
            yield link(b[some], bucket[some], fps)

    return run


def similar_fingerprints(codes: DataFrame, words: int, limit: int, hot: int = HOT_BUCKET, bands: int = BANDS) -> DataFrame:
    """codes: (_fp, _weak), _fp distinct. Rows (a, b) of linked fingerprints that span the components of all links found.

    Every fingerprint goes to one bucket for each of its 4 * words blocks of 16 bits: the blocks are the top nodes of as many indexes,
    each in the Gray order of the bits as they follow the block. Two fingerprints with fewer differing bits than there are
    blocks agree in one of them, so with limit < 4 * words no link is lost. With a larger limit, the first `bands` blocks act as bands, and a
    fingerprint goes to the bucket of its block with its least certain bit turned over as well: bits that differ between near copies mostly are such bits.
    A bucket of 64-bit fingerprints beyond `hot` is dealt out again by the 12-bit quarters of its other 48 bits, of which a linked pair
    with up to three differences shares one.
    """
    importable(codes.sparkSession)
    blocks = 4 * words
    near_all = limit < blocks
    keys = lambda c: F.expr(f"hex(substring({c}, 2 * _b + 1, 2))")
    dealt = codes.select("_fp", "_weak", F.explode(F.sequence(F.lit(0), F.lit((blocks if near_all else min(bands, blocks)) - 1))).alias("_b"))
    dealt = dealt.select("_fp", "_b", keys("_fp").alias("_key") if near_all else F.explode(F.array_distinct(F.array(keys("_fp"), keys("_weak")))).alias("_key"))
    if words == 1 and limit <= 3:
        large = dealt.groupBy("_b", "_key").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot).select("_b", "_key", F.lit(True).alias("_hot"))
        rest = F.expr("concat(left(hex(_fp), 4 * _b), substring(hex(_fp), 4 * _b + 5))")
        parts = F.when(F.col("_hot"), F.transform(F.sequence(F.lit(0), F.lit(3)), lambda s: F.concat_ws(".", F.col("_key"), s.cast("string"), F.substring(rest, 3 * s + 1, F.lit(3)))))
        dealt = dealt.join(large, ["_b", "_key"], "left").select("_fp", "_b", F.explode(F.coalesce(parts, F.array("_key"))).alias("_key"))
    near = dealt.select("_b", "_key", "_fp").repartition("_b", "_key").sortWithinPartitions("_b", "_key")
    return near.mapInArrow(_neighbours(words, limit), "a binary, b binary")


def _similar_texts(links: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str, shingle: int, similarity: float, seed: int) -> DataFrame:
    """Those links (durable) whose texts' sets of shingles have at least this Jaccard similarity. Only linked texts are looked at, each once."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            found = [np.unique(np.array([xxhash.xxh64_intdigest(s, seed) for s in shingles(t.as_py(), shingle)], _U)).tobytes() for t in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["_fp", "_set"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("_sa"), batch.column("_sb"), strict=True):
                one, other = np.frombuffer(x.as_py(), _U), np.frombuffer(y.as_py(), _U)
                both = len(np.intersect1d(one, other, assume_unique=True))
                good.append(both >= similarity * (len(one) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    linked = links.select(F.col("a").alias("_fp")).union(links.select("b")).distinct()
    wanted = nodes.join(linked, "_fp").select("_fp", F.xxhash64("_node.id").alias("_k"), F.col("_node.hash").alias("_h"))
    texts = docs.select(F.xxhash64(id_col).alias("_k"), F.xxhash64(text_col).alias("_h"), F.col(text_col).alias("_text"))
    known = durable(texts.join(wanted, ["_k", "_h"]).select("_fp", "_text").mapInArrow(sets, "_fp binary, _set binary").groupBy("_fp").agg(F.min("_set").alias("_set")))
    side = lambda end: known.select(F.col("_fp").alias(end), F.col("_set").alias(f"_s{end}"))
    both = spread_join(spread_join(links, side("a"), ["a"]), side("b"), ["b"], counted=links)
    return durable(both.mapInArrow(compare, "a binary, b binary"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE_WORDS,
    words: int = WORDS,
    max_diff: int | None = None,
    similarity: float = SIMILARITY,
    seed: int = SEED,
    hot: int = HOT_BUCKET,
) -> DataFrame:
    """One row per document: (id, fingerprint, component_id), component_id being the smallest id that links reach.

    With `max_diff`, documents link if their fingerprints differ in at most so many bits. Without, documents are candidates if their
    fingerprints differ in as many bits as two sets of shingles of Jaccard similarity `similarity` may (see max_differences), and candidates that
    span a component are linked if their whole texts' sets of shingles are that similar. Equal fingerprints are one node, so exact copies cost nothing more, and from
    each bucket only a spanning forest of its links goes on, the nearest pairs first.

    A null, empty or blank text has fingerprint zero, linked like any other. A text of fewer words than a shingle is one
    shingle; one of any length is looked at whole. Rows that repeat an id have a row each. A null id is never a component_id while its
    component has another. Extra columns are ignored, whatever they are called. An empty table gives no rows.
    """
    made, roots = _rooted(docs, id_col, text_col, shingle, words, max_diff, similarity, seed, hot)
    placed = spread_join(made.select("_id", "_hash", "_fp"), roots, ["_fp"])
    return placed.select(F.col("_id").alias(id_col), F.lower(F.hex("_fp")).alias("fingerprint"), F.col("_root.id").alias("component_id"))


def _rooted(docs: DataFrame, id_col: str, text_col: str, shingle: int, words: int, max_diff: int | None, similarity: float, seed: int, hot: int) -> tuple[DataFrame, DataFrame]:
    """The documents' fingerprints, and (_fp, _root) of each: the smallest node that it reaches. A node is the first document of a fingerprint by
    id, null last, and hash, so a component's smallest node is its first document and no component has to be gathered to find it."""
    made = durable(fingerprints(docs, id_col, text_col, shingle, words, seed))
    first = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_hash").alias("hash"), F.col("_fp").alias("fp"))
    nodes = durable(made.groupBy("_fp").agg(F.min(first).alias("_node"), F.min("_weak").alias("_weak")))
    limit = max_differences(similarity, words) if max_diff is None else max_diff
    links = durable(similar_fingerprints(nodes.select("_fp", "_weak"), words, limit, hot).distinct())
    if max_diff is None:
        links = _similar_texts(links, nodes, docs, id_col, text_col, shingle, similarity, seed)
    end = lambda name: nodes.select(F.col("_fp").alias(name), F.col("_node").alias(f"_n{name}"))
    edges = spread_join(spread_join(links, end("a"), ["a"]), end("b"), ["b"], counted=links).select(F.col("_na").alias("a"), F.col("_nb").alias("b"))
    found = connected_components(edges).select(F.col("node.fp").alias("_fp"), F.col("root").alias("_root"))
    return made, nodes.join(found, "_fp", "left").select("_fp", F.coalesce("_root", "_node").alias("_root"))


def survivors(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE_WORDS,
    words: int = WORDS,
    max_diff: int | None = None,
    similarity: float = SIMILARITY,
    seed: int = SEED,
    hot: int = HOT_BUCKET,
) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest id, a null id only if there is no
    other, and of rows that repeat that id the one whose text has the smallest hash. As near_duplicates for all else."""
    _, roots = _rooted(docs, id_col, text_col, shingle, words, max_diff, similarity, seed, hot)
    kept = roots.select(F.xxhash64("_root.id").alias("_kept_id"), F.col("_root.hash").alias("_kept_hash")).distinct()
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.xxhash64(id_col).alias("_kept_id"), F.xxhash64(text_col).alias("_kept_hash"))
    return whole.join(kept, ["_kept_id", "_kept_hash"]).dropDuplicates(["_kept_id", "_kept_hash"]).select("_doc.*")
