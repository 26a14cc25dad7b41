"""Scoring documents by the cross-entropy difference of a target and a background class-based bigram model."""

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import durable, importable

#: Words that are classes of their own, classes of all other words by their last two bytes, words whose counts are sent to all tasks.
FREQUENT, ENDINGS, LISTED = 767, 256, 16_384
#: Weight of the unigram model in a bigram's probability, in words; what every class, and every word of one, is seen before any text.
PRIOR, FLOOR = 50.0, 0.5
#: Bytes of text that are counted or scored together; words that a task remembers from one such chunk to the next.
CHUNK_BYTES, KNOWN_WORDS = 8 << 20, 200_000
#: Up to so many target ids go to all tasks (some 64 MB); beyond, documents meet them by id.
FEW_IDS = 500_000


def words(text: bytes | None) -> list[bytes]:
    """A-Z lower-cased, split at white space (U+0009 to U+000D and U+0020)."""
    return (text or b"").lower().split()


class Words(dict):
    """Numbers words as they come; knows each one's 64-bit hash and the class of its ending."""

    def __init__(self, endings: int):
        super().__init__()
        self.endings, self._hash, self._class = endings, [], []

    def __missing__(self, word: bytes) -> int:
        import xxhash

        self[word] = k = len(self._hash)
        self._hash.append(xxhash.xxh3_64_intdigest(word))
        self._class.append(1 + crc32(word[-2:]) % self.endings)
        return k

    def of(self, text: bytes | None) -> np.ndarray:
        found = words(text)
        return np.fromiter(map(self.__getitem__, found), np.int64, len(found))

    def known(self) -> tuple[np.ndarray, np.ndarray]:
        return np.array(self._hash, np.uint64).view(np.int64), np.array(self._class, np.int64)

    def fresh(self) -> "Words":
        return self if len(self) < KNOWN_WORDS else Words(self.endings)


@dataclass
class Models:
    """target, background: losses in bits by class before and class. listed: hashes of frequent words in order, their first `frequent` being classes;
    counts: theirs, in the target and in all. inside: by class, words and distinct words in it, target and all. words: (_w, _t, _n), of every word."""

    listed: np.ndarray
    counts: np.ndarray
    frequent: int
    endings: int
    target: np.ndarray
    background: np.ndarray
    inside: np.ndarray
    words: DataFrame
    scale: float
    floor: float


def classes_of(hashes: np.ndarray, endings_of: np.ndarray, frequent: np.ndarray, endings: int) -> np.ndarray:
    """frequent: hashes, the k-th word being class 1 + endings + k; other words are of the class of their ending."""
    by = np.argsort(frequent)
    at = np.searchsorted(frequent, hashes, sorter=by).clip(max=max(len(by) - 1, 0))
    own = by[at] if len(by) else np.zeros(len(hashes), np.int64)
    return np.where(frequent[own] == hashes, 1 + endings + own, endings_of) if len(by) else endings_of


def _chunks(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[list, list]]:
    """(batches, texts) of about CHUNK_BYTES."""
    held, texts, size = [], [], 0
    for batch in batches:
        first = 0
        for k, t in enumerate(batch.column(text).cast(pa.binary())):
            texts.append(t.as_py())
            size += len(texts[-1] or b"")
            if size >= CHUNK_BYTES:
                held.append(batch.slice(first, k + 1 - first))
                yield held, texts
                held, texts, size, first = [], [], 0, k + 1
        if first < batch.num_rows:
            held.append(batch.slice(first))
    if texts:
        yield held, texts


def _losses(counts: np.ndarray, scale: float, prior: float, floor: float) -> np.ndarray:
    """-log2 of bigram probabilities that fall back on unigrams; counts are scaled first."""
    counts = counts * scale
    once = counts.sum(0) + floor
    once /= once.sum()
    return -np.log2((counts + prior * once) / (counts.sum(1, keepdims=True) + prior))


def fit(
    docs: DataFrame,
    target_ids: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    frequent: int = FREQUENT,
    endings: int = ENDINGS,
    listed: int = LISTED,
    prior: float = PRIOR,
    floor: float = FLOOR,
) -> Models:
    """The two models. target_ids: one column, ids of the documents that the target model learns from; null ids are passed over.

    The background model learns from all documents, the target model from its own; both have the vocabulary of all, which is every word of the corpus. They
    are matched: the background counts are scaled to the target's number of words before smoothing. A word's probability is that of its class after the
    class before, times its own within the class. The `frequent` most frequent words (ties by hash) are classes, the others share `endings` classes by their last two bytes, so
    the table of class pairs is bounded, while the counts within classes are of every word, by a 64-bit hash, and stay a Spark table. Only the
    counts of the `listed` most frequent words go to the driver.

    Null and blank texts teach nothing. Rows that repeat an id count each. An empty table gives models in which all words are unheard of.
    Texts of any length are counted whole.
    """
    importable(docs.sparkSession)
    chosen = durable(target_ids.select(F.col(target_ids.columns[0]).alias("_chosen")).filter(F.col("_chosen").isNotNull()).distinct())
    few = F.broadcast(chosen) if chosen.count() <= FEW_IDS else chosen
    marked = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(few, F.col("_id") == F.col("_chosen"), "left").select("_text", F.col("_chosen").isNotNull().alias("_mark"))

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words(endings)
        for held, texts in _chunks(batches, 0):
            marks = np.concatenate([b.column(1).to_numpy(zero_copy_only=False) for b in held])
            found = [known.of(t) for t in texts]
            every = np.concatenate(found)
            mine = np.concatenate([x for x, m in zip(found, marks, strict=True) if m] or [every[:0]])
            n, t = np.bincount(every, minlength=len(known)), np.bincount(mine, minlength=len(known))
            some = np.flatnonzero(n)
            hashes, ending = known.known()
            yield pa.RecordBatch.from_arrays([pa.array(hashes[some]), pa.array(ending[some].astype(np.int32)), pa.array(t[some]), pa.array(n[some])], names=["_w", "_e", "_t", "_n"])
            known = known.fresh()

    sums = marked.mapInArrow(count_words, "_w long, _e int, _t long, _n long").groupBy("_w").agg(F.min("_e").alias("_e"), F.sum("_t").alias("_t"), F.sum("_n").alias("_n"))
    counted = durable(sums)
    # How often the words to be listed occur at least, as a power of two, is told by one sum, so that few others meet in the last sort.
    powers = sorted(counted.groupBy(F.floor(F.log2("_n")).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True)
    least = next((r["p"] for k, r in enumerate(powers) if sum(x["n"] for x in powers[: k + 1]) >= listed), 0)
    top = counted.filter(F.col("_n") >= 2**least).orderBy(F.desc("_n"), "_w").limit(listed).toArrow()
    hashes = top.column("_w").to_numpy()
    own = hashes[:frequent]
    size = 1 + endings + len(own)
    ranked = np.stack([top.column(c).to_numpy() for c in ("_t", "_n")]).astype(np.float64)
    inside = np.zeros((4, size))
    for r in counted.groupBy("_e").agg(F.sum("_t").alias("t"), F.sum("_n").alias("n"), F.count_if(F.col("_t") > 0).alias("dt"), F.count(F.lit(1)).alias("dn")).collect():  # a row a class
        inside[:, r["_e"]] = r["t"], r["n"], r["dt"], r["dn"]
    ending = top.column("_e").to_numpy()[:frequent]
    for k, value in enumerate((ranked[0, :frequent], ranked[1, :frequent], ranked[0, :frequent] > 0, np.ones(len(own)))):
        np.subtract.at(inside[k], ending, value)

    def count_classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = Words(endings), np.zeros((2, size * size), np.int64)
        for held, texts in _chunks(batches, 0):
            marks = np.concatenate([b.column(1).to_numpy(zero_copy_only=False) for b in held])
            found = [known.of(t) for t in texts]
            code = classes_of(*known.known(), own, endings)
            for mark in (False, True):
                grams = [np.r_[0, c[:-1]] * size + c for x, m in zip(found, marks, strict=True) if m == mark and len(x) for c in (code[x],)]
                if grams:
                    cells, times = np.unique(np.concatenate(grams), return_counts=True)
                    seen[int(mark)][cells] += times
            known = known.fresh()
        cells = np.flatnonzero(seen.any(0))
        for at in range(0, len(cells), 100_000):
            part = cells[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(seen[1][part]), pa.array(seen[0][part] + seen[1][part])], names=["_cell", "_t", "_n"])

    got = marked.mapInArrow(count_classes, "_cell int, _t long, _n long").groupBy("_cell").agg(F.sum("_t").alias("_t"), F.sum("_n").alias("_n")).toArrow()  # the square of the classes at most
    target, background = np.zeros((2, size * size))
    target[got.column("_cell").to_numpy()], background[got.column("_cell").to_numpy()] = got.column("_t").to_numpy(), got.column("_n").to_numpy()
    scale = target.sum() / background.sum() if background.sum() else 1.0
    tables = [_losses(x.reshape(size, size), s, prior, floor).astype(np.float32) for x, s in ((target, 1.0), (background, scale))]
    return Models(hashes, ranked, len(own), endings, *tables, inside, counted.select("_w", "_t", "_n"), scale, floor)


def _inside(m: Models, kind: int, counts: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Loss of words within their classes (not those that are classes), kind 0 for the target and 1 for the background. One entry of each
    class stands for words that nothing has told of."""
    scale = m.scale if kind else 1.0
    return -np.log2((counts * scale + m.floor) / (m.inside[kind][codes] * scale + m.floor * (m.inside[3][codes] + 1)))


def score(docs: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (id, n_tokens, loss_target, loss_background, score).

    Losses are bits per word over the whole text; score is background less target, the mean over the words of their loss differences: the higher, the
    more the document is like the target.

    Documents are looked at in chunks of some CHUNK_BYTES of text (a longer text is one alone). A chunk holds its documents' losses as far as the broadcast part of
    the models tells them, and asks for each further word once: these requests meet the table of words by hash, and the answers meet their chunk again.

    A null or blank text has no words and 0 throughout. Rows that repeat an id are scored one by one. Extra columns are ignored, whatever they are
    called. An empty table gives no rows.
    """
    importable(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    table, size = models.words, len(models.target)
    shared = docs.sparkSession.sparkContext.broadcast([getattr(models, x) for x in ("listed", "counts", "frequent", "endings", "target", "background", "inside", "scale", "floor")])  # 8 bytes a pair of classes, 24 a listed word

    def model() -> Models:
        listed, counts, frequent, endings, target, background, inside, scale, floor = shared.value
        return Models(listed, counts, frequent, endings, target, background, inside, None, scale, floor)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        m, zip_ = model(), zstandard.ZstdCompressor(level=1)
        known, by, number = Words(m.endings), np.argsort(m.listed), TaskContext.get().partitionId() << 32
        for held, texts in _chunks(batches, 1):
            found = [known.of(t) for t in texts]
            lengths = np.array([len(x) for x in found])
            every, owner = np.concatenate(found), np.repeat(np.arange(len(found)), lengths)
            hashes, ending = known.known()
            code = classes_of(hashes, ending, m.listed[: m.frequent], m.endings)
            c = code[every]
            before = np.r_[0, c[:-1]]
            before[np.cumsum(lengths)[:-1][lengths[1:] > 0]] = 0
            # words within their classes: the listed ones' losses are known here
            at = by[np.searchsorted(m.listed, hashes, sorter=by).clip(max=len(by) - 1)] if len(by) else np.zeros(len(hashes), np.int64)
            there = m.listed[at] == hashes if len(by) else np.zeros(len(hashes), bool)
            within = [np.where(there & (code <= m.endings), _inside(m, k, m.counts[k][at] if len(by) else 0.0 * code, code), 0.0) for k in (0, 1)]
            loss = [np.bincount(owner, x.ravel()[before * size + c] + w[every], len(found)) for x, w in zip((m.target, m.background), within, strict=True)]
            # the others by the order in which they first occur
            open_ = np.flatnonzero(~there[every])
            asked, first, back = np.unique(every[open_], return_index=True, return_inverse=True)
            turn = np.argsort(first)
            place = np.empty(len(turn), np.int64)
            place[turn] = np.arange(len(turn))
            pair, times = np.unique(owner[open_] * (len(asked) + 1) + place[back], return_counts=True)
            whose, which = pair // (len(asked) + 1), pair % (len(asked) + 1)
            blob = np.r_[np.diff(whose, prepend=0), np.diff(which, prepend=0), times].astype(np.int32).tobytes()
            ids = pa.concat_arrays([b.column(0) for b in held])
            listed = lambda values: pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), values)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number]),
                    *map(listed, (ids, pa.array(lengths, pa.int64()), pa.array(loss[0]), pa.array(loss[1]))),
                    *[pa.array([x], pa.binary()) for x in (zip_.compress(blob), zip_.compress(code[asked[turn]].astype(np.int16).tobytes()), hashes[asked[turn]].tobytes())],
                ],
                names=["_chunk", "_ids", "_count", "_lt", "_lb", "_open", "_codes", "_hashes"],
            )
            number += 1
            known = known.fresh()

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                w = np.frombuffer(raw.as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(w), chunk)), pa.array(np.arange(len(w), dtype=np.int32)), pa.array(w)], names=["_chunk", "_i", "_w"])

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        import zstandard

        m, unzip, out = model(), zstandard.ZstdDecompressor(), []
        for row in range(left.num_rows):
            codes = np.frombuffer(unzip.decompress(left.column("_codes")[row].as_py()), np.int16).astype(np.int64)
            blob = np.frombuffer(unzip.decompress(left.column("_open")[row].as_py()), np.int32).astype(np.int64).reshape(3, -1)
            whose, which, times = np.cumsum(blob[0]), np.cumsum(blob[1]), blob[2]
            ids = left.column("_ids")[row].values
            n = left.column("_count")[row].values.to_numpy()
            loss = []
            for k, (own, counted) in enumerate((("_lt", "_t"), ("_lb", "_n"))):
                counts = np.zeros(len(codes))
                counts[right.column("_i").to_numpy()] = right.column(counted).to_numpy()
                further = np.bincount(whose, (_inside(m, k, counts, codes) if len(codes) else codes)[which] * times, len(n)) if len(which) else 0.0
                loss.append((left.column(own)[row].values.to_numpy() + further) / np.maximum(n, 1))
            out.append(pa.Table.from_arrays([ids, pa.array(n), *map(pa.array, (*loss, loss[1] - loss[0]))], names=["_id", "n_tokens", "loss_target", "loss_background", "score"]))
        return pa.concat_tables(out) if out else left.schema.empty_table().select([])

    made = durable(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(
        judge, f"_chunk long, _ids array<{id_type}>, _count array<long>, _lt array<double>, _lb array<double>, _open binary, _codes binary, _hashes binary"))
    answers = made.select("_chunk", "_hashes").mapInArrow(ask, "_chunk long, _i int, _w long").join(table, "_w").select("_chunk", "_i", "_t", "_n")
    whole = made.drop("_hashes").groupBy("_chunk").cogroup(answers.groupBy("_chunk")).applyInArrow(finish, f"_id {id_type}, n_tokens long, loss_target double, loss_background double, score double")
    return whole.withColumnRenamed("_id", id_col)
