"""Language ID with hyperdimensional profiles of letter n-grams."""

import math
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.shared import importable

UNKNOWN = "und"
DIMENSIONS, ORDER, SEED = 512, 3, 7
#: Bound of the fit: labelled documents per language that are expected in the sample; tasks that sum them up, in all and of one language.
TRAIN_DOCS, TRAIN_TASKS, LANGUAGE_TASKS = 3000, 24, 6
#: Up to so many languages their shares are sent to all tasks; beyond, rows meet them by language.
FEW_LANGUAGES = 10_000
#: Characters and texts that a task looks at together, and distinct n-grams of theirs, fewer in proportion to more than DIMENSIONS.
BATCH_CHARS, BATCH_TEXTS, SLICE_GRAMS = 200_000, 256, 8192

_BLANK = 0


@dataclass
class Profiles:
    """Unit prototypes of languages, less their common part, and what is needed to make letter vectors again."""

    languages: list[str]
    prototypes: np.ndarray
    common: np.ndarray
    dimensions: int = DIMENSIONS
    order: int = ORDER
    seed: int = SEED


def letter_vectors(letters: np.ndarray, dimensions: int, seed: int) -> np.ndarray:
    """A random vector of +1 and -1 for each code point, the same in every process."""
    out = np.empty((len(letters), dimensions), np.float32)
    for k, c in enumerate(letters.tolist()):
        bits = np.random.Generator(np.random.PCG64([seed, c])).integers(0, 2, dimensions, dtype=np.int8)
        out[k] = 2 * bits - 1
    return out


class Encoder:
    """Turns texts into bundles: the sum over n-grams of the product of letter vectors, each rotated by its place."""

    def __init__(self, dimensions: int = DIMENSIONS, order: int = ORDER, seed: int = SEED):
        self.dimensions, self.order, self.seed = dimensions, order, seed
        self.known: dict[int, np.ndarray] = {}
        self.is_letter = np.zeros(0x110000, np.int8)  # 0: not seen yet, 1: letter, 2: other

    def _vectors(self, letters: np.ndarray) -> np.ndarray:
        new = [c for c in letters.tolist() if c not in self.known]
        if len(self.known) + len(new) > 20_000:
            self.known = {}
            new = letters.tolist()
        if new:
            self.known.update(zip(new, letter_vectors(np.array(new), self.dimensions, self.seed).astype(np.int8), strict=True))
        return np.stack([self.known[c] for c in letters.tolist()]).astype(np.float32)

    def _letters(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Code points of all texts, each between blanks, with runs of other characters as one blank; the texts' numbers."""
        lowered = [t.lower() for t in texts]
        points = np.frombuffer((" " + "  ".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), "<u4")
        owner = np.repeat(np.arange(len(texts), dtype=np.int32), np.array([len(t) + 2 for t in lowered], np.int64))
        seen = np.unique(points) if len(points) < 5000 else np.flatnonzero(np.bincount(points))
        for c in seen[self.is_letter[seen] == 0].tolist():
            self.is_letter[c] = 1 if chr(c).isalpha() else 2
        points = np.where(self.is_letter[points] == 1, points, np.uint32(_BLANK))
        keep = np.ones(len(points), bool)
        keep[1:] = (points[1:] != _BLANK) | (points[:-1] != _BLANK) | (owner[1:] != owner[:-1])
        return points[keep], owner[keep]

    def bundles(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A row of the bundle for each text, and how many n-grams with a letter it has. The bundle is a sum, so it is
        taken in slices: of BATCH_CHARS characters, and of SLICE_GRAMS distinct n-grams within those."""
        points, owner = self._letters(texts)
        total, grams = np.zeros((len(texts), self.dimensions), np.float32), np.zeros(len(texts), np.int64)
        for at in range(0, max(len(points) - self.order + 1, 0), BATCH_CHARS):
            self._add(points[at : at + BATCH_CHARS + self.order - 1].astype(np.int64), owner[at : at + BATCH_CHARS + self.order - 1], total, grams)
        return total, grams

    def _add(self, points: np.ndarray, owner: np.ndarray, total: np.ndarray, grams: np.ndarray) -> None:
        order, size = self.order, len(points) - self.order + 1
        alphabet = np.flatnonzero(np.bincount(points, minlength=1))
        place = np.zeros(int(alphabet[-1]) + 1, np.int64)
        place[alphabet] = np.arange(len(alphabet))
        codes = place[points]
        gram = np.zeros(size, np.int64)
        some = np.zeros(size, bool)
        for k in range(order):
            gram = gram * len(alphabet) + codes[k : k + size]
            some |= points[k : k + size] != _BLANK
        one = (owner[:size] == owner[order - 1 :]) & some
        gram, whose = gram[one], owner[:size][one].astype(np.int64)
        grams += np.bincount(whose, minlength=len(grams))
        if len(alphabet) ** order <= 4_000_000:
            used = np.flatnonzero(np.bincount(gram, minlength=1))
            column = np.zeros(len(alphabet) ** order, np.int32)
            column[used] = np.arange(len(used))
            at = column[gram]
        else:
            used, at = np.unique(gram, return_inverse=True)
        base = self._vectors(alphabet)
        turned = [np.roll(base, order - 1 - k, axis=1) for k in range(order)]
        first, n = int(whose.min(initial=0)), int(whose.max(initial=-1)) + 1
        width = max(SLICE_GRAMS * DIMENSIONS // max(self.dimensions, DIMENSIONS), 1)
        several = len(used) > width
        if several:  # by n-gram, so that a slice is a range
            by = np.argsort(at, kind="stable")
            at, whose = at[by], whose[by]
        for low in range(0, len(used), width):
            part = used[low : low + width]
            a, b = np.searchsorted(at, [low, low + len(part)]) if several else (0, len(at))
            counts = np.bincount((whose[a:b] - first) * len(part) + at[a:b] - low, minlength=(n - first) * len(part)).reshape(n - first, len(part))
            bound, rest = turned[order - 1][part % len(alphabet)], part // len(alphabet)
            for k in range(order - 2, -1, -1):
                bound *= turned[k][rest % len(alphabet)]
                rest //= len(alphabet)
            total[first:n] += counts.astype(np.float32) @ bound


_encoders: dict[tuple, Encoder] = {}


def _encoder(*how: int) -> Encoder:
    if how not in _encoders:
        _encoders[how] = Encoder(*how)
    return _encoders[how]


def _batched(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of about BATCH_CHARS characters; a longer text is a range of its own."""
    start = size = 0
    for k, t in enumerate(texts):
        if k > start and (size + len(t) > BATCH_CHARS or k - start >= BATCH_TEXTS):
            yield start, k
            start, size = k, 0
        size += len(t)
    if texts:
        yield start, len(texts)


def _slices(column: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
    """The ranges of a column of texts, each with its texts; no more than BATCH_TEXTS become Python's at once."""
    for at in range(0, len(column), BATCH_TEXTS):
        texts = [t or "" for t in column.slice(at, BATCH_TEXTS).to_pylist()]
        for a, b in _batched(texts):
            yield at + a, at + b, texts[a:b]


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def fit(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = TRAIN_DOCS,
    dimensions: int = DIMENSIONS,
    order: int = ORDER,
    seed: int = SEED,
) -> Profiles:
    """Prototypes from a sample that is expected to hold `per_language` of each language's documents (all, if fewer).

    Each document's bundle is scaled to length 1 before it is added, so long texts weigh no more than others. What all
    languages have in common is taken off the prototypes. Every language that has a labelled text is learned; the prototypes, a
    row of `dimensions` numbers a language, are the only thing that grows with them. Rows without text or language teach nothing; an
    empty table, or one without labels, gives no languages.
    """
    importable(labelled.sparkSession)
    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang"))
    counts = rows.groupBy("_lang").agg((F.lit(float(per_language)) / F.count(F.lit(1))).alias("_share")).collect()  # a row a language, as the prototypes have
    shares = labelled.sparkSession.createDataFrame([tuple(r) for r in counts], rows.select("_lang", F.lit(1.0).alias("_share")).schema)
    draw = F.pmod(F.xxhash64("_id", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    shares = F.broadcast(shares) if len(counts) <= FEW_LANGUAGES else shares
    sample = rows.join(shares, "_lang").filter(draw < F.col("_share")).select("_text", "_lang", F.pmod(F.xxhash64("_id"), F.lit(LANGUAGE_TASKS)).alias("_part")).repartition(TRAIN_TASKS, "_lang", "_part")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, found = _encoder(dimensions, order, seed), {}
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_TEXTS):  # so that only these become Python's
                texts, langs = (batch.column(k).slice(at, BATCH_TEXTS).to_pylist() for k in (0, 1))
                langs = np.array(langs, object)
                for a, b in _batched(texts):
                    units = _unit(encode.bundles(texts[a:b])[0])
                    for lang in set(langs[a:b]):
                        found[lang] = found.get(lang, 0) + units[langs[a:b] == lang].sum(0, dtype=np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array([v.tobytes() for v in found.values()], pa.binary())], names=["_lang", "_sum"])

    total: dict[str, np.ndarray] = {}
    for r in sample.select("_text", "_lang").mapInArrow(sums, "_lang string, _sum binary").collect():  # LANGUAGE_TASKS rows a language at most
        total[r["_lang"]] = total.get(r["_lang"], 0) + np.frombuffer(bytes(r["_sum"]), np.float64)
    if not total:
        return Profiles([], np.zeros((0, dimensions), np.float32), np.zeros(dimensions, np.float32), dimensions, order, seed)
    languages = sorted(total)
    prototypes = _unit(np.stack([total[x] for x in languages]))
    common = prototypes.mean(0) if len(languages) > 1 else np.zeros(dimensions)
    return Profiles(languages, _unit(prototypes - common).astype(np.float32), _unit(common).astype(np.float32), dimensions, order, seed)


def chance_cosine(profiles: Profiles, share: float) -> float:
    """The cosine that a text in none of the languages reaches with its nearest prototype with this chance at most. The cosine of a random vector is about normal with
    a deviation of one over the root of the dimensions."""
    return NormalDist().inv_cdf(1 - share / max(len(profiles.languages), 1)) / math.sqrt(profiles.dimensions)


def predict(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per document: (id, lang_pred, score, cosine), from the whole text and nothing else. keep: columns of docs that
    pass through in place of the id; they must not be named like the results. A text_col within a kept struct (as in "doc.text") is taken from there, so that it is sent once.

    The document's bundle, less its part along what all languages share, is compared with every prototype by cosine; the
    nearest language wins, the first by name in a tie. score is that language's share of exp(8 * cosine) over all languages, so
    it lies between 0 and 1. A null or empty text, or one without letters, is `und` with score 0, as is every text if no language was learned. Rows that
    repeat an id are judged one by one. A text of any length is looked at whole, BATCH_CHARS characters at a time. An empty table gives no rows.
    Extra columns are ignored.
    """
    importable(docs.sparkSession)
    keep = [id_col] if keep is None else keep
    taken = {"lang_pred", "score", "cosine"} & set(keep)
    if taken:
        raise ValueError(f"columns named like results: {sorted(taken)}")
    passed = T.StructType([T.StructField(f"_{k}", docs.schema[c].dataType) for k, c in enumerate(keep)])
    schema = T.StructType([*passed, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("cosine", T.DoubleType())])
    names = [*profiles.languages, UNKNOWN]

    inner = next((k for k, c in enumerate(keep) if text_col.startswith(f"{c}.")), None)
    field = "" if inner is None else text_col[len(keep[inner]) + 1 :]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(profiles.dimensions, profiles.order, profiles.seed)
        for batch in batches:
            column = batch.column(len(keep)) if inner is None else batch.column(inner).field(field)
            best, score, cosine = np.full(batch.num_rows, len(names) - 1), np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for a, b, texts in _slices(column) if len(names) > 1 else ():
                bundle, grams = encode.bundles(texts)
                bundle = _unit(bundle)
                near = _unit(bundle - np.outer(bundle @ profiles.common, profiles.common)) @ profiles.prototypes.T
                power = np.exp(8.0 * near.astype(np.float64))
                some, top = grams > 0, near.argmax(1)
                best[a:b][some] = top[some]
                every = np.arange(b - a)
                score[a:b][some] = (power[every, top] / power.sum(1))[some]
                cosine[a:b][some] = near[every, top][some]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array([names[k] for k in best], pa.string()), pa.array(score, pa.float64()), pa.array(cosine, pa.float64())],
                names=schema.names,
            )

    rows = docs.select(*[F.col(f"`{c}`").alias(f"_{k}") for k, c in enumerate(keep)], *([F.col(text_col).alias("_text")] if inner is None else []))
    return rows.mapInArrow(judge, schema).withColumnsRenamed({f"_{k}": c for k, c in enumerate(keep)})
