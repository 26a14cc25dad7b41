"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text, normalised by length, with exception phrases."""

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import importable

#: Bound of the fit: labelled documents that are expected in the sample.
TRAIN_DOCS, TRAIN_TASKS = 40_000, 24
#: A word enters the lexicon if so many documents have it and toxic ones have it so much more often (log of the ratio).
MIN_DOCS, MIN_WEIGHT = 5, 2.0
#: A phrase around a lexicon word is an exception if so many clean documents have it and no toxic one does.
EXCEPTION_DOCS = 5
FLUSH_WORDS = 300_000
#: A sample of up to so many ids is sent to all tasks; beyond, documents meet it by id.
FEW_IDS = 500_000

# Letters that look like Latin ones (Cyrillic and Greek), full-width letters by rule, digits and signs used for letters.
LOOKALIKES = dict(zip("аеорсухіјѕԁһкмтвн", "aeopcyxijsdhkmtbh", strict=True)) | dict(zip("αενοριτκυχ", "aevopitkux", strict=True))
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

_LOOK = str.maketrans(LOOKALIKES | {chr(0xFF21 + k): chr(97 + k) for k in range(26)} | {chr(0xFF41 + k): chr(97 + k) for k in range(26)} | {"​": None, "‌": None, "‍": None, "­": None})
_DIGIT = str.maketrans(DIGITS)
#: Digits and signs count as letters where a letter follows, digits also where one stands before.
_SUBSTITUTED = re.compile(r"[013457@$!]+(?=[^\W\d_])|(?<=[^\W\d_])[013457]+")
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    """Lower case, look-alike letters and digits for letters undone. Cyrillic and Greek words change as well, alike everywhere."""
    text = text.lower()
    if not text.isascii():
        text = text.translate(_LOOK)
    return _SUBSTITUTED.sub(lambda m: m[0].translate(_DIGIT), text)


@dataclass
class Lexicon:
    """weights: by folded word. exceptions: folded phrases. model: of the logistic regression over features()."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    model: tuple[float, ...] = (-4.0, 1.0, 1.0, -0.5)


class Matcher:
    def __init__(self, lexicon: Lexicon):
        import ahocorasick

        self.machine = ahocorasick.Automaton()
        for phrase in lexicon.exceptions:
            self.machine.add_word(fold(phrase), (len(fold(phrase)), None, 0.0))
        for word, weight in lexicon.weights.items():
            self.machine.add_word(word, (len(word), word, weight))
        self.some = len(self.machine) > 0
        if self.some:
            self.machine.make_automaton()

    def hits(self, text: str) -> list[tuple[int, int, str, float]]:
        """Lexicon words of a folded text that stand as whole words and in no exception phrase: begin, end, word, weight."""
        if not self.some:
            return []
        words, excused, n = [], [], len(text)
        for last, (size, word, weight) in self.machine.iter(text):
            begin, end = last + 1 - size, last + 1
            if (begin and text[begin - 1].isalpha()) or (end < n and text[end].isalpha()):
                continue
            if word is None:
                excused.append((begin, end))
            else:
                words.append((begin, end, word, weight))
        return self._outside(words, excused) if excused else words

    @staticmethod
    def _outside(words: list, excused: list) -> list:
        """Both come by their ends. Of the phrases that end no earlier than a word, the one that begins first decides, so one sweep from the back suffices."""
        out, begin, k = [], math.inf, len(excused)
        for word in reversed(words):
            while k and excused[k - 1][1] >= word[1]:
                k -= 1
                begin = min(begin, excused[k][0])
            if begin > word[0]:
                out.append(word)
        return out[::-1]

    def features(self, text: str | None) -> tuple[float, float, float, float]:
        """1, log of the summed weight, log of the distinct words' weight, log of the length in words."""
        if not text:
            return 1.0, 0.0, 0.0, 0.0
        found = self.hits(fold(text))
        total, distinct = sum(w[3] for w in found), sum({w[2]: w[3] for w in found}.values())
        return 1.0, math.log1p(total), math.log1p(distinct), math.log1p(text.count(" ") + text.count("\n") + 1)


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.5) -> tuple[float, ...]:
    """Regularised logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-3, *[penalty] * (x.shape[1] - 1)])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(len(w)), x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def _learned(counts: DataFrame, toxic: int, clean: int) -> dict[str, float]:
    """counts: (word, toxic, clean) in documents. The largest log ratios of the two smoothed rates."""
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    good = counts.filter(F.col("toxic") + F.col("clean") >= MIN_DOCS).withColumn("weight", odds).filter(F.col("weight") >= MIN_WEIGHT)
    return {r["word"]: r["weight"] for r in good.orderBy(F.desc("weight"), "word").collect()}  # words of MIN_DOCS documents of the sample at least


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    train_docs: int = TRAIN_DOCS,
    exceptions: tuple[str, ...] = (),
) -> Lexicon:
    """Learns weights, exception phrases and the regression from a sample of labelled documents with text.

    The sample is expected to hold `train_docs` documents (all, if fewer); it is all that is held here, so its ids are sent to the tasks
    and no text is shuffled but the sample's. Its halves are crossed: the regression learns
    from features that the other half's lexicon gives, and the final lexicon comes from both. A phrase of a lexicon word and a neighbouring
    word that several clean documents have and no toxic one is an exception, beside those given. A document whose labels
    disagree counts as toxic. Null texts, labels and ids teach nothing. Without any label of either kind, or with an empty table, the lexicon is empty.
    """
    importable(docs.sparkSession)
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("_toxic"))
    n = known.count()
    draw = F.pmod(F.xxhash64("_id", F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = known.filter(draw < min(1.0, train_docs / max(n, 1)))
    sample = (
        docs.select(F.col(id_col).alias("_key"), F.col(text_col).alias("_text"))
        .filter(F.col("_text").isNotNull())
        .join(F.broadcast(some) if train_docs <= FEW_IDS else some, F.col("_key") == F.col("_id"))
        .select("_text", (F.col("_toxic") > 0).alias("_y"), (F.pmod(F.xxhash64("_id", F.lit(12)), F.lit(2)) == 0).alias("_half"))
        .repartition(TRAIN_TASKS)
        .cache()
    )
    sizes = {(r["_y"], r["_half"]): r["n"] for r in sample.groupBy("_y", "_half").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = [[sizes.get((y, h), 0) for h in (True, False)] for y in (True, False)]
    if not sum(toxic) or not sum(clean):
        sample.unpersist()
        return Lexicon({}, exceptions)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found: Counter) -> pa.RecordBatch:
            keys = list(found)
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.bool_()), pa.array([k[2] for k in keys], pa.bool_()), pa.array(list(found.values()), pa.int64())],
                names=["word", "y", "half", "n"],
            )

        found: Counter = Counter()
        for batch in batches:
            for text, y, half in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                found.update((w, y, half) for w in set(_WORD.findall(fold(text))))
                if len(found) > FLUSH_WORDS:
                    yield out(found)
                    found = Counter()
        yield out(found)

    per_word = sample.mapInArrow(words, "word string, y boolean, half boolean, n long").groupBy("word")
    when = lambda y, h: F.coalesce(F.sum(F.when((F.col("y") == y) & (F.col("half") == h), F.col("n"))), F.lit(0))
    counted = per_word.agg(*[when(y, h).alias(f"{'toxic' if y else 'clean'}_{int(h)}") for y in (True, False) for h in (True, False)]).cache()
    half = {
        h: Lexicon(_learned(counted.select("word", F.col(f"toxic_{h}").alias("toxic"), F.col(f"clean_{h}").alias("clean")), toxic[1 - h], clean[1 - h]), exceptions)
        for h in (1, 0)
    }
    both = _learned(counted.select("word", F.expr("toxic_1 + toxic_0").alias("toxic"), F.expr("clean_1 + clean_0").alias("clean")), sum(toxic), sum(clean))
    counted.unpersist()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Features by the other half's lexicon, as a row each; phrases around hits, one row per document and phrase."""
        other, whole = {bool(h): Matcher(half[1 - h]) for h in (0, 1)}, Matcher(Lexicon(both, exceptions))
        for batch in batches:
            rows = []
            for text, y, own in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                rows.append((None, y, list(other[own].features(text))))
                folded, phrases = fold(text), set()
                for begin, end, word, _ in whole.hits(folded):
                    before, after = _WORD.findall(folded[max(0, begin - 40) : begin]), _WORD.findall(folded[end : end + 40])
                    phrases |= {f"{x} {word}" for x in before[-1:]} | {f"{word} {x}" for x in after[:1]}
                rows += [(p, y, None) for p in phrases]
            phrase, toxic_row, feature = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(phrase, pa.string()), pa.array(toxic_row, pa.bool_()), pa.array(feature, pa.list_(pa.float64()))], names=["phrase", "y", "x"])

    seen = sample.mapInArrow(look, "phrase string, y boolean, x array<double>").cache()
    phrases = seen.filter("phrase is not null").groupBy("phrase").agg(F.count_if(F.col("y")).alias("t"), F.count_if(~F.col("y")).alias("c"))
    excused = [r["phrase"] for r in phrases.filter((F.col("t") == 0) & (F.col("c") >= EXCEPTION_DOCS)).orderBy(F.desc("c"), "phrase").collect()]
    rows = seen.filter("phrase is null").select("y", "x").toArrow()  # as many as the sample has documents
    x = np.array(rows.column("x").to_pylist())
    model = _logistic(x, np.array(rows.column("y").to_pylist(), float))
    seen.unpersist()
    sample.unpersist()
    return Lexicon(both, (*exceptions, *excused), model)


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (id, score, predicted, weight), from the whole text and nothing else.

    score is between 0 and 1; a null or empty text is scored as one without hits, and documents with equal features tie. Texts of any length are
    matched in one sweep. Rows that repeat an id are scored one by one. An empty table gives no rows. Extra columns are ignored, whatever they are called.
    """
    importable(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, w = Matcher(lexicon), np.array(lexicon.model)
        for batch in batches:
            x = np.array([matcher.features(t) for t in batch.column(1).to_pylist()]).reshape(-1, len(w))
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32), pa.int32()), pa.array(np.expm1(x[:, 1]), pa.float64())],
                names=["_id", "score", "predicted", "weight"],
            )

    made = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(judge, f"_id {id_type}, score double, predicted int, weight double")
    return made.withColumnRenamed("_id", id_col)
