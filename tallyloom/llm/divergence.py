"""Audit of how sources of a language differ in their terms: term-block matrices of counts in int64, all pairs of a block at once."""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.shared import durable, importable

#: Kept terms are those of so many documents of a language; what a term is seen beyond its occurrences; parts of the whole that a share is told in; terms listed a group.
MIN_DOCS, PRIOR, SCALE, TOP = 3, 1, 1_000_000_000, 200
#: Terms of a block on average, cells of a tile that are looked at together (8 bytes each, a few at a time), salts over which a group's heaps are merged first.
BLOCK_TERMS, TILE_CELLS, HEAPS = 4096, 1 << 21, 32
#: Entries that a task counts before it hands them on; bytes of a text that are split at once.
FLUSH, SLICE = 300_000, 1 << 20

#: Bytes of terms (A-Z lower-cased, all beyond ASCII as they are); every other byte parts terms.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_slices(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text, a slice of some SLICE bytes at a time."""
    clean, first = (text or b"").translate(_FOLD), 0
    while first < len(clean):
        end = clean.find(b" ", first + SLICE) if len(clean) - first > SLICE else -1
        end = len(clean) if end < 0 else end
        yield clean[first:end].split()
        first = end


def shares(counts: np.ndarray, total: int, kinds: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / (total + kinds)), by long division, as the product would not fit 64 bits. Exact up to totals of 9e15."""
    whole = max(total + PRIOR * kinds, 1)
    out, rest = np.divmod(counts + PRIOR, whole)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + digit
    return 1 + out


def differences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // q


def pair_sums(p: np.ndarray) -> np.ndarray:
    """p: shares by group and term. Sums of differences over the terms for all pairs (group, other), a tile of groups and terms at a time."""
    n, terms = p.shape
    out = np.zeros((n, n), np.int64)
    rows = max(1, min(n, TILE_CELLS // max(n, 1)))
    width = max(1, TILE_CELLS // (rows * max(n, 1)))
    for i in range(0, n, rows):
        for t in range(0, terms, width):
            out[i : i + rows] += differences(p[i : i + rows, None, t : t + width], p[None, :, t : t + width]).sum(-1)
    return out


def counted(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """(_lang, _source, _term, _n, _docs): occurrences and documents with the term, summed within tasks only."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times: dict[tuple[str, str], Counter] = {}
        within: dict[tuple[str, str], Counter] = {}

        def handed() -> Iterator[pa.RecordBatch]:
            for group, own in times.items():
                terms = sorted(own)
                for k in range(0, len(terms), 100_000):
                    part = terms[k : k + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([group[0]] * len(part)), pa.array([group[1]] * len(part)), pa.array(part, pa.binary()).cast(pa.string()), pa.array([own[t] for t in part], pa.int64()), pa.array([within[group][t] for t in part], pa.int64())],
                        names=["_lang", "_source", "_term", "_n", "_docs"],
                    )
            times.clear()
            within.clear()

        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, strict=True):
                own, docs_with, seen = times.setdefault((lang, source), Counter()), within.setdefault((lang, source), Counter()), set()
                for terms in term_slices(text.as_py()):
                    own.update(terms)
                    seen.update(terms)
                docs_with.update(seen)
            if sum(map(len, times.values())) > FLUSH:
                yield from handed()
        yield from handed()

    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "_lang"), (source_col, "_source"))], F.col(text_col).alias("_text"))
    return rows.mapInArrow(count, "_lang string, _source string, _term string, _n long, _docs long")


def kept_terms(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(_lang, _term, _of: occurrences by source) of the terms in at least min_docs documents of the language. One shuffle by language and term."""
    spread = counts.repartition(F.col("_lang"), F.col("_term"))
    sums = spread.groupBy("_lang", "_term", "_source").agg(F.sum("_n").alias("_n"), F.sum("_docs").alias("_docs"))
    terms = sums.groupBy("_lang", "_term").agg(F.sum("_docs").alias("_docs"), F.array_sort(F.collect_list(F.struct("_source", "_n"))).alias("_of"))
    return terms.filter(F.col("_docs") >= min_docs).select("_lang", "_term", "_of")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, block_terms: int = BLOCK_TERMS, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank) for each group, a group being a language's documents of one source.

    Part `pair`: how far the group's terms differ from those of each other source of its language, summed over the language's kept terms (those in at least
    min_docs of its documents). Part `term`: the kept terms that the group uses more than its language does, the `top` with the largest difference. Shares and
    differences are whole numbers, exact at any size. rank counts by value, ties by item in the order of UTF-8.

    Tasks count terms by group; counts meet by language and term. Blocks of about block_terms terms then get the list of their languages' groups and become dense matrices of groups by terms. All
    pairs of groups are compared in each block, and the blocks' pair sums are summed up; a block gives each group's top terms, which are merged, first by salt, then by group.
    A task holds a block's matrix and the square of a language's sources, which is what the result has.

    Null text, language and source are empty. A group without kept terms has its pairs, with 0 if its language has no kept term, and no terms. Long texts are counted a slice at a time. Rows that
    repeat count each. Extra columns are ignored, whatever they are called. An empty table gives no rows.
    """
    importable(docs.sparkSession)
    kept = durable(kept_terms(counted(docs, text_col, lang_col, source_col), min_docs))
    of_kept = kept.select("_lang", F.explode("_of").alias("_o")).groupBy("_lang", F.col("_o._source").alias("_source")).agg(F.sum("_o._n").alias("_total"))
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "_lang"), (source_col, "_source"))]).distinct()
    kinds = kept.groupBy("_lang").agg(F.count(F.lit(1)).alias("_kinds"))
    stats = durable(groups.join(of_kept, ["_lang", "_source"], "left").join(kinds, "_lang", "left").na.fill(0, ["_total", "_kinds"]))

    blocks = max(1, -(-kept.count() // block_terms))
    placed = kept.withColumn("_block", F.pmod(F.xxhash64("_lang", "_term"), F.lit(blocks)).cast("int"))
    without = stats.filter("_kinds = 0").select("_lang", F.lit(0).alias("_block")).distinct()
    where = placed.select("_lang", "_block").distinct().unionByName(without)
    about = durable(where).join(stats, "_lang").withColumnRenamed("_block", "_of_block")  # each block's groups

    def compare(terms: pa.Table, about: pa.Table) -> pa.Table:
        out, of_lang, by_lang = [], {}, {}
        for r in about.to_pylist():
            of_lang.setdefault(r["_lang"], []).append((r["_source"], r["_total"], r["_kinds"]))
        langs = terms.column("_lang").to_pylist()
        for k, lang in enumerate(langs):
            by_lang.setdefault(lang, []).append(k)
        for lang, groups in of_lang.items():
            groups.sort()
            number, at, kinds = {g[0]: k for k, g in enumerate(groups)}, by_lang.get(lang, []), groups[0][2]
            part = terms.take(pa.array(at, pa.int64()))
            matrix = np.zeros((len(groups), len(at)), np.int64)
            for column, entries in enumerate(part.column("_of").to_pylist()):
                for e in entries:
                    matrix[number[e["_source"]], column] = e["_n"]
            p = np.stack([shares(own, g[1], kinds) for own, g in zip(matrix, groups, strict=True)])
            q = shares(matrix.sum(0), sum(g[1] for g in groups), kinds)
            names = np.array([g[0] for g in groups], object)
            i, j = np.nonzero(~np.eye(len(groups), dtype=bool))
            out.append((np.full(len(i), lang, object), names[i], np.full(len(i), "pair", object), names[j], pair_sums(p)[i, j]))
            words = np.array([t.encode() for t in part.column("_term").to_pylist()], object)
            above = differences(p, q)
            for k in range(len(groups)):
                mine = np.flatnonzero((matrix[k] > 0) & (p[k] > q))
                if len(mine) > top:
                    least = np.partition(above[k][mine], -top)[-top]
                    mine = mine[above[k][mine] >= least]
                mine = sorted(mine, key=lambda c, f=above[k]: (-f[c], words[c]))[:top]
                one = lambda value, n=len(mine): np.full(n, value, object)
                out.append((one(lang), one(names[k]), one("term"), np.array([words[c].decode() for c in mine], object), above[k][mine]))
        columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [[]] * 5
        return pa.table({n: pa.array(c, kind) for n, c, kind in zip(("lang", "source", "part", "item", "value"), columns, [pa.string()] * 4 + [pa.int64()], strict=True)})

    found = durable(placed.groupBy("_block").cogroup(about.groupBy("_of_block")).applyInArrow(compare, "lang string, source string, part string, item string, value long"))
    order = [F.desc("value"), F.col("item")]
    pairs = found.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    first = Window.partitionBy("lang", "source", F.pmod(F.xxhash64("item"), F.lit(HEAPS))).orderBy(*order)
    heaps = found.filter("part = 'term'").withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= top).drop("_r")
    last = Window.partitionBy("lang", "source").orderBy(*order)
    terms = heaps.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(last)).unionByName(terms)
