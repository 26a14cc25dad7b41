"""Importance resampling towards a target: hashed n-gram features counted by DuckDB in each partition, merged and scored by Spark."""

from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.mixing import numbered
from tallyloom.llm.shared import UPPER, durable, importable

MAX_N, BUCKETS, MIN_WORDS, DRAW_PERCENT, SEED = 1, 10_000, 20, 10, 2024
#: A word, once A-Z are lower-cased: digits, letters a-z and all that is not ASCII. The same set of characters as bytes of UTF-8, for cutting long texts.
WORD, WORD_BYTES = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", rb"[0-9A-Za-z\x80-\xff]+"
#: Bytes of text that one DuckDB query looks at; longer texts are cut between words.
QUERY_BYTES, DUCKDB_MEMORY = 8 << 20, "400MB"


def features_sql(max_n: int, buckets: int) -> str:
    """Bucket counts by row of the table `pieces` (row, extra, text); a piece's last `extra` words only end n-grams that start before them."""
    grams = ["SELECT row, word AS feature FROM placed WHERE pos <= n - extra"]
    for k in range(2, max_n + 1):
        words = ", ".join(["word", *(f"lead(word, {j}) OVER w" for j in range(1, k))])
        grams.append(f"SELECT row, concat_ws(' ', {words}) AS feature FROM placed WINDOW w AS (PARTITION BY piece ORDER BY pos) QUALIFY pos <= least(n - extra, n - {k - 1})")
    return f"""
    WITH split AS (SELECT piece, row, extra, regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '{WORD}') AS words FROM pieces),
    placed AS (SELECT piece, row, extra, len(words) AS n, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM split),
    features AS ({" UNION ALL ".join(grams)}),
    seen AS (SELECT row, feature, count(*) AS times FROM features GROUP BY ALL),
    hashed AS (SELECT feature, (zlib_crc32(feature) % {buckets})::INT AS bucket FROM (SELECT DISTINCT feature FROM seen)),
    counted AS (SELECT row, bucket, sum(times)::BIGINT AS times FROM seen JOIN hashed USING (feature) GROUP BY ALL),
    listed AS (SELECT row, list(bucket ORDER BY bucket) AS buckets, list(times ORDER BY bucket) AS times FROM counted GROUP BY row),
    measured AS (SELECT row, sum(len(words) - extra)::BIGINT AS n_words FROM split GROUP BY row)
    SELECT row, n_words, coalesce(buckets, []) AS buckets, coalesce(times, []) AS times FROM measured LEFT JOIN listed USING (row) ORDER BY row
    """


def cut(text: bytes, max_n: int, size: int = QUERY_BYTES) -> Iterator[tuple[bytes, int]]:
    """(piece, extra): the text in pieces of about `size` bytes that end between words, each followed by the `extra` words, max_n - 1 at most, that its last n-grams need."""
    import re

    first = 0
    while len(text) - first > size:
        end = re.compile(rb"[^0-9A-Za-z\x80-\xff]|\Z").search(text, first + size).start()
        words = [m.end() for _, m in zip(range(max_n - 1), re.compile(WORD_BYTES).finditer(text, end), strict=False)]
        yield text[first : words[-1] if words else end], len(words)
        first = end
    yield text[first:], 0


def together(counts: pa.Table) -> pa.Table:
    """One row for each _row, counts of several added up. In the order of rows."""
    rows: dict[int, tuple[int, dict]] = {}
    for row, n, own, times in zip(*(c.to_pylist() for c in counts.columns), strict=True):
        words, was = rows.get(row, (0, {}))
        for b, t in zip(own, times, strict=True):
            was[b] = was.get(b, 0) + t
        rows[row] = (words + n, was)
    order = sorted(rows)
    columns = [order, [rows[r][0] for r in order], [sorted(rows[r][1]) for r in order], [[rows[r][1][b] for b in sorted(rows[r][1])] for r in order]]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, counts.schema, strict=True)], schema=counts.schema)


def spilled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_n: int = MAX_N, buckets: int = BUCKETS) -> DataFrame:
    """(_row, _id, _words, _buckets, _times) of each row, as Parquet in the shared folder: its words and how often each bucket is hit, by the order of buckets.

    Each partition's texts go through an in-memory DuckDB, some 8 MB at a time: SQL unnests the words, windows them to n-grams and counts them by bucket, a registered function giving zlib's CRC-32.
    """
    importable(docs.sparkSession)
    sql, id_type = features_sql(max_n, buckets), docs.schema[id_col].dataType.simpleString()
    kinds = {"_row": pa.int64(), "_words": pa.int64(), "_buckets": pa.list_(pa.int32()), "_times": pa.list_(pa.int64())}

    def checksums(features: pa.ChunkedArray) -> pa.Array:
        return pa.array([crc32(x) for x in features.cast(pa.binary()).to_pylist()], pa.int64())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb
        from pyspark import TaskContext

        con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": DUCKDB_MEMORY})
        con.create_function("zlib_crc32", checksums, ["VARCHAR"], "BIGINT", type="arrow")
        results, number = [], TaskContext.get().partitionId() << 33

        def query(pieces: list[tuple[int, int, bytes]]) -> None:
            rows, extra, texts = zip(*pieces, strict=True)
            con.register("pieces", pa.table({"piece": pa.array(range(len(rows)), pa.int64()), "row": pa.array(rows, pa.int64()), "extra": pa.array(extra, pa.int64()), "text": pa.array(texts, pa.binary()).cast(pa.string())}))
            results.append(con.sql(sql).to_arrow_table().rename_columns(list(kinds)).cast(pa.schema(kinds.items())))
            con.unregister("pieces")

        def made(ids: list) -> Iterator[pa.RecordBatch]:
            found = pa.concat_tables(results)
            results.clear()
            if found.num_rows > len(ids):  # a text in several queries
                found = together(found)
            whole = found.add_column(1, "_id", pa.concat_arrays(ids)).combine_chunks()
            yield from whole.to_batches()

        ids, pieces, size = [], [], 0
        for batch in batches:
            for k, text in enumerate(batch.column(1).cast(pa.binary())):
                row = number + len(ids)
                ids.append(batch.column(0).slice(k, 1))
                for piece, extra in cut(text.as_py() or b"", max_n):
                    pieces.append((row, extra, piece))
                    size += len(piece)
                    if size >= QUERY_BYTES:
                        query(pieces)
                        pieces, size = [], 0
                if not pieces or len(ids) >= 20_000:
                    if pieces:
                        query(pieces)
                    yield from made(ids)
                    number, ids, pieces, size = number + len(ids), [], [], 0
        if pieces:
            query(pieces)
        if ids:
            yield from made(ids)
        con.close()

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return durable(rows.mapInArrow(count, f"_row long, _id {id_type}, _words long, _buckets array<int>, _times array<long>"))


def merged(counts: DataFrame, name: str) -> DataFrame:
    """(_bucket, name): bucket counts of all rows, summed map-side."""
    each = counts.select(F.explode(F.arrays_zip("_buckets", "_times")).alias("b"))
    return each.groupBy(F.col("b._buckets").alias("_bucket")).agg(F.sum("b._times").alias(name))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(_bucket, _gain) for each bucket: 1000 times the logarithm of how much likelier it is in the target, with one more hit in every bucket, rounded down.
    docs, target: as spilled gives them. The table has `buckets` rows."""
    source, wanted = durable(merged(docs, "_s")), durable(merged(target, "_t"))
    n_source, n_target = ((x.agg(F.sum(c)).first()[0] or 0) for x, c in ((source, "_s"), (wanted, "_t")))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("_bucket")).join(source, "_bucket", "left").join(wanted, "_bucket", "left")
    seen = lambda c: F.coalesce(c, F.lit(0)).cast("double") + 1.0
    return every.select("_bucket", F.floor(1000.0 * F.log(seen("_t") * F.lit(float(n_source + buckets)) / (seen("_s") * F.lit(float(n_target + buckets))))).alias("_gain"))


def drawn_noise(id_: Column, seed: int) -> Column:
    """1000 times a Gumbel draw, rounded down, that the seed and the id decide; a null id draws as one that is written as nothing."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    max_n: int = MAX_N,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    percent: int = DRAW_PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of docs: (id, n_features, weight, score, rank).

    Features are all runs of 1 to max_n consecutive words, each hashed to a bucket. A bucket's gain is the log ratio of its share in the target to that in
    docs; a document's weight is the sum of gains over its features, repeats counted, and its score adds Gumbel noise, so that the highest scores are a draw without replacement in proportion to the importance weights.
    Of the N documents with at least min_words words, floor(percent * N / 100) are drawn, ties to smaller ids; rank counts them from 1 and is null for all others.

    Texts are read once, by DuckDB in each partition, and spilled as bucket counts; the rest is Spark: counts are summed map-side, the table of gains (`buckets` rows) is sent to all
    tasks, weights are summed where a document's counts lie, and ranks are given by ranges of the score, without a task for all.

    A null or blank text has no features, weight 0 and no rank. A text of any length is looked at in pieces that end between words. Rows that repeat an id share its noise and have a row and a rank each.
    A null id comes last among ties. Extra columns are ignored, whatever they are called. An empty table gives no rows; an empty target gives every bucket the same chance there.
    """
    own = spilled(docs, id_col, text_col, max_n, buckets)
    wanted = target.select(F.lit(0).alias("_id"), F.col(target_text_col).alias("_text"))
    table = F.broadcast(gains(own, spilled(wanted, "_id", "_text", max_n, buckets), buckets))
    each = own.select("_row", "_id", "_words", F.explode_outer(F.arrays_zip("_buckets", "_times")).alias("_b")).select("_row", "_id", "_words", F.col("_b._buckets").alias("_bucket"), F.col("_b._times").alias("_n"))
    weighed = each.join(table, "_bucket", "left").groupBy("_row").agg(
        F.first("_id").alias("_id"), F.first("_words").alias("_words"), F.coalesce(F.sum("_n"), F.lit(0)).alias("_features"), F.coalesce(F.sum(F.col("_n") * F.col("_gain")), F.lit(0)).alias("_weight")
    )
    scored = durable(weighed.withColumn("_score", F.col("_weight") + drawn_noise(F.col("_id"), seed)).withColumn("_in", F.col("_words") >= min_words))
    draw = percent * scored.filter("_in").count() // 100
    ranked = numbered(scored, [F.desc("_in"), F.desc("_score"), F.col("_id").asc_nulls_last(), F.col("_row")], "_nth")
    return ranked.select(
        F.col("_id").alias(id_col),
        F.col("_features").alias("n_features"),
        F.col("_weight").alias("weight"),
        F.col("_score").alias("score"),
        F.when(F.col("_nth") < draw, F.col("_nth").cast("long") + 1).alias("rank"),
    )
