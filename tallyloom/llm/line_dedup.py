"""Line dedup in DataFrame operations only: lines that many documents share are dropped everywhere."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import BLANKS, ascii_lower

MIN_DOCS, MIN_CHARS = 10, 1
#: Parts over which the places of one common line are spread when they meet its hash.
SALTS = 32


def line_key(line: Column) -> Column:
    """The normalised line: blanks stripped at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _digest(line: Column, min_chars: int) -> Column:
    key = line_key(line)
    return F.when(F.length(key) >= min_chars, F.unhex(F.md5(key.cast("binary"))))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS
) -> DataFrame:
    """One row per document: (id, n_lines, n_dropped, kept_text).

    Lines are exploded and keyed by the 128-bit hash of their normalised form. Each document offers each of its hashes
    once, so counting documents per hash needs one shuffle with map-side sums and a line that a third of the documents
    share is one row per task. Hashes over the threshold, few as they are, are copied to SALTS parts and meet the (row key, position, hash)
    rows there, which are dealt to the parts by row, so no line's places gather in one task. Only hashes travel. The
    text is cut and put together again by position in one pass.

    A null or empty text has one empty line. Keys shorter than `min_chars` code points are never dropped. Every row
    counts as a document; rows that repeat id and text get the same result each. A document that loses all lines has an empty
    kept_text. Very long texts are split where they lie and never gathered. Extra columns are ignored. An empty table gives no rows.
    """
    base = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    lines = F.split("_text", "\n")
    row = [F.xxhash64("_id").alias("_row_id"), F.xxhash64("_text").alias("_row_text")]
    common = (
        base.select(F.explode(F.array_distinct(F.transform(lines, lambda x: _digest(x, min_chars)))).alias("_key"))
        .filter("_key is not null")
        .groupBy("_key")
        .agg(F.count(F.lit(1)).alias("_docs"))
        .filter(F.col("_docs") >= min_docs)
        .select("_key", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    )
    placed = (
        base.select(*row, F.posexplode(lines).alias("_pos", "_line"))
        .select("_row_id", "_row_text", "_pos", _digest(F.col("_line"), min_chars).alias("_key"), F.pmod(F.xxhash64("_row_id", "_row_text", "_pos"), F.lit(SALTS)).cast("int").alias("_salt"))
        .filter("_key is not null")
    )
    dropped = placed.join(common, ["_key", "_salt"]).groupBy("_row_id", "_row_text").agg(F.collect_set("_pos").alias("_drop"))
    cut = base.select("*", *row).join(dropped, ["_row_id", "_row_text"], "left").withColumn("_lines", lines)
    places = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_drop"))
    kept = F.array_join(F.transform(places, lambda i: F.element_at(F.col("_lines"), i + 1)), "\n")
    return cut.select(
        F.col("_id").alias(id_col),
        F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("_drop").isNull(), F.col("_text")).otherwise(kept).alias("kept_text"),
    )
