"""Reading and writing JSON, CSV, templates and style sheets, and tables of what is done.

Paths may be globs on any file system that Spark reads. Files are split over tasks by file; only a file that spans lines (multi-line JSON or CSV) is read whole.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.text import blank, stripped

BOM = "﻿"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether any file matches, by the file system that the path names."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    matches = found.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(found)
    return matches is not None and len(matches) > 0


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON files that hold an array of objects, or one object, with _ord, their place in the file. A path without files gives no rows."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema).withColumn("_ord", F.lit(None).cast("long"))
    return spark.read.schema(schema).option("multiLine", True).json(path).withColumn("_ord", F.monotonically_increasing_id())


def read_csv(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """CSV files with a header, quoted line ends and doubled quotes, with or without a byte order mark; all columns as text and _row, the row's place. Empty fields are
    empty texts, as the format can't tell them from nulls."""
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"', encoding=encoding, emptyValue="", nullValue="\u0000", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    named = rows.toDF(*[c.removeprefix(BOM).strip('"') for c in rows.columns])
    return named.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in named.columns]).withColumn("_row", F.monotonically_increasing_id())


def write_csv(df: DataFrame, path: str, bom: bool = True, mode: str = "overwrite") -> None:
    """Header, quotes only where needed, quotes doubled; with a byte order mark at the head of every file. Nulls are written empty. Columns that begin with _ stay out."""
    kept = [c for c in df.columns if not c.startswith("_")]
    names = [BOM + c if bom and k == 0 else c for k, c in enumerate(kept)]
    df.select(*[F.col(f"`{c}`").cast("string").alias(n) for c, n in zip(kept, names, strict=True)]).write.mode(mode).csv(path, header=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One object a line; nulls are written, letters as they are."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def uncommented(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)/\*.*?\*/", "")


def read_commented_json(spark: SparkSession, path: str) -> DataFrame:
    """(file, value): each file's JSON as a variant, block comments and raw control characters aside; null if it is no JSON."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), uncommented(F.col("value")).alias("_v"))
    return files.select("file", F.try_parse_json(F.regexp_replace("_v", "[\\x00-\\x1f]", " ")).alias("value"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_number, line) of text files, numbers from 1."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(F.split("value", "\r?\n")).alias("_p", "line"))
    return files.select("file", (F.col("_p") + 1).alias("line_number"), "line")


def selectors(css: DataFrame, column: str) -> DataFrame:
    """(kind, name) of the classes and ids that style sheets select."""
    found = lambda kind, sign: F.transform(F.regexp_extract_all(F.col(column), F.lit(sign + "([a-zA-Z_][a-zA-Z0-9_-]*)"), 1), lambda n: F.struct(F.lit(kind).alias("kind"), n.alias("name")))
    return css.select(F.explode(F.concat(found("class", r"\."), found("id", "#"))).alias("_s")).select("_s.*").distinct()


def customers(rows: DataFrame, country: str | None = None) -> DataFrame:
    """CSV rows of customers with an address, of a country if given; of rows with one address, cases aside, the first."""
    wanted = rows if country is None else rows.filter(stripped(F.col("Country")) == country)
    keyed = wanted.withColumn("_email", F.lower(stripped(F.col("Email")))).filter(~blank(F.col("_email")))
    first = keyed.groupBy("_email").agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), "_row").alias("_r"))
    return first.select("_r.*")


def text_index(texts: DataFrame, text: str, page: str, order: str, most: int | None = None) -> DataFrame:
    """(text, pages): pages on which a text was seen, each once, by where it was seen first. Blank texts are out. most: how many pages to list; without it a text's list holds all, however many."""
    seen = texts.filter(~blank(F.col(text))).groupBy(text, page).agg(F.min(order).alias("_first"))
    if most is not None:  # Spark keeps no more than that of each text before rows meet
        seen = seen.withColumn("_nth", F.row_number().over(Window.partitionBy(text).orderBy("_first", page))).filter(F.col("_nth") <= most).drop("_nth")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("_first", page))), lambda x: x[page])
    return seen.groupBy(F.col(text).alias("text")).agg(listed.alias("pages"))


def pending(rows: DataFrame, path: str, key: str) -> DataFrame:
    """Rows whose key the table of done keys at path lacks; all, if there is no table yet. Null keys are pending."""
    spark = rows.sparkSession
    return rows.join(spark.read.parquet(path).select(key).distinct(), key, "left_anti") if exists(spark, path) else rows


def mark_done(rows: DataFrame, path: str, key: str) -> None:
    """Appends the keys that the table lacks, so marking again changes nothing."""
    pending(rows.select(key).filter(F.col(key).isNotNull()).distinct(), path, key).write.mode("append").parquet(path)
