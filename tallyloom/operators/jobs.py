"""Whole jobs over translation rows and fields, made of the other operators."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import classify, text, trees
from tallyloom.operators import audit, changes, rows, sequence

Translate = Callable[[list[str]], list[str | None]]

#: How findings of different kinds rank where a row has several (see audit.strongest_finding).
RANKS = {"model": 0, "script_high": 1, "duplicate": 2, "heuristic": 3, "script_medium": 4}


def translate_rows(table: DataFrame, translate: Translate, done: DataFrame | None = None, overwrite: bool = False, most_tokens: int = 6000, order: str = "_row") -> DataFrame:
    """Translation rows with what they lacked, and bucket, what became of them. Rows to translate, or translated badly, go out: rich-text trees by their texts, values beyond most_tokens in parts, equal texts of a batch once. What comes back is
    put together again. Fields to keep get their source; parts that do not come back leave the row as it is; a handle equal to its source is emptied. done: (id, translation) of an earlier run."""
    sorted_ = rows.row_buckets(table, None if done is None else done.select("id"), overwrite)
    asked = sorted_.filter(F.col("bucket").isin("translate", "bad")).select(F.col(order).cast("string").alias("_id"), F.col(rows.SOURCE).alias("_v"))
    fields = rows.tree_fields(asked, "_id", "_v")
    parts = rows.cut_fields(fields, "id", "value", most_tokens)
    back = changes.translated_fields(parts.select("parent", "part", "n_parts", "value"), translate)
    whole = rows.joined_fields(back.filter("translation is not null").select("parent", "part", "n_parts", F.col("translation").alias("value"))).filter("whole")
    met = fields.select("parent", "path", "id").join(whole.select("id", "value"), "id")
    made = rows.apply_tree_fields(asked, "_id", "_v", met.select("parent", "path", "value")).select(F.col("_id").alias("_rid"), F.col("translation").alias("_new"))
    out = sorted_.join(made, F.col(order).cast("string") == F.col("_rid"), "left").drop("_rid")
    if done is not None:
        earlier = done.groupBy(F.col("id").alias("_fid")).agg(F.max("translation").alias("_old"))
        out = out.withColumn("_fid", rows.field_id()).join(earlier, "_fid", "left").drop("_fid")
    else:
        out = out.withColumn("_old", F.lit(None).cast("string"))
    source, target = F.col(rows.SOURCE), F.col(rows.TARGET)
    final = F.when(F.col("bucket") == "keep", source).when(F.col("bucket") == "from_previous", F.coalesce("_old", target)).otherwise(F.coalesce("_new", target))
    same_handle = (F.col(rows.FIELD) == "handle") & (text.stripped(final) == text.stripped(source))
    return out.withColumn("Translated content", F.when(same_handle, "").otherwise(final)).drop("_new", "_old")


def validate_rows(table: DataFrame, order: str = "_row") -> DataFrame:
    """(row, source, reason): the strongest finding of each row that takes part in validation: structural faults, sources of one translation that differ, and rows whose translation fits a neighbour's source better."""
    open_ = table.filter(classify.removal_reason(F.col(rows.FIELD), F.col(rows.SOURCE)).isNull())
    visible = lambda c: F.coalesce(trees.rich_text(F.when(F.col(c).startswith("{"), F.col(c))), text.visible_text(F.col(c)))
    seen = open_.select(F.col(order).alias("row"), F.col("Type"), F.col("Identification"), F.col("Field").alias("_f"), visible(rows.SOURCE).alias("_s"), visible(rows.TARGET).alias("_t"), F.col(rows.TARGET).alias("_raw"))
    issue = classify.script_issue(F.col("_f"), F.substring("_s", 1, 300), F.substring("_t", 1, 300), F.col("_raw"))
    script = seen.select("row", issue.alias("_i")).filter("_i is not null").select("row", F.concat(F.lit("script_"), F.col("_i.severity")).alias("source"), F.col("_i.reason").alias("reason"))
    cut = seen.select("row", F.substring("_s", 1, 200).alias("_s"), F.substring("_t", 1, 500).alias("_t"))
    double = changes.dissimilar_sources(cut, "row", "_s", "_t").select("row", F.lit("duplicate").alias("source"), F.lit("duplicate Arabic for different English").alias("reason"))
    words = F.array_distinct(F.filter(F.split(F.lower(F.substring("_s", 1, 150)), r"(?U)\s+"), lambda w: w != ""))
    latin = F.array_distinct(F.regexp_extract_all(F.lower(F.substring("_t", 1, 150)), F.lit("([a-z]{2,})"), 1))
    placed = seen.filter((F.length("_s") >= 10) & (F.length("_t") >= 5)).withColumn("_w", words).withColumn("_l", latin)
    shifted = sequence.shifted_rows(placed, ["Type", "Identification"], "row", F.col("_w"), F.col("_l"), keep="row")
    moved = shifted.select("row", F.lit("heuristic").alias("source"), F.lit("translation fits a neighbour").alias("reason"))
    return audit.strongest_finding(script.unionByName(double).unionByName(moved), "row", RANKS)


def audit_fix_verify(fields: DataFrame, translate: Translate) -> tuple[DataFrame, DataFrame]:
    """(fields with their new translations and status, (status, before, after, delta)): fields whose translation is missing or not good are translated anew, one that comes back replaces the old, and all are judged again."""
    before = changes.checked_fields(fields)
    keys = ["resource_id", "key"]
    poor = before.filter(~F.col("status").isin("OK", "SKIP")).select(*keys, "value")
    nodes = rows.tree_fields(poor.withColumn("_id", F.concat_ws("|", *keys)), "_id", "value")
    back = changes.translated_fields(nodes, translate).filter("translation is not null").select("parent", "path", F.col("translation").alias("value"))
    made = rows.apply_tree_fields(poor.withColumn("_id", F.concat_ws("|", *keys)), "_id", "value", back).select(*keys, F.col("translation").alias("_new"))
    fixed = fields.join(made, keys, "left").withColumn("outdated", F.col("outdated") & F.col("_new").isNull()).withColumn("translation", F.coalesce("_new", "translation")).drop("_new")
    after = changes.checked_fields(fixed)
    return after, audit.run_delta(before, after, "status")
