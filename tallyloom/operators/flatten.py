"""Nested documents as a long field relation and back, and the references they hold."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def field_rows(df: DataFrame, key: Column, scalars: list[str], lists: dict[str, list[str]] | None = None) -> DataFrame:
    """(field_id, value): a row for each scalar and for each field of each element of a list of structs, blanks left out.

    Ids are key.field and key.<list><place>.field. One projection and one explode, without a join.
    """

    def pair(i: Column, v: Column) -> Column:
        return F.struct(F.concat_ws(".", key, i).alias("field_id"), v.cast("string").alias("value"))

    def element(name: str, fields: list[str]):
        return lambda x, k: F.array(*[pair(F.concat(F.lit(name), k.cast("string"), F.lit(f".{f}")), x[f]) for f in fields])

    groups = [F.array(*[pair(F.lit(c), F.col(c)) for c in scalars])]
    for name, fields in (lists or {}).items():
        items = F.transform(F.col(name), element(name, fields))
        groups.append(F.coalesce(F.flatten(items), F.array().cast("array<struct<field_id:string,value:string>>")))
    rows = df.select(F.explode(F.flatten(F.array(*groups))).alias("_f")).select("_f.*")
    return rows.filter("value is not null and trim(value) <> ''")


def apply_values(df: DataFrame, key: Column, fields: list[str], values: DataFrame) -> DataFrame:
    """Writes a field relation (field_id, value) back over scalar fields; fields without a value stay."""
    wanted = values.select(F.regexp_extract("field_id", r"^(.*)\.([^.]+)$", 1).alias("_key"), F.regexp_extract("field_id", r"^(.*)\.([^.]+)$", 2).alias("_field"), "value")
    wide = wanted.groupBy("_key").pivot("_field", fields).agg(F.max("value"))
    new = wide.select("_key", *[F.col(f).alias(f"_new_{f}") for f in fields])
    joined = df.withColumn("_key", key).join(new, "_key", "left")
    return joined.select(*[F.coalesce(f"_new_{c}", F.col(c).cast("string")).alias(c) if c in fields else F.col(c) for c in df.columns])


def references(value: Column) -> Column:
    """Global ids of a value: of a JSON array its id strings, of a single id itself, else none."""
    listed = F.filter(F.from_json(value, "array<string>"), lambda x: x.startswith("gid://"))
    one = F.when(value.startswith("gid://"), F.array(value))
    return F.coalesce(F.when(value.startswith("["), listed), one, F.array().cast("array<string>"))


def edges(df: DataFrame, from_type: str, from_id: str, field: str, to_type: str, to_id: str) -> DataFrame:
    """(from_type, from_id, field, to_type, to_id), one row per reference."""
    return df.select(F.lit(from_type).alias("from_type"), F.col(from_id).cast("long").alias("from_id"), F.lit(field).alias("field"), F.lit(to_type).alias("to_type"), F.col(to_id).cast("long").alias("to_id"))
