"""Nested documents taken apart and put together: ids, tags, arrays of fields, templates, trees of categories, and counts over them."""

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions import classify, text, trees

# Kinds of fields that hold text, and how ids begin.
TEXT_TYPES = ("single_line_text_field", "multi_line_text_field", "rich_text_field")
ID_BEGIN = "gid://shopify/"


def global_id(kind: Column, number: Column) -> Column:
    """Id of a kind and a number, apostrophes in front of which are left out; an id stays one."""
    bare = F.regexp_replace(number, "^'+", "")
    return F.when(bare.startswith("gid://"), bare).otherwise(F.concat(F.lit(ID_BEGIN), kind, F.lit("/"), bare))


def id_type(gid: Column) -> Column:
    return F.nullif(F.regexp_extract(gid, "^gid://[^/]+/([^/]+)/", 1), F.lit(""))


def id_number(gid: Column) -> Column:
    return F.regexp_extract(gid, r"/(\d+)$", 1).try_cast("long")


def joined_tags(tags: Column, is_list: bool) -> Column:
    """Tags as one text; a list is joined, null stays null."""
    return F.array_join(tags, ", ") if is_list else tags


def field_value(fields: Column, key: str, name: str = "value") -> Column:
    """Value of the first of an array of (key, value) structs with the key; null without."""
    return F.get(F.filter(fields, lambda f: f["key"] == key), F.lit(0))[name]


def upserted(fields: Column, namespace: Column, key: Column, value: Column) -> Column:
    """An array of (namespace, key, value) with the value of the one put in its place, or at the end. A null array is empty."""
    own = F.struct(namespace.alias("namespace"), key.alias("key"), value.alias("value"))
    same = lambda f: (f["namespace"] == namespace) & (f["key"] == key)
    there = F.exists(fields, same)
    return F.when(there, F.transform(fields, lambda f: F.when(same(f), own).otherwise(f))).otherwise(F.concat(F.coalesce(fields, F.array().cast("array<struct<namespace:string,key:string,value:string>>")), F.array(own)))


def object_fields(objects: DataFrame, type_col: str, handle: str, fields: str) -> DataFrame:
    """(field_id, value) of an object's fields of text, field_id being mo.type.handle.key; blank values are out."""
    rows = objects.select(type_col, handle, F.explode(fields).alias("_f")).filter(F.col("_f.type").isin(*TEXT_TYPES) & (text.stripped(F.col("_f.value")) != ""))
    return rows.select(F.concat_ws(".", F.lit("mo"), type_col, handle, "_f.key").alias("field_id"), F.col("_f.value").alias("value"))


def values_by_document(fields: DataFrame, field_id: str, value: str, remap: DataFrame | None = None, dots: int = 1) -> DataFrame:
    """(prefix, handle, field, value) of composite ids prefix.handle.field; dots: how many parts stand before the handle. remap: (old, new) handles. Of values of one field the largest stays."""
    parts = F.split(field_id, r"\.", dots + 2)
    split = fields.filter(F.size(parts) == dots + 2).select(F.array_join(F.slice(parts, 1, dots), ".").alias("prefix"), F.get(parts, F.lit(dots)).alias("_h"), F.get(parts, F.lit(dots + 1)).alias("field"), F.col(value).alias("value"))
    if remap is not None:
        split = split.join(remap.groupBy(F.col("old").alias("_h")).agg(F.max("new").alias("_new")), "_h", "left").withColumn("_h", F.coalesce("_new", "_h"))
    return split.groupBy("prefix", F.col("_h").alias("handle"), "field").agg(F.max("value").alias("value"))


def field_maps(values: DataFrame, keys: list[str]) -> DataFrame:
    """values: (keys, field, value). (keys, fields): map by field; of values of one field the largest, as a map has each key once."""
    once = values.groupBy(*keys, "field").agg(F.max("value").alias("value"))
    return once.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("fields"))


def new_handles(objects: DataFrame, type_col: str, handle: str, name: str, explicit: Column, order: str) -> DataFrame:
    """Handles made from names, but for those given explicitly or without a name; of objects of a type with one handle the first stays, all without one do."""
    slug = trees.ascii_slug(F.col(name))
    made = objects.withColumn(handle, F.when(explicit | text.blank(F.col(name)), F.col(handle)).otherwise(slug))
    first = made.filter(~text.blank(F.col(handle))).groupBy(type_col, handle).agg(F.min(order).alias("_first"))
    return made.join(first, [type_col, handle], "left").filter(F.col("_first").isNull() | (F.col(order) == F.col("_first"))).select(*objects.columns)


def overlaid(base: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """base with values of new, by key, wherever they are not blank; rows that only new has are added. Both have the same columns; new has each key once."""
    fields = [c for c in base.columns if c != key]
    met = base.join(new.select(key, *[F.col(f"`{c}`").alias(f"_new_{k}") for k, c in enumerate(fields)]), key, "full_outer")
    filled = lambda k: F.nullif(F.col(f"_new_{k}").cast("string"), F.lit(""))
    return met.select(key, *[F.coalesce(F.when(filled(k).isNotNull(), F.col(f"_new_{k}")), F.col(f"`{c}`")).alias(c) for k, c in enumerate(fields)])


_SETTINGS = "struct<type:string,settings:map<string,string>>"
TEMPLATE = f"struct<sections:map<string,struct<type:string,settings:map<string,string>,blocks:map<string,{_SETTINGS}>>>>"


def template_images(templates: DataFrame, template: str, *keep: str) -> DataFrame:
    """(keep, section_id, section_type, block_id, block_type, setting_key, value, preset): image settings of templates' sections and blocks that have a value. What is no template has none."""
    parsed = templates.select(*keep, F.explode(F.from_json(template, TEMPLATE)["sections"]).alias("section_id", "_s"))
    section = F.coalesce(F.col("_s.type"), F.lit("unknown"))
    own = parsed.select(*keep, "section_id", section.alias("section_type"), F.lit(None).cast("string").alias("block_id"), F.lit(None).cast("string").alias("block_type"), F.explode("_s.settings").alias("setting_key", "value"))
    blocks = parsed.select(*keep, "section_id", section.alias("section_type"), F.explode("_s.blocks").alias("block_id", "_b"))
    inner = blocks.select(*keep, "section_id", "section_type", "block_id", F.coalesce("_b.type", F.lit("unknown")).alias("block_type"), F.explode("_b.settings").alias("setting_key", "value"))
    icon = F.col("block_id").isNotNull() & (F.lower("block_type").contains("icon") | F.lower("setting_key").contains("icon"))
    preset = F.when(icon, "icon").otherwise(classify.image_preset(F.col("section_type"), F.col("setting_key")))
    return own.unionByName(inner).filter(classify.is_image_setting(F.col("setting_key")) & ~text.blank(F.col("value"))).withColumn("preset", preset)


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("path", T.ArrayType(T.IntegerType())), T.StructField("url_key", T.StringType()), T.StructField("name", T.StringType()), T.StructField("product_count", T.LongType())])))
def category_rows(values: pd.Series) -> pd.Series:
    """Categories of a JSON tree, parents before children, in order; those without products and children are left out. path: places from the root."""

    def one(value):
        try:
            todo = [((k,), c) for k, c in reversed(list(enumerate(json.loads(value))))]
        except (TypeError, ValueError):
            return []
        out = []
        while todo:
            path, node = todo.pop()
            children = node.get("children") or []
            if node.get("product_count", 0) or children:
                out.append({"path": list(path), "url_key": node.get("url_key"), "name": node.get("name"), "product_count": node.get("product_count", 0)})
                todo += [((*path, k), c) for k, c in reversed(list(enumerate(children)))]
        return out

    return values.map(one)


def by_prefix(fields: DataFrame, key: str, value: str, parts: int) -> DataFrame:
    """(prefix, n, n_filled, n_chars) of values by the first parts of their dotted keys."""
    filled = ~text.blank(F.col(value))
    return fields.groupBy(F.substring_index(F.col(key), ".", parts).alias("prefix")).agg(F.count(F.lit(1)).alias("n"), F.count_if(filled).alias("n_filled"), F.sum(F.length(value)).alias("n_chars"))


def missing_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field, n_missing, n, percent) of null or empty values, in one pass."""
    counted = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(text.blank(F.col(f"`{c}`").cast("string"))).alias(f"_{k}") for k, c in enumerate(fields)])
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"_{k}").alias("n_missing")) for k, c in enumerate(fields)])
    return counted.select(F.explode(pairs).alias("_p"), "n").select("_p.field", "_p.n_missing", "n", F.when(F.col("n") > 0, 100.0 * F.col("_p.n_missing") / F.col("n")).otherwise(0.0).alias("percent"))


def batch_cost(df: DataFrame, group: str, value: str, size: int) -> DataFrame:
    """(group, n, batches, tokens): batches of `size` rows, one at least, and the tokens of all values."""
    tokens = text.estimated_tokens(F.coalesce(F.col(value), F.lit("")))
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / size)).cast("long").alias("batches"), F.sum(tokens).cast("long").alias("tokens"))


def append_new(first: DataFrame, more: DataFrame, key: str) -> DataFrame:
    """Rows of first, and those of more whose key it lacks."""
    return first.unionByName(more.join(first.select(key).distinct(), key, "left_anti"))


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    """Whether both hold the same rows, as often. A difference ends the search early."""
    return left.columns == right.columns and left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def by_rank(df: DataFrame, name: str, ranks: list[str], order: str) -> DataFrame:
    """Rows by the place of their name in ranks, others last, then by order."""
    place = F.array_position(F.array(*map(F.lit, ranks)), F.col(name))
    return df.orderBy(F.when(place > 0, place).otherwise(999), order)


def price_map(items: DataFrame, order: str) -> DataFrame:
    """items: (sku, name, final_price, regular_price, currency, order). One row per sku, the last; prices rounded half to even, a missing regular price being the final one. Blank skus are out."""
    last = items.filter(~text.blank(F.col("sku"))).groupBy("sku").agg(F.max_by(F.struct("name", "final_price", "regular_price", "currency"), order).alias("_p"))
    whole = lambda c: F.bround(c, 0).cast("long")
    return last.select("sku", "_p.name", whole(F.col("_p.final_price")).alias("final_price"), whole(F.coalesce("_p.regular_price", "_p.final_price")).alias("regular_price"), "_p.currency")


def media_by_key(media: DataFrame, key: str, url: str, position: str) -> DataFrame:
    """(key, urls) in order of position, each url once, at its first place."""
    first = media.filter(~text.blank(F.col(url))).groupBy(key, url).agg(F.min(position).alias("_at"))
    return first.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", url))), lambda m: m[url]).alias("urls"))


def sitemap_urls(files: DataFrame, content: str) -> DataFrame:
    """(kind, url) of the addresses that saved sitemaps list: sitemap for further sitemaps, product, category, blog or page by their paths; each once."""
    urls = files.select(F.explode(F.regexp_extract_all(content, F.lit(r"(?s)<loc>\s*(.*?)\s*</loc>"), 1)).alias("url")).distinct()
    path = F.lower("url")
    kind = F.when(path.rlike(r"\.xml(\.gz)?$"), "sitemap").when(path.rlike("/products?/|\\.html$"), "product").when(path.rlike("/(collections|category|categories)/"), "category").when(path.contains("/blog"), "blog").otherwise("page")
    return urls.select(kind.alias("kind"), "url")


def key_sets(rows: DataFrame, key: str, item: str) -> DataFrame:
    """(key, items): sorted distinct items of each key, blanks aside."""
    return rows.filter(~text.blank(F.col(key).cast("string")) & ~text.blank(F.col(item).cast("string"))).groupBy(key).agg(F.array_sort(F.collect_set(item)).alias("items"))


def weighted_outcomes(df: DataFrame, value: str, outcome: Column) -> DataFrame:
    """(outcome, n_values, n_rows): distinct values and rows by what becomes of a value; the outcome is found once a value."""
    counted = df.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    return counted.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n_values"), F.sum("_n").alias("n_rows"))


def key_budget(fields: DataFrame, category: Column, most: int = 3400) -> DataFrame:
    """(category, n, n_translated, over): fields by category, and under the null category all; over is how many translated ones exceed the budget."""
    filled = ~text.blank(F.col("translation"))
    counted = fields.withColumn("_c", category).rollup("_c").agg(F.count(F.lit(1)).alias("n"), F.count_if(filled).alias("n_translated"))
    return counted.select(F.col("_c").alias("category"), "n", "n_translated", F.greatest(F.col("n_translated") - most, F.lit(0)).alias("over"))


def pruned(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """A nested JSON column without the dotted keys of `keys` (one column, a list that fits a task's memory, as a locale file's does), and without what is empty then."""
    names = [r[0] for r in keys.distinct().collect()]
    held = F.array(*map(F.lit, names)) if names else F.array().cast("array<string>")
    return df.withColumn(column, trees.nested(F.map_filter(trees.dotted(column), lambda k, _: ~F.array_contains(held, k))))


def template_texts(templates: DataFrame, template: str, is_text, *keep: str) -> DataFrame:
    """(keep, section_id, block_id, setting_key, value): settings of templates' sections and blocks that is_text, a column function, admits."""
    parsed = templates.select(*keep, F.explode(F.from_json(template, TEMPLATE)["sections"]).alias("section_id", "_s"))
    own = parsed.select(*keep, "section_id", F.lit(None).cast("string").alias("block_id"), F.explode("_s.settings").alias("setting_key", "value"))
    blocks = parsed.select(*keep, "section_id", F.explode("_s.blocks").alias("block_id", "_b"))
    inner = blocks.select(*keep, "section_id", "block_id", F.explode("_b.settings").alias("setting_key", "value"))
    return own.unionByName(inner).filter(is_text(F.col("value")))


def customer_records(table: DataFrame) -> DataFrame:
    """Customers' CSV rows as (first_name, last_name, email, phone, tags, address): names from billing, else from the name, else from the address of mail."""
    from tallyloom.functions import people

    raw = lambda c: text.stripped(F.coalesce(F.col(f"`{c}`"), F.lit("")))
    named, mailed = people.split_name(raw("Name")), people.name_of_email(raw("Email"))
    first, last = people.name_case(raw("Billing Firstname")), people.name_case(raw("Billing Lastname"))
    by_name = lambda k: people.name_case(named[k])
    none = lambda a, b: (a == "") & (b == "")
    pick = lambda own, k: F.when(~none(first, last), own).when(~none(by_name("first"), by_name("last")), by_name(k)).otherwise(mailed[k])
    address = F.struct(
        F.array_join(people.address_lines(raw("Street Address")), ", ").alias("address1"), people.city_case(raw("City")).alias("city"), people.province(raw("State/Province"), raw("Country")).alias("province"),
        raw("Country").alias("country"), raw("ZIP").alias("zip"), raw("Company").alias("company"),
    )
    return table.select(
        pick(first, "first").alias("first_name"), pick(last, "last").alias("last_name"), F.lower(raw("Email")).alias("email"), people.phone(F.col("Phone")).alias("phone"),
        F.concat(F.lit("magento-import,magento-id:"), F.col("ID")).alias("tags"), address.alias("address"),
    )
