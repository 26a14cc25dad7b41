"""Counts and maps over fields, findings and stores, each one aggregate or two."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import text

# Sources of keys that are counted by their first three parts rather than two, and how many keys a store takes.
LONG_PREFIXES, MOST_KEYS = ("theme_editor", "checkout", "shopify_system", "customer_accounts"), 3400


def key_report(fields: DataFrame, source: Column) -> DataFrame:
    """fields: (key, english, arabic, has_translation); source: of a key, a column. (source, prefix, n, n_translated, n_chars, over): by source and prefix, by source (null prefix) and in all (both null); over is how many keys of all exceed what a
    store takes, null elsewhere."""
    parts = F.when(source.isin(*LONG_PREFIXES), 3).otherwise(2)
    done = F.coalesce(F.col("has_translation"), F.lit(False)) | ~text.blank(F.col("arabic"))
    split = F.split("key", r"\.")
    told = fields.select(source.alias("source"), F.array_join(F.slice(split, F.lit(1), parts), ".").alias("prefix"), done.cast("int").alias("_d"), F.length(F.coalesce("english", F.lit(""))).alias("_c"))
    summed = told.rollup("source", "prefix").agg(F.count(F.lit(1)).alias("n"), F.sum("_d").alias("n_translated"), F.sum("_c").alias("n_chars"), F.grouping_id().alias("_g"))
    return summed.withColumn("over", F.when(F.col("_g") == 3, F.greatest(F.col("n") - MOST_KEYS, F.lit(0)))).drop("_g")


def work_estimate(gaps: DataFrame, weights: dict[str, int]) -> DataFrame:
    """gaps: (kind). (kind, n, fields): how many fields the gaps of each kind have, by what one of it has; kinds without a weight have none and are left out. The null kind is the sum."""
    weight = F.element_at(F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]), F.col("kind"))
    return gaps.withColumn("_w", weight).filter("_w > 0").rollup("kind").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_w"), F.lit(0)).cast("long").alias("fields"))


def todo_summary(rows: DataFrame, kind: str, source_language: Column, target_language: Column, same: Column) -> DataFrame:
    """(part, name, n) of translation rows: gap by kind, for rows without a target language; issue by category and todo by action for those whose translation is Spanish, or English (identical or not), and for Spanish sources under an Arabic translation."""
    spanish, english = target_language == "es", target_language == "en"
    issue = F.when(spanish, "spanish_not_translated").when(english & same, "identical_not_translated").when(english, "english_not_translated")
    todo = F.when(spanish & (source_language == "es"), "translate_es_to_ar").when(spanish | english, "translate").when((source_language == "es") & (target_language == "ar"), "fix_default_es_to_en")
    gap = F.when(target_language.isNull(), F.col(kind).cast("string"))
    found = F.array(*[F.when(name.isNotNull(), F.struct(F.lit(part).alias("part"), name.alias("name"))) for part, name in (("gap", gap), ("issue", issue), ("todo", todo))])
    return rows.select(F.explode(F.array_compact(found)).alias("_f")).groupBy("_f.part", "_f.name").agg(F.count(F.lit(1)).alias("n"))


def image_counters(products: DataFrame, entries: DataFrame) -> DataFrame:
    """products: (images); entries: (file). (counter, n): products with and without images, entries whose file is there or missing."""
    one = lambda test, a, b: F.when(F.coalesce(test, F.lit(False)), a).otherwise(b)
    both = products.select(one(F.size("images") > 0, "products_with_images", "products_missing_images").alias("counter")).unionByName(entries.select(one(~text.blank(F.col("file")), "metaobject_files_populated", "metaobject_files_missing").alias("counter")))
    return both.groupBy("counter").agg(F.count(F.lit(1)).alias("n"))


def handle_maps(kinds: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """kinds: name -> (source, target), both (id, handle). (kind, old, new): handles that differ, by id; of several target handles of one id the largest counts, blank ones are none."""
    out = None
    for kind, (source, target) in kinds.items():
        new = target.filter(~text.blank(F.col("handle"))).groupBy(F.col("id").cast("string").alias("id")).agg(F.max("handle").alias("new"))
        own = source.filter(~text.blank(F.col("handle"))).select(F.col("id").cast("string").alias("id"), F.col("handle").alias("old")).join(new, "id").filter(F.col("old") != F.col("new"))
        part = own.select(F.lit(kind).alias("kind"), "old", "new").distinct()
        out = part if out is None else out.unionByName(part)
    return out


def media_in_order(products: DataFrame, media: str = "media") -> DataFrame:
    """products with images in place of media, an array of (url, label, position): (src, alt) by position, a missing one being 0, of those with an address; positions that tie keep the array's order. Sorted within the row, nothing is shuffled."""
    placed = F.transform(media, lambda m, k: F.struct(F.coalesce(m["position"], F.lit(0)).alias("p"), k.alias("k"), m["url"].alias("src"), F.coalesce(m["label"], F.lit("")).alias("alt")))
    shown = F.transform(F.array_sort(F.filter(placed, lambda m: ~text.blank(m["src"]))), lambda m: F.struct(m["src"].alias("src"), m["alt"].alias("alt")))
    return products.withColumn("images", F.coalesce(shown, F.array().cast("array<struct<src:string,alt:string>>"))).drop(media)


def wanted_resources(nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """nodes: (resourceId, translatableContent, translations); wanted: (id). (resource_id, content, translations): maps by key of the wanted resources, of which of several entries of one key the last counts. Wanted ids that are not there have no row."""
    last = lambda name, *fields: F.map_from_entries(F.filter(F.transform(name, lambda c, k: F.when(~F.exists(F.slice(name, k + 2, F.size(name)), lambda d: d["key"] == c["key"]), F.struct(c["key"].alias("key"), F.struct(*[c[f].alias(f) for f in fields]).alias("value")))), lambda e: e.isNotNull()))
    own = nodes.join(wanted.select(F.col("id").alias("resourceId")).distinct(), "resourceId", "left_semi")
    return own.select(F.col("resourceId").alias("resource_id"), last("translatableContent", "digest", "value").alias("content"), last("translations", "value", "outdated").alias("translations"))


def entry_differences(left: DataFrame, right: DataFrame, handles: DataFrame, keys: list[str]) -> DataFrame:
    """left, right: (handle, key, value), a row for each field of an entry; handles: (old, new), old unique. (handle, key, verdict): missing (null key) for left entries that neither their handle nor its new one finds, and empty for fields of
    `keys` that left fills and the right entry doesn't."""
    entries = right.select("handle").distinct()
    named = left.select("handle").distinct().join(handles.select(F.col("old").alias("handle"), "new"), "handle", "left")
    at = named.join(entries.withColumn("_a", F.col("handle")), "handle", "left").join(entries.select(F.col("handle").alias("new"), F.col("handle").alias("_b")), "new", "left").select("handle", F.coalesce("_a", "_b").alias("_at"))
    missing = at.filter("_at is null").select("handle", F.lit(None).cast("string").alias("key"), F.lit("missing").alias("verdict"))
    full = lambda df: df.filter(F.col("key").isin(*keys) & ~text.blank(F.col("value")))
    asked = full(left).select("handle", "key").distinct().join(at.filter("_at is not null"), "handle")
    return missing.unionByName(asked.join(full(right).select(F.col("handle").alias("_at"), "key"), ["_at", "key"], "left_anti").select("handle", "key", F.lit("empty").alias("verdict")))
