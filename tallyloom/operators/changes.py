"""What has to change in one store so that it holds what another does: fields and their state, plans of updates in batches, findings of checks.

All of these return rows that a sink can carry out; nothing here calls a store.
"""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions import classify, html, language, text, trees
from tallyloom.sources.scratch import kept

# Reference kinds of menu items by the first part of an id or path.
MENU_KINDS = {"Collection": "COLLECTION", "Product": "PRODUCT", "Page": "PAGE", "Blog": "BLOG", "Article": "ARTICLE", "collections": "COLLECTION", "products": "PRODUCT", "pages": "PAGE", "blogs": "BLOG"}


# --- fields ---------------------------------------------------------------------------------------------------------------


def translatable_fields(nodes: DataFrame, node_id: str = "resourceId", content: str = "translatableContent", translations: str = "translations") -> DataFrame:
    """(resource_id, key, value, digest, translation, outdated, has_translation) of each resource's content, with the first translation of its key. Both lists are a resource's own, so
    nothing is shuffled; resources without content have no rows."""
    own = F.get(F.filter(translations, lambda t: t["key"] == F.col("_c.key")), F.lit(0))
    listed = nodes.select(F.col(node_id).alias("resource_id"), F.explode(content).alias("_c"), F.col(translations))
    found = listed.select("resource_id", F.col("_c.key").alias("key"), F.col("_c.value").alias("value"), F.col("_c.digest").alias("digest"), own.alias("_t"))
    return found.select("resource_id", "key", "value", "digest", F.col("_t.value").alias("translation"), F.coalesce("_t.outdated", F.lit(False)).alias("outdated"), (~text.blank(F.col("_t.value"))).alias("has_translation"))


def translated_resources(fields: DataFrame) -> DataFrame:
    """(resource_id, fields): map of key and translation, of resources with one at least."""
    filled = fields.filter(text.stripped(F.coalesce("translation", F.lit(""))) != "")
    once = filled.groupBy("resource_id", "key").agg(F.max("translation").alias("_t"))
    return once.groupBy("resource_id").agg(F.map_from_entries(F.collect_list(F.struct("key", "_t"))).alias("fields"))


def checked_fields(fields: DataFrame) -> DataFrame:
    """Adds status: of the field and its translation (see classify.translation_status), then SOURCE_SPANISH for a Spanish source of 15 characters or more that is not MISSING or SKIP, HTML_BLOAT over all but these, and,
    where all is well so far, HAS_ENGLISH and HAS_SPANISH."""
    value, translated = F.col("value"), F.col("translation")
    basic = classify.translation_status(value, translated, F.col("key"), F.col("outdated"))
    open_ = ~basic.isin("SKIP", "MISSING")
    visible = language.checkable_text(translated, trees.rich_text("translation"))
    status = (
        F.when(open_ & html.has_bloat(translated), "HTML_BLOAT")
        .when(open_ & (F.length(value) >= 15) & language.is_spanish(value), "SOURCE_SPANISH")
        .when((basic == "OK") & (F.size(language.english_terms(visible)) > 0), "HAS_ENGLISH")
        .when((basic == "OK") & language.keeps_spanish(visible), "HAS_SPANISH")
        .otherwise(basic)
    )
    return fields.withColumn("status", status)


def missing_rows(rows: DataFrame, owner: str, key: str, wanted: list[dict]) -> DataFrame:
    """rows, and for each owner those of `wanted` (its key among them) whose key it lacks. Other columns of rows are null there."""
    each = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in w.items()]) for w in wanted])
    added = rows.select(owner).distinct().select(owner, F.explode(each).alias("_w")).select(owner, "_w.*")
    return rows.unionByName(added.join(rows.select(owner, key), [owner, key], "left_anti"), allowMissingColumns=True)


def resolved(values: DataFrame, column: str, known: DataFrame, mark: str = "RESOLVE:") -> DataFrame:
    """known: (name, id). Values mark + name become the id, empty if it is not known; others stay."""
    name = F.when(F.col(column).startswith(mark), F.substring(F.col(column), len(mark) + 1, 1 << 30))
    met = values.withColumn("_name", name).join(known.groupBy(F.col("name").alias("_name")).agg(F.max("id").alias("_id")), "_name", "left")
    return met.withColumn(column, F.when(F.col("_name").isNotNull(), F.coalesce("_id", F.lit(""))).otherwise(F.col(column))).drop("_name", "_id")


def menu_kind(url: Column, gid: Column) -> Column:
    """Kind of a menu item: of its id, else of its path; FRONTPAGE for the root, HTTP for anything else."""
    names = F.create_map(*[F.lit(x) for pair in MENU_KINDS.items() for x in pair])
    path = text.path_of(url)
    part = F.nullif(F.regexp_extract(path, "^/([^/]+)/", 1), F.lit(""))
    article = path.rlike("^/blogs/[^/]+/[^/]+")
    return F.coalesce(F.element_at(names, F.regexp_extract(gid, "^gid://[^/]+/([^/]+)/", 1)), F.when(article, "ARTICLE"), F.element_at(names, part), F.when(path.isin("", "/"), "FRONTPAGE"), F.lit("HTTP"))


# --- plans of updates -------------------------------------------------------------------------------------------------------


def batches(rows: DataFrame, group: str, order: str, size: int, *columns: str) -> DataFrame:
    """(group, batch, rows): rows of a group in order, `size` to a batch, as arrays of structs of the columns."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1
    numbered = rows.select(group, F.floor(place / size).cast("long").alias("batch"), F.struct(*dict.fromkeys([order, *columns])).alias("_r"))
    listed = F.transform(F.array_sort(F.collect_list("_r")), lambda r: F.struct(*[r[c].alias(c) for c in columns]))
    return numbered.groupBy(group, "batch").agg(listed.alias("rows"))


def by_owner(rows: DataFrame, owners: DataFrame) -> DataFrame:
    """rows: (resource_id, key, ...); owners: (resource_id, owner_id, owner_key). Rows of resources that have an owner go to it under its key; resources that should have one (owner_id null) are dropped."""
    met = rows.join(owners.groupBy("resource_id").agg(F.max(F.struct("owner_id", "owner_key")).alias("_o")), "resource_id", "left").filter(F.col("_o").isNull() | F.col("_o.owner_id").isNotNull())
    return met.withColumn("key", F.coalesce("_o.owner_key", "key")).withColumn("resource_id", F.coalesce("_o.owner_id", "resource_id")).select(*rows.columns)


def with_digests(changes: DataFrame, fields: DataFrame) -> DataFrame:
    """changes: (resource_id, key, translation); fields: (resource_id, key, digest). Adds digest and matched, false where the resource has no such field."""
    known = fields.groupBy("resource_id", "key").agg(F.max("digest").alias("digest"))
    return changes.join(known, ["resource_id", "key"], "left").withColumn("matched", F.col("digest").isNotNull())


def fill_empty(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, value) of source where target has the keys' row without a value, or no row; blank source values fill nothing. Of several the largest counts."""
    full = target.filter(~text.blank(text.stripped(F.col("value")))).select(*keys).distinct()
    return source.filter(~text.blank(text.stripped(F.col("value")))).groupBy(*keys).agg(F.max("value").alias("value")).join(full, keys, "left_anti")


def price_changes(variants: DataFrame, prices: DataFrame) -> DataFrame:
    """variants: (sku, price, compare_at); prices: (sku, final, regular), rounded half to even. (sku, price, compare_at) of variants whose price changes; compare_at becomes a regular price that differs, else stays."""
    known = prices.groupBy("sku").agg(F.max(F.struct(F.bround("final", 0).alias("final"), F.bround("regular", 0).alias("regular"))).alias("_p"))
    met = variants.join(known, "sku").filter(F.col("_p.final").isNotNull() & ~F.col("_p.final").eqNullSafe(F.col("price")))
    return met.select("sku", F.col("_p.final").alias("price"), F.when(F.col("_p.regular") != F.col("_p.final"), F.col("_p.regular")).otherwise(F.col("compare_at")).alias("compare_at"))


def inverse_map(mapping: DataFrame) -> DataFrame:
    """(old, new) turned round; of several olds of one new the last counts."""
    return mapping.groupBy(F.col("new").alias("old")).agg(F.max(F.col("old")).alias("new"))


def links_to_make(links: DataFrame, left: DataFrame, right: DataFrame, done: DataFrame) -> DataFrame:
    """links: (left_id, right_id); left, right: (old, new); done: (left_new, right_new). Pairs of new ids, each once, that are not made yet; links with an unmapped end are out."""
    both = links.join(left.select(F.col("old").alias("left_id"), F.col("new").alias("left_new")), "left_id").join(right.select(F.col("old").alias("right_id"), F.col("new").alias("right_new")), "right_id")
    return both.select("left_new", "right_new").distinct().join(done.select("left_new", "right_new"), ["left_new", "right_new"], "left_anti")


def creation_plan(source: DataFrame, existing: DataFrame, done: DataFrame, key: str, handle: str) -> DataFrame:
    """Adds action: done if its key was, exists if the target has its handle (and its target_id), else create. Blank handles never exist."""
    met = source.join(done.select(key, F.lit(True).alias("_done")).distinct(), key, "left")
    met = met.join(existing.filter(~text.blank(F.col(handle))).groupBy(handle).agg(F.max("target_id").alias("target_id")), handle, "left")
    return met.withColumn("action", F.when(F.col("_done"), "done").when(F.col("target_id").isNotNull(), "exists").otherwise("create")).drop("_done")


def by_name_or_handle(base: DataFrame, new: DataFrame) -> DataFrame:
    """base, new: (handle, name, value). base with the value of new's row of its name, cases aside, else of the name that its handle spells with hyphens for blanks; new values that are blank change nothing."""
    spelled = lambda c: F.lower(text.stripped(c))
    index = new.filter(~text.blank(F.col("value"))).groupBy(spelled(F.col("name")).alias("_k")).agg(F.max("value").alias("_v"))
    for name, key in (("_a", spelled(F.col("name"))), ("_b", F.replace("handle", F.lit("-"), F.lit(" ")))):
        base = base.withColumn("_key", key).join(index.select(F.col("_k").alias("_key"), F.col("_v").alias(name)), "_key", "left").drop("_key")
    return base.withColumn("value", F.coalesce("_a", "_b", "value")).drop("_a", "_b")


def to_import(rows: DataFrame, key: str, *there: DataFrame) -> DataFrame:
    """Rows whose key none of the tables (of one column each) has; rows without a key stay out."""
    left = rows.filter(~text.blank(F.col(key)))
    for table in there:
        left = left.join(table.select(F.col(table.columns[0]).alias(key)).distinct(), key, "left_anti")
    return left


def ordered_items(wanted: DataFrame, known: DataFrame) -> DataFrame:
    """wanted: (menu, parent, pos, handle); known: (handle, id). (menu, items): array of (handle, id, children) in order; unknown ones are dropped, their children with them. One level of children."""
    met = wanted.join(known.groupBy("handle").agg(F.max("id").alias("id")), "handle")
    inner = met.filter("parent is not null").groupBy("menu", F.col("parent").alias("handle")).agg(F.array_sort(F.collect_list(F.struct("pos", "handle", "id"))).alias("_c"))
    children = F.transform(F.coalesce("_c", F.array().cast("array<struct<pos:int,handle:string,id:bigint>>")), lambda c: F.struct(c["handle"].alias("handle"), c["id"].alias("id")))
    top = met.filter("parent is null").join(inner, ["menu", "handle"], "left").select("menu", "pos", "handle", "id", children.alias("children"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("pos", "handle", "id", "children"))), lambda x: F.struct(x["handle"].alias("handle"), x["id"].alias("id"), x["children"].alias("children")))
    return top.groupBy("menu").agg(listed.alias("items"))


# --- checks ---------------------------------------------------------------------------------------------------------------


def findings(rows: DataFrame, subject: str, checks: dict[str, tuple[str, Column]]) -> DataFrame:
    """checks: code -> (severity, fault). (code, severity, subject), a row for each fault found, in one pass."""
    found = F.array_compact(F.array(*[F.when(fault, F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"))) for code, (severity, fault) in checks.items()]))
    return rows.select(F.col(subject).alias("subject"), F.explode(found).alias("_f")).select("_f.*", "subject")


def absent(expected: DataFrame, actual: DataFrame, key: str, code: str) -> DataFrame:
    """Findings for expected keys that are not there."""
    return expected.select(key).distinct().join(actual.select(key), key, "left_anti").select(F.lit(code).alias("code"), F.lit("fail").alias("severity"), F.col(key).cast("string").alias("subject"))


def catalog_faults(products: DataFrame) -> DataFrame:
    """products: (id, handle, status, images, variants with price). Findings: not active, without images, a price of zero, a handle with Spanish words."""
    price = F.exists("variants", lambda v: F.coalesce(v["price"].try_cast("double") == 0, F.lit(False)))
    return findings(products, "id", {
        "not_active": ("warn", ~F.col("status").eqNullSafe("active")), "no_images": ("fail", F.coalesce(F.size("images") < 1, F.lit(True))), "zero_price": ("fail", price),
        "spanish_handle": ("warn", language.is_spanish(F.replace("handle", F.lit("-"), F.lit(" ")))),
    })


def group_differences(left: DataFrame, right: DataFrame, group: str, item: str) -> DataFrame:
    """(group, missing, extra, n_left, n_right): sorted items that only left or only right has in a group, and how many rows each has."""
    side = lambda df, name: df.groupBy(group).agg(F.collect_set(item).alias(name), F.count(F.lit(1)).alias(f"n{name}"))
    met = side(left, "_left").join(side(right, "_right"), group, "full_outer")
    none = F.array().cast(left.select(F.array(item)).schema[0].dataType)
    l, r = F.coalesce("_left", none), F.coalesce("_right", none)
    return met.select(group, F.array_sort(F.array_except(l, r)).alias("missing"), F.array_sort(F.array_except(r, l)).alias("extra"), F.coalesce("n_left", F.lit(0)).alias("n_left"), F.coalesce("n_right", F.lit(0)).alias("n_right"))


def page_differences(left: DataFrame, right: DataFrame, path: str, content: str) -> DataFrame:
    """(path, images_left, images_right, missing_links, verdict) of pages by path: missing, too_few_images (under half), other_links or same."""
    images = lambda c: F.regexp_count(c, F.lit("(?i)<img[^>]*>"))
    links = lambda c: F.array_distinct(F.regexp_extract_all(c, F.lit(r'(?i)<a\s[^>]*href="(/[^"#?]*)'), 1))
    side = lambda df, name: df.groupBy(path).agg(F.max(content).alias(name))
    met = side(left, "_l").join(side(right, "_r"), path, "left")
    lost = F.array_except(links(F.col("_l")), links(F.coalesce("_r", F.lit(""))))
    shown = met.select(path, images(F.col("_l")).alias("images_left"), images(F.col("_r")).alias("images_right"), F.array_sort(lost).alias("missing_links"), F.col("_r").isNull().alias("_gone"))
    verdict = F.when(F.col("_gone"), "missing").when(F.col("images_right") < F.col("images_left") * 0.5, "too_few_images").when(F.size("missing_links") > 0, "other_links").otherwise("same")
    return shown.withColumn("verdict", verdict).drop("_gone")


def copied_share(left: DataFrame, right: DataFrame, key: str, fields: list[str], order: str, first: int = 5) -> DataFrame:
    """(n, n_equal, is_copy): over the first rows of right by order, how many fields that left's row of the key has too are equal; a copy if over four fifths are."""
    some = right.orderBy(order).limit(first)
    met = some.alias("r").join(left.alias("l"), key)
    equal = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")).cast("int") for c in fields]
    total = met.agg(F.coalesce(F.sum(sum((e * 0 + 1 for e in equal), F.lit(0))), F.lit(0)).alias("n"), F.coalesce(F.sum(sum(equal, F.lit(0))), F.lit(0)).alias("n_equal"))
    return total.withColumn("is_copy", F.when(F.col("n") > 0, F.col("n_equal") / F.col("n") > 0.8).otherwise(False))


def key_coverage(rows: DataFrame, keys: list[str], key: str, owner: str) -> DataFrame:
    """(key, n, total, state): how many owners have a key with a value: OK for all, MISSING for none, else PARTIAL."""
    total = rows.select(owner).distinct().count()
    counted = rows.filter(~text.blank(F.col("value"))).groupBy(key).agg(F.count_distinct(owner).alias("n"))
    wanted = rows.sparkSession.createDataFrame([(k,) for k in keys], f"{key} string").join(counted, key, "left").fillna(0, ["n"])
    return wanted.withColumn("total", F.lit(total).cast("long")).withColumn("state", F.when(F.col("n") == 0, "MISSING").when(F.col("n") >= F.col("total"), "OK").otherwise("PARTIAL"))


def dissimilar_sources(rows: DataFrame, row_id: str, source: str, translated: str, least: float = 0.3, width: int = 64) -> DataFrame:
    """Ids of rows whose translation, over 20 characters, stands for a source that shares under `least` of its words with another source of that translation. Sources under three words don't count.

    Sources of one translation that have the same words are one set. By the smallest and the largest set of its group alone most are told: sets that differ that much in size can't share enough. The others are compared with about `width`
    sets of the group, taken by hash, until one differs. Only sets that are near all of those go on to the group's other sets, which come in arrays of about `width`; no pair becomes a row, no group is sorted, and nothing is left out.
    least is 1 at most.
    """
    words = F.array_sort(F.array_distinct(F.filter(F.split(F.lower(source), r"(?U)\s+"), lambda w: w != "")))
    base = kept(rows.filter(F.length(translated) > 20).select(F.col(row_id).alias("_id"), F.col(translated).alias("_t"), words.alias("_w")).filter(F.size("_w") >= 3))
    size, hash_ = F.size("_w"), F.xxhash64("_w")
    groups = kept(base.groupBy("_t").agg(F.min(size).alias("_least"), F.max(size).alias("_most"), F.ceil(F.approx_count_distinct(hash_) / width).alias("_parts")))
    told = base.join(groups, "_t").withColumn("_differs", (F.col("_least") / size < least) | (size / F.col("_most") < least))
    rest = kept(told.filter("not _differs").select("_t", "_w").distinct())
    among = base.join(groups.select("_t", "_parts"), "_t").withColumn("_part", F.pmod(hash_, F.col("_parts")))
    far = lambda a, b: F.size(F.array_intersect(a, b)) / F.greatest(F.size(a), F.size(b)) < least
    met = lambda some, sets: some.join(sets.distinct().groupBy("_t", "_part").agg(F.collect_list("_w").alias("_others")), "_t").withColumn("_far", F.exists("_others", lambda o: far(o, F.col("_w")))).select("_t", "_w", "_far")
    seen = kept(met(rest, among.filter("_part = 0").select("_t", "_part", "_w")))
    open_ = kept(rest.join(seen.filter("_far"), ["_t", "_w"], "left_anti"))
    others = among.filter("_part > 0").join(open_.select("_t").distinct(), "_t", "left_semi").select("_t", "_part", "_w")
    found = seen.filter("_far").select("_t", "_w").unionByName(met(open_, others).filter("_far").select("_t", "_w")).distinct()
    ids = told.filter("_differs").select("_id").unionByName(told.filter("not _differs").select("_id", "_t", "_w").join(found, ["_t", "_w"]).select("_id"))
    return ids.select(F.col("_id").alias(row_id)).distinct()


# --- translation by a function ------------------------------------------------------------------------------------------------


def translated_fields(fields: DataFrame, translate: Callable[[list[str]], list[str | None]], size: int = 80, retries: int = 1) -> DataFrame:
    """fields: (id, value). Adds translation, null where none came. translate: takes texts and gives as many texts or nulls; it runs in the tasks, on `size` texts at a time, and is asked again for those that are
    missing. Equal texts of a batch are asked once; blank ones are not asked."""
    schema = T.StructType([*fields.schema.fields, T.StructField("translation", T.StringType())])

    def run(batches_: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches_:
            known: dict[str, str | None] = {}
            asked = [v for v in dict.fromkeys(batch["value"]) if v and v.strip()]
            for _ in range(1 + retries):
                for at in range(0, len(asked), size):
                    part = asked[at : at + size]
                    known.update((v, t) for v, t in zip(part, translate(part), strict=False) if t)
                asked = [v for v in asked if v not in known]
            yield batch.assign(translation=[known.get(v) for v in batch["value"]])

    return fields.mapInPandas(run, schema)
