"""Two stores compared and one prepared from the other: paths, menus, pages, images, metafields, places, prices."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import language, text

# Kinds of menu items that lead to something with a handle: part of the id, part of the path before the handle, and the id of the target.
MENU_TARGETS = (("/Collection/", "collections", "gid://shopify/Collection/"), ("/Page/", "pages", "gid://shopify/OnlineStorePage/"), ("/OnlineStorePage/", "pages", "gid://shopify/OnlineStorePage/"), ("/Product/", "products", "gid://shopify/Product/"))
# Beginnings of English names of places that may be left out, and signs within them.
PLACE_BEGINNINGS, PLACE_SIGNS = ("al ", "al-"), "['ʿʾ]"


def empty(c: Column) -> Column:
    return text.blank(text.stripped(c))


def article_paths(source: DataFrame, target: DataFrame) -> DataFrame:
    """source, target: (id, blog_handle, handle). (old, new): paths of articles that moved, by id; articles with a blank handle or blog on either side are left out. Of several target rows of one id the largest counts."""
    path = lambda: F.when(~text.blank(F.col("blog_handle")) & ~text.blank(F.col("handle")), F.concat(F.lit("/blogs/"), F.col("blog_handle"), F.lit("/"), F.col("handle")))
    new = target.select("id", path().alias("new")).groupBy("id").agg(F.max("new").alias("new"))
    return source.select("id", path().alias("old")).join(new, "id").filter(F.col("old") != F.col("new")).select("old", "new").distinct()


def resolved_menu_items(items: DataFrame, known: DataFrame, hosts: list[str]) -> DataFrame:
    """items: (menu, pos, title, url, resource_id); known: (kind, handle, id), kind being collections, pages or products. (menu, pos, title, resource_id, url): the target's id of what has the handle that follows the kind in
    the address, else the address without these hosts, with a slash in front. Items that lead to none of these kinds keep their address, without hosts too. A blank address is null."""
    kind = F.lit(None)
    begin = F.lit(None)
    for part, path, gid in reversed(MENU_TARGETS):
        kind = F.when(F.col("resource_id").contains(part), path).otherwise(kind)
        begin = F.when(F.col("resource_id").contains(part), gid).otherwise(begin)
    parts = F.split(F.regexp_replace("url", "/+$", ""), "/")
    at = F.array_position(parts, F.col("_kind"))
    shown = F.col("url")
    for host in hosts:
        shown = F.replace(shown, F.lit(host), F.lit(""))
    path = F.when(text.blank(F.col("url")), None).when(shown.startswith("/"), shown).otherwise(F.concat(F.lit("/"), shown))
    told = items.withColumn("_kind", kind).withColumn("_begin", begin).withColumn("_handle", F.when(at > 0, F.get(parts, at.cast("int"))))
    ids = known.groupBy(F.col("kind").alias("_kind"), F.col("handle").alias("_handle")).agg(F.min("id").alias("_id"))
    met = told.join(ids, ["_kind", "_handle"], "left")
    found = F.concat(F.col("_begin"), F.col("_id").cast("string"))
    return met.select("menu", "pos", "title", found.alias("resource_id"), F.when(found.isNull(), path).alias("url"))


def mapped_differences(left: DataFrame, right: DataFrame, handles: DataFrame, fields: list[str]) -> DataFrame:
    """left, right: (handle, fields), handles unique; handles: (old, new), old unique. (handle, matched, verdict, differing): for each left row missing, or same or differs, by the fields of the right row of its handle or, failing that, of its new one; and
    only_right for right rows that no left row has come to. A field is told to differ by value, null being like blank."""
    l = left.join(handles.select(F.col("old").alias("handle"), F.col("new").alias("_new")), "handle", "left")
    r = right.select(F.col("handle").alias("_at"), F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in fields]).alias("_r"))
    direct = l.join(r.select(F.col("_at").alias("handle"), F.col("_r").alias("_r1")), "handle", "left")
    both = direct.join(r.select(F.col("_at").alias("_new"), F.col("_r").alias("_r2")), "_new", "left")
    there = F.coalesce("_r1", "_r2")
    differing = F.array_compact(F.array(*[F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != there[c], F.lit(c)) for c in fields]))
    matched = F.when(F.col("_r1").isNotNull(), F.col("handle")).when(F.col("_r2").isNotNull(), F.col("_new"))
    out = both.select("handle", matched.alias("matched"), F.when(matched.isNull(), "missing").when(F.size(differing) > 0, "differs").otherwise("same").alias("verdict"), F.when(matched.isNotNull(), differing).alias("differing"))
    seen = out.select(F.col("matched").alias("_at")).union(left.select("handle")).distinct()
    none = F.lit(None).cast("array<string>").alias("differing")
    return out.unionByName(r.join(seen, "_at", "left_anti").select(F.lit(None).cast("string").alias("handle"), F.col("_at").alias("matched"), F.lit("only_right").alias("verdict"), none))


def bare_path(url: Column) -> Column:
    """What follows the last .com of an address, without /en in front and slashes at both ends."""
    return F.regexp_replace(F.regexp_replace(F.element_at(F.split(F.coalesce(url, F.lit("")), r"\.com"), -1), "^/en/", "/"), "^/+|/+$", "")


def navigation_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """left, right: (menu, pos, title, url, n_children). (menu, pos, title, verdict): for each left item missing_menu, missing, children (another number of them) or same, by the first right item of its menu whose path is the same."""
    first = right.groupBy("menu", bare_path(F.col("url")).alias("_p")).agg(F.min(F.struct("pos", "n_children")).alias("_r"))
    menus = right.select("menu").distinct().withColumn("_there", F.lit(True))
    met = left.withColumn("_p", bare_path(F.col("url"))).join(first, ["menu", "_p"], "left").join(menus, "menu", "left")
    verdict = F.when(F.col("_there").isNull(), "missing_menu").when(F.col("_r").isNull(), "missing").when(F.col("n_children") != F.col("_r.n_children"), "children").otherwise("same")
    return met.select("menu", "pos", "title", verdict.alias("verdict"))


def without_members(groups: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Groups that no member refers to: collections without products."""
    return groups.join(members.select(key), key, "left_anti")


def image_alts(local: DataFrame, target: DataFrame) -> DataFrame:
    """local: (handle, alts), alternative texts in the images' order; target: (handle, image_id, pos), pos from 0. (image_id, alt): texts by position where there is one. Of local rows of one handle the largest counts."""
    by = local.groupBy("handle").agg(F.max("alts").alias("_a")).select("handle", F.posexplode("_a").alias("pos", "alt")).filter(~text.blank(F.col("alt")))
    return target.join(by, ["handle", "pos"]).select("image_id", "alt")


def metafield_translations(metafields: DataFrame, content: DataFrame, local: DataFrame, done: DataFrame) -> DataFrame:
    """metafields: (id, handle, key, value, type); content: (id, english, digest, translation); local: (handle, key, translation); done: (id). (id, handle, key, english, digest, translation, action): upload with a local translation, else translate.

    References, blank values, those without a handle, that are done, have no text or digest or are translated already, are left out; a local translation that is the English text itself is none."""
    open_ = metafields.filter(~empty(F.col("value")) & ~F.coalesce(F.col("type").contains("reference"), F.lit(False)) & ~text.blank(F.col("handle"))).join(done, "id", "left_anti")
    there = content.filter(~text.blank(F.col("english")) & ~text.blank(F.col("digest")) & empty(F.col("translation"))).select("id", "english", "digest")
    own = local.filter(~empty(F.col("translation"))).groupBy("handle", "key").agg(F.max("translation").alias("translation"))
    met = open_.select("id", "handle", "key").join(there, "id").join(own, ["handle", "key"], "left")
    use = F.when(F.col("translation") != F.col("english"), F.col("translation"))
    return met.select("id", "handle", "key", "english", "digest", use.alias("translation"), F.when(use.isNotNull(), "upload").otherwise("translate").alias("action"))


def unmatched_translations(fields: DataFrame, matched: DataFrame, keys: list[str]) -> DataFrame:
    """Fields that have a translation though none of the matched keys is theirs: what may be removed."""
    return fields.filter(F.col("has_translation") & ~empty(F.col("translation"))).join(matched.select(*keys), keys, "left_anti")


def place_names(places: DataFrame, regions: DataFrame) -> DataFrame:
    """places, regions: (name_en, name_ar, ord). (spelling, name): spellings of places by which they are looked up, in lower case: the English name as it is, without signs and without its article, and the Arabic one; of regions the names
    alone. A later place or region has a spelling before an earlier one, and regions before places. name is the English one or, without it, the Arabic."""
    en, ar = text.stripped(F.coalesce("name_en", F.lit(""))), text.stripped(F.coalesce("name_ar", F.lit("")))
    low = F.lower(en)
    name = F.when(en != "", en).otherwise(ar)
    less = [F.when(low.startswith(b), F.substring(low, len(b) + 1, 1 << 20)) for b in PLACE_BEGINNINGS]
    spelled = lambda more: F.array_distinct(F.filter(F.array_compact(F.array(low, ar, *more)), lambda s: s != ""))
    both = places.select(F.lit(0).alias("_k"), "ord", name.alias("name"), F.explode(spelled([F.regexp_replace(low, PLACE_SIGNS, ""), *less])).alias("spelling"))
    both = both.unionByName(regions.select(F.lit(1).alias("_k"), "ord", name.alias("name"), F.explode(spelled([])).alias("spelling")))
    return both.groupBy("spelling").agg(F.max_by("name", F.struct("_k", "ord")).alias("name"))


def place_of(rows: DataFrame, city: str, names: DataFrame, fixed: DataFrame, candidates) -> DataFrame:
    """Adds place and step: fixed, if one of the candidate spellings is in fixed (spelling, name), else known, if one is in names, else null. candidates: a column function from a city to an array of spellings in the order they are tried; the first
    that is found counts. fixed goes before names for each spelling in turn."""
    asked = rows.select(city).distinct().select(city, F.posexplode(candidates(F.col(city))).alias("_at", "spelling"))
    index = fixed.select("spelling", F.lit(0).alias("_k"), F.col("name").alias("_n")).unionByName(names.select("spelling", F.lit(1).alias("_k"), F.col("name").alias("_n")))
    best = asked.join(index, "spelling").groupBy(city).agg(F.min(F.struct("_at", "_k", "_n")).alias("_b"))
    met = rows.join(best.withColumnRenamed(city, "_city"), F.col(city) == F.col("_city"), "left").drop("_city")
    return met.withColumn("place", F.col("_b._n")).withColumn("step", F.when(F.col("_b._k") == 0, "fixed").when(F.col("_b._k") == 1, "known")).drop("_b")


def spanish_by_prefix(fields: DataFrame) -> DataFrame:
    """fields: (key, value). (prefix, n) of values that are still Spanish by the first part of their key; handles and scientific names are not looked at."""
    open_ = fields.filter(~F.col("key").endswith(".handle") & ~F.col("key").endswith(".inci_name") & language.is_spanish(F.col("value")))
    return open_.groupBy(F.substring_index("key", ".", 1).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))


def images_by_sku(products: DataFrame, images: DataFrame) -> DataFrame:
    """products: (id, skus, images), skus in their order; images: (sku, images), sku unique. (id, images) of products whose first sku that is not blank has other images, one at least."""
    first = F.get(F.filter("skus", lambda s: ~text.blank(s)), F.lit(0))
    met = products.select("id", first.alias("sku"), F.col("images").alias("_was")).join(images, "sku")
    return met.filter((F.size("images") > 0) & ~F.col("images").eqNullSafe(F.col("_was"))).select("id", "images")


def prices_by_handle(prices: DataFrame, variants: DataFrame) -> DataFrame:
    """prices: (handle, price), handle unique; variants: (product_id, handle, variant_id). (handle, variant_id, price, found): new prices of all variants of the first product, by id, that has the handle; found is false, and the rest null, where none has."""
    first = variants.groupBy("handle").agg(F.min("product_id").alias("product_id"))
    own = variants.join(first, ["handle", "product_id"]).select("handle", "variant_id")
    met = prices.join(own, "handle", "left")
    return met.select("handle", "variant_id", F.when(F.col("variant_id").isNotNull(), F.col("price")).alias("price"), F.col("variant_id").isNotNull().alias("found"))


def group_links(members: DataFrame, groups: DataFrame, products: DataFrame) -> DataFrame:
    """members: (url_key, sku); groups: (url_key, id); products: (sku, id). (group_id, product_id): links by both keys, each once; what has no counterpart makes none."""
    g, p = groups.select("url_key", F.col("id").alias("group_id")), products.select("sku", F.col("id").alias("product_id"))
    return members.filter(~text.blank(F.col("url_key")) & ~text.blank(F.col("sku"))).join(g, "url_key").join(p, "sku").select("group_id", "product_id").distinct()
