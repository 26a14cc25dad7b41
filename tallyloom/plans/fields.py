"""Queries of fields, documents, menus, plans and checks over the driver tables, each with its SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import classify, language, text
from tallyloom.operators import changes, extract, reshape, stores
from tallyloom.plans.catalog import query
from tallyloom.sources.tables import table

# --- scripts --------------------------------------------------------------------------------------------------------------

#: Turns of a conversation in Latin letters, with some or most of them Arabic, and within markup: said so in both dialects.
MIXED = """CASE turn % 5 WHEN 0 THEN text WHEN 1 THEN translate(text, 'aeiou', 'اعويه') WHEN 2 THEN translate(text, 'aeioutnrslhd', 'اعويهتنرسلحد') WHEN 3 THEN concat('<b>', text, '</b> {note ', role, '}') ELSE '' END"""
AR, LA = "[؀-ۿݐ-ݿࢠ-ࣿﭐ-﷿ﹰ-﻿]", "[a-zA-ZÀ-ÿ]"
BARE = r"trim(regexp_replace(regexp_replace(v, '<[^>]+>', ' ', 'g'), '\{[^}]*\}', ' ', 'g'))"
SCRIPT_SQL = f"""WITH m AS (SELECT conv_id, turn, role, {MIXED} AS v FROM conversations),
c AS (SELECT *, len(regexp_extract_all(v, '{AR}')) AS ar, len(regexp_extract_all(v, '{LA}')) AS la, len(regexp_extract_all({BARE}, '{AR}')) AS bar, len(regexp_extract_all({BARE}, '{LA}')) AS bla, trim(v) AS tv FROM m)
"""


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.expr(MIXED).alias("v"))


@query("t02_has_script", SCRIPT_SQL + "SELECT conv_id, turn, CASE WHEN v = '' THEN false WHEN bar + bla = 0 THEN true ELSE bar / (bar + bla) >= 0.3 END AS arabic FROM c")
def t02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(spark, sf_dir).select("conv_id", "turn", text.has_script(F.col("v")).alias("arabic"))


@query("t03_foreign_share", SCRIPT_SQL + "SELECT conv_id, turn, coalesce(la / nullif(la + ar, 0) > 0.15, false) AS english FROM c")
def t03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(spark, sf_dir).select("conv_id", "turn", text.has_foreign_share(F.col("v")).alias("english"))


@query(
    "t04_visibly_arabic",
    SCRIPT_SQL + r"""SELECT conv_id, turn, length(tv) < 3 OR regexp_matches(tv, '^(?:\d+|[A-Z]{2,5}$|©|@|\+\d|INCI|pH\s)') OR ar + la < 3 OR la = 0 OR ar / (ar + la) >= 0.4 AS fine FROM c""",
)
def t04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(spark, sf_dir).select("conv_id", "turn", language.is_visibly_arabic(F.col("v")).alias("fine"))


@query(
    "t07_language",
    SCRIPT_SQL + r"""SELECT conv_id, turn, CASE WHEN ar + la = 0 THEN NULL WHEN ar > la THEN 'ar'
  WHEN len(regexp_extract_all(v, '[áéíóúñ¿¡üÁÉÍÓÚÑÜ]')) >= 2 OR len(list_filter(regexp_split_to_array(lower(v), '[^\p{L}\p{N}\p{M}_]+'),
    lambda w: w IN ('de', 'del', 'los', 'las', 'con', 'para', 'por', 'una', 'que', 'cabello', 'capilar', 'champú', 'tratamiento', 'colección', 'más', 'también', 'producto', 'productos', 'cuidado'))) >= 2 THEN 'es' ELSE 'en' END AS lang FROM c""",
)
def t07(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(spark, sf_dir).select("conv_id", "turn", text.hinted_language(F.col("v")).alias("lang"))


@query(
    "f10_simple_status",
    SCRIPT_SQL + """SELECT conv_id, turn, CASE WHEN v = '' THEN 'MISSING' WHEN turn % 5 = 0 AND NOT (bar + bla = 0 OR bar / (bar + bla) >= 0.3) THEN 'IDENTICAL'
  ELSE CASE WHEN bar + bla = 0 OR bar / (bar + bla) >= 0.3 THEN 'OK' ELSE 'NOT_ARABIC' END || CASE WHEN conv_id % 3 = 0 THEN ' [OUTDATED]' ELSE '' END END AS status FROM c""",
)
def f10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text", F.nullif(F.expr(MIXED), F.lit("")).alias("v"))
    return rows.select("conv_id", "turn", extract.simple_status(F.col("text"), F.col("v"), F.col("conv_id") % 3 == 0, F.lit(None).cast("string")).alias("status"))


@query(
    "f08_upload_arabic",
    SCRIPT_SQL + f"SELECT conv_id, turn, CASE WHEN v = '' THEN false ELSE coalesce(len(regexp_extract_all({BARE}, '[؀-ۿݐ-ݿࢠ-ࣿ]')) / nullif(len(regexp_extract_all({BARE}, '[؀-ۿݐ-ݿࢠ-ࣿ]')) + bla, 0) >= 0.3, true) END AS arabic FROM c",
)
def f08(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(spark, sf_dir).select("conv_id", "turn", classify.has_arabic_for_upload(F.col("v"), F.lit(None).cast("string")).alias("arabic"))


@query("f20_untranslated", "SELECT conv_id, turn, text <> '' AND lower(trim(v)) = lower(trim(text)) AS same FROM (SELECT conv_id, turn, text, CASE turn % 3 WHEN 0 THEN translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') WHEN 1 THEN ' ' || text || ' ' ELSE text || '.' END AS v FROM conversations)")
def f20(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.when(F.col("turn") % 3 == 0, F.translate("text", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")).when(F.col("turn") % 3 == 1, F.concat(F.lit(" "), F.col("text"), F.lit(" "))).otherwise(F.concat(F.col("text"), F.lit(".")))
    none = F.lit(None).cast("string")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", classify.is_untranslated(v, F.col("text"), none, none).alias("same"))


NAMES = {"red": "أحمر", "red widget": "أداة حمراء", "small": "صغير", "ring": "خاتم"}


@query("t20_names", "SELECT p_partkey, " + "".join(["regexp_replace("] * 4) + "p_name, 'red widget', 'أداة حمراء', 'gi'), 'small', 'صغير', 'gi'), 'ring', 'خاتم', 'gi'), 'red', 'أحمر', 'gi') AS name FROM part")
def t20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", language.names_replaced(F.col("p_name"), NAMES).alias("name"))


@query("t21_names_left", "SELECT p_partkey, regexp_extract_all(p_name, '(?i)(red widget|small|ring|red)') AS names FROM part")
def t21(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.transform(language.names_left(F.col("p_name"), NAMES), lambda n: n["name"]).alias("names"))


@query("f28_normal_json", "SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE json(props)::VARCHAR END AS props FROM events")
def f28(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", classify.normal_json(F.when(F.col("event_id") % 10 == 0, F.rtrim("props", F.lit("}"))).otherwise(F.col("props"))).alias("props"))


# --- documents and their fields -------------------------------------------------------------------------------------------


@query(
    "p06_object_fields",
    """SELECT DISTINCT 'mo.order.' || l_orderkey || '.line' || l_linenumber || '_' || l_partkey AS field_id, 'part ' || l_partkey AS value FROM lineitem WHERE l_linenumber % 3 <> 2 AND l_returnflag <> 'N'""",
)
def p06(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("l_linenumber") % 3 == 2, "file_reference").when(F.col("l_linenumber") % 3 == 1, "single_line_text_field").otherwise("rich_text_field")
    key = F.concat(F.lit("line"), F.col("l_linenumber").cast("string"), F.lit("_"), F.col("l_partkey").cast("string"))
    field = F.struct(key.alias("key"), F.when(F.col("l_returnflag") == "N", " ").otherwise(F.concat(F.lit("part "), F.col("l_partkey").cast("string"))).alias("value"), kind.alias("type"))
    objects = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("handle")).agg(F.collect_set(field).alias("fields")).withColumn("type", F.lit("order"))
    return reshape.object_fields(objects, "type", "handle", "fields")


@query("p07_tags", "SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS tags FROM orders GROUP BY 1")
def p07(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_set("o_orderpriority")).alias("t")).select("o_custkey", reshape.joined_tags(F.col("t"), True).alias("tags"))


@query(
    "p08_by_document",
    """WITH f AS (SELECT o_orderpriority[1:1] AS prefix, 'h' || o_custkey AS handle, 'f.' || o_orderstatus AS field, o_orderkey::VARCHAR AS value FROM orders), r AS (SELECT 'h' || c_custkey AS old, 'n' || c_nationkey AS new FROM customer WHERE c_custkey % 2 = 0)
SELECT prefix, coalesce(r.new, f.handle) AS handle, field, max(value) AS value FROM f LEFT JOIN r ON r.old = f.handle GROUP BY ALL""",
)
def p08(spark: SparkSession, sf_dir: str) -> DataFrame:
    handle = lambda c: F.concat(F.lit("h"), F.col(c).cast("string"))
    fields = table(spark, sf_dir, "orders").select(F.concat_ws(".", F.substring("o_orderpriority", 1, 1), handle("o_custkey"), F.lit("f"), "o_orderstatus").alias("field_id"), F.col("o_orderkey").cast("string").alias("value"))
    remap = table(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(handle("c_custkey").alias("old"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("new"))
    return reshape.values_by_document(fields, "field_id", "value", remap)


@query(
    "p25_overlay",
    """WITH n AS (SELECT p_partkey + 50 AS p_partkey, CASE WHEN p_size % 2 = 0 THEN '' ELSE p_brand END AS p_name, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_type END AS p_type FROM part)
SELECT coalesce(b.p_partkey, n.p_partkey) AS p_partkey, coalesce(nullif(n.p_name, ''), b.p_name) AS p_name, coalesce(n.p_type, b.p_type) AS p_type FROM part b FULL JOIN n ON n.p_partkey = b.p_partkey""",
)
def p25(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    new = table(spark, sf_dir, "part").select((F.col("p_partkey") + 50).alias("p_partkey"), F.when(F.col("p_size") % 2 == 0, "").otherwise(F.col("p_brand")).alias("p_name"), F.when(F.col("p_size") % 3 != 0, F.col("p_type")).alias("p_type"))
    return reshape.overlaid(base, new, "p_partkey")


@query("p30_resolved", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN coalesce(c.c_custkey::VARCHAR, '') ELSE o_orderstatus END AS value FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 0) c ON c.c_custkey = o_custkey")
def p30(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("RESOLVE:c"), F.col("o_custkey").cast("string"))).otherwise(F.col("o_orderstatus")).alias("value"))
    known = table(spark, sf_dir, "customer").filter("c_custkey % 3 <> 0").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("name"), F.col("c_custkey").cast("string").alias("id"))
    return changes.resolved(values, "value", known)


@query(
    "p31_menu_kind",
    """WITH u AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_linenumber WHEN 1 THEN 'https://x.y/en/collections/c' || l_partkey WHEN 2 THEN '/products/p' || l_partkey WHEN 3 THEN '/blogs/b/a' || l_partkey WHEN 4 THEN '/pages/x?y=1' WHEN 5 THEN '/' ELSE 'https://x.y/other/' END AS url,
  CASE WHEN l_linenumber = 6 THEN 'gid://shopify/Page/' || l_suppkey END AS gid FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN gid IS NOT NULL THEN 'PAGE' ELSE CASE l_linenumber WHEN 1 THEN 'COLLECTION' WHEN 2 THEN 'PRODUCT' WHEN 3 THEN 'ARTICLE' WHEN 4 THEN 'PAGE' WHEN 5 THEN 'FRONTPAGE' ELSE 'HTTP' END END AS kind FROM u""",
)
def p31(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, p = F.col("l_linenumber"), F.col("l_partkey").cast("string")
    url = F.when(n == 1, F.concat(F.lit("https://x.y/en/collections/c"), p)).when(n == 2, F.concat(F.lit("/products/p"), p)).when(n == 3, F.concat(F.lit("/blogs/b/a"), p)).when(n == 4, "/pages/x?y=1").when(n == 5, "/").otherwise("https://x.y/other/")
    gid = F.when(n == 6, F.concat(F.lit("gid://shopify/Page/"), F.col("l_suppkey").cast("string")))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", changes.menu_kind(url, gid).alias("kind"))


def resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order as a resource: its lines as content, those not of return flag N as translations."""
    key, value = F.concat(F.lit("k"), F.col("l_linenumber").cast("string")), F.col("l_partkey").cast("string")
    content = F.struct(key.alias("key"), value.alias("value"), F.concat(F.lit("d"), F.col("l_suppkey").cast("string")).alias("digest"))
    done = F.when(F.col("l_returnflag") != "N", F.struct(key.alias("key"), F.concat(F.col("l_returnflag"), value).alias("value"), (F.col("l_linestatus") == "O").alias("outdated")))
    once = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min(F.struct("l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")).alias("m")).select("l_orderkey", "l_linenumber", "m.*")
    return once.groupBy(F.col("l_orderkey").alias("resourceId")).agg(F.collect_list(content).alias("translatableContent"), F.collect_list(done).alias("translations"))


ONCE_SQL = "WITH o AS (SELECT l_orderkey, l_linenumber, min(struct_pack(p := l_partkey, s := l_suppkey, r := l_returnflag, t := l_linestatus)) AS m FROM lineitem GROUP BY ALL)\n"


@query(
    "s10_theme_keys",
    ONCE_SQL + """SELECT l_orderkey AS resource_id, 'k' || l_linenumber AS key, m.p::VARCHAR AS value, 'd' || m.s AS digest, CASE WHEN m.r <> 'N' THEN m.r || m.p END AS translation, m.r <> 'N' AND m.t = 'O' AS outdated, m.r <> 'N' AS has_translation FROM o""",
)
def s10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.translatable_fields(resources(spark, sf_dir))


@query("s27_translated", ONCE_SQL + "SELECT l_orderkey AS resource_id, list_sort(list('k' || l_linenumber || '=' || m.r || m.p)) AS fields FROM o WHERE m.r <> 'N' GROUP BY 1")
def s27(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = changes.translated_resources(changes.translatable_fields(resources(spark, sf_dir)))
    return found.select("resource_id", F.array_sort(F.transform(F.map_entries("fields"), lambda e: F.concat_ws("=", e["key"], e["value"]))).alias("fields"))


@query(
    "s12_price_map",
    "SELECT 'p' || l_partkey AS sku, max_by(struct_pack(n := l_returnflag, f := round_even(l_extendedprice / 4, 0)::BIGINT, r := round_even(coalesce(CASE WHEN l_linenumber % 2 = 0 THEN l_extendedprice END, l_extendedprice / 4), 0)::BIGINT), l_orderkey * 1000000000 + l_linenumber * 10000000 + l_suppkey) AS x FROM lineitem GROUP BY 1".join(("SELECT sku, x.n AS name, x.f AS final_price, x.r AS regular_price FROM (", ")")),
)
def s12(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.col("l_orderkey") * 1_000_000_000 + F.col("l_linenumber") * 10_000_000 + F.col("l_suppkey")
    items = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("sku"), F.col("l_returnflag").alias("name"), (F.col("l_extendedprice") / 4).alias("final_price"), F.when(F.col("l_linenumber") % 2 == 0, F.col("l_extendedprice")).alias("regular_price"), F.lit("SAR").alias("currency"), order.alias("ord")
    )
    return reshape.price_map(items, "ord").select("sku", "name", "final_price", "regular_price")


@query("s13_media", "SELECT l_partkey, list(u ORDER BY first_, u) AS urls FROM (SELECT l_partkey, 'u' || l_suppkey AS u, min(l_orderkey) AS first_ FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL) GROUP BY 1")
def s13(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.when(F.col("l_returnflag") == "R", "").otherwise(F.concat(F.lit("u"), F.col("l_suppkey").cast("string")))
    return reshape.media_by_key(table(spark, sf_dir, "lineitem").select("l_partkey", url.alias("url"), "l_orderkey"), "l_partkey", "url", "l_orderkey")


@query(
    "s16_sitemaps",
    r"""WITH u AS (SELECT DISTINCT CASE page_id % 5 WHEN 0 THEN url || '/product/' || page_id WHEN 1 THEN url || '/blog-1' WHEN 2 THEN 'https://s.x/collections/' || page_id WHEN 3 THEN 'https://s.x/map' || page_id || '.xml.gz' ELSE url END AS url FROM pages)
SELECT CASE WHEN regexp_matches(lower(url), '\.xml(\.gz)?$') THEN 'sitemap' WHEN regexp_matches(lower(url), '/products?/|\.html$') THEN 'product' WHEN regexp_matches(lower(url), '/(collections|category|categories)/') THEN 'category' WHEN contains(lower(url), '/blog') THEN 'blog' ELSE 'page' END AS kind, url FROM u""",
)
def s16(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n, u = F.col("page_id") % 5, F.col("page_id").cast("string"), F.col("url")
    url = F.when(k == 0, F.concat(u, F.lit("/product/"), n)).when(k == 1, F.concat(u, F.lit("/blog-1"))).when(k == 2, F.concat(F.lit("https://s.x/collections/"), n)).when(k == 3, F.concat(F.lit("https://s.x/map"), n, F.lit(".xml.gz"))).otherwise(u)
    files = table(spark, sf_dir, "pages").groupBy((F.col("page_id") % 7).alias("g")).agg(F.concat(F.lit("<urlset>"), F.array_join(F.collect_list(F.concat(F.lit("<url><loc>\n "), url, F.lit(" </loc></url>"))), ""), F.lit("</urlset>")).alias("content"))
    return reshape.sitemap_urls(files, "content")


# --- plans and checks -------------------------------------------------------------------------------------------------------


@query("m23_inverse", "SELECT o_custkey AS old, max(o_orderkey) AS new FROM orders GROUP BY 1")
def m23(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.inverse_map(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("old"), F.col("o_custkey").alias("new")))


@query(
    "m24_fill_empty",
    """WITH s AS (SELECT o_custkey AS id, o_orderpriority AS key, CASE WHEN o_orderkey % 4 = 0 THEN ' ' ELSE 'v' || o_orderkey END AS value FROM orders), t AS (SELECT o_custkey AS id, o_orderpriority AS key FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 5 <> 0)
SELECT id, key, max(value) AS value FROM s WHERE value <> ' ' AND (id, key) NOT IN (SELECT (id, key) FROM t) GROUP BY ALL""",
)
def m24(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    keys = [F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("key")]
    source = orders.select(*keys, F.when(k % 4 == 0, " ").otherwise(F.concat(F.lit("v"), k.cast("string"))).alias("value"))
    target = orders.filter("o_orderstatus = 'F'").select(*keys, F.when(k % 5 == 0, "").otherwise("full").alias("value"))
    return changes.fill_empty(target, source, ["id", "key"])


@query(
    "m35_digests",
    """SELECT o_orderkey AS resource_id, o_orderpriority AS key, o_orderstatus AS translation, d.digest, d.digest IS NOT NULL AS matched FROM orders LEFT JOIN (SELECT l_orderkey, max('d' || l_partkey) AS digest FROM lineitem WHERE l_linenumber > 2 GROUP BY 1) d ON d.l_orderkey = o_orderkey AND o_orderkey % 3 <> 0""",
)
def m35(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("resource_id"), F.col("o_orderpriority").alias("key"), F.col("o_orderstatus").alias("translation"))
    fields = table(spark, sf_dir, "lineitem").filter("l_linenumber > 2").withColumnRenamed("l_orderkey", "resource_id").join(orders.filter("resource_id % 3 <> 0").select("resource_id", "key"), "resource_id")
    return changes.with_digests(orders, fields.select("resource_id", "key", F.concat(F.lit("d"), F.col("l_partkey").cast("string")).alias("digest")))


@query(
    "m40_by_name",
    """WITH n AS (SELECT lower(trim(name)) AS k, max(value) AS v FROM (SELECT upper(p_name) || ' ' || p_partkey AS name, 'new ' || p_partkey AS value FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT replace('item-' || p_partkey, '-', ' '), 'spelled ' || p_partkey FROM part WHERE p_partkey % 3 = 0) GROUP BY 1)
SELECT 'item-' || p_partkey AS handle, p_name || ' ' || p_partkey AS name, coalesce(a.v, b.v, 'old') AS value FROM part LEFT JOIN n a ON a.k = lower(p_name || ' ' || p_partkey) LEFT JOIN n b ON b.k = 'item ' || p_partkey""",
)
def m40(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, p = table(spark, sf_dir, "part"), F.col("p_partkey").cast("string")
    base = part.select(F.concat(F.lit("item-"), p).alias("handle"), F.concat_ws(" ", "p_name", p).alias("name"), F.lit("old").alias("value"))
    new = part.filter("p_partkey % 2 = 0").select(F.lit("").alias("handle"), F.concat(F.upper("p_name"), F.lit(" "), p).alias("name"), F.concat(F.lit("new "), p).alias("value"))
    new = new.unionByName(part.filter("p_partkey % 3 = 0").select(F.lit("").alias("handle"), F.concat(F.lit("item "), p).alias("name"), F.concat(F.lit("spelled "), p).alias("value")))
    return changes.by_name_or_handle(base, new)


@query(
    "m47_creation_plan",
    """SELECT c_custkey, 'h' || c_nationkey || '-' || c_custkey % 50 AS handle, t.id AS target_id, CASE WHEN c_custkey % 11 = 0 THEN 'done' WHEN t.id IS NOT NULL THEN 'exists' ELSE 'create' END AS action
FROM customer LEFT JOIN (SELECT 'h' || s_nationkey || '-' || s_suppkey % 50 AS handle, max(s_suppkey) AS id FROM supplier GROUP BY 1) t ON t.handle = 'h' || c_nationkey || '-' || c_custkey % 50""",
)
def m47(spark: SparkSession, sf_dir: str) -> DataFrame:
    handle = lambda n, k: F.concat(F.lit("h"), F.col(n).cast("string"), F.lit("-"), (F.col(k) % 50).cast("string")).alias("handle")
    source = table(spark, sf_dir, "customer").select("c_custkey", handle("c_nationkey", "c_custkey"))
    existing = table(spark, sf_dir, "supplier").select(handle("s_nationkey", "s_suppkey"), F.col("s_suppkey").alias("target_id"))
    return changes.creation_plan(source, existing, source.filter("c_custkey % 11 = 0").select("c_custkey"), "c_custkey", "handle").select("c_custkey", "handle", "target_id", "action")


@query(
    "m53_differences",
    """WITH l AS (SELECT l_suppkey AS g, l_returnflag || l_linenumber AS i FROM lineitem WHERE l_linestatus = 'O'), r AS (SELECT l_suppkey AS g, l_returnflag || l_linenumber AS i FROM lineitem WHERE l_linestatus <> 'O' AND l_linenumber < 6),
k AS (SELECT g FROM l UNION SELECT g FROM r)
SELECT g AS l_suppkey, list_sort((SELECT coalesce(list(DISTINCT i), []) FROM l WHERE l.g = k.g AND i NOT IN (SELECT i FROM r WHERE r.g = k.g))) AS missing, list_sort((SELECT coalesce(list(DISTINCT i), []) FROM r WHERE r.g = k.g AND i NOT IN (SELECT i FROM l WHERE l.g = k.g))) AS extra,
  (SELECT count(*) FROM l WHERE l.g = k.g) AS n_left, (SELECT count(*) FROM r WHERE r.g = k.g) AS n_right FROM k""",
)
def m53(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").withColumn("i", F.concat(F.col("l_returnflag"), F.col("l_linenumber").cast("string")))
    return changes.group_differences(rows.filter("l_linestatus = 'O'"), rows.filter("l_linestatus <> 'O' AND l_linenumber < 6"), "l_suppkey", "i")


@query("m61_to_import", "SELECT c_custkey, c_name FROM customer WHERE c_custkey % 10 <> 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AND c_custkey NOT IN (SELECT s_suppkey FROM supplier)")
def m61(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.when(F.col("c_custkey") % 10 != 0, F.col("c_custkey").cast("string")).alias("email"))
    orders, others = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").cast("string")), table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string"))
    return changes.to_import(people, "email", orders, others).select("c_custkey", "c_name")


@query("a03_by_prefix", "SELECT o_orderpriority[1:1] || '.' || o_orderstatus AS prefix, count(*) AS n, count(*) FILTER (WHERE o_orderkey % 3 <> 0) AS n_filled, sum(CASE WHEN o_orderkey % 3 <> 0 THEN length(o_orderkey::VARCHAR) ELSE 0 END)::BIGINT AS n_chars FROM orders GROUP BY 1")
def a03(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat_ws(".", F.substring("o_orderpriority", 1, 1), "o_orderstatus", F.col("o_orderkey").cast("string"))
    return reshape.by_prefix(table(spark, sf_dir, "orders").select(key.alias("key"), F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.col("o_orderkey").cast("string")).alias("value")), "key", "value", 2)


@query("a09_coverage", "SELECT k AS key, count(DISTINCT CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END) AS n, (SELECT count(DISTINCT o_custkey) FROM orders) AS total, CASE WHEN count(DISTINCT CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END) = 0 THEN 'MISSING' WHEN count(DISTINCT CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END) >= (SELECT count(DISTINCT o_custkey) FROM orders) THEN 'OK' ELSE 'PARTIAL' END AS state FROM (SELECT unnest(['F', 'O', 'none']) AS k) LEFT JOIN orders ON o_orderstatus = k GROUP BY 1")
def a09(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderstatus").alias("key"), F.when(F.col("o_orderkey") % 2 == 0, "x").otherwise("").alias("value"))
    return changes.key_coverage(rows, ["F", "O", "none"], "key", "o_custkey")


@query("a19_key_sets", "SELECT l_suppkey, list_sort(list(DISTINCT l_partkey)) AS items FROM lineitem GROUP BY 1")
def a19(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.key_sets(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_partkey")


@query("a23_outcomes", "SELECT CASE WHEN lower(c_mktsegment) LIKE '%a%' THEN 'known' ELSE 'unknown' END AS outcome, count(DISTINCT c_mktsegment) AS n_values, count(*) AS n_rows FROM customer GROUP BY 1")
def a23(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.weighted_outcomes(table(spark, sf_dir, "customer"), "c_mktsegment", F.when(F.lower("c_mktsegment").contains("a"), "known").otherwise("unknown"))


@query("w07_most_common", "SELECT p_type, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, min(p_partkey) LIMIT 3")
def w07(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.most_common(table(spark, sf_dir, "part"), "p_type", 3, "p_partkey")


@query(
    "f24_catalog_faults",
    """WITH p AS (SELECT o_orderkey AS id, o_orderstatus AS status, count(*) FILTER (WHERE l_returnflag = 'R') AS images, coalesce(bool_or(l_linenumber = 7), false) AS zero FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)
SELECT 'not_active' AS code, 'warn' AS severity, id AS subject FROM p WHERE status <> 'O' UNION ALL SELECT 'no_images', 'fail', id FROM p WHERE images = 0 UNION ALL SELECT 'zero_price', 'fail', id FROM p WHERE zero UNION ALL SELECT 'spanish_handle', 'warn', id FROM p WHERE id % 9 = 0""",
)
def f24(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_list(F.when(F.col("l_returnflag") == "R", F.lit("i"))).alias("images"), F.collect_list(F.struct(F.when(F.col("l_linenumber") == 7, "0.00").otherwise("1.5").alias("price"))).alias("variants"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "O", "active").otherwise("draft").alias("status"), F.when(F.col("o_orderkey") % 9 == 0, "champu-para-el-cabello").otherwise("plain").alias("handle"))
    return changes.catalog_faults(orders.join(lines, "id", "left"))


@query("f29_absent", "SELECT 'no_orders' AS code, 'fail' AS severity, c_custkey::VARCHAR AS subject FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def f29(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.absent(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), "k", "no_orders")


@query("k07_batches", "SELECT o_custkey, batch, list(o_orderkey ORDER BY o_orderkey) AS keys FROM (SELECT o_custkey, o_orderkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 3 AS batch FROM orders) GROUP BY ALL")
def k07(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = changes.batches(table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", 3, "o_orderkey")
    return found.select("o_custkey", "batch", F.transform("rows", lambda r: r["o_orderkey"]).alias("keys"))


# --- two stores ---------------------------------------------------------------------------------------------------------------


def key(letter: str, column: str):
    return F.concat(F.lit(letter), F.col(column).cast("string"))


@query(
    "m09_article_paths",
    """WITH s AS (SELECT o_orderkey AS id, 'b' || o_custkey % 9 AS b, 'a' || o_orderkey AS h FROM orders), t AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 'b' || o_custkey % 3 END AS b, 'a' || o_orderkey AS h FROM orders WHERE o_orderstatus <> 'F')
SELECT '/blogs/' || s.b || '/' || s.h AS old, '/blogs/' || t.b || '/' || t.h AS new FROM s JOIN t USING (id) WHERE t.b <> '' AND s.b <> t.b""",
)
def m09(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("n", F.col("o_custkey") % 9).withColumn("m", F.col("o_custkey") % 3)
    source = orders.select(F.col("o_orderkey").alias("id"), key("b", "n").alias("blog_handle"), key("a", "o_orderkey").alias("handle"))
    target = orders.filter("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 7 == 0, "").otherwise(key("b", "m")).alias("blog_handle"), key("a", "o_orderkey").alias("handle"))
    return stores.article_paths(source, target)


@query(
    "m31_menu_items",
    """WITH i AS (SELECT o_custkey AS menu, o_orderkey AS pos, CASE o_orderkey % 4 WHEN 0 THEN 'https://a.com/collections/h' || o_custkey || '/' WHEN 1 THEN 'https://a.com/pages/h' || o_custkey WHEN 2 THEN 'x/products/h' || o_custkey ELSE 'https://b.com' END AS url, o_orderkey % 4 AS k FROM orders),
s AS (SELECT 'h' || s_suppkey AS h, s_suppkey AS id FROM supplier)
SELECT menu, pos, CASE WHEN s.id IS NOT NULL THEN CASE k WHEN 0 THEN 'gid://shopify/Collection/' WHEN 1 THEN 'gid://shopify/OnlineStorePage/' ELSE 'gid://shopify/Product/' END || s.id END AS resource_id,
  CASE WHEN s.id IS NULL THEN CASE k WHEN 0 THEN '/collections/h' || menu || '/' WHEN 1 THEN '/pages/h' || menu WHEN 2 THEN '/x/products/h' || menu ELSE '/' END END AS url FROM i LEFT JOIN s ON s.h = 'h' || menu AND k < 3""",
)
def m31(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, h = F.col("o_orderkey") % 4, key("h", "o_custkey")
    url = F.when(k == 0, F.concat(F.lit("https://a.com/collections/"), h, F.lit("/"))).when(k == 1, F.concat(F.lit("https://a.com/pages/"), h)).when(k == 2, F.concat(F.lit("x/products/"), h)).otherwise("https://b.com")
    gid = F.when(k == 0, "gid://shopify/Collection/1").when(k == 1, "gid://shopify/Page/1").when(k == 2, "gid://shopify/Product/1")
    items = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("menu"), F.col("o_orderkey").alias("pos"), F.lit("t").alias("title"), url.alias("url"), gid.alias("resource_id"))
    known = table(spark, sf_dir, "supplier").select(F.explode(F.array(*map(F.lit, ("collections", "pages", "products")))).alias("kind"), key("h", "s_suppkey").alias("handle"), F.col("s_suppkey").alias("id"))
    return stores.resolved_menu_items(items, known, ["https://a.com", "https://b.com"]).drop("title")


@query(
    "m11_mapped_differences",
    """WITH l AS (SELECT 'c' || c_custkey AS handle, c_mktsegment AS a, c_nationkey::VARCHAR AS b FROM customer), r AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN 'n' ELSE 'c' END || c_custkey AS handle, c_mktsegment AS a, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_nationkey::VARCHAR END AS b FROM customer WHERE c_custkey % 5 <> 0),
m AS (SELECT l.handle, coalesce(r1.handle, r2.handle) AS matched, CASE WHEN coalesce(r1.handle, r2.handle) IS NULL THEN NULL ELSE CASE WHEN l.b <> coalesce(CASE WHEN r1.handle IS NOT NULL THEN r1.b ELSE r2.b END, '') THEN ['b'] ELSE []::VARCHAR[] END END AS differing
  FROM l LEFT JOIN r r1 ON r1.handle = l.handle LEFT JOIN r r2 ON r2.handle = 'n' || l.handle[2:] AND l.handle[2:]::INT % 2 = 0)
SELECT handle, matched, CASE WHEN matched IS NULL THEN 'missing' WHEN len(differing) > 0 THEN 'differs' ELSE 'same' END AS verdict, differing FROM m
UNION ALL SELECT NULL, handle, 'only_right', NULL FROM r WHERE handle NOT IN (SELECT matched FROM m WHERE matched IS NOT NULL)""",
)
def m11(spark: SparkSession, sf_dir: str) -> DataFrame:
    people, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    left = people.select(key("c", "c_custkey").alias("handle"), F.col("c_mktsegment").alias("a"), F.col("c_nationkey").alias("b"))
    right = people.filter(k % 5 != 0).select(F.when(k % 3 == 0, key("n", "c_custkey")).otherwise(key("c", "c_custkey")).alias("handle"), F.col("c_mktsegment").alias("a"), F.when(k % 4 != 0, F.col("c_nationkey")).alias("b"))
    handles = people.filter(k % 2 == 0).select(key("c", "c_custkey").alias("old"), key("n", "c_custkey").alias("new"))
    return stores.mapped_differences(left, right, handles, ["a", "b"])


@query(
    "m13_navigation",
    """WITH l AS (SELECT o_custkey AS menu, o_orderkey AS pos, 'p' || o_orderkey AS path, o_orderkey % 3 AS n FROM orders), r AS (SELECT o_custkey AS menu, 'p' || o_orderkey AS path, o_orderkey % 2 AS n FROM orders WHERE o_orderstatus <> 'F' AND o_custkey % 4 <> 0)
SELECT l.menu, l.pos, CASE WHEN l.menu NOT IN (SELECT menu FROM r) THEN 'missing_menu' WHEN r.path IS NULL THEN 'missing' WHEN l.n <> r.n THEN 'children' ELSE 'same' END AS verdict FROM l LEFT JOIN r ON r.menu = l.menu AND r.path = l.path""",
)
def m13(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    row = lambda url, n: [F.col("o_custkey").alias("menu"), F.col("o_orderkey").alias("pos"), F.lit("t").alias("title"), url.alias("url"), (F.col("o_orderkey") % n).alias("n_children")]
    left = orders.select(*row(F.concat(F.lit("https://a.com/en/p"), F.col("o_orderkey").cast("string"), F.lit("/")), 3))
    right = orders.filter("o_orderstatus <> 'F' AND o_custkey % 4 <> 0").select(*row(F.concat(F.lit("https://b.com/p"), F.col("o_orderkey").cast("string")), 2))
    return stores.navigation_differences(left, right).drop("title")


@query("m54_empty_groups", "SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 1)")
def m54(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R' AND l_linenumber = 1").select(F.col("l_partkey").alias("p_partkey"))
    return stores.without_members(table(spark, sf_dir, "part").select("p_partkey", "p_name"), lines, "p_partkey")


@query(
    "m39_image_alts",
    "SELECT l_orderkey * 100 + rn AS image_id, a AS alt FROM (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS rn, CASE WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag || l_partkey END AS a FROM lineitem) WHERE rn < 3 AND a <> ''",
)
def m39(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    alt = F.when(F.col("l_returnflag") == "N", "").otherwise(F.concat("l_returnflag", F.col("l_partkey").cast("string")))
    local = lines.groupBy(F.col("l_orderkey").alias("handle")).agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", alt.alias("a")))), lambda x: x["a"]).alias("alts"))
    target = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("handle"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("pos")).select("handle", (F.col("handle") * 100 + F.col("pos")).alias("image_id"), "pos")
    return stores.image_alts(local, target)


@query(
    "m38_metafields",
    """WITH m AS (SELECT o_orderkey AS id, 'h' || o_custkey AS handle, o_orderpriority AS key, CASE WHEN o_orderkey % 6 = 0 THEN 'list.product_reference' ELSE 'text' END AS type FROM orders WHERE o_orderkey % 10 <> 0),
c AS (SELECT o_orderkey AS id, 'e' || o_orderkey AS english, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'd' || o_orderkey END AS digest, CASE WHEN o_orderkey % 4 = 1 THEN 'there' END AS t FROM orders),
l AS (SELECT 'h' || o_custkey AS handle, o_orderpriority AS key, max('t' || o_orderkey) AS t FROM orders WHERE o_orderkey % 3 = 0 GROUP BY ALL)
SELECT m.id, m.handle, m.key, english, digest, l.t AS translation, CASE WHEN l.t IS NOT NULL THEN 'upload' ELSE 'translate' END AS action
FROM m JOIN c USING (id) LEFT JOIN l ON l.handle = m.handle AND l.key = m.key WHERE type = 'text' AND digest IS NOT NULL AND c.t IS NULL AND m.id % 11 <> 0""",
)
def m38(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    own = [k.alias("id"), key("h", "o_custkey").alias("handle"), F.col("o_orderpriority").alias("key")]
    metafields = orders.select(*own, F.when(k % 10 == 0, " ").otherwise("v").alias("value"), F.when(k % 6 == 0, "list.product_reference").otherwise("text").alias("type"))
    content = orders.select(k.alias("id"), key("e", "o_orderkey").alias("english"), F.when(F.col("o_orderstatus") != "P", key("d", "o_orderkey")).alias("digest"), F.when(k % 4 == 1, "there").alias("translation"))
    local = orders.filter(k % 3 == 0).select(*own[1:], key("t", "o_orderkey").alias("translation"))
    return stores.metafield_translations(metafields, content, local, orders.filter(k % 11 == 0).select(k.alias("id")))


@query("m44_unmatched", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_orderkey % 3 <> 0 AND o_custkey NOT IN (SELECT s_suppkey FROM supplier)")
def m44(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("k"), (F.col("o_orderstatus") == "O").alias("has_translation"), F.when(F.col("o_orderkey") % 3 == 0, " ").otherwise("t").alias("translation"))
    return stores.unmatched_translations(fields, table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k")), ["k"]).select("o_orderkey")


@query(
    "t29_places",
    """WITH p AS (SELECT c_custkey AS ord, CASE WHEN c_custkey % 3 = 0 THEN 'Al ' WHEN c_custkey % 3 = 1 THEN 'Al-' ELSE '' END || 'Qa''ra' || c_custkey // 2 AS en, 'مدينة' || c_custkey AS ar FROM customer), r AS (SELECT n_nationkey AS ord, n_name AS en, '' AS ar FROM nation),
s AS (SELECT 0 AS k, ord, en, lower(en) AS spelling FROM p UNION ALL SELECT 0, ord, en, ar FROM p UNION ALL SELECT 0, ord, en, replace(lower(en), '''', '') FROM p UNION ALL SELECT 0, ord, en, lower(en)[4:] FROM p WHERE en LIKE 'Al %' OR en LIKE 'Al-%' UNION ALL SELECT 1, ord, en, lower(en) FROM r)
SELECT spelling, max_by(en, k * 1000000000 + ord) AS name FROM s GROUP BY 1""",
)
def t29(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    begin = F.when(k % 3 == 0, "Al ").when(k % 3 == 1, "Al-").otherwise("")
    places = table(spark, sf_dir, "customer").select(F.concat(begin, F.lit("Qa'ra"), F.expr("c_custkey div 2").cast("string")).alias("name_en"), key("مدينة", "c_custkey").alias("name_ar"), k.alias("ord"))
    regions = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name_en"), F.lit("").alias("name_ar"), F.col("n_nationkey").cast("long").alias("ord"))
    return stores.place_names(places, regions)


@query("a24_spanish_prefix", "SELECT o_orderstatus AS prefix, count(*) AS n FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey % 5 > 1 GROUP BY 1")
def a24(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    name = F.when(k % 5 == 0, "handle").when(k % 5 == 1, "inci_name").otherwise("title")
    fields = table(spark, sf_dir, "orders").select(F.concat_ws(".", "o_orderstatus", k.cast("string"), name).alias("key"), F.when(k % 2 == 0, "champú para el cabello").otherwise("plain words").alias("value"))
    return stores.spanish_by_prefix(fields)


@query(
    "m59_images",
    """WITH p AS (SELECT l_orderkey AS id, min(l_linenumber) FILTER (WHERE l_returnflag <> 'N') AS n FROM lineitem GROUP BY 1), f AS (SELECT p.id, min(l_partkey) AS sku FROM p JOIN lineitem ON l_orderkey = p.id AND l_linenumber = p.n AND l_returnflag <> 'N' GROUP BY 1)
SELECT id, ['u' || sku] AS images FROM f WHERE sku % 4 <> 0 AND id % 5 <> 0 AND sku IN (SELECT p_partkey FROM part)""",
)
def m59(spark: SparkSession, sf_dir: str) -> DataFrame:
    sku = F.when(F.col("l_returnflag") == "N", "").otherwise(F.col("l_partkey").cast("string"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", sku.alias("s")))), lambda x: x["s"])
    first = F.get(F.filter("skus", lambda s: s != ""), F.lit(0))
    products = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(listed.alias("skus")).withColumn("images", F.when(F.col("id") % 5 == 0, F.array(F.concat(F.lit("u"), first))).otherwise(F.array().cast("array<string>")))
    images = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("sku"), F.when(F.col("p_partkey") % 4 == 0, F.array().cast("array<string>")).otherwise(F.array(key("u", "p_partkey"))).alias("images"))
    return stores.images_by_sku(products, images)


@query(
    "m60_prices",
    """WITH v AS (SELECT l_suppkey AS product_id, 'h' || l_suppkey % 40 AS handle, l_orderkey * 100 + l_linenumber AS variant_id FROM lineitem), p AS (SELECT 'h' || s_suppkey AS handle, s_acctbal AS price FROM supplier), f AS (SELECT handle, min(product_id) AS product_id FROM v GROUP BY 1)
SELECT p.handle, v.variant_id, CASE WHEN v.variant_id IS NOT NULL THEN price END AS price, v.variant_id IS NOT NULL AS found FROM p LEFT JOIN (SELECT v.* FROM v JOIN f USING (handle, product_id)) v ON v.handle = p.handle""",
)
def m60(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = table(spark, sf_dir, "lineitem").withColumn("m", F.col("l_suppkey") % 40).select(F.col("l_suppkey").alias("product_id"), key("h", "m").alias("handle"), (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("variant_id"))
    return stores.prices_by_handle(table(spark, sf_dir, "supplier").select(key("h", "s_suppkey").alias("handle"), F.col("s_acctbal").alias("price")), variants)


@query("m51_group_links", "SELECT DISTINCT s_nationkey AS group_id, l_partkey * 10 AS product_id FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_partkey % 3 <> 0 AND l_suppkey % 4 <> 0")
def m51(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = table(spark, sf_dir, "lineitem").select(F.when(F.col("l_suppkey") % 4 == 0, "").otherwise(key("k", "l_suppkey")).alias("url_key"), key("p", "l_partkey").alias("sku"))
    groups = table(spark, sf_dir, "supplier").select(key("k", "s_suppkey").alias("url_key"), F.col("s_nationkey").alias("id"))
    products = table(spark, sf_dir, "part").filter("p_partkey % 3 <> 0").select(key("p", "p_partkey").alias("sku"), (F.col("p_partkey") * 10).alias("id"))
    return stores.group_links(members, groups, products)
