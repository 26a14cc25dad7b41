"""Queries of exports, content audits and prepared products, each with its SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import content, summaries
from tallyloom.plans.catalog import query
from tallyloom.sources import export
from tallyloom.sources.tables import table

#: Part of a text that is Spanish, and one that is not.
SPANISH, PLAIN = "champú para el cabello", "plain words"


@query(
    "s26_export",
    """
WITH m AS (SELECT l_partkey, l_returnflag, l_linestatus, max('v' || l_suppkey) AS v FROM lineitem GROUP BY ALL),
f AS (SELECT l_partkey::VARCHAR AS id, list(l_returnflag || '.' || l_linestatus || '=' || v ORDER BY l_returnflag, l_linestatus) AS fields FROM m GROUP BY 1)
SELECT 'products' AS kind, p_partkey::VARCHAR AS id, 'p' || p_partkey AS handle, p_name AS title, NULL AS body_md5, coalesce(fields, []) AS fields FROM part LEFT JOIN f ON f.id = p_partkey::VARCHAR
UNION ALL SELECT 'collections', s_suppkey::VARCHAR, NULL, s_name, NULL, NULL FROM supplier
UNION ALL SELECT 'pages', page_id::VARCHAR, url, NULL, md5(html), NULL FROM pages
UNION ALL SELECT 'articles', doc_id::VARCHAR, 'd' || doc_id, NULL, md5(text), NULL FROM documents
UNION ALL SELECT 'metaobjects', 'gid://x/' || c_custkey, c_name, NULL, NULL, NULL FROM customer""",
)
def s26(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda name: table(spark, sf_dir, name)
    text_of = lambda letter, c: F.concat(F.lit(letter), F.col(c).cast("string"))
    metafields = read("lineitem").select(F.col("l_partkey").alias("owner_id"), F.col("l_returnflag").alias("namespace"), F.col("l_linestatus").alias("key"), text_of("v", "l_suppkey").alias("value"), F.lit("text").alias("type"))
    products = read("part").select(F.col("p_partkey").alias("id"), text_of("p", "p_partkey").alias("handle"), F.col("p_name").alias("title"))
    kinds = {
        "products": export.with_metafields(products, metafields), "collections": read("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("title")), "pages": read("pages").select(F.col("page_id").alias("id"), F.col("url").alias("handle"), F.col("html").alias("body_html")),
        "articles": read("documents").select(F.col("doc_id").alias("id"), text_of("d", "doc_id").alias("handle"), F.col("text").alias("body_html")), "metaobjects": read("customer").select(text_of("gid://x/", "c_custkey").alias("id"), F.col("c_name").alias("handle"), F.col("c_nationkey").alias("more")),
    }
    fields = F.transform("metafields", lambda m: F.concat(m["namespace"], F.lit("."), m["key"], F.lit("="), m["value"]))
    return export.all_resources(kinds).select("kind", "id", "handle", "title", F.md5("body_html").alias("body_md5"), fields.alias("fields"))


@query(
    "f23_content_audit",
    f"""
WITH r AS (SELECT o_orderkey AS id, o_orderkey % 3 = 0 AS es, o_orderkey % 4 = 1 AS bloat, o_orderstatus = 'F' AS named, o_orderkey % 5 = 0 AS field FROM orders)
SELECT id, 'body_html' AS field, 'html_bloat' AS issue FROM r WHERE bloat UNION ALL SELECT id, 'body_html', 'spanish' FROM r WHERE es UNION ALL SELECT id, 'title', 'spanish' FROM r WHERE named UNION ALL SELECT id, 'metafield:m', 'spanish' FROM r WHERE field""",
)
def f23(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    said = lambda test: F.when(test, SPANISH).otherwise(PLAIN)
    body = F.concat(F.when(k % 4 == 1, "<p data-a='1'>").otherwise("<p>"), said(k % 3 == 0), F.lit("</p>"))
    field = F.struct(F.lit("n").alias("namespace"), F.lit("m").alias("key"), said(k % 5 == 0).alias("value"), F.lit("text").alias("type"))
    rows = table(spark, sf_dir, "orders").select(F.lit("order").alias("kind"), k.alias("id"), F.lit("h").alias("handle"), said(F.col("o_orderstatus") == "F").alias("title"), body.alias("body_html"), F.array(field).alias("metafields"))
    return content.audit_content(rows).select("id", "field", "issue")


def ordered_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as products, their lines as variants."""
    n = F.col("l_linenumber")
    variant = F.struct(n, F.col("l_partkey").cast("string").alias("title"), F.when(n % 4 == 0, "").otherwise(F.concat(F.lit("p"), F.col("l_partkey").cast("string"))).alias("sku"), F.when(n == 2, "0.0").when(n != 5, F.col("l_quantity").cast("int").cast("string")).alias("price"),
                       F.when(n == 1, F.lit("99")).alias("compare_at_price"), F.when(F.col("l_returnflag") == "R", F.lit("shop")).alias("inventory_management"), (F.col("l_suppkey") % 3).cast("int").alias("inventory_quantity"), F.col("l_suppkey").alias("s"))
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.array_sort(F.collect_list(variant)).alias("variants"))
    k = F.col("o_orderkey")
    handle = F.when(k % 6 == 0, F.lit("champu-x")).otherwise(F.lit("plain"))
    image = F.array(F.struct(F.when(k % 7 == 0, F.lit("")).otherwise(F.lit("src")).alias("src"), F.lit("").alias("alt")))
    orders = table(spark, sf_dir, "orders").select(k.alias("id"), handle.alias("handle"), F.when(F.col("o_orderstatus") == "O", "active").alias("status"), image.alias("images"), F.col("o_orderpriority").alias("title"))
    return orders.join(lines, "id", "left")


@query(
    "f25_product_faults",
    """
SELECT 'not_active' AS code, o_orderkey::VARCHAR AS subject FROM orders WHERE o_orderstatus <> 'O' UNION ALL SELECT 'spanish_handle', o_orderkey::VARCHAR FROM orders WHERE o_orderkey % 6 = 0
UNION ALL SELECT 'zero_price', l_orderkey || '/' || l_partkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_linenumber IN (2, 5) OR l_quantity::INT = 0
UNION ALL SELECT 'no_inventory', l_orderkey || '/' || l_partkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'R' AND l_suppkey % 3 = 0""",
)
def f25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content.product_faults(ordered_parts(spark, sf_dir)).select("code", "subject")


@query(
    "p09_prepared",
    """
WITH v AS (SELECT l_orderkey AS id, l_linenumber AS n, l_partkey AS p, l_suppkey AS s, l_returnflag AS r, CASE WHEN l_linenumber % 4 <> 0 THEN 'p' || l_partkey ELSE '' END AS sku, CASE WHEN l_linenumber = 2 THEN '0.0' WHEN l_linenumber <> 5 THEN l_quantity::INT::VARCHAR END AS price, CASE WHEN l_linenumber = 1 THEN '99' END AS compare FROM lineitem),
k AS (SELECT 'p' || p_partkey AS sku, p_size AS f, CASE WHEN p_size % 2 = 0 THEN p_size ELSE p_size + 5 END AS g FROM part WHERE p_partkey % 3 <> 0),
w AS (SELECT v.*, coalesce(k.f::VARCHAR, price, '0') AS cost, CASE WHEN k.f IS NOT NULL THEN CASE WHEN f <> g THEN g::VARCHAR END ELSE compare END AS was FROM v LEFT JOIN k ON k.sku = v.sku),
x AS (SELECT id, list_sort(list(sku || ':' || cost || ':' || coalesce(was, '-'))) AS variants FROM w GROUP BY 1)
SELECT o_orderkey AS id, o_orderpriority AS title, CASE WHEN o_orderstatus = 'O' THEN 'active' ELSE 'draft' END AS status, o_orderstatus = 'O' AS published, CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE 1 END AS images, coalesce(variants, []) AS variants FROM orders LEFT JOIN x ON x.id = o_orderkey""",
)
def p09(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")
    products = ordered_parts(spark, sf_dir).withColumns({"body_html": none, "vendor": none, "product_type": none, "tags": none})
    size = F.col("p_size")
    prices = table(spark, sf_dir, "part").filter("p_partkey % 3 <> 0").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("sku"), size.alias("final_price"), F.when(size % 2 == 0, size).otherwise(size + 5).alias("regular_price"))
    out = content.prepared_products(products, prices)
    shown = F.array_sort(F.transform("variants", lambda v: F.concat_ws(":", v["sku"], v["price"], F.coalesce(v["compare_at_price"], F.lit("-")))))
    return out.select("id", "title", "status", "published", F.size("images").alias("images"), shown.alias("variants"))


@query(
    "a06_key_report",
    """
WITH f AS (SELECT CASE o_orderkey % 3 WHEN 0 THEN 'theme_editor' ELSE 'other' END AS source, string_split((o_orderkey % 3) || '.' || (o_custkey % 2) || '.' || o_orderstatus || '.' || o_orderkey, '.') AS parts, o_orderkey % 2 = 0 OR o_orderpriority LIKE '1%' AS done, length(o_orderpriority) AS c FROM orders),
p AS (SELECT source, array_to_string(parts[1:CASE WHEN source = 'other' THEN 2 ELSE 3 END], '.') AS prefix, done, c FROM f)
SELECT source, prefix, count(*) AS n, count(*) FILTER (WHERE done) AS n_translated, sum(c)::BIGINT AS n_chars, CASE WHEN grouping(source) = 1 THEN greatest(count(*) - 3400, 0) END AS over FROM p GROUP BY ROLLUP (source, prefix)""",
)
def a06(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    key = F.concat_ws(".", (k % 3).cast("string"), (F.col("o_custkey") % 2).cast("string"), "o_orderstatus", k.cast("string"))
    fields = table(spark, sf_dir, "orders").select(key.alias("key"), F.col("o_orderpriority").alias("english"), F.when(F.col("o_orderpriority").startswith("1"), "x").alias("arabic"), (k % 2 == 0).alias("has_translation"))
    return summaries.key_report(fields, F.when(F.col("key").startswith("0"), "theme_editor").otherwise("other"))


@query("a08_work", "SELECT kind, count(*) AS n, sum(w)::BIGINT AS fields FROM (SELECT o_orderstatus AS kind, CASE o_orderstatus WHEN 'F' THEN 7 ELSE 2 END AS w FROM orders WHERE o_orderstatus IN ('F', 'O')) GROUP BY ROLLUP (kind)")
def a08(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.work_estimate(table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("kind")), {"F": 7, "O": 2, "none": 3})


@query(
    "a10_todos",
    """
WITH r AS (SELECT l_returnflag AS kind, CASE l_linenumber % 3 WHEN 0 THEN 'es' ELSE 'en' END AS s, CASE l_partkey % 4 WHEN 0 THEN 'es' WHEN 1 THEN 'en' WHEN 2 THEN 'ar' END AS t, l_suppkey % 2 = 0 AS same FROM lineitem),
p AS (SELECT 'gap' AS part, kind AS name FROM r WHERE t IS NULL UNION ALL SELECT 'issue', CASE WHEN t = 'es' THEN 'spanish_not_translated' WHEN same THEN 'identical_not_translated' ELSE 'english_not_translated' END FROM r WHERE t IN ('es', 'en')
  UNION ALL SELECT 'todo', CASE WHEN t = 'ar' THEN 'fix_default_es_to_en' WHEN t = 'es' AND s = 'es' THEN 'translate_es_to_ar' ELSE 'translate' END FROM r WHERE t IN ('es', 'en') OR t = 'ar' AND s = 'es')
SELECT part, name, count(*) AS n FROM p GROUP BY ALL""",
)
def a10(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = F.when(F.col("l_partkey") % 4 == 0, "es").when(F.col("l_partkey") % 4 == 1, "en").when(F.col("l_partkey") % 4 == 2, "ar")
    return summaries.todo_summary(table(spark, sf_dir, "lineitem"), "l_returnflag", F.when(F.col("l_linenumber") % 3 == 0, "es").otherwise("en"), target, F.col("l_suppkey") % 2 == 0)


@query("a27_images", "SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'products_with_images' ELSE 'products_missing_images' END AS counter, count(*) AS n FROM orders GROUP BY 1 UNION ALL SELECT CASE WHEN p_size % 2 = 0 THEN 'metaobject_files_populated' ELSE 'metaobject_files_missing' END, count(*) FROM part GROUP BY 1")
def a27(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 3 == 0, F.array(F.lit("i"))).alias("images"))
    return summaries.image_counters(products, table(spark, sf_dir, "part").select(F.when(F.col("p_size") % 2 == 0, "f").otherwise("").alias("file")))


@query(
    "a29_handle_maps",
    """
SELECT DISTINCT 'products' AS kind, 'p' || p_partkey AS old, 'p' || p_partkey // 2 AS new FROM part WHERE p_size % 3 <> 0 AND p_partkey <> p_partkey // 2
UNION ALL SELECT DISTINCT 'collections', 'c' || s_suppkey, 'd' || s_suppkey FROM supplier WHERE s_suppkey % 2 = 0""",
)
def a29(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = lambda letter, c: F.concat(F.lit(letter), c.cast("string")).alias("handle")
    part, supplier, p, s = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier"), F.col("p_partkey"), F.col("s_suppkey")
    products = part.select(p.alias("id"), of("p", p)), part.select(p.alias("id"), F.when(F.col("p_size") % 3 == 0, "").otherwise(of("p", F.expr("p_partkey div 2"))).alias("handle"))
    collections = supplier.select(s.alias("id"), of("c", s)), supplier.filter(s % 2 == 0).select(s.alias("id"), of("d", s))
    return summaries.handle_maps({"products": products, "collections": collections})


@query("l03_media_order", "SELECT l_orderkey, list('u' || l_partkey ORDER BY l_suppkey % 5, l_partkey) FILTER (WHERE l_returnflag <> 'R') AS srcs FROM lineitem GROUP BY 1".join(("SELECT l_orderkey, coalesce(srcs, []) AS srcs FROM (", ")")))
def l03(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.struct(F.col("l_partkey").alias("k"), F.when(F.col("l_returnflag") != "R", F.concat(F.lit("u"), F.col("l_partkey").cast("string"))).alias("url"), F.lit(None).cast("string").alias("label"), F.nullif(F.col("l_suppkey") % 5, F.lit(0)).cast("int").alias("position"))
    products = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("media"))
    return summaries.media_in_order(products).select("l_orderkey", F.transform("images", lambda i: i["src"]).alias("srcs"))


@query(
    "s08_wanted",
    """
WITH o AS (SELECT l_orderkey, l_linenumber, max(l_partkey) AS p FROM lineitem GROUP BY ALL)
SELECT l_orderkey AS resource_id, list('k' || l_linenumber || '=' || p ORDER BY l_linenumber) AS content FROM o WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1""",
)
def s08(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = F.struct(F.col("l_partkey").alias("p"), F.concat(F.lit("k"), F.col("l_linenumber").cast("string")).alias("key"), F.col("l_partkey").cast("string").alias("value"), F.lit("d").alias("digest"), F.lit(False).alias("outdated"))
    nodes = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("resourceId")).agg(F.array_sort(F.collect_list(entry)).alias("translatableContent"))
    nodes = nodes.withColumn("translations", F.slice("translatableContent", 1, 1))
    found = summaries.wanted_resources(nodes, table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id")))
    return found.select("resource_id", F.array_sort(F.transform(F.map_entries("content"), lambda e: F.concat_ws("=", e["key"], e["value"]["value"]))).alias("content"))


@query(
    "m15_entries",
    """
WITH l AS (SELECT 'h' || p_partkey AS handle, unnest(['name', 'icon', 'more']) AS key, p_size AS z, p_partkey AS k FROM part), lf AS (SELECT * FROM l WHERE NOT (key = 'icon' AND z % 2 = 0)),
r AS (SELECT DISTINCT CASE WHEN s_suppkey % 2 = 0 THEN 'h' ELSE 'n' END || s_suppkey AS handle, s_suppkey AS k, s_nationkey FROM supplier),
a AS (SELECT DISTINCT l.handle, l.k, (SELECT min(r.k) FROM r WHERE r.handle = l.handle OR r.handle = 'n' || l.k AND l.k % 3 <> 0) AS hit FROM l)
SELECT handle, NULL AS key, 'missing' AS verdict FROM a WHERE hit IS NULL
UNION ALL SELECT lf.handle, lf.key, 'empty' FROM lf JOIN a USING (handle) JOIN r ON r.k = a.hit WHERE hit IS NOT NULL AND lf.key IN ('name', 'icon') AND (lf.key = 'icon' OR s_nationkey % 2 = 0)""",
)
def m15(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, s = F.col("p_partkey").cast("string"), F.col("s_suppkey").cast("string")
    left = table(spark, sf_dir, "part").select(F.concat(F.lit("h"), p).alias("handle"), F.explode(F.array(*map(F.lit, ("name", "icon", "more")))).alias("key"), "p_size").select("handle", "key", F.when((F.col("key") == "icon") & (F.col("p_size") % 2 == 0), "").otherwise("v").alias("value"))
    right = table(spark, sf_dir, "supplier").select(F.concat(F.when(F.col("s_suppkey") % 2 == 0, "h").otherwise("n"), s).alias("handle"), F.explode(F.array(F.lit("name"), F.lit("other"))).alias("key"), "s_nationkey").select("handle", "key", F.when((F.col("key") == "name") & (F.col("s_nationkey") % 2 == 0), "").otherwise("v").alias("value"))
    handles = table(spark, sf_dir, "part").filter("p_partkey % 3 <> 0").select(F.concat(F.lit("h"), p).alias("old"), F.concat(F.lit("n"), p).alias("new"))
    return summaries.entry_differences(left, right, handles, ["name", "icon"])
