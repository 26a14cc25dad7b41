"""Queries of batches, containment and suffix joins, each with its SQL."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import classify, text
from tallyloom.operators import contain, extract, menus, rows
from tallyloom.plans.catalog import query
from tallyloom.sources import files
from tallyloom.sources.tables import table

#: normal_form in SQL.
NF = r"trim(regexp_replace(lower(regexp_replace(regexp_replace({0}, '<[^>]+>', ' ', 'g'), '%\{{[^}}]*\}}', ' ', 'g')), '[ \t\n\x0B\f\r]+', ' ', 'g'))"


def lines_of(df: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """(id, pos, line)."""
    return df.select(F.col(id_col).alias("id"), F.posexplode(F.split(F.coalesce(text_col, F.lit("")), "\n")).alias("pos", "line"))


@query(
    "w04_batches",
    r"""
WITH RECURSIVE d AS (SELECT source, doc_id, coalesce(text, '') AS text, greatest(1, length(coalesce(text, '')) // 3) > 1500 AS large FROM documents),
u AS (SELECT source, doc_id, CASE WHEN contains(text, chr(10) || chr(10)) THEN regexp_extract_all(text, '(?s).+?(?:\n\n\n*|\z)') WHEN contains(text, chr(10)) THEN regexp_extract_all(text, '[^\n]*\n|[^\n]+\z')
    WHEN regexp_matches(text, '[.!?。][ \t\n\x0B\f\r]') THEN regexp_extract_all(text, '(?s).+?(?:[.!?。][ \t\n\x0B\f\r]+|\z)') ELSE list_transform(range((length(text) + 4499) // 4500), lambda i: substr(text, i * 4500 + 1, 4500)) END AS parts FROM d WHERE large),
x AS (SELECT source, doc_id, p AS part, length(p) AS n, k FROM (SELECT source, doc_id, unnest(parts) AS p, generate_subscripts(parts, 1) AS k FROM u)),
c AS (SELECT source, doc_id, k, n AS size, 0 AS piece FROM x WHERE k = 1
  UNION ALL SELECT x.source, x.doc_id, x.k, CASE WHEN c.size + x.n <= 3600 THEN c.size + x.n ELSE x.n END, CASE WHEN c.size + x.n <= 3600 THEN c.piece ELSE c.piece + 1 END FROM c JOIN x ON x.doc_id = c.doc_id AND x.k = c.k + 1),
f AS (SELECT source, doc_id, 0 AS part, false AS alone, greatest(1, length(text) // 3) + 5 AS w FROM d WHERE NOT large UNION ALL SELECT source, doc_id, piece, true, greatest(1, max(size) // 3) + 5 FROM c GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id, part) AS rn FROM f),
g AS (SELECT source, doc_id, part, alone, rn, w, w AS total, 0 AS batch FROM o WHERE rn = 1
  UNION ALL SELECT o.source, o.doc_id, o.part, o.alone, o.rn, o.w, CASE WHEN o.alone OR g.alone OR g.total + o.w > 1505 THEN o.w ELSE g.total + o.w END, CASE WHEN o.alone OR g.alone OR g.total + o.w > 1505 THEN g.batch + 1 ELSE g.batch END
  FROM g JOIN o ON o.source = g.source AND o.rn = g.rn + 1)
SELECT source, doc_id, part, w AS weight, batch FROM g""",
)
def w04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.field_batches(table(spark, sf_dir, "documents"), "source", "doc_id", "doc_id", "text", 1500, 1500).select("source", "doc_id", "part", "weight", "batch")


@query(
    "m32_substring",
    f"""
WITH t AS (SELECT DISTINCT trim(line) AS text FROM (SELECT unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents) WHERE trim(line) <> ''),
b AS (SELECT item_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM benchmark),
f AS (SELECT item_id * 1000 + pos AS id, trim(line) AS english FROM b WHERE trim(line) <> ''),
tn AS (SELECT text, nullif({NF.format("text")}, '') AS nf FROM t), fn AS (SELECT id, english, nullif({NF.format("english")}, '') AS nf FROM f),
e AS (SELECT english, min(id) AS id FROM f GROUP BY 1), a AS (SELECT nf, min(id) AS id FROM fn WHERE nf IS NOT NULL GROUP BY 1),
m AS (SELECT tn.text, tn.nf, e.id AS exact_id, a.id AS alike_id FROM tn LEFT JOIN e ON e.english = tn.text LEFT JOIN a ON a.nf = tn.nf),
s AS (SELECT m.nf, min(fn.id) AS id FROM (SELECT DISTINCT nf FROM m WHERE exact_id IS NULL AND alike_id IS NULL AND length(nf) >= 4) m JOIN fn ON contains(m.nf, fn.nf) OR contains(fn.nf, m.nf) GROUP BY 1)
SELECT text, coalesce(exact_id, alike_id, s.id) AS id, CASE WHEN exact_id IS NOT NULL THEN 'exact' WHEN alike_id IS NOT NULL THEN 'normalized' WHEN s.id IS NOT NULL THEN 'substring' END AS step
FROM m LEFT JOIN s ON s.nf = m.nf""",
)
def m32(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = lines_of(table(spark, sf_dir, "documents"), "doc_id").select(F.col("line").alias("text"))
    fields = lines_of(table(spark, sf_dir, "benchmark"), "item_id").select((F.col("id") * 1000 + F.col("pos")).alias("id"), F.col("line").alias("english")).withColumn("ord", F.col("id"))
    return contain.matched_keys(texts, fields, text.normal_form).select("text", "id", "step")


def looked_up() -> Column:
    """A value for each turn: blank, an address, with other blanks, a part of the text, or the text within another."""
    k, c = F.col("turn") % 5, F.col("text")
    return F.when(k == 0, F.substring(c, 6, 24)).when(k == 1, F.concat(F.lit("Read: "), c)).when(k == 2, F.concat(F.lit("  "), F.replace(c, F.lit(" "), F.lit("  ")))).when(k == 3, F.concat(F.lit("https://x.y/"), F.col("conv_id").cast("string"))).otherwise(c)


@query(
    "m34_verdict",
    f"""
WITH f AS (SELECT conv_id, turn, CASE turn % 5 WHEN 0 THEN substr(text, 6, 24) WHEN 1 THEN 'Read: ' || text WHEN 2 THEN '  ' || replace(text, ' ', '  ') WHEN 3 THEN 'https://x.y/' || conv_id ELSE text END AS v FROM conversations),
s AS (SELECT DISTINCT text FROM conversations WHERE trim(text) <> '' AND turn % 2 = 0),
n AS (SELECT text, {NF.format("text")} AS nf FROM s), fv AS (SELECT *, {NF.format("v")} AS nf, trim(coalesce(v, '')) = '' AS blank, coalesce(v LIKE 'https://%', false) AS other FROM f),
m AS (SELECT fv.*, v IN (SELECT text FROM s) AS exact_, nf IN (SELECT nf FROM n WHERE length(nf) >= 2) AS alike FROM fv),
p AS (SELECT q.nf, min(n.text) AS text FROM (SELECT DISTINCT nf FROM m WHERE NOT blank AND NOT other AND NOT exact_ AND NOT alike AND length(nf) >= 4) q JOIN n ON length(n.nf) >= 4 AND (contains(q.nf, n.nf) OR contains(n.nf, q.nf)) GROUP BY 1)
SELECT conv_id, turn, CASE WHEN blank THEN 'empty' WHEN other THEN 'non_text' WHEN exact_ OR alike OR p.text IS NOT NULL THEN 'visible' ELSE 'not_visible' END AS verdict,
  CASE WHEN blank OR other THEN NULL WHEN exact_ THEN 'exact' WHEN alike THEN 'normalized' WHEN p.text IS NOT NULL THEN 'substring' END AS match_type,
  CASE WHEN NOT (blank OR other OR exact_ OR alike) THEN substr(p.text, 1, 80) END AS matched_text
FROM m LEFT JOIN p ON p.nf = m.nf""",
)
def m34(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations")
    site = files.text_index(talks.filter("turn % 2 = 0").select("text", F.col("conv_id").alias("page"), "turn"), "text", "page", "turn", 5)
    found = contain.lookup_verdict(talks.select("conv_id", "turn", looked_up().alias("v")), "v", site, text.normal_form, classify.is_no_display_text)
    return found.select("conv_id", "turn", "verdict", "match_type", "matched_text")


@query(
    "m10_store_match",
    r"""
WITH l AS (SELECT page_id AS id, CASE WHEN page_id % 6 < 2 THEN 'h' || (page_id % 40) ELSE 'p' || page_id END AS handle, lower(coalesce(nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), ''), url)) AS title FROM pages),
r AS (SELECT doc_id AS id, 'h' || (doc_id % 60) AS handle, lower(substr(coalesce(text, ''), 1, 60)) AS title FROM documents),
h AS (SELECT 'h' || c_custkey AS old, 'h' || ((c_custkey * 7) % 70) AS new FROM customer WHERE c_custkey < 40 AND c_custkey % 2 = 0),
at_ AS (SELECT handle, max(id) AS id FROM r GROUP BY 1),
j AS (SELECT l.*, h.new, m.id AS mapped, o.id AS own, h.new IS NOT NULL AND l.id > min(l.id) OVER (PARTITION BY h.new) AS lost FROM l LEFT JOIN h ON h.old = l.handle LEFT JOIN at_ m ON m.handle = h.new LEFT JOIN at_ o ON o.handle = l.handle),
c AS (SELECT *, CASE WHEN mapped IS NOT NULL THEN new WHEN own IS NOT NULL THEN handle END AS claim FROM j WHERE NOT lost),
k AS (SELECT * FROM c WHERE claim IS NULL OR id = (SELECT min(d.id) FROM c d WHERE d.claim = c.claim)),
w AS (SELECT id, title, list_filter(regexp_split_to_array(title, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS words FROM r),
t AS (SELECT k.id, min(w.id) AS hit FROM k JOIN w ON len(list_distinct(list_intersect(list_filter(regexp_split_to_array(k.title, '[ \t\n\x0B\f\r]+'), lambda x: x <> ''), w.words))) >= 2
      OR contains(k.title, w.title) OR contains(w.title, k.title) WHERE k.claim IS NULL GROUP BY 1)
SELECT k.id AS left_id, coalesce(mapped, own, t.hit) AS right_id, CASE WHEN mapped IS NOT NULL THEN 'mapped' WHEN own IS NOT NULL THEN 'handle' WHEN t.hit IS NOT NULL THEN 'title' END AS step FROM k LEFT JOIN t ON t.id = k.id""",
)
def m10(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, d, c = F.col("page_id"), F.col("doc_id"), F.col("c_custkey")
    title = F.coalesce(F.nullif(F.regexp_extract("html", "<title>([^<]*)</title>", 1), F.lit("")), F.col("url"))
    handle = F.when(k % 6 < 2, F.concat(F.lit("h"), (k % 40).cast("string"))).otherwise(F.concat(F.lit("p"), k.cast("string")))
    left = table(spark, sf_dir, "pages").select(k.alias("id"), k.alias("ord"), handle.alias("handle"), title.alias("title"))
    right = table(spark, sf_dir, "documents").select(d.alias("id"), d.alias("ord"), F.concat(F.lit("h"), (d % 60).cast("string")).alias("handle"), F.substring(F.coalesce("text", F.lit("")), 1, 60).alias("title"))
    handles = table(spark, sf_dir, "customer").filter("c_custkey < 40 AND c_custkey % 2 = 0").select(F.concat(F.lit("h"), c.cast("string")).alias("old"), F.concat(F.lit("h"), ((c * 7) % 70).cast("string")).alias("new"))
    return contain.store_matches(left, right, handles)


@query(
    "m37_suffix",
    """
WITH k AS (SELECT l_orderkey * 10 + l_linenumber AS ord, lower(l_returnflag) || '.' || (l_partkey % 7) || '.item-' || l_partkey || CASE WHEN l_linenumber % 3 = 0 THEN '.v2' ELSE '' END AS key FROM lineitem),
h AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'item-' || p_partkey || '.v2' ELSE 'item-' || p_partkey END AS handle FROM part)
SELECT p_partkey, min_by(key, ord) AS key, min(ord) AS ord FROM h JOIN k ON ends_with(k.key, '.' || h.handle) GROUP BY p_partkey""",
)
def m37(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, item = F.col("p_partkey").cast("string"), F.concat(F.lit("item-"), F.col("l_partkey").cast("string"))
    key = F.concat_ws(".", F.lower("l_returnflag"), (F.col("l_partkey") % 7).cast("string"), item, F.when(F.col("l_linenumber") % 3 == 0, "v2"))
    keys = table(spark, sf_dir, "lineitem").select(key.alias("key"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord")).withColumn("what", F.col("ord"))
    handle = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("item-"), p, F.lit(".v2"))).otherwise(F.concat(F.lit("item-"), p))
    parts = table(spark, sf_dir, "part").select("p_partkey", handle.alias("handle"))
    return parts.join(contain.by_suffix(keys, parts), "handle").select("p_partkey", "key", F.col("what").alias("ord"))


def orders_as_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, doc): an order with its lines as JSON. Strings, whole numbers, booleans, nulls, an array of objects and one of strings."""
    line = F.struct(F.col("l_partkey").alias("part"), F.col("l_returnflag").alias("flag"), F.col("l_quantity").cast("int").alias("n"), (F.col("l_linestatus") == "O").alias("open"))
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(line).alias("lines"))
    flags = F.array_sort(F.array_distinct(F.filter(F.transform("lines", lambda x: x["flag"]), lambda x: x.isNotNull())))
    orders = table(spark, sf_dir, "orders").join(lines.withColumn("flags", flags), "o_orderkey", "left")
    whole = F.struct(F.struct(F.col("o_orderpriority").alias("priority"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderstatus")).alias("state")).alias("head"), F.col("o_custkey").alias("customer"), "lines", "flags")
    return orders.select("o_orderkey", F.to_json(whole, {"ignoreNullFields": "false"}).alias("doc"))


@query(
    "a22_paths",
    """
WITH l AS (SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)), g AS (SELECT o_orderkey, count(l_orderkey) AS n, count(DISTINCT l_returnflag) AS f FROM orders LEFT JOIN l ON l_orderkey = o_orderkey GROUP BY 1),
v AS (
  SELECT '$.head.priority' AS path, 'str' AS kind, o_orderpriority AS value, NULL::BIGINT AS items FROM orders
  UNION ALL SELECT '$.head.state', CASE WHEN o_orderstatus = 'F' THEN 'str' ELSE 'null' END, CASE WHEN o_orderstatus = 'F' THEN 'F' END, NULL FROM orders
  UNION ALL SELECT '$.customer', 'int', o_custkey::VARCHAR, NULL FROM orders
  UNION ALL SELECT CASE WHEN n > 0 THEN '$.lines[]' ELSE '$.lines' END, CASE WHEN n > 0 THEN 'array' ELSE 'null' END, NULL, CASE WHEN n > 0 THEN n END FROM g
  UNION ALL SELECT CASE WHEN n > 0 THEN '$.flags[]' ELSE '$.flags' END, CASE WHEN n > 0 THEN 'array' ELSE 'null' END, NULL, CASE WHEN n > 0 THEN f END FROM g
  UNION ALL SELECT '$.flags[]', 'str', l_returnflag, NULL FROM (SELECT DISTINCT l_orderkey, l_returnflag FROM l)
  UNION ALL SELECT '$.lines[].part', 'int', l_partkey::VARCHAR, NULL FROM l
  UNION ALL SELECT '$.lines[].flag', 'str', l_returnflag, NULL FROM l
  UNION ALL SELECT '$.lines[].n', 'int', l_quantity::INT::VARCHAR, NULL FROM l
  UNION ALL SELECT '$.lines[].open', 'bool', CASE WHEN l_linestatus = 'O' THEN 'true' ELSE 'false' END, NULL FROM l),
m AS (SELECT *, value IS NOT NULL AND value <> '' AND NOT (kind <> 'str' AND value IN ('0', 'false')) AS filled FROM v)
SELECT path, list_sort(list(DISTINCT kind)) AS kinds, count(*) AS n, count(*) FILTER (WHERE filled) AS n_filled, coalesce(max(length(value)) FILTER (WHERE filled AND kind = 'str'), 0) AS longest,
  list_slice(list_sort(coalesce(list(DISTINCT value) FILTER (WHERE filled), [])), 1, 3) AS samples, coalesce(sum(items), 0)::BIGINT AS n_items
FROM m GROUP BY path""",
)
def a22_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.json_dictionary(orders_as_json(spark, sf_dir), "doc").select("path", "kinds", "n", "n_filled", "longest", "samples", "n_items")


@query(
    "p15_menu",
    """
WITH RECURSIVE c AS (SELECT p_partkey AS id, CASE WHEN p_partkey >= 3 THEN p_partkey // 3 END AS parent, -p_partkey AS pos, CASE WHEN p_size = 13 THEN '' ELSE p_name || ' ' || p_partkey END AS name,
    CASE WHEN p_size % 4 = 0 THEN 'root' WHEN p_size = 7 THEN NULL ELSE 'k' || p_partkey END AS url_key, p_size % 3 AS n FROM part),
k AS (SELECT 'k' || s_suppkey * 5 AS url_key, s_suppkey AS id FROM supplier),
t AS (SELECT c.*, (coalesce(url_key, '') IN ('', 'root') OR name = '') AS over FROM c),
w AS (SELECT id, NULL::BIGINT AS above, [pos] AS place, over FROM t WHERE parent IS NULL OR parent NOT IN (SELECT id FROM t)
  UNION ALL SELECT t.id, CASE WHEN w.over THEN w.above ELSE w.id END, CASE WHEN w.over THEN list_append(w.place, t.pos) ELSE [t.pos] END, t.over FROM w JOIN t ON t.parent = w.id)
SELECT w.id, above, place, name AS title, 'gid://shopify/Collection/' || k.id AS resource_id, CASE WHEN k.id IS NULL THEN '/collections/' || t.url_key END AS url
FROM w JOIN t USING (id) LEFT JOIN k ON k.url_key = t.url_key WHERE NOT w.over AND (k.id IS NOT NULL OR n <> 0 OR w.id IN (SELECT parent FROM t))""",
)
def p15(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    name = F.when(size == 13, "").otherwise(F.concat_ws(" ", "p_name", k.cast("string")))
    key = F.when(size % 4 == 0, "root").when(size == 7, None).otherwise(F.concat(F.lit("k"), k.cast("string")))
    categories = table(spark, sf_dir, "part").select(F.lit(1).alias("tree"), k.alias("id"), F.when(k >= 3, F.expr("p_partkey div 3")).alias("parent"), (-k).alias("pos"), name.alias("name"), key.alias("url_key"), (size % 3).alias("product_count"))
    collections = table(spark, sf_dir, "supplier").select(F.concat(F.lit("k"), (F.col("s_suppkey") * 5).cast("string")).alias("url_key"), F.col("s_suppkey").alias("id"))
    return menus.category_menu(categories, collections, ("root",)).drop("tree")
