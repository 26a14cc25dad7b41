"""The registered queries over the driver tables, each with its SQL."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import classify, text, trees
from tallyloom.operators import audit, dedup, flatten, match, sequence
from tallyloom.sources.tables import table

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return register


# --- matching ---------------------------------------------------------------------------------------------------------


def second_catalog(parts: DataFrame) -> DataFrame:
    """Another system's catalog made from `part`: other ids, some keys changed, some rows gone."""
    k = F.col("p_partkey")
    return parts.filter(k % 11 != 0).select(
        (k + 1_000_000).alias("t_id"),
        F.when(k % 3 == 0, F.concat(F.lit("x"), k.cast("string"))).otherwise(k.cast("string")).alias("t_sku"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(F.concat_ws("-", text.plain_slug(F.col("p_name")), (k % 40).cast("string"))).alias("t_handle"),
    )


CATALOG_SQL = """
WITH src AS (SELECT p_partkey AS id, p_partkey::VARCHAR AS sku,
    trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') || '-' || (p_partkey % 40) AS handle FROM part),
tgt AS (SELECT p_partkey + 1000000 AS t_id, CASE WHEN p_partkey % 3 = 0 THEN 'x' || p_partkey ELSE p_partkey::VARCHAR END AS t_sku,
    CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') || '-' || (p_partkey % 40) END AS t_handle
  FROM part WHERE p_partkey % 11 <> 0),
idx AS (SELECT 0 AS rank, t_sku AS key, max(t_id) AS t_id FROM tgt GROUP BY t_sku
  UNION ALL SELECT 1, t_handle, max(t_id) FROM tgt WHERE t_handle IS NOT NULL GROUP BY t_handle),
hits AS (SELECT s.id, i.rank, i.t_id FROM src s JOIN idx i ON i.rank = 0 AND i.key = s.sku
  UNION ALL SELECT s.id, i.rank, i.t_id FROM src s JOIN idx i ON i.rank = 1 AND i.key = s.handle),
ladder AS (SELECT id AS source_id, min_by(t_id, rank) AS target_id, CASE min(rank) WHEN 0 THEN 'sku' ELSE 'handle' END AS method FROM hits GROUP BY id)
"""


def ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    handle = F.concat_ws("-", text.plain_slug(F.col("p_name")), (F.col("p_partkey") % 40).cast("string"))
    source = [("sku", F.col("p_partkey").cast("string")), ("handle", handle)]
    target = [("sku", F.col("t_sku")), ("handle", F.col("t_handle"))]
    other = second_catalog(parts).withColumnRenamed("t_id", "id")
    return match.key_ladder(parts.withColumnRenamed("p_partkey", "id").withColumn("p_partkey", F.col("id")), other, "id", "id", source, target)


@query("m01_match_ladder", CATALOG_SQL + "SELECT * FROM ladder")
def m01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ladder(spark, sf_dir)


@query("m02_unmatched", CATALOG_SQL + "SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT source_id FROM ladder)")
def m02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").join(ladder(spark, sf_dir), F.col("p_partkey") == F.col("source_id"), "left_anti").select("p_partkey", "p_name")


@query("m04_present", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def m04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query(
    "m06_gaps",
    """
WITH o AS (SELECT DISTINCT o_custkey, o_orderpriority FROM orders), p AS (SELECT DISTINCT o_orderpriority AS missing FROM orders WHERE o_orderpriority IS NOT NULL)
SELECT c_custkey, c_name, missing FROM customer CROSS JOIN p WHERE NOT EXISTS (SELECT 1 FROM o WHERE o_custkey = c_custkey AND o_orderpriority = missing)
UNION ALL SELECT c_custkey, c_name, 'any' FROM customer WHERE NOT EXISTS (SELECT 1 FROM o WHERE o_custkey = c_custkey)""",
)
def m06(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without an order of a priority, for each there is, and without any order at all."""
    customers, orders = table(spark, sf_dir, "customer").select("c_custkey", "c_name"), table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority").distinct()
    own, priority = F.col("c_custkey") == F.col("o_custkey"), F.col("o_orderpriority").alias("missing")
    each = customers.crossJoin(F.broadcast(orders.filter("o_orderpriority is not null").select(priority).distinct()))
    lacking = each.join(orders, own & (F.col("missing") == F.col("o_orderpriority")), "left_anti")
    return lacking.unionByName(customers.join(orders, own, "left_anti").withColumn("missing", F.lit("any")))


@query("m07_one_to_one", CATALOG_SQL + "SELECT min(source_id) AS source_id, target_id, min_by(method, source_id) AS method FROM ladder GROUP BY target_id")
def m07(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match.one_to_one(ladder(spark, sf_dir), F.col("source_id"))


@query(
    "m08_key_remap",
    r"""
WITH m AS (SELECT page_id, url AS old, regexp_replace(regexp_replace(regexp_replace(regexp_replace(url, '^[a-z]+://[^/]*', ''), '[?#].*$', ''), '/+$', ''), '^/[a-z][a-z](/|$)', '/') AS new FROM pages)
SELECT * FROM m WHERE new <> '' AND new <> old""",
)
def m08(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    mapped = pages.select("page_id", F.col("url").alias("old"), text.path_of(F.col("url")).alias("new"))
    return mapped.filter((F.col("new") != "") & (F.col("new") != F.col("old")))


@query(
    "m16_schema_diff",
    """
WITH f AS (SELECT event_type AS type, substr(props, 3, 1) || (event_id % 7) AS field, CASE WHEN event_id % 2 = 0 THEN 'int' ELSE 'text' END AS kind FROM events),
a AS (SELECT type, field, min(kind) AS kind FROM f GROUP BY ALL),
b AS (SELECT CASE type WHEN 'click' THEN 'tap' ELSE type END AS type, CASE WHEN field LIKE '%4' THEN field || 'x' ELSE field END AS field, max(kind) AS kind FROM f GROUP BY ALL),
j AS (SELECT coalesce(a.type, b.type) AS type, coalesce(a.field, b.field) AS field, a.kind AS left_kind, b.kind AS right_kind FROM a FULL JOIN b ON a.type = b.type AND a.field = b.field),
v AS (SELECT *, CASE WHEN type NOT IN (SELECT type FROM b) THEN 'missing_type' WHEN type NOT IN (SELECT type FROM a) THEN 'extra_type'
  WHEN right_kind IS NULL THEN 'missing' WHEN left_kind IS NULL THEN 'extra' WHEN left_kind <> right_kind THEN 'mismatch' END AS verdict FROM j)
SELECT * FROM v WHERE verdict IS NOT NULL""",
)
def m16(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events on both sides; on the right one type and some fields have other names."""
    events = table(spark, sf_dir, "events")
    field = F.concat(F.substring("props", 3, 1), (F.col("event_id") % 7).cast("string"))
    kind = F.when(F.col("event_id") % 2 == 0, "int").otherwise("text")
    rows = events.select(F.col("event_type").alias("type"), field.alias("field"), kind.alias("kind"))
    left = rows.groupBy("type", "field").agg(F.min("kind").alias("kind"))
    renamed = rows.select(F.when(F.col("type") == "click", "tap").otherwise(F.col("type")).alias("type"), F.when(F.col("field").like("%4"), F.concat("field", F.lit("x"))).otherwise(F.col("field")).alias("field"), "kind")
    return match.schema_difference(left, renamed.groupBy("type", "field").agg(F.max("kind").alias("kind")))


@query("m18_dangling", "SELECT l_orderkey, l_linenumber, l_partkey + 150 AS p_partkey FROM lineitem WHERE l_partkey + 150 NOT IN (SELECT p_partkey FROM part)")
def m18(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") + 150).alias("p_partkey"))
    return match.dangling_references(edges, table(spark, sf_dir, "part"), "p_partkey").select("l_orderkey", "l_linenumber", "p_partkey")


@query(
    "m19_jaccard_best",
    """
WITH t AS (SELECT DISTINCT o_orderkey AS id, l_partkey AS item, o_orderpriority < '3' AS is_left FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
n AS (SELECT id, count(*) AS n FROM t GROUP BY id),
c AS (SELECT l.id AS left_id, r.id AS right_id, count(*) AS n_both FROM t l JOIN t r ON l.item = r.item AND l.is_left AND NOT r.is_left GROUP BY ALL),
s AS (SELECT left_id, right_id, n_both::DOUBLE / (ln.n + rn.n - n_both)::DOUBLE AS score FROM c JOIN n ln ON ln.id = left_id JOIN n rn ON rn.id = right_id)
SELECT left_id, right_id, score FROM s WHERE score >= 0.4 QUALIFY row_number() OVER (PARTITION BY left_id ORDER BY score DESC, right_id) = 1""",
)
def m19(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of the two most urgent priorities against all others, by the parts that they hold."""
    lines = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    sets = lines.groupBy(F.col("o_orderkey").alias("id"), (F.col("o_orderpriority") < "3").alias("_left")).agg(F.collect_set("l_partkey").alias("items"))
    return match.jaccard_best(sets.filter("_left"), sets.filter("not _left"), 0.4)


@query(
    "m20_price_enrich",
    """
SELECT l_orderkey, l_linenumber, coalesce(CASE WHEN l_partkey % 4 <> 0 THEN p_retailprice END, l_extendedprice) AS price,
  CASE WHEN l_partkey % 4 <> 0 AND p_retailprice IS NOT NULL THEN CASE WHEN p_retailprice <> l_extendedprice THEN l_extendedprice END ELSE l_tax END AS compare_at
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""",
)
def m20(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = table(spark, sf_dir, "part").filter("p_partkey % 4 <> 0").select("p_partkey", F.col("p_retailprice").alias("_final"))
    lines = table(spark, sf_dir, "lineitem").join(prices, F.col("l_partkey") == F.col("p_partkey"), "left")
    regular = F.when(F.col("_final") != F.col("l_extendedprice"), F.col("l_extendedprice"))
    return lines.select("l_orderkey", "l_linenumber", F.coalesce("_final", "l_extendedprice").alias("price"), F.when(F.col("_final").isNotNull(), regular).otherwise(F.col("l_tax")).alias("compare_at"))


@query(
    "m25_remap_references",
    """
SELECT l_orderkey, string_agg((l_partkey * 10)::VARCHAR, ',' ORDER BY l_linenumber, l_partkey) AS mapped FROM lineitem WHERE l_partkey % 3 <> 0 GROUP BY l_orderkey""",
)
def m25(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"])
    refs = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(listed.alias("refs"))
    mapping = table(spark, sf_dir, "part").filter("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("old"), (F.col("p_partkey") * 10).alias("new"))
    return match.remap_references(refs, "l_orderkey", "refs", mapping).select("l_orderkey", F.array_join("refs", ",").alias("mapped"))


PATH_SQL = "regexp_replace(regexp_replace(regexp_replace(url, '^[a-z]+://[^/]*', ''), '[?#].*$', ''), '/+$', '')"


@query(
    "m29_redirects",
    f"""
WITH t AS (SELECT page_id, {PATH_SQL} AS path FROM pages),
m AS (SELECT * FROM (VALUES ('/fr', '/francais', 2), ('/en', '/english', 1), ('/fr/825', '/special', 3)) v(old, new, ord)),
h AS (SELECT page_id, path, old, new, row_number() OVER (PARTITION BY page_id ORDER BY CASE WHEN old = path THEN 0 ELSE 1 END, ord) AS rn FROM t JOIN m ON path = old OR starts_with(path, old || '/'))
SELECT t.page_id, t.path, coalesce(h.new || substr(t.path, length(h.old) + 1), t.path) AS new_path FROM t LEFT JOIN h ON h.page_id = t.page_id AND rn = 1""",
)
def m29(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.regexp_replace(F.regexp_replace(F.regexp_replace("url", "^[a-z]+://[^/]*", ""), "[?#].*$", ""), "/+$", "")
    mapping = spark.createDataFrame([("/fr", "/francais", 2), ("/en", "/english", 1), ("/fr/825", "/special", 3)], "old string, new string, ord int")
    return match.remap_paths(table(spark, sf_dir, "pages").select("page_id", path.alias("path")), "path", mapping)


@query(
    "m41_upsert",
    """
WITH change AS (SELECT doc_id + 7 AS doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE 1 - quality END AS quality FROM labels)
SELECT coalesce(b.doc_id, c.doc_id) AS doc_id, coalesce(c.quality, b.quality) AS quality,
  CASE WHEN b.doc_id IS NULL THEN 'insert' WHEN c.quality IS NOT NULL AND c.quality IS DISTINCT FROM b.quality THEN 'update' ELSE 'keep' END AS action
FROM labels b FULL JOIN change c ON b.doc_id = c.doc_id""",
)
def m41(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All labels, and all labels changed under other ids."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    change = labels.select((F.col("doc_id") + 7).alias("doc_id"), F.when(F.col("doc_id") % 7 != 0, 1 - F.col("quality")).alias("quality"))
    return match.upsert(labels, change, ["doc_id"], "quality")


# --- choice of rows -----------------------------------------------------------------------------------------------------


@query("a04_duplicates", "SELECT CASE WHEN text IS NOT NULL THEN sha256(text) END AS text_sha, count(*) AS n, count(*) - 1 AS wasted FROM documents GROUP BY text HAVING count(*) > 1")
def a04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.repeated_values(table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("text_sha")), "text_sha")


@query("a13_first_wins", "SELECT o_custkey, o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1")
def a13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.first_wins(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], F.col("o_orderkey"))


@query("a13_last_wins", "SELECT o_custkey, o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1")
def a13_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.last_wins(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], F.col("o_orderkey"))


@query(
    "a17_best_by_score",
    """
SELECT o_custkey, o_orderkey, 100 * (o_orderstatus = 'O')::INT + length(o_orderpriority) AS score FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY 100 * (o_orderstatus = 'O')::INT + length(o_orderpriority) DESC, o_orderkey) = 1""",
)
def a17(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = 100 * (F.col("o_orderstatus") == "O").cast("int") + F.length("o_orderpriority")
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", score.alias("score"))
    return dedup.best_by(orders, ["o_custkey"], F.col("score"), F.col("o_orderkey"))


# --- counts and profiles ------------------------------------------------------------------------------------------------


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    status = F.when(F.col("quality").isNull(), "MISSING").when(F.col("toxic") == 1, "TOXIC").when(F.col("quality") == 0, "POOR").otherwise("OK")
    return docs.select("doc_id", "lang", "source").join(labels, "doc_id", "left").select("doc_id", "lang", "source", status.alias("status"))


LABELLED_SQL = """WITH s AS (SELECT d.doc_id, lang, source, CASE WHEN quality IS NULL THEN 'MISSING' WHEN toxic = 1 THEN 'TOXIC' WHEN quality = 0 THEN 'POOR' ELSE 'OK' END AS status
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
"""


@query("a01_status_rollup", LABELLED_SQL + "SELECT lang, count(*) AS n, count(*) FILTER (status = 'OK') AS n_good, 100::DOUBLE * count(*) FILTER (status = 'OK') / count(*) AS percent_good FROM s GROUP BY ROLLUP (lang)")
def a01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.status_rollup(labelled(spark, sf_dir), "lang", F.col("status"), "OK")


@query("a02_counts", LABELLED_SQL + "SELECT source, status, count(*) AS n FROM s GROUP BY ALL")
def a02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(spark, sf_dir).groupBy("source", "status").agg(F.count(F.lit(1)).alias("n"))


@query(
    "a11_coverage",
    LABELLED_SQL
    + """, c AS (SELECT source, count(*) FILTER (doc_id % 13 = 0) AS n_empty, count(*) FILTER (doc_id % 13 <> 0 AND status = 'TOXIC') AS n_not_text,
  count(*) FILTER (doc_id % 13 <> 0 AND status = 'POOR') AS n_keep, count(*) FILTER (doc_id % 13 <> 0 AND status = 'OK') AS n_translated, count(*) FILTER (doc_id % 13 <> 0 AND status = 'MISSING') AS n_gap FROM s GROUP BY source)
SELECT *, CASE WHEN n_translated + n_gap > 0 THEN 100::DOUBLE * n_translated / (n_translated + n_gap) ELSE 100 END AS coverage FROM c""",
)
def a11(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("status")
    bucket = F.when(F.col("doc_id") % 13 == 0, "empty").when(s == "TOXIC", "not_text").when(s == "POOR", "keep").when(s == "OK", "translated").otherwise("gap")
    return audit.coverage(labelled(spark, sf_dir), "source", bucket)


@query(
    "a21_section_score",
    LABELLED_SQL
    + """, f AS (SELECT source AS section, CASE status WHEN 'OK' THEN 'pass' WHEN 'TOXIC' THEN 'fail' ELSE 'warn' END AS verdict FROM s)
SELECT section, count(*) FILTER (verdict = 'pass') AS n_pass, count(*) FILTER (verdict = 'fail') AS n_fail, count(*) FILTER (verdict = 'warn') AS n_warn,
  count(*) FILTER (verdict = 'pass')::DOUBLE / greatest(count(*) FILTER (verdict IN ('pass', 'fail')), 1) AS score FROM f GROUP BY section""",
)
def a21(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdict = F.when(F.col("status") == "OK", "pass").when(F.col("status") == "TOXIC", "fail").otherwise("warn")
    return audit.section_score(labelled(spark, sf_dir).select(F.col("source").alias("section"), verdict.alias("verdict")))


@query(
    "a22_profile",
    """
WITH k AS (SELECT unnest(json_keys(props)) AS path, props FROM events), v AS (SELECT path, json_extract_string(props, '$.' || path) AS v FROM k)
SELECT path, count(*) AS n, count(*) FILTER (v IS NOT NULL AND v <> '') AS n_filled, max(length(v)) AS longest, count(DISTINCT v) AS n_distinct FROM v GROUP BY path""",
)
def a22(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.json_profile(table(spark, sf_dir, "events"), "props")


@query(
    "a25_run_delta",
    """
WITH a AS (SELECT o_orderstatus AS status, count(*) AS before FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1), b AS (SELECT o_orderstatus AS status, count(*) AS after FROM orders WHERE o_orderkey % 2 = 1 GROUP BY 1)
SELECT coalesce(a.status, b.status) AS status, coalesce(before, 0) AS before, coalesce(after, 0) AS after, coalesce(after, 0) - coalesce(before, 0) AS delta FROM a FULL JOIN b ON a.status = b.status""",
)
def a25(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    return audit.run_delta(orders.filter("o_orderkey % 2 = 0"), orders.filter("o_orderkey % 2 = 1"), "status")


@query(
    "l07_precedence",
    """
WITH f AS (SELECT doc_id, 'script' AS source, 'q' || quality AS reason FROM labels UNION ALL SELECT doc_id, 'model', 't' || toxic FROM labels WHERE doc_id % 3 = 0 UNION ALL SELECT doc_id, 'other', 'x' FROM labels WHERE doc_id % 2 = 0)
SELECT doc_id, source, reason FROM f QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY CASE source WHEN 'model' THEN 0 WHEN 'script' THEN 1 ELSE 999 END, source, reason) = 1""",
)
def l07(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    row = lambda df, source, reason: df.select("doc_id", F.lit(source).alias("source"), reason.alias("reason"))
    found = row(labels, "script", F.concat(F.lit("q"), F.col("quality").cast("string"))).unionByName(row(labels.filter("doc_id % 3 = 0"), "model", F.concat(F.lit("t"), F.col("toxic").cast("string"))))
    return audit.strongest_finding(found.unionByName(row(labels.filter("doc_id % 2 = 0"), "other", F.lit("x"))), "doc_id", {"model": 0, "script": 1})


# --- order --------------------------------------------------------------------------------------------------------------


def tokens(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("([a-z]{3,})"), 1))


@query(
    "w01_shift",
    """
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos, list_distinct(regexp_extract_all(lower(text), '[a-z]{3,}')) AS w FROM conversations),
s AS (SELECT conv_id, pos, w, list_distinct(list_filter(w, lambda x: length(x) > 4)) AS own_w FROM t),
m AS (SELECT a.conv_id, a.pos, b.pos - a.pos AS o, len(list_intersect(a.w, a.own_w)) AS own, len(list_intersect(a.w, b.w)) AS other FROM s a JOIN s b ON a.conv_id = b.conv_id AND b.pos <> a.pos AND abs(b.pos - a.pos) <= 5)
SELECT conv_id, pos, o::INT AS "offset", own::INT AS own, other::INT AS other FROM m WHERE other >= 3 AND other > own
QUALIFY row_number() OVER (PARTITION BY conv_id, pos ORDER BY other DESC, abs(o), o) = 1""",
)
def w01(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets are a turn's words; a row's own source is its long words, so that neighbours can be nearer."""
    words = tokens(F.col("text"))
    placed = sequence.shifted_rows(table(spark, sf_dir, "conversations"), ["conv_id"], "turn", words, words, own_tokens=F.filter(words, lambda x: F.length(x) > 4))
    return placed.select("conv_id", "pos", "offset", "own", "other")


@query(
    "w03_pack",
    """
WITH RECURSIVE o AS (SELECT source, doc_id, greatest(1, n_chars // 3) AS w, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents),
g AS (SELECT source, doc_id, rn, w, w AS total, 1 AS rows_, 0 AS batch FROM o WHERE rn = 1
  UNION ALL SELECT o.source, o.doc_id, o.rn, o.w, CASE WHEN g.total + o.w > 12000 OR g.rows_ >= 25 THEN o.w ELSE g.total + o.w END,
    CASE WHEN g.total + o.w > 12000 OR g.rows_ >= 25 THEN 1 ELSE g.rows_ + 1 END, CASE WHEN g.total + o.w > 12000 OR g.rows_ >= 25 THEN g.batch + 1 ELSE g.batch END
  FROM g JOIN o ON o.source = g.source AND o.rn = g.rn + 1)
SELECT source, doc_id, w AS weight, batch FROM g""",
)
def w03(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", F.greatest(F.lit(1), F.expr("n_chars div 3")).alias("weight"))
    return sequence.greedy_batches(docs, "source", "doc_id", "weight", 12_000, 25).select("source", "doc_id", "weight", "batch")


@query("w05_batches", "SELECT l_orderkey, l_linenumber, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1) // 3 AS batch FROM lineitem")
def w05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.fixed_batches(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey"], "l_linenumber", 3)


# --- text and classes ---------------------------------------------------------------------------------------------------


@query("t01_char_mix", "SELECT doc_id, len(regexp_extract_all(text, '[؀-ۿ]')) AS arabic, len(regexp_extract_all(text, '[a-zA-ZÀ-ÿ]')) AS latin FROM documents")
def t01(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", text.letters(c, text.ARABIC).cast("long").alias("arabic"), text.letters(c, text.LATIN).cast("long").alias("latin"))


@query(
    "t15_visible_text",
    r"""
SELECT page_id, trim(regexp_replace(regexp_replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<style[^>]*>.*?</style>', ' ', 'g'), '(?is)<script[^>]*>.*?</script>', ' ', 'g'),
  '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&#[0-9]+;', ' ', 'g'), '[ \t\n\x0B\f\r]+', ' ', 'g')) AS visible FROM pages""",
)
def t15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.visible_text(F.col("html")).alias("visible"))


@query("t18_slug", "SELECT p_partkey, substr(trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-'), 1, 255) AS slug FROM part")
def t18(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", trees.ascii_slug(F.col("p_name")).alias("slug"))


@query("t22_tokens", "SELECT doc_id, greatest(1, length(text) // 3)::INT AS tokens FROM documents")
def t22(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.estimated_tokens(F.col("text")).alias("tokens"))


@query(
    "t25_codec",
    r"""
WITH e AS (SELECT doc_id, regexp_replace(replace(replace(text, '\', '\'), chr(10), '\n'), '[ \t\n\x0B\f\r]+$', '') AS line FROM documents)
SELECT doc_id, CASE WHEN line IS NOT NULL THEN doc_id::VARCHAR END AS id, CASE WHEN line IS NOT NULL THEN sha256(replace(replace(line, '\n', chr(10)), '\', '\')) END AS value_sha FROM e""",
)
def t25(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents there and back. Null texts have no record; a backslash before an n comes back as a line end."""
    docs = table(spark, sf_dir, "documents")
    line = text.encoded_record(F.col("doc_id").cast("string"), F.col("text"))
    back = docs.select("doc_id", text.decoded_record(line).alias("r"))
    return back.select("doc_id", F.col("r.id").alias("id"), F.sha2("r.value", 256).alias("value_sha"))


@query(
    "f01_row_class",
    r"""
WITH v AS (SELECT page_id, CASE page_id % 10 WHEN 0 THEN url WHEN 1 THEN page_id::VARCHAR WHEN 2 THEN '' WHEN 3 THEN 'deadbeef' || page_id WHEN 4 THEN '["gid://x/1","' || page_id || '"]' WHEN 5 THEN '["gid://x/1",' || page_id || ']'
    WHEN 6 THEN '<p>{{ a.b }} {{ c }};</p>' WHEN 7 THEN '{"reviewCount":' || page_id || '}' WHEN 8 THEN '{{ a }} left' ELSE 'Some words ' || page_id END AS value,
  CASE page_id % 7 WHEN 0 THEN 'handle' WHEN 1 THEN 'hero.image' WHEN 2 THEN 'footer.link' ELSE 'title' END AS field, CASE WHEN page_id % 2 = 0 THEN 'texte' END AS translated FROM pages)
SELECT page_id, CASE WHEN trim(value) = '' OR field = 'handle' OR regexp_matches(value, '^(https?://|/)') OR regexp_full_match(value, '-?[0-9]+\.?[0-9]*') OR regexp_full_match(value, '[0-9a-f]{8,}')
    OR regexp_full_match(value, '\["gid://x/1","[0-9]+"\]') OR value = '<p>{{ a.b }} {{ c }};</p>' OR value LIKE '{"reviewCount"%' THEN 'skip'
  WHEN field LIKE '%.image' OR field LIKE '%.link' THEN 'keep' WHEN translated <> '' AND translated <> value THEN 'done' ELSE 'translate' END AS class FROM v""",
)
def f01(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields and values of every kind, by page."""
    k, number = F.col("page_id"), F.col("page_id").cast("string")
    kinds = (F.col("url"), number, F.lit(""), F.concat(F.lit("deadbeef"), number), F.concat(F.lit('["gid://x/1","'), number, F.lit('"]')), F.concat(F.lit('["gid://x/1",'), number, F.lit("]")), F.lit("<p>{{ a.b }} {{ c }};</p>"),
             F.concat(F.lit('{"reviewCount":'), number, F.lit("}")), F.lit("{{ a }} left"), F.concat(F.lit("Some words "), number))
    value = F.element_at(F.array(*kinds), (k % 10 + 1).cast("int"))
    field = F.when(k % 7 == 0, "handle").when(k % 7 == 1, "hero.image").when(k % 7 == 2, "footer.link").otherwise("title")
    return table(spark, sf_dir, "pages").select("page_id", classify.row_class(field, value, F.when(k % 2 == 0, "texte")).alias("class"))


@query(
    "f09_status",
    r"""
WITH p AS (SELECT doc_id, text AS s, CASE doc_id % 6 WHEN 0 THEN NULL WHEN 1 THEN text WHEN 2 THEN 'هذا نص عربي كامل' WHEN 3 THEN 'نص half of it' WHEN 4 THEN '12345' ELSE 'only Latin here' END AS t, doc_id % 5 = 0 AS outdated FROM documents)
SELECT doc_id, CASE WHEN s IS NULL OR trim(s) = '' OR regexp_matches(s, '^(https?://|/)') OR regexp_full_match(trim(s), '-?[0-9]+\.?[0-9]*') OR regexp_full_match(trim(s), '[0-9a-f]{8,}') THEN 'SKIP'
  WHEN t IS NULL THEN 'MISSING' WHEN s = t THEN 'IDENTICAL' WHEN t = '12345' THEN CASE WHEN outdated AND FALSE THEN 'OUTDATED' ELSE 'OK' END WHEN NOT regexp_matches(t, '[؀-ۿ]') THEN 'NOT_ARABIC' WHEN t LIKE 'نص half%' THEN 'MIXED_LANGUAGE'
  WHEN outdated THEN 'OUTDATED' ELSE 'OK' END AS status FROM p""",
)
def f09(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Translations of every kind, by document: none, the source, Arabic, mixed, without letters, Latin."""
    k = F.col("doc_id") % 6
    other = F.when(k == 0, None).when(k == 1, F.col("text")).when(k == 2, "هذا نص عربي كامل").when(k == 3, "نص half of it").when(k == 4, "12345").otherwise("only Latin here")
    return table(spark, sf_dir, "documents").select("doc_id", classify.translation_status(F.col("text"), other, F.lit("title"), F.col("doc_id") % 5 == 0).alias("status"))


@query("f19_truncated", "SELECT conv_id, turn, length(text) > 50 AND length(lead(text) OVER w) < 0.2 * length(text) AS truncated FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def f19(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    talks = table(spark, sf_dir, "conversations")
    after = F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    return talks.withColumn("_next", after).select("conv_id", "turn", classify.is_truncated(F.col("text"), F.col("_next")).alias("truncated"))


@query(
    "j12_html_counts",
    r"""
SELECT page_id, len(regexp_extract_all(html, '(?i)<img[^>]*>')) AS n_images, len(regexp_extract_all(html, '(?i)<a\s[^>]*href="/')) AS n_inner_links, len(regexp_extract_all(html, '(?i)<h[1-6][^>]*>')) AS n_headings,
  regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title FROM pages""",
)
def j12(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = lambda pattern: F.regexp_count("html", F.lit(pattern)).cast("long")
    return table(spark, sf_dir, "pages").select(
        "page_id", count("(?i)<img[^>]*>").alias("n_images"), count(r'(?i)<a\s[^>]*href="/').alias("n_inner_links"), count("(?i)<h[1-6][^>]*>").alias("n_headings"), F.regexp_extract("html", "(?is)<title>(.*?)</title>", 1).alias("title")
    )


# --- documents as fields ------------------------------------------------------------------------------------------------


@query(
    "p01_flatten",
    """
SELECT 'order.' || o_orderkey || '.status' AS field_id, o_orderstatus AS value FROM orders WHERE trim(o_orderstatus) <> ''
UNION ALL SELECT 'order.' || o_orderkey || '.priority', o_orderpriority FROM orders WHERE trim(o_orderpriority) <> ''
UNION ALL SELECT 'order.' || l_orderkey || '.line' || k || '.' || f, CASE f WHEN 'flag' THEN l_returnflag ELSE l_linestatus END
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_returnflag, l_linestatus) - 1 AS k FROM lineitem JOIN orders ON o_orderkey = l_orderkey), (VALUES ('flag'), ('state')) v(f)""",
)
def p01(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("state")))).alias("line"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    nested = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return flatten.field_rows(nested, F.concat(F.lit("order."), F.col("o_orderkey").cast("string")), ["status", "priority"], {"line": ["flag", "state"]})


@query(
    "p28_apply",
    """SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'new ' || c_name ELSE c_name END AS c_name, CASE WHEN c_custkey % 3 = 0 THEN 'seg' || c_custkey ELSE c_mktsegment END AS c_mktsegment FROM customer""",
)
def p28(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    key = F.concat(F.lit("cust."), F.col("c_custkey").cast("string"))
    row = lambda df, field, value: df.select(F.concat(key, F.lit(f".{field}")).alias("field_id"), value.alias("value"))
    values = row(people.filter("c_custkey % 2 = 0"), "c_name", F.concat(F.lit("new "), F.col("c_name"))).unionByName(row(people.filter("c_custkey % 3 = 0"), "c_mktsegment", F.concat(F.lit("seg"), F.col("c_custkey").cast("string"))))
    return flatten.apply_values(people, key, ["c_name", "c_mktsegment"], values)


@query(
    "j09_relations",
    """
SELECT 'order' AS from_type, o_orderkey AS from_id, 'customer' AS field, 'customer' AS to_type, o_custkey AS to_id FROM orders
UNION ALL SELECT 'order', l_orderkey, 'part', 'part', l_partkey FROM lineitem UNION ALL SELECT 'order', l_orderkey, 'supplier', 'supplier', l_suppkey FROM lineitem""",
)
def j09(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    found = flatten.edges(orders, "order", "o_orderkey", "customer", "customer", "o_custkey").unionByName(flatten.edges(lines, "order", "l_orderkey", "part", "part", "l_partkey"))
    return found.unionByName(flatten.edges(lines, "order", "l_orderkey", "supplier", "supplier", "l_suppkey"))


@query(
    "a12_relation_summary",
    "SELECT 'order' AS from_type, 'part' AS to_type, count(*) AS n FROM lineitem UNION ALL SELECT 'order', 'supplier', count(*) FROM lineitem UNION ALL SELECT 'order', 'customer', count(*) FROM orders",
)
def a12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return j09(spark, sf_dir).groupBy("from_type", "to_type").agg(F.count(F.lit(1)).alias("n"))


from tallyloom.plans import fields, jobs, matching, shop, translation  # noqa: E402, F401 (register their queries)
