"""Queries of whole jobs over the driver tables, each with its SQL. The models are rules, so that answers are the same each time."""

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.text import RECORD_MARK
from tallyloom.operators import answers, fixes
from tallyloom.plans.catalog import query
from tallyloom.sources.scratch import folder
from tallyloom.sources.tables import table


def in_capitals(request: str) -> str:
    """Every value, A-Z in capitals."""
    up = str.maketrans("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    return "\n".join(k + RECORD_MARK + v.translate(up) for k, v in (line.split(RECORD_MARK, 1) for line in request.split("\n")))


def forgetful(request: str) -> str:
    """Refuses a request whose first value is marked no; leaves out values marked skip; says the others between brackets."""
    entries = [line.split(RECORD_MARK, 1) for line in request.split("\n")]
    if entries[0][1].startswith("no:"):
        return "Sorry."
    return "```\n" + "\n".join(f"{k}{RECORD_MARK}[{v}]" for k, v in entries if not v.startswith("skip:")) + "\n```"


def judged(request: str) -> str:
    """Not ok: targets that end in a digit of 0 to 2, with high, low or medium confidence."""
    out = []
    for line in request.split("\n"):
        k, pair = line.split("\t", 1)
        last = pair.rstrip()[-1:]
        if last in ("0", "1", "2"):
            out.append({"i": int(k), "ok": False, "reason": f"ends in {last}", "confidence": ("high", "low", "medium")[int(last)]})
    return json.dumps(out)


def judged_again(request: str) -> str:
    """Ok: what was said to end in 1 and has an even number of characters before its first separator."""
    out = []
    for line in request.split("\n"):
        k, pair = line.split("\t", 1)
        if pair.endswith("ends in 1") and len(pair.split(" ||| ")[0]) % 2 == 0:
            out.append({"i": int(k), "ok": True})
    return json.dumps(out)


@query(
    "c01_fill_gaps",
    """
WITH f AS (SELECT 'p' || p_partkey AS id, p_brand AS kind, p_partkey AS ord, CASE WHEN p_size % 10 = 0 THEN ' ' ELSE p_name || ' of ' || p_type END AS value FROM part),
e AS (SELECT 'p' || ps AS id, max(t) AS t FROM (SELECT l_partkey AS ps, 'old ' || l_returnflag AS t FROM lineitem WHERE l_linenumber = 5) GROUP BY 1)
SELECT f.id, kind, ord, value, CASE WHEN t IS NOT NULL THEN t WHEN trim(value) <> '' THEN upper(value) END AS translation,
  CASE WHEN t IS NOT NULL THEN 'existing' WHEN trim(value) = '' THEN 'blank' ELSE 'done' END AS origin FROM f LEFT JOIN e ON e.id = f.id""",
)
def c01(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.concat(F.lit("p"), F.col("p_partkey").cast("string"))
    value = F.when(F.col("p_size") % 10 == 0, " ").otherwise(F.concat_ws(" of ", "p_name", "p_type"))
    fields = table(spark, sf_dir, "part").select(k.alias("id"), F.col("p_brand").alias("kind"), F.col("p_partkey").alias("ord"), value.alias("value"))
    old = table(spark, sf_dir, "lineitem").filter("l_linenumber = 5").select(F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("id"), F.concat(F.lit("old "), F.col("l_returnflag")).alias("translation"))
    return fixes.fill_gaps(fields, old, in_capitals, f"{folder(spark)}/done-{uuid.uuid4().hex}", most_fields=40, slices=2)


@query(
    "c10_theme_keys",
    """
WITH k AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN '{{ ' || source || ' }}' ELSE coalesce(lang, '') || ' from ' || source END AS english, CASE WHEN quality = 1 THEN 'there' END AS arabic, quality = 1 AS done,
  CASE WHEN toxic = 1 THEN 'junk' ELSE 'useful' END AS category FROM documents LEFT JOIN labels USING (doc_id))
SELECT doc_id::VARCHAR AS key, english, upper(english) AS translation FROM k WHERE NOT coalesce(done AND arabic <> '', false) AND category <> 'junk' AND doc_id % 4 <> 0""",
)
def c10(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = table(spark, sf_dir, "documents").select("doc_id", "lang", "source").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    english = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("{{ "), F.col("source"), F.lit(" }}"))).otherwise(F.concat(F.coalesce("lang", F.lit("")), F.lit(" from "), F.col("source")))
    good = F.col("quality") == 1
    fields = both.select(F.lit("theme").alias("resource_id"), F.col("doc_id").cast("string").alias("key"), english.alias("english"), F.when(good, "there").alias("arabic"), good.alias("has_translation"), F.when(F.col("toxic") == 1, "junk").otherwise("useful").alias("category"))
    return fixes.translate_keys(fields, in_capitals, f"{folder(spark)}/done-{uuid.uuid4().hex}", slices=2).select("key", "english", "translation")


@query(
    "c06_from_audit",
    """
WITH c AS (SELECT page_id, url, 'd' || page_id AS digest, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages),
p AS (SELECT page_id, 'title' AS key, substr(title, 1, 20) AS english FROM c WHERE title <> '' UNION ALL SELECT page_id, 'url', url FROM c WHERE page_id % 2 = 0)
SELECT p.page_id::VARCHAR AS resource_id, p.key, CASE WHEN p.key = 'title' THEN digest END AS digest, CASE WHEN p.key = 'title' THEN title ELSE english END AS value,
  rtrim(translate(CASE WHEN p.key = 'title' THEN title ELSE english END, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')) AS translation FROM p JOIN c USING (page_id)""",
)
def c06(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, title = F.col("page_id").cast("string").alias("resource_id"), F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    pages = table(spark, sf_dir, "pages")
    kind = F.lit("page").alias("resource_type")
    problems = pages.filter(title != "").select(kind, k, F.lit("title").alias("key"), F.substring(title, 1, 20).alias("english")).unionByName(pages.filter("page_id % 2 = 0").select(kind, k, F.lit("url").alias("key"), F.col("url").alias("english")))
    problems = problems.unionByName(pages.select(kind, k, F.lit("handle").alias("key"), F.lit("never").alias("english")))
    content = pages.select(k, F.lit("title").alias("key"), title.alias("value"), F.concat(F.lit("d"), F.col("page_id").cast("string")).alias("digest"))
    return fixes.fix_from_audit(problems, content, in_capitals, f"{folder(spark)}/done-{uuid.uuid4().hex}", slices=2)


@query(
    "g02_answers",
    """
WITH f AS (SELECT o_custkey AS batch, o_orderkey AS id, CASE WHEN o_custkey % 9 = 0 AND o_orderkey = min(o_orderkey) OVER (PARTITION BY o_custkey) THEN 'no:' WHEN o_orderkey % 4 = 3 THEN 'skip:' ELSE '' END || o_orderpriority AS value FROM orders),
b AS (SELECT batch, bool_or(value LIKE 'no:%') AS no FROM f GROUP BY 1)
SELECT id, CASE WHEN NOT no AND value NOT LIKE 'skip:%' THEN '[' || value || ']' END AS translation, CASE WHEN no THEN 'refusal' WHEN value NOT LIKE 'skip:%' THEN 'translated' ELSE 'missing' END AS outcome
FROM f JOIN b USING (batch)""",
)
def g02(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    first = orders.groupBy("o_custkey").agg(F.min("o_orderkey").alias("first"))
    mark = F.when((F.col("o_custkey") % 9 == 0) & (k == F.col("first")), "no:").when(k % 4 == 3, "skip:").otherwise("")
    fields = orders.join(first, "o_custkey").select(F.col("o_custkey").alias("batch"), k.alias("pos"), k.alias("id"), F.concat(mark, F.col("o_orderpriority")).alias("value"))
    return answers.answered(fields, forgetful, attempts=2)


@query(
    "g05_validated",
    """
WITH p AS (SELECT l_orderkey * 10 + l_linenumber AS row, 'part ' || l_partkey AS source, l_returnflag || (l_suppkey + l_linenumber) AS target FROM lineitem),
v AS (SELECT row, source, right(target, 1) AS last FROM p WHERE length(target) >= 2)
SELECT row, 'ends in ' || last AS reason, CASE last WHEN '0' THEN 'high' ELSE 'confirmed' END AS confidence FROM v WHERE last IN ('0', '2') OR last = '1' AND length(source) % 2 = 1""",
)
def g05(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, target = F.col("l_orderkey") * 10 + F.col("l_linenumber"), F.concat("l_returnflag", (F.col("l_suppkey") + F.col("l_linenumber")).cast("string"))
    pairs = table(spark, sf_dir, "lineitem").select(k.alias("row"), F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("source"), target.alias("target"))
    return answers.validated(pairs, judged, judged_again)


@query(
    "c09_content_fixes",
    r"""
WITH v AS (SELECT page_id, html, contains(html, '<style') AS bloat, contains(html, 'data-') AS data, contains(lower(html), '&amp;') AS amp FROM pages),
a AS (SELECT *, CASE WHEN bloat THEN regexp_replace(html, '(?s)<style[^>]*>.*?</style>', '', 'g') ELSE html END AS a FROM v),
b AS (SELECT *, CASE WHEN amp THEN CASE WHEN page_id % 5 = 0 THEN NULL ELSE replace(a, '&amp;', '&') END ELSE a END AS b FROM a)
SELECT page_id, list_sort(list_filter([CASE WHEN bloat THEN 'bloat' END, CASE WHEN amp THEN 'entities' END], lambda x: x IS NOT NULL)) AS issues, md5(coalesce(b, html)) AS md5,
  CASE WHEN b IS NULL THEN 'failed' WHEN b = html THEN 'unchanged' ELSE 'updated' END AS status FROM b WHERE bloat OR amp""",
)
def c09(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    values = pages.select(F.lit("page").alias("type"), F.col("page_id").alias("id"), F.lit("html").alias("field"), F.col("html").alias("value"))
    issues = F.array_compact(F.array(F.when(F.col("html").contains("<style"), F.lit("bloat")), F.when(F.lower("html").contains("&amp;"), F.lit("entities"))))
    findings = pages.select(F.lit("page").alias("type"), F.col("page_id").alias("id"), F.lit("html").alias("field"), F.explode(issues).alias("issue"))
    marked = values.withColumn("value", F.concat(F.when(F.col("id") % 5 == 0, "!").otherwise(""), F.col("value")))
    rewrites = [("bloat", lambda c: F.regexp_replace(c, "(?s)<style[^>]*>.*?</style>", "")), ("entities", lambda c: F.when(~c.startswith("!"), F.replace(c, F.lit("&amp;"), F.lit("&"))))]
    out = fixes.content_fixes(findings, marked, rewrites)
    return out.select(F.col("id").alias("page_id"), "issues", F.md5(F.regexp_replace("new_value", "^!", "")).alias("md5"), "status")


@query(
    "c08_definitions",
    """
WITH RECURSIVE s AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 11 = 0 THEN 'shopify--' ELSE 't' END || p_partkey AS type, CASE WHEN p_partkey >= 4 THEN p_partkey // 4 END AS needs FROM part),
t AS (SELECT 't' || s_suppkey * 3 AS type, s_suppkey + 100000 AS id FROM supplier),
m AS (SELECT s.*, n.type AS needs_type, k.id AS needs_id FROM s LEFT JOIN s n ON n.id = s.needs LEFT JOIN t k ON k.type = n.type WHERE s.type NOT IN (SELECT type FROM t) AND s.type NOT LIKE 'shopify--%'),
l AS (SELECT type, 0 AS level FROM m WHERE needs_type IS NULL OR needs_id IS NOT NULL OR needs_type NOT IN (SELECT type FROM m) UNION ALL SELECT m.type, l.level + 1 FROM l JOIN m ON m.needs_type = l.type AND m.needs_id IS NULL)
SELECT m.type, level, 'ordered' AS state, 'name' AS display_key, m.needs_type, m.needs_id FROM m JOIN l USING (type)""",
)
def c08(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    kind = F.concat(F.when(k % 11 == 0, "shopify--").otherwise("t"), k.cast("string"))
    base = table(spark, sf_dir, "part").select(kind.alias("type"), k.alias("id"), F.when(k >= 4, F.expr("p_partkey div 4")).alias("up"))
    field = lambda pos, key, what, needs: F.struct(F.lit(pos).alias("pos"), F.lit(key).alias("key"), F.lit(what).alias("kind"), needs.cast("long").alias("needs"))
    source = base.select("type", "id", F.explode(F.array(field(0, "icon", "file", F.lit(None)), field(1, "name", "text", F.lit(None)), field(2, "up", "reference", F.col("up")))).alias("f")).select("type", "id", "f.*")
    target = table(spark, sf_dir, "supplier").select(F.concat(F.lit("t"), (F.col("s_suppkey") * 3).cast("string")).alias("type"), (F.col("s_suppkey") + 100_000).alias("id"))
    out = fixes.missing_definitions(source, target)
    up = F.filter("fields", lambda f: f["key"] == "up")[0]
    return out.select("type", "level", "state", "display_key", up["needs_type"].alias("needs_type"), up["needs_id"].alias("needs_id"))


@query(
    "f27_homepage",
    """
WITH s AS (SELECT o_custkey % 50 AS name, o_orderkey AS section, CASE o_orderkey % 5 WHEN 0 THEN 'featured-list' WHEN 1 THEN 'Product grid' ELSE 'rich-text' END AS type, CASE WHEN o_orderkey % 7 = 0 THEN 'Shop now' ELSE '' END AS title,
    CASE WHEN o_orderkey % 3 = 0 THEN 'c' || o_custkey ELSE '' END AS collection, CASE WHEN o_orderstatus = 'F' THEN 'a.jpg' ELSE '' END AS image FROM orders),
p AS (SELECT * FROM s WHERE regexp_matches(lower(type), 'product|collection|featured') OR regexp_matches(lower(title), 'product|best|shop'))
SELECT 'n' || name AS name, section::VARCHAR AS section, 'product_section' AS "check", CASE WHEN collection <> '' THEN 'ok' ELSE 'fail' END AS verdict, 1 AS n FROM p
UNION ALL SELECT 'n' || name, NULL, 'no_product_section', 'warn', 1 FROM (SELECT DISTINCT name FROM s) WHERE name NOT IN (SELECT name FROM p)
UNION ALL SELECT 'n' || name, NULL, 'images', CASE WHEN image <> '' THEN 'ok' ELSE 'warn' END, 2 * count(*) FROM s GROUP BY ALL""",
)
def f27(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty templates grow with the orders, so each comes in parts of a section."""
    k = F.col("o_orderkey")
    image = F.when(F.col("o_orderstatus") == "F", "a.jpg").otherwise("")
    settings = F.struct(F.when(k % 7 == 0, "Shop now").otherwise("").alias("title"), F.when(k % 3 == 0, F.concat(F.lit("c"), F.col("o_custkey").cast("string"))).otherwise("").alias("collection"), image.alias("hero_Image"))
    kind = F.when(k % 5 == 0, "featured-list").when(k % 5 == 1, "Product grid").otherwise("rich-text")
    body = F.struct(kind.alias("type"), settings.alias("settings"), F.struct(F.struct(F.struct(image.alias("image")).alias("settings")).alias("b1")).alias("blocks"))
    one = table(spark, sf_dir, "orders").select(F.concat(F.lit("n"), (F.col("o_custkey") % 50).cast("string")).alias("name"), k.cast("string").alias("section"), body.alias("body"))
    return fixes.homepage_checks(one.select("name", F.to_json(F.struct(F.create_map("section", "body").alias("sections"))).alias("value")))
