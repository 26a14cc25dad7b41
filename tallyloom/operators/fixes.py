"""Jobs that fill gaps and mend content: translations with a table of what is done, rewrites by finding, definitions in the order of their dependencies, structural checks."""

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import text
from tallyloom.operators import answers, sequence
from tallyloom.sources import files
from tallyloom.sources.scratch import kept

#: Tokens and fields of a request, and parts of the work after each of which what is done is written.
MOST_TOKENS, MOST_FIELDS, SLICES = 12_000, 250, 8


def empty(c: Column) -> Column:
    return text.blank(text.stripped(c))


def done_translations(spark, path: str) -> DataFrame:
    """(id, translation) of all runs so far; of several of one id the largest. None yet: no rows."""
    if not files.exists(spark, path):
        return spark.createDataFrame([], "id string, translation string")
    return spark.read.schema("id string, translation string").parquet(f"{path}/*").groupBy("id").agg(F.max("translation").alias("translation"))


def fill_gaps(
    fields: DataFrame, existing: DataFrame, ask: answers.Ask, done_path: str, most_tokens: int = MOST_TOKENS, most_fields: int = MOST_FIELDS, slices: int = SLICES, **protocol
) -> DataFrame:
    """fields: (id, kind, ord, value), ids unique strings; existing: (id, translation). (id, kind, ord, value, translation, origin): origin is existing, done (now or by an earlier run), blank for values that are not asked, or null where nothing came.

    What neither existing nor an earlier run has goes out, packed by kind in order (see sequence.greedy_batches), under the protocol of answers.answered. The work is cut into `slices` by batch. As soon as a slice has its
    answers they are written below done_path, in a folder of their own that appears whole or not at all. So a run that is killed loses one slice; started again, it asks only for what is not there, and a second copy of an id does
    no harm. A blank translation is none."""
    spark = fields.sparkSession
    there = existing.filter(~empty(F.col("translation"))).groupBy("id").agg(F.max("translation").alias("_old"))
    asks = ~empty(F.col("value"))
    open_ = fields.filter(asks).join(there.select("id"), "id", "left_anti").join(done_translations(spark, done_path).select("id"), "id", "left_anti")
    weighed = open_.select("id", "kind", "ord", "value", text.estimated_tokens(F.col("value")).cast("long").alias("tokens"))
    packed = kept(sequence.greedy_batches(weighed, "kind", ["ord", "id"], "tokens", most_tokens, most_fields))
    work = kept(packed.select(F.concat_ws("|", F.coalesce("kind", F.lit("")), F.col("batch").cast("string")).alias("batch"), F.struct("ord", "id").alias("pos"), "id", "value"))
    for k in range(slices):
        part = work.filter(F.pmod(F.xxhash64("batch"), F.lit(slices)) == k)
        if part.limit(1).count():
            came = answers.answered(part, ask, **protocol).filter(~empty(F.col("translation")))
            came.select(F.col("id").cast("string").alias("id"), "translation").write.parquet(f"{done_path}/run-{uuid.uuid4().hex}")
    met = fields.join(there, "id", "left").join(done_translations(spark, done_path).withColumnRenamed("translation", "_new"), "id", "left")
    origin = F.when(F.col("_old").isNotNull(), "existing").when(~asks, "blank").when(F.col("_new").isNotNull(), "done")
    return met.select("id", "kind", "ord", "value", F.coalesce("_old", F.when(asks, F.col("_new"))).alias("translation"), origin.alias("origin"))


def fix_from_audit(problems: DataFrame, content: DataFrame, ask: answers.Ask, done_path: str, **how) -> DataFrame:
    """problems: (resource_type, resource_id, key, english), as an audit has them, english being cut short; content: (resource_id, key, value, digest), whole. (resource_id, key, digest, value, translation): the rows to
    upload, those without a translation left out. The whole value is translated where content has one; handles are never. Problems that repeat are one; what an earlier run has is not asked again (see fill_gaps)."""
    first = problems.filter("key <> 'handle'").groupBy("resource_type", "resource_id", "key").agg(F.min("english").alias("english"))
    met = first.join(content.groupBy("resource_id", "key").agg(F.max(F.struct("value", "digest")).alias("_c")), ["resource_id", "key"], "left")
    value = F.when(~empty(F.col("_c.value")), F.col("_c.value")).otherwise(F.col("english"))
    rows = kept(met.select(F.concat_ws("|", "resource_type", "resource_id", "key").alias("id"), "resource_type", "resource_id", "key", value.alias("value"), F.col("_c.digest").alias("digest")))
    fields = rows.select("id", F.col("resource_type").alias("kind"), F.col("id").alias("ord"), "value")
    made = fill_gaps(fields, fields.select("id", F.lit(None).cast("string").alias("translation")).limit(0), ask, done_path, **how)
    return rows.join(made.select("id", "translation"), "id").filter("translation is not null").select("resource_id", "key", "digest", "value", "translation")


def has_words(value: Column) -> Column:
    """Two letters in a row outside of markup and template tags."""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "<[^>]+>", ""), r"\{\{[^}]*\}\}", ""), r"\{%[^%]*%\}", "")
    return F.coalesce(bare.rlike("[a-zA-Z]{2,}"), F.lit(False))


def keys_to_translate(fields: DataFrame) -> DataFrame:
    """fields: (resource_id, key, english, arabic, has_translation, category). Those with words but no translation, junk and locale keys left out."""
    lacks = ~(F.coalesce("has_translation", F.lit(False)) & ~empty(F.col("arabic")))
    return fields.filter(~empty(F.col("english")) & lacks & ~F.coalesce(F.col("category").isin("junk", "theme_locale"), F.lit(False)) & has_words(F.col("english")))


def translate_keys(fields: DataFrame, ask: answers.Ask, done_path: str, **how) -> DataFrame:
    """(resource_id, key, english, translation) of the keys to translate that got one. Equal texts, however many keys have them, are asked once, under their hash; see fill_gaps for runs that are killed."""
    keys = kept(keys_to_translate(fields).select("resource_id", "key", "english").withColumn("id", F.sha2("english", 256)))
    texts = keys.groupBy("id").agg(F.first("english").alias("value")).withColumn("kind", F.substring("id", 1, 1)).withColumn("ord", F.col("id"))
    made = fill_gaps(texts, texts.select("id", F.col("value").alias("translation")).limit(0), ask, done_path, **how)
    return keys.join(made.filter("translation is not null").select("id", "translation"), "id").select("resource_id", "key", "english", "translation")


def content_fixes(findings: DataFrame, values: DataFrame, rewrites: list[tuple[str, Callable[[Column], Column]]], translate: tuple[str, answers.Ask] | None = None, size: int = 80) -> DataFrame:
    """findings: (type, id, field, issue); values: (type, id, field, value), keys unique. (type, id, field, issues, value, new_value, status): one row for each target with a finding and a value.

    A target's rewrites are applied in the given order, each where its issue was found, to what the one before has left; then it is translated, if that issue was found. A step that gives null or, for a translation, nothing, fails the
    row: it keeps its value, and no later step is tried. status: updated, unchanged (nothing to do, or no difference), failed. Findings that repeat count once; issues without a rewrite do nothing."""
    keys = ["type", "id", "field"]
    by = findings.groupBy(*keys).agg(F.array_sort(F.collect_set("issue")).alias("issues"))
    now = values.select(*keys, "value").join(by, keys).withColumn("new_value", F.col("value")).withColumn("_failed", F.lit(False))
    for issue, rewrite in rewrites:
        due = F.array_contains("issues", issue) & ~F.col("_failed")
        now = now.withColumn("_next", F.when(due, rewrite(F.col("new_value"))).otherwise(F.col("new_value")))
        now = now.withColumn("_failed", F.col("_failed") | (due & F.col("_next").isNull())).withColumn("new_value", F.col("_next")).drop("_next")
    if translate:
        issue, ask = translate
        now = kept(now.withColumn("_key", F.sha2(F.to_json(F.struct(*keys)), 256)))
        due = F.array_contains("issues", issue) & ~F.col("_failed")
        out = now.filter(due).select(F.lit("x").alias("kind"), F.col("_key").alias("id"), F.col("new_value").alias("value"), text.estimated_tokens(F.col("new_value")).cast("long").alias("tokens"))
        packed = sequence.greedy_batches(out.withColumn("kind", F.substring("id", 1, 2)), "kind", "id", "tokens", MOST_TOKENS, size)
        came = answers.answered(kept(packed.select(F.concat_ws("|", "kind", F.col("batch").cast("string")).alias("batch"), F.col("id").alias("pos"), "id", "value")), ask)
        now = now.join(came.filter(~empty(F.col("translation"))).select(F.col("id").alias("_key"), "translation"), "_key", "left")
        now = now.withColumn("_failed", F.col("_failed") | (due & F.col("translation").isNull())).withColumn("new_value", F.when(due, F.col("translation")).otherwise(F.col("new_value"))).drop("translation", "_key")
    status = F.when(F.col("_failed"), "failed").when(F.col("new_value").eqNullSafe(F.col("value")), "unchanged").otherwise("updated")
    return now.withColumn("status", status).withColumn("new_value", F.when(F.col("_failed"), F.col("value")).otherwise(F.col("new_value"))).select(*keys, "issues", "value", "new_value", "status")


# --- definitions by dependency ------------------------------------------------------------------------------------------------


def peeled(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """nodes: (node); edges: (node, needs). ((node, level), nodes left): level 0 needs nothing, the others what lies below them; left are nodes on a cycle or that need one. Edges to nodes that are not there need
    nothing. One round for each level."""
    left = kept(nodes.select("node").distinct())
    open_ = kept(edges.select("node", "needs").distinct().join(left.withColumnRenamed("node", "needs"), "needs", "left_semi").join(left, "node", "left_semi"))
    levels = left.withColumn("level", F.lit(0)).limit(0)
    level = 0
    while True:
        free = kept(left.join(open_.select("node").distinct(), "node", "left_anti"))
        if not free.limit(1).count():
            return levels, left
        levels = levels.unionByName(free.withColumn("level", F.lit(level)))
        left = kept(left.join(free, "node", "left_anti"))
        open_ = kept(open_.join(free.withColumnRenamed("node", "needs"), "needs", "left_anti"))
        level += 1


def dependency_levels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, level, state): state is ordered with its level, or cycle (on one, or between two) or behind (needs one) with a null level."""
    levels, left = peeled(nodes, edges)
    inner = edges.join(left, "node", "left_semi").join(left.withColumnRenamed("node", "needs"), "needs", "left_semi")
    behind, cyclic = peeled(left, inner.select(F.col("needs").alias("node"), F.col("node").alias("needs")))
    none = F.lit(None).cast("int").alias("level")
    return levels.select("node", "level", F.lit("ordered").alias("state")).unionByName(behind.select("node", none, F.lit("behind").alias("state"))).unionByName(cyclic.select("node", none, F.lit("cycle").alias("state")))


# Types that the store itself manages, and fields that name an entry.
MANAGED, NAME_FIELDS = "shopify--", ("name", "title", "question")


def missing_definitions(source: DataFrame, target: DataFrame) -> DataFrame:
    """source: (type, id, pos, key, kind, needs), a row for each field, needs being the id of the definition that it refers to or null; target: (type, id). (type, level, state, display_key, fields): what to create, level by
    level, with fields as array of struct(key, kind, needs_type, needs_id).

    A type that the target has, or that the store manages, is not created. needs_id is the target's id of the type referred to, where it is there; null with a needs_type: that is created at a lower level and its id known
    then. On a cycle, references within it have to be left for later. References to no definition have neither."""
    known = target.groupBy("type").agg(F.max("id").alias("_target_id"))
    ids = source.select(F.col("id").alias("needs"), F.col("type").alias("needs_type")).distinct()
    lacking = kept(source.join(known.select("type"), "type", "left_anti").filter(~F.col("type").startswith(MANAGED)).join(ids, "needs", "left").join(known.select(F.col("type").alias("needs_type"), F.col("_target_id").alias("needs_id")), "needs_type", "left"))
    levels = dependency_levels(lacking.select(F.col("type").alias("node")), lacking.filter("needs_type is not null and needs_id is null").select(F.col("type").alias("node"), F.col("needs_type").alias("needs")))
    listed = F.array_sort(F.collect_list(F.struct("pos", "key", "kind", "needs_type", "needs_id")))
    whole = lacking.groupBy("type").agg(listed.alias("_f"))
    named = F.filter("_f", lambda f: f["key"].isin(*NAME_FIELDS))
    out = whole.join(levels.withColumnRenamed("node", "type"), "type")
    return out.select("type", "level", "state", F.coalesce(F.get(named, F.lit(0))["key"], F.get("_f", F.lit(0))["key"]).alias("display_key"), F.transform("_f", lambda f: F.struct(f["key"].alias("key"), f["kind"].alias("kind"), f["needs_type"].alias("needs_type"), f["needs_id"].alias("needs_id"))).alias("fields"))


# --- structural checks --------------------------------------------------------------------------------------------------------

# What tells a section of products by its type or its heading.
PRODUCT_TYPES, PRODUCT_HEADINGS = "product|collection|featured", "product|best|shop"


def _exploded(df: DataFrame, field: str, *names: str) -> DataFrame:
    """df with a row for each entry of its VARIANT object `field`: key and value under these names."""
    out = df.lateralJoin(df.sparkSession.tvf.variant_explode(F.col(field).outer()))
    return out.withColumnRenamed("key", names[0]).withColumnRenamed("value", names[1]).drop("pos")


def filled(v: Column) -> Column:
    """Whether a JSON value is neither null, empty, zero nor false."""
    shown = F.to_json(v)
    return F.coalesce(~shown.isin("null", '""', "0", "0.0", "false", "[]", "{}"), F.lit(False))


def homepage_checks(templates: DataFrame) -> DataFrame:
    """templates: (name, value), value being a template's JSON. (name, section, check, verdict, n): for each section of products whether it has a collection (ok or fail); for a template without one no_product_section (warn); and images, by
    template, with verdict ok or, for slots that are empty, warn, counted over the settings of sections and their blocks. A template that is no JSON has unreadable (fail) alone. Rows of one name are parts of one template, with some of its sections each, so no template need be in one row; sections that are no
    object are none. Sections are cut out as texts: as VARIANT each would carry the names of all of its template."""
    bodies = F.from_json("value", "sections map<string,string>")["sections"]
    parts = templates.select("name", F.try_parse_json("value").isNotNull().alias("fine"), F.explode_outer(bodies).alias("section", "body"))
    parts = kept(parts.withColumn("body", F.try_parse_json(F.when(F.col("fine"), F.col("body")))))
    part = lambda c, path: F.try_variant_get(c, path, "variant")
    word = lambda c, path: F.coalesce(F.try_variant_get(c, path, "string"), F.lit(""))
    names = parts.groupBy("name").agg(F.bool_or("fine").alias("fine"))
    sections = parts.filter("fine and section is not null").drop("fine")
    heading = F.lower(F.when(word("body", "$.settings.heading") != "", word("body", "$.settings.heading")).otherwise(word("body", "$.settings.title")))
    products = sections.filter(F.lower(word("body", "$.type")).rlike(PRODUCT_TYPES) | heading.rlike(PRODUCT_HEADINGS))
    has = filled(part("body", "$.settings.collection"))
    row = lambda df, check, verdict, n=1: df.select("name", F.col("section"), F.lit(check).alias("check"), verdict.alias("verdict"), F.lit(n).cast("long").alias("n"))
    nothing = F.lit(None).cast("string").alias("section")
    out = row(products, "product_section", F.when(has, "ok").otherwise("fail"))
    out = out.unionByName(row(names.filter("fine").join(products.select("name").distinct(), "name", "left_anti").select("name", nothing), "no_product_section", F.lit("warn")))
    own = _exploded(sections.select("name", part("body", "$.settings").alias("o")), "o", "key", "set").select("name", "key", "set")
    blocks = _exploded(sections.select("name", part("body", "$.blocks").alias("o")), "o", "block", "inner").select("name", part("inner", "$.settings").alias("o"))
    settings = own.unionByName(_exploded(blocks, "o", "key", "set").select("name", "key", "set")).filter(F.lower("key").contains("image"))
    images = settings.groupBy("name", F.when(filled(F.col("set")), "ok").otherwise("warn").alias("verdict")).agg(F.count(F.lit(1)).alias("n"))
    out = out.unionByName(images.select("name", nothing, F.lit("images").alias("check"), "verdict", "n"))
    return out.unionByName(row(parts.filter("not fine").select("name", nothing).distinct(), "unreadable", F.lit("fail")))


def menu_checks(items: DataFrame, expected: DataFrame) -> DataFrame:
    """items: (menu, title, url); expected: (menu, keyword). (menu, keyword, verdict): fail for a menu that is not there, else ok if one of its titles or addresses has the keyword, in lower case, or warn."""
    there = items.select("menu").distinct().withColumn("_there", F.lit(True))
    shown = F.lower(F.concat_ws(" ", "title", "url"))
    met = expected.distinct().join(items.select("menu", shown.alias("_t")), "menu", "left").groupBy("menu", "keyword").agg(F.bool_or(F.coalesce(F.col("_t").contains(F.col("keyword")), F.lit(False))).alias("_hit"))
    return met.join(there, "menu", "left").select("menu", "keyword", F.when(F.col("_there").isNull(), "fail").when(F.col("_hit"), "ok").otherwise("warn").alias("verdict"))


def listing_checks(assets: DataFrame, template: str, detail: str, definitions: DataFrame, kind: str) -> DataFrame:
    """assets: (name, value) of a theme; definitions: (type, renderable, publishable). (check, subject, verdict) of a listing page and its detail pages: whether both templates are there and readable, whether each section of the listing links anywhere (ok:
    to entries' own addresses, info: some link, warn: none; unknown without its source), and what the kind's definition can do."""
    known = assets.select("name", "value")
    files_ = known.filter(F.col("name").isin(template, detail)).select("name", F.try_parse_json("value").isNotNull().alias("_fine"))
    wanted = known.sparkSession.createDataFrame([("template", template), ("detail_template", detail)], "check string, subject string")
    out = wanted.join(files_, F.col("subject") == F.col("name"), "left").select("check", "subject", F.when(F.coalesce("_fine", F.lit(False)), "ok").otherwise("fail").alias("verdict"))
    body = known.filter(F.col("name") == template).select(F.try_variant_get(F.try_parse_json("value"), "$.sections", "variant").alias("s"))
    used = _exploded(body, "s", "section", "b").select("section", F.concat(F.lit("sections/"), F.coalesce(F.try_variant_get("b", "$.type", "string"), F.lit("")), F.lit(".liquid")).alias("name"))
    v, low = F.col("value"), F.lower("value")
    links = F.when(v.isNull(), "unknown").when(v.contains(".url") & low.contains("metaobject"), "ok").when(low.contains("href") | low.contains("url"), "info").otherwise("warn")
    out = out.unionByName(used.join(known, "name", "left").select(F.lit("section_links").alias("check"), F.col("section").alias("subject"), links.alias("verdict")))
    can = definitions.filter(F.col("type") == kind).select(F.explode(F.map_from_arrays(F.array(F.lit("renderable"), F.lit("publishable")), F.array(F.coalesce("renderable", F.lit(False)), F.coalesce("publishable", F.lit(False))))).alias("check", "_can"))
    return out.unionByName(can.select("check", F.lit(kind).alias("subject"), F.when(F.col("_can"), "ok").otherwise("fail").alias("verdict")))
