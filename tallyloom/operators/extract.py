"""Texts taken out of products, other documents, templates and findings, and profiles of JSON."""

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import language, text
from tallyloom.operators.reshape import TEXT_TYPES
from tallyloom.sources.scratch import finer, kept

# Attributes that a reader sees, values of theirs that are no text, and names that stay in English.
SEEN_ATTRIBUTES = "placeholder|aria-label|alt|title"
NO_TEXT = r"(?i)^(?:https?://.*|/.*|#.*|mailto:.*|tel:.*|javascript:.*|[0-9.,]+(?:px|em|rem|%|vh|vw)?|true|false|[A-Za-z0-9_-]+\.(?:liquid|json|js|css|png|jpg|svg))$"
ENGLISH_NAMES = (
    "shopify", "liquid", "json", "html", "css", "svg", "usd", "sar", "facebook", "instagram", "twitter", "tiktok", "pinterest", "youtube", "whatsapp", "snapchat", "tumblr", "aha", "bha", "ph", "spf", "uv",
    "dna", "rna", "nmf",
)
#: The title that a product without variants gives its only one.
NO_VARIANT = "Default Title"

#: Up to so many paths a profile of JSON sends to all tasks (a path and a sample each); levels that one pass goes down at most; one in so many texts tells a profile's depth and bounds of its samples.
FEW_PATHS = 10_000
WAVE = 4
BOUNDED = 256

_PAIR = "array<struct<field:string,value:string>>"


def document_fields(docs: DataFrame, prefix: str, scalars: list[str], key: Column | None = None) -> DataFrame:
    """(field_id, value): texts of nested documents, blanks out. Ids are prefix.handle.path, the handle or, without one, the id standing for the document, or `key`.

    Of the columns that docs has: the scalars; variants as v<i>.title and v<i>.option1 to 3, but for a title that stands for no variant; options as opt<i>.name and opt<i>.val<j>; images as img<i>.alt and an image as image.alt; and
    metafields of text as mf.namespace.key. One projection and one explode; nothing is shuffled.
    """
    have = dict(docs.dtypes)
    own = F.coalesce(F.nullif(F.col("handle"), F.lit("")), F.col("id").cast("string")) if key is None else key
    pair = lambda path, value: F.struct(path.alias("field"), value.cast("string").alias("value"))
    place = lambda name, k, *rest: F.concat(F.lit(name), k.cast("string"), *map(F.lit, rest))
    groups = [F.array(*[pair(F.lit(c), F.col(c)) for c in scalars if c in have])]
    if "variants" in have:
        titles = [f.name for f in docs.schema["variants"].dataType.elementType.fields if f.name in ("title", "option1", "option2", "option3")]
        no_variant = lambda v: F.when(v != NO_VARIANT, v)
        groups.append(F.flatten(F.transform("variants", lambda v, k: F.array(*[pair(place("v", k, f".{t}"), no_variant(v[t])) for t in titles]))))
    if "options" in have:
        names = F.transform("options", lambda o, k: pair(place("opt", k, ".name"), o["name"]))
        values = F.flatten(F.transform("options", lambda o, k: F.transform(F.coalesce(o["values"], F.array().cast("array<string>")), lambda v, j: pair(F.concat(place("opt", k, ".val"), j.cast("string")), v))))
        groups += [names, values]
    if "images" in have:
        groups.append(F.transform("images", lambda i, k: pair(place("img", k, ".alt"), i["alt"])))
    if "image" in have:
        groups.append(F.array(pair(F.lit("image.alt"), F.col("image.alt"))))
    if "metafields" in have:
        texts = F.filter("metafields", lambda m: m["type"].isin(*TEXT_TYPES))
        groups.append(F.transform(texts, lambda m: pair(F.concat_ws(".", F.lit("mf"), m["namespace"], m["key"]), m["value"])))
    listed = F.flatten(F.array(*[F.coalesce(g, F.array().cast(_PAIR)) for g in groups]))
    rows = docs.select(own.alias("_key"), F.explode(listed).alias("_f")).filter(~text.blank(F.col("_f.value")))
    return rows.select(F.concat_ws(".", F.lit(prefix), "_key", "_f.field").alias("field_id"), F.col("_f.value").alias("value"))


def visible_literals(lines: DataFrame, names: tuple[str, ...] = ()) -> DataFrame:
    """lines: (file, line_number, line) of templates. (file, line_number, kind, english): texts between tags and in attributes that a reader sees, written into the template. Lines that translate, the schema of a section, what holds
    template expressions, and single words that are names, are out. The lines of a file meet in one task."""
    place = Window.partitionBy("file").orderBy("line_number")
    begin, end = F.trim("line") == "{% schema %}", F.trim("line") == "{% endschema %}"
    depth = F.sum(F.when(begin, 1).when(end, -1).otherwise(0)).over(place)
    outside = lines.withColumn("_d", depth).filter((F.col("_d") == 0) & ~end & ~F.col("line").rlike(r"\{\{.*?\|\s*t\s*[\s|}]"))
    tagged = F.transform(F.regexp_extract_all("line", F.lit(r">([^<{]*?[A-Za-z]{3,}[^<{]*?)<"), 1), lambda t: F.struct(F.lit("text").alias("kind"), F.trim(t).alias("english")))
    attributes = F.transform(F.regexp_extract_all("line", F.lit(rf'(?:{SEEN_ATTRIBUTES})\s*=\s*"([^"]*[A-Za-z]{{3,}}[^"]*)"'), 1), lambda t: F.struct(F.lit("attribute").alias("kind"), F.trim(t).alias("english")))
    found = outside.select("file", "line_number", F.explode(F.concat(tagged, attributes)).alias("_f")).select("file", "line_number", "_f.*")
    c = F.col("english")
    return found.filter((F.length(c) >= 2) & ~c.contains("{{") & ~c.contains("{%") & ~c.rlike(NO_TEXT) & ~F.lower(c).isin(*ENGLISH_NAMES, *names)).distinct()


def _nesting(doc: Column) -> Column:
    """How deep objects and arrays lie in one another in a JSON text, WAVE at most: rounds in which the innermost brackets go out."""
    brackets = F.regexp_replace(F.regexp_replace(doc, r"(?s)\\.", ""), r'"[^"]*+"|[^\[\]{}"]++', "")
    once = lambda s: F.struct(F.regexp_replace(s["left"], r"\{\}|\[\]", "").alias("left"), (s["n"] + (s["left"] != "").cast("int")).alias("n"))
    return F.aggregate(F.array(*[F.lit(k) for k in range(WAVE)]), F.struct(brackets.alias("left"), F.lit(0).alias("n")), lambda s, _: once(s))["n"]


def _told(df: DataFrame, shape: Column) -> DataFrame:
    """df: (path, kind, value, items, new), where new is a value not told yet, of this shape. (path, kind, value, items, inner): an array has a row of its own and, as an object has, one whose inner is itself, to be opened. inner is null in
    all other rows."""
    new, kind, found = F.col("new"), F.col("kind"), F.col("_shape")
    told = (
        F.when(new.isNull(), kind).when(found == "STRING", "str").when(found == "BIGINT", "int").when(found == "BOOLEAN", "bool").when(found == "VOID", "null").when(found.startswith("OBJECT"), "object").when(found.startswith("ARRAY"), "array")
        .when(found.rlike(r"DECIMAL\(\d+,0\)"), "int").otherwise("float")
    )
    df = df.withColumn("_shape", shape).withColumn("kind", told)
    array, inner = new.isNotNull() & (kind == "array"), new.isNotNull() & kind.isin("object", "array")
    df = df.withColumn("_own", F.explode(F.when(array, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))))
    text_of = F.when(new.isNull(), F.col("value")).when(inner | (kind == "null"), None).when(found.isin("BIGINT", "BOOLEAN"), F.to_json(new)).otherwise(F.try_variant_get(new, "$", "string"))
    size = F.when(F.col("_own"), F.size(F.try_variant_get(new, "$", "array<variant>"))).otherwise(F.col("items"))
    path = F.when(array, F.concat("path", F.lit("[]"))).otherwise(F.col("path"))
    return df.select(path.alias("path"), "kind", text_of.alias("value"), size.alias("items"), F.when(inner & ~F.col("_own"), new).alias("inner"))


def _read(df: DataFrame, column: str) -> DataFrame:
    """(new, shape, nesting): the texts of a column as values, null for what is no JSON, the shape of objects and arrays, and the nesting of one in BOUNDED, by hash."""
    doc = F.col(column)
    first = F.ltrim(doc, F.lit(" \t\r\n"))
    shape = F.when(first.startswith("{"), "OBJECT").when(first.startswith("["), "ARRAY")
    return df.select(F.try_parse_json(doc).alias("new"), shape.alias("shape"), F.when(F.pmod(F.xxhash64(doc), F.lit(BOUNDED)) == 0, _nesting(doc)).alias("nesting"))


def _roots(docs: DataFrame) -> DataFrame:
    """Rows of _told for values that _read gave."""
    null = lambda kind: F.lit(None).cast(kind)
    new = docs.filter(F.col("new").isNotNull()).select(F.lit("$").alias("path"), null("string").alias("kind"), null("string").alias("value"), null("int").alias("items"), "new", "shape")
    return _told(new, F.coalesce("shape", F.schema_of_variant("new")))


def _opened(df: DataFrame, levels: int, items: int | None) -> DataFrame:
    """Rows of _told with what lies so many levels below them, in one pass."""
    for _ in range(levels):
        above = df.withColumnRenamed("value", "_value")
        below = above.lateralJoin(df.sparkSession.tvf.variant_explode_outer(F.col("inner").outer())).filter(F.col("inner").isNull() | F.col("value").isNotNull())
        if items is not None:
            below = below.filter(F.col("inner").isNull() | F.col("key").isNotNull() | (F.col("pos") < items))
        path = F.when(F.col("key").isNotNull(), F.concat("path", F.lit("."), "key")).otherwise(F.col("path"))
        df = _told(below.select(path.alias("path"), "kind", F.col("_value").alias("value"), "items", F.col("value").alias("new")), F.schema_of_variant("new"))
    return df


def _waves(now: DataFrame, levels: int | None, items: int | None) -> list[DataFrame]:
    """Rows of _told and all below them, so many levels at most: tables of WAVE levels each, each a pass over what the one before left to be opened, written as VARIANT."""
    done = []
    while True:
        step = WAVE if levels is None else min(WAVE, levels)
        wave = _opened(now, step, items)
        done.append(wave.filter(F.col("inner").isNull()).drop("inner"))
        levels = None if levels is None else levels - step
        if levels == 0:
            return done
        now = kept(wave.filter(F.col("inner").isNotNull()))
        if now.isEmpty():
            return done


def json_nodes(df: DataFrame, column: str, levels: int | None = None, items: int | None = None) -> DataFrame:
    """(path, kind, value, items): every value in a column of JSON texts with its path, arrays as path[] with their number of items, other values with their text. Objects have no row of their own. Texts that
    are no JSON, and nulls, have none. levels, items: how deep to go and how many items of an array to look into; all by default. WAVE levels are one pass; only what lies deeper is written."""
    return functools.reduce(DataFrame.unionByName, _waves(_roots(_read(df, column)), levels, items))


def _filled(found: DataFrame) -> DataFrame:
    """found: nodes. Also _filled, whether a value is neither empty nor zero, _word, a filled text, and _s, the first 200 characters of a filled value."""
    filled = ~text.blank(F.col("value")) & ~((F.col("kind") != "str") & F.col("value").isin("0", "0.0", "-0.0", "false"))
    found = found.withColumn("_filled", F.coalesce(filled, F.lit(False)))
    return found.withColumn("_word", F.when((F.col("kind") == "str") & F.col("_filled"), F.col("value"))).withColumn("_s", F.when(F.col("_filled"), F.substring("value", 1, 200)))


def _least(shown: DataFrame, n: int) -> DataFrame:
    """shown: (path, _s). (path, _s0, _s1, ...): the n least distinct values of each path, each a minimum of what lies beyond the one before."""
    least = shown.groupBy("path").agg(F.min("_s").alias("_s0"))
    for k in range(1, n):
        least = kept(least)
        more = shown.join(F.broadcast(least) if least.count() <= FEW_PATHS else least, "path").filter(F.col("_s") > F.col(f"_s{k - 1}")).groupBy("path").agg(F.min("_s").alias(f"_s{k}"))
        least = least.join(more, "path", "left")
    return least


def json_dictionary(df: DataFrame, column: str, samples: int = 3, levels: int | None = None, items: int | None = None) -> DataFrame:
    """(path, kinds, n, n_filled, longest, n_spanish, n_distinct, samples, n_items): every path of a column of JSON texts with its kinds, how many values it has and how many that are neither empty nor zero, the longest text, texts that look
    Spanish, about how many distinct values (a sketch, within a few hundredths), the first distinct samples by order, cut at 200 characters, and the items of arrays. See json_nodes for levels and items.

    The texts are written once, as VARIANT, and gone through once; only texts deeper than the one in BOUNDED that tells the depth take further passes. All but the samples are sums and maxima. The same texts, one in BOUNDED, give a path's
    samples among them; what is above the last of these can be no sample, so all texts' values are told apart only up to it, and those of paths without such a bound. n_spanish and n_distinct are a pass of their own, left out where nobody
    selects them."""
    samples = max(samples, 0)
    docs = finer(kept(_read(df, column)))
    few = docs.filter(F.col("nesting").isNotNull())
    most = few.agg(F.max("nesting")).first()[0] or WAVE
    first = most if levels is None else min(most, levels)
    bound = F.col(f"_s{max(samples, 1) - 1}")
    some = kept(_filled(_opened(_roots(few), first, items)).filter(F.col("inner").isNull()).select("path", "_s").distinct().filter(F.col("_s").isNotNull()))
    bounds = kept(_least(some, max(samples, 1)).filter(bound.isNotNull()).select("path", bound.alias("_bound")).limit(FEW_PATHS))

    def told(found: DataFrame) -> DataFrame:
        near = _filled(found).join(F.broadcast(bounds), "path", "left").withColumn("_s", F.when(F.col("_bound").isNull() | (F.col("_s") <= F.col("_bound")), F.col("_s")))
        return near.groupBy("path", "kind", "_s").agg(F.count("inner").alias("_open"), F.count_if(F.col("inner").isNull()).alias("n"), F.count_if("_filled").alias("n_filled"), F.max(F.length("_word")).alias("longest"), F.sum("items").alias("n_items"))

    wave = _opened(_roots(docs), first, items)
    found, parts = [wave.filter(F.col("inner").isNull()).drop("inner")], kept(told(wave))
    if (levels is None or first < levels) and not parts.filter("_open > 0").isEmpty():
        deeper = _waves(kept(wave.filter(F.col("inner").isNotNull())), None if levels is None else levels - first, items)
        found += deeper
        parts = functools.reduce(DataFrame.unionByName, [parts, *[kept(told(d.withColumn("inner", F.lit(None)))) for d in deeper]])
    parts = parts.filter("n > 0")
    out = parts.groupBy("path").agg(
        F.array_sort(F.collect_set("kind")).alias("kinds"), F.sum("n").alias("n"), F.sum("n_filled").alias("n_filled"), F.coalesce(F.max("longest"), F.lit(0)).cast("long").alias("longest"), F.coalesce(F.sum("n_items"), F.lit(0)).alias("n_items")
    )
    listed = F.array_compact(F.array(*[F.col(f"_s{k}") for k in range(samples)]))
    words = _filled(functools.reduce(DataFrame.unionByName, found)).groupBy("path").agg(F.count_if(language.spanish_hint(F.col("_word")).isNotNull()).alias("n_spanish"), F.approx_count_distinct(F.when(F.col("_filled"), F.col("value")), 0.02).alias("n_distinct"))
    least = _least(parts.filter(F.col("_s").isNotNull()).select("path", "_s"), samples)
    return out.join(least, "path", "left").join(words, "path", "left").select("path", "kinds", "n", "n_filled", "longest", "n_spanish", "n_distinct", listed.alias("samples"), "n_items")


def mismatches(found: DataFrame, rows: DataFrame, order: str = "_row") -> DataFrame:
    """found: (row, source, reason, severity, confidence); rows: translation rows. Findings with the row's keys and the first 120 visible characters of both texts; a confidence stands for the severity."""
    cut = lambda c: text.visible_text(F.col(f"`{c}`"), 120)
    own = rows.select(F.col(order).alias("row"), F.col("Type").alias("type"), F.col("Identification").alias("identification"), F.col("Field").alias("field"), cut("Default content").alias("english"), cut("Translated content").alias("arabic"))
    return found.withColumn("severity", F.when(F.col("confidence").isNull(), F.coalesce("severity", F.lit("medium")))).join(own, "row")


def simple_status(value: Column, translation: Column, outdated: Column, rich_text: Column) -> Column:
    """MISSING without a translation, IDENTICAL for the value itself without Arabic, else OK or NOT_ARABIC, marked if outdated. rich_text: of the translation's tree."""
    arabic = text.has_script(translation) | (translation.startswith("{") & F.coalesce(text.has_script(rich_text), F.lit(False)))
    mark = F.when(F.coalesce(outdated, F.lit(False)), " [OUTDATED]").otherwise("")
    return F.when(translation.isNull(), "MISSING").when((translation == value) & ~arabic, "IDENTICAL").otherwise(F.concat(F.when(arabic, "OK").otherwise("NOT_ARABIC"), mark))


def first_rows(df: DataFrame, order: str, n: int, group: list[str] | None = None) -> DataFrame:
    """The first n rows by order, of each group if there are any; a spot check looks at no more."""
    if not group:
        return df.orderBy(order).limit(n)
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*group).orderBy(order))).filter(F.col("_r") <= n).drop("_r")


def most_common(df: DataFrame, value: str, n: int, order: str) -> DataFrame:
    """(value, n): the n most frequent values, of equally frequent ones the first seen by order."""
    counted = df.groupBy(value).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("_first"))
    return counted.orderBy(F.desc("n"), "_first").limit(n).drop("_first")


def digest(rows: DataFrame, section: str, order: str, line: Column, most: int, width: int) -> DataFrame:
    """(section, text): the first `most` distinct lines of each section by order, each cut to a width, as one text."""
    cut = rows.select(section, F.col(order).alias("_o"), F.substring(line, 1, width).alias("_l")).filter(~text.blank(F.col("_l"))).groupBy(section, "_l").agg(F.min("_o").alias("_o"))
    first = first_rows(cut, "_o", most, [section])
    return first.groupBy(section).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_o", "_l"))), lambda x: x["_l"]), "\n").alias("text"))
