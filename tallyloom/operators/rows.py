"""Translation rows (Type, Identification, Field, Default content, Translated content): cleaning, sorting, neighbours, cutting and joining of long texts."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import classify, language, text, trees
from tallyloom.operators import sequence
from tallyloom.sources.scratch import kept

TYPE, ID, FIELD, SOURCE, TARGET = (f"`{c}`" for c in ("Type", "Identification", "Field", "Default content", "Translated content"))


def field_id() -> Column:
    return F.concat_ws("|", TYPE, ID, FIELD)


def is_bad_translation(source: Column, translated: Column, visible: Column) -> Column:
    """Too little Arabic, English terms left, or the source itself."""
    return ~text.has_script(translated) | language.keeps_english(visible) | ((translated == source) & (F.length(source) > 2) & ~text.has_script(translated))


def row_buckets(rows: DataFrame, done: DataFrame | None = None, overwrite: bool = False) -> DataFrame:
    """Adds bucket (see classify.translation_bucket). done: one column of field ids that an earlier run has translated."""
    marked = rows.withColumn("_fid", field_id())
    if done is None:
        marked = marked.withColumn("_was", F.lit(False))
    else:
        marked = marked.join(done.select(F.col(done.columns[0]).alias("_fid"), F.lit(True).alias("_was")).distinct(), "_fid", "left")
    source, target = text.stripped(F.col(SOURCE)), text.stripped(F.col(TARGET))
    visible = F.coalesce(trees.rich_text(F.when(target.startswith("{"), target)), text.visible_text(target))
    bucket = classify.translation_bucket(F.col(FIELD), F.col(SOURCE), F.col(TARGET), is_bad_translation(source, target, visible), F.col("_was"), overwrite)
    return marked.withColumn("bucket", bucket).drop("_fid", "_was")


def cleaned_for_upload(rows: DataFrame, order: str = "_row") -> DataFrame:
    """Adds removed: why a row is not uploaded, null if it is. A row that repeats an earlier one's type, identification and field is a duplicate, whatever becomes
    of that; then the first of non_translatable, keep_as_is, empty_translation and identical_no_arabic that holds."""
    key = [text.stripped(F.col(c)).alias(f"_k{k}") for k, c in enumerate((TYPE, ID, FIELD))]
    keyed = rows.select("*", *key)
    first = keyed.groupBy("_k0", "_k1", "_k2").agg(F.min(order).alias("_first"))
    source, target = text.stripped(F.col(SOURCE)), text.stripped(F.col(TARGET))
    rich = trees.rich_text(F.when(target.startswith("{"), target))
    why = (
        F.when(F.col(order) != F.col("_first"), "duplicate")
        .when(classify.is_not_uploaded(F.col(FIELD), F.col(SOURCE)), "non_translatable")
        .when(classify.is_kept(F.col(FIELD)), "keep_as_is")
        .when(target == "", "empty_translation")
        .when((target == source) & ~classify.has_arabic_for_upload(target, rich), "identical_no_arabic")
    )
    return keyed.join(first, ["_k0", "_k1", "_k2"]).withColumn("removed", why).drop("_k0", "_k1", "_k2", "_first")


def cleaned_rows(rows: DataFrame, misplaced: bool = False) -> DataFrame:
    """Adds removed (why a row goes, null if it stays) and cleared (why its translation goes), and empties such translations. Rows that repeat all stay."""
    source, target = text.stripped(F.col(SOURCE)), text.stripped(F.col(TARGET))
    removed = (
        F.when(classify.is_not_text(F.col(FIELD), F.col(SOURCE)), F.when(source == "", "non_translatable_empty").when(F.col(FIELD) == "handle", "non_translatable_handle").otherwise("non_translatable_value"))
        .when(classify.is_kept(F.col(FIELD)), "keep_as_is")
    )
    wrong = classify.misplacement(F.col(SOURCE), F.col(TARGET), trees.rich_text(F.when(source.startswith("{"), source))) if misplaced else F.lit(None).cast("string")
    cleared = F.when((target != "") & (target == source) & ~text.has_script(target), "identical_not_translated").when((target != "") & wrong.isNotNull(), F.concat(F.lit("misaligned_"), wrong))
    marked = rows.withColumn("removed", removed).withColumn("cleared", F.when(F.col("removed").isNull(), cleared))
    return marked.withColumn("Translated content", F.when(F.col("cleared").isNotNull(), "").otherwise(F.col(TARGET)))


def later_copies(rows: DataFrame, value: str, order: str, kept: Column) -> DataFrame:
    """Rows whose value an earlier row of those that `kept` admits has; null values have no copies. The first is a minimum, taken map-side."""
    admitted = rows.filter(kept & F.col(value).isNotNull())
    first = admitted.groupBy(value).agg(F.min(order).alias("_first"))
    return admitted.join(first, value).filter(F.col(order) > F.col("_first")).drop("_first")


def with_neighbours(rows: DataFrame, group: list[str], order: str, columns: list[str], reach: int = 2) -> DataFrame:
    """Adds neighbours: array of (offset, columns) of the rows up to `reach` places away within the group."""
    place = Window.partitionBy(*group).orderBy(order)
    near = [F.when(F.lag(F.lit(1), -k).over(place).isNotNull(), F.struct(F.lit(k).alias("offset"), *[F.lag(c, -k).over(place).alias(c) for c in columns])) for k in range(-reach, reach + 1) if k]
    return rows.withColumn("neighbours", F.array_compact(F.array(*near)))


def stratified_sample(rows: DataFrame, group: str, key: str, size: int, seed: int = 42) -> DataFrame:
    """`size` rows: from each group its share, one at least, by a hash of the key and the seed, and the rest from all other rows. Only the groups' numbers are
    gathered, and what each group or all could offer, `size` rows at most."""
    n = rows.select(group).distinct().count()
    share = max(1, size // max(n, 1))
    drawn = rows.withColumn("_h", F.xxhash64(key, F.lit(seed)))
    by_group = drawn.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy("_h", key))).filter(F.col("_r") <= max(share, size))
    return by_group.withColumn("_later", F.col("_r") > share).orderBy("_later", "_h", key).limit(max(size, 0)).drop("_h", "_r", "_later")


def pieces(c: Column, most_tokens: int) -> Column:
    """A long text cut into array of parts: at blank lines, else at line ends, else after sentences, else by length, whichever comes first with more than one part.
    Joined with the same separators (see whole) they are the text again."""
    limit = 3 * int(most_tokens * 0.8)
    unit = (
        F.when(c.contains("\n\n"), F.split(c, r"(?<=\n\n)(?!\n)"))
        .when(c.contains("\n"), F.split(c, r"(?<=\n)"))
        .when(c.rlike(r"[.!?。]\s"), F.split(c, r"(?<=[.!?。]\s)(?!\s)"))
        .otherwise(F.regexp_extract_all(c, F.lit(f"(?s)(.{{1,{3 * most_tokens}}})"), 1))
    )
    empty = F.array().cast("array<string>")

    def add(done: Column, part: Column) -> Column:
        last = F.element_at(done, -1)
        fits = (F.size(done) > 0) & (F.length(F.coalesce(last, F.lit(""))) + F.length(part) <= limit)
        return F.when(fits, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.concat(last, part)))).otherwise(F.concat(done, F.array(part)))

    return F.aggregate(F.filter(unit, lambda p: p != ""), empty, lambda done, part: F.when(F.size(done) == 0, F.array(part)).otherwise(add(done, part)))


def cut_fields(fields: DataFrame, id_col: str, value: str, most_tokens: int = 6000) -> DataFrame:
    """(parent, part, n_parts, id, value): fields of more tokens in parts, id being parent:chunk_<part>; others as they are, part 0 of 1. Nothing is lost at the cuts."""
    large = text.estimated_tokens(F.col(value)) > most_tokens
    parts = F.when(large, pieces(F.col(value), most_tokens)).otherwise(F.array(value))
    rows = fields.withColumn("_n", F.size(parts)).select(F.col(id_col).alias("parent"), "_n", F.posexplode(parts).alias("part", "_v"))
    name = F.when(F.col("_n") > 1, F.concat_ws(":chunk_", "parent", F.col("part").cast("string"))).otherwise(F.col("parent"))
    return rows.select("parent", "part", F.col("_n").alias("n_parts"), name.alias("id"), F.col("_v").alias("value"))


def field_batches(fields: DataFrame, group: str, order: str, id_col: str, value: str, most_tokens: int = 6000, cut_over: int = 6000) -> DataFrame:
    """(group, order, parent, part, n_parts, id, value, weight, batch): fields of a group in order, packed into batches of at most most_tokens, each further field of a batch costing five more.
    A field of more than cut_over tokens is cut (see pieces), and each part is a batch of its own. weight: tokens and those five. A null value is an empty one."""
    whole = F.coalesce(F.col(value), F.lit(""))
    large = text.estimated_tokens(whole) > cut_over
    listed = fields.select(group, order, F.col(id_col).cast("string").alias("parent"), large.alias("_alone"), F.when(large, pieces(whole, cut_over)).otherwise(F.array(whole)).alias("_p"))
    parts = listed.select(group, order, "parent", F.size("_p").alias("n_parts"), "_alone", F.posexplode("_p").alias("part", "value"))
    name = F.when(F.col("n_parts") > 1, F.concat_ws(":chunk_", "parent", F.col("part").cast("string"))).otherwise(F.col("parent"))
    weighed = parts.withColumn("id", name).withColumn("weight", (text.estimated_tokens(F.col("value")) + 5).cast("long"))
    batched = sequence.greedy_batches(kept(weighed), group, [order, "part"], "weight", most_tokens + 5, (most_tokens + 5) // 6 + 1, "_alone")
    return batched.select(group, order, "parent", "part", "n_parts", "id", "value", "weight", "batch")


def joined_fields(parts: DataFrame) -> DataFrame:
    """parts: (parent, part, n_parts, value). (id, value, whole): parts joined in order; whole is false where some are missing."""
    listed = F.array_sort(F.collect_list(F.struct("part", "value")))
    both = parts.groupBy("parent").agg(listed.alias("_p"), F.max("n_parts").alias("_n"))
    return both.select(F.col("parent").alias("id"), F.array_join(F.transform("_p", lambda p: p["value"]), "").alias("value"), (F.size("_p") == F.col("_n")).alias("whole"))


def tree_fields(rows: DataFrame, id_col: str, value: str) -> DataFrame:
    """(parent, path, id, value): rich-text trees by text node, id being parent::node<k>, blank nodes out; other values as they are with a null path."""
    nodes = trees.rich_text_nodes(value)
    listed = rows.select(F.col(id_col).alias("parent"), F.col(value).alias("_v"), nodes.alias("_n"))
    plain = listed.filter(F.size("_n") == 0).select("parent", F.lit(None).cast("string").alias("path"), F.col("parent").alias("id"), F.col("_v").alias("value"))
    some = listed.select("parent", F.posexplode("_n").alias("_k", "_node")).filter(text.stripped(F.col("_node.value")) != "")
    return plain.unionByName(some.select("parent", F.col("_node.path").alias("path"), F.concat_ws("::node", "parent", F.col("_k").cast("string")).alias("id"), F.col("_node.value").alias("value")))


def apply_tree_fields(rows: DataFrame, id_col: str, value: str, translated: DataFrame) -> DataFrame:
    """translated: (parent, path, value), as tree_fields gives them. Adds translation: trees rebuilt with the texts there are, mended to the source's form; plain values replaced;
    null where nothing is translated."""
    by = translated.groupBy("parent").agg(
        F.max(F.when(F.col("path").isNull(), F.col("value"))).alias("_plain"),
        F.collect_list(F.when(F.col("path").isNotNull(), F.struct("path", "value"))).alias("_nodes"),
    )
    met = rows.join(by, F.col(id_col) == F.col("parent"), "left")
    rebuilt = trees.mended_tree(trees.with_texts(F.when(F.size("_nodes") > 0, F.col(value)), F.col("_nodes")), F.col(value))
    return met.withColumn("translation", F.coalesce("_plain", F.when(F.size("_nodes") > 0, rebuilt))).drop("parent", "_plain", "_nodes")
