"""Matching records across systems: ladders of keys, set similarity, reference maps, upserts, schema differences."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def whole_row(df: DataFrame) -> Column:
    """All columns as a struct, whatever they are called."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def _step(rank: int, name: str):
    return lambda k, at: F.struct(F.lit(rank).alias("rank"), at.alias("at"), F.lit(name).alias("method"), k.cast("string").alias("key"))


def exploded_keys(df: DataFrame, id_col: str | Column, steps: list[tuple[str, Column]]) -> DataFrame:
    """(_id, _rank, _at, _method, _key): one row per key, steps giving a name and a column or array of keys, _at being its place in the array. Null keys are out."""
    parts = []
    for rank, (name, keys) in enumerate(steps):
        many = keys if df.select(keys.alias("_k")).schema["_k"].dataType.typeName() == "array" else F.array(keys)
        parts.append(F.coalesce(F.transform(many, _step(rank, name)), F.array().cast("array<struct<rank:int,at:int,method:string,key:string>>")))
    own = F.col(id_col) if isinstance(id_col, str) else id_col
    listed = df.select(own.alias("_id"), F.explode(F.flatten(F.array(*parts))).alias("_s"))
    return listed.select("_id", *[F.col(f"_s.{x}").alias(f"_{x}") for x in ("rank", "at", "method", "key")]).filter("_key is not null")


def key_ladder(source: DataFrame, target: DataFrame, id_col: str, order: str, source_steps: list[tuple[str, Column]], target_steps: list[tuple[str, Column]]) -> DataFrame:
    """(source_id, target_id, method): each source's match by the first step of the ladder that finds one, by its first key there that does.

    The target's keys are made unique first, the last by `order` winning, so the join is many to one however often a key occurs,
    and the best step is a minimum that is taken map-side. Sources without a match have no row; rows that repeat an id are one source. Null
    keys match nothing. Extra columns are ignored.
    """
    pair = F.struct(F.col(order).alias("order"), F.col(id_col).alias("id"))
    index = exploded_keys(target, pair, target_steps).groupBy("_rank", "_key").agg(F.max("_id").alias("_last")).select("_rank", "_key", F.col("_last.id").alias("target_id"))
    found = exploded_keys(source, id_col, source_steps).join(index, ["_rank", "_key"])
    best = found.groupBy("_id").agg(F.min(F.struct("_rank", "_at", "_method", "target_id")).alias("_best"))
    return best.select(F.col("_id").alias("source_id"), F.col("_best.target_id").alias("target_id"), F.col("_best._method").alias("method"))


def unmatched(source: DataFrame, target: DataFrame, steps: list[tuple[Column, Column]]) -> DataFrame:
    """Rows of source that share no key with target in any of the steps, each a column or array of keys on either side. An empty target leaves all."""
    keyed = source.withColumn("_row_id", F.monotonically_increasing_id())
    mine = exploded_keys(keyed, "_row_id", [(str(k), own) for k, (own, _) in enumerate(steps)])
    others = exploded_keys(target.withColumn("_one", F.lit(1)), "_one", [(str(k), other) for k, (_, other) in enumerate(steps)]).select("_rank", "_key").distinct()
    return keyed.join(mine.join(others, ["_rank", "_key"]).select(F.col("_id").alias("_row_id")).distinct(), "_row_id", "left_anti").drop("_row_id")


def one_to_one(matches: DataFrame, source_order: Column) -> DataFrame:
    """Each target goes to its first source by `source_order`; later sources lose it."""
    first = matches.groupBy("target_id").agg(F.min_by(whole_row(matches), source_order).alias("_m"))
    return first.select("_m.*")


def remap_references(refs: DataFrame, id_col: str, list_col: str, mapping: DataFrame) -> DataFrame:
    """Maps every reference of a list, drops those without a counterpart, keeps order. mapping: (old, new), old unique."""
    items = refs.select(id_col, F.posexplode(list_col).alias("_pos", "old"))
    return items.join(mapping, "old").groupBy(id_col).agg(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "new"))), lambda x: x["new"]).alias(list_col))


def dangling_references(edges: DataFrame, valid: DataFrame, key: str) -> DataFrame:
    return edges.filter(F.col(key).isNotNull()).join(valid.select(key), key, "left_anti")


def jaccard_best(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """left, right: (id, items). (left_id, right_id, score): for each left set its most similar right set of at least `least`.

    Two sets that similar share an item among their rarest ones: of n items all but ceil(least * n) - 1, the first ones in one order of all
    items. Only those meet, and only where the sizes and the places of the shared item allow the similarity. A pair meets at the first item that both
    beginnings share, so the sets travel with their beginnings and each candidate is measured once, where it meets. Ties go to the smaller right id. Sets without items, null ids
    and null items match nothing.
    """
    whole = lambda sets: sets.select("id", F.array_distinct(F.array_compact("items")).alias("items")).filter(F.col("id").isNotNull() & (F.size("items") > 0))
    l, r = whole(left), whole(right)
    often = l.select(F.explode("items").alias("_item")).unionByName(r.select(F.explode("items").alias("_item"))).groupBy("_item").agg(F.count(F.lit(1)).alias("_n"))

    def begun(sets: DataFrame, side: str) -> DataFrame:
        ranked = sets.select("id", F.explode("items").alias("_item")).join(often, "_item").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("_n", "_item"))).alias("_r"))
        items = F.transform("_r", lambda x: x["_item"])
        own = ranked.select(F.col("id").alias(f"{side}_id"), items.alias(f"{side}_items"), F.size("_r").alias(f"{side}_size"))
        keep = F.col(f"{side}_size") - F.ceil(F.col(f"{side}_size") * F.lit(least) - F.lit(1e-9)).cast("int") + 1
        return own.select("*", F.posexplode(F.slice(f"{side}_items", 1, keep)).alias(f"{side}_at", "_item")).withColumn(f"{side}_begin", F.slice(f"{side}_items", F.lit(1), F.col(f"{side}_at")))

    met = begun(l, "left").join(begun(r, "right"), "_item")
    small, large = F.least("left_size", "right_size"), F.greatest("left_size", "right_size")
    most = 1 + F.least(F.col("left_size") - F.col("left_at"), F.col("right_size") - F.col("right_at")) - 1
    possible = (small >= large * F.lit(least) - F.lit(1e-9)) & (most >= (F.col("left_size") + F.col("right_size")) * F.lit(least / (1 + least)) - F.lit(1e-9))
    first = ~F.arrays_overlap("left_begin", "right_begin")
    both = F.size(F.array_intersect("left_items", "right_items"))
    score = both / (F.col("left_size") + F.col("right_size") - both)
    good = met.filter(possible & first).select("left_id", "right_id", score.alias("score")).filter((F.col("score") >= least) & (F.col("score") > 0))
    best = good.groupBy("left_id").agg(F.max(F.struct("score", (-F.col("right_id")).alias("_r"))).alias("_b"))
    return best.select("left_id", (-F.col("_b._r")).alias("right_id"), F.col("_b.score").alias("score"))


def upsert(base: DataFrame, change: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Full outer merge: a changed value that is not null wins, keys of either side stay. action: insert, update or keep."""
    new = change.select(*keys, F.col(value).alias("_new"), F.lit(True).alias("_is_new"))
    old = base.select(*keys, F.col(value).alias("_old"), F.lit(True).alias("_is_old"))
    action = F.when(F.col("_is_old").isNull(), "insert").when(F.col("_new").isNotNull() & ~F.col("_new").eqNullSafe(F.col("_old")), "update").otherwise("keep")
    return old.join(new, keys, "full_outer").select(*keys, F.coalesce("_new", "_old").alias(value), action.alias("action"))


def schema_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """left, right: (type, field, kind). One row per (type, field) that differs: missing, extra or mismatch; whole types as missing_type or extra_type."""
    lt, rt = left.select("type").distinct().withColumn("_lt", F.lit(True)), right.select("type").distinct().withColumn("_rt", F.lit(True))
    both = left.withColumnRenamed("kind", "_l").join(right.withColumnRenamed("kind", "_r"), ["type", "field"], "full_outer").join(lt, "type", "left").join(rt, "type", "left")
    verdict = (
        F.when(F.col("_rt").isNull(), "missing_type")
        .when(F.col("_lt").isNull(), "extra_type")
        .when(F.col("_r").isNull(), "missing")
        .when(F.col("_l").isNull(), "extra")
        .when(F.col("_l") != F.col("_r"), "mismatch")
    )
    return both.withColumn("verdict", verdict).filter("verdict is not null").select("type", "field", F.col("_l").alias("left_kind"), F.col("_r").alias("right_kind"), "verdict")


def remap_paths(targets: DataFrame, path: str, mapping: DataFrame) -> DataFrame:
    """mapping: (old, new, ord). A path that equals an old one becomes the new one; else the first mapping by ord whose old path
    it extends at a slash replaces that part; else it stays. All slash-ended beginnings of a path are looked up by equality."""
    parts = F.split("_path", "/")
    starts = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    rows = targets.select(F.col(path).alias("_path")).distinct().select("_path", F.explode(F.filter(starts, lambda s: s != "")).alias("old"))
    hits = rows.join(mapping, "old").withColumn("_exact", F.when(F.col("old") == F.col("_path"), 0).otherwise(1))
    best = hits.groupBy("_path").agg(F.min_by(F.struct("old", "new"), F.struct("_exact", "ord")).alias("_hit"))
    moved = F.concat(F.col("_hit.new"), F.expr("substring(_path, length(_hit.old) + 1)"))
    return targets.join(best, targets[path].eqNullSafe(best["_path"]), "left").withColumn("new_path", F.coalesce(moved, F.col(path))).drop("_path", "_hit")


def exact_or_bare(targets: DataFrame, url: str, mapping: DataFrame) -> DataFrame:
    """mapping: (old, new), old unique. Adds new_url: of the address without slashes at its end, else of that without its query, else null."""
    bare = F.regexp_replace(F.col(url), "/+$", "")
    keyed = targets.withColumn("_exact", bare).withColumn("_bare", F.substring_index(bare, "?", 1))
    for key in ("_exact", "_bare"):
        keyed = keyed.join(mapping.select(F.col("old").alias(key), F.col("new").alias(f"{key}_new")), key, "left")
    return keyed.withColumn("new_url", F.coalesce("_exact_new", "_bare_new")).drop("_exact", "_bare", "_exact_new", "_bare_new")


def entry_status(source: DataFrame, target: DataFrame, mapped: DataFrame) -> DataFrame:
    """source, target: (type, id, handle); mapped: (type, id) of sources. (type, handle, status, source_id, target_id): mapped, unmapped (there by handle), missing, or orphaned
    in the target. Of entries of one handle the last by id counts."""
    last = lambda df, name: df.groupBy("type", "handle").agg(F.max("id").alias(name))
    known = mapped.select("type", F.col("id").alias("source_id"), F.lit(True).alias("_known")).distinct()
    both = last(source, "source_id").join(last(target, "target_id"), ["type", "handle"], "full_outer").join(known, ["type", "source_id"], "left")
    status = F.when(F.col("source_id").isNull(), "orphaned").when(F.col("_known"), "mapped").when(F.col("target_id").isNotNull(), "unmapped").otherwise("missing")
    return both.select("type", "handle", status.alias("status"), "source_id", "target_id")


def remap_rules(rules: DataFrame, definitions: DataFrame, objects: DataFrame) -> DataFrame:
    """rules: (group, pos, column, object_id, condition); definitions, objects: (old, new), old unique. The rules with object_id and condition mapped where they are; groups in which
    a product_metafield_definition rule finds no definition are skipped whole, skipped being true for all of their rules."""
    number = F.regexp_extract(F.col("object_id").cast("string"), r"(\d+)$", 1)
    met = rules.withColumn("_n", number).join(definitions.select(F.col("old").cast("string").alias("_n"), F.col("new").alias("_def")), "_n", "left")
    met = met.join(objects.select(F.col("old").alias("condition"), F.col("new").alias("_obj")), "condition", "left")
    lost = F.col("object_id").isNotNull() & F.col("_def").isNull() & (F.col("column") == "product_metafield_definition")
    veto = met.groupBy("group").agg(F.bool_or(lost).alias("skipped"))
    return met.join(veto, "group").select("group", "pos", "column", F.coalesce(F.col("_def").cast("string"), F.col("object_id").cast("string")).alias("object_id"), F.coalesce("_obj", "condition").alias("condition"), "skipped")


def same_key(left: DataFrame, right: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """(old, new): ids of the rows of left and right that agree in all keys; of several on the right, the last."""
    return left.select(F.col(id_col).alias("old"), *keys).join(right.groupBy(*keys).agg(F.max(id_col).alias("new")), keys).select("old", "new")


def lookup_verdict(fields: DataFrame, value: str, site: DataFrame, normal, no_text, pages: int = 5) -> DataFrame:
    """site: (text, pages). Adds verdict (visible, not_visible, non_text or empty), match_type (exact or normalized) and pages, the first few on which the text is seen. normal, no_text: column
    functions, of a normal form that two letters at least make comparable, and of values that are no text. Texts that only contain one another do not match: that would compare all with all."""
    exact = site.groupBy(F.col("text").alias("_t")).agg(F.min("pages").alias("_exact"))
    alike = site.withColumn("_nf", normal(F.col("text"))).filter(F.length("_nf") >= 2).groupBy("_nf").agg(F.min_by("pages", "text").alias("_alike"))
    c = F.col(value)
    met = fields.withColumn("_t", c).withColumn("_nf", normal(c)).join(exact, "_t", "left").join(alike, "_nf", "left")
    empty, other = F.coalesce(F.trim(c) == "", F.lit(True)), F.coalesce(no_text(c), F.lit(False))
    kind = F.when(empty | other, None).when(F.col("_exact").isNotNull(), "exact").when(F.col("_alike").isNotNull(), "normalized")
    verdict = F.when(empty, "empty").when(other, "non_text").when(kind.isNotNull(), "visible").otherwise("not_visible")
    seen = F.when(kind.isNotNull(), F.slice(F.coalesce("_exact", "_alike"), 1, pages))
    return met.withColumn("verdict", verdict).withColumn("match_type", kind).withColumn("pages", seen).drop("_t", "_nf", "_exact", "_alike")


def split_by_translation(content: DataFrame, local: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """content: (keys, value); local: (keys, translation); done: keys. Adds translation and action: skip what is done or blank, upload what has a local translation other than the value, translate
    the rest. Of several local translations of one key the largest counts."""
    best = local.groupBy(*keys).agg(F.max("translation").alias("translation"))
    met = content.join(best, keys, "left").join(done.select(*keys, F.lit(True).alias("_done")).distinct(), keys, "left")
    there = F.coalesce((F.trim("translation") != "") & (F.lower(F.trim("translation")) != F.lower(F.trim("value"))), F.lit(False))
    action = F.when(F.col("_done") | F.coalesce(F.trim("value") == "", F.lit(True)), "skip").when(there, "upload").otherwise("translate")
    return met.withColumn("action", F.coalesce(action, F.when(there, "upload").otherwise("translate"))).drop("_done")


def locale_split(target: DataFrame, source: DataFrame, is_junk: Column) -> DataFrame:
    """target, source: (key, value), keys unique. (key, value, source_value, action) of the target's keys: orphan without a source, identical to it, junk by is_junk over the target's columns, else useful; and
    missing for source keys with a value that the target has none for."""
    t, s = target.withColumn("_there", F.lit(True)).withColumn("_junk", is_junk), source.select("key", F.col("value").alias("source_value"), F.lit(True).alias("_source"))
    both = t.join(s, "key", "full_outer")
    lacks = F.coalesce(F.trim("value") == "", F.lit(True))
    action = (
        F.when(F.col("_there") & F.col("_source").isNull(), "orphan").when(lacks & ~F.coalesce(F.trim("source_value") == "", F.lit(True)), "missing").when(F.col("value") == F.col("source_value"), "identical")
        .when(F.col("_junk"), "junk").when(F.col("_there"), "useful")
    )
    return both.withColumn("action", action).filter("action is not null").select("key", "value", "source_value", "action")


def field_differences(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """left, right: (keys, field, value). (keys, field, status): both, missing (blank or absent on the right) or extra (on the left), by whether each has a value that is not blank."""
    has = lambda df, name: df.groupBy(*keys, "field").agg(F.max(F.coalesce(F.trim("value") != "", F.lit(False))).alias(name))
    met = has(left, "_l").join(has(right, "_r"), [*keys, "field"], "full_outer").fillna(False, ["_l", "_r"])
    status = F.when(F.col("_l") & F.col("_r"), "both").when(F.col("_l"), "missing").when(F.col("_r"), "extra")
    return met.withColumn("status", status).filter("status is not null").select(*keys, "field", "status")


def two_hops(prices: DataFrame, sources: DataFrame, mapping: DataFrame) -> DataFrame:
    """prices: (sku, price); sources: (sku, id); mapping: (old, new). (sku, source_id, target_id, price) of skus that have all three; a sku's last price, by value, counts."""
    last = prices.groupBy("sku").agg(F.max("price").alias("price"))
    return last.join(sources.select("sku", F.col("id").alias("source_id")), "sku").join(mapping.select(F.col("old").alias("source_id"), F.col("new").alias("target_id")), "source_id").select("sku", "source_id", "target_id", "price")


def same_lists(left: DataFrame, right: DataFrame, key: str, items: str) -> DataFrame:
    """(key, n_left, n_right, verdict): identical, different, or missing on the right, of lists compared in order."""
    met = left.select(key, F.col(items).alias("_l")).join(right.select(key, F.col(items).alias("_r")), key, "left")
    verdict = F.when(F.col("_r").isNull(), "missing").when(F.col("_l") == F.col("_r"), "identical").otherwise("different")
    return met.select(key, F.size("_l").alias("n_left"), F.coalesce(F.size("_r"), F.lit(0)).alias("n_right"), verdict.alias("verdict"))


def whole_groups(parts: DataFrame, group: str, key: str, known: DataFrame) -> DataFrame:
    """parts: (group, pos, key); known: (key, id). (group, ids): ids in order of the groups all of whose keys are known."""
    met = parts.join(known.select(key, "id"), key, "left")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("pos", "id"))), lambda x: x["id"])
    return met.groupBy(group).agg(F.bool_and(F.col("id").isNotNull()).alias("_all"), listed.alias("ids")).filter("_all").drop("_all")


def similar_titles(left: DataFrame, right: DataFrame, words, least: int = 2) -> DataFrame:
    """left, right: (id, ord, title). (left_id, right_id): for each left row the first right row by ord that shares `least` words, by the column function words. Rows meet by the pairs of
    their words when two are asked for, so common words alone bring none together; a title that merely contains another is no match, as that would compare all with all."""
    def keyed(df: DataFrame, side: str) -> DataFrame:
        own = df.select(F.col("id").alias(f"{side}_id"), F.col("ord").alias(f"{side}_ord"), F.array_sort(F.array_distinct(words(F.col("title")))).alias("_w"))
        pairs = F.flatten(F.transform("_w", lambda a: F.transform(F.filter("_w", lambda b: b > a), lambda b: F.concat_ws(" ", a, b))))
        return own.select(f"{side}_id", f"{side}_ord", F.explode(pairs if least >= 2 else F.col("_w")).alias("_k"))

    first = keyed(right, "right").groupBy("_k").agg(F.min(F.struct("right_ord", "right_id")).alias("_f")) if least <= 2 else keyed(right, "right").select("_k", F.struct("right_ord", "right_id").alias("_f"))
    met = keyed(left, "left").join(first, "_k")
    if least > 2:
        met = met.groupBy("left_id", "_f").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= least * (least - 1) // 2)
    return met.groupBy("left_id").agg(F.min("_f").alias("_f")).select("left_id", F.col("_f.right_id").alias("right_id"))
