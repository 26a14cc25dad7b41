"""Trees as tables of edges: menus out of category trees, paths of nodes."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.sources.scratch import kept

#: Doublings after which a chain of parents must have ended; a longer one is a cycle.
MOST_DOUBLINGS = 40

# How a menu entry names its target.
COLLECTION_ID, COLLECTION_PATH = "gid://shopify/Collection/", "/collections/"


def blank(c: Column) -> Column:
    return F.coalesce(c == "", F.lit(True))


def hoisted(nodes: DataFrame, passed_over: Column) -> DataFrame:
    """nodes: (tree, id, parent, pos, ...), a root's parent being null. Adds above, the nearest ancestor that is not passed over (null for none), and place, the positions from there down to the node, by
    which the children of one ancestor are in their order. Nodes that are passed over have both too.

    Chains of passed-over parents are halved in each round by one join of those nodes that still stand below one, so a chain of n takes log2(n) rounds. A cycle of passed-over
    nodes is an error; a parent that is not there counts as none."""
    ids = nodes.select("tree", F.col("id").alias("parent"), F.lit(True).alias("_there"))
    state = nodes.withColumn("_over", F.coalesce(passed_over, F.lit(False))).join(ids, ["tree", "parent"], "left")
    state = state.withColumn("above", F.when(F.col("_there"), F.col("parent"))).withColumn("place", F.array(F.col("pos").cast("long"))).drop("_there")
    for _ in range(MOST_DOUBLINGS):
        state = kept(state)
        over = state.filter("_over").select("tree", F.col("id").alias("above"), F.col("above").alias("_next"), F.col("place").alias("_before"), F.lit(True).alias("_hit"))
        met = state.join(over, ["tree", "above"], "left")
        if not met.filter("_hit").limit(1).count():
            return state.drop("_over")
        state = met.withColumn("above", F.when(F.col("_hit"), F.col("_next")).otherwise(F.col("above"))).withColumn("place", F.when(F.col("_hit"), F.concat("_before", "place")).otherwise(F.col("place"))).select(state.columns)
    raise ValueError("the passed-over nodes of a tree form a cycle")


def category_menu(categories: DataFrame, collections: DataFrame, skipped: tuple[str, ...] = ()) -> DataFrame:
    """categories: (tree, id, parent, pos, name, url_key, product_count); collections: (url_key, id), url_key unique. (tree, id, above, place, title, resource_id, url): the menu entries, each below the entry `above` (null: at the top) in the order of place.

    A category without name or url_key, or whose url_key is skipped, gives no entry and its children take its place. One without a collection, products and children is left out. An entry leads to its collection
    or, without one, to the path of its url_key. A null product_count is none. Ids are unique in a tree; an empty table gives no rows."""
    over = blank(F.col("name")) | blank(F.col("url_key")) | F.col("url_key").isin(*skipped)
    placed = hoisted(categories, over)
    parents = categories.filter("parent is not null").select("tree", F.col("parent").alias("id"), F.lit(True).alias("_parent")).distinct()
    met = placed.filter(~over).join(parents, ["tree", "id"], "left").join(collections.select("url_key", F.col("id").cast("string").alias("_collection")), "url_key", "left")
    there = F.col("_collection").isNotNull() | (F.coalesce("product_count", F.lit(0)) != 0) | F.coalesce("_parent", F.lit(False))
    resource = F.concat(F.lit(COLLECTION_ID), F.col("_collection"))
    return met.filter(there).select("tree", "id", "above", "place", F.col("name").alias("title"), resource.alias("resource_id"), F.when(resource.isNull(), F.concat(F.lit(COLLECTION_PATH), F.col("url_key"))).alias("url"))


def depths(nodes: DataFrame) -> DataFrame:
    """nodes: (tree, id, parent). (tree, id, depth, root): how far each node is from its root, by doubling. Nodes on a cycle, or below one, have a null root."""
    ids = nodes.select("tree", F.col("id").alias("parent"), F.lit(True).alias("_there"))
    start = nodes.select("tree", "id", "parent").join(ids, ["tree", "parent"], "left")
    state = start.select("tree", "id", F.when(F.col("_there"), F.col("parent")).alias("up"), F.when(F.col("_there"), F.lit(1)).otherwise(0).cast("long").alias("depth"), F.when(F.col("_there").isNull(), F.col("id")).alias("root"))
    for _ in range(MOST_DOUBLINGS):
        state = kept(state)
        if not state.filter("root is null and up is not null").limit(1).count():
            break
        other = state.select("tree", F.col("id").alias("up"), F.col("up").alias("_up"), F.col("depth").alias("_depth"), F.col("root").alias("_root"))
        met = state.join(other, ["tree", "up"], "left")
        state = met.select("tree", "id", F.when(F.col("root").isNull(), F.col("_up")).alias("up"), F.when(F.col("root").isNull(), F.col("depth") + F.col("_depth")).otherwise(F.col("depth")).alias("depth"), F.coalesce("root", "_root").alias("root"))
        if state.filter(F.col("depth") > 1 << 40).limit(1).count():
            break
    return state.select("tree", "id", F.when(F.col("root").isNotNull(), F.col("depth")).alias("depth"), "root")
