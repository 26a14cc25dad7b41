"""Audits of a store's content, and products prepared for another store."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import html, language, text, trees
from tallyloom.operators import changes

# Parts of handles that are Spanish, and characters under which a body's visible text is not judged.
SPANISH_HANDLES = ("champu", "acondicionador", "mascarilla", "serum-", "rutina-")
LEAST_BODY = 10


def audit_content(resources: DataFrame, spanish: bool = True, bloat: bool = True) -> DataFrame:
    """resources: (kind, id, handle, title, body_html, metafields with key, value, type). (kind, id, handle, field, issue): html_bloat of bodies and of rich-text metafields, spanish of bodies (their visible text, ten characters at least),
    titles and metafields (a tree's texts). One pass, nothing is shuffled; blank values have no issue."""
    none = F.lit(None).cast("struct<field:string,issue:string>")
    found = lambda test, field, issue: F.when(F.coalesce(test, F.lit(False)), F.struct(field.alias("field"), F.lit(issue).alias("issue"))).otherwise(none)
    visible = text.visible_text(F.col("body_html"))
    own = [found(F.lit(bloat) & html.has_bloat(F.col("body_html")), F.lit("body_html"), "html_bloat"), found(F.lit(spanish) & (F.length(visible) >= LEAST_BODY) & language.is_spanish(visible), F.lit("body_html"), "spanish"),
           found(F.lit(spanish) & language.is_spanish(F.col("title")), F.lit("title"), "spanish")]
    keep = ["kind", "id", "handle"]
    first = resources.select(*keep, F.explode(F.array_compact(F.array(*own))).alias("_f")).select(*keep, "_f.field", "_f.issue")
    fields = resources.select(*keep, F.explode("metafields").alias("_m")).select(*keep, F.concat(F.lit("metafield:"), F.col("_m.key")).alias("field"), F.col("_m.value").alias("_v"), F.col("_m.type").alias("_t"))
    checked = F.coalesce(trees.rich_text(F.when(F.col("_t") == "rich_text_field", F.col("_v"))), F.col("_v"))
    more = [found(F.lit(bloat) & (F.col("_t") == "rich_text_field") & html.has_bloat(F.col("_v")), F.col("field"), "html_bloat"), found(F.lit(spanish) & language.is_spanish(checked), F.col("field"), "spanish")]
    return first.unionByName(fields.select(*keep, F.explode(F.array_compact(F.array(*more))).alias("_f")).select(*keep, "_f.field", "_f.issue"))


def product_faults(products: DataFrame) -> DataFrame:
    """products: (id, handle, status, images, variants with title, price, inventory_management, inventory_quantity). (code, severity, subject): not active, no images, a Spanish handle, and for each variant a price of zero or none in stock where stock is
    kept. A missing price is zero, a missing quantity none; subject is the product's id, for variants id/title."""
    own = changes.findings(products, "id", {
        "not_active": ("fail", ~F.col("status").eqNullSafe("active")), "no_images": ("fail", F.coalesce(F.size("images") < 1, F.lit(True))),
        "spanish_handle": ("fail", F.coalesce(F.col("handle").rlike("|".join(SPANISH_HANDLES)), F.lit(False))),
    })
    variants = products.select("id", F.explode("variants").alias("v")).select(F.concat_ws("/", F.col("id").cast("string"), F.coalesce("v.title", F.lit(""))).alias("subject"), "v.*")
    amount = F.coalesce(F.col("price").try_cast("double"), F.lit(0.0))
    kept = ~text.blank(F.col("inventory_management")) & (F.coalesce("inventory_quantity", F.lit(0)) <= 0)
    more = changes.findings(variants, "subject", {"zero_price": ("fail", amount == 0), "no_inventory": ("fail", kept)})
    return own.withColumn("subject", F.col("subject").cast("string")).unionByName(more)


PREPARED_TEXTS = ("title", "body_html", "vendor", "product_type", "tags", "handle")


def prepared_products(products: DataFrame, prices: DataFrame) -> DataFrame:
    """products: (id, title, body_html, vendor, product_type, tags, handle, status, images, variants with sku, price, compare_at_price); prices: (sku, final_price, regular_price), sku unique. What a new store is given: texts without nulls, status (draft for none), published for active ones,
    images with an address (a blank alternative text is null), and variants with the price map's price for their sku, else their own or "0". A regular price that differs from the final one is compare_at_price; without a price in the map the variant's own stays.

    Variants meet the prices by sku, spread by product, and come back in their order. Products without images or variants have empty arrays."""
    listed = products.select("id", F.posexplode("variants").alias("_at", "v"))
    known = prices.select(F.col("sku").alias("_sku"), F.col("final_price").cast("string").alias("_final"), F.col("regular_price").cast("string").alias("_regular"))
    met = listed.withColumn("_sku", F.nullif(F.col("v.sku"), F.lit(""))).join(known, "_sku", "left")
    price = F.coalesce("_final", "v.price", F.lit("0"))
    compare = F.when(F.col("_final").isNotNull(), F.when(F.col("_regular") != F.col("_final"), F.col("_regular"))).otherwise(F.col("v.compare_at_price"))
    one = F.struct("_at", F.coalesce("v.sku", F.lit("")).alias("sku"), price.alias("price"), compare.alias("compare_at_price"))
    variants = met.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: x.dropFields("_at")).alias("variants"))
    images = F.transform(F.filter(F.coalesce("images", F.array().cast("array<struct<src:string,alt:string>>")), lambda i: ~text.blank(i["src"])), lambda i: F.struct(i["src"].alias("src"), F.nullif(i["alt"], F.lit("")).alias("alt")))
    status = F.coalesce("status", F.lit("draft"))
    base = products.select("id", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in PREPARED_TEXTS], status.alias("status"), (status == "active").alias("published"), images.alias("images"))
    none = F.array().cast("array<struct<sku:string,price:string,compare_at_price:string>>")
    return base.join(variants, "id", "left").withColumn("variants", F.coalesce("variants", none))
