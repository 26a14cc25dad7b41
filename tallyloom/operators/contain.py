"""Joins of texts that contain one another, and of keys that end alike, by equality joins on parts of them."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import parts
from tallyloom.operators import match
from tallyloom.sources.scratch import kept, spread_join

#: Characters of the parts by which texts meet; no shorter text is looked for.
GRAM = 4
#: Up to so many texts that are shorter are sent to all tasks.
FEW_SHORT = 100_000


def grams(text: Column, size: int = GRAM) -> Column:
    """All distinct parts of `size` characters. One pass over the text: substring by place would start from its beginning each time."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(rf"(?s)(?=(.{{{size}}}))"), 1))


def contained(needles: DataFrame, hay: DataFrame, size: int = GRAM) -> DataFrame:
    """needles: (needle); hay: (hay). Distinct pairs (needle, hay) of which hay contains needle, needles of fewer than `size` characters and nulls left out.

    A needle asks by one of its parts alone, of 4 * `size` characters, or of 2 * `size` or `size` in a shorter one: the rarest by counts of all parts of the hay in buckets, a table of fixed size that all tasks get. If one of its parts
    is nowhere there, it has no match and goes. Hay texts offer those of their parts that are asked for, which a bitmap of the asked ones tells at once, so no table of all parts is written. They meet by keys of parts; a part
    that many ask for or offer is spread over many tasks. Only candidates get their texts back and are compared.
    """
    spark = needles.sparkSession
    there = kept(hay.select("hay").filter(F.length("hay") >= size).distinct().withColumn("_h", F.monotonically_increasing_id()))
    asked = needles.select("needle").filter(F.length("needle") >= size).distinct()
    n, all_ = len(parts.lengths(size)), 1 << parts.BUCKET_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n * all_, np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in parts.chunks(texts):
                for k, (found, _) in enumerate(parts.keys(texts[a:b], size)):
                    total[k * all_ : (k + 1) * all_] += np.bincount(parts.buckets(found), minlength=all_)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["_at", "_n"])

    counted = there.select("hay").mapInArrow(count, "_at long, _n long").groupBy("_at").agg(F.sum("_n").alias("_n")).toArrow()  # no more rows than there are buckets
    counts = np.zeros(n * all_, np.int64)
    counts[counted.column("_at").to_numpy()] = counted.column("_n").to_numpy()
    counts = np.minimum(counts, 2**31 - 1).astype(np.int32).reshape(n, all_)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in parts.chunks(texts):
                found, at = parts.rarest(texts[a:b], size, counts)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at + a)), pa.array(found.view(np.int64))], names=["needle", "_key"])

    by = kept(asked.mapInArrow(ask, "needle string, _key long"))
    bits = min(max((16 * by.count()).bit_length(), 15), 28)
    bit = F.col("_key").bitwiseAND(F.lit((1 << bits) - 1)) + 1
    blocks = by.groupBy(F.bitmap_bucket_number(bit).alias("_block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("_bits")).toArrow()  # 4 KB each, 8192 at most
    wanted = np.zeros((max(1 << bits, 1 << 15)) // 8, np.uint8)
    for block, some in zip(blocks.column("_block").to_pylist(), blocks.column("_bits").to_pylist(), strict=True):
        wanted[(block - 1) * 4096 : block * 4096] = np.frombuffer(some, np.uint8)

    def offer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for a, b in parts.chunks(texts):
                for found, owner in parts.keys(texts[a:b], size):
                    low = found & np.uint64((1 << bits) - 1)
                    some = (wanted[low >> np.uint64(3)] >> (low & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    yield pa.RecordBatch.from_arrays([pa.array(found[some].view(np.int64)), pa.array(ids[a:b][owner[some]])], names=["_key", "_h"])

    offered = kept(there.select("hay", "_h").mapInArrow(offer, "_key long, _h long"))
    # A part asked for by a needles and offered by h texts gives a * h candidates; both sides of a hot one are dealt out in a grid.
    many = by.groupBy("_key").agg(F.count(F.lit(1)).alias("_a")).join(offered.groupBy("_key").agg(F.count(F.lit(1)).alias("_o")), "_key")
    grid = kept(many.select("_key", *[F.least(F.lit(64), F.ceil(F.col(c) / 4096)).cast("int").alias(n) for c, n in (("_a", "_rows"), ("_o", "_columns"))]))
    part = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    asking = by.join(grid, "_key").select("_key", "needle", part("needle", "_rows").alias("_x"), F.explode(F.sequence(F.lit(0), F.col("_columns") - 1)).alias("_y"))
    offering = offered.join(grid, "_key").distinct().select("_key", "_h", part("_h", "_columns").alias("_y"), F.explode(F.sequence(F.lit(0), F.col("_rows") - 1)).alias("_x"))
    met = kept(asking.join(offering, ["_key", "_x", "_y"]).select("needle", "_h"))
    return spread_join(met, there, ["_h"]).filter(F.col("hay").contains(F.col("needle"))).select("needle", "hay")


def first_contained(left: DataFrame, right: DataFrame, size: int = GRAM, least_left: int = GRAM, least_right: int = 1) -> DataFrame:
    """left: (text); right: (text, ord, what). (text, ord, what, other): for each left text of at least least_left characters the first right one, of at least least_right, by ord that contains it or that it
    contains. Texts shorter than `size` are met by equality with the short parts of the other side. Empty texts and nulls match nothing. Of equal right texts the first counts. ord has no ties."""
    l = kept(left.select("text").filter(F.length("text") >= max(least_left, 1)).distinct())
    r = kept(right.filter(F.length("text") >= max(least_right, 1)).groupBy("text").agg(F.min(F.struct("ord", "what")).alias("_f")))
    own, other = l.select(F.col("text").alias("left")), r.select(F.col("text").alias("right"))
    within = contained(own.withColumnRenamed("left", "needle"), other.withColumnRenamed("right", "hay"), size).select(F.col("needle").alias("left"), F.col("hay").alias("right"))
    around = contained(other.withColumnRenamed("right", "needle"), own.withColumnRenamed("left", "hay"), size).select(F.col("hay").alias("left"), F.col("needle").alias("right"))
    pairs = within.unionByName(around)

    def short_parts(texts: DataFrame, side: str, least: int, into: str) -> DataFrame:
        """Distinct parts shorter than `size` of each text, as `into`."""
        return texts.select(*texts.columns, F.explode(F.array_distinct(F.flatten(F.array(*[grams(F.col(side), k) for k in range(max(least, 1), size)])))).alias(into))

    # The other side's short texts are looked for alone, if there are any.
    if least_right < size and (short := kept(other.filter(F.length("right") < size))).count():
        met = short_parts(own, "left", least_right, "right").join(F.broadcast(short) if short.count() <= FEW_SHORT else short, "right", "left_semi")
        pairs = pairs.unionByName(met.select("left", "right"))
    if least_left < size and (short := kept(own.filter(F.length("left") < size))).count():  # only the first of the right texts with a short part is of interest
        offers = short_parts(r.select(F.col("text").alias("right"), "_f"), "right", least_left, "left").join(F.broadcast(short) if short.count() <= FEW_SHORT else short, "left", "left_semi")
        pairs = pairs.unionByName(offers.groupBy("left").agg(F.min(F.struct("_f", "right"))["right"].alias("right")))
    best = spread_join(kept(pairs), r.select(F.col("text").alias("right"), "_f"), ["right"]).groupBy("left").agg(F.min(F.struct("_f.ord", "_f.what", "right")).alias("_b"))
    return best.select(F.col("left").alias("text"), F.col("_b.ord").alias("ord"), F.col("_b.what").alias("what"), F.col("_b.right").alias("other"))


def matched_keys(texts: DataFrame, fields: DataFrame, normal, size: int = GRAM) -> DataFrame:
    """texts: (text); fields: (id, ord, english). (text, id, step) of each distinct text, blanks at its ends cut off, that is not blank: exact, normalized or substring (in either
    direction, for normal forms of at least `size` characters), each the first field by ord; id and step are null for texts without a match. normal: a column function. A blank field matches nothing; a
    normal form that is empty is none."""
    seen = kept(texts.select(F.trim("text").alias("text")).filter(F.col("text") != "").distinct().withColumn("_nf", F.nullif(normal(F.col("text")), F.lit(""))))
    known = kept(fields.select("id", "ord", F.trim("english").alias("english")).filter(F.col("english") != "").withColumn("_nf", F.nullif(normal(F.col("english")), F.lit(""))))
    first = lambda c, name: known.filter(F.col(c).isNotNull()).groupBy(c).agg(F.min(F.struct("ord", "id"))["id"].alias(name))
    met = seen.join(first("english", "_exact").withColumnRenamed("english", "text"), "text", "left")
    met = kept(spread_join(kept(met), first("_nf", "_alike"), ["_nf"], "left"))
    rest = met.filter(F.col("_exact").isNull() & F.col("_alike").isNull()).select(F.col("_nf").alias("text"))
    part = first_contained(rest, known.select(F.col("_nf").alias("text"), "ord", F.col("id").alias("what")), size, size).select(F.col("text").alias("_nf"), F.col("what").alias("_part"))
    met = met.join(part, "_nf", "left")
    step = F.when(F.col("_exact").isNotNull(), "exact").when(F.col("_alike").isNotNull(), "normalized").when(F.col("_part").isNotNull(), "substring")
    return met.select("text", F.coalesce("_exact", "_alike", "_part").alias("id"), step.alias("step"))


def lookup_verdict(fields: DataFrame, value: str, site: DataFrame, normal, no_text, pages: int = 5, size: int = GRAM) -> DataFrame:
    """match.lookup_verdict with its third step: a value that is not seen as it is, nor in its normal form, is visible as substring if its normal form contains, or is contained in, that of a site text, both of at
    least `size` characters; the first site text by its own order counts. Adds matched_text, that text's first 80 characters, for such values."""
    told = match.lookup_verdict(fields, value, site, normal, no_text, pages).withColumn("_nf", normal(F.col(value)))
    told = kept(told)
    open_ = told.filter((F.col("verdict") == "not_visible")).select(F.col("_nf").alias("text"))
    index = site.select(normal(F.col("text")).alias("_t"), F.col("text").alias("ord"), F.slice("pages", 1, pages).alias("what"))
    parts = first_contained(open_, index.select(F.col("_t").alias("text"), "ord", "what"), size, size, size)
    hit = parts.select(F.col("text").alias("_nf"), F.col("what").alias("_pages"), F.substring("ord", 1, 80).alias("_other"))
    met = told.join(hit, "_nf", "left")
    third = (F.col("verdict") == "not_visible") & F.col("_other").isNotNull()
    return (
        met.withColumn("match_type", F.when(third, "substring").otherwise(F.col("match_type")))
        .withColumn("pages", F.when(third, F.col("_pages")).otherwise(F.col("pages")))
        .withColumn("matched_text", F.when(third, F.col("_other")))
        .withColumn("verdict", F.when(third, "visible").otherwise(F.col("verdict")))
        .drop("_nf", "_pages", "_other")
    )


def store_matches(left: DataFrame, right: DataFrame, handles: DataFrame) -> DataFrame:
    """left, right: (id, ord, handle, title); handles: (old, new), old unique. (left_id, right_id, step) of the left rows that are not passed over: mapped (its handle's new one is there), handle (its own is), title, or null for no match.

    A handle that two rows come to is the first one's by ord, later rows are passed over, as are rows whose mapped handle an earlier one has, there or not. A title matches the first right one by ord that shares two words with it or contains it or
    is contained in it, in lower case; so a blank one matches the first of all, and a blank right one is contained in every title. Of right rows of one handle the last by ord counts. A null title or handle is blank; ord has no ties. Rows that repeat an id are one each."""
    blank = lambda c: F.coalesce(c, F.lit(""))
    r = kept(right.select("id", "ord", blank(F.col("handle")).alias("handle"), F.lower(blank(F.col("title"))).alias("title")))
    there = r.groupBy("handle").agg(F.max_by("id", "ord").alias("_at"))
    l = left.select("id", "ord", blank(F.col("handle")).alias("handle"), F.lower(blank(F.col("title"))).alias("title"))
    l = l.join(handles.select(F.col("old").alias("handle"), F.nullif(F.col("new"), F.lit("")).alias("new")), "handle", "left")
    l = kept(l.join(there.select(F.col("handle").alias("new"), F.col("_at").alias("_mapped")), "new", "left").join(there.select("handle", F.col("_at").alias("_own")), "handle", "left"))
    first_mapped = l.filter("new is not null").groupBy("new").agg(F.min("ord").alias("_first_new"))
    l = kept(l.join(first_mapped, "new", "left").withColumn("_lost", F.coalesce(F.col("ord") > F.col("_first_new"), F.lit(False))))
    claim = F.when(F.col("_mapped").isNotNull(), F.col("new")).when(F.col("_own").isNotNull(), F.col("handle"))
    claims = kept(l.filter("not _lost").withColumn("_claim", claim))
    winners = claims.filter("_claim is not null").groupBy("_claim").agg(F.min("ord").alias("_won"))
    kept_rows = kept(claims.join(winners, "_claim", "left").filter(F.col("_claim").isNull() | (F.col("ord") == F.col("_won"))))
    rest = kept_rows.filter("_claim is null").select("id", "ord", "title")

    words = lambda c: F.filter(F.split(c, r"\s+"), lambda w: w != "")
    shared = match.similar_titles(rest.select(F.col("ord").alias("id"), "ord", "title"), r.select(F.struct("ord", "id").alias("id"), "ord", "title"), words)
    parts = first_contained(rest.select("title").withColumnRenamed("title", "text"), r.select(F.col("title").alias("text"), "ord", F.col("id").alias("what")), least_left=1)
    found = shared.select(F.col("left_id").alias("ord"), F.col("right_id").alias("_hit"))
    found = found.unionByName(rest.join(parts.select(F.col("text").alias("title"), F.struct(F.col("ord"), F.col("what").alias("id")).alias("_hit")), "title").select("ord", "_hit"))
    any_row, empty_row = r.agg(F.min(F.struct("ord", "id")), F.min(F.when(F.col("title") == "", F.struct("ord", "id")))).first()
    kind = r.select(F.struct("ord", "id").alias("_hit")).schema["_hit"].dataType
    for hit, which in ((any_row, F.col("title") == ""), (empty_row, F.lit(True))):
        if hit is not None:
            found = found.unionByName(rest.filter(which).select("ord", F.struct(F.lit(hit["ord"]).alias("ord"), F.lit(hit["id"]).alias("id")).cast(kind).alias("_hit")))
    best = found.groupBy("ord").agg(F.min("_hit").alias("_hit"))
    met = kept_rows.join(best, "ord", "left")
    step = F.when(F.col("_mapped").isNotNull(), "mapped").when(F.col("_own").isNotNull(), "handle").when(F.col("_hit").isNotNull(), "title")
    return met.select(F.col("id").alias("left_id"), F.coalesce("_mapped", "_own", "_hit.id").alias("right_id"), step.alias("step"))


def by_suffix(keys: DataFrame, handles: DataFrame, separator: str = ".") -> DataFrame:
    """keys: (key, ord, what); handles: (handle). (handle, key, what): for each handle the first key by ord that ends with the separator and the handle. Every suffix of a key that follows a separator is
    an entry of the index, of which the first by ord is kept by a minimum taken map-side; handles may hold separators themselves. Blank handles match nothing; a null is none."""
    parts = F.split("key", f"\\Q{separator}\\E", -1)
    n = F.size(parts)
    ends = F.when(n > 1, F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda k: F.array_join(F.slice(parts, k + 1, n), separator)))
    index = keys.select("key", "ord", "what", F.explode(ends).alias("handle")).filter("handle <> ''").groupBy("handle").agg(F.min(F.struct("ord", "key", "what")).alias("_f"))
    return handles.select("handle").join(index, "handle").select("handle", F.col("_f.key").alias("key"), F.col("_f.what").alias("what"))
