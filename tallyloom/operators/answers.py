"""Asking a model for many rows and taking its answers apart: batches under opaque numbers, retries, verdicts in passes. Every answer is written before anything reads it."""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import text
from tallyloom.sources.scratch import kept

Ask = Callable[[str], str | None]

#: Attempts at a batch, the share of its lines with which an answer is accepted, and missing fields up to which they are asked for once more.
ATTEMPTS, ACCEPTED, MOST_MISSING = 4, 0.9, 10

# Words by which an answer without any record is told to be a refusal, and the tags around records.
REFUSALS = ("sorry", "can't process")
TAGS = r"</?TOON>"


def unfenced(raw: Column) -> Column:
    """The text within a code fence and without the tags around records."""
    c = text.stripped(raw)
    lines = F.split(c, "\n")
    last = F.when(text.stripped(F.element_at(lines, -1)) == "```", 1).otherwise(0)
    inside = F.array_join(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1 - last, F.lit(0))), "\n")
    return text.stripped(F.regexp_replace(F.when(c.startswith("```"), inside).otherwise(c), TAGS, ""))


def records(raw: Column) -> Column:
    """array of struct(id, value): the answer's lines that are records, in their order."""
    return F.filter(F.transform(F.split(unfenced(raw), "\n"), text.decoded_record), lambda r: r.isNotNull())


def answer_kind(raw: Column, expected: Column, accepted: float = ACCEPTED) -> Column:
    """empty (or no answer at all), refusal, accepted, or short: fewer records than the accepted share of those expected."""
    c = text.stripped(raw)
    no = ~c.contains(text.RECORD_MARK) & F.array_contains(F.transform(F.array(*map(F.lit, REFUSALS)), lambda w: F.lower(c).contains(w)), True)
    return F.when(F.coalesce(c == "", F.lit(True)), "empty").when(no, "refusal").when(F.size(records(raw)) >= expected * F.lit(accepted), "accepted").otherwise("short")


def requests(fields: DataFrame) -> DataFrame:
    """fields: (batch, pos, id, value). (batch, n, request, ids): a batch's fields as records under the numbers 0, 1, ... by pos; ids in that order. A batch is as large as batching made it."""
    listed = F.array_sort(F.collect_list(F.struct("pos", "id", F.coalesce("value", F.lit("")).alias("value"))))
    whole = fields.groupBy("batch").agg(listed.alias("_f"))
    lines = F.transform("_f", lambda f, k: text.encoded_record(k.cast("string"), f["value"]))
    return whole.select("batch", F.size("_f").alias("n"), F.array_join(lines, "\n").alias("request"), F.transform("_f", lambda f: f["id"]).alias("ids"))


def asked(rows: DataFrame, ask: Ask) -> DataFrame:
    """Adds raw and error, of which one is null (both, if the answer is): ask is called in the tasks once for each request, and what it raises is an error of that request alone. Written at once."""
    schema = f"{rows._jdf.schema().toDDL()}, raw string, error string"
    at = rows.columns.index("request")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, errors = [], []
            for request in batch.column(at).to_pylist():
                try:
                    raw.append(ask(request))
                    errors.append(None)
                except Exception as e:  # whatever a client raises: the request is tried again
                    raw.append(None)
                    errors.append(str(e)[:200])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.string()), pa.array(errors, pa.string())], names=[*batch.schema.names, "raw", "error"])

    return kept(rows.mapInArrow(run, schema))


def taken(answers: DataFrame, mangled: bool = False) -> DataFrame:
    """(id, translation): records back under the ids of their requests; numbers that were not asked are passed over, and of a number's records the last counts. mangled: the only field of a request takes the first record
    if no record has its number."""
    found = answers.select("batch", "ids", F.posexplode(records(F.col("raw"))).alias("_at", "_r"))
    plain = F.when(F.col("_r.id").rlike("^(0|[1-9][0-9]{0,8})$"), F.col("_r.id").cast("int"))
    own = found.select("ids", "_at", plain.alias("_k"), F.col("_r.value").alias("_v")).filter((F.col("_k") < F.size("ids")) & F.col("_k").isNotNull())
    out = own.groupBy(F.get("ids", F.col("_k")).alias("id")).agg(F.max_by("_v", "_at").alias("translation"))
    if not mangled:
        return out
    single = found.filter((F.size("ids") == 1) & (F.col("_at") == 0)).select(F.get("ids", F.lit(0)).alias("id"), F.col("_r.value").alias("_first"))
    return out.join(single, "id", "full_outer").select("id", F.coalesce("translation", "_first").alias("translation"))


def answered(fields: DataFrame, ask: Ask, attempts: int = ATTEMPTS, accepted: float = ACCEPTED, most_missing: int = MOST_MISSING, mangled: bool = False) -> DataFrame:
    """fields: (batch, pos, id, value), ids unique. (id, translation, outcome): translated; retried, if it came with the second request; missing; or, if its whole batch had no answer, refusal or empty.

    Only records under opaque numbers go out. A batch whose answer is empty, a refusal or short of the accepted share is asked again, up to `attempts` times; after the last, what a short answer has is taken. Then batches
    that lack `most_missing` fields at most ask for these once more, under new numbers; others leave them for the next run. Each attempt is a table of its own, so a lost executor asks nothing twice that was
    written, and later steps all see the same answers. A null value goes out as an empty one. An empty table asks nothing."""
    whole = kept(requests(fields))
    pending, settled = whole, []
    for k in range(attempts):
        told = asked(pending, ask).withColumn("kind", answer_kind(F.col("raw"), F.col("n"), accepted))
        final = k == attempts - 1
        settled.append(told if final else told.filter("kind = 'accepted'"))
        pending = kept(told.filter("kind <> 'accepted'").select(*whole.columns))
        if final or not pending.limit(1).count():
            break
    answers = settled[0]
    for more in settled[1:]:
        answers = answers.unionByName(more)
    answers = kept(answers)
    first = taken(answers.filter("kind IN ('accepted', 'short')"), mangled)
    batch_kind = answers.select("batch", "kind")
    state = kept(fields.select("batch", "pos", "id", "value").join(batch_kind, "batch", "left").join(first, "id", "left"))
    lacking = state.filter("translation is null and kind IN ('accepted', 'short')")
    few = lacking.groupBy("batch").agg(F.count(F.lit(1)).alias("_m")).filter(F.col("_m") <= most_missing).select("batch")
    again = taken(asked(requests(lacking.join(few, "batch").select("batch", "pos", "id", "value")), ask).filter("raw is not null"))
    met = state.join(again.withColumnRenamed("translation", "_again"), "id", "left")
    outcome = F.when(F.col("translation").isNotNull(), "translated").when(F.col("_again").isNotNull(), "retried").when(F.col("kind").isin("refusal", "empty"), F.col("kind")).otherwise("missing")
    return met.select("id", F.coalesce("translation", "_again").alias("translation"), outcome.alias("outcome"))


# --- verdicts in passes -------------------------------------------------------------------------------------------------------

VERDICTS = "array<struct<i:int,ok:boolean,reason:string,confidence:string,en:string>>"
#: Pairs of a first request, of a second with context, findings up to which texts are translated back, and the share of words by which one that comes back rescues a finding.
FIRST_SIZE, AGAIN_SIZE, MOST_BACK, ENOUGH = 50, 15, 30, 0.3


def _batched(rows: DataFrame, size: int) -> DataFrame:
    """Adds batch and k: rows by row in batches of a size, without one task for all: rows of a range of numbers are one sequence, so the last batch of a range may be smaller."""
    span = F.floor(F.col("row") / F.lit(size * 64))
    place = F.row_number().over(Window.partitionBy(span).orderBy("row")) - 1
    return rows.withColumn("batch", F.concat_ws(".", span.cast("string"), F.floor(place / size).cast("string"))).withColumn("k", (place % size).cast("int"))


def _verdicts(rows: DataFrame, ask: Ask, size: int, line: Column) -> DataFrame:
    """rows with batch and k, and what the answer says of each: a left join with (ok, reason, confidence, en) by its number; several of one number: the last."""
    numbered = kept(_batched(rows, size))
    listed = F.array_sort(F.collect_list(F.struct("k", line.alias("line"))))
    lines = F.transform(listed, lambda x: F.concat_ws("\t", x["k"].cast("string"), x["line"]))
    told = asked(numbered.groupBy("batch").agg(F.array_join(lines, "\n").alias("request")), ask)
    body = F.regexp_extract("raw", r"(?s)(\[.*\])", 1)
    said = told.select("batch", F.posexplode(F.from_json(body, VERDICTS)).alias("_at", "_v")).groupBy("batch", F.col("_v.i").alias("k")).agg(F.max_by("_v", "_at").alias("_v"))
    return numbered.join(said, ["batch", "k"], "left").select(*rows.columns, F.col("_v").isNotNull().alias("said"), *[F.col(f"_v.{c}").alias(f"v_{c}") for c in ("ok", "reason", "confidence", "en")])


def word_overlap(a: Column, b: Column) -> Column:
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), r"(?U)\s+"), lambda w: w != ""))
    x, y = words(a), words(b)
    return F.when((F.size(x) > 0) & (F.size(y) > 0), F.size(F.array_intersect(x, y)) / F.greatest(F.size(x), F.size(y)))


def validated(pairs: DataFrame, judge: Ask, recheck: Ask | None = None, back: Ask | None = None, first_size: int = FIRST_SIZE, again_size: int = AGAIN_SIZE, most_back: int = MOST_BACK, enough: float = ENOUGH) -> DataFrame:
    """pairs: (row, source, target), both visible texts. (row, reason, confidence): the pairs that are wrong.

    First all pairs are judged; those said to be not ok are flagged, with the confidence that is given (medium without one). Flagged ones of medium or low confidence are judged again (see `recheck`; None leaves
    them): said to be ok they go, all others, also those of which nothing is said, are confirmed, with the new reason if there is one. If that leaves most_back at most, they are translated back, and those whose words overlap
    with the source's by more than `enough` go. Each pass takes what the one before has left and is written. Pairs with a blank or equal side, a source under 3 or a target under 2 characters are not judged. Requests
    hold a line for each pair (number, tab, texts joined by ||| with tabs and line ends as blanks); answers are JSON lists of {i, ok, reason, confidence} and, for back, {i, en}."""
    flat = lambda c: F.regexp_replace(c, r"[\t\r\n]", " ")
    line = F.concat_ws(" ||| ", flat(F.col("source")), flat(F.col("target")))
    fit = (F.length("source") >= 3) & (F.length("target") >= 2) & (F.col("source") != F.col("target"))
    told = _verdicts(pairs.select("row", "source", "target").filter(fit), judge, first_size, line)
    flagged = told.filter(F.col("said") & (F.col("v_ok") == False)).select("row", "source", "target", F.coalesce("v_reason", F.lit("")).alias("reason"), F.coalesce("v_confidence", F.lit("medium")).alias("confidence"))  # noqa: E712
    flagged = kept(flagged)
    if recheck is None:
        return flagged.select("row", "reason", "confidence")
    sure = flagged.filter("confidence NOT IN ('medium', 'low')")
    unsure = flagged.filter("confidence IN ('medium', 'low')")
    context = F.concat_ws(" ||| ", line, flat(F.col("reason")))
    again = _verdicts(unsure, recheck, again_size, context)
    confirmed = kept(again.filter(~(F.col("said") & F.coalesce("v_ok", F.lit(False)))).select("row", "source", "target", F.coalesce(F.nullif("v_reason", F.lit("")), "reason").alias("reason"), F.lit("confirmed").alias("confidence")))
    n = confirmed.count()
    if back is not None and 0 < n <= most_back:
        came = _verdicts(confirmed, back, most_back, flat(F.col("target")))
        confirmed = came.filter(F.coalesce(word_overlap(F.substring("source", 1, 300), F.col("v_en")), F.lit(0.0)) <= enough)
    return sure.select("row", "reason", "confidence").unionByName(confirmed.select("row", "reason", "confidence"))
