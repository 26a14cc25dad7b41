"""The corpus pipeline: language ID, exact dedup, near-dedup, mixing of sources, packing."""

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import exact_dedup, language_id, mixing, packing, simhash
from tallyloom.llm.queries import tokenizer_path
from tallyloom.llm.shared import discard, durable, table, written

#: Signs of a language's prototype, and the share of texts in none of the languages that may pass for one of them by chance: at or below that cosine a document goes.
DIMENSIONS, BY_CHANCE = 2048, 0.001


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or no nearer to any language that is labelled than chance would bring one of BY_CHANCE of other texts (a cosine of 0.077 for
    four languages), go: null, empty and blank texts among them. Texts of any length are judged whole, rows that
    repeat stay or go alike, and columns pass through, whatever they are called. If no document has both text and language, nothing can be
    told: a warning is given and all documents stay. An empty table stays empty."""
    profiles = language_id.fit(docs, dimensions=DIMENSIONS)
    if not profiles.languages:
        warnings.warn("language ID: no labelled text, all documents stay", stacklevel=2)
        return docs
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    told = language_id.predict(whole, profiles, text_col="_doc.text", keep=["_doc"])
    return told.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("cosine") > language_id.chance_cosine(profiles, BY_CHANCE))).select("_doc.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, null being empty, the document with the largest id stays, one row of it if it repeats; a null id only if there is no other. Texts of any length are
    hashed whole, other columns pass through, whatever they are called, and an empty table stays empty."""
    return exact_dedup.survivors(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose five-word shingles have a similarity of 0.8 or more, directly or by others between them, the one with the smallest id stays, a null id
    only if there is no other; of rows that repeat that id with other texts, the one whose text has the smallest hash. Candidates come from fingerprints (see simhash.near_duplicates); blank texts are
    alike. Texts of any length are looked at whole, other columns pass through, whatever they are called, and an empty table stays empty."""
    return simhash.survivors(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes their words, none more than twice; documents without words once. A null source is one of its own. Rows that repeat id and
    text are taken alike. Texts of any length are counted whole, other columns pass through, whatever they are called, and an empty table stays empty."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens, with their ids; null texts are empty, copies are packed each. A text longer than a sequence is cut into
    pieces, none is left out; extra columns are ignored, and an empty table gives no pieces."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("language ID", keep_known_language),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("packing", pack),
]

#: Language prototypes, fingerprints and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of documents, each written as Parquet in the shared folder and read again. Only what the result still reads is left there."""
    docs, before = table(spark, sf_dir, "documents"), []
    for _, stage in STAGES[:-1]:
        mark = len(written())
        docs = durable(stage(spark, docs, sf_dir))
        made = written(mark)
        discard(spark, before + made[:-1])  # what the stage read, and its own intermediate tables
        before = made[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
