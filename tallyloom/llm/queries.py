"""One query per operator, with production parameters, over its whole table; SQL where SQL can say it."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import divergence, exact_dedup, language_id, line_dedup, lm_scoring, mixing, nearest, packing, resampling, sharding, simhash, suffix_dedup, toxicity
from tallyloom.llm.shared import table


def held_out(modulus: int, remainder: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(modulus)) == remainder


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = language_id.fit(docs.filter(~held_out(3, 1)))
    return language_id.predict(docs, profiles).select("doc_id", held_out(3, 1).alias("held_out"), "lang_pred", "score", "cosine")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(~held_out(5, 0)))
    return toxicity.score(docs, lexicon).select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted", "weight")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return verdicts.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, words=1, max_diff=3)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target is what is labelled as of good quality, a fifth of it held out."""
    docs = table(spark, sf_dir, "documents")
    good = table(spark, sf_dir, "labels").filter((F.col("quality") == 1) & ~held_out(5, 0)).select("doc_id")
    return lm_scoring.score(docs, lm_scoring.fit(docs, good)).withColumn("held_out", held_out(5, 0))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_toxicity": op2_toxicity,
    "op3_line_dedup": op3_line_dedup,
    "op4_packing": op4_packing,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_mixing": op7_mixing,
    "op8_simhash": op8_simhash,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_nearest": op10_nearest,
    "op11_sharding": op11_sharding,
    "op12_resampling": op12_resampling,
    "op13_divergence": op13_divergence,
}

ORACLES = {
    "op3_line_dedup": r"""
WITH base AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT rid, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM base),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
common AS (SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT rid) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines,
       count(*) FILTER (WHERE k IN (SELECT k FROM common))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE k NOT IN (SELECT k FROM common)), '')) AS kept_sha256
FROM keyed GROUP BY rid
""",
    "op6_exact_dedup": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
""",
    # CRC-32 is worked out bit by bit for each distinct word.
    "op12_resampling": r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
marks AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM benchmark),
features AS (SELECT rid, unnest(words) AS word FROM docs),
kinds AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM features UNION SELECT word FROM marks)),
bytes AS (SELECT word, list_transform(range(length(h) // 2), lambda k: ('0x' || substr(h, 2 * k + 1, 2))::BIGINT) AS b FROM kinds),
hashed AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
           lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295) % 10000 AS bucket
  FROM bytes),
s AS (SELECT bucket, count(*) AS n FROM features JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM marks JOIN hashed USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE
           / ((s.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket)),
weights AS (SELECT rid, sum(gain)::BIGINT AS weight FROM features JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY rid),
scored AS (
  SELECT rid, doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM docs LEFT JOIN weights USING (rid)),
ranked AS (
  SELECT *, n_features >= 20 AS inside, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, rid) AS place FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN inside AND place <= (SELECT count(*) FROM scored WHERE n_features >= 20) * 10 // 100 THEN place END AS rank
FROM ranked
""",
    "op13_divergence": r"""
WITH base AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT rid, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM base),
counts AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL),
kept AS (SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT rid) >= 3),
groups AS (SELECT DISTINCT lang, source FROM base),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 1)) // (sum(n) OVER w + count(*) OVER w) AS p FROM dense WINDOW w AS (PARTITION BY lang, source)),
whole AS (SELECT lang, term, sum(n) AS n FROM dense GROUP BY ALL),
q AS (SELECT lang, term, 1 + (1000000000 * (n + 1)) // (sum(n) OVER w + count(*) OVER w) AS q FROM whole WINDOW w AS (PARTITION BY lang)),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, (p - q) * (p - q) // q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
""",
}
