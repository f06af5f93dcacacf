"""One query for each operator of the package, on whole tables, and SQL where it can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunloom.llm import (
    decontam,
    langid,
    packing,
    pii,
    quality,
    repeats,
    secret_scan,
    sharding,
    simhash,
    spelling,
    tokencount,
    toxicity,
    vector_codes,
)
from sunloom.llm.common import id_fold


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontam.is_contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"),
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_quality(_table(spark, sf_dir, "documents"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *counts, "base_failed", "kept")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokencount.count_tokens(_table(spark, sf_dir, "documents"))
    return counted.select("*", (F.col("n_tokens") > tokencount.LIMIT).alias("over_limit"))


def _spans_text(column: str) -> Column:
    parts = F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")


def _kind_counts(kinds: tuple[str, ...]) -> list[Column]:
    def of(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return [of(kind) for kind in kinds]


def _span_digest(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    return found.select(
        "doc_id",
        *_kind_counts(kinds),
        F.sha2(_spans_text("base"), 256).alias("base_sha256"),
        _spans_text("spans").alias("spans"),
    )


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return _span_digest(pii.personal_data(documents, pii.train(documents)), pii.KINDS)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    found = langid.identify(documents, langid.dictionaries(documents))
    held_out = (id_fold("doc_id", langid.FOLDS) == langid.HELD_OUT).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score", "accepted")


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    scored = toxicity.score(documents, toxicity.train(documents, _table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        (id_fold("doc_id", toxicity.FOLDS) == toxicity.HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.array_join(
            F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ","
        ).alias("spans"),
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return _span_digest(secret_scan.secrets(documents, secret_scan.train(documents)), secret_scan.KINDS)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(_table(spark, sf_dir, "embeddings"))
    return coded.select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(vector_codes.digest(books)).alias("codebooks_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_contamination,
        op2_quality,
        op3_token_counts,
        op4_personal_data,
        op5_language,
        op6_shards,
        op7_toxicity,
        op8_secrets,
        op9_packing,
        op10_near_duplicates,
        op11_repeats,
        op12_spelling,
        op13_vector_codes,
    )
}


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

CONTAMINATION_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), {_ALNUM}) AS w FROM documents),
b AS (
  SELECT DISTINCT item_id::VARCHAR AS item_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM benchmark
  WHERE item_id IS NOT NULL AND text IS NOT NULL
),
bw AS (
  SELECT DISTINCT item_id, least(len(w), {decontam.WINDOW}) AS size,
         array_to_string(w[i:i + {decontam.WINDOW - 1}], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - {decontam.WINDOW - 1}) + 1)) AS i FROM b WHERE len(w) > 0)
),
dw AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win FROM (
    SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
    FROM d, (SELECT DISTINCT size FROM bw) WHERE len(w) >= size)
),
hits AS (SELECT doc_id, i, dw.size, item_id FROM dw JOIN bw USING (win)),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY 1
),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY 1
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


def _quality_sql(rounds: int = quality.ROUNDS) -> str:
    """The counts, and the estimate as a recursion over the vote patterns."""
    limits = quality.right_bounds(list(quality.RULES))
    rules = len(limits)
    each = range(1, rules + 1)
    log_odds = "ln(1 - share) - ln(share)" + "".join(
        f" - CASE v[{j}] WHEN 1 THEN ln(good[{j}]) - ln(1 - bad[{j}]) "
        f"WHEN -1 THEN ln(1 - good[{j}]) - ln(bad[{j}]) ELSE 0 END"
        for j in each
    )

    def bounded(value: str, bounds: tuple[float, float]) -> str:
        return f"least({bounds[1]}, greatest({bounds[0]}, {value}))"

    def right(weight: str, vote: int, j: int) -> str:
        return (
            f"(1 + sum(n * {weight} * (v[{j}] = {vote})::INT)) / (2 + sum(n * {weight} * (v[{j}] <> 0)::INT))"
        )

    good = ", ".join(bounded(right("g", 1, j), limits[j - 1][:2]) for j in each)
    bad = ", ".join(bounded(right("(1 - g)", -1, j), quality.BAD_RIGHT) for j in each)
    start_good = ", ".join(f"{first}::DOUBLE" for _, _, first in limits)
    start_bad = ", ".join([f"{quality.BAD_START}::DOUBLE"] * rules)
    word = r"'[^\x20\x09-\x0D]+'"
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {word}) AS w FROM documents
),
win AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2)
),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM win SEMI JOIN
      (SELECT doc_id, win FROM win GROUP BY 1, 2 HAVING count(*) > 1) USING (doc_id, win)) GROUP BY 1
),
c AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         len(regexp_extract_all(text, '\\p{{Lu}}')) AS n_upper, len(regexp_extract_all(text, '[!?]')) AS n_shouts,
         len(regexp_extract_all(text, ',')) AS n_commas, len(regexp_extract_all(text, '[0-9]')) AS n_digits,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, {word})) AS lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words, greatest(len(w), 1) AS m
  FROM d LEFT JOIN rep USING (doc_id)
),
k AS (
  SELECT *, len(lines) AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         word_chars / m AS mean FROM c
),
votes AS (
  SELECT *, [
    CASE WHEN n_words < 20 THEN -1 WHEN n_words >= 50 THEN 1 ELSE 0 END,
    CASE WHEN mean < 2 OR mean > 15 THEN -1 WHEN mean BETWEEN 3 AND 10 THEN 1 ELSE 0 END,
    CASE WHEN n_symbols > 0.15 * m THEN -1 WHEN n_symbols <= 0.03 * m THEN 1 ELSE 0 END,
    CASE WHEN n_shouts > 0.2 * m THEN -1 WHEN n_shouts <= 0.05 * m THEN 1 ELSE 0 END,
    CASE WHEN n_upper > 0.5 * word_chars THEN -1 WHEN n_upper <= 0.15 * word_chars THEN 1 ELSE 0 END,
    CASE WHEN n_repeat_words > 0.3 * m THEN -1 WHEN n_repeat_words <= 0.1 * m THEN 1 ELSE 0 END,
    CASE WHEN n_dup_lines > 0.5 * n_lines THEN -1 WHEN n_dup_lines <= 0.1 * n_lines THEN 1 ELSE 0 END,
    CASE WHEN n_commas < 0.035 * m OR n_commas > 0.085 * m THEN -1
      WHEN n_commas >= 0.04 * m AND n_commas <= 0.08 * m THEN 1 ELSE 0 END,
    CASE WHEN n_digits > 0.1 * m THEN -1 WHEN n_digits <= 0.02 * m THEN 1 ELSE 0 END] AS v,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM k
),
patterns AS (SELECT v, count(*)::DOUBLE AS n FROM votes GROUP BY 1),
em AS (
  SELECT 0 AS i, 0.9::DOUBLE AS share, [{start_good}] AS good, [{start_bad}] AS bad
  UNION ALL
  SELECT any_value(i) + 1, {bounded("sum(n * g) / sum(n)", quality.SHARE_GOOD)}, [{good}], [{bad}]
  FROM (SELECT em.*, v, n, 1 / (1 + exp({log_odds})) AS g FROM em, patterns WHERE i < {rounds})
  GROUP BY i
),
judged AS (SELECT v, 1 / (1 + exp({log_odds})) AS posterior FROM patterns, em WHERE i = {rounds})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND posterior >= 0.5 AS kept
FROM votes JOIN judged USING (v)
"""


SHARDS_SQL = f"""
WITH d AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS n_bytes, array_to_string(list_transform(
           string_split(md5(doc_id::VARCHAR)[1:{sharding.HASH_BITS // 4}], ''),
           lambda c: lpad(bin(instr('0123456789abcdef', c) - 1), 4, '0')), '') AS bits
  FROM documents
),
p AS (SELECT doc_id, n_bytes, bits[1:k] AS shard, k FROM (SELECT *, unnest(range(0, {sharding.HASH_BITS + 1})) AS k FROM d)),
s AS (SELECT shard, sum(n_bytes)::BIGINT AS shard_bytes, count(*)::BIGINT AS shard_docs FROM p GROUP BY 1)
SELECT doc_id, n_bytes, shard, shard_bytes, shard_docs
FROM p JOIN s USING (shard) WHERE shard_bytes <= {sharding.LIMIT_BYTES} OR shard_docs = 1
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY k) = 1
"""

REPEATS_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + {repeats.WINDOW - 1}], ' ') AS win FROM (
    SELECT doc_id, w, unnest(range(1, len(w) - {repeats.WINDOW - 2})) AS i FROM d WHERE len(w) >= {repeats.WINDOW})
),
least AS (SELECT win, min(doc_id) AS least FROM win GROUP BY 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + {repeats.WINDOW})) AS p FROM win JOIN least USING (win) WHERE least < doc_id
),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY 1
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def _codes_sql(rounds: int = vector_codes.ROUNDS) -> str:
    """Codebooks by plain search over all entries, a pair of tables for each round."""
    parts, entries = vector_codes.PARTS, vector_codes.ENTRIES

    def assigned(k: int) -> str:
        return f"""
a{k} AS MATERIALIZED (
  SELECT vec_id, label, part, v, arg_min(entry, distance * {entries} + entry) AS entry, min(distance) AS distance FROM (
    SELECT p.*, entry, list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance
    FROM p JOIN b{k} USING (part)) GROUP BY ALL
)"""

    def moved(k: int) -> str:
        return f"""
b{k + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(moved, c) AS c FROM b{k} LEFT JOIN (
    SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY j) AS moved FROM (
      SELECT part, entry, j, sum(x)::BIGINT AS s, count(*)::BIGINT AS n FROM (
        SELECT part, entry, unnest(v) AS x, unnest(range(len(v))) AS j FROM a{k}) GROUP BY 1, 2, 3) GROUP BY 1, 2
  ) USING (part, entry)
)"""

    steps = ",".join(step for k in range(rounds) for step in (assigned(k), moved(k)))
    return f"""
WITH e AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {vector_codes.SCALE})::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
p AS MATERIALIZED (
  SELECT vec_id, label, part, v[part * len(v) // {parts} + 1:(part + 1) * len(v) // {parts}] AS v
  FROM e, (SELECT unnest(range({parts})) AS part)
),
b0 AS MATERIALIZED (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v AS c
  FROM p QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id) <= {entries}
),{steps},{assigned(rounds)},
coded AS (
  SELECT vec_id, label, string_agg(lpad(lower(hex(entry)), 2, '0'), '' ORDER BY part) AS code, sum(distance)::BIGINT AS error
  FROM a{rounds} GROUP BY 1, 2
),
books AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, books
"""


ORACLES = {
    "op1_contamination": CONTAMINATION_SQL,
    "op2_quality": _quality_sql(),
    "op6_shards": SHARDS_SQL,
    "op11_repeats": REPEATS_SQL,
    "op13_vector_codes": _codes_sql(),
}
