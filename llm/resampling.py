"""Importance resampling towards a target: documents drawn by n-gram likelihood ratio and keyed noise.

Every feature, a run of 1 to ``order`` words, falls into one of ``buckets`` by its crc32. Buckets are
counted over all documents and all target texts; the two tables have a fixed number of places, and
so has the array of gains that scores a document: its weight is the floored mean of its features'
gains. Noise drawn from the id (Gumbel) is added, so that the highest scores are a sample without
replacement, in proportion to the weights.

Ranks come from a radix sort over Spark, least digit first. The sort key is (score from the highest
down, id from the smallest up), cut into digits; a digit in which all rows agree needs no pass. A pass
is a counting sort that is stable: rows lie in blocks of neighbouring places, each block counts its
digits, sums over smaller digits and over earlier blocks give every (digit, block) its first
place, and a row goes there plus its number among the block's rows of that digit. After the last
pass the place is the rank. A block has ``BLOCK_ROWS`` rows however they are distributed, so
no score, id or copy that many rows share gathers more rows than that, and each pass ends in a written
table of narrow rows, from which a lost task starts anew.

Defined results: a null text has no features and weight 0; a null id draws its noise as empty text and
comes after all others of its score; of rows alike, which one comes first is open; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.common import in_tasks, stored, table
from llm.sharding import CRC_TABLE, crc_sql

BUCKETS, ORDER, SEED = 10_000, 1, 2024
LEAST_WORDS, PERCENT = 20, 10
#: Bits of a digit, and rows of a block after the first pass (before it, a block is a part of the table).
DIGIT_BITS, BLOCK_ROWS = 11, 1 << 14
WITHIN = 33
SCORED = "doc_id long, n_words long, n_features long, weight long, score long"
#: A-Z to lower case; every other byte below 128 but 0-9 and a-z to a blank.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_PLAIN).split() if text else []


def features(words: list[bytes], order: int, buckets: int) -> np.ndarray:
    """Bucket of every run of 1 to ``order`` words."""
    found = [np.fromiter(map(crc32, words), np.int64, len(words))]
    for n in range(2, order + 1):
        runs = [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
        found.append(np.fromiter(map(crc32, runs), np.int64, len(runs)))
    return np.concatenate(found) % buckets


def bucket_batches(batches: Iterator, order: int, buckets: int) -> Iterator:
    """How many features of a part of the rows fall into each bucket."""
    counts = np.zeros(buckets, np.int64)
    for batch in batches:
        for text in batch["text"]:
            counts += np.bincount(features(words_of(text.as_py()), order, buckets), minlength=buckets)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["bucket", "n"])


def bucket_counts(texts: DataFrame, order: int = ORDER, buckets: int = BUCKETS) -> list[int]:
    """Features in each bucket, over all rows; the driver sees ``buckets`` numbers."""
    task = in_tasks("llm.resampling", "bucket_batches", order, buckets)
    rows = texts.select("text").mapInArrow(task, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = [0] * buckets
    for row in rows.collect():
        counts[row["bucket"]] = row["n"]
    return counts


def bucket_gains(target: list[int], corpus: list[int]) -> list[int]:
    """``floor(1000 * ln)`` of how much likelier a bucket is in the target; one is added to every count."""
    buckets = len(corpus)
    all_target, all_corpus = float(sum(target) + buckets), float(sum(corpus) + buckets)
    return [math.floor(1000 * math.log((t + 1.0) * all_corpus / ((s + 1.0) * all_target))) for t, s in zip(target, corpus)]


def noise(doc_id: int | None, seed: int = SEED) -> int:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))


def score_batches(batches: Iterator, gains: list[int], order: int, seed: int) -> Iterator:
    worth = np.array(gains, np.int64)
    names = [c.split()[0] for c in SCORED.split(", ")]
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
            words = words_of(text.as_py())
            found = features(words, order, len(worth))
            weight = int(worth[found].sum()) // len(found) if len(found) else 0
            rows.append((doc_id, len(words), len(found), weight, weight + noise(doc_id, seed)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)


def scored(docs: DataFrame, gains: list[int], order: int = ORDER, seed: int = SEED) -> DataFrame:
    """``SCORED`` of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(in_tasks("llm.resampling", "score_batches", gains, order, seed), SCORED)


def _key(rows: DataFrame) -> list[tuple[Column, int]]:
    """The sort key as numbers from 0 up, the least significant first, with the bits in which rows differ.

    Of an id of 64 bits the lower and the upper half are numbers of their own.
    """
    low, high = F.col("doc_id").bitwiseAND(0xFFFFFFFF), F.shiftright("doc_id", 32)
    bounds = rows.agg(F.min(high).alias("high"), F.max("score").alias("score")).first()
    if bounds["score"] is None:
        return []
    none = F.col("doc_id").isNull().cast("long")
    parts = [F.coalesce(low, F.lit(0)), F.coalesce(high - F.lit(bounds["high"] or 0), F.lit(0)), none, F.lit(bounds["score"]) - F.col("score")]
    differ = rows.agg(*[F.bit_or(p).bitwiseXOR(F.bit_and(p)).alias(f"part{i}") for i, p in enumerate(parts)]).first()
    return list(zip(parts, differ))


def _digits(rows: DataFrame) -> list[Column]:
    """Digits to sort by, the least significant first; those that all rows share are left out."""
    mask = (1 << DIGIT_BITS) - 1
    return [
        F.shiftright(part, shift).bitwiseAND(mask)
        for part, differ in _key(rows)
        for shift in range(0, differ.bit_length(), DIGIT_BITS)
        if differ >> shift & mask
    ]


def counting_pass(rows: DataFrame, digit: Column, block: Column) -> DataFrame:
    """``rows`` with their ``place`` after a stable sort by ``digit``; ``rows`` is read twice."""
    columns = rows.columns
    marked = rows.withColumns({"_digit": digit, "_block": block})
    counts = marked.groupBy("_digit", "_block").agg(F.count("*").alias("n"))
    before = (Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    # one row a digit: at most 2 to the DIGIT_BITS
    digits = counts.groupBy("_digit").agg(F.sum("n").alias("n"))
    digits = digits.select("_digit", F.coalesce(F.sum("n").over(Window.orderBy("_digit").rowsBetween(*before)), none).alias("smaller"))
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy("_digit").orderBy("_block").rowsBetween(*before)), none)
    first = counts.select("_digit", "_block", earlier.alias("earlier")).join(digits, "_digit")
    first = first.select("_digit", "_block", (F.col("earlier") + F.col("smaller")).alias("first"))
    among = F.row_number().over(Window.partitionBy("_digit", "_block").orderBy("place")) - 1
    ranked = marked.withColumn("_among", among).join(first, ["_digit", "_block"])
    return ranked.withColumn("place", F.col("first") + F.col("_among")).select(*columns)


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``rank`` from 1 on, by score from the highest down, then id from the smallest up."""
    rows = stored(rows.withColumn("place", F.monotonically_increasing_id()), "scored")
    block = F.shiftright("place", WITHIN)
    for digit in _digits(rows) or [F.lit(0).cast("long")]:
        rows = stored(counting_pass(rows, digit, block), "radix")
        block = F.floor(F.col("place") / BLOCK_ROWS)
    return rows.withColumn("rank", F.col("place") + 1).drop("place")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    order: int = ORDER,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """``SCORED`` of every row, and ``rank`` of the drawn ones: ``percent`` of those with ``least_words`` words."""
    gains = bucket_gains(bucket_counts(target, order, buckets), bucket_counts(docs, order, buckets))
    rows = stored(scored(docs, gains, order, seed), "scored")
    able = F.col("n_words") >= least_words
    drawn = percent * rows.where(able).count() // 100
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    others = rows.where(~able).withColumn("rank", F.lit(None).cast("long"))
    return ranked(rows.where(able)).withColumn("rank", rank).unionByName(others)


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
SQL = f"""
WITH {CRC_TABLE}, docs AS MATERIALIZED (
  SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents
), runs AS (
  SELECT r, unnest(w) AS word FROM docs
), targets AS (
  SELECT unnest({_WORDS}) AS word FROM benchmark
), hashed AS (
  SELECT word, {crc_sql("word")} % 10000 AS bucket
  FROM (SELECT word FROM runs UNION SELECT word FROM targets), tab
), s AS (
  SELECT bucket, count(*) AS n FROM runs JOIN hashed USING (word) GROUP BY bucket
), t AS (
  SELECT bucket, count(*) AS n FROM targets JOIN hashed USING (word) GROUP BY bucket
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT sum(n) FROM s) + 10000)::DOUBLE
         / ((coalesce(s.n, 0) + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM t), 0) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM s FULL JOIN t USING (bucket)
), weights AS (
  SELECT r, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM runs JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY r
), noisy AS (
  SELECT doc_id, r, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM docs LEFT JOIN weights USING (r)
), placed AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank, count(*) OVER () AS n FROM noisy WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
FROM noisy LEFT JOIN placed USING (r)
"""
