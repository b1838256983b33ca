"""Sharding by rendezvous hashing: every record goes to the shard that draws best for its key.

For each shard a record's key draws a number u between 0 and 1 (eight hex digits of a sha256 over key
and block of eight shards), and the shard with the least ``-ln(u) / weight`` takes the record. Draws
of one shard do not depend on the others, so a new shard takes from each only what draws best
for the new one, nothing moves between old shards, and a changed weight moves its difference only.

Rows are then dealt out by ranges of (shard, key, checksum, size) with the place in the input as the
last resort, so that a shard, a key or copies of one row that hold a third of all rows are spread over
as many tasks as their share asks for. Each task writes its stretch into the folders of its shards. A
row's slot is its place in the task's stretch plus what earlier stretches hold of the shard; that
sum needs one small row for each stretch, counted from the written files, and no second sort.

Defined results: a null text has 0 bytes and the checksum of empty text; a null key draws as empty
text and comes first in its shard; rows alike get neighbouring slots; all columns of a row travel in
one struct, so none can clash; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from highmark.session import work_folder
from llm.common import table

LAW, SHARDS = "key", 24
#: Shards whose draws come from one digest, and hex digits of each.
IN_DIGEST, DIGITS = 8, 8
#: What a record takes besides its text, in bytes.
FRAME = 8
#: Up to so many stretches (about 30 MB of rows) their table is broadcast; beyond, it is joined.
STRETCHES = 500_000
WITHIN = 33


def _costs(digests: Sequence[Column], weights: Sequence[float]) -> list[Column]:
    """``-ln(u) / weight`` with its shard, for every shard."""
    costs = []
    for shard, weight in enumerate(weights):
        digits = F.substring(digests[shard // IN_DIGEST], 1 + DIGITS * (shard % IN_DIGEST), DIGITS)
        u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 4 * DIGITS)
        costs.append(F.struct((-F.log(u) / float(weight)).alias("cost"), F.lit(shard).alias("shard")))
    return costs


def assigned(docs: DataFrame, weights: Sequence[float], key: str = "doc_id", text: str = "text", grown: float = 1.0) -> DataFrame:
    """``row`` (all columns), ``key``, size, crc, the shard, and the shard if one of weight ``grown`` is added."""
    if not weights or min(*weights, grown) <= 0:
        raise ValueError("weights must be positive")
    weights = [*weights, grown]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(key).alias("key"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + FRAME).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("crc"),
    )
    named = F.coalesce(F.col("key").cast("string"), F.lit(""))
    blocks = range(-(-len(weights) // IN_DIGEST))
    rows = rows.withColumns({f"digest{b}": F.sha2(F.concat(named, F.lit(f":{b}")).cast("binary"), 256) for b in blocks})
    costs = _costs([F.col(f"digest{b}") for b in blocks], weights)
    rows = rows.select("row", "key", "size", "crc", F.array_min(F.array(*costs[:-1])).alias("best"), costs[-1].alias("new"))
    return rows.select(
        "row", "key", "size", "crc", F.col("best.shard").alias("shard"), F.least("best", "new")["shard"].alias("grown_shard")
    )


def write_shards(docs: DataFrame, path: str, weights: Sequence[float], key: str = "doc_id", text: str = "text", grown: float = 1.0) -> None:
    """``path/rows/shard=k`` holds the rows of shard k, ``path/stretches`` where each task's stretch of a shard begins."""
    spark = docs.sparkSession
    order = ("shard", F.col("key").asc_nulls_first(), "crc", "size", "at")
    rows = assigned(docs, weights, key, text, grown).withColumn("at", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.select("row", "size", "grown_shard", F.monotonically_increasing_id().alias("place"), "shard")
    rows.write.partitionBy("shard").option("compression", "zstd").parquet(f"{path}/rows")
    _written(spark, path, docs.schema).groupBy("shard", F.shiftright("place", WITHIN).alias("task")).agg(
        F.min("place").alias("first"), F.count("*").alias("n")
    ).write.parquet(f"{path}/stretches")


def _written(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    fields = [T.StructField("row", schema), T.StructField("size", T.LongType()), T.StructField("grown_shard", T.IntegerType())]
    fields += [T.StructField("place", T.LongType()), T.StructField("shard", T.IntegerType())]
    return spark.read.schema(T.StructType(fields)).parquet(f"{path}/rows")


def read_shards(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``row, size, grown_shard, shard, slot`` of the written rows; ``schema`` is that of the sharded table."""
    stretches = spark.read.schema("shard int, task long, first long, n long").parquet(f"{path}/stretches")
    earlier = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = stretches.select(
        "shard", "task", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift")
    )
    if stretches.count() <= STRETCHES:
        starts = F.broadcast(starts)
    rows = _written(spark, path, schema).withColumn("task", F.shiftright("place", WITHIN))
    return rows.join(starts, ["shard", "task"]).select("row", "size", "grown_shard", "shard", (F.col("place") + F.col("shift")).alias("slot"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), work_folder(spark, "shards")
    write_shards(docs, path, [1.0] * SHARDS)
    rows = read_shards(spark, path, docs.schema)
    return rows.select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        F.crc32(F.coalesce(F.col("row.text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )


#: crc32 of a list of bytes, by the table of the reflected polynomial.
CRC_TABLE = """tab AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, n)) AS tab
)"""


def crc_sql(text: str) -> str:
    """crc32 of the UTF-8 bytes of ``text``, beside ``CRC_TABLE``."""
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: CAST('0x' || x AS BIGINT))"
    return f"xor(list_reduce({octets}, lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]), 4294967295), 4294967295)"


SQL = f"""
WITH {CRC_TABLE}, keyed AS MATERIALIZED (
  SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 8 AS BIGINT) AS size, {crc_sql("coalesce(text, '')")} AS text_crc32,
         coalesce(CAST(doc_id AS VARCHAR), '') AS k, row_number() OVER () AS r
  FROM documents, tab
), draws AS (
  SELECT r, s, -ln((CAST('0x' || substr(sha256(k || ':' || (s // 8)), 1 + 8 * (s % 8), 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296) AS cost
  FROM keyed, (SELECT unnest(range(25)) AS s)
), told AS (
  SELECT r, arg_min(s, cost) FILTER (s < 24) AS shard, arg_min(s, cost) AS grown FROM draws GROUP BY r
)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
       CAST(grown AS INTEGER) AS grown_shard
FROM keyed JOIN told USING (r)
"""
