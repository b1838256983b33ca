"""Document fingerprints: threshold-scaled sketches, in SQL functions only.

A fingerprint keeps every hash of a document's 5-word shingles that lies below a fixed share of
the hash range. Because the share is the same for all documents, fingerprints merge by union, and
set overlaps, containment between very unequal documents included, are estimated by those of the
kept hashes. A text with words none of whose hashes lies below keeps its smallest one as a mark, so
that equal texts have equal fingerprints and likeness to another such text is a guess from one hash; a
merged sketch drops the mark again if others lie below. Containment does not read marks: what share of
such a text another one has cannot be told from the sketches, and is null. A smaller ``scale`` keeps
more hashes and leaves fewer texts with a mark only.

Words are split at ASCII white space after lower-casing; a text of fewer than five words is one
shingle. Defined results: null text is empty text; without words the fingerprint is empty; likeness
of two empty fingerprints is 1, of an empty and another one 0; an empty one is contained in any; repeated
ids follow each other in the order of their texts; null ids come first, in that order too; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from llm.common import stored, table

SHINGLE_WORDS = 5
#: One hash in so many is kept.
SCALE = 4
#: Ids in one block of the walk to the next document.
BLOCK = 64
#: Rows without an id are in blocks by as many bytes of their texts; these come before all blocks of ids.
FIRST_BYTES, NULL_BLOCKS = 7, -(1 << 58)
LONG_MIN = -(1 << 63)


def _bind(value: Column, f) -> Column:
    """``f(value)`` with ``value`` worked out once: the lambda of a one-element array names it."""
    return F.transform(F.array(value), f)[0]


def _limit(scale: int) -> int:
    """The greatest hash that is kept."""
    return LONG_MIN + (1 << 64) // scale - 1


def _below(hashes: Column, scale: int) -> Column:
    """Hashes below the fixed share, or else the smallest; sorted, each once."""
    low = F.filter(hashes, lambda x: x <= _limit(scale))
    return _bind(low, lambda x: F.when(F.size(x) > 0, F.sort_array(F.array_distinct(x))).otherwise(F.slice(F.array(F.array_min(hashes)), 1, F.least(F.size(hashes), F.lit(1)))))


def sketch(text: Column, scale: int = SCALE) -> Column:
    """Sorted array of the kept shingle hashes of a text."""
    words = F.array_remove(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), "")

    def hashes(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(w) - SHINGLE_WORDS, F.lit(0)))
        shingle = F.transform(starts, lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(SHINGLE_WORDS))))
        return F.when(F.size(w) > 0, shingle).otherwise(F.array().cast("array<bigint>"))

    return _bind(words, lambda w: _bind(hashes(w), lambda h: _below(h, scale)))


def merge(a: Column, b: Column, scale: int = SCALE) -> Column:
    """Sketch of two documents together."""
    return _bind(F.array_union(a, b), lambda both: _below(both, scale))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles in all shingles of both."""
    common = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(common / (F.size(a) + F.size(b) - common))


def containment(a: Column, b: Column, scale: int = SCALE) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has too; null if ``a`` has a mark only, and ``b`` another."""
    share = F.size(F.array_intersect(a, b)) / F.size(a)
    told = (a[0] <= _limit(scale)) | (a == b)
    return F.when(F.size(a) == 0, F.lit(1.0)).when(told, share)


def as_text(a: Column) -> Column:
    """A sketch as text: its hashes in order, 16 hex digits each."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def _block(doc_id: Column, text: Column) -> Column:
    """Numbers that rise with the id, and for null ids with the text. The last literal is never reached: it tells
    the planner that there is no null, so that joins add no filter below the exchange of texts that they share."""
    first = F.rpad(F.hex(F.substring(text.cast("binary"), 1, FIRST_BYTES)), 2 * FIRST_BYTES, "0")
    return F.coalesce(F.floor(doc_id / BLOCK).cast("long"), F.conv(first, 16, 10).cast("long") + NULL_BLOCKS, F.lit(NULL_BLOCKS))


def _next_block(blocks: DataFrame) -> DataFrame:
    """``block, next_block`` of distinct block numbers; after the last comes the first. Numbers are
    dealt out by ranges; of each range only the first one travels to the range before."""
    dealt = stored(blocks.repartitionByRange("block").select("block", F.spark_partition_id().alias("part")), "blocks")
    heads = dealt.groupBy("part").agg(F.min("block").alias("head"))
    first = heads.agg(F.min("head")).first()[0]  # one number; null without rows
    # one row for each range
    heads = heads.select("part", F.lead("head").over(Window.orderBy("part")).alias("after"))
    within = Window.partitionBy("part").orderBy("block")
    inner = dealt.select("part", "block", F.lead("block").over(within).alias("inner"))
    return inner.join(heads, "part").select("block", F.coalesce("inner", "after", F.lit(first)).alias("next_block"))


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last floor(n/2) characters replaced by the first as many of ``following``."""
    n = F.char_length(text)
    cut = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - cut), F.substring(following, F.lit(1), cut))


def edited_sketches(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, sketch, edited_sketch, next_sketch`` of every row.

    Rows meet the next one (ascending id; after the last comes the first) in blocks of ids, at most
    ``BLOCK`` ids each: texts are dealt out by block once, and all that follows reads that exchange.
    The last row of a block gets the first of the next one in a join of such rows only.
    """
    block = _block(F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))).alias("block")
    # a long stays as it is: another name for it would keep the branches from sharing the exchange
    doc_id = F.col("doc_id") if docs.schema["doc_id"].dataType == T.LongType() else F.col("doc_id").cast("long").alias("doc_id")
    rows = docs.select(block, doc_id, F.coalesce("text", F.lit("")).alias("text")).repartition("block")
    order = Window.partitionBy("block").orderBy(F.col("doc_id").asc_nulls_first(), "text")
    inner = rows.withColumn("sketch", sketch(F.col("text"), scale)).select(
        "doc_id", "text", "sketch", F.lead("text").over(order).alias("next_text"), F.lead("sketch").over(order).alias("next_sketch")
    )
    inner = inner.where("next_text IS NOT NULL")
    heads = rows.select("block", "text", F.row_number().over(order).alias("place")).where("place = 1")
    heads = heads.select(F.col("block").alias("next_block"), F.col("text").alias("next_text"))
    tails = rows.select("block", "doc_id", "text", F.lead("text").over(order).isNull().alias("last")).where("last")
    # apart, so that texts are read for null ids only
    blocks = docs.where("doc_id IS NOT NULL").select(F.floor(F.col("doc_id").cast("long") / BLOCK).cast("long").alias("block")).distinct()
    blocks = blocks.union(docs.where("doc_id IS NULL").select(block).distinct())
    tails = tails.join(_next_block(blocks), "block").join(heads, "next_block")
    tails = tails.select("doc_id", "text", sketch(F.col("text"), scale).alias("sketch"), "next_text", sketch(F.col("next_text"), scale).alias("next_sketch"))
    both = inner.unionByName(tails).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    return both.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        "sketch",
        sketch(F.col("edited"), scale).alias("edited_sketch"),
        "next_sketch",
    )


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = edited_sketches(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        containment(F.col("edited_sketch"), F.col("sketch")).alias("edited_in_text"),
    )
