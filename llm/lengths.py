"""Exact token lengths: a histogram, and suffix sums over it for every context limit.

A document's length is the number of its ids and the end id, as ``llm.packing`` cuts it. Tasks count
lengths, one aggregation by length adds the counts, and all else reads that histogram, whose rows
are the distinct lengths and not the documents. Suffix sums go by blocks of lengths: within each
block, then over the few blocks.

For a limit L, ``n_docs`` documents have just this length, ``n_longer`` documents with
``tokens_longer`` tokens in all are longer; cutting every document to L tokens leaves
``truncated_tokens``, which is what the documents up to L have and L for each longer one. The
quantile of p percent is the shortest length that at least p percent of the documents do not exceed:
it is the limit whose ``first_percent`` and ``last_percent`` (null where there is none) enclose p;
other quantiles follow from ``n_longer`` in the same way. Every limit from 1 to the greatest length
has a row.

Defined results: null text is empty text, which is the end id alone; a repeated row counts again; an
empty table has no limits; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from llm.common import in_tasks, slices, stored, table
from llm.packing import VOCABULARY, encoder

#: Lengths in one block of the suffix sums, and limits worked out from one row at a time.
BLOCK = 1024


def length_batches(batches: Iterator, path: str) -> Iterator:
    """How often each length occurs in a part of the rows."""
    encode, counts = encoder(path), Counter()
    for batch in batches:
        for part in slices(batch):
            counts.update(len(encode(text)) + 1 if text else 1 for text in part["text"].to_pylist())
    yield pa.RecordBatch.from_arrays([pa.array(list(counts.keys()), pa.int64()), pa.array(list(counts.values()), pa.int64())], ["length", "n"])


def length_histogram(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``length, n`` of all rows."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    counts = docs.select("text").mapInArrow(in_tasks("llm.lengths", "length_batches", path), "length long, n long")
    return counts.groupBy("length").agg(F.sum("n").alias("n"))


def context_limits(histogram: DataFrame) -> DataFrame:
    """The row of every limit. ``histogram`` is read twice: give a stored table."""
    rows = histogram.withColumn("block", F.floor(F.col("length") / BLOCK).cast("long")).withColumn("tokens", F.col("length") * F.col("n"))
    blocks = rows.groupBy("block").agg(F.sum("n").alias("n"), F.sum("tokens").alias("tokens"), F.max("length").alias("top"))
    order, none = Window.orderBy("block"), F.lit(0).cast("long")
    after, all_ = order.rowsBetween(1, Window.unboundedFollowing), Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = lambda c, w: F.coalesce(F.sum(c).over(w), none)
    blocks = blocks.select(
        "block",
        total("n", after).alias("n_after"),
        total("tokens", after).alias("tokens_after"),
        total("n", all_).alias("docs"),
        total("tokens", all_).alias("all_tokens"),
        F.coalesce(F.lag("top").over(order), none).alias("top_before"),
    )
    within = Window.partitionBy("block").orderBy("length")
    rest = within.rowsBetween(1, Window.unboundedFollowing)
    rows = rows.select("block", "length", "n", "tokens", total("n", rest).alias("n_rest"), total("tokens", rest).alias("tokens_rest"), F.lag("length").over(within).alias("shorter"))
    rows = rows.join(blocks, "block").select(
        "length",
        "n",
        "tokens",
        "docs",
        "all_tokens",
        F.coalesce("shorter", "top_before").alias("shorter"),
        (F.col("n_rest") + F.col("n_after")).alias("longer"),
        (F.col("tokens_rest") + F.col("tokens_after")).alias("tokens_longer"),
    )
    # limits between two lengths first in runs, so that no array is longer than a block
    rows = rows.withColumn("run", F.explode(F.sequence(F.col("shorter") + 1, F.col("length"), F.lit(BLOCK).cast("long"))))
    rows = rows.withColumn("limit", F.explode(F.sequence("run", F.least(F.col("run") + BLOCK - 1, F.col("length")))))
    here = F.col("limit") == F.col("length")
    longer = F.when(here, F.col("longer")).otherwise(F.col("longer") + F.col("n"))
    tokens_longer = F.when(here, F.col("tokens_longer")).otherwise(F.col("tokens_longer") + F.col("tokens"))
    # of whole numbers, so exact
    first = F.expr("(100 * (docs - longer - n)) div docs + 1")
    last = F.expr("(100 * (docs - longer)) div docs")
    told = here & (first <= last)
    return rows.select(
        F.col("limit").alias("context_limit"),
        F.when(here, F.col("n")).otherwise(none).alias("n_docs"),
        longer.alias("n_longer"),
        tokens_longer.alias("tokens_longer"),
        (F.col("all_tokens") - tokens_longer + F.col("limit") * longer).alias("truncated_tokens"),
        F.when(told, first).alias("first_percent"),
        F.when(told, last).alias("last_percent"),
    )


def op6_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_limits(stored(length_histogram(table(spark, sf_dir, "documents")), "lengths"))
