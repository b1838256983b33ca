"""Helpers that the operators share: reading a table, calling code in tasks, text of batches."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from highmark.session import work_folder

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
WORD_BREAK = rb"[\x20\x09-\x0D]+"
#: ASCII letters to lower case, every other byte as it is.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_tasks(module: str, function: str, *args) -> Callable[[Iterator], Iterator]:
    """``module.function(batches, *args)`` for ``mapInArrow`` or ``mapInPandas``.

    Tasks import the module, so what it keeps (vocabularies, memos) lives as long as the worker.
    """
    root = ROOT

    def run(batches):
        import importlib
        import sys

        if root not in sys.path:
            sys.path.append(root)
        return getattr(importlib.import_module(module), function)(batches, *args)

    return run


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends there."""
    spark = df.sparkSession
    path = work_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def slices(batch, rows: int = 256) -> Iterator:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: A-Z lower-cased, split at ASCII white space."""
    return text.encode().translate(LOWER).split() if text else []
