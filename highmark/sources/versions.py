"""Tables in versions that share what did not change.

A store holds tables cut into parts (years of the observation table, station buckets of the ladder). Each
run writes only the parts it changes, into folders of its own, ``<table>/run=<version>/...``, then a
manifest with one row per part of the version, and at last turns the pointer ``current`` by a rename.
Readers go by the manifest of the pointer, so they see either all of a version or nothing of it; what
a run that failed left behind is in no manifest.

Manifests are small: a part is a calendar year, or one of a fixed number of buckets with at most
``MOST_PIECES`` pieces. They are read by the driver, which plans with them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from highmark.sources.files import read_small, replace_small

POINTER = "current"
#: Pieces that a part may grow to before it is written as one again.
MOST_PIECES = 16
MANIFEST = "table string, part int, path string, oldest_provisional date, settled date"


@dataclass(frozen=True)
class Piece:
    """A folder that belongs to a version. ``path`` is relative to the store."""

    table: str
    part: int
    path: str
    oldest_provisional: date | None = None
    settled: date | None = None


class Conflict(RuntimeError):
    """Another run has published a version meanwhile."""


def new_version() -> str:
    return uuid.uuid4().hex


def current(base: str) -> str | None:
    """The published version, if there is one."""
    return read_small(base, POINTER)


def manifest(spark: SparkSession, base: str, version: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{base}/manifests/run={version}")


def pieces(spark: SparkSession, base: str, version: str | None) -> list[Piece]:
    if version is None:
        return []
    names = [f.split()[0] for f in MANIFEST.split(", ")]
    return [Piece(*(row[n] for n in names)) for row in manifest(spark, base, version).select(names).collect()]


def publish(spark: SparkSession, base: str, version: str, held: Iterable[Piece], after: str | None) -> None:
    """Make ``version`` the current one, unless ``after`` is no longer what it follows."""
    rows = [(p.table, p.part, p.path, p.oldest_provisional, p.settled) for p in held]
    listed = spark.createDataFrame(rows, MANIFEST).coalesce(1)
    listed.write.mode("errorifexists").parquet(f"{base}/manifests/run={version}")
    if current(base) != after:
        raise Conflict(f"{base} has moved on from {after}")
    replace_small(base, POINTER, version)


def read_pieces(
    spark: SparkSession, base: str, table: str, held: Iterable[Piece], schema: T.StructType | str, parts: Iterable[int] | None = None
) -> DataFrame:
    """Rows of a table's pieces, of some parts only if these are named: no other folder is opened."""
    wanted = None if parts is None else set(parts)
    paths = [f"{base}/{p.path}" for p in held if p.table == table and (wanted is None or p.part in wanted)]
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.option("basePath", f"{base}/{table}").schema(schema).parquet(*paths).select(schema.names)
