"""Fill-in-middle: texts cut at two code points and put in the order prefix, suffix, middle.

Cuts are told in code points, texts lie in bytes. For each text the byte offsets at which a code
point begins, and the end of the text, form a set in the manner of Roaring bitmaps: offsets go by
their high bits into containers of 65,536, and each container takes the smallest of three forms,
which are a sorted array of low bits, a bitmap, and runs of neighbours (plain ASCII is one run). Next
to the containers stand their cumulative cardinalities. The byte offset of the k-th code point is
then ``select(k)``: a search of the cardinalities for the container, and a select inside it. No text
is decoded.

Where the two cuts fall and which form a document takes come from sha256 of seed and id, so a
document is always cut alike, and nothing but the row itself is needed.

Defined results: null text is empty text; an empty text, and one that holds a sentinel, stays plain;
a null id counts as empty text in the digest; repeated rows are cut alike; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import in_tasks, slices, table

SEED, PLAIN_FROM, SPM_BELOW = 1, 90, 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
CONTAINER = 1 << 16
FILLED = "doc_id long, n long, form string, prefix_chars long, middle_chars long, first_cut long, second_cut long, output string"
_ONES = np.array([bin(b).count("1") for b in range(256)], np.int64)


class Array:
    """Sorted low bits, two bytes each."""

    def __init__(self, mask: np.ndarray):
        self.low = np.flatnonzero(mask).astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class Bitmap:
    """One bit for each place of the container."""

    def __init__(self, mask: np.ndarray):
        self.bits = np.packbits(mask, bitorder="little")

    def select(self, k: int) -> int:
        through = np.cumsum(_ONES[self.bits])
        at = int(np.searchsorted(through, k, "right"))
        inside = np.flatnonzero(np.unpackbits(self.bits[at : at + 1], bitorder="little"))
        return 8 * at + int(inside[k - (int(through[at - 1]) if at else 0)])


class Runs:
    """Starts of runs, and how many members come before each."""

    def __init__(self, mask: np.ndarray, starts: np.ndarray):
        ends = np.flatnonzero(mask & np.append(~mask[1:], True)) + 1
        self.starts, self.before = starts, np.concatenate(([0], np.cumsum(ends - starts)))

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.starts[at]) + k - int(self.before[at])


def container(mask: np.ndarray, members: int) -> Array | Bitmap | Runs:
    """The smallest form: 4 bytes a run, 2 bytes a member, or a bit a place."""
    starts = np.flatnonzero(mask & np.append(True, ~mask[:-1]))
    sizes = {"runs": 4 * len(starts), "array": 2 * members, "bitmap": CONTAINER // 8}
    smallest = min(sizes, key=sizes.get)
    return Runs(mask, starts) if smallest == "runs" else Array(mask) if smallest == "array" else Bitmap(mask)


class Boundaries:
    """Byte offsets at which code points of ``text`` begin, and its end."""

    def __init__(self, text: bytes):
        mask = np.empty(len(text) + 1, bool)
        mask[:-1] = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
        mask[-1] = True
        self.containers, self.through, members = [], [], 0
        for start in range(0, len(mask), CONTAINER):
            part = mask[start : start + CONTAINER]
            inside = int(np.count_nonzero(part))
            members += inside
            self.containers.append(container(part, inside) if inside else None)
            self.through.append(members)
        self.members = members

    def select(self, k: int) -> int:
        """The ``k``-th offset, counted from 0."""
        at = int(np.searchsorted(self.through, k, "right"))
        return at * CONTAINER + self.containers[at].select(k - (self.through[at - 1] if at else 0))


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """The first four groups of eight hex digits."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12)]


def filled(doc_id: int | None, text: bytes, seed: int = SEED) -> tuple:
    """Code points, form, lengths of prefix and middle, both cuts in bytes, output."""
    h1, h2, h3, h4 = draws(doc_id, seed)
    bounds = Boundaries(text)
    n = bounds.members - 1
    if not text or h3 % 100 >= PLAIN_FROM or any(m in text for m in MARKS):
        return n, "plain", None, None, None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = bounds.select(first), bounds.select(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    p, s, m = MARKS
    if h4 % 100 < SPM_BELOW:
        return n, "spm", first, second - first, a, b, b"".join((s, suffix, p, prefix, m, middle))
    return n, "psm", first, second - first, a, b, b"".join((p, prefix, s, suffix, m, middle))


def fill_batches(batches: Iterator, seed: int) -> Iterator:
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "first_cut", "second_cut", "output"]
    for batch in batches:
        for part in slices(batch):
            ids, texts = part["doc_id"].to_pylist(), part["text"].cast(pa.binary()).to_pylist()
            rows = list(zip(*(filled(i, t or b"", seed) for i, t in zip(ids, texts))))
            output = pa.array(rows[-1], pa.binary()).cast(pa.string())
            columns = [part["doc_id"], *(pa.array(c, t) for c, t in zip(rows, types)), output]
            yield pa.RecordBatch.from_arrays(columns, names)


def fill_in_middle(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``FILLED`` of every row; cuts and lengths are null where the form is plain."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(in_tasks("llm.fill_in_middle", "fill_batches", seed), FILLED)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of; it holds no sentinel unless its form is plain."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_in_middle(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


SQL = """
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, CAST(length(coalesce(text, '')) AS BIGINT) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), drawn AS (
  SELECT doc_id, text, n, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS c2,
         text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
           OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 AS plain,
         CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 AS spm
  FROM texts
), cut AS (
  SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b, substr(text, 1, least(c1, c2)) AS prefix,
         substr(text, least(c1, c2) + 1, greatest(c1, c2) - least(c1, c2)) AS middle, substr(text, greatest(c1, c2) + 1) AS suffix
  FROM drawn
)
SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
       CASE WHEN NOT plain THEN a END AS prefix_chars, CASE WHEN NOT plain THEN b - a END AS middle_chars,
       sha256(CASE WHEN plain THEN text WHEN spm THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                   ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""
