"""Packing of token sequences into windows by minimum bin slack.

A document's ids are cut into full windows and one rest. A histogram of the rests, at most
``capacity`` numbers, is all that the planner sees: for the longest rest left, a bitset of the
sums that the others can reach picks the multiset that fills the window closest to capacity; the
multiset is used as often as the counts allow. Each rest finds its window by its rank among the
rests of its length, counted in blocks, so that no length meets in one task.

Defined results: null text is empty text, which is the end id alone; a repeated row is packed
again; an empty table gives no pieces; other columns are not read. A last window whose content is
a power of two, or full, needs no padding; others are padded by whoever writes them.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from llm.common import in_tasks, slices, stored, table

CAPACITY = 2048
END_ID = 1
VOCABULARY = "byte_bpe_50k.json"
#: Fixed value: the text of the vocabulary's special token and its id.
SPECIAL = {"<|endoftext|>": 50256}
LONG_RUN = 5000
#: Blocks over which the pieces of one length are numbered.
BLOCKS = 4096
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PLAN = "length long, first long, last long, times long, sequence long, at long"

_encoders: dict[str, tuple] = {}


def encoder(path: str):
    """text -> uint32 ids, as the ``tokenizers`` file at ``path`` gives them.

    The file's vocabulary, ids and pattern are also there as ranks; the rank encoder gives the
    same ids several times faster. Texts that it refuses go to ``tokenizers`` itself.
    """
    if path not in _encoders:
        import tiktoken
        from tokenizers import Tokenizer

        slow = Tokenizer.from_file(path)
        with open(path.removesuffix(".json") + ".tiktoken", "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)

        def encode(text: str) -> np.ndarray:
            if len(text) > LONG_RUN and re.search(rf"\s{{{LONG_RUN}}}", text):
                # the pattern engine goes back over a run of white space, and so far only
                return np.array(slow.encode(text, add_special_tokens=False).ids, dtype="<u4")
            return fast.encode_to_numpy(text, allowed_special="all")

        _encoders[path] = (encode,)
    return _encoders[path][0]


def cut_batches(batches: Iterator, path: str, capacity: int, end_id: int) -> Iterator:
    """Pieces of each document: full windows, then the rest if there is one."""
    encode, end = encoder(path), np.array([end_id], dtype="<u4")
    for batch in batches:
        for part in slices(batch):
            rows = []
            for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist()):
                ids = np.concatenate([encode(text).astype("<u4", copy=False), end]) if text else end
                for start in range(0, len(ids), capacity):
                    piece = ids[start : start + capacity]
                    rows.append((doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])


def closest_fill(counts: dict[int, int], room: int) -> list[int]:
    """Lengths, as many of each as ``counts`` has at most, whose sum is closest to ``room`` from below.

    Bit s of ``reach`` says that the sum s can be made; the states before each item lead back.
    """
    reach, full, trail = 1, 1 << room, []
    inside = (full << 1) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        for _ in range(min(counts[length], room // length)):
            wider = (reach | reach << length) & inside
            if wider == reach:
                break
            trail.append((length, reach))
            reach = wider
            if reach & full:
                break
        if reach & full:
            break
    total, chosen = reach.bit_length() - 1, []
    for length, before in reversed(trail):
        if not before >> total & 1:
            chosen.append(length)
            total -= length
    return chosen


def plan_windows(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple]:
    """Rows of ``PLAN``: pieces ``first <= rank < last`` of a length, ``times`` of them in each
    sequence from ``sequence`` on, the first at offset ``at``."""
    left = {k: v for k, v in histogram.items() if v}
    used = dict.fromkeys(left, 0)
    rows, sequence = [], 0
    while left:
        longest = max(left)
        left[longest] -= 1
        chosen = [longest, *closest_fill({k: v for k, v in left.items() if v}, capacity - longest)]
        left[longest] += 1
        times = {k: chosen.count(k) for k in chosen}
        repeats, at = min(left[k] // n for k, n in times.items()), 0
        for length, n in times.items():
            first = used[length]
            used[length] = first + n * repeats
            rows.append((length, first, used[length], n, sequence, at))
            at += n * length
            left[length] -= n * repeats
            if not left[length]:
                del left[length]
        sequence += repeats
    return rows


def cut_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``PIECES`` of the ids of ``text`` followed by ``end_id``."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(in_tasks("llm.packing", "cut_batches", path, capacity, end_id), PIECES)


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``. ``pieces`` is read twice: give a stored table.

    The histogram has at most ``capacity`` rows and the plan at most a few for each length and
    halving of its count, whatever the number of pieces; both go through the driver, the plan as
    a broadcast.
    """
    spark = pieces.sparkSession
    blocks = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "start"), F.lit(BLOCKS)))
    counts = blocks.groupBy("length", "block").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "block", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("length", "block").orderBy("doc_id", "start", "ids_crc32")
    ranked = blocks.withColumn("place", F.row_number().over(within) - 1)
    ranked = ranked.join(counts, ["length", "block"]).withColumn("rank", F.col("place") + F.col("ahead"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = spark.createDataFrame(plan_windows(histogram, capacity), PLAN)
    nth = F.col("rank") - F.col("first")
    placed = ranked.join(
        F.broadcast(plan),
        (ranked["length"] == plan["length"]) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")),
    )
    return placed.select(
        *(ranked[c] for c in pieces.columns),
        (F.col("sequence") + F.floor(nth / F.col("times"))).cast("long").alias("sequence_id"),
        (F.col("at") + nth % F.col("times") * ranked["length"]).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    return pack_pieces(stored(cut_documents(docs, vocabulary), "pieces"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
