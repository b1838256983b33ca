"""Training order: token ids in binary shards of fixed stride, in a keyed random order of sequences.

Tasks encode their documents, put the end id after each, run them together and cut them into
sequences of ``length`` ids; the last sequence of a task is filled up with end ids. Sequences are
written once and numbered 0 to N - 1 by file and row, without a sort. A Feistel network over the
smallest even number of bits that holds N, its rounds keyed, permutes the numbers; what falls outside
0 to N - 1 goes through it again until it falls inside (cycle-walking), so every number has one slot
and every slot one number.

Shard k holds the slots ``k * stride`` to ``(k + 1) * stride - 1`` as one file of records of
``length * ID_BYTES`` bytes, little-endian, and nothing else: the record of a slot is found by one
division and read at its offset. One task owns a shard, writes it in the order of slots and gives
it its name by a rename, so a lost task only writes the same bytes again. The folder ``index`` tells
which part of which document lies where in a sequence, ``order.json`` the sizes.

The same documents in the same partitions have the same order; other partitions number the sequences
otherwise.

Defined results: null text is empty text, which is the end id alone; null ids stay null; a repeated
row is written again; an empty table has no sequence and no shard; other columns are not read. Ids
that do not fit into ``ID_BYTES`` raise.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from highmark.session import work_folder
from highmark.sources.files import read_small, replace_small
from llm.common import in_tasks, slices, table
from llm.packing import END_ID, VOCABULARY, encoder

KEY, ROUNDS = 0x5EED, 6
#: Ids in a sequence, bytes of an id, sequences in a shard (32 MB; take more for larger corpora).
LENGTH, ID_BYTES, STRIDE = 2048, 2, 8192
#: Sequences handed on at once, whatever the length of a document.
AT_ONCE = 512
#: Files up to this many have their first numbers broadcast, some 100 bytes each.
FEW_FILES = 100_000
PARTS = "doc_ids array<bigint>, starts array<bigint>, lengths array<bigint>, offsets array<bigint>"
LISTS = ["doc_ids", "starts", "lengths", "offsets"]
#: Stored sequences are compressed by the page of their Parquet file, which sees many; those in a shuffle each by itself.
SEQUENCES = f"ids binary, {PARTS}"
SLOTTED = f"slot long, zstd binary, {PARTS}"
LEVEL = 6
INDEX = f"slot long, {PARTS}"
MANIFEST = "order.json"


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def round_keys(key: int) -> np.ndarray:
    steps = np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return _mix64(steps + np.uint64(key & ((1 << 64) - 1)))


def permuted(numbers: np.ndarray, size: int, key: int = KEY) -> np.ndarray:
    """Slots of ``numbers``, all of 0 to ``size`` - 1."""
    half = np.uint64(max(1, -(-(size - 1).bit_length() // 2)))
    mask, keys = np.uint64((1 << int(half)) - 1), round_keys(key)
    out = numbers.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> half, out[walking] & mask
        for k in keys:
            left, right = right, left ^ (_mix64(right + k) & mask)
        out[walking] = left << half | right
        walking = walking[out[walking] >= np.uint64(size)]
    return out.astype(np.int64)


def _sequence_batch(rows: list[tuple]) -> pa.RecordBatch:
    records, *lists = zip(*rows)
    columns = [pa.array(records, pa.binary()), *(pa.array(c, pa.list_(pa.int64())) for c in lists)]
    return pa.RecordBatch.from_arrays(columns, ["ids", *LISTS])


def sequence_batches(batches: Iterator, path: str, length: int, end_id: int) -> Iterator:
    """``SEQUENCES`` of the documents of one task, run together."""
    encode, end, kind = encoder(path), np.array([end_id], dtype="<u4"), f"<u{ID_BYTES}"
    ids, lists, room, rows = [], ([], [], [], []), length, []

    def close() -> None:
        nonlocal ids, lists, room
        ids.append(np.full(room, end_id, dtype=kind))
        rows.append((np.concatenate(ids).tobytes(), *lists))
        ids, lists, room = [], ([], [], [], []), length

    for batch in batches:
        for part in slices(batch):
            for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist()):
                own = np.concatenate([encode(text), end]) if text else end
                if int(own.max()) >> 8 * ID_BYTES:
                    raise ValueError(f"id {own.max()} does not fit into {ID_BYTES} bytes")
                own, start = own.astype(kind), 0
                while start < len(own):
                    piece = own[start : start + room]
                    ids.append(piece)
                    for to, value in zip(lists, (doc_id, start, len(piece), length - room)):
                        to.append(value)
                    start, room = start + len(piece), room - len(piece)
                    if not room:
                        close()
                        if len(rows) == AT_ONCE:
                            yield _sequence_batch(rows)
                            rows.clear()
    if ids:
        close()
    if rows:
        yield _sequence_batch(rows)


def slot_batches(batches: Iterator, size: int, key: int) -> Iterator:
    """Numbered sequences with their slots, compressed until they are written."""
    squeeze = pa.Codec("zstd", compression_level=LEVEL).compress
    for batch in batches:
        for part in slices(batch, AT_ONCE):
            slot = permuted(part["number"].to_numpy(zero_copy_only=False), size, key)
            records = pa.array([squeeze(r.as_buffer(), asbytes=True) for r in part["ids"]], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(slot), records, *(part[c] for c in LISTS)], ["slot", "zstd", *LISTS])


def slotted(docs: DataFrame, key: int = KEY, length: int = LENGTH, vocabulary: str | None = None) -> tuple[DataFrame, int]:
    """``SLOTTED`` of all sequences, not yet dealt out, and their number. The driver sees one count of each file."""
    spark, path = docs.sparkSession, vocabulary or public_tokenizers.path(VOCABULARY)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    folder = work_folder(spark, "sequences")
    cut = rows.mapInArrow(in_tasks("llm.training_order", "sequence_batches", path, length, END_ID), SEQUENCES)
    cut.write.options(**{"compression": "zstd", "parquet.compression.codec.zstd.level": LEVEL}).parquet(folder)
    rows = spark.read.schema(SEQUENCES).parquet(folder)
    rows = rows.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"), *rows.columns)
    first, size = [], 0
    for file, n in sorted(tuple(r) for r in rows.groupBy("file").agg(F.count("*").alias("n")).collect()):
        first.append((file, size))
        size += n
    ahead = spark.createDataFrame(first, "file string, ahead long")
    rows = rows.join(F.broadcast(ahead) if len(first) <= FEW_FILES else ahead, "file")
    rows = rows.select((F.col("ahead") + F.col("row")).alias("number"), "ids", *LISTS)
    return rows.mapInArrow(in_tasks("llm.training_order", "slot_batches", size, key), SLOTTED), size


def shard_path(root: str, shard: int) -> str:
    """Shards lie in folders of a thousand."""
    return f"{root}/shards/{shard // 1000:06d}/{shard:09d}.bin"


def shard_batches(batches: Iterator, base: str, stride: int, record: int) -> Iterator:
    """Writes the shards whose sequences come in, each whole and by ascending slot; gives their index rows."""
    import posixpath
    import uuid

    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(base)
    expand = pa.Codec("zstd").decompress
    out = hidden = shard = None

    def close() -> None:
        if out is not None:
            out.close()
            store.move(hidden, shard_path(root, shard))

    for batch in batches:
        slots = batch["slot"].to_numpy(zero_copy_only=False)
        records = batch["zstd"]
        for k, at in enumerate((slots // stride).tolist()):
            if at != shard:
                close()
                shard, folder = at, posixpath.dirname(shard_path(root, at))
                store.create_dir(folder, recursive=True)
                hidden = f"{folder}/.{uuid.uuid4().hex}"
                out = store.open_output_stream(hidden)
            out.write(expand(records[k].as_buffer(), record))
        yield pa.RecordBatch.from_arrays([batch["slot"], *(batch[c] for c in LISTS)], ["slot", *LISTS])
    close()


def write_order(docs: DataFrame, path: str, key: int = KEY, length: int = LENGTH, stride: int = STRIDE, vocabulary: str | None = None) -> None:
    """Shards, index and sizes below ``path``, which all executors must see."""
    rows, size = slotted(docs, key, length, vocabulary)
    shards = max(1, -(-size // stride))
    dealt = rows.repartitionById(shards, F.expr(f"CAST(slot DIV {stride} AS int)")).sortWithinPartitions("slot")
    dealt = dealt.mapInArrow(in_tasks("llm.training_order", "shard_batches", path, stride, length * ID_BYTES), INDEX)
    dealt.write.option("compression", "zstd").parquet(f"{path}/index")
    replace_small(path, MANIFEST, json.dumps({"sequences": size, "length": length, "id_bytes": ID_BYTES, "stride": stride, "key": key}))


def record_batches(batches: Iterator, base: str, start: int, stop: int, stride: int, record: int) -> Iterator:
    """The records of slots ``start`` to ``stop`` - 1 of each shard that comes in as ``id``, a few at a time."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(base)
    for batch in batches:
        for shard in batch["id"].to_pylist():
            low, high = max(start, shard * stride), min(stop, (shard + 1) * stride)
            with store.open_input_file(shard_path(root, shard)) as file:
                file.seek((low - shard * stride) * record)
                for slot in range(low, high, AT_ONCE):
                    n = min(AT_ONCE, high - slot)
                    data = file.read(n * record)
                    if len(data) != n * record:
                        raise ValueError(f"shard {shard} ends before slot {slot + n}")
                    ids = [data[k * record : (k + 1) * record] for k in range(n)]
                    columns = [pa.array(range(slot, slot + n), pa.int64()), pa.array([shard] * n, pa.int64()), pa.array(ids, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["slot", "shard", "ids"])


def read_order(spark: SparkSession, path: str, start: int = 0, stop: int | None = None) -> DataFrame:
    """``slot, shard, ids`` of the slots from ``start`` on, before ``stop`` if given; other shards are not
    opened, and within the first reading begins at the offset of ``start``."""
    sizes = json.loads(read_small(path, MANIFEST))
    stride, record = sizes["stride"], sizes["length"] * sizes["id_bytes"]
    start, stop = max(start, 0), min(sizes["sequences"] if stop is None else stop, sizes["sequences"])
    first, last = start // stride, -(-stop // stride) if stop > start else start // stride
    shards = spark.range(first, last, 1, max(1, last - first))
    return shards.mapInArrow(in_tasks("llm.training_order", "record_batches", path, start, stop, stride, record), "slot long, shard long, ids binary")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """``slot, doc_id, start, length, offset``: each part of a document, and where in its sequence it lies."""
    parts = spark.read.schema(INDEX).parquet(f"{path}/index").select("slot", F.explode(F.arrays_zip(*LISTS)).alias("p"))
    return parts.select("slot", *(F.col(f"p.{c}s").alias(c) for c in ("doc_id", "start", "length", "offset")))


def op5_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark, "training-order")
    write_order(table(spark, sf_dir, "documents"), path)
    records = read_order(spark, path).select("slot", "shard", F.crc32("ids").alias("record_crc32"))
    byte_offset = (F.col("slot") % STRIDE * (LENGTH * ID_BYTES) + F.col("offset") * ID_BYTES).alias("byte_offset")
    # what leaves Python looks small to the planner: without the hint it would be broadcast at any size
    return read_index(spark, path).join(records.hint("merge"), "slot").select("doc_id", "start", "length", "slot", "shard", byte_offset, "record_crc32")
