"""Training order: a permutation for every size and key, binary shards of fixed stride, reads from any slot."""

import glob
import os
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from highmark.session import work_folder
from llm import queries
from llm import training_order as to
from llm.packing import END_ID, VOCABULARY, encoder


@pytest.mark.parametrize("size", [1, 2, 3, 5, 16, 17, 64, 65, 1000, 4097])
def test_permutation(size):
    slots = to.permuted(np.arange(size), size)
    assert sorted(slots.tolist()) == list(range(size))
    if size > 10:
        assert slots.tolist() != to.permuted(np.arange(size), size, to.KEY + 1).tolist() != list(range(size))


def own_ids(text):
    return [*(encoder(public_tokenizers.path(VOCABULARY))(text).tolist() if text else []), END_ID]


def numbers(data):
    return np.frombuffer(data, f"<u{to.ID_BYTES}").tolist()


def check(spark, docs, length, stride):
    """Writes ``docs``; every row must come back from the shards, whole."""
    path = work_folder(spark, "t")
    to.write_order(docs, path, length=length, stride=stride)
    records = {r["slot"]: (r["shard"], numbers(r["ids"])) for r in to.read_order(spark, path).collect()}
    assert sorted(records) == list(range(len(records)))
    assert all(shard == slot // stride and len(ids) == length for slot, (shard, ids) in records.items())
    found, filled = Counter(), Counter()
    for r in to.read_index(spark, path).collect():
        ids = records[r["slot"]][1][r["offset"] : r["offset"] + r["length"]]
        found[r["doc_id"], r["start"], tuple(ids)] += 1
        filled[r["slot"]] += r["length"]
    # pieces are cut where sequences end, so rows are compared by what lies at each position
    got, want = Counter(), Counter()
    for (doc_id, start, ids), n in found.items():
        got.update({(doc_id, start + k, i): n for k, i in enumerate(ids)})
    for r in docs.collect():
        want.update((r["doc_id"], k, i) for k, i in enumerate(own_ids(r["text"])))
    assert got == want
    for slot, n in filled.items():
        assert set(records[slot][1][n:]) <= {END_ID}
    return path, records


def test_edge_rows(spark, edge_docs):
    for parts in (1, 5):
        check(spark, edge_docs.repartition(parts), 64, 100)


def test_columns_named_like_its_own(spark, edge_docs):
    names = ["slot", "shard", "ids", "zstd", "number", "file", "row", "ahead", "length", "start", "starts", "offset", "_metadata"]
    check(spark, edge_docs.select("*", *(F.lit("other").alias(c) for c in names)), 64, 16)


def test_empty_table(spark, no_docs):
    path, records = check(spark, no_docs, 64, 4)
    assert not records and not glob.glob(f"{path}/shards/*/*")
    assert to.read_order(spark, path, 3, 9).count() == 0


def test_slots_are_the_permutation_of_one_running_text(spark, sf_docs):
    docs = sf_docs.select("doc_id", "text").coalesce(1)
    stream = [i for r in docs.collect() for i in own_ids(r["text"])]
    _, records = check(spark, docs, 128, 50)
    size = -(-len(stream) // 128)
    stream += [END_ID] * (size * 128 - len(stream))
    slots = to.permuted(np.arange(size), size).tolist()
    assert {s: stream[k * 128 : (k + 1) * 128] for k, s in enumerate(slots)} == {s: ids for s, (_, ids) in records.items()}


def test_shards_have_a_fixed_stride_and_are_read_by_offset(spark, sf_docs):
    path, records = check(spark, sf_docs, 128, 32)
    files = sorted(glob.glob(f"{path}/shards/*/*.bin"))
    assert len(files) == -(-len(records) // 32)
    assert [os.path.getsize(f) for f in files[:-1]] == [32 * 128 * to.ID_BYTES] * (len(files) - 1)
    for slot in (0, 31, 32, 45, len(records) - 1):
        with open(to.shard_path(path, slot // 32), "rb") as file:
            file.seek(slot % 32 * 128 * to.ID_BYTES)
            assert numbers(file.read(128 * to.ID_BYTES)) == records[slot][1]


def test_resumed_reads_open_no_other_shard(spark, sf_docs):
    path, records = check(spark, sf_docs, 128, 32)
    for start, stop in ((0, None), (45, None), (64, 96), (70, 71), (70, 70), (len(records), None)):
        rows = to.read_order(spark, path, start, stop).collect()
        assert sorted(r["slot"] for r in rows) == list(range(len(records)))[start:stop]
        assert all(numbers(r["ids"]) == records[r["slot"]][1] for r in rows)
    os.remove(to.shard_path(path, 0))
    assert to.read_order(spark, path, 45).count() == len(records) - 45


def test_a_task_that_runs_again_writes_the_same(spark, sf_docs):
    path = work_folder(spark, "t")
    rows, size = to.slotted(sf_docs, length=128)
    batch = rows.sort("slot").toArrow().combine_chunks().to_batches()
    read = lambda: {f: open(f, "rb").read() for f in glob.glob(f"{path}/shards/*/*.bin")}  # noqa: E731, SIM115
    list(to.shard_batches(iter(batch), path, 32, 128 * to.ID_BYTES))
    before = read()
    list(to.shard_batches(iter(batch), path, 32, 128 * to.ID_BYTES))
    assert read() == before and sum(map(len, before.values())) == size * 128 * to.ID_BYTES


def test_ids_that_do_not_fit(spark, sf_docs, monkeypatch):
    monkeypatch.setattr(to, "ID_BYTES", 1)
    batch = sf_docs.select("doc_id", "text").toArrow().to_batches()
    with pytest.raises(ValueError, match="does not fit"):
        list(to.sequence_batches(iter(batch), public_tokenizers.path(VOCABULARY), 64, END_ID))


def test_query(spark, sf_dir, sf_docs):
    rows = queries.QUERIES["op5_training_order"](spark, sf_dir).collect()
    lengths = Counter()
    for r in rows:
        lengths[r["doc_id"]] += r["length"]
    assert lengths == {r["doc_id"]: len(own_ids(r["text"])) for r in sf_docs.collect()}
    path = work_folder(spark, "again")
    to.write_order(sf_docs, path)
    crc = {r["slot"]: zlib.crc32(bytes(r["ids"])) for r in to.read_order(spark, path).collect()}
    assert {r["slot"]: r["record_crc32"] for r in rows} == crc
