"""Sharding: shards against a plain loop, slots without gaps, what moves when shards or weights change, no Python in the plan."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import compare
import pytest

from highmark.session import work_folder
from llm import queries, sharding


def brute(key, weights):
    costs = []
    for s, w in enumerate(weights):
        digest = hashlib.sha256(f"{'' if key is None else key}:{s // 8}".encode()).hexdigest()
        u = (int(digest[8 * (s % 8) : 8 * (s % 8) + 8], 16) + 0.5) / 2**32
        costs.append((-math.log(u) / w, s))
    return min(costs)[1]


def check(spark, docs, weights, grown=1.0):
    path = work_folder(spark, "t")
    sharding.write_shards(docs, path, weights, grown=grown)
    rows = sharding.read_shards(spark, path, docs.schema).collect()
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted((r["row"] for r in rows), key=key) == sorted(docs.collect(), key=key)
    shards = defaultdict(list)
    for r in rows:
        text = (r["row"]["text"] or "").encode()
        assert r["size"] == len(text) + 8
        assert r["shard"] == brute(r["row"]["doc_id"], weights)
        assert r["grown_shard"] == brute(r["row"]["doc_id"], [*weights, grown])
        shards[r["shard"]].append((r["slot"], r["row"]["doc_id"], zlib.crc32(text), r["size"]))
    for stretch in shards.values():
        stretch.sort()
        assert [s for s, *_ in stretch] == list(range(len(stretch)))
        order = [(i is not None, i or 0, c, n) for _, i, c, n in stretch]
        assert order == sorted(order)
    return rows


def test_edge_rows(spark, edge_docs, no_docs):
    check(spark, edge_docs, [1.0] * 24)
    check(spark, edge_docs, [1.0, 5.0, 0.25], 2.0)
    check(spark, edge_docs.withColumnsRenamed({"n": "shard", "rep": "slot", "sketch": "place", "word": "size"}), [1.0] * 9)
    assert check(spark, no_docs, [1.0] * 3) == []
    with pytest.raises(ValueError):
        sharding.assigned(edge_docs, [1.0, 0.0])


def test_rows_alike_are_spread(spark):
    """A third of the rows without id and text, another third copies of one row: still slots without gaps, in several files."""
    docs = spark.range(0, 6000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 7 ELSE id END AS doc_id",
        "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 'the same text' ELSE 'text ' || id END AS text",
    )
    path, merging = work_folder(spark, "t"), "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    try:
        sharding.write_shards(docs, path, [1.0] * 24)
    finally:
        spark.conf.unset(merging)
    rows = sharding.read_shards(spark, path, docs.schema).select("shard", "slot", "row.doc_id").collect()
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    stretches = spark.read.parquet(f"{path}/stretches").collect()
    assert max(r["n"] for r in stretches) <= 2 * len(rows) / 8
    assert Counter(r["doc_id"] for r in rows)[None] == 2000


def test_few_rows_move():
    keys, weights = range(20000), [1.0, 2.0, 1.0, 4.0]
    before = [brute(k, weights) for k in keys]
    shares = [c / len(keys) for _, c in sorted(Counter(before).items())]
    assert all(abs(s - w / 8) < 0.015 for s, w in zip(shares, weights))
    after = [brute(k, [*weights, 2.0]) for k in keys]
    moved = [(a, b) for a, b in zip(before, after) if a != b]
    assert {b for _, b in moved} == {4} and abs(len(moved) / len(keys) - 0.2) < 0.015
    heavier = [brute(k, [1.0, 3.0, 1.0, 4.0]) for k in keys]
    assert {b for a, b in zip(before, heavier) if a != b} == {1}


def test_query(spark, sf_dir):
    rows = queries.QUERIES["op12_sharding"](spark, sf_dir)
    assert compare.difference(rows, compare.connect(sf_dir), sharding.SQL) is None
    assert all(r["grown_shard"] in (r["shard"], 24) for r in rows.collect())


def test_no_python_in_the_plan(spark, sf_docs):
    rows = sharding.assigned(sf_docs, [1.0] * 24)
    plan = rows._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
