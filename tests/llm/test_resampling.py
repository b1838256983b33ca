"""Importance resampling: scores, draws and ranks against plain loops; the radix sort against sorted()."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import compare
import pytest

from llm import queries, resampling
from llm.common import stored

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def parts(text, order):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [" ".join(words[i : i + n]) for n in range(1, order + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, percent=10, least=20, order=1, buckets=10000):
    """Counter of (doc_id, n_features, weight, score, rank)."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, parts(text, order)[1]))
    for text in target:
        t.update(map(bucket, parts(text, order)[1]))
    S, T = sum(s.values()), sum(t.values())
    rows = []
    for doc_id, text in docs:
        words, found = parts(text, order)
        gains = [math.floor(1000 * math.log((t[b] + 1.0) * (S + buckets) / ((s[b] + 1.0) * (T + buckets)))) for b in map(bucket, found)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(found), weight, score, len(words)))
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = percent * len(able) // 100
    told = [(*r[:4], k if k <= drawn else None) for k, r in enumerate(able, 1)]
    return Counter(told + [(*r[:4], None) for r in rows if r[4] < least])


def got(rows):
    return Counter(tuple(r) for r in rows.select("doc_id", "n_features", "weight", "score", "rank").collect())


def test_edge_rows(spark, edge_docs, no_docs):
    target = spark.createDataFrame([("w1x1 w2x4 the same line",), (None,), ("",)], "text string")
    texts = [r["text"] for r in target.collect()]
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert got(resampling.resample(edge_docs, target)) == brute(docs, texts)
    assert got(resampling.resample(edge_docs, target, 60, 1, 3, 97)) == brute(docs, texts, 60, 1, 3, 97)
    assert got(resampling.resample(edge_docs, target.where("false"), 100, 0)) == brute(docs, [], 100, 0)
    assert resampling.resample(no_docs, target).count() == 0


@pytest.mark.parametrize("spread", ["dense", "wide", "ties", "one"])
def test_radix_sort(spark, monkeypatch, spread):
    """Many small blocks; ids over all 64 bits, with repeats and nulls."""
    monkeypatch.setattr(resampling, "BLOCK_ROWS", 64)
    rnd = random.Random(spread)
    id_of = {"dense": lambda: rnd.randrange(3000), "wide": lambda: rnd.choice((None, rnd.randrange(-(1 << 63), 1 << 63))), "ties": lambda: 5, "one": lambda: None}[spread]
    score_of = {"dense": lambda: rnd.randrange(-9000, 30000), "wide": lambda: rnd.randrange(-3, 4), "ties": lambda: 8, "one": lambda: -1}[spread]
    rows = [(id_of(), score_of()) for _ in range(1 if spread == "one" else 2500)]
    out = resampling.ranked(spark.createDataFrame(rows, "doc_id long, score long").repartition(7)).collect()
    assert sorted(r["rank"] for r in out) == list(range(1, len(rows) + 1))
    order = [(r["doc_id"], r["score"]) for r in sorted(out, key=lambda r: r["rank"])]
    assert order == sorted(rows, key=lambda r: (-r[1], r[0] is None, r[0] or 0))


def test_pass_is_stable_and_blocks_are_even(spark, monkeypatch):
    """Nine of ten rows share a digit: still no group beyond a block, and their order stays."""
    rows = [(i, 0 if i % 10 else i // 10, i) for i in range(4000)]
    df = stored(spark.createDataFrame(rows, "id long, digit long, place long"), "t")
    block = resampling.F.floor(resampling.F.col("place") / 128)
    out = resampling.counting_pass(df, resampling.F.col("digit"), block).collect()
    assert [(r["id"], r["digit"]) for r in sorted(out, key=lambda r: r["place"])] == [r[:2] for r in sorted(rows, key=lambda r: r[1])]
    groups = df.groupBy(block, "digit").count().collect()
    assert max(r["count"] for r in groups) <= 128


def test_query(spark, sf_dir, sf_docs):
    rows = queries.QUERIES["op13_resampling"](spark, sf_dir)
    assert compare.difference(rows, compare.connect(sf_dir), resampling.SQL) is None
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert got(rows) == brute([(r["doc_id"], r["text"]) for r in sf_docs.collect()], texts)
