"""Lengths: every limit against plain loops over all documents."""

import math

import public_tokenizers

from pyspark.sql import functions as F

from llm import lengths, packing, queries


def check(rows, texts):
    encode = packing.encoder(public_tokenizers.path(packing.VOCABULARY))
    sizes = sorted(len(encode(t)) + 1 if t else 1 for t in texts)
    percent = {}
    for p in range(1, 101):
        percent.setdefault(sizes[math.ceil(p * len(sizes) / 100) - 1], []).append(p)
    rows = sorted(rows)
    assert [r["context_limit"] for r in rows] == list(range(1, sizes[-1] + 1))
    for r in rows if len(rows) < 3000 else rows[:400] + rows[400:-400:37] + rows[-400:]:
        limit = r["context_limit"]
        longer = [s for s in sizes if s > limit]
        told = percent.get(limit, [None])
        assert tuple(r)[1:] == (sizes.count(limit), len(longer), sum(longer), sum(min(s, limit) for s in sizes), told[0], told[-1])
    assert sum(r["last_percent"] - r["first_percent"] + 1 for r in rows if r["last_percent"]) == 100


def test_documents(spark, sf_dir, sf_docs):
    check(queries.QUERIES["op6_length_histogram"](spark, sf_dir).collect(), [r["text"] for r in sf_docs.collect()])


def test_edge_rows(spark, edge_docs, no_docs):
    rows = lengths.context_limits(lengths.length_histogram(edge_docs)).collect()
    check(rows, [r["text"] for r in edge_docs.collect()])
    assert lengths.context_limits(lengths.length_histogram(no_docs)).count() == 0


def test_columns_named_like_its_own(edge_docs):
    names = ["length", "n", "limit", "block", "context_limit", "tokens", "n_docs"]
    named = edge_docs.drop("n").select("*", *(F.lit("other").alias(c) for c in names))
    rows = lengths.context_limits(lengths.length_histogram(named)).collect()
    check(rows, [r["text"] for r in edge_docs.collect()])
