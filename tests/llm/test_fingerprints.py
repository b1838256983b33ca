"""Fingerprints against sets in plain Python."""

import hashlib

from pyspark.sql import functions as F

import edge
from llm import fingerprints


def words(text):
    return (text or "").lower().encode().split()


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_documents(spark, sf_dir, sf_docs):
    rows = {r["doc_id"]: r for r in fingerprints.op2_fingerprints(spark, sf_dir).collect()}
    docs = sorted((r["doc_id"], r["text"] or "") for r in sf_docs.collect())
    assert len(rows) == len(docs)
    equal = {}
    for k, (doc_id, text) in enumerate(docs):
        after = docs[(k + 1) % len(docs)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = rows[doc_id]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert equal.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        if len(shingles(text)) > 200:
            assert abs(r["near_edited"] - jaccard(shingles(text), shingles(edited))) < 0.25
            assert abs(r["near_next"] - jaccard(shingles(text), shingles(after))) < 0.25
    assert len(set(equal.values())) == len(equal)


def test_scale_one_is_the_whole_set(spark, edge_docs):
    rows = edge_docs.select("text", fingerprints.sketch(F.coalesce("text", F.lit("")), 1).alias("all"), fingerprints.sketch(F.coalesce("text", F.lit(""))).alias("some")).collect()
    for r in rows:
        # the built-in lower() folds more than A-Z, but maps equal words to equal ones here
        assert len(r["all"]) == len(shingles(r["text"])) or "İ" in r["text"]
        low = [h for h in r["all"] if h < fingerprints.LONG_MIN + (1 << 64) // fingerprints.SCALE]
        assert r["some"] == (sorted(low) or sorted(r["all"])[:1])


def test_merge_is_the_sketch_of_both(spark):
    df = spark.createDataFrame([(edge.BASE, " ".join(edge.WORDS[::-1])), ("a b", "c d"), ("", "x y")], "a string, b string")
    for scale in (1, 4):
        a, b = fingerprints.sketch(F.col("a"), scale), fingerprints.sketch(F.col("b"), scale)
        for r in df.select(a.alias("a"), b.alias("b"), fingerprints.merge(a, b, scale).alias("both"), fingerprints.containment(a, fingerprints.merge(a, b, scale)).alias("c")).collect():
            both = sorted({*r["a"], *r["b"]})
            low = [h for h in both if h < fingerprints.LONG_MIN + (1 << 64) // scale]
            assert r["both"] == (low or both[:1])


def test_short_text_inside_a_long_one(spark):
    """Containment of a part is 1 or, if nothing of it is kept, unknown; never 0."""
    rows = [(" ".join(f"a{i}_{k}" for k in range(8)), " ".join(f"a{i}_{k}" for k in range(600)), f"other {i} words that are elsewhere") for i in range(200)]
    a, b, c = (fingerprints.sketch(F.col(x)) for x in "abc")
    df = spark.createDataFrame(rows, "a string, b string, c string")
    found = df.select(fingerprints.containment(a, b).alias("part"), fingerprints.containment(a, a).alias("own"), fingerprints.containment(a, c).alias("other")).collect()
    assert {r["part"] for r in found} == {1.0, None} and sum(r["part"] is None for r in found) < 100
    assert {r["own"] for r in found} == {1.0}
    assert {r["other"] for r in found} == {0.0, None}


def check_next(rows, found):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    want = []
    for k, (i, text) in enumerate(order):
        after, half = order[(k + 1) % len(order)][1], len(text) // 2
        want.append((str(i), hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()))
    assert sorted((str(r["doc_id"]), r["edited_sha256"]) for r in found) == sorted(want)


def test_many_rows_without_an_id(spark):
    """Their blocks follow the order of texts, whatever bytes these begin with."""
    texts = [f"{chr(c)}{chr(c)[:k]}{'z' * k}{k}" for k in range(9) for c in (0x20, 0x41, 0x7A, 0xE9, 0x3042, 0x1F642)]
    rows = [(None, t) for t in texts] + [(None, ""), (-(1 << 63), "least"), (-3, "x"), (4, "y"), (4, "y"), ((1 << 63) - 1, "most")]
    docs = edge.frame(spark, [(i, t, "en") for i, t in rows]).repartition(5)
    check_next(rows, fingerprints.edited_sketches(docs).collect())


def test_next_block_over_many_ranges(spark):
    ids = sorted({k * k * 7_919_993 % (1 << 40) for k in range(3000)})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = fingerprints._next_block(spark.createDataFrame([(i,) for i in ids], "block long")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(map(tuple, found)) == list(zip(ids, [*ids[1:], ids[0]]))


def test_edge_rows(edge_docs, no_docs):
    rows = fingerprints.edited_sketches(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    order = sorted(edge_docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"], r["text"] or ""))
    want = []
    for k, r in enumerate(order):
        text, after = r["text"] or "", order[(k + 1) % len(order)]["text"] or ""
        half = len(text) // 2
        want.append((str(r["doc_id"]), len(text), hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()))
    assert sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"]) for r in rows) == sorted(want)
    assert fingerprints.edited_sketches(no_docs).count() == 0


def test_one_document_follows_itself(spark):
    row = fingerprints.edited_sketches(edge.frame(spark, [(5, "abcdef", "en")])).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest()


def test_sparse_ids_over_many_blocks(spark):
    ids = [k * k * 7919 % 1_000_003 for k in range(300)] + [(1 << 62) - k * 999_983 for k in range(50)] + [-(1 << 61), -5, 0]
    ids = sorted(set(ids))
    docs = edge.frame(spark, [(i, f"t{i}", "en") for i in ids])
    got = {r["doc_id"]: r["edited_sha256"] for r in fingerprints.edited_sketches(docs).collect()}
    for k, i in enumerate(ids):
        text, after = f"t{i}", f"t{ids[(k + 1) % len(ids)]}"
        half = len(text) // 2
        assert got[i] == hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()


def test_texts_are_dealt_out_once(spark, sf_dir):
    """All three readers of the texts share one exchange."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = fingerprints.op2_fingerprints(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    shared = [line for line in plan.splitlines() if "REPARTITION_BY_COL" in line]
    assert len([line for line in shared if "ReusedExchange" not in line]) == 1


def test_no_python_in_the_plan(spark, sf_dir):
    plan = fingerprints.op2_fingerprints(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
