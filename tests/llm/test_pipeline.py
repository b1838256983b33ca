"""The pipeline stage by stage, and its registration."""

from collections import Counter

import __spark_entry__ as entry
import corpus_pipeline
import edge
import test_near_dedup
import test_packing
from llm import language, quality
from llm.common import stored


def test_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 14)]
    assert "pipeline" in entry.queries() and {"op3_exact_search", "op10_near_dedup", "op11_fill_in_middle", "op12_sharding", "op13_resampling"} <= set(entry.oracle_sql())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_dedup", "packing"]


def key(rows):
    return Counter(tuple(r) for r in rows)


def test_stages_on_documents(spark):
    """Each stage against a loop over what the one before kept."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}

    good = stored(corpus_pipeline.quality(spark, docs, folder), "t")
    assert good.columns == docs.columns
    model = quality.fit_quality(docs, spark.read.parquet(f"{folder}/labels.parquet"), corpus_pipeline.remainder("doc_id", 5) != 0)
    want = [r for r in docs.collect() if model.scores([quality.features(r["text"])])[0] >= quality.THRESHOLD]
    assert key(good.collect()) == key(want)
    kept = {r["doc_id"] for r in want}
    assert all(i in kept for i, q in labels.items() if q == 1)

    told = stored(corpus_pipeline.language(spark, good, folder), "t")
    assert key(told.collect()) == key(r for r in want if any(c.isalpha() for c in r["text"] or ""))

    single = stored(corpus_pipeline.near_dedup(spark, told, folder), "t")
    rows = [(r["doc_id"], r["text"]) for r in told.collect()]
    stays = {i for (i, _), (_, _, _, k) in zip(rows, test_near_dedup.brute(rows)) if k}
    assert key(single.collect()) == key(r for r in told.collect() if r["doc_id"] in stays)

    packed = corpus_pipeline.packing(spark, single, folder)
    test_packing.check(single, packed.collect())
    run = corpus_pipeline.run(spark, folder)
    columns = ["doc_id", "start", "length", "ids_crc32"]
    assert key(run.select(*columns).collect()) == key(packed.select(*columns).collect())


def test_stages_take_awkward_rows(spark, edge_docs, no_docs):
    folder = "/root/testdata/sf0.001"
    for docs in (edge_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            after = stored(stage(spark, docs, folder), "t")
            if name != "packing":
                assert after.columns == docs.columns
                assert after.exceptAll(docs).count() == 0
                docs = after
    assert language.UNKNOWN == "und" and edge.ROWS
