"""Language identification: held-out accuracy and awkward rows."""

import math
import zlib

import numpy as np

from llm import language


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    rows = language.op8_language(spark, folder).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert np.mean([langs[r["doc_id"]] == r["lang_pred"] for r in rows if r["held_out"]]) > 0.98


def test_related_languages_meet_in_pairs():
    langs = ["de", "en", "es", "fr", "tlh"]
    rng = np.random.default_rng(1)
    y = np.repeat(np.arange(5), 30)
    x = rng.random((150, 1 << language.BITS)).astype(np.float32) / 100
    x[np.arange(150), y * 7] += 1
    model = language.Model(langs, x, y)
    assert model.families == ["germanic", "romance", "tlh"] and model.pairs == [(0, 1), (2, 3)]
    names, score = model.predict(x)
    assert [langs.index(n) for n in names] == y.tolist() and ((score > 0) & (score <= 1)).all()


def one_by_one(model, text):
    """Family by the largest margin, then a vote of every pair in it; the more certain, then the earlier one of a tie."""
    x = language.features(text) if text else None
    if x is None:
        return language.UNKNOWN, 0.0
    squash = lambda m: 1 / (1 + math.exp(-max(-40.0, min(40.0, 3 * m))))
    margins = [float(np.dot(x.astype(np.float64), model.weights[:, k].astype(np.float64))) for k in range(model.weights.shape[1])]
    several = len(model.families) if len(model.families) > 1 else 0
    family, score = 0, 1.0
    if several:
        family = max(range(several), key=lambda k: (margins[k], -k))
        score = squash(margins[family])
    votes, sure = {m: 0 for m in model.members[family]}, {m: 0.0 for m in model.members[family]}
    for (a, b), margin in zip(model.pairs, margins[several:]):
        if a in votes:
            p = squash(margin)
            votes[a if p >= 0.5 else b] += 1
            sure[a] += p
            sure[b] += 1 - p
    best = sorted(votes, key=lambda m: (-votes[m], -sure[m], m))[0]
    return model.languages[best], score * (sure[best] / (len(votes) - 1) if len(votes) > 1 else 1.0)


def test_query_equals_plain_loop(spark, sf_dir, sf_docs):
    docs = sf_docs.select("doc_id", "text", "lang")
    model = language.fit_languages(docs, language.remainder("doc_id", language.HELD_OUT) != 1)
    want = {r["doc_id"]: one_by_one(model, r["text"]) for r in docs.collect()}
    rows = language.op8_language(spark, sf_dir).collect()
    assert len(rows) == len(want)
    for r in rows:
        name, score = want[r["doc_id"]]
        assert r["lang_pred"] == name and abs(r["score"] - score) < 1e-4


def test_ties_go_to_the_earlier_language(monkeypatch):
    """Machines that say nothing: all margins are 0, so votes and certainty tie within the first family."""
    monkeypatch.setattr(language, "fit_machine", lambda x, positive, seed: np.zeros(x.shape[1], np.float32))
    langs = ["de", "en", "es", "fr", "nl"]
    x = np.ones((5, 1 << language.BITS), np.float32)
    model = language.Model(langs, x, np.arange(5))
    names, score = model.predict(x[:1])
    assert names == [one_by_one(model, "any text")[0]] and abs(score[0] - one_by_one(model, "any text")[1]) < 1e-9


def test_edge_rows(spark, edge_docs, no_docs):
    model = language.fit_languages(edge_docs)
    rows = language.predict_languages(edge_docs, model, ["doc_id", "text"]).collect()
    assert len(rows) == edge_docs.count()
    for r in rows:
        has_letter = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == language.UNKNOWN) == (not has_letter)
        assert 0 <= r["score"] <= 1 and r["lang_pred"] in ("en", "de", "fr", "es", "und")
    assert language.predict_languages(no_docs, model, ["doc_id"]).count() == 0
    assert language.fit_languages(no_docs) is None
    assert {r["lang_pred"] for r in language.predict_languages(edge_docs, None, ["doc_id"]).collect()} == {language.UNKNOWN}
