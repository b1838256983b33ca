"""Near-duplicates against all pairs."""

import numpy as np
import pytest

import compare
import edge
from llm import near_dedup
from llm.common import words_of


def brute(rows):
    """n_shingles and component of each row by comparing all ids with words."""
    sets, n = {}, []
    for i, text, *_ in rows:
        w = words_of(text)
        s = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
        n.append(len(s))
        if s and i is not None:
            sets.setdefault(i, []).append(s)
    part = {i: i for i, *_ in rows if i is not None}

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if any(100 * len(x & y) >= 85 * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = root(a), root(b)
                part[max(p, q)] = min(p, q)
    out = []
    for (i, *_), size in zip(rows, n):
        c = None if i is None else root(i)
        out.append((i, size, c, i is None or i == c))
    return out


def same(df, rows):
    key = lambda r: tuple((v is not None, v) for v in r)
    got = sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=key)
    assert got == sorted(brute(rows), key=key)


def family(size, seed, n_words=300, most=30):
    """Copies of one text, each with up to ``most`` words changed."""
    rng = np.random.default_rng(seed)
    base = [f"b{seed}_{i}" for i in range(n_words)]
    rows = []
    for k in range(size):
        words = list(base)
        for at in rng.integers(0, n_words, rng.integers(0, most)):
            words[at] = f"e{seed}_{k}_{at}"
        rows.append((1000 * seed + k, " ".join(words), "en"))
    return rows


def test_edge_rows(spark, edge_docs, no_docs):
    same(near_dedup.near_duplicates(edge_docs), edge.ROWS)
    assert near_dedup.near_duplicates(no_docs).count() == 0


def test_documents(spark, sf_dir, sf_docs):
    rows = [(r["doc_id"], r["text"]) for r in sf_docs.collect()]
    result = near_dedup.op10_near_dedup(spark, sf_dir)
    same(result, rows)
    assert compare.difference(result, compare.connect(sf_dir), near_dedup.SQL) is None


@pytest.mark.parametrize("block", [2048, 16])
def test_large_families_are_compared_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", block)
    rows = family(90, 1) + family(40, 2, 200, 8) + family(60, 3, 120, 25) + [(9999, edge.BASE, "en")]
    same(near_dedup.near_duplicates(edge.frame(spark, rows)), rows)


def test_one_id_with_two_texts_is_one_document(spark):
    other = " ".join(f"o{i}" for i in range(100))
    rows = [(5, edge.BASE, "en"), (5, other, "en"), (6, edge.BASE, "en"), (7, other, "en")]
    same(near_dedup.near_duplicates(edge.frame(spark, rows)), rows)


def test_one_of_each(spark, edge_docs):
    kept = near_dedup.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    want = {(i, t) for (i, t, *_), (_, _, _, stays) in zip(edge.ROWS, brute(edge.ROWS)) if stays}
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert set(got) == want and len([i for i, _ in got if i is not None]) == len({i for i, _ in got if i is not None})


def test_coordinates_agree_as_often_as_sets():
    rng = np.random.default_rng(7)
    differ = []
    for _ in range(40):
        pool = rng.integers(0, 1 << 63, 400).astype(np.uint64)
        a, b = pool[:300], pool[60:360]
        agree = (near_dedup.signature(np.unique(a)) == near_dedup.signature(np.unique(b))).mean()
        differ.append(agree - 240 / 360)
    assert abs(np.mean(differ)) < 0.03 and np.abs(differ).max() < 0.25


def test_common_counts():
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 9000, rng.integers(1, 6000)).astype(np.uint64)) for _ in range(7)]
    got = near_dedup.common_counts(sets[:3], sets)
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets] for a in sets[:3]]


def test_threshold_is_an_argument(spark):
    """Copies between 0.80 and 0.85: apart for op10, one from 80 percent on; also in a family beyond pairs."""
    base = [f"b{i}" for i in range(300)]
    copy = lambda k, n: " ".join(f"e{k}_{i}" if i in range(10, 10 + 10 * n, 10) else w for i, w in enumerate(base))
    rows = [(1, " ".join(base), "en"), (2, copy(2, 6), "en"), (3, copy(3, 7), "en")]  # 266/326, 261/331
    result = lambda rows, *percent: [r["component_id"] for r in near_dedup.near_duplicates(edge.frame(spark, rows), *percent).orderBy("doc_id").collect()]
    assert result(rows) == [1, 2, 3] and result(rows, 80) == [1, 1, 3]
    many = [(1, " ".join(base), "en"), *((k, copy(k, 6), "en") for k in range(2, 42))]
    assert result(many) == list(range(1, 42)) and result(many, 80) == [1] * 41
    assert [r["doc_id"] for r in near_dedup.one_of_each(edge.frame(spark, rows), 80).orderBy("doc_id").collect()] == [1, 3]
    assert near_dedup.bands_for(85) == near_dedup.BANDS
