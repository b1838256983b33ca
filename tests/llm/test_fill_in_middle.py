"""Fill-in-middle: the boundary set against plain decoding, outputs against slices of code points, exact round trips."""

import hashlib

import compare
import numpy as np
import pytest

from llm import fill_in_middle as fim
from llm import queries


def brute(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if h4 % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return doc_id, n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


TEXTS = {
    "empty": ("", {"Array"}),
    "ascii": ("plain words " * 20000, {"Runs"}),
    "wide": ("🙂" * 3000, {"Array"}),
    "mixed": ("añb🙂日" * 60000, {"Bitmap"}),
    "both": ("x" * 65535 + "é" * 40000 + "日" * 9, None),
    "full": ("y" * 65536, None),
}


@pytest.mark.parametrize("name", list(TEXTS))
def test_boundary_set(name):
    text, kinds = TEXTS[name]
    bounds = fim.Boundaries(text.encode())
    assert bounds.members == len(text) + 1
    sizes = [0, *np.cumsum([len(c.encode()) for c in text]).tolist()]
    picked = sorted({*range(min(len(text), 50) + 1), *range(0, len(text) + 1, 397), len(text)})
    assert [bounds.select(k) for k in picked] == [sizes[k] for k in picked]
    if kinds:
        assert kinds <= {type(c).__name__ for c in bounds.containers}


def check(docs):
    rows = fim.fill_in_middle(docs)
    rows = rows.withColumn("restored", fim.restored(rows["output"], rows["form"])).collect()
    given = docs.select("doc_id", "text").collect()
    key = lambda r: tuple((v is not None, v) for v in r)
    got = [tuple(r[c] for c in ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")) for r in rows]
    assert sorted(got, key=key) == sorted((brute(*r) for r in given), key=key)
    assert sorted(r["restored"] for r in rows) == sorted(r["text"] or "" for r in given)
    for r in rows:
        if r["form"] != "plain":
            raw = r["restored"].encode()
            assert len(raw[: r["first_cut"]].decode()) == r["prefix_chars"]
            assert len(raw[r["first_cut"] : r["second_cut"]].decode()) == r["middle_chars"]
    return rows


def test_edge_rows(spark, edge_docs, no_docs):
    check(edge_docs)
    marked = spark.createDataFrame([(i, f"{m} inside {m}<") for i, m in enumerate(("<P>", "<S>", "<M>", "<P", "S>", "<<P>>"))], "doc_id long, text string")
    assert [r["form"] == "plain" for r in sorted(check(marked))][:3] == [True] * 3
    assert fim.fill_in_middle(no_docs).count() == 0


def test_sentinels_do_not_meet_the_text(spark):
    """Texts of sentinel pieces: whatever the cuts are, splitting finds the three sentinels only."""
    rows = [(i, "<P<S<M>"[: i % 8] + "M>S>P<"[i % 7 :] * 3) for i in range(400)]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_query(spark, sf_dir, sf_docs):
    rows = queries.QUERIES["op11_fill_in_middle"](spark, sf_dir)
    assert compare.difference(rows, compare.connect(sf_dir), fim.SQL) is None
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [brute(r["doc_id"], r["text"]) for r in sf_docs.collect()]
    assert sorted(tuple(r)[:-1] for r in rows.collect() if r["form"] != "plain") == sorted((*w[:5], digest(w[5])) for w in want if w[2] != "plain")
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
