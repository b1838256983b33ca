"""Byte-level BPE against the tiktoken library, and exact round trips."""

import base64
import random
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

import edge
from llm import byte_bpe

PATH = public_tokenizers.path(byte_bpe.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(packed):
    return list(memoryview(bytes(packed)).cast("I"))


def test_table(spark, edge_docs, sf_docs, library):
    for docs in (edge_docs, sf_docs):
        rows = byte_bpe.decode_documents(byte_bpe.encode_documents(docs)).collect()
        want = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
        assert Counter((r["doc_id"], bytes(r["decoded"])) for r in rows) == Counter((i, t.encode()) for i, t in want)
        for r in rows:
            assert ids(r["ids"]) == library.encode_ordinary(bytes(r["decoded"]).decode())


def test_random_joins(library):
    codec = byte_bpe.codec(PATH)
    rng = random.Random(5)
    for alphabet in ("ab", "abcdefghij", "aé日 ", "  \n\tx", "0123.,;'ts"):
        for n in (1, 2, 7, 30, 200, 1500):
            text = "".join(rng.choice(alphabet) for _ in range(n))
            assert ids(codec.encode(text)) == library.encode_ordinary(text)
            data = text.replace(" ", "").encode()
            cut = rng.randrange(len(data) + 1)
            joined = codec.join(codec.tree(data[:cut]), codec.tree(data[cut:])) if 0 < cut < len(data) else codec.tree(data)
            assert joined == codec._merged_long(data)


def test_long_texts_are_cut_at_seams(monkeypatch, library):
    monkeypatch.setattr(byte_bpe, "SPAN_CHARS", 40)
    codec = byte_bpe.Codec(byte_bpe.codec(PATH).ranks)
    for text in (edge.BASE, "a  b   c \n d\t e" * 30, "日本語" * 50, " " * 99 + "x", "x" + " " * 99):
        assert ids(codec.encode(text)) == library.encode_ordinary(text)


def test_every_match_that_is_no_token_is_joined(monkeypatch, sf_docs):
    codec = byte_bpe.Codec(byte_bpe.codec(PATH).ranks)
    seen, joined = set(), set()
    bytes_of = lambda ids: b"".join(codec.bytes_of[i] for i in ids)
    match_ids, join = codec.match_ids, codec.join
    monkeypatch.setattr(codec, "match_ids", lambda m: seen.add(m.encode()) or match_ids(m))
    monkeypatch.setattr(codec, "join", lambda a, b: joined.add(bytes_of(a) + bytes_of(b)) or join(a, b))
    for row in sf_docs.collect():
        codec.encode(row["text"] or "")
    split = {m for m in seen if m not in codec.ranks}
    assert len(split) > 100 and split <= joined


def test_decoding_halves(monkeypatch, library):
    monkeypatch.setattr(byte_bpe, "LEAF_IDS", 1)
    codec = byte_bpe.codec(PATH)
    for text in ("", "a", "one two", edge.BASE, "日本語🙂" * 40):
        assert codec.decode(codec.encode(text)) == text.encode()


def test_empty_table(no_docs):
    assert byte_bpe.decode_documents(byte_bpe.encode_documents(no_docs)).count() == 0
