"""Byte-level BPE as a monoid: encode halves, join neighbours, decode by concatenation.

A token sequence is the encoding of its bytes exactly if every two neighbours are: merges run by
rank, so until a merge first crosses a border both neighbours change as they would alone. Joining
two encodings thus needs only a window around the seam: it is encoded anew and grows until its
outer borders are such pairs; nothing outside can change then. Every match that is no token is
halved down to single bytes and joined up again; short halves, which recur in many matches, are
kept, and so is what each pair of neighbours becomes.

The same holds for the pattern that cuts a text before the merges: a space directly before a
character that is no white space always starts a match, so texts are cut there.

Defined results: null text is empty text, which has no ids; every input row gives one output row;
repeated rows stay repeated; no other column of the input is read.
"""

from __future__ import annotations

import base64
import heapq
import re
import sys
from array import array
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import in_tasks, slices, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Windows up to so many bytes are merged over a list, longer ones over a heap.
LIST_BYTES = 24
#: Halves up to so many bytes are kept.
KEPT_BYTES = 6
#: Ids that decoding takes without halving them.
LEAF_IDS = 64
SPAN_CHARS = 1 << 15
#: Entries that a worker keeps of what it has encoded; beyond, it starts anew.
MEMO_CHUNKS, MEMO_MATCHES = 300_000, 400_000
#: Unicode's White_Space, as the pattern's \s means it.
SPACE = "\t-\r \x85\xa0  -     　"
SEAM = re.compile(f" (?=[^{SPACE}])")


def packed(ids: list[int]) -> bytes:
    words = array("I", ids)
    if sys.byteorder == "big":
        words.byteswap()
    return words.tobytes()


class Codec:
    """Encoder and decoder for one rank table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
        import regex

        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.pairs: dict[tuple[int, int], list[int] | None] = {}
        self.halves: dict[bytes, list[int]] = {}
        self.matches: dict[str, bytes] = {}
        self.chunks = _Chunks(self)

    def merged(self, data: bytes) -> list[int]:
        """Merges by lowest rank, leftmost first, from single bytes."""
        if len(data) > LIST_BYTES:
            return self._merged_long(data)
        get, parts = self.ranks.get, [data[i : i + 1] for i in range(len(data))]
        none = len(self.ranks)
        order = [get(data[i : i + 2], none) for i in range(len(data) - 1)]
        while order:
            rank = min(order)
            if rank == none:
                break
            i = order.index(rank)
            parts[i] += parts.pop(i + 1)
            del order[i]
            if i < len(order):
                order[i] = get(parts[i] + parts[i + 1], none)
            if i:
                order[i - 1] = get(parts[i - 1] + parts[i], none)
        return [self.ranks[p] for p in parts]

    def _merged_long(self, data: bytes) -> list[int]:
        """The same over a linked list with a heap, for windows that had to grow."""
        get, n = self.ranks.get, len(data)
        end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
        alive, heap = [True] * n, []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (rank := get(data[i : end[j]])) is not None:
                heapq.heappush(heap, (rank, i, end[i], end[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, mid, stop = heapq.heappop(heap)
            if not alive[i] or end[i] != mid or after[i] >= n or end[after[i]] != stop:
                continue
            j = after[i]
            alive[j], end[i], after[i] = False, stop, after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [self.ranks[data[i : end[i]]] for i in range(n) if alive[i]]

    def window(self, a: int, b: int) -> list[int] | None:
        """Encoding of the bytes of ``a b``; None if that is ``a b``, which are settled then."""
        found = self.pairs.get((a, b), False)
        if found is False:
            if len(self.pairs) > MEMO_MATCHES:
                self.pairs.clear()
            found = self.merged(self.bytes_of[a] + self.bytes_of[b])
            found = self.pairs[a, b] = None if found == [a, b] else found
        return found

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Encoding of the bytes of both, from their encodings."""
        if not left or not right:
            return left + right
        window = self.window(left[-1], right[0])
        if window is None:
            return left + right
        i = j = 1
        while True:
            fits_left = i == len(left) or self.window(left[-i - 1], window[0]) is None
            fits_right = j == len(right) or self.window(window[-1], right[j]) is None
            if fits_left and fits_right:
                return left[: len(left) - i] + window + right[j:]
            i = i if fits_left else min(2 * i, len(left))
            j = j if fits_right else min(2 * j, len(right))
            window = self.merged(b"".join(map(self.bytes_of.__getitem__, left[len(left) - i :] + right[:j])))

    def tree(self, data: bytes) -> list[int]:
        """Ids of bytes that the pattern does not cut: both halves encoded, then joined."""
        if len(data) < 2:
            return [self.ranks[data]] if data else []
        half = len(data) // 2
        if len(data) > KEPT_BYTES:
            return self.join(self.tree(data[:half]), self.tree(data[half:]))
        ids = self.halves.get(data)
        if ids is None:
            if len(self.halves) > MEMO_MATCHES:
                self.halves.clear()
            ids = self.halves[data] = self.join(self.tree(data[:half]), self.tree(data[half:]))
        return ids

    def match_ids(self, match: str) -> bytes:
        """Ids of one match of the pattern, as little-endian unsigned 32-bit integers."""
        data = match.encode()
        whole = self.ranks.get(data)
        return packed(self.tree(data) if whole is None else [whole])

    def encode(self, text: str) -> bytes:
        """Ids of a text, as little-endian unsigned 32-bit integers."""
        if len(text) > SPAN_CHARS:
            half = len(text) // 2
            seam = SEAM.search(text, half)
            cut = seam.start() if seam else text.rfind(" ", 1, half)
            if seam or (cut > 0 and SEAM.match(text, cut)):
                return self.encode(text[:cut]) + self.encode(text[cut:])
            return b"".join(map(self.match_ids, self.pattern.findall(text)))
        if not text:
            return b""
        if len(self.chunks) > MEMO_CHUNKS:
            self.chunks.clear()
        first, *rest = SEAM.split(text)
        # the space belongs to the chunk after it; the first chunk may have none
        head = b"".join(map(self.match_ids, self.pattern.findall(first)))
        return head + b"".join(map(self.chunks.__getitem__, rest))

    def decode(self, ids: bytes) -> bytes:
        """Bytes of ids; concatenation of the bytes of both halves, down to a few ids."""
        if len(ids) <= 4 * LEAF_IDS:
            return b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I")))
        half = len(ids) // 8 * 4
        return self.decode(ids[:half]) + self.decode(ids[half:])


class _Chunks(dict):
    """Ids by what follows one space up to the next seam; worked out on first use."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec

    def __missing__(self, chunk: str) -> bytes:
        codec, out = self.codec, []
        for match in codec.pattern.findall(" " + chunk):
            ids = codec.matches.get(match)
            if ids is None:
                if len(codec.matches) > MEMO_MATCHES:
                    codec.matches.clear()
                ids = codec.match_ids(match)
                if len(match) <= 64:
                    codec.matches[match] = ids
            out.append(ids)
        ids = b"".join(out)
        if len(chunk) <= 64:
            self[chunk] = ids
        return ids


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a rank file, one for each worker."""
    if path not in _codecs:
        with open(path, "rb") as lines:
            _codecs[path] = Codec({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})
    return _codecs[path]


def encode_batches(batches: Iterator, path: str) -> Iterator:
    c = codec(path)
    for batch in batches:
        for part in slices(batch):
            ids = [c.encode(t or "") for t in part["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(ids, pa.binary())], ["doc_id", "ids"])


def decode_batches(batches: Iterator, path: str) -> Iterator:
    c = codec(path)
    for batch in batches:
        for part in slices(batch):
            ids = part["ids"].to_pylist()
            data = pa.array([c.decode(i or b"") for i in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([part["doc_id"], part["ids"], data], ["doc_id", "ids", "decoded"])


def encode_documents(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, ids``: the ids of ``text``, packed as little-endian unsigned 32-bit integers."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(in_tasks("llm.byte_bpe", "encode_batches", path), "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, ids, decoded``: the bytes of packed ids."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(in_tasks("llm.byte_bpe", "decode_batches", path), "doc_id long, ids binary, decoded binary")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = decode_documents(encode_documents(table(spark, sf_dir, "documents")))
    return done.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
