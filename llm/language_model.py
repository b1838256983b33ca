"""Language-model scores: online logistic mixing of hashed-context bit predictors.

A text is its words (A-Z lower-cased, split at ASCII white space), each followed by a space, and
an end mark. Bytes are told bit by bit along one Huffman tree. For each bit, four predictors look
up a hash of their context (the last 2, 3 and 5 bytes of the word, and all of it so far) together
with the tree's node in tables of what followed in training. Their log-odds are added with weights
that a gate selects by how often the two longest contexts were seen; while a document is read, a
correction to the weights follows the error gradient after each run of bits, so that every bit is
predicted from earlier ones only. Where two words come together again, the word that followed them
before gets a share of the probability, as large as such words have earned so far in this text. The
score is the log10 probability of it all.

Tables are summed over all training words, from the table of word counts; they have a fixed size
whatever the corpus. Gate weights are fitted on all of these words as often as they occur, each held
out of the counts by taking its own occurrence away. The base score needs the count of every word: the
``HEAD_WORDS`` most frequent go to every task, the others meet their counts in a join.

Defined results: null text is empty text, which is the end mark alone; a repeated row is learnt
from and scored again; without training rows every bit has probability 1/2, the base score is 0
and nothing is known; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import in_tasks, remainder, slices, stored, table, words_of

HELD_OUT = 7
END = b"\n"
ORDERS = (2, 3, 5)  # and the whole word so far
TABLES = len(ORDERS) + 1
#: Bits of the places in each table, and where its places begin in the row of all.
BITS = (18, 20, 21, 22)
FIRST = tuple(sum(1 << b for b in BITS[:k]) for k in range(len(BITS)))
PLACES, BLOCK = sum(1 << b for b in BITS), 1 << 16
HEAD_WORDS = 1 << 17
WORDS_A_TASK, FAN_IN = 2_000_000, 16
#: Gate weights begin at, and are drawn weakly to, START; steps end when they promise less than SETTLED of the loss.
START, TOWARDS, SETTLED, MOST_STEPS = np.array([0.3] * TABLES), 50.0, 1e-3, 12
PAIRS = [(j, k) for j in range(TABLES) for k in range(j, TABLES)]
SUMS = ["loss", *(f"slope{k}" for k in range(TABLES)), *(f"bend{j}{k}" for j, k in PAIRS)]
#: Entries that a worker keeps of what it has worked out; beyond, it starts anew. Of the words, the most frequent stay.
MEMO, STAY, COUNTED = 110_000, 50_000, 300_000
#: Words whose bits are worked out together, and the bytes at their beginning that are looked at for being shared.
WORDS_AT_ONCE, SHARED = 1024, 32
#: Log-odds are kept in steps of 1 / STEP; counts up to 255.
STEP, PRIOR = 16, 0.4
GATES = 6 * 4
#: Gate by how often the context was seen: the whole word so far, and the last five bytes.
WHOLE_GATE = np.searchsorted(np.array([1, 2, 4, 16, 64]), np.arange(256), side="right")
FIVE_GATE = np.searchsorted(np.array([1, 4, 32]), np.arange(256), side="right")
RUN, RATE = 4096, 0.016
LN10 = math.log(10)
_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INVERSE = np.uint64(pow(int(_P), -1, 1 << 64))


class Tree:
    """Huffman tree over the 256 bytes: for each byte its nodes and bits from the root."""

    def __init__(self, weights: np.ndarray):
        heap = [(float(w) + 1, i, i) for i, w in enumerate(weights)]
        heapq.heapify(heap)
        children: dict[int, tuple[int, int]] = {}
        for new in range(256, 511):
            (a, _, left), (b, _, right) = heapq.heappop(heap), heapq.heappop(heap)
            children[new] = (left, right)
            heapq.heappush(heap, (a + b, new, new))
        paths: dict[int, list] = {}
        todo = [(510, [])]
        while todo:
            node, path = todo.pop()
            if node < 256:
                paths[node] = path
            else:
                todo += [(child, [*path, (node - 256, bit)]) for bit, child in enumerate(children[node])]
        self.length = np.array([len(paths[b]) for b in range(256)])
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]])
        flat = [step for b in range(256) for step in paths[b]]
        self.node = np.array([n for n, _ in flat], dtype=np.uint32)
        self.bit = np.array([b for _, b in flat], dtype=bool)


def spelled(words: list[bytes]) -> list[bytes]:
    return [w if w == END else w + b" " for w in words]


def contexts_of(words: list[bytes], chosen: np.ndarray | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
    """Of all bytes of spelled words, or those at ``chosen``: the byte, and a hash of its context for each predictor."""
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    at = np.arange(len(data)) if chosen is None else chosen
    first = np.repeat(np.cumsum(lengths) - lengths, lengths)[at]
    within = at - first
    value = data.astype(np.uint64) + np.uint64(1)
    contexts, window = [], np.zeros(len(at), dtype=np.uint64)
    for back in range(1, max(ORDERS) + 1):
        # 0 before the word's start
        earlier = np.where(within >= back, value[np.maximum(at - back, 0)], np.uint64(0))
        window = (window + earlier) * _P
        window ^= window >> np.uint64(29)
        if back in ORDERS:
            contexts.append(window.copy())
    powers = np.cumprod(np.full(len(data), _P))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(value * powers)])
    inverse = np.cumprod(np.full(len(data), _P_INVERSE))
    contexts.append((sums[at] - sums[first]) * inverse[first] + within.astype(np.uint64))
    return data[at], contexts


def places_of(data: np.ndarray, contexts: list[np.ndarray], tree: Tree) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of all bits of bytes in their contexts: the byte's number, the bit, and its place for each predictor."""
    size = tree.length[data]
    byte = np.repeat(np.arange(len(data)), size)
    step = np.repeat(tree.start[data] - np.cumsum(size) + size, size) + np.arange(len(byte))
    node = tree.node[step].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    places = []
    for k, context in enumerate(contexts):
        mixed = (context * np.uint64(0xA0761D6478BD642F) + np.uint64(k))[byte]
        mixed ^= node
        mixed *= np.uint64(0x165667B19E3779F9)
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xC2B2AE3D27D4EB4F)
        mixed >>= np.uint64(64 - BITS[k])
        mixed += np.uint64(FIRST[k])
        places.append(mixed.view(np.int64))
    return byte, tree.bit[step], places


def bits_of(words: list[bytes], tree: Tree) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of all bits of spelled words: the word's number, the bit, and its place for each predictor."""
    byte, bit, places = places_of(*contexts_of(words), tree)
    return np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))[byte], bit, places


def first_alike(words: list[bytes], lengths: np.ndarray) -> np.ndarray:
    """For each byte of the words: where the byte stands that ends the same beginning of a word, in the first of
    the words before that follow each other and all have it. Sorted words share most."""
    width = min(int(lengths.max()), SHARED)
    begin = np.array(words, dtype=f"S{width}").view(np.uint8).reshape(-1, width)
    same = np.zeros(begin.shape, dtype=bool)
    np.equal(begin[1:], begin[:-1], out=same[1:])
    # shorter words are filled up with zeros, which longer ones may really have
    same[1:] &= np.arange(width) < np.minimum(lengths[1:], lengths[:-1])[:, None]
    same = np.logical_and.accumulate(same, axis=1)
    word = np.maximum.accumulate(np.where(same, 0, np.arange(len(words))[:, None]), axis=0)
    start = np.cumsum(lengths) - lengths
    of = np.repeat(np.arange(len(words)), lengths)
    at = np.arange(len(of))
    within = at - start[of]
    near = np.flatnonzero(within < width)
    at[near] = start[word[of[near], within[near]]] + within[near]
    return at


class Spelled:
    """The bits of spelled words, those of bytes up to which words begin alike only once.

    ``byte`` is the number of each bit's byte among those that are kept, ``bit`` and ``places`` are as
    ``bits_of`` has them; ``like`` leads from the bytes of all words to the kept ones.
    """

    def __init__(self, words: list[bytes], tree: Tree):
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        like = first_alike(words, self.lengths)
        fresh = like == np.arange(len(like))
        data, contexts = contexts_of(words, np.flatnonzero(fresh))
        self.byte, self.bit, self.places = places_of(data, contexts, tree)
        self.like = (np.cumsum(fresh) - 1)[like]
        self.size = tree.length[data]

    def summed(self, n: np.ndarray) -> np.ndarray:
        """For each kept bit, how often it occurs in words that occur ``n`` times."""
        return np.bincount(self.like, np.repeat(n, self.lengths)).astype(np.float32)[self.byte]

    def all_bits(self) -> tuple[np.ndarray, np.ndarray]:
        """Of all words, where each bit stands among the kept ones, and where the bits of each word end."""
        sizes, begin = self.size[self.like], (np.cumsum(self.size) - self.size)[self.like]
        past = np.cumsum(sizes)
        return np.repeat(begin - past + sizes, sizes) + np.arange(past[-1]), past[np.cumsum(self.lengths) - 1]


def count_batches(batches: Iterator) -> Iterator:
    """Counts of words as far as one task's memory goes; the same word may come again."""
    counts: Counter = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(counts.keys()), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for part in slices(batch, 64):
            for text in part["text"].to_pylist():
                counts.update(words_of(text))
                counts[END] += 1
            if len(counts) > COUNTED:
                yield out()
                counts.clear()
    if counts:
        yield out()


def byte_batches(batches: Iterator) -> Iterator:
    """How often each byte occurs in counted words."""
    total = np.zeros(256)
    for batch in batches:
        for part in slices(batch, 65536):
            words = spelled(part["word"].to_pylist())
            n = np.array(part["n"].to_pylist(), dtype=np.float64)
            weights = np.repeat(n, np.fromiter(map(len, words), np.int64, len(words)))
            total += np.bincount(np.frombuffer(b"".join(words), np.uint8), weights, minlength=256)
    yield pa.RecordBatch.from_arrays([pa.array(range(256), pa.int32()), pa.array(total)], ["byte", "n"])


def table_batches(batches: Iterator, tree: Tree) -> Iterator:
    """Counts of zeros and ones by place, in blocks; only blocks that have any."""
    from pyspark import TaskContext

    seen = np.zeros((2, PLACES), dtype=np.float32)
    flat = seen.reshape(-1)
    for batch in batches:
        for part in slices(batch.take(pc.sort_indices(batch["word"])), WORDS_AT_ONCE):
            told = Spelled(spelled(part["word"].to_pylist()), tree)
            weight = told.summed(np.array(part["n"].to_pylist(), dtype=np.float64))
            ones = told.bit * PLACES
            for place in told.places:
                np.add.at(flat, place + ones, weight)
    task = TaskContext.get().partitionId()
    for block in range(PLACES // BLOCK):
        counts = seen[:, block * BLOCK : (block + 1) * BLOCK]
        if counts.any():
            columns = [pa.array([task], pa.int32()), pa.array([block], pa.int32()), pa.array([counts.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["task", "block", "counts"])


def add_blocks(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(c, np.float32) for c in group["counts"].to_pylist())
    return pa.table({"task": pa.array([group["task"][0].as_py() // FAN_IN], pa.int32()), "block": group["block"][:1], "counts": pa.array([total.tobytes()], pa.binary())})


def odds_batches(batches: Iterator) -> Iterator:
    """Log-odds of a one, in steps, and counts up to 255."""
    for batch in batches:
        for row in batch.to_pylist():
            zeros, ones = np.frombuffer(row["counts"], np.float32).reshape(2, -1)
            odds = np.clip(np.rint(STEP * np.log((ones + PRIOR) / (zeros + PRIOR))), -127, 127).astype(np.int8)
            seen = np.minimum(zeros + ones, 255).astype(np.uint8)
            columns = [pa.array([row["block"]], pa.int32()), pa.array([odds.tobytes()], pa.binary()), pa.array([seen.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["block", "odds", "seen"])


def _fewer() -> np.ndarray:
    """By log-odds of the bit that came, in steps from -127, and by count: the log-odds with one such bit less."""
    odds = np.arange(-127, 128, dtype=np.float64)[:, None] / STEP
    n = np.arange(256, dtype=np.float64)[None, :]
    share = 1 / (1 + np.exp(-odds)) * (n + 2 * PRIOR) - PRIOR
    fewer = np.log(np.maximum(share - 1, 0) + PRIOR) - np.log(np.maximum(n - share, 0) + PRIOR)
    return np.where(n < 255, fewer, odds).astype(np.float32)


FEWER = _fewer()


class Model:
    """The tree, the tables (log-odds and counts side by side, so that one look finds both) and the gate weights."""

    def __init__(self, tree: Tree, odds: np.ndarray, seen: np.ndarray):
        self.tree, self.told = tree, np.stack([odds.view(np.uint8), seen], axis=1)
        self.weights = np.tile(START, (GATES, 1)).astype(np.float32)

    @property
    def odds(self) -> np.ndarray:
        return self.told[:, 0].view(np.int8)

    @property
    def seen(self) -> np.ndarray:
        return self.told[:, 1]

    def look(self, places: list[np.ndarray], bit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each predictor the log-odds of the bit that came, in steps, and the count."""
        sign, both = np.where(bit, np.int8(1), np.int8(-1)), self.told.view(np.uint16)[:, 0]
        for place in places:
            found = both[place].view(np.uint8).reshape(-1, 2)
            yield found[:, 0].view(np.int8) * sign, found[:, 1]

    def looked_up(self, bit: np.ndarray, places: list[np.ndarray], own: bool) -> tuple[np.ndarray, np.ndarray]:
        """Of bits in their places, the predictors' log-odds of the bit that came, and the gate."""
        x = np.empty((len(bit), TABLES), dtype=np.float32)
        seen = []
        for k, (odds, n) in enumerate(self.look(places, bit)):
            if own:
                x[:, k] = FEWER.reshape(-1)[(odds.astype(np.int32) + 127) * 256 + n]
                n = np.maximum(n, 1) - np.uint8(1)
            else:
                x[:, k] = odds.astype(np.float32) / STEP
            seen.append(n)
        return x, WHOLE_GATE[seen[-1]] * 4 + FIVE_GATE[seen[-2]]

    def inputs(self, words: list[bytes], own: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all bits of spelled words: the word's number, the predictors' log-odds of the bit that
        came, and the gate. ``own``: one occurrence of each word taken out of the counts."""
        of, bit, places = bits_of(words, self.tree)
        return of, *self.looked_up(bit, places, own)

    def slopes(self, words: list[bytes], n: np.ndarray) -> np.ndarray:
        """Of each gate's weights over words that occur ``n`` times: loss in nats, its slope and its curvature (``SUMS``)."""
        told = Spelled(spelled(words), self.tree)
        x, gate = self.looked_up(told.bit, told.places, own=True)
        order = np.argsort(gate.astype(np.uint8), kind="stable")
        x, n, ends = x[order], told.summed(n)[order], np.cumsum(np.bincount(gate, minlength=GATES))
        out = np.zeros((GATES, len(SUMS)))
        for g in np.flatnonzero(np.diff(ends, prepend=0)):
            at = slice(ends[g - 1] if g else 0, ends[g])
            mix = x[at] @ self.weights[g]
            fall = np.exp(np.clip(-mix, -60, 60))
            down = n[at] * (fall / (1 + fall))
            bend = (x[at] * (down / (1 + fall))[:, None]).T @ x[at]
            out[g] = [n[at] @ np.log1p(fall), *(down @ x[at]), *(bend[j, k] for j, k in PAIRS)]
        return out

    def records(self, words: list[bytes]) -> list[bytes]:
        """For each word, its bits' log-odds and their mix, packed (``RECORD``)."""
        told = Spelled(spelled(words), self.tree)
        x = np.empty((len(told.bit), TABLES), dtype=np.int8)
        seen = []
        for k, (odds, n) in enumerate(self.look(told.places, told.bit)):
            x[:, k] = odds
            seen.append(n)
        gate = WHOLE_GATE[seen[-1]] * 4 + FIVE_GATE[seen[-2]]
        out = np.empty(len(x), dtype=RECORD)
        out["x"] = x
        out["mix"] = np.einsum("ij,ij->i", x.astype(np.float32), self.weights[gate]) / STEP
        bits, ends = told.all_bits()
        packed, ends = out.view(np.int64)[bits].tobytes(), (ends * RECORD.itemsize).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]


#: Two numbers of four bytes, so that either is taken out of many records at once.
RECORD = np.dtype([("x", np.int8, TABLES), ("mix", np.float32)])
#: What a repeated pair begins with by how long repeats have gone on: successes and trials.
GOOD, TRIED = np.array([0.1, 0.8, 1.6, 2.4]), np.array([1.0, 1.2, 2.0, 2.6])


def repeats(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a text of numbered words, where the two words before came together earlier: the position, whether
    the word that followed then comes again, and for how many words that has gone on (up to 3)."""
    # 0 before the text
    before = np.concatenate([[0, 0], ids + 1])
    kinds, shift = int(before.max()) + 1, len(ids).bit_length()
    pair = before[:-2] * kinds + before[1:-1]
    if kinds * kinds << shift < 1 << 63:
        # numbers that hold their positions sort faster than positions by numbers
        pair = np.sort(pair << shift | np.arange(len(ids)))
        order = pair & (1 << shift) - 1
        pair >>= shift
    else:
        order = np.argsort(pair, kind="stable")
        pair = pair[order]
    same = pair[1:] == pair[:-1]
    last = np.full(len(ids), -1)
    last[order[1:][same]] = order[:-1][same]
    at = np.flatnonzero(last >= 0)
    again = np.zeros(len(ids) + 3, dtype=np.int64)
    again[at + 3] = ids[at] == ids[last[at]]
    one = again[2:-1]
    two = one * again[1:-2]
    return at, again[at + 3], (one + two + two * again[:-3])[at]


def shares(hit: np.ndarray, going: np.ndarray) -> np.ndarray:
    """The share of each repeated pair: successes over trials of those before it that had gone on for as long."""
    order = np.argsort(going.astype(np.uint8), kind="stable")
    came, kind, out = hit[order], going[order], np.empty(len(hit))
    tries = np.bincount(going, minlength=len(GOOD))
    first = np.repeat(np.cumsum(tries) - tries, tries)
    came_before = np.append(0, np.cumsum(came))
    since = came_before[1:] - came_before[first]
    out[order] = (GOOD[kind] + since - came) / (TRIED[kind] + (np.arange(len(hit)) - first))
    return out


def log10_probability(words: list[bytes], records: list[bytes]) -> float:
    """Of a document's words, the end mark included, with their packed bits."""
    distinct = dict.fromkeys(words)
    number = dict(zip(distinct, range(len(distinct))))
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    return numbered_probability(ids, b"".join(records), np.fromiter(map(len, records), np.int64, len(records)))


def numbered_probability(ids: np.ndarray, packed: bytes, lengths: np.ndarray) -> float:
    """The same of numbered words, their records run together, and the lengths of these.

    Weights are corrected after each run of bits. What followed an earlier occurrence of the last
    two words gets a share of the probability that follows its success in this document so far.
    """
    both = np.frombuffer(packed, dtype=np.int32).reshape(-1, 2)
    xs = both[:, 0].copy().view(np.int8).reshape(-1, TABLES)
    falls = both[:, 1].copy().view(np.float32)
    change = None
    for start in range(0, len(falls), RUN):
        fall = falls[start : start + RUN]
        more = start + RUN < len(falls)
        x = xs[start : start + RUN].astype(np.float32) if more or change is not None else None
        if change is not None:
            fall += x @ change
        if fall.min() < -60:
            np.maximum(fall, np.float32(-60), out=fall)
        np.exp(np.negative(fall, out=fall), out=fall)
        whole = fall + np.float32(1)
        if more:
            fall /= whole
            step = np.float32(RATE / STEP**2 / np.sqrt(len(fall))) * (fall @ x)
            change = step if change is None else change + step
        np.log(whole, out=fall)
    each = np.add.reduceat(falls, (np.cumsum(lengths) - lengths) // RECORD.itemsize).astype(np.float64)
    at, hit, going = repeats(ids)
    if len(at):
        share, own = shares(hit, going), each[at]
        miss = 1 - share
        each[at] = np.where(hit, -np.log(share + miss * np.exp(-own)), own - np.log(miss))
    return -float(each.sum()) / LN10


class Known:
    """Words that a worker has worked out: their numbers, and by number the records, these' lengths and the head's logarithms."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {}
        self.records: list[bytes] = []
        self.lengths = np.zeros(0, np.int64)
        self.logs = np.zeros(0)

    def add(self, words: list[bytes], model: Model, head: dict[bytes, float]) -> None:
        found = []
        words = sorted(words)
        for at in range(0, len(words), WORDS_AT_ONCE):
            found += model.records(words[at : at + WORDS_AT_ONCE])
        self.numbers.update(zip(words, range(len(self.records), len(self.records) + len(words))))
        self.records += found
        self.lengths = np.append(self.lengths, np.fromiter(map(len, found), np.int64, len(found)))
        self.logs = np.append(self.logs, np.array([head.get(w, np.nan) for w in words], dtype=np.float64))

    def find(self, words: list[bytes]) -> np.ndarray:
        """The numbers of words, -1 for those that are not known."""
        return np.fromiter(map(self.numbers.get, words, repeat(-1)), np.int64, len(words))

    def only(self, head: dict[bytes, float]) -> Known:
        """What is known of the most frequent words, which come again soon."""
        logs, kept, words = np.fromiter(head.values(), np.float64, len(head)), Known(), list(self.numbers)
        at = np.flatnonzero(self.logs > (-np.inf if len(logs) <= STAY else np.partition(logs, -STAY - 1)[-STAY - 1]))
        kept.numbers = {words[i]: number for number, i in enumerate(at.tolist())}
        kept.records = [self.records[i] for i in at.tolist()]
        kept.lengths, kept.logs = self.lengths[at], self.logs[at]
        return kept


_memo: dict[int, Known] = {}


def score_batches(batches: Iterator, model: Model, head: dict[bytes, float], stamp: int) -> Iterator:
    """Scores, what the head tells of the base score, and the words that it lacks."""
    from pyspark import TaskContext

    key = TaskContext.get().partitionId() << 40
    for old in [k for k in _memo if k != stamp]:
        del _memo[old]
    known = _memo.setdefault(stamp, Known())
    for batch in batches:
        for part in slices(batch, 128):
            texts = [[*words_of(t), END] for t in part["text"].to_pylist()]
            words = list(chain.from_iterable(texts))
            ids = known.find(words)
            if len(ids) and ids.min() < 0:
                if len(known.numbers) > MEMO:
                    known = _memo[stamp] = known.only(head)
                    ids = known.find(words)
                absent = np.flatnonzero(ids < 0)
                new = list(map(words.__getitem__, absent.tolist()))
                known.add(list(set(new)), model, head)
                ids[absent] = known.find(new)
            lengths, logs, numbers = known.lengths[ids], known.logs[ids], ids.tolist()
            rows, end = [], 0
            for told in texts:
                start, end = end, end + len(told)
                packed = b"".join(map(known.records.__getitem__, numbers[start:end]))
                score = numbered_probability(ids[start:end], packed, lengths[start:end])
                # the end mark is counted apart
                mine = logs[start : end - 1]
                absent = np.flatnonzero(np.isnan(mine))
                tail = [told[i] for i in absent]
                rows.append((key, len(told), len(mine) - len(tail), float(np.nansum(mine)), score, tail))
                key += 1
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary())]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([part["doc_id"], *columns], ["doc_id", "key", "n_tokens", "n_head", "head_sum", "score", "tail"])


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` over all rows; the end mark counts once for each."""
    partial = docs.select("text").mapInArrow(in_tasks("llm.language_model", "count_batches"), "word binary, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def fit_model(counts: DataFrame) -> Model:
    """Tables and gate weights from stored word counts."""
    rows = counts.agg(F.count("*")).first()[0]
    task = lambda name, *args: in_tasks("llm.language_model", name, *args)
    spread = counts.coalesce(rows // WORDS_A_TASK + 1)
    weights = np.zeros(256)
    for row in spread.mapInArrow(task("byte_batches"), "byte int, n double").groupBy("byte").agg(F.sum("n").alias("n")).collect():
        weights[row["byte"]] = row["n"]
    tree = Tree(weights)
    kind = "task int, block int, counts binary"
    blocks = stored(spread.mapInArrow(task("table_batches", tree), kind), "tables")
    tasks = rows // WORDS_A_TASK + 1
    while tasks > 1:
        up = F.floor(F.col("task") / FAN_IN)
        blocks = stored(blocks.groupBy(up.alias("up"), "block").applyInArrow(task("add_blocks"), kind), "tables")
        tasks = -(-tasks // FAN_IN)
    odds, seen = np.zeros(PLACES, np.int8), np.zeros(PLACES, np.uint8)
    for row in blocks.mapInArrow(task("odds_batches"), "block int, odds binary, seen binary").toLocalIterator():
        at = slice(row["block"] * BLOCK, (row["block"] + 1) * BLOCK)
        odds[at], seen[at] = np.frombuffer(row["odds"], np.int8), np.frombuffer(row["seen"], np.uint8)
    model = Model(tree, odds, seen)
    return fit_gates(model, counts) if rows else model


def slope_batches(batches: Iterator, model: Model) -> Iterator:
    """Sums of ``Model.slopes`` over all words of a task."""
    total = np.zeros((GATES, len(SUMS)))
    for batch in batches:
        for part in slices(batch.take(pc.sort_indices(batch["word"])), WORDS_AT_ONCE):
            total += model.slopes(part["word"].to_pylist(), np.array(part["n"].to_pylist(), dtype=np.float64))
    yield pa.RecordBatch.from_arrays([pa.array(range(GATES), pa.int32()), *map(pa.array, total.T)], ["gate", *SUMS])


def fit_gates(model: Model, counts: DataFrame) -> Model:
    """Gate weights by Newton's steps, each over every word as often as it occurs.

    A gate has weights of its own, so each is fitted alone; a step that made its loss rise is halved. The
    driver sees the sums of each gate, a fixed number of them.
    """
    kind = ", ".join(["gate int", *(f"{name} double" for name in SUMS)])
    best = np.full(GATES, np.inf)
    good = model.weights.copy()
    for _ in range(MOST_STEPS):
        sums = np.zeros((GATES, len(SUMS)))
        found = counts.mapInArrow(in_tasks("llm.language_model", "slope_batches", model), kind)
        for row in found.groupBy("gate").agg(*(F.sum(name).alias(name) for name in SUMS)).collect():
            sums[row["gate"]] = [row[name] for name in SUMS]
        weights = model.weights.astype(np.float64)
        loss = sums[:, 0] + TOWARDS / 2 * ((weights - START) ** 2).sum(1)
        # sums differ a little by their order
        nearer = loss <= best * (1 + 1e-5)
        bend = np.zeros((GATES, TABLES, TABLES))
        for i, (j, k) in enumerate(PAIRS):
            bend[:, j, k] = bend[:, k, j] = sums[:, 1 + TABLES + i]
        slope = sums[:, 1 : 1 + TABLES] - TOWARDS * (weights - START)
        step = np.linalg.solve(bend + TOWARDS * np.eye(TABLES), slope[:, :, None])[:, :, 0]
        after = np.where(nearer[:, None], weights + step, (weights + good) / 2).astype(np.float32)
        good[nearer], best = model.weights[nearer], np.minimum(loss, best)
        # seldom used gates need not settle as closely as others; the last step still counts
        gain = np.where(nearer, (step * slope).sum(1) / 2, 0).sum()
        settled = nearer.all() and gain < SETTLED * loss.sum()
        model.weights = after
        if settled:
            break
    return model


def score_documents(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every row, from stored counts."""
    model = fit_model(counts)
    size, vocabulary = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    level = F.floor(4 * F.log2("n"))
    left, least = HEAD_WORDS, None
    for row in counts.groupBy(level.alias("level")).agg(F.count("*").alias("n"), F.min("n").alias("least")).orderBy(F.desc("level")).collect():
        left -= row["n"]
        if left < 0:
            break
        least = row["least"]
    head = {} if least is None else {bytes(r["word"]): float(np.log10(r["n"] + 1)) for r in counts.where(F.col("n") >= least).collect()}
    end = counts.where(F.col("word") == F.lit(bytearray(END))).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    stamp = zlib.crc32(model.weights.tobytes(), zlib.crc32(model.told))
    call = in_tasks("llm.language_model", "score_batches", model, head, stamp)
    kind = "doc_id long, key long, n_tokens long, n_head long, head_sum double, score double, tail array<binary>"
    scored = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(call, kind), "scored")
    rare = counts if least is None else counts.where(F.col("n") < least)
    tail = scored.select("key", F.explode("tail").alias("word")).join(rare, "word")
    tail = tail.groupBy("key").agg(F.sum(F.log10(F.col("n") + 1)).alias("tail_sum"), F.count("*").alias("n_tail"))
    total = float(np.log10(size + vocabulary + 1))
    none = F.lit(0)
    return scored.join(tail, "key", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_head") + F.coalesce("n_tail", none) + int(end > 0)).cast("long").alias("n_known"),
        F.lit(size).cast("long").alias("train_tokens"),
        (F.col("head_sum") + F.coalesce("tail_sum", F.lit(0.0)) + float(np.log10(end + 1)) - F.col("n_tokens") * total).alias("base_score"),
        "score",
    )


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    held_out: Column = remainder("doc_id", HELD_OUT) == 2
    counts = stored(word_counts(docs.where(~held_out)), "word-counts")
    return score_documents(docs, counts).withColumn("held_out", held_out)
