"""Language model: base scores by brute force, probabilities that add up, awkward rows."""

import math
import zlib
from collections import Counter

import numpy as np

from llm import language_model as lm
from llm.common import stored, words_of


def check(rows, docs, train):
    counts = Counter()
    for i, text in docs:
        if train(i):
            counts.update([*words_of(text), None])
    total, distinct = sum(counts.values()), len(counts)
    want = Counter()
    for i, text in docs:
        tokens = [*words_of(text), None]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens)
        want[i, len(tokens), sum(counts[w] > 0 for w in tokens), total, round(base, 4)] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in rows) == want
    assert all(r["score"] < 0 for r in rows)


def test_documents(spark, sf_dir, sf_docs, monkeypatch):
    docs = [(r["doc_id"], r["text"]) for r in sf_docs.collect()]
    train = lambda i: zlib.crc32(str(i).encode()) % 7 != 2
    for head in (lm.HEAD_WORDS, 50):
        monkeypatch.setattr(lm, "HEAD_WORDS", head)
        rows = lm.op9_language_model(spark, sf_dir).collect()
        assert all(r["held_out"] != train(r["doc_id"]) for r in rows)
        check(rows, docs, train)
    size = {i: sum(len(w) + 1 for w in words_of(t)) + 1 for i, t in docs}
    unseen = [r for r in rows if r["held_out"]]
    assert -sum(r["score"] for r in unseen) * math.log2(10) < 3 * sum(size[r["doc_id"]] for r in unseen)


def test_edge_rows(spark, edge_docs, no_docs):
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    counts = stored(lm.word_counts(edge_docs), "counts")
    check(lm.score_documents(edge_docs, counts).collect(), docs, lambda i: True)
    assert lm.score_documents(no_docs, counts).count() == 0
    nothing = stored(lm.word_counts(no_docs), "counts")
    rows = lm.score_documents(edge_docs, nothing).collect()
    assert len(rows) == len(docs) and all(r["base_score"] == 0 and r["n_known"] == 0 for r in rows)


def small_model():
    words = [b"the", b"then", b"cat", b"cats", b"sat", lm.END]
    rng = np.random.default_rng(3)
    odds = rng.integers(-40, 40, lm.PLACES).astype(np.int8)
    seen = rng.integers(0, 9, lm.PLACES).astype(np.uint8)
    return lm.Model(lm.Tree(np.bincount(list(b"".join(words)), minlength=256)), odds, seen), words


def test_next_bytes_add_up_to_one():
    model, _ = small_model()
    for before in (b"", b"th", b"caterpill"):
        total = 0.0
        for byte in range(256):
            of, x, gate = model.inputs([before + bytes([byte])])
            mix = (x * model.weights[gate]).sum(1).astype(float)
            skip = model.inputs([before])[1].shape[0] if before else 0
            total += math.exp(-np.log1p(np.exp(-mix[skip:])).sum())
        assert abs(total - 1) < 1e-4


def test_repeated_pairs_earn_probability():
    model, words = small_model()
    records = dict(zip(words, model.records(words)))
    score = lambda text: lm.log10_probability(text, [records[w] for w in text])
    once = score([b"the", b"cat", b"sat"])
    assert score([b"the", b"cat", b"sat"] * 20) > 12 * once
    plain = -sum(np.log1p(np.exp(-np.frombuffer(records[w], lm.RECORD)["mix"].astype(float))).sum() for w in (b"the", b"cat")) / math.log(10)
    assert abs(score([b"the", b"cat"]) - plain) < 1e-4


def test_places_follow_contexts_only():
    model, _ = small_model()
    _, _, one = lm.bits_of([b"abcdef "], model.tree)
    of, _, two = lm.bits_of([b"zz ", b"abcdef ", lm.END], model.tree)
    for a, b in zip(one, two):
        assert a.tolist() == b[of == 1].tolist()


class Plain:
    """The score bit by bit, with Python integers and dictionaries."""

    def __init__(self, tree):
        self.tree, self.full = tree, (1 << 64) - 1
        self.counts = {}

    def bits(self, word):
        """``bit, places`` of a word with its space."""
        value = [b + 1 for b in (word if word == lm.END else word + b" ")]
        p = int(lm._P)
        for at, v in enumerate(value):
            contexts, window = [], 0
            for back in range(1, 6):
                window = (window + (value[at - back] if at >= back else 0)) * p & self.full
                window ^= window >> 29
                if back in lm.ORDERS:
                    contexts.append(window)
            contexts.append(sum(x * pow(p, i, 1 << 64) for i, x in enumerate(value[:at])) + at)
            start = int(self.tree.start[v - 1])
            for step in range(start, start + int(self.tree.length[v - 1])):
                places = []
                for k, context in enumerate(contexts):
                    mixed = (context * 0xA0761D6478BD642F + k) & self.full ^ int(self.tree.node[step]) * 0xD6E8FEB86659FD93 & self.full
                    mixed = mixed * 0x165667B19E3779F9 & self.full
                    mixed = (mixed ^ mixed >> 32) * 0xC2B2AE3D27D4EB4F & self.full
                    places.append((mixed >> 64 - lm.BITS[k]) + lm.FIRST[k])
                yield bool(self.tree.bit[step]), places

    def learn(self, counts):
        for word, n in counts.items():
            for bit, places in self.bits(word):
                for place in places:
                    self.counts.setdefault(place, [0, 0])[bit] += n

    def known(self, place):
        zeros, ones = self.counts.get(place, (0, 0))
        odds = lm.STEP * math.log((ones + lm.PRIOR) / (zeros + lm.PRIOR))
        return max(-127, min(127, round(odds))), min(zeros + ones, 255)

    def score(self, words, weights, run):
        change, inside, costs = [0.0] * lm.TABLES, [], []
        for word in words:
            costs.append(0.0)
            for bit, places in self.bits(word):
                told = [self.known(place) for place in places]
                x = [odds if bit else -odds for odds, _ in told]
                gate = lm.WHOLE_GATE[told[-1][1]] * 4 + lm.FIVE_GATE[told[-2][1]]
                mix = sum(a * float(b) for a, b in zip(x, weights[gate])) / lm.STEP + sum(a * b for a, b in zip(x, change))
                costs[-1] += math.log1p(math.exp(-mix))
                inside.append((x, 1 / (1 + math.exp(mix))))
                if len(inside) == run:
                    rate = lm.RATE / lm.STEP**2 / math.sqrt(run)
                    change = [c + rate * sum(miss * x[k] for x, miss in inside) for k, c in enumerate(change)]
                    inside = []
        good, tries, going, after, total = [0.1, 0.8, 1.6, 2.4], [1.0, 1.2, 2.0, 2.6], 0, {}, 0.0
        for i, word in enumerate(words):
            pair = tuple([None, None, *words][i : i + 2])
            if pair in after:
                share, came = good[going] / tries[going], after[pair] == word
                total += math.log(share + (1 - share) * math.exp(-costs[i])) if came else math.log(1 - share) - costs[i]
                good[going] += came
                tries[going] += 1
                going = min(going + 1, 3) if came else 0
            else:
                total, going = total - costs[i], 0
            after[pair] = word
        return total / math.log(10)


def test_scores_by_brute_force(spark, sf_docs, monkeypatch):
    """Tables and scores of real texts against loops over bits, with the run of bits as it is and a short one."""
    some = [(r["doc_id"], r["text"]) for r in sf_docs.orderBy("doc_id").limit(14).collect()]
    some += [(-1, None), (-2, "the the the the the the"), (-3, "Éa b　c é" * 9)]
    docs = spark.createDataFrame(some, "doc_id long, text string").repartition(3)
    train = docs.where("doc_id <> -3 AND doc_id % 3 <> 0")
    counts = stored(lm.word_counts(train), "counts")
    model = lm.fit_model(counts)
    plain = Plain(model.tree)
    plain.learn({bytes(r["word"]): r["n"] for r in counts.collect()})
    at = sorted(plain.counts)
    assert np.nonzero(model.seen)[0].tolist() == at
    assert [(int(model.odds[p]), int(model.seen[p])) for p in at] == [plain.known(p) for p in at]
    words = {i: [*words_of(t), lm.END] for i, t in some}
    found = {r["doc_id"]: r["score"] for r in lm.score_documents(docs, counts).collect()}
    assert found.keys() == words.keys()
    for i, told in words.items():
        want = plain.score(told, model.weights, lm.RUN)
        assert abs(found[i] - want) < 1e-3 * abs(want) + 1e-3
    # a run this short corrects the weights within a few words; scores change, and still agree
    monkeypatch.setattr(lm, "RUN", 48)
    for i, told in words.items():
        want = plain.score(told, model.weights, 48)
        assert abs(lm.log10_probability(told, model.records(told)) - want) < 1e-3 * abs(want) + 1e-3


def test_gates_are_fitted_on_all_words(spark, monkeypatch):
    """Sums of slopes against a loop over bits; weights settle where every word, as often as it occurs, puts them."""
    rng = np.random.default_rng(5)
    texts = [" ".join("".join(chr(97 + c) for c in rng.integers(0, 4, rng.integers(1, 5))) for _ in range(60)) for _ in range(12)]
    counts = stored(lm.word_counts(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)), "counts")
    told = {bytes(r["word"]): r["n"] for r in counts.collect()}
    monkeypatch.setattr(lm, "SETTLED", 1e-9)
    model = lm.fit_model(counts)
    loss, slope = np.zeros(lm.GATES), np.zeros((lm.GATES, lm.TABLES))
    for word, n in told.items():
        _, x, gates = model.inputs(lm.spelled([word]), own=True)
        for row, g in zip(x.astype(float), gates):
            mix = float(row @ model.weights[g].astype(float))
            loss[g] += n * math.log1p(math.exp(-mix))
            slope[g] += n * row / (1 + math.exp(mix))
    words = sorted(told)
    sums = model.slopes(words, np.array([told[w] for w in words], dtype=float))
    assert np.allclose(sums[:, 0], loss, rtol=1e-4) and np.allclose(sums[:, 1 : 1 + lm.TABLES], slope, rtol=1e-3, atol=1e-2)
    assert loss.sum() > 0
    # no word is left out of the sums that the weights settle on
    assert np.abs(slope - lm.TOWARDS * (model.weights - lm.START)).max() < 1e-3 * sum(told.values())
    part = model.slopes(words[::2], np.array([told[w] for w in words[::2]], dtype=float))[:, 1 : 1 + lm.TABLES]
    assert np.abs(part - lm.TOWARDS * (model.weights - lm.START)).max() > 1e-3 * sum(told.values())


def test_repeats_against_a_loop():
    rng = np.random.default_rng(8)
    for size, kinds in ((1, 1), (2, 1), (40, 1), (300, 4), (300, 60)):
        ids = rng.integers(0, kinds, size)
        if size == 300:
            ids[150:250] = ids[20:120]
        want, last, one, two, going = [], {}, None, None, 0
        for i, word in enumerate(ids.tolist()):
            before = last.get((one, two))
            if before is None:
                going = 0
            else:
                want.append((i, before == word, going))
                going = min(going + 1, 3) if before == word else 0
            last[one, two] = word
            one, two = two, word
        assert [(a, bool(b), c) for a, b, c in zip(*(v.tolist() for v in lm.repeats(ids)))] == want


def test_words_that_begin_alike_share_their_bits():
    """In any order, with bytes of zero and beyond the bytes that are compared; every byte is worked out once."""
    model, words = small_model()
    words = [b"", b"a", b"a\0", b"a\0\0", b"ab", b"x" * 31, b"x" * 32, b"x" * 33, b"x" * 32 + b"y", b"x" * 80, *words]
    alone = [model.records([w])[0] for w in words]
    for order in (range(len(words)), sorted(range(len(words)), key=words.__getitem__), range(len(words) - 1, -1, -1)):
        assert model.records([words[i] for i in order]) == [alone[i] for i in order]
    told = lm.Spelled(lm.spelled([b"stand", b"standing", b"standings"]), model.tree)
    assert len(told.size) == len("stand ") + len("ing ") + len("s ")
    bits, ends = told.all_bits()
    for k, place in enumerate(lm.bits_of(lm.spelled([b"stand", b"standing", b"standings"]), model.tree)[2]):
        assert told.places[k][bits].tolist() == place.tolist()
    assert ends[-1] == len(bits)


def test_frequent_words_are_worked_out_once(monkeypatch):
    """What a worker forgets are words outside the head only, and scores stay the same."""
    import pyarrow as pa
    from pyspark import TaskContext

    model, _ = small_model()
    head = {b"the": 2.0, b"cat": 1.5}
    texts = [f"The cat sat{i} on{i} {'the ' * (i % 3)}mat{i}" for i in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(texts)], ["doc_id", "text"])
    monkeypatch.setattr(TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    worked, records = Counter(), model.records

    def count(words):
        worked.update(words)
        return records(words)

    model.records = count
    found = {}
    for memo in (lm.MEMO, 5):
        monkeypatch.setattr(lm, "MEMO", memo)
        lm._memo.clear()
        worked.clear()
        found[memo] = [b.to_pydict() for b in lm.score_batches(iter([batch]), model, head, 1)]
        assert worked[b"the"] == worked[b"cat"] == 1
    assert found[5] == found[max(found)]
    assert worked[lm.END] == 3  # a word outside the head, once for each part of 128 documents
    lm._memo.clear()


def test_shares_against_a_loop():
    rng = np.random.default_rng(9)
    for size in (1, 7, 400):
        hit, going = rng.integers(0, 2, size), rng.integers(0, 4, size)
        good, tried, want = lm.GOOD.copy(), lm.TRIED.copy(), []
        for h, g in zip(hit, going):
            want.append(good[g] / tried[g])
            good[g] += h
            tried[g] += 1
        assert np.allclose(lm.shares(hit, going), want)
