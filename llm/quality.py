"""Quality classifier: a factorisation machine over hashed words, structure and length.

Inputs of a text are its distinct words, hashed, each with weight 1/sqrt(their number), and one
step of each structure statistic (shares of byte classes, repeated neighbours, distinct words,
line and text lengths). The score is the logistic of w0 + sum w_j x_j + the low-rank interactions
of all pairs, which the identity sum_{i<j} <v_i, v_j> x_i x_j = (|sum v_j x_j|^2 - sum |v_j x_j|^2) / 2
gives in linear time. Labels, lang, source and doc_id are never inputs.

The model is fitted on the driver on at most ``SAMPLE_ROWS`` labelled rows, chosen by a hash of
their id; every text is scored whole, in tasks.

Defined results: null text is empty text and gets the score of its (empty) structure; a repeated
row is scored again; without usable labels every score is 0.5; label rows without a document, or
with a null label, are not used; several labels of one document all count.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import in_tasks, remainder, slices, table, words_of

SAMPLE_ROWS = 6000
HELD_OUT, THRESHOLD = 5, 0.3
WORD_BITS, STEPS, FACTORS = 15, 16, 8
EPOCHS, BATCH, RATE, DECAY = 8, 32, 0.05, 1e-5
#: Byte classes: letters in upper and lower case, digits, white space, end of line, sentence
#: marks, then every other ASCII character by itself (as far as there are steps), other bytes.
CLASSES = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " \t", "\n\r", ".,;:'-", '"()[]', "!?", "|", "#$%&*+=<>@^_`~/\\{}"]
_CLASS_OF = np.full(256, len(CLASSES), dtype=np.int64)
for _i, _chars in enumerate(CLASSES):
    _CLASS_OF[list(_chars.encode())] = _i
STATISTICS = len(CLASSES) + 1 + 6
SIZE = (1 << WORD_BITS) + STATISTICS * STEPS


def _step(share: float) -> int:
    """Steps of a share of 1: 0 for none, then one for each halving from 1 down to 2^-14."""
    return 0 if share <= 0 else max(1, 15 - int(-np.log2(min(share, 1.0))))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of a text's inputs."""
    data, words = (text or "").encode(), words_of(text)
    n, count = len(data), len(words)
    shares = np.bincount(_CLASS_OF[np.frombuffer(data, dtype=np.uint8)], minlength=len(CLASSES) + 1) / max(n, 1)
    hashes = np.fromiter(map(zlib.crc32, words), np.uint32, count)
    distinct = np.unique(hashes & ((1 << WORD_BITS) - 1)).astype(np.int32)
    same = np.count_nonzero(hashes[1:] == hashes[:-1]) / max(count - 1, 1)
    lines = data.split(b"\n")
    steps = [_step(s) for s in shares]
    steps += [
        _step(same),
        int(10 * len(distinct) / max(count, 1)),
        min(15, int(n / max(count, 1))),
        min(15, n.bit_length()),
        int(10 * len(set(lines)) / len(lines)),
        min(15, (n // len(lines)).bit_length()),
    ]
    structure = (1 << WORD_BITS) + STEPS * np.arange(STATISTICS, dtype=np.int32) + np.array(steps, dtype=np.int32)
    values = np.concatenate([np.full(len(distinct), 1 / np.sqrt(max(len(distinct), 1))), np.full(STATISTICS, 1 / np.sqrt(STATISTICS))])
    return np.concatenate([distinct, structure]).astype(np.int32), values.astype(np.float32)


class Model:
    def __init__(self, seed: int = 1):
        self.bias = np.float32(0)
        self.weights = np.zeros(SIZE, dtype=np.float32)
        self.factors = np.random.default_rng(seed).normal(0, 0.05, (SIZE, FACTORS)).astype(np.float32)

    def logits(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of texts whose inputs lie one after the other; also their factor sums."""
        scaled = self.factors[index] * value[:, None]
        sums = np.add.reduceat(scaled, starts)
        pairs = 0.5 * ((sums**2).sum(1) - np.add.reduceat((scaled**2).sum(1), starts))
        return self.bias + np.add.reduceat(self.weights[index] * value, starts) + pairs, sums

    def scores(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        logits, _ = self.logits(*_flat(rows))
        return 1 / (1 + np.exp(-np.clip(logits, -40, 40).astype(np.float64)))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 1) -> Model:
        """Adaptive gradient steps on the logistic loss, in small batches."""
        rng = np.random.default_rng(seed)
        g_bias, g_weights = 1e-8, np.full(SIZE, 1e-8, np.float32)
        g_factors = np.full((SIZE, FACTORS), 1e-8, np.float32)
        for _ in range(EPOCHS):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), BATCH):
                chosen = order[at : at + BATCH]
                index, value, starts = _flat([rows[i] for i in chosen])
                logits, sums = self.logits(index, value, starts)
                error = (1 / (1 + np.exp(-np.clip(logits, -40, 40))) - labels[chosen]).astype(np.float32) / len(chosen)
                of = np.repeat(np.arange(len(chosen)), np.diff(np.append(starts, len(index))))
                touched, where = np.unique(index, return_inverse=True)
                slope = np.zeros(len(touched), np.float32)
                np.add.at(slope, where, error[of] * value)
                slope += DECAY * self.weights[touched]
                own = self.factors[index]
                steep = np.zeros((len(touched), FACTORS), np.float32)
                np.add.at(steep, where, (error[of] * value)[:, None] * (sums[of] - own * value[:, None]))
                steep += DECAY * self.factors[touched]
                g_weights[touched] += slope**2
                g_factors[touched] += steep**2
                self.weights[touched] -= RATE * 4 * slope / np.sqrt(g_weights[touched])
                self.factors[touched] -= RATE * steep / np.sqrt(g_factors[touched])
                g_bias += float(error.sum()) ** 2
                self.bias -= np.float32(RATE * 4 * error.sum() / np.sqrt(g_bias))
        return self


def _flat(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array([len(i) for i, _ in rows])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    return np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows]), starts


def feature_batches(batches: Iterator) -> Iterator:
    for batch in batches:
        for part in slices(batch):
            rows = [features(t) for t in part["text"].to_pylist()]
            columns = [part["label"], pa.array([i.tobytes() for i, _ in rows], pa.binary()), pa.array([v.tobytes() for _, v in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["label", "index", "value"])


def score_batches(batches: Iterator, model: Model, keep: list[str], name: str) -> Iterator:
    for batch in batches:
        for part in slices(batch):
            scores = model.scores([features(t) for t in part["text"].to_pylist()])
            yield pa.RecordBatch.from_arrays([*(part[c] for c in keep), pa.array(scores, pa.float64())], [*keep, name])


def fit_quality(docs: DataFrame, labels: DataFrame, usable: Column | None = None, rows: int = SAMPLE_ROWS) -> Model:
    """A model of ``labels.quality``. ``usable`` says of ``doc_id`` whether a label may be learnt from."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("float").alias("label"))
    known = known.where("doc_id IS NOT NULL AND label IS NOT NULL")
    known = known.where(usable) if usable is not None else known
    # at most ``rows`` rows of two numbers: small enough to send to every executor
    known = known.orderBy(F.xxhash64("doc_id", "label"), "doc_id", "label").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id")
    found = texts.select("label", "text").mapInArrow(in_tasks("llm.quality", "feature_batches"), "label float, index binary, value binary").collect()
    model = Model()
    if found:
        found.sort(key=lambda r: (bytes(r["index"]), bytes(r["value"]), r["label"]))
        inputs = [(np.frombuffer(r["index"], np.int32), np.frombuffer(r["value"], np.float32)) for r in found]
        return model.fit(inputs, np.array([r["label"] for r in found], np.float32))
    model.factors[:] = 0
    return model


def quality_scores(docs: DataFrame, model: Model, keep: list[str], name: str = "score") -> DataFrame:
    """``keep`` columns of every row, and the score as ``name``, which is none of them."""
    rows = docs.select(*dict.fromkeys([*keep, "text"]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return rows.mapInArrow(in_tasks("llm.quality", "score_batches", model, keep, name), f"{schema}, `{name}` double")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = fit_quality(docs, table(spark, sf_dir, "labels"), remainder("doc_id", HELD_OUT) != 0)
    return quality_scores(docs, model, ["doc_id"]).select(
        "doc_id",
        (remainder("doc_id", HELD_OUT) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
