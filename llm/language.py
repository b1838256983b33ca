"""Language identification in two steps: family first, then pairs of related languages.

A text is the distribution of its hashed letter n-grams (one to three, lower case, everything that
is no letter taken as a gap), as square roots of shares. One linear support vector machine for
each family, against the rest, picks the family; inside it, one machine for each pair of languages
votes. Machines are fitted on the driver on a bounded sample: about ``SAMPLE_LANGUAGE`` rows of each
language, chosen by a hash of their id, and never more than ``SAMPLE_ROWS`` in all. Every text is
read whole.

Defined results: ``und`` with score 0 for a null text or one without a letter, or if nothing could
be learnt; a language that is alone in its family is decided by the family; languages outside
``FAMILIES`` form a family each; ties go to the first in alphabetical order; repeated rows are
predicted again.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import in_tasks, remainder, slices, table

UNKNOWN, HELD_OUT = "und", 3
BITS = 12
SAMPLE_LANGUAGE, SAMPLE_ROWS = 400, 8000
EPOCHS, BATCH, REGULAR = 30, 32, 1e-4
#: Families by language code, public knowledge.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "is", "nb", "nl", "nn", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "pt", "ro"],
    "slavic": ["bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "uralic": ["et", "fi", "hu"],
    "turkic": ["az", "kk", "tr", "uz"],
    "indic": ["bn", "hi", "mr", "ne", "pa", "ur"],
    "semitic": ["am", "ar", "he", "mt"],
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}
_letter = np.zeros(0, dtype=bool)


def letters() -> np.ndarray:
    """Whether a code point is a letter; one table for each worker."""
    global _letter
    if not len(_letter):
        _letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letter


def features(text: str | None) -> np.ndarray | None:
    """Square roots of the shares of n-grams; None without a letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    is_letter = letters()[points]
    if not is_letter.any():
        return None
    points = np.where(is_letter, points, np.uint32(32))
    gap = np.full(1, 32, dtype=np.uint32)
    points = np.concatenate([gap, points, gap])
    one = points * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (points[1:] * np.uint32(0x85EBCA6B))) * np.uint32(0xC2B2AE35)
    three = (two[:-1] ^ (points[2:] * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
    shift = np.uint32(32 - BITS)
    counts = np.zeros(1 << BITS)
    for grams in (one, two, three):
        counts += np.bincount(grams >> shift, minlength=1 << BITS) / len(grams)
    return np.sqrt(counts / 3).astype(np.float32)


def fit_machine(x: np.ndarray, positive: np.ndarray, seed: int) -> np.ndarray:
    """Weights of a linear support vector machine, mean of the second half of its steps."""
    rng = np.random.default_rng(seed)
    y = np.where(positive, 1.0, -1.0).astype(np.float32)
    balance = np.where(positive, len(y) / (2 * max(positive.sum(), 1)), len(y) / (2 * max((~positive).sum(), 1))).astype(np.float32)
    weights, mean, kept, step = np.zeros(x.shape[1], np.float32), np.zeros(x.shape[1], np.float64), 0, 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(order), BATCH):
            step += 1
            rows = order[at : at + BATCH]
            rate = 1 / (REGULAR * (step + 1000))
            inside = y[rows] * (x[rows] @ weights) < 1
            slope = (y[rows] * balance[rows] * inside) @ x[rows] / len(rows)
            weights = (1 - rate * REGULAR) * weights + rate * slope
            if 2 * epoch >= EPOCHS:
                mean += weights
                kept += 1
    return (mean / kept).astype(np.float32)


class Model:
    """Languages, their families, and the machines' weights side by side."""

    def __init__(self, languages: list[str], x: np.ndarray, y: np.ndarray):
        self.languages = languages
        family_of = [FAMILY_OF.get(c, c) for c in languages]
        self.families = sorted(set(family_of))
        self.members = [[i for i, f in enumerate(family_of) if f == g] for g in self.families]
        self.pairs = [pair for m in self.members for pair in combinations(m, 2)]
        own = np.array([self.families.index(f) for f in family_of], dtype=int)
        columns = []
        if len(self.families) > 1:
            columns += [fit_machine(x, own[y] == k, k) for k in range(len(self.families))]
        for k, (a, b) in enumerate(self.pairs):
            rows = (y == a) | (y == b)
            columns.append(fit_machine(x[rows], y[rows] == a, 1000 + k))
        self.weights = np.stack(columns, 1) if columns else np.zeros((1 << BITS, 0), np.float32)

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        margins = (x @ self.weights).astype(np.float64)
        squash = lambda m: 1 / (1 + np.exp(-np.clip(3 * m, -40, 40)))
        several = len(self.families) if len(self.families) > 1 else 0
        family = margins[:, :several].argmax(1) if several else np.zeros(len(x), int)
        score = squash(margins[:, :several].max(1)) if several else np.ones(len(x))
        votes = np.zeros((len(x), len(self.languages)))
        sure = np.zeros((len(x), len(self.languages)))
        for k, (a, b) in enumerate(self.pairs):
            p = squash(margins[:, several + k])
            votes[:, a] += p >= 0.5
            votes[:, b] += p < 0.5
            sure[:, a] += p
            sure[:, b] += 1 - p
        names = []
        for i, f in enumerate(family):
            members = self.members[f]
            best = max(members, key=lambda m: (votes[i, m], sure[i, m], -m))
            names.append(self.languages[best])
            if len(members) > 1:
                score[i] *= sure[i, best] / (len(members) - 1)
        return names, score


def feature_batches(batches: Iterator) -> Iterator:
    for batch in batches:
        for part in slices(batch):
            rows = [(lang, features(text)) for lang, text in zip(part["lang"].to_pylist(), part["text"].to_pylist())]
            rows = [(lang, x.astype(np.float16).tobytes()) for lang, x in rows if x is not None]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], ["lang", "x"])


def predict_batches(batches: Iterator, model: Model | None, keep: list[str], told: tuple[str, str]) -> Iterator:
    for batch in batches:
        for part in slices(batch):
            names, scores = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows)
            found = [(i, x) for i, t in enumerate(part["text"].to_pylist()) if model and t and (x := features(t)) is not None]
            if found:
                best, score = model.predict(np.stack([x for _, x in found]))
                for (i, _), name, s in zip(found, best, score):
                    names[i], scores[i] = name, s
            yield pa.RecordBatch.from_arrays([*(part[c] for c in keep), pa.array(names, pa.string()), pa.array(scores, pa.float64())], [*keep, *told])


def fit_languages(docs: DataFrame, usable: Column | None = None) -> Model | None:
    """A model of ``lang``, or None if no row has text and language."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    known = known.where(usable) if usable is not None else known
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    each = max(1, min(SAMPLE_LANGUAGE, SAMPLE_ROWS // len(counts)))
    share = F.create_map(*(F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, each / n))))
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / (1 << 30)
    # about ``each`` rows of a language; the limit only holds the total
    some = known.where(place <= share[F.col("lang")]).orderBy(F.xxhash64("text", "doc_id")).limit(SAMPLE_ROWS)
    rows = some.select("lang", "text").mapInArrow(in_tasks("llm.language", "feature_batches"), "lang string, x binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["lang"], bytes(r["x"])))
    languages = sorted({r["lang"] for r in rows})
    x = np.stack([np.frombuffer(r["x"], np.float16) for r in rows]).astype(np.float32)
    return Model(languages, x, np.array([languages.index(r["lang"]) for r in rows]))


def predict_languages(docs: DataFrame, model: Model | None, keep: list[str], told: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``keep`` columns of every row, the language and its score; ``told`` names them, none of ``keep``."""
    rows = docs.select(*dict.fromkeys([*keep, "text"]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return rows.mapInArrow(in_tasks("llm.language", "predict_batches", model, keep, told), f"{schema}, `{told[0]}` string, `{told[1]}` double")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = fit_languages(docs, remainder("doc_id", HELD_OUT) != 1)
    return predict_languages(docs, model, ["doc_id"]).select(
        "doc_id", (remainder("doc_id", HELD_OUT) == 1).alias("held_out"), "lang_pred", "score"
    )
