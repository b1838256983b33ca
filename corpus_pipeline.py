"""Documents to packed sequences: quality, language, near copies, packing.

``STAGES`` are (name, function) with ``function(spark, docs, sf_dir) -> DataFrame``; each result is
written as Parquet and read again as the next stage's documents. All but the last return the
columns of their documents, whatever these are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import remainder, stored, table
from llm.language import HELD_OUT as LANGUAGE_FOLDS
from llm.language import UNKNOWN, fit_languages, predict_languages
from llm.near_dedup import one_of_each
from llm.packing import pack_documents
from llm.quality import HELD_OUT as QUALITY_FOLDS
from llm.quality import THRESHOLD, fit_quality, quality_scores

#: Percent of common shingles from which on two documents are near copies; see the README.
NEAR_PERCENT = 85
#: Quality, language identification and packing have no SQL form; tests hold stages against plain loops.
ORACLE_SQL = None


def _free(name: str, docs: DataFrame) -> str:
    """``name``, or with underscores if the documents have such a column."""
    while name.lower() in map(str.lower, docs.columns):
        name += "_"
    return name


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good ones."""
    model = fit_quality(docs, table(spark, sf_dir, "labels"), remainder("doc_id", QUALITY_FOLDS) != 0)
    name = _free("score", docs)
    return quality_scores(docs, model, docs.columns, name).where(F.col(name) >= THRESHOLD).drop(name)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: those without a letter, or without a text, go."""
    model = fit_languages(docs, remainder("doc_id", LANGUAGE_FOLDS) != 1)
    told = (_free("lang_pred", docs), _free("lang_score", docs))
    return predict_languages(docs, model, docs.columns, told).where(F.col(told[0]) != UNKNOWN).drop(*told)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return one_of_each(docs, NEAR_PERCENT)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as pieces of packed sequences."""
    return pack_documents(docs)


STAGES = [("quality", quality), ("language", language), ("near_dedup", near_dedup), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage; those before are stored in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
