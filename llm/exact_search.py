"""Exact top-k search by inner product with a pivot table.

Vectors become integers, floor(64 x) of each component. A table of their distances to ``PIVOTS``
pivots is worked out once and stored. For a query q and a candidate x the triangle inequality gives
|q - x| >= |d(q, p) - d(x, p)| for each pivot p; the greatest of these bounds caps the inner product
at (|q|^2 + |x|^2 - bound^2) / 2. Candidates are evaluated in the order of their caps until the
next cap lies below the k-th best score found: the rest cannot enter the result.

Queries and candidates meet in blocks; a block returns its best ``k`` for each query, and the best
of those are the result.

Defined results: rows with a null id or vector, an empty vector, or a null or non-finite component
take no part; repeated rows of one id count once (the smallest vector of them); only vectors of
equal length are compared; fewer than ``k`` candidates are all returned; equal scores are ranked by
id; other columns are not read. Scores are exact as long as they stay below 2^53.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from llm.common import in_tasks, slices, stored, table

TOP, QUERY_MODULUS, SCALE = 20, 20, 64
PIVOTS = 16
QUERY_BLOCK, CANDIDATE_BLOCK = 4096, 8192
#: Room for rounding in distances, as a share of the squares they come from.
SLACK = 1e-9


def valid_vectors(rows: DataFrame) -> DataFrame:
    """``vec_id, vector``: one integer vector for each id."""
    whole = F.transform("embedding", lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("double"))
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    good = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)).where(~odd)
    return good.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("vector")).groupBy("vec_id").agg(F.min("vector").alias("vector"))


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * (x @ pivots.T)
    return np.sqrt(np.maximum(square, 0))


def table_batches(batches: Iterator, pivots: dict[int, np.ndarray]) -> Iterator:
    """Vectors as bytes with their distances to the pivots of their length."""
    for batch in batches:
        for part in slices(batch, 2048):
            vectors = [np.array(v, dtype=np.float64) for v in part["vector"].to_pylist()]
            far = [distances(v[None, :], pivots[len(v)])[0] for v in vectors]
            columns = [part["vec_id"], pa.array([len(v) for v in vectors], pa.int32()), pa.array([v.tobytes() for v in vectors], pa.binary()), pa.array([d.tobytes() for d in far], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "size", "vector", "far"])


def pivot_table(vectors: DataFrame) -> DataFrame:
    """``vec_id, size, vector, far`` (packed doubles); up to ``PIVOTS`` vectors of each length are pivots."""
    order = Window.partitionBy(F.size("vector")).orderBy(F.xxhash64("vec_id"), "vec_id")
    chosen = vectors.select("vector", F.row_number().over(order).alias("n")).where(F.col("n") <= PIVOTS).collect()
    pivots: dict[int, list] = {}
    for row in sorted(chosen, key=lambda r: r["n"]):
        pivots.setdefault(len(row["vector"]), []).append(row["vector"])
    arrays = {k: np.array(v, dtype=np.float64) for k, v in pivots.items()}
    return vectors.select("vec_id", "vector").mapInArrow(in_tasks("llm.exact_search", "table_batches", arrays), "vec_id long, size int, vector binary, far binary")


def best(query: np.ndarray, own: int, caps: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the ``k`` best candidates of a block, by caps until none can enter."""
    open_ = ids != own
    first = min(len(ids), 8 * k)
    head = np.argpartition(-caps, first - 1)[:first] if first < len(ids) else np.arange(len(ids))
    done = head[open_[head]]
    scores = vectors[done] @ query
    least = -np.inf if len(scores) < k else np.partition(scores, -k)[-k]
    rest = open_ & (caps >= least)
    rest[head] = False
    rest = np.nonzero(rest)[0]
    rest = rest[np.argsort(-caps[rest], kind="stable")]
    at, step = 0, 4 * first
    while at < len(rest) and caps[rest[at]] >= least:
        some = rest[at : at + step]
        done, scores = np.concatenate([done, some]), np.concatenate([scores, vectors[some] @ query])
        keep = scores >= (-np.inf if len(scores) < k else np.partition(scores, -k)[-k])
        done, scores = done[keep], scores[keep]
        least = -np.inf if len(scores) < k else scores.min()
        at, step = at + step, 2 * step
    order = np.lexsort((ids[done], -scores))[:k]
    return ids[done][order], scores[order]


def search_blocks(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    found: list[tuple] = []
    if queries.num_rows and candidates.num_rows:
        load = lambda t, c: np.frombuffer(b"".join(t[c].to_pylist()), dtype=np.float64).reshape(t.num_rows, -1)
        q, x, far_q, far_x = load(queries, "vector"), load(candidates, "vector"), load(queries, "far"), load(candidates, "far")
        own, ids = np.array(queries["vec_id"].to_pylist()), np.array(candidates["vec_id"].to_pylist())
        square_q, square_x = (q**2).sum(1), (x**2).sum(1)
        for start in range(0, len(q), 64):
            part = far_q[start : start + 64]
            bound = np.zeros((len(part), len(x)))
            for p in range(part.shape[1]):
                np.maximum(bound, np.abs(part[:, p, None] - far_x[None, :, p]), out=bound)
            sums = square_q[start : start + 64, None] + square_x[None, :]
            caps = (sums * (1 + SLACK) - bound**2) / 2 + SLACK
            for i in range(len(part)):
                near, scores = best(q[start + i], own[start + i], caps[i], ids, x, k)
                found.append((np.full(len(near), own[start + i]), near, scores.astype(np.int64)))
    columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 3
    return pa.table(dict(zip(("query_id", "vec_id", "score"), (pa.array(c, pa.int64()) for c in columns))))


def top_k(vectors: DataFrame, is_query: Column, k: int = TOP) -> DataFrame:
    """``query_id, rank, vec_id, score`` for every vector that ``is_query`` (of ``vec_id``) names."""
    known = stored(pivot_table(vectors), "pivot-table")
    n, queries = known.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    n_q, n_x = -(-queries // QUERY_BLOCK) or 1, -(-n // CANDIDATE_BLOCK) or 1
    block = lambda parts: F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")
    all_ = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    asked = known.where(is_query).select("*", block(n_q).alias("qb")).withColumn("xb", all_(n_x))
    given = known.select("*", block(n_x).alias("xb")).withColumn("qb", all_(n_q))
    keys = ["size", "qb", "xb"]
    found = asked.groupBy(*keys).cogroup(given.groupBy(*keys)).applyInArrow(in_tasks_pair(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def in_tasks_pair(k: int):
    call = in_tasks("llm.exact_search", "search_pair", k)
    return lambda queries, candidates: call((queries, candidates))


def search_pair(pair: tuple, k: int) -> pa.Table:
    return search_blocks(*pair, k)


def op3_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = valid_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, F.col("vec_id") % QUERY_MODULUS == 0)


SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), one AS (
  SELECT vec_id, min(v) AS v FROM whole GROUP BY vec_id
), scored AS (
  SELECT q.vec_id AS query_id, x.vec_id AS vec_id, CAST(list_inner_product(q.v, x.v) AS BIGINT) AS score
  FROM one q JOIN one x ON q.vec_id % 20 = 0 AND q.vec_id <> x.vec_id AND len(q.v) = len(x.v)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 20
"""
