"""Exact search for the largest inner products in an impact-ordered index.

Vectors of integers are indexed as postings: a posting of dimension ``d`` says which component a
vector has there. Its impact is the component's size, quantised to powers of two; postings of
equal impact are a segment, and segments are processed from the highest impact down, for all
queries of a block at once. After each segment a candidate's score is known up to the product
of what remains of both vectors (Cauchy-Schwarz), so it lies within bounds. A query stops once the bounds
prove which candidates can still be among its best; those are scored exactly. Without a proof all segments
are processed, and the scores are exact anyway.

Candidates are dealt out in blocks, and each block meets each block of queries.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from excursio.llm import workers
from excursio.shared import write_shared

K = 5
CANDIDATES = 8192
QUERIES = 1024
#: A query stops when at most this share of a block's candidates can still be members.
FEW = 0.02


def integers(embedding: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` of every component as long; null if the vector or a component isn't finite."""
    whole = F.transform(embedding, lambda x: x.cast("double") * scale)
    usable = F.forall(
        whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float(2**62)))
    )
    return F.when(embedding.isNotNull() & usable, F.transform(whole, lambda x: F.floor(x).cast("long")))


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: the highest scores, among equal ones the smallest ids."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort([ids[some], -scores[some]])][:k]


def search_block(
    ids: np.ndarray,
    vectors: np.ndarray,
    query_rows: np.ndarray,
    queries: np.ndarray,
    k: int,
    rows: np.ndarray | None = None,
):
    """The best ``k`` candidates of a block for each query: the query's row, the candidates' ids, scores.

    ``rows`` number the candidates (by default their ids do); the candidate with the query's own row is no
    candidate of it. Bounds are doubles, so where scores can pass 2**52 nothing is stopped early.
    """
    rows = ids if rows is None else rows
    order = np.lexsort([rows, ids])
    ids, rows, vectors = ids[order], rows[order], vectors[order]
    reach = np.abs(vectors).max(initial=0), np.abs(queries).max(initial=0)
    exact = float(reach[0]) * float(reach[1]) * max(vectors.shape[1], 1) < 2.0**52
    kind = np.float64 if exact else np.int64
    v, q = vectors.astype(kind), queries.astype(kind)
    known = np.zeros((len(queries), len(ids)), kind)
    rest = v.copy()
    impact = np.frexp(np.abs(vectors).astype(np.float64))[1]
    norms = np.sqrt((queries.astype(np.float64) ** 2).sum(1))
    out: list[tuple[int, np.ndarray, np.ndarray]] = []
    open_queries = np.arange(len(queries))
    levels = [x for x in np.unique(impact)[::-1] if x > 0]
    for at, level in enumerate(levels):
        segment = np.where(impact == level, v, 0)
        rest -= segment
        known[open_queries] += q[open_queries] @ segment.T
        last = at == len(levels) - 1
        slack = np.sqrt((rest.astype(np.float64) ** 2).sum(1)) * (1 + 1e-9)
        if not (exact or last):
            continue
        still = []
        for one in open_queries:
            base = known[one].astype(np.float64)
            around = norms[one] * slack + 1e-6
            able = rows != query_rows[one]
            if not last:
                # The k-th largest lower bound; whoever can't reach it is out.
                lower = np.where(able, base - around, -np.inf)
                bar = np.partition(lower, max(len(lower) - k, 0))[max(len(lower) - k, 0)]
                members = np.flatnonzero(able & (base + around >= bar))
                if len(members) > max(FEW * len(ids), 2 * k):
                    still.append(one)
                    continue
                scores = (v[members] @ q[one]).astype(np.int64) if len(members) else np.zeros(0, np.int64)
            else:
                members = np.flatnonzero(able)
                scores = known[one, members].astype(np.int64)
            best = _top(scores, ids[members], k)
            out.append((one, members[best], scores[best]))
        open_queries = np.array(still, np.int64)
        if not len(open_queries):
            break
    for one in open_queries if not levels else ():
        members = np.flatnonzero(rows != query_rows[one])
        best = members[:k]
        out.append((one, best, np.zeros(len(best), np.int64)))
    return [(query_rows[one], ids[places], scores) for one, places, scores in out]


def _search(k: int):
    def search(key, candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(candidates) and len(queries):
            wide = max(map(len, [*candidates["v"], *queries["query_v"]]))

            def matrix(rows):
                out = np.zeros((len(rows), wide), np.int64)
                for row, values in zip(out, rows):
                    row[: len(values)] = values
                return out

            found = search_block(
                candidates["vec_id"].to_numpy(np.int64),
                matrix(candidates["v"]),
                queries["query_row"].to_numpy(np.int64),
                matrix(queries["query_v"]),
                k,
                candidates["row"].to_numpy(np.int64),
            )
        ids = dict(zip(queries["query_row"], queries["query_vec_id"]))
        return pd.DataFrame(
            {
                "query_row": np.repeat([x[0] for x in found], [len(x[1]) for x in found]).astype(np.int64),
                "query_id": np.repeat([ids[x[0]] for x in found], [len(x[1]) for x in found]).astype(np.int64),
                "vec_id": np.concatenate([x[1] for x in found] or [np.zeros(0)]).astype(np.int64),
                "score": np.concatenate([x[2] for x in found] or [np.zeros(0)]).astype(np.int64),
            }
        )

    return search


def best_matches(
    vectors: DataFrame, queries: Column, k: int = K, *, candidates_per_block: int = CANDIDATES, queries_per_block: int = QUERIES
) -> DataFrame:
    """For each row that is a query, the ``k`` other rows with the largest inner products.

    ``vectors`` has ``vec_id`` and ``embedding``; ``queries`` is a condition on them. Every component x
    counts as floor(256 x). Returns ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``; equal scores
    are ranked by the smaller ``vec_id``. Fewer rows than ``k`` give all there are.

    Vectors that are null or hold null or non-finite components, and rows without an id, take no part.
    Shorter vectors are filled up with zeros. Rows that share an id, equal or not, count one by one: each is a
    candidate of the others, and each query row has ranks of its own. An empty table gives an empty result.
    Other columns aren't used, whatever their names.
    """
    workers.ready(vectors.sparkSession)
    usable = vectors.select("vec_id", integers(F.col("embedding")).alias("v"), F.coalesce(queries, F.lit(False)).alias("query"))
    usable = usable.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    usable = write_shared(usable.withColumn("row", F.monotonically_increasing_id()), "vectors")
    counts = vectors.select(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(queries, F.lit(False))).alias("q")).first()
    blocks = max(1, math.ceil(counts["n"] / candidates_per_block))
    query_blocks = max(1, math.ceil(counts["q"] / queries_per_block))
    place = lambda n, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = usable.select("row", "vec_id", "v", place(blocks, 1).alias("block"), every(query_blocks).alias("query_block"))
    # Columns of their own: were they those of ``dealt``, Spark would lose them when it prunes columns.
    own = [F.col(c).alias(f"query_{c}") for c in ("row", "vec_id", "v")]
    asked = usable.where("query").select(*own, place(query_blocks, 2).alias("query_block"), every(blocks).alias("block"))
    keys = ["block", "query_block"]
    found = dealt.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(
        _search(k), "query_row long, query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


SQL = """
WITH usable AS (
  SELECT row_number() OVER () AS r, vec_id, [CAST(floor(256.0::DOUBLE * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND q.r <> c.r)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM pairs)
WHERE rank <= 5
"""
