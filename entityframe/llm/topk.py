"""Exact top-k inner products by columnar branch and bound.

Vectors are cut into blocks of candidates and blocks of queries.  A task holds one block of
each, the candidates in vertical layout (one row per dimension), and adds up products
dimension block by dimension block.  After each step a candidate can still gain at most the
product of the remaining lengths of both vectors, by Cauchy and Schwarz; candidates that
cannot reach the k-th best any more are compacted away.

A query meets one block first and then, round by round, as many as it has met before.  Its
k-th best score so far is the one to beat, and a block sends back only rows that reach it, so
what is sent grows with the number of rounds, not of blocks.  All arithmetic is on whole
numbers and exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from entityframe.llm.common import load, ship, stage

CANDIDATE_BLOCK = 2048
QUERY_BLOCK = 4096
DIMENSION_BLOCK = 16
SCALE = 64
# Whole numbers up to here are exact in double precision.
_EXACT = float(1 << 52)
_FOUND = "query long, query_id long, rid long, vec_id long, score long"


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """rid, vec_id, v: floor(scale * x) of each component.  Rows with a null id or vector, or a null
    or non-finite component, are left out.  rid tells rows apart that share an id; it is fixed
    once the frame is written."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    clean = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("x")).filter(
        F.col("vec_id").isNotNull() & F.col("x").isNotNull() & F.forall("x", finite)
    )
    whole = F.transform("x", lambda x: F.floor(x * scale))
    return clean.select(F.monotonically_increasing_id().alias("rid"), "vec_id", whole.alias("v"))


def _matrix(rows: list, width: int) -> np.ndarray:
    """One vector per row; shorter ones are zero beyond their end."""
    out = np.zeros((len(rows), width), dtype=np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def _tail_lengths(m: np.ndarray, starts: list[int]) -> np.ndarray:
    """Length of each vector from each of `starts` on."""
    squares = np.square(m.astype(np.float64))
    return np.sqrt(np.stack([squares[:, s:].sum(axis=1) for s in starts]))


def search_block(
    queries: np.ndarray, asked: np.ndarray, beat: np.ndarray, vectors: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int, step: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place of the query, places, scores) of the up to k best candidates that score at least
    `beat`, ties to the smaller of `ids`.  `asked` and `rows` are the numbers of the rows."""
    width = vectors.shape[1]
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(width, 1)
    if most >= _EXACT:
        yield from _search_wide(queries, asked, beat, vectors, rows, ids, k)
        return
    starts = list(range(0, width, step)) or [0]
    columns = np.ascontiguousarray(vectors.T.astype(np.float64))
    tails, query_tails = _tail_lengths(vectors, [*starts[1:], width]), _tail_lengths(queries, [*starts[1:], width])
    first = queries[:, :step].astype(np.float64) @ columns[:step]
    for i, query in enumerate(queries.astype(np.float64)):
        alive = np.flatnonzero(rows != asked[i])
        sums, floor = first[i, alive], beat[i]
        for b, start in enumerate(starts):
            if b:
                sums = sums + query[start : start + step] @ columns[start : start + step, alive]
            slack = query_tails[b, i] * tails[b, alive] * (1 + 1e-9) + 1e-6
            if b == len(starts) - 1:
                slack = 0.0
            if len(alive) > k:
                floor = max(floor, np.partition(sums - slack, len(alive) - k)[len(alive) - k])
            keep = sums + slack >= floor
            alive, sums = alive[keep], sums[keep]
            if not len(alive):
                break
        if len(alive):
            best = np.lexsort((ids[alive], -sums))[:k]
            yield i, alive[best], sums[best].astype(np.int64)


def _search_wide(queries, asked, beat, vectors, rows, ids, k):
    """For components too large for doubles: unbounded integers, scores clipped to 64 bits."""
    low, high = -(1 << 63), (1 << 63) - 1
    for i, query in enumerate(queries.astype(object)):
        scores = [min(max(int(s), low), high) for s in vectors.astype(object) @ query]
        ranked = sorted((-s, int(ids[at]), at) for at, s in enumerate(scores) if rows[at] != asked[i] and s >= beat[i])[:k]
        if ranked:
            yield i, np.array([at for _, _, at in ranked]), np.array([-s for s, _, _ in ranked])


def _searcher(k: int, step: int):
    def search(rows: pd.DataFrame) -> pd.DataFrame:
        asks = rows[rows["asks"]]
        holds = rows[~rows["asks"]]
        width = max((len(v) for v in rows["v"]), default=0)
        queries, vectors = _matrix(list(asks["v"]), width), _matrix(list(holds["v"]), width)
        beat = asks["beat"].fillna(-np.inf).to_numpy(dtype=np.float64)
        numbers, ids = ([side[c].to_numpy() for side in (asks, holds)] for c in ("rid", "vec_id"))
        found = [
            pd.DataFrame({"query": numbers[0][q], "query_id": ids[0][q], "rid": numbers[1][at], "vec_id": ids[1][at], "score": scores})
            for q, at, scores in search_block(queries, numbers[0], beat, vectors, numbers[1], ids[1], k, step)
        ] if len(asks) and len(holds) else []
        if not found:
            return pd.DataFrame({c: [] for c in ("query", "query_id", "rid", "vec_id", "score")}, dtype="int64")
        return pd.concat(found, ignore_index=True)

    return search


def exact_top_k(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    scale: int = SCALE,
    candidate_block: int = CANDIDATE_BLOCK,
    query_block: int = QUERY_BLOCK,
    step: int = DIMENSION_BLOCK,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest integer inner products of each query.

    Needs vec_id and embedding; other columns are ignored.  Queries are the vectors whose
    vec_id is divisible by `every`; candidates are all vectors but the query's own.  Ties go
    to the smaller vec_id.  Left out are the rows that integer_vectors leaves out.  Rows that
    share a vec_id all take part, each as a candidate and, where it is one, as a query.  Vectors of
    unequal length are compared as if the shorter ended in zeros; an empty vector scores 0.
    An empty table gives an empty result.
    """
    ship(vectors.sparkSession)
    whole = stage(integer_vectors(vectors, scale), "vectors")
    asks = F.col("vec_id") % every == 0
    n, m = whole.agg(F.count(F.lit(1)), F.count(F.when(asks, 1))).first()
    blocks, query_blocks = max(1, -(-n // candidate_block)), max(1, -(-m // query_block))
    deal = F.xxhash64("rid")
    dealt = whole.withColumns({"block": F.pmod(deal, F.lit(blocks)), "qblock": F.pmod(F.shiftright(deal, 20), F.lit(query_blocks))})
    queries = dealt.filter(asks)
    every_q = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(query_blocks - 1).cast("bigint")))
    columns = ["block", "qblock", "rid", "vec_id", "v"]

    def search(asked: DataFrame, held: DataFrame) -> DataFrame:
        both = asked.select(*columns, "beat", F.lit(True).alias("asks")).unionByName(
            held.select(*columns, F.lit(None).cast("double").alias("beat"), F.lit(False).alias("asks"))
        )
        return both.groupBy("block", "qblock").applyInPandas(_searcher(k, step), _FOUND)

    candidates = dealt.drop("qblock").withColumn("qblock", every_q)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id", "rid")
    best, first = None, 0
    while first < blocks:
        last = min(max(1, 2 * first), blocks)
        beat = _scores_to_beat(best, k) if best is not None else None
        steps = F.explode(F.sequence(F.lit(first).cast("bigint"), F.lit(last - 1).cast("bigint")))
        asked = queries.withColumn("step", steps).withColumn("block", F.pmod(F.col("block") + F.col("step"), F.lit(blocks)))
        asked = asked.join(beat, "rid", "left") if beat is not None else asked.withColumn("beat", F.lit(None).cast("double"))
        found = search(asked, candidates)
        found = found if best is None else found.unionByName(best.drop("rank"))
        best = stage(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k), "best")
        first = last
    return best.select("query_id", "rank", "vec_id", "score")


def _scores_to_beat(best: DataFrame, k: int) -> DataFrame:
    """The k-th best score so far of each query that has so many."""
    full = best.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("score").cast("double").alias("beat"))
    return full.filter(F.col("n") >= k).select(F.col("query").alias("rid"), "beat")


def op3_exact_top_k(spark, sf):
    return exact_top_k(load(spark, sf, "embeddings"))


OP3_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON c.rid <> q.rid WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
