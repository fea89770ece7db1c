"""Hard negatives of each anchor by vertical scans of columns, after the BOND method.

Vectors are kept in blocks, one row per block, with a column of whole numbers per dimension and
each column's least and greatest value.  An anchor reads the columns of a block in the order of
its own magnitudes, largest first.  After some columns, a candidate's score lies between its sum
so far plus the least, and plus the greatest, that the columns still unread can add; a bitmap
holds the candidates whose range can still matter, and shrinks as the ranges narrow.

There are two scans.  The first finds an anchor's positives, the best rows of its label.  The
second finds, for the score window under each positive, the best rows of other labels in it; a
candidate stays in the bitmap while its range meets a window at a place where it could be among
the best.  What a task has found so far is the bar for its further blocks.

Blocks stay where they are.  Anchors come to them in chunks of a fixed size, sent to every
task; a task returns a few rows per anchor, and a window merges those of all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from entityframe.llm.common import fresh_path, load, ship, stage

#: Vectors of a block, at the mean; columns read between two looks at the bounds.
BLOCK_ROWS = 2048
COLUMNS_A_STEP = 8
#: The most anchors, and the most bytes of their components, sent to tasks at a time.
CHUNK_ROWS = 4096
CHUNK_BYTES = 8 << 20
SCALE = 256
_SAFE = 1 << 62
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1

_BLOCK = "block long, width int, rids binary, ids binary, labels binary, columns binary"
_FOUND = "rid long, positive int, score long, vec_id long, other long"


def labelled_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """rid, vec_id, label, v: rows that take part, with floor(scale * x) of each component.

    Left out are rows with a null id, label or vector, or with a null or non-finite component.
    rid tells rows apart that share an id; it is fixed once the frame is written.
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    clean = vectors.select("vec_id", F.col("label").cast("bigint").alias("label"), F.col("embedding").cast("array<double>").alias("x"))
    clean = clean.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & F.forall("x", finite))
    return clean.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "label", F.transform("x", lambda x: F.floor(x * scale)).alias("v"))


def _pack_block(rows) -> dict:
    """One block: vectors of unequal length end in zeros."""
    width = max((len(v) for v in rows["v"]), default=0)
    matrix = np.zeros((len(rows), width), dtype=np.int64)
    for i, v in enumerate(rows["v"]):
        matrix[i, : len(v)] = v
    return {
        "width": width,
        "rids": rows["rid"].to_numpy(np.int64).tobytes(),
        "ids": rows["vec_id"].to_numpy(np.int64).tobytes(),
        "labels": rows["label"].to_numpy(np.int64).tobytes(),
        "columns": np.ascontiguousarray(matrix.T).tobytes(),
    }


def blocks_of(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per block of some `block_rows` vectors, dealt by a hash of the row."""
    import pandas as pd

    count = max(1, -(-rows.count() // block_rows))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{"block": int(group["block"].iloc[0]), **_pack_block(group)}])

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("rid"), F.lit(count)))
    return dealt.groupBy("block").applyInPandas(pack, _BLOCK)


class Block:
    """Columns of one block and the range of each."""

    def __init__(self, row: dict):
        self.rids, self.ids, self.labels = (np.frombuffer(row[c], dtype=np.int64) for c in ("rids", "ids", "labels"))
        self.columns = np.frombuffer(row["columns"], dtype=np.int64).reshape(row["width"], len(self.ids))
        self.low = self.columns.min(axis=1, initial=_MOST)
        self.high = self.columns.max(axis=1, initial=_LEAST)
        #: The largest magnitude, as an unbounded integer.
        self.most = max((max(abs(int(a)), abs(int(b))) for a, b in zip(self.low, self.high, strict=True)), default=0)


@dataclass
class Anchor:
    rid: int
    label: int
    vector: np.ndarray


def narrowing(anchor: Anchor, block: Block, alive: np.ndarray, step: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
    """(candidates, least score, greatest score, whether exact) after each `step` columns, in the
    descending order of the anchor's magnitudes.  The caller may `send` the candidates to go on with."""
    width = min(len(anchor.vector), len(block.columns))
    vector = anchor.vector[:width]
    strongest = max((abs(int(x)) for x in vector), default=0)
    wide = strongest * block.most * max(width, 1) >= _SAFE
    kind = object if wide else np.int64
    vector = vector.astype(kind)
    order = np.argsort(np.array([-abs(int(x)) for x in vector]) if wide else -np.abs(vector), kind="stable")
    low, high = block.low[:width].astype(kind)[order], block.high[:width].astype(kind)[order]
    vector = vector[order]
    # What the columns from each place on can add at the least and at the most.
    least = np.append(np.cumsum(np.minimum(vector * low, vector * high)[::-1])[::-1], 0)
    most = np.append(np.cumsum(np.maximum(vector * low, vector * high)[::-1])[::-1], 0)
    sums = np.zeros(len(alive), dtype=kind)
    for start in range(0, max(width, 1), step):
        end = min(start + step, width)
        if end > start:
            columns = block.columns[np.ix_(order[start:end], alive)].astype(kind)
            sums = sums + vector[start:end] @ columns
        exact = end >= width
        if exact and wide:
            sums = np.array([min(max(int(s), _LEAST), _MOST) for s in sums], dtype=object)
        keep = yield alive, sums + least[end], sums + most[end], exact
        if keep is not None:
            alive, sums = alive[keep], sums[keep]
        if not len(alive):
            return


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def scan_positives(anchor: Anchor, block: Block, bar: int | None, k: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the block and scores of the rows of the anchor's label that can be among its k best."""
    alive = np.flatnonzero((block.labels == anchor.label) & (block.rids != anchor.rid))
    if not len(alive):
        return alive, np.zeros(0, dtype=np.int64)
    scan = narrowing(anchor, block, alive, step)
    state = next(scan)
    while True:
        alive, least, most, exact = state
        floor = bar
        if len(alive) > k:
            here = np.partition(least, len(least) - k)[len(least) - k]
            floor = here if floor is None else max(floor, here)
        keep = np.ones(len(alive), dtype=bool) if floor is None else (most >= floor).astype(bool)
        if exact or not keep.any():
            return alive[keep], least[keep].astype(np.int64)
        state = scan.send(keep)


@dataclass
class ScoreWindow:
    """Scores from `low` to `high`, both included; `bar` is the k-th best found so far."""

    low: int
    high: int
    bar: int | None = None


def scan_windows(anchor: Anchor, block: Block, windows: list[ScoreWindow], k: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact scores of rows of other labels that can be among the k best of a window."""
    alive = np.flatnonzero(block.labels != anchor.label)
    if not len(alive):
        return alive, np.zeros(0, dtype=np.int64)
    scan = narrowing(anchor, block, alive, step)
    state = next(scan)
    while True:
        alive, least, most, exact = state
        keep = np.zeros(len(alive), dtype=bool)
        for w in windows:
            floor = w.low if w.bar is None else max(w.low, w.bar)
            # Only rows that are inside for certain can raise the floor.
            inside = least[((least >= w.low) & (most <= w.high)).astype(bool)]
            if len(inside) > k:
                floor = max(floor, np.partition(inside, len(inside) - k)[len(inside) - k])
            keep |= ((most >= floor) & (least <= w.high)).astype(bool)
        if exact or not keep.any():
            return alive[keep], least[keep].astype(np.int64)
        state = scan.send(keep)


class Best:
    """The k best (score, id) seen so far, ties to the smaller id."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids, self.rids = k, *(np.zeros(0, dtype=np.int64) for _ in range(3))

    @property
    def bar(self) -> int | None:
        return int(self.scores[-1]) if len(self.scores) == self.k else None

    def add(self, scores: np.ndarray, ids: np.ndarray, rids: np.ndarray) -> None:
        scores, ids, rids = (np.concatenate(p) for p in ((self.scores, scores), (self.ids, ids), (self.rids, rids)))
        best = _best(scores, ids, self.k)
        self.scores, self.ids, self.rids = scores[best], ids[best], rids[best]


def _found(rid: int, positive: int, best: Best) -> dict[str, np.ndarray]:
    n = len(best.scores)
    return {"rid": np.full(n, rid), "positive": np.full(n, positive, np.int32), "score": best.scores, "vec_id": best.ids, "other": best.rids}


def _batches(parts: list[dict[str, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    kinds = {"rid": pa.int64(), "positive": pa.int32(), "score": pa.int64(), "vec_id": pa.int64(), "other": pa.int64()}
    for at in range(0, len(parts), 4096):
        some = parts[at : at + 4096]
        yield pa.record_batch({c: pa.array(np.concatenate([p[c] for p in some]), kind) for c, kind in kinds.items()})


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Block(batch.slice(i, 1).to_pylist()[0])


def _positive_scan(sent, k: int, step: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = [Anchor(rid, label, np.array(v, dtype=np.int64)) for rid, label, v in sent.value]
        best = [Best(k) for _ in anchors]
        for block in _blocks(batches):
            for anchor, found in zip(anchors, best, strict=True):
                at, scores = scan_positives(anchor, block, found.bar, k, step)
                if len(at):
                    found.add(scores, block.ids[at], block.rids[at])
        yield from _batches([_found(a.rid, 0, b) for a, b in zip(anchors, best, strict=True) if len(b.scores)])

    return scan


def _window_scan(sent, k: int, step: int, low: int, high: int, of: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = []
        for rid, label, v, scores in sent.value:
            # Windows of negative scores are empty: a share of a negative score lies above it.
            opened = [(n, ScoreWindow(-(-low * s // of), high * s // of), Best(k)) for n, s in scores if low * s <= high * s]
            if opened:
                work.append((Anchor(rid, label, np.array(v, dtype=np.int64)), opened))
        for block in _blocks(batches):
            for anchor, opened in work:
                at, scores = scan_windows(anchor, block, [w for _, w, _ in opened], k, step)
                if not len(at):
                    continue
                for _, window, found in opened:
                    inside = (scores >= window.low) & (scores <= window.high)
                    if inside.any():
                        found.add(scores[inside], block.ids[at[inside]], block.rids[at[inside]])
                        window.bar = found.bar
        yield from _batches([_found(a.rid, n, b) for a, opened in work for n, _, b in opened if len(b.scores)])

    return scan


def hard_negatives(
    vectors: DataFrame,
    every: int = 100,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    scale: int = SCALE,
    block_rows: int = BLOCK_ROWS,
    chunk_rows: int = CHUNK_ROWS,
    step: int = COLUMNS_A_STEP,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Needs vec_id, label and embedding; other columns are ignored.  Anchors are the rows whose
    vec_id is divisible by `every`; an anchor's positives are the `positives` other rows of its
    label that score highest with it, ties to the smaller vec_id.  Of the rows of other labels
    that score from `low` to `high` percent of a positive, the `negatives` highest are returned.
    Left out are the rows that `labelled_vectors` leaves out.  Rows that share a vec_id all take
    part, each for itself.  Vectors of unequal length are compared as if the shorter ended in
    zeros.  Scores beyond 64 bits count as the nearest 64-bit number.  A label without another
    row has no positives, and an empty table no result.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = stage(labelled_vectors(vectors, scale), "vectors")
    blocks = stage(blocks_of(rows, block_rows), "blocks")
    anchors = rows.filter(F.col("vec_id") % every == 0)
    count, width = anchors.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    # Chunks hold no more than a fixed number of bytes, whatever the width of a vector.
    chunk_rows = max(1, min(chunk_rows, CHUNK_BYTES // (8 * max(width or 1, 1))))
    chunks = -(-count // chunk_rows)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not chunks:
        return spark.createDataFrame([], schema)
    anchors = anchors.withColumn("chunk", F.pmod(F.xxhash64(F.col("rid"), F.lit(1)), F.lit(chunks)))
    path = fresh_path(spark, "negatives")
    for chunk in range(chunks):
        own = anchors.filter(F.col("chunk") == chunk).select("rid", "label", "v").collect()
        sent = spark.sparkContext.broadcast([tuple(r) for r in own])
        best = _merged(blocks.mapInArrow(_positive_scan(sent, positives, step), _FOUND), positives)
        best = stage(best.withColumn("positive", F.col("rank")).drop("rank"), "positives")
        scores: dict[int, list] = {}
        for r in best.select("rid", "positive", "score").collect():
            scores.setdefault(r["rid"], []).append((r["positive"], r["score"]))
        asked = spark.sparkContext.broadcast([(*r, scores[r["rid"]]) for r in own if r["rid"] in scores])
        found = _merged(blocks.mapInArrow(_window_scan(asked, negatives, step, low, high, 100), _FOUND), negatives)
        named = best.select("rid", "positive", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
        found.join(named, ["rid", "positive"]).write.parquet(f"{path}/chunk={chunk}")
        sent.unpersist()
        asked.unpersist()
    ids = rows.select("rid", F.col("vec_id").alias("anchor_id"))
    result = spark.read.parquet(path).join(ids, "rid")
    return result.select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The k best of what the tasks found for each anchor and positive, ranked."""
    order = Window.partitionBy("rid", "positive").orderBy(F.col("score").desc(), "vec_id", "other")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def op11_hard_negatives(spark, sf):
    vectors = load(spark, sf, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved))


OP11_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.rid, a.vec_id AS anchor_id, o.vec_id, o.label = a.label AS same, list_dot_product(a.v, o.v)::BIGINT AS score
  FROM v a JOIN v o ON o.rid <> a.rid WHERE a.vec_id % 100 = 0
), positive AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS n FROM scored WHERE same) WHERE n <= 5
), ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, o.vec_id AS negative_id, p.score AS positive_score, o.score AS negative_score,
         row_number() OVER (PARTITION BY p.rid, p.n ORDER BY o.score DESC, o.vec_id)::INTEGER AS rank
  FROM positive p JOIN scored o ON o.rid = p.rid AND NOT o.same AND 80 * p.score <= 100 * o.score AND o.score <= p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
"""
