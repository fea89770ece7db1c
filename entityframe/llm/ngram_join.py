"""Similarity join on word n-grams: MinHash banding, then exact Jaccard.

Documents with equal n-gram sets are one node.  Each node has a MinHash signature cut into
bands; the number of bands and rows is chosen for a target recall at the threshold.  Nodes
that share a band hash meet through the smallest node of that bucket, their hub; a hub's
group is verified on full n-gram sets.  A large group is cut into blocks and every pair of
blocks is a task of its own, so a group of any size is compared whole; a task sends back one
row per node, not its pairs.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from entityframe.llm.common import load, ship, slices, stage, text_or_empty
from entityframe.llm.components import components

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.99999
MOST_HASHES = 160
#: Nodes of a block.
BLOCK = 256
#: Size of the bit map that keeps texts without a candidate from being shuffled.
FILTER_BITS = 1 << 24
_SEED = 20_240_607
_COLUMNS = 8192
# Fixed values of a well-known 64-bit mixing step, and an odd base.
_MIX1, _MIX2, _BASE = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15
_CODE_POINTS = 0x110000


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): as many rows as `most` hashes allow, and so few false candidates, while
    a pair at the threshold shares a band with probability `recall` at least."""
    for rows in range(most, 0, -1):
        share = threshold**rows
        bands = 1 if share >= 1 else math.ceil(math.log1p(-recall) / math.log1p(-share)) if recall < 1 else most
        if bands * rows <= most:
            return max(1, bands), rows
    raise ValueError("no bands reach this recall with so few hashes")


@functools.cache
def _word_table() -> np.ndarray:
    return np.array([chr(c).isalnum() or c == 95 for c in range(_CODE_POINTS)])


@functools.lru_cache(maxsize=8)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.full(size, _BASE, dtype=np.uint64)
        down = np.full(size, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
        up[0] = down[0] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX2)
    return x ^ (x >> np.uint64(31))


def ngram_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the different n-grams of a text's lower-case words.

    A word is a run of letters, digits and underscores.  A text of fewer words has one
    n-gram, all its words; one without words has none.
    """
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    inside = _word_table()[points]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    # The words with one space between them; prefix sums of a polynomial give every n-gram's hash.
    keep = inside.copy()
    keep[ends[ends < len(points)]] = True
    joined = np.where(inside, points, 32)[keep].astype(np.uint64)
    size = 1 << max(12, len(joined).bit_length())
    up, down = _powers(size)
    sums = np.zeros(len(joined) + 1, dtype=np.uint64)
    np.cumsum(joined * up[: len(joined)], out=sums[1:])
    lengths = ends - starts
    first = np.cumsum(lengths + 1) - (lengths + 1)
    last = first + lengths
    n = min(words, len(first))
    a, b = first[: len(first) - n + 1], last[n - 1 :]
    return np.unique(_mixed((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64)))


@functools.cache
def _hash_functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(_SEED)
    return random.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1), random.integers(0, 1 << 63, count, dtype=np.uint64)


def band_hashes(grams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    times, plus = _hash_functions(bands * rows)
    least = np.full(bands * rows, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(grams), 1024):
        part = grams[at : at + 1024]
        np.minimum(least, _mixed_low(part[:, None] * times + plus).min(axis=0), out=least)
    out = np.arange(bands, dtype=np.uint64)
    for column in least.reshape(bands, rows).T:
        out = _mixed((out ^ column) * np.uint64(_BASE))
    return out.view(np.int64)


def _mixed_low(x: np.ndarray) -> np.ndarray:
    return x ^ (x >> np.uint64(32))


def _profiles(words: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys, sizes, signatures = [], [], []
            for text in batch.column("text").to_pylist():
                grams = ngram_set(text, words)
                digest = hashlib.blake2b(grams.tobytes(), digest_size=16).digest()
                keys.append(np.frombuffer(digest, dtype=np.int64))
                sizes.append(len(grams))
                signatures.append(band_hashes(grams, bands, rows) if len(grams) else np.zeros(0, dtype=np.int64))
            keys = np.array(keys).reshape(-1, 2)
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in signatures])]).astype(np.int32)
            values = np.concatenate([np.zeros(0, dtype=np.int64), *signatures])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("text_hash"), pa.array(keys[:, 0]), pa.array(keys[:, 1]),
                    pa.array(sizes, pa.int32()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                ],
                names=["doc_id", "text_hash", "k1", "k2", "grams", "bands"],
            )

    return run


def _sets(words: int):
    """Each node's n-gram set, once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches):
            nodes, sets = [], []
            for node, text in zip(batch.column("node").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if node not in seen:
                    seen.add(node)
                    nodes.append(node)
                    sets.append(ngram_set(text, words).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], names=["node", "grams"])

    return run


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many n-grams each left set has in common with each right set."""
    if len(left) * len(right) <= 16:
        return np.array([[len(np.intersect1d(a, b, assume_unique=True)) for b in right] for a in left])
    every, place = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    owner = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    out = np.zeros((len(left), len(right)), dtype=np.float64)
    for at in range(0, len(every), _COLUMNS):
        lo, hi = np.searchsorted(place, [at, at + _COLUMNS])
        dense = np.zeros((len(left) + len(right), min(_COLUMNS, len(every) - at)), dtype=np.float32)
        dense[owner[lo:hi], place[lo:hi] - at] = 1
        out += dense[: len(left)] @ dense[len(left) :].T
    return out.astype(np.int64)


def verify_block(rows: list[dict], threshold: float) -> list[tuple[int, int, int]]:
    """(node, links, root) of each node with a partner in this pair of blocks of a hub's group.

    `links` counts partners with their copies; nodes linked here have the same root.  A pair
    that meets at several hubs belongs to the smallest.
    """
    nodes = list({r["node"]: r for r in rows}.values())
    lower, upper = nodes[0]["lower"], nodes[0]["upper"]
    left = [r for r in nodes if r["block"] == lower]
    right = left if lower == upper else [r for r in nodes if r["block"] == upper]
    if not left or not right:
        return []
    hub = nodes[0]["hub"]
    a, b = ([np.frombuffer(r["grams"], dtype=np.uint64) for r in side] for side in (left, right))
    sizes_a, sizes_b = (np.array([len(s) for s in side]) for side in (a, b))
    common = _shared(a, b)
    linked = common / (sizes_a[:, None] + sizes_b[None, :] - common) >= threshold
    root = {r["node"]: r["node"] for r in nodes}
    links = dict.fromkeys(root, 0)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for i, j in zip(*np.nonzero(linked), strict=True):
        if left is right and j <= i:
            continue
        x, y = left[i], right[j]
        if (len(x["hubs"]) > 1 and len(y["hubs"]) > 1) and min(set(x["hubs"]) & set(y["hubs"])) != hub:
            continue
        links[x["node"]] += y["copies"]
        links[y["node"]] += x["copies"]
        p, q = find(x["node"]), find(y["node"])
        root[max(p, q)] = min(p, q)
    return [(n, count, find(n)) for n, count in links.items() if count]


def _verifier(threshold: float):
    fields = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def emit(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(3)], schema=fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, found = [], None, []
        for batch in batches:
            for row in batch.to_pylist():
                now = (row["hub"], row["lower"], row["upper"])
                if now != key:
                    if len(held) > 1:
                        found += verify_block(held, threshold)
                    held, key = [], now
                held.append(row)
            if len(found) > 4096:
                yield emit(found)
                found = []
        if len(held) > 1:
            found += verify_block(held, threshold)
        yield emit(found)

    return run


def ngram_join(
    docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK
) -> DataFrame:
    """doc_id, text_hash, class_id, n_links, is_first of each row of `docs`.

    Needs doc_id and text; other columns are ignored.  Two documents are linked if the Jaccard
    similarity of their n-gram sets reaches the threshold; `n_links` counts linked rows, copies
    included.  `class_id` is the smallest doc_id of those reachable over links, and `is_first`
    holds on one document of each class (rows that agree in doc_id and text are one document).
    A text without words (null, empty) has no links and is a class of its own.  A null doc_id
    gives way to any other; a class of null ids has a null class_id.  An empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    bands, rows = choose_bands(threshold, recall)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    keyed = keyed.withColumn("text_hash", F.xxhash64("text"))
    profiles = stage(
        keyed.mapInArrow(
            _profiles(words, bands, rows),
            "doc_id long, text_hash long, k1 long, k2 long, grams int, bands array<long>",
        ),
        "profiles",
    )
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    nodes = (
        profiles.filter("grams > 0")
        .groupBy("k1", "k2")
        .agg(F.count(F.lit(1)).alias("copies"), F.min(place).alias("first"), F.first("bands").alias("bands"))
    )
    nodes = stage(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    verified = stage(_verified(keyed, nodes, words, threshold, block), "verified")
    # One edge per node and task at most.
    edges = verified.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    grouped = stage(components(edges), "components")
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    labelled = (
        nodes.select("node", "k1", "k2", "copies", "first")
        .join(grouped, "node", "left")
        .join(links, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    labelled = stage(labelled, "labelled")
    firsts = labelled.groupBy("component").agg(F.min("first").alias("class"))
    classes = labelled.join(firsts, "component").select(
        "k1", "k2", "class", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    found = profiles.drop("bands").join(classes, ["k1", "k2"], "left")
    alone = F.col("class").isNull()
    first = F.col("doc_id").eqNullSafe(F.col("class.doc_id")) & (F.col("text_hash") == F.col("class.text_hash"))
    return found.select(
        "doc_id",
        "text_hash",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class.doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (alone | first).alias("is_first"),
    )


def _verified(keyed: DataFrame, nodes: DataFrame, words: int, threshold: float, block: int) -> DataFrame:
    banded = nodes.select("node", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = stage(banded.join(buckets.select("band", "hub"), "band").groupBy("node", "hub").count().drop("count"), "met")
    # Only hubs of more than a block are looked up, so that small groups need no shuffle by hub.
    sizes = met.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")).filter("blocks > 1")
    sizes = stage(sizes, "large-hubs")
    hubs = met.groupBy("node").agg(F.sort_array(F.collect_set("hub")).alias("hubs"))
    known = nodes.select("node", "copies", F.col("first.doc_id").alias("first_id"), F.col("first.text_hash").alias("first_hash"))
    wanted = stage(hubs.join(known, "node"), "wanted")
    texts = _maybe(keyed, wanted).join(
        wanted.select("node", "first_id", "first_hash"),
        (F.col("text_hash") == F.col("first_hash")) & F.col("doc_id").eqNullSafe(F.col("first_id")),
    ).select("node", "text")
    sets = texts.mapInArrow(_sets(words), "node long, grams binary")
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    members = met.join(sizes, "hub", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", mine)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = members.select("node", "hub", "block", other).select(
        "node", "hub", "block", F.least("block", "other").alias("lower"), F.greatest("block", "other").alias("upper")
    )
    # Each node's set is sent to its hubs' tasks in one row with what the checks need.
    loaded = pairs.join(wanted.select("node", "hubs", "copies"), "node").join(sets, "node")
    task = ["hub", "lower", "upper"]
    return (
        loaded.repartition(*task).sortWithinPartitions(*task)
        .mapInArrow(_verifier(threshold), "node long, links long, root long")
    )


def _maybe(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """`keyed` without most of the rows that the join with `wanted` drops anyway, so that their
    texts are not shuffled.  A bit map over the hashes of the wanted texts says which: it lets
    through every wanted row and, the fuller it is, the more others.
    """
    words = wanted.select(F.pmod("first_hash", F.lit(FILTER_BITS)).alias("bit")).groupBy(
        F.shiftright("bit", 6).alias("word")
    ).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % 64).cast("int"))).alias("bits"))
    bit = F.pmod("text_hash", F.lit(FILTER_BITS))
    # Bounded by FILTER_BITS / 64 rows of two numbers.
    found = keyed.join(F.broadcast(words), F.shiftright(bit, 6) == F.col("word"))
    return found.filter(F.bit_get("bits", bit % 64) == 1).drop("word", "bits")


def drop_near_copies(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of `docs` that ngram_join calls first in their class, with all their columns."""
    found = ngram_join(docs, **parameters).filter(~F.col("is_first")).select(
        F.col("doc_id").alias("__gone"), F.col("text_hash").alias("__hash")
    ).distinct()
    rows = docs.select(F.struct("*").alias("__row"), F.col("doc_id").alias("__id"), F.xxhash64(text_or_empty("text")).alias("__text"))
    same = (F.col("__text") == F.col("__hash")) & F.col("__id").eqNullSafe(F.col("__gone"))
    return rows.join(stage(found, "near-copies"), same, "left_anti").select("__row.*")


def op4_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join(load(spark, sf, "documents")).select("doc_id", "class_id", "n_links")
