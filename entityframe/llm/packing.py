"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

Pieces shorter than a sequence are dealt into shards by their rank in length, so that every
shard has the same mix of lengths.  Several islands evolve packings of each shard.  An
offspring takes whole well-filled sequences of one parent; the other parent's sequences that
share a piece with them are broken up, and the pieces set free are placed best fit.  Between
epochs the best packing of each island moves on to the next one, through a table in the
shared folder.  An island stops as soon as its packing meets a lower bound.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from entityframe.llm.common import load, ship, slices, stage, text_or_empty
from entityframe.llm.tokens import encoder, vocabulary_path
from entityframe.operators.paging import numbered

LENGTH = 2048
SEPARATOR = 0
#: Pieces of a shard, islands of a shard, packings of an island.
SHARD = 16_384
ISLANDS = 3
POPULATION = 6
GENERATIONS = 8
EPOCHS = 2
_PIECES = "doc_id long, text_hash long, piece int, start long, length long, ids_crc32 long"
_ROWS = 8192


# --- pieces ----------------------------------------------------------------------------


def _cut(n: int, length: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of n ids; where there are several the first may be shorter."""
    first = n if n <= length else n % length or length
    return [(0, first), *((a, a + length) for a in range(first, n, length))]


def _ids(encode, text: str) -> np.ndarray:
    return np.append(encode.ids(text), np.uint32(SEPARATOR)).astype("<u4")


def _cutter(path: str, length: int, with_ids: bool):
    names = [part.split()[0] for part in _PIECES.split(", ")] + ["ids"] * with_ids
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int64())] * with_ids
    fields = pa.schema(list(zip(names, kinds, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in slices(batches):
            rows: list[tuple] = []
            for doc_id, text_hash, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_hash", "text")), strict=True):
                ids = _ids(encode, text)
                for piece, (a, b) in enumerate(_cut(len(ids), length)):
                    part = ids[a:b]
                    rows.append((doc_id, text_hash, piece, a, b - a, zlib.crc32(part), *([part.astype(np.int64)] if with_ids else [])))
                if len(rows) >= _ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], schema=fields)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], schema=fields)

    return run


def _texts(docs: DataFrame) -> DataFrame:
    text = text_or_empty("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


# --- grouping genetic algorithm -------------------------------------------------------


class Problem:
    """Pieces (longest first) to be packed into sequences of `capacity`."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.lengths = np.asarray(lengths, dtype=np.int64)
        self.plain = self.lengths.tolist()
        self.capacity = capacity
        self.bound = self._bound()

    def _bound(self) -> int:
        """No packing has fewer sequences: pieces over half a sequence cannot share one, and what
        does not fit beside them needs more."""
        counts = np.bincount(self.lengths, minlength=self.capacity + 1)
        sums = np.cumsum(counts * np.arange(self.capacity + 1))
        totals = np.cumsum(counts)
        n, half = totals[-1], self.capacity // 2
        best = -(-int(sums[-1]) // self.capacity)
        for a in range(half + 1):  # pieces shorter than a are left out
            big = int(n - totals[self.capacity - a])
            middle = int(totals[self.capacity - a] - totals[half])
            room = middle * self.capacity - int(sums[self.capacity - a] - sums[half])
            small = int(sums[half] - (sums[a - 1] if a else 0))
            best = max(best, big + middle + max(0, -(-(small - room) // self.capacity)))
        return best

    def best_fit(self, items: list[int], fills: list[int], owner: np.ndarray) -> None:
        """Puts `items`, in their order, where they leave the least room; opens sequences as needed."""
        by_room: dict[int, list[int]] = {}
        rooms = 0  # bit r is set where a sequence has room r
        for b, fill in enumerate(fills):
            room = self.capacity - fill
            if room:
                by_room.setdefault(room, []).append(b)
                rooms |= 1 << room
        for i in items:
            size = self.plain[i]
            fitting = rooms >> size
            if fitting:
                room = size + (fitting & -fitting).bit_length() - 1
                held = by_room[room]
                b = held.pop()
                if not held:
                    rooms ^= 1 << room
            else:
                b, room = len(fills), self.capacity
                fills.append(0)
            owner[i] = b
            fills[b] += size
            room -= size
            if room:
                held = by_room.setdefault(room, [])
                if not held:
                    rooms |= 1 << room
                held.append(b)


class Packing:
    """owner[i] is the sequence of piece i; fills are the sequences' tokens."""

    def __init__(self, owner: np.ndarray, fills: np.ndarray, capacity: int):
        self.owner, self.fills = owner, fills
        # Well-filled sequences count more than evenly filled ones.
        self.fitness = float(np.mean((fills / capacity) ** 2)) if len(fills) else 1.0

    @property
    def rank(self) -> tuple[int, float]:
        return len(self.fills), -self.fitness


def packed(problem: Problem, order: list[int]) -> Packing:
    owner, fills = np.full(len(order), -1, dtype=np.int64), []
    problem.best_fit(order, fills, owner)
    return Packing(owner, np.array(fills, dtype=np.int64), problem.capacity)


def crossover(problem: Problem, host: Packing, donor: Packing, random: np.random.Generator) -> Packing:
    """`host` with whole well-filled sequences of `donor`."""
    share = random.uniform(0.02, 0.12)
    keen = random.random(len(donor.fills)) * (donor.fills / problem.capacity) ** 4
    chosen = np.argsort(-keen, kind="stable")[: max(1, int(share * len(donor.fills)))]
    injected = np.isin(donor.owner, chosen)
    # Host sequences with a duplicate are broken up; a few of the emptiest go too.
    broken = np.zeros(len(host.fills), dtype=bool)
    broken[host.owner[injected]] = True
    broken[np.argsort(host.fills, kind="stable")[:4]] = True
    kept = np.flatnonzero(~broken)
    renamed = np.full(len(host.fills), -1, dtype=np.int64)
    renamed[kept] = np.arange(len(kept))
    owner = renamed[host.owner]
    places = np.full(len(donor.fills), -1, dtype=np.int64)
    places[chosen] = len(kept) + np.arange(len(chosen))
    owner[injected] = places[donor.owner[injected]]
    fills = [*host.fills[kept].tolist(), *donor.fills[chosen].tolist()]
    problem.best_fit(np.flatnonzero(owner < 0).tolist(), fills, owner)  # pieces are longest first
    return Packing(owner, np.array(fills, dtype=np.int64), problem.capacity)


def mutated(problem: Problem, parent: Packing, random: np.random.Generator) -> Packing:
    """`parent` with some random sequences broken up and packed anew."""
    broken = random.random(len(parent.fills)) < 8 / max(8, len(parent.fills))
    kept = np.flatnonzero(~broken)
    renamed = np.full(len(parent.fills), -1, dtype=np.int64)
    renamed[kept] = np.arange(len(kept))
    owner, fills = renamed[parent.owner], parent.fills[kept].tolist()
    problem.best_fit(np.flatnonzero(owner < 0).tolist(), fills, owner)
    return Packing(owner, np.array(fills, dtype=np.int64), problem.capacity)


def evolve(
    problem: Problem, seed: list[int], migrants: list[Packing] = (), population: int = POPULATION, generations: int = GENERATIONS
) -> Packing:
    """One island's best packing after an epoch."""
    random = np.random.default_rng(seed)
    n = len(problem.plain)
    people = [*migrants]
    if not people:
        people.append(packed(problem, list(range(n))))
    if min(p.rank for p in people)[0] > problem.bound:
        while len(people) < population:
            # Best fit in an order that is decreasing but for some noise.
            noisy = problem.lengths * random.uniform(0.8, 1.2, n)
            people.append(packed(problem, np.argsort(-noisy, kind="stable").tolist()))
        for _ in range(generations):
            people.sort(key=lambda p: p.rank)
            if len(people[0].fills) <= problem.bound:
                break
            parents = people[: max(2, population // 2)]
            young = []
            while len(young) < population - len(parents):
                host, donor = random.choice(len(parents), 2, replace=False)
                young.append(crossover(problem, parents[host], parents[donor], random))
            if random.random() < 0.5:
                young[-1] = mutated(problem, young[-1], random)
            people = parents + young
    return min(people, key=lambda p: p.rank)


# --- islands ---------------------------------------------------------------------------

_ELITE = "shard long, island int, bound int, sequences int, fitness double, owner array<int>"


def _islander(capacity: int, epoch: int, population: int, generations: int):
    fields = pa.schema(
        [("shard", pa.int64()), ("island", pa.int32()), ("bound", pa.int32()), ("sequences", pa.int32()), ("fitness", pa.float64()), ("owner", pa.list_(pa.int32()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                problem = Problem(np.array(row["lengths"]), capacity)
                migrants = []
                for owner in row["migrants"] or []:
                    owner = np.array(owner, dtype=np.int64)
                    fills = np.bincount(owner, weights=problem.lengths).astype(np.int64)
                    migrants.append(Packing(owner, fills, capacity))
                best = evolve(problem, [epoch, row["shard"], row["island"]], migrants, population, generations)
                found = {
                    "shard": row["shard"], "island": row["island"], "bound": problem.bound, "sequences": len(best.fills),
                    "fitness": best.fitness, "owner": best.owner.tolist(),
                }
                yield pa.RecordBatch.from_pylist([found], schema=fields)

    return run


def _evolved(shards: DataFrame, capacity: int, islands: int, epochs: int, population: int, generations: int) -> DataFrame:
    """shard and the owner list of its best packing over all islands and epochs."""
    every = F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island")
    all_elites = None
    for epoch in range(epochs):
        tasks = shards.select("shard", "lengths", every)
        if all_elites is None:
            tasks = tasks.withColumn("migrants", F.lit(None).cast("array<array<int>>"))
        else:
            solved = elites.groupBy("shard").agg(F.min(F.col("sequences") - F.col("bound")).alias("over")).filter("over > 0")
            if solved.isEmpty():
                break
            # An island starts from its own best packing and that of the island before it.
            own = elites.select("shard", "island", "owner")
            moved = own.withColumn("island", ((F.col("island") + 1) % islands).cast("int"))
            arrived = own.unionByName(moved).groupBy("shard", "island").agg(F.collect_set("owner").alias("migrants"))
            tasks = tasks.join(solved.select("shard"), "shard", "left_semi").join(arrived, ["shard", "island"])
        dealt = tasks.repartition("shard", "island")
        elites = stage(dealt.mapInArrow(_islander(capacity, epoch, population, generations), _ELITE), "elites")
        all_elites = elites if all_elites is None else all_elites.unionByName(elites)
    best = F.min_by("owner", F.struct("sequences", -F.col("fitness"), "island")).alias("owner")
    return all_elites.groupBy("shard").agg(best)


def _laid_out(capacity: int):
    """Sequence and offset of every piece of a shard."""
    fields = pa.schema([("uid", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                owner, lengths = np.array(row["owner"], dtype=np.int64), np.array(row["lengths"], dtype=np.int64)
                order = np.argsort(owner, kind="stable")
                before = np.cumsum(lengths[order]) - lengths[order]
                first = np.flatnonzero(np.diff(owner[order], prepend=-1))
                offsets = np.empty(len(owner), dtype=np.int64)
                offsets[order] = before - np.repeat(before[first], np.diff(np.append(first, len(owner))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["uids"], pa.int64()), pa.array((row["shard"] << 32) + owner), pa.array(offsets)], schema=fields
                )

    return run


def pack_documents(
    docs: DataFrame,
    length: int = LENGTH,
    vocabulary: str | None = None,
    shard: int = SHARD,
    islands: int = ISLANDS,
    epochs: int = EPOCHS,
    population: int = POPULATION,
    generations: int = GENERATIONS,
) -> DataFrame:
    """Where each piece of each row of `docs` lies: doc_id, text_hash, piece, start, length,
    ids_crc32, sequence_id, offset.

    Needs doc_id and text; other columns are ignored.  A document is its ids and the
    separator; null text is empty and gives the separator alone.  Only a document longer than
    a sequence is cut.  Rows that repeat an id or a text are packed each.  The same rows give
    as many sequences again.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    pieces = _texts(docs).mapInArrow(_cutter(vocabulary or vocabulary_path(), length, False), _PIECES)
    pieces = stage(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    short = pieces.filter(F.col("length") < length).select("uid", "length")
    shards_count = max(1, -(-short.count() // shard))
    dealt = numbered(short, [F.col("length").desc(), "uid"], "place").withColumn("shard", F.col("place") % shards_count)
    # Bounded by `shard` pieces each.
    listed = dealt.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("place", "uid", "length"))).alias("items"))
    shards = stage(
        listed.select("shard", F.col("items.uid").alias("uids"), F.transform("items.length", lambda x: x.cast("int")).alias("lengths")),
        "shards",
    )
    best = _evolved(shards, length, islands, epochs, population, generations)
    placed = shards.join(best, "shard").mapInArrow(_laid_out(length), "uid long, sequence_id long, offset long")
    whole = (F.col("length") == length)
    alone = pieces.filter(whole).withColumns({"sequence_id": -F.col("uid") - 1, "offset": F.lit(0).cast("long")})
    return pieces.filter(~whole).join(placed, "uid").unionByName(alone).drop("uid")


def token_sequences(docs: DataFrame, placed: DataFrame, length: int = LENGTH, vocabulary: str | None = None) -> DataFrame:
    """sequence_id and ids of every sequence of `placed` (from pack_documents over `docs`)."""
    ship(docs.sparkSession)
    cut = _texts(docs).mapInArrow(_cutter(vocabulary or vocabulary_path(), length, True), f"{_PIECES}, ids array<long>")
    cut = cut.select(F.col("doc_id").alias("__id"), "text_hash", "piece", "ids").dropDuplicates(["__id", "text_hash", "piece"])
    found = placed.join(cut, ["text_hash", "piece"]).filter(F.col("doc_id").eqNullSafe(F.col("__id")))
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return found.groupBy("sequence_id").agg(F.flatten(parts["ids"]).alias("ids"))


def op1_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack_documents(load(spark, sf, "documents")).drop("text_hash")
