"""Toxicity by the nearest labelled examples, with exact TF-IDF cosine.

Terms are all words of all labelled examples, and those of their beginnings and numbers of
times that labelled toxic texts have more often than others.  A term weighs its inverse
document frequency, and the more the surer it is a sign; no word is left out.
Labelled examples lie in an inverted index; terms that many examples have are columns beside
it, so that a batch of texts meets them in one matrix product.  Every text is compared with
every example, so the neighbours are exact (in single precision).  Their distance-weighted
votes are calibrated on the examples themselves, each left out in turn.

Terms are read out of every text once, into a staged table; document frequencies over all
documents, examples and scores come from there.  The examples are a bounded sample of labelled
rows, and every text is scored whole.  Words that no example has are not in a text's length.
"""

from __future__ import annotations

import pickle
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from entityframe.llm.common import held_out, load, ship, slices, stage

#: Labelled rows that terms and examples are taken from.
EXAMPLES = 8000
#: Weight of a word without any sign of toxicity, against a squared standard score.
PLAIN_WEIGHT = 0.4
#: A term in more than this share of the examples is kept as a column.
COMMON = 1 / 16
NEIGHBOURS = 15
BLOCK = 256
BEGINNINGS = (4, 5, 6)
#: A stem makes a term of its own for each of these numbers of times that a text has it.
TIMES = (1, 2, 4)
#: A text is rejected from this score on.
REJECT = 0.5
_WORD = re.compile(r"\w+")


def _words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def _stems(word: str) -> list[str]:
    """A word and its beginnings, the latter marked by a star."""
    return [word, *(f"{word[:n]}*" for n in BEGINNINGS if len(word) > n)]


def _term(stem: str, times: int) -> str:
    return stem if times == 1 else f"{stem}@{times}"


def _terms(text: str | None) -> set[str]:
    """Terms of a text: each stem, and once more for each number of times that it reaches."""
    stems: Counter = Counter()
    for word, n in Counter(_words(text)).items():
        for stem in _stems(word):
            stems[stem] += n
    return {_term(stem, times) for stem, n in stems.items() for times in TIMES if n >= times}


def _hashes(stems: Iterable[str], size: int = -1) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, stems), np.uint64, size)


def _stem(term: str) -> str:
    return term.rsplit("@", 1)[0] if "@" in term else term


class Vocabulary:
    """The chosen terms and how often texts have each.

    Stems are known by 64-bit hashes in sorted arrays, which take a tenth of the memory of a
    dictionary of words in every worker.
    """

    def __init__(self, terms: list[str]):
        #: Not sent to workers.
        self.terms: list[str] | None = list(terms)
        size, places = len(self.terms), {str(times): i for i, times in enumerate(TIMES)}
        found = _hashes((_stem(t) for t in self.terms), size)
        # Stems that any term is about, and their terms by the times they ask for (-1: none).
        stems, at, slot = np.unique(found, return_index=True, return_inverse=True)
        self._asked = np.full((len(stems), len(TIMES)), -1, dtype=np.int32)
        asked = np.fromiter((places[t.rsplit("@", 1)[1]] if "@" in t else 0 for t in self.terms), np.int64, size)
        self._asked[slot, asked] = np.arange(size)
        begins = np.fromiter((_stem(self.terms[i]).endswith("*") for i in at.tolist()), bool, len(at))
        self._begin, self._begin_slot = stems[begins], np.flatnonzero(begins)
        self._word, self._word_slot = stems[~begins], np.flatnonzero(~begins)
        # The known beginnings of each word, one list after the other, some words at a time.
        words = at[~begins].tolist()
        parts = [self._begun([_stem(self.terms[i]) for i in words[j : j + 4096]]) for j in range(0, len(words), 4096)]
        counts = [np.bincount(of, minlength=min(4096, len(words) - 4096 * j)) for j, (of, _) in enumerate(parts)]
        self._starts = np.cumsum(np.concatenate([np.zeros(1, dtype=np.int64), *counts]))
        self._begins = np.concatenate([np.zeros(0, dtype=np.int64), *[begun for _, begun in parts]])

    def __getstate__(self):
        return self.__dict__ | {"terms": None}

    @property
    def size(self) -> int:
        return int(self._asked.max(initial=-1)) + 1

    def _begun(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(place of the word, slot) of the known beginnings of some words, in their order."""
        if not len(self._begin) or not words:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        cut = [(i, f"{word[:n]}*") for i, word in enumerate(words) for n in BEGINNINGS if len(word) > n]
        of = np.fromiter((i for i, _ in cut), np.int64, len(cut))
        row = _find(self._begin, _hashes((x for _, x in cut), len(cut)))
        return of[row >= 0], self._begin_slot[row[row >= 0]]

    def batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, times) of all terms of some texts, sorted by text."""
        counted = [Counter(_words(text)) for text in texts]
        lengths = np.fromiter(map(len, counted), np.int64, len(counted))
        size = int(lengths.sum())
        of = np.repeat(np.arange(len(counted)), lengths)
        times = np.fromiter(chain.from_iterable(c.values() for c in counted), np.int64, size)
        row = _find(self._word, _hashes(chain.from_iterable(counted), size))
        known, unknown = np.flatnonzero(row >= 0), np.flatnonzero(row < 0)
        # Beginnings, also of words that no example has, add up over the words of a text.
        n = self._starts[row[known] + 1] - self._starts[row[known]]
        ends = np.cumsum(n)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self._starts[row[known]] - ends + n, n)
        strange = [word for word, r in zip(chain.from_iterable(counted), row.tolist(), strict=True) if r < 0]
        others, extra = self._begun(strange)
        source = np.concatenate([np.repeat(known, n), unknown[others]])
        begun = np.concatenate([self._begins[at], extra])
        stride = max(len(self._asked), 1)
        key, sums = _summed(of[source] * stride + begun, times[source])
        of, slot, times = (
            np.concatenate(pair) for pair in ((of[known], key // stride), (self._word_slot[row[known]], key % stride), (times[known], sums))
        )
        asked = self._asked[slot]
        has = (asked >= 0) & (times[:, None] >= TIMES)
        which = np.flatnonzero(has.any(axis=1))
        per = has[which].sum(axis=1)
        of, times, term = np.repeat(of[which], per), np.repeat(times[which], per), asked[which][has[which]].astype(np.int64)
        order = np.argsort(of.astype(np.int16 if len(counted) < 1 << 15 else np.int64), kind="stable")
        return of[order], term[order], times[order]

    def counts(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Terms of each text, rising, and how often it has each."""
        of, term, times = self.batch(texts)
        order = np.lexsort((term, of))
        of, term, times = of[order], term[order], times[order]
        cuts = np.searchsorted(of, np.arange(1, len(texts)))
        return list(zip(np.split(term, cuts), np.split(times, cuts), strict=True))


def _find(known: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The place of each wanted value in a sorted array; -1 where it is not there."""
    if not len(known):
        return np.full(len(wanted), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return np.where(known[at] == wanted, at, -1)


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, rising, and the sum of the values of each."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
    return keys[first], np.add.reduceat(values, first)


class Examples:
    """Inverted index of the labelled examples, and the calibration of its votes.  `block` texts
    are looked up at once."""

    def __init__(
        self, counts: Iterable[tuple[np.ndarray, np.ndarray]], ids: list[int], toxic: list[int], idf: np.ndarray,
        neighbours: int = NEIGHBOURS, block: int = BLOCK,
    ):
        #: Set where texts are to be read; what is scored elsewhere has its terms already.
        self.vocabulary: Vocabulary | None = None
        self.idf, self.neighbours, self.block = idf, neighbours, block
        # Examples lie one after the other in flat arrays, which take a few bytes an entry.
        terms, times, starts, lengths, used, plain = array("i"), array("i"), [0], [], [], []
        for i, pair in enumerate(counts):
            kept, _, length = self._raw(*pair)
            if not length:
                plain.append(toxic[i])
                continue
            for flat, given in zip((terms, times), pair, strict=True):
                flat.frombytes(given[kept].astype(np.int32, copy=False).tobytes())
            starts.append(len(terms))
            lengths.append(length)
            used.append(i)
        self.ids = np.array([ids[i] for i in used], dtype=np.int64)
        self.toxic = np.array([toxic[i] for i in used], dtype=np.float64)
        overall = sum(toxic) / len(toxic) if toxic else 0.0
        #: The score of a text without any term: the share of toxic ones among such examples,
        #: which are few, and as many more as there are neighbours with the share of all.
        self.plain = (sum(plain) + neighbours * overall) / (len(plain) + neighbours)
        terms, times = (np.frombuffer(x, dtype=np.int32) for x in (terms, times))
        order = np.argsort(terms, kind="stable")
        places = np.repeat(np.arange(len(used), dtype=np.min_scalar_type(len(used))), np.diff(starts))[order]
        per = np.bincount(terms, minlength=len(idf)).astype(np.int32)
        self._entries = (per, places, times[order].astype(np.min_scalar_type(times.max(initial=0))), np.array(lengths))
        del order, places
        self._index(*self._entries)
        votes = []
        for at in range(0, len(used), block):
            some = range(at, min(at + block, len(used)))
            vectors = [self._weigh(terms[starts[i] : starts[i + 1]], times[starts[i] : starts[i + 1]]) for i in some]
            votes += [self._vote(near)[0] if len(near[0]) else self.plain for near in self._nearest(vectors, some)]
        self.curve = _isotonic(np.array(votes), self.toxic)

    def __getstate__(self):
        # The index is built anew from the numbers of times, which are small when packed.
        built = ("vocabulary", "column", "columns", "rest", "cuts", "_entries")
        entries = self._entries
        if not isinstance(entries, bytes):
            per, places, *others = entries
            # Differences of unsigned numbers wrap around, and so do their sums.
            entries = zlib.compress(pickle.dumps((per, np.diff(places, prepend=places[:1] * 0), *others)), 6)
        return zlib.compress(pickle.dumps({k: v for k, v in self.__dict__.items() if k not in built}), 6), entries

    def __setstate__(self, state):
        kept, self._entries = state
        self.__dict__.update(pickle.loads(zlib.decompress(kept)), vocabulary=None)
        per, places, *others = pickle.loads(zlib.decompress(self._entries))
        self._index(per, np.cumsum(places, dtype=places.dtype, out=places), *others)

    def _index(self, per: np.ndarray, places: np.ndarray, times: np.ndarray, lengths: np.ndarray) -> None:
        """From the entries of each term in turn: `per` is their number, `places` are the examples."""
        cuts = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(per, dtype=np.int64)])
        common = np.flatnonzero(per > max(COMMON * len(lengths), 1))
        #: Column of each common term, -1 for the others.
        self.column = np.full(len(per), -1, dtype=np.int32)
        self.column[common] = np.arange(len(common))
        self.columns = np.zeros((len(lengths), len(common)), dtype=np.float32)
        rare = self.column < 0
        self.cuts = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(np.where(rare, per, 0), dtype=np.int64)])
        #: Weight (lower half) and place (upper half) of each other entry, so that one look-up finds both.
        self.rest = np.empty(self.cuts[-1], dtype="<i8")
        halves = self.rest.view("<i4").reshape(-1, 2)
        # Some terms at a time, so that little more than the index is held.
        for low in range(0, len(per), 1024):
            high = min(low + 1024, len(per))
            part, n = slice(cuts[low], cuts[high]), per[low:high]
            weights = (1 + np.log(times[part].astype(np.int32))) * np.repeat(self.idf[low:high], n) / lengths[places[part]]
            among = np.repeat(rare[low:high], n)
            to = slice(self.cuts[low], self.cuts[high])
            halves[to, 0], halves[to, 1] = weights[among].astype("<f4").view("<i4"), places[part][among]
            self.columns[places[part][~among], np.repeat(self.column[low:high], n)[~among]] = weights[~among]

    def _raw(self, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Which terms weigh anything, their weights, and the length of those."""
        weights = (1 + np.log(counts)) * self.idf[terms]
        kept = weights > 0
        weights = weights[kept]
        return kept, weights, float(np.sqrt(weights @ weights)) if len(weights) else 0.0

    def _weigh(self, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kept, weights, length = self._raw(terms, counts)
        return (terms[kept], weights / length) if length else (terms[:0], weights[:0])

    def nearest(self, vector: tuple[np.ndarray, np.ndarray], without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the nearest examples with a cosine above 0, nearest first;
        ties go to the earlier place."""
        return next(self._nearest([vector], [without]))

    def _nearest(self, vectors: list, without: Iterable[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        without = list(without)
        for at in range(0, len(vectors), self.block):
            part = vectors[at : at + self.block]
            of = np.repeat(np.arange(len(part)), [len(terms) for terms, _ in part])
            terms, weights = (np.concatenate(x) for x in zip(*part, strict=True))
            weights, column = weights.astype(np.float32), self.column[terms]
            asked = np.zeros((len(part), self.columns.shape[1]), dtype=np.float32)
            among = column >= 0
            asked[of[among], column[among]] = weights[among]
            rare = np.flatnonzero(~among)
            starts, ends, weights = self.cuts[terms[rare]], self.cuts[terms[rare] + 1], weights[rare]
            cuts = np.searchsorted(of[rare], np.arange(len(part) + 1)).tolist()
            for row, (sums, left) in enumerate(zip(asked @ self.columns.T, without[at : at + self.block], strict=True)):
                own = slice(cuts[row], cuts[row + 1])
                yield self._best(self._added(sums, starts[own], ends[own] - starts[own], weights[own]), left)

    def _added(self, sums: np.ndarray, starts: np.ndarray, n: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What the common terms add to the cosine with each example, and what the others add, whose
        `n` entries each begin at `starts`."""
        ends = np.cumsum(n)
        if not len(n) or not len(sums) or not ends[-1]:
            return sums.astype(np.float64)
        at = np.repeat(starts - ends + n, n)
        at += np.arange(ends[-1])
        found = self.rest.take(at, mode="clip")
        products = found.view("<f4")[::2] * np.repeat(weights, n)
        found >>= 32
        return sums + np.bincount(found, products, minlength=len(sums))

    def _best(self, sums: np.ndarray, without: int) -> tuple[np.ndarray, np.ndarray]:
        if without >= 0:
            sums[without] = 0.0
        k = min(self.neighbours, len(sums))
        least = np.partition(sums, len(sums) - k)[len(sums) - k] if k else 0.0
        # Rounding must not leave out a tie.
        near = np.flatnonzero(sums >= least - 1e-6 if least > 1e-6 else sums > 0)
        best = near[np.lexsort((near, -np.round(sums[near], 6)))[:k]]
        return best, sums[best].astype(np.float64)

    def _vote(self, near: tuple[np.ndarray, np.ndarray]) -> tuple[float, np.ndarray]:
        places, cosines = near
        # Close neighbours count most; a distant lone neighbour leaves room for the plain share.
        weights = cosines / (1.05 - np.minimum(cosines, 1.0))
        return float((weights @ self.toxic[places] + self.plain) / (weights.sum() + 1)), weights

    def scores(self, counts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """(score, ids of the nearest examples, their cosines) of texts with these terms."""
        out = []
        for near in self._nearest([self._weigh(*c) for c in counts], [-1] * len(counts)):
            if len(near[0]):
                score = float(np.interp(self._vote(near)[0], *self.curve))
                out.append((score, self.ids[near[0]], near[1]))
            else:
                out.append((self.plain, self.ids[:0], near[1]))
        return out


def _isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of a rising line that best fits y at x; each point pools neighbours that would fall."""
    if not len(x):
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # sum of x, sum of y, count
    for i in order:
        pools.append([float(x[i]), float(y[i]), 1.0])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    # Half a case of either label keeps sure scores off 0 and 1.
    return np.array([p[0] / p[2] for p in pools]), np.array([(p[1] + 0.5) / (p[2] + 1) for p in pools])


def _choose(labels: DataFrame, most: int) -> DataFrame:
    """doc_id, toxic of up to `most` labelled rows, the first by a hash of the id."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic")
    )
    # Bounded by `most` rows of two numbers, which are broadcast.
    return stage(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most), "chosen")


def _count_terms(sample: DataFrame) -> tuple[list[str], np.ndarray]:
    """The terms of the sample, and how each counts besides its document frequency: as a word,
    and by how sure a sign of toxicity it is.  The latter is the squared standard score of its
    log odds ratio, without the first toxic text, which may have it by chance."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n, toxic = Counter(), Counter()
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                terms = _terms(text)
                n.update(terms)
                if label:
                    toxic.update(terms)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64()), pa.array([toxic[t] for t in n], pa.int64())],
                names=["term", "n", "toxic"],
            )

    rows, toxic = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not toxic or toxic == rows:
        return [], np.zeros(0)
    counts = sample.select("text", "toxic").mapInArrow(tally, "term string, n long, toxic long")
    counts = counts.groupBy("term").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    # What is no word and in fewer than two toxic texts counts nothing by the formula below.
    # Bounded by the different words of EXAMPLES texts and the beginnings of the toxic ones.
    found = counts.filter(~F.col("term").rlike("[*@]") | (F.col("toxic") > 1)).toArrow().sort_by("term")
    n, bad = (found.column(c).to_numpy().astype(np.float64) for c in ("n", "toxic"))
    odds = np.log((bad + 0.5) / (toxic + 1)) - np.log((n - bad + 0.5) / (rows - toxic + 1))
    sure = np.square(np.maximum(odds, 0.0)) / (1 / (bad + 0.5) + 1 / (n - bad + 0.5))
    sure *= np.maximum(bad - 1, 0) / np.maximum(bad, 1)
    derived = pc.match_substring_regex(found.column("term"), "[*@]").to_numpy()
    counts = sure + PLAIN_WEIGHT * ~derived
    return found.column("term").filter(pa.array(counts > 0)).to_pylist(), counts[counts > 0]


def _with_terms(docs: DataFrame, vocabulary: Vocabulary, kept: list[str], tally: bool = False) -> DataFrame:
    """row, terms, times: each row's `kept` columns as a struct, and the terms of its text, packed as
    Spark moves a few long values faster than many numbers.  With `tally`, a task adds one row with a
    null struct: the terms it has seen, and in how many texts."""
    # Bounded by the different terms of EXAMPLES texts.
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    # The text goes to Python once.
    inside = "text" in kept
    rows = docs.select(F.struct(*[F.col(_quoted(c)) for c in kept]).alias("row"), *([] if inside else ["text"]))
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), *[T.StructField(c, T.BinaryType()) for c in ("terms", "times")]])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, row = np.zeros(shared.value.size, dtype=np.int64), None
        for batch in slices(batches, 256):
            row = batch.column("row").type
            texts = batch.column("row").field("text") if inside else batch.column("text")
            of, terms, times = shared.value.batch(texts.to_pylist())
            seen += np.bincount(terms, minlength=len(seen))
            lists = _packed(np.searchsorted(of, np.arange(batch.num_rows + 1)), terms, times)
            yield pa.RecordBatch.from_arrays([batch.column("row"), *lists], names=["row", "terms", "times"])
        if tally and row is not None:
            terms = np.flatnonzero(seen)
            lists = _packed(np.array([0, len(terms)]), terms, seen[terms])
            yield pa.RecordBatch.from_arrays([pa.nulls(1, row), *lists], names=["row", "terms", "times"])

    return rows.mapInArrow(count, schema)


@contextmanager
def _small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Whole texts go to Python and come back: fewer rows at a time bound the buffers on both sides."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _packed(cuts: np.ndarray, terms: np.ndarray, times: np.ndarray) -> list[pa.BinaryArray]:
    """Terms as 32-bit numbers, and times in as few bytes as the largest of them needs."""
    values = [terms.astype("<u4"), times.astype(np.min_scalar_type(times.max(initial=0)).newbyteorder("<"))]
    return [
        pa.BinaryArray.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * x.itemsize).astype(np.int32)), pa.py_buffer(x)])
        for x in values
    ]


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Terms of each row and how often it has each."""
    for terms, times in zip(*(batch.column(c).to_pylist() for c in ("terms", "times")), strict=True):
        width = 4 * len(times) // len(terms) if terms else 1
        yield np.frombuffer(terms, "<i4"), np.frombuffer(times, f"<u{width}").astype(np.int32)


def _sums(tallies: DataFrame) -> DataFrame:
    """term, n: in how many texts each term is."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            for terms, times in _unpacked(batch):
                yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(times, pa.int64())], names=["term", "n"])

    counted = tallies.select("terms", "times").mapInArrow(spread, "term int, n long")
    return counted.groupBy("term").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> Examples:
    """The index over labelled rows of `labels` (doc_id, toxic) that `docs` (doc_id, text) has.

    Rows without an id or with a label other than 0 and 1 teach nothing; of repeated labels the
    larger counts.  Without toxic and clean examples every score is the share of toxic ones
    (0 without any label).
    """
    vocabulary, packed, _ = _fit(docs, labels, ["doc_id"], examples)
    model = pickle.loads(packed.data)
    model.vocabulary = vocabulary
    return model


def _fit(
    docs: DataFrame, labels: DataFrame, kept: list[str], examples: int = EXAMPLES
) -> tuple[Vocabulary, Packed, DataFrame]:
    """The vocabulary, the index, and all rows with their terms, which are read out of each text once: document
    frequencies, examples and scores all come from that table."""
    ship(docs.sparkSession)
    chosen = _choose(labels, examples)
    terms, counts = _count_terms(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))
    vocabulary = Vocabulary(terms)
    with _small_batches(docs.sparkSession):
        staged = stage(_with_terms(docs, vocabulary, kept, tally=True), "terms", compression="zstd")
    counted, tallies = (staged.filter(f"row IS {what}") for what in ("NOT NULL", "NULL"))
    # One row per term at most comes back.
    found = _sums(tallies).toArrow()
    seen = np.zeros(len(terms))
    seen[found.column("term").to_numpy()] = found.column("n").to_numpy()
    weights = np.maximum(np.log((counted.count() + 1) / (seen + 0.5)), 0.0) * counts
    taught = counted.select(F.col("row.doc_id").cast("long").alias("doc_id"), "terms", "times").join(F.broadcast(chosen), "doc_id")
    # Bounded by `examples` texts; rows that repeat an id are one example.  They meet in one task,
    # which makes the index; the driver sees its packed form only.
    learnt = taught.dropDuplicates(["doc_id"]).repartition(1).mapInArrow(_learner(weights), "model binary").first()
    packed = Packed(pickle.dumps(Examples([], [], [], weights)) if learnt is None else bytes(learnt["model"]))
    return vocabulary, packed, counted


class Packed:
    """A pickled index, which is unpacked where it is sent to."""

    def __init__(self, data: bytes):
        self.data = data

    def __getstate__(self):
        return self.data

    def __setstate__(self, data: bytes):
        self.examples = pickle.loads(data)


def _learner(weights: np.ndarray):
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            rows += zip(batch.column("doc_id").to_pylist(), batch.column("toxic").to_pylist(), _unpacked(batch), strict=True)
        rows.sort(key=lambda r: r[0])
        ordered = ((terms[o], times[o]) for *_, (terms, times) in rows for o in [np.argsort(terms)])
        model = Examples(ordered, [r[0] for r in rows], [r[1] for r in rows], weights)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    return learn


def with_scores(docs: DataFrame, model: Examples) -> DataFrame:
    """row, toxicity: each row of `docs` (which needs text) as a struct, and its `score`,
    `evidence_ids` and `evidence_cosines`.

    A null or empty text has the score of a text without any term.  No rows move, so copies and repeated ids do not matter.
    """
    ship(docs.sparkSession)
    return _scored(_with_terms(docs, model.vocabulary, docs.columns), Packed(pickle.dumps(model)))


def _scored(counted: DataFrame, packed: Packed) -> DataFrame:
    # Bounded by EXAMPLES and their terms.
    shared = counted.sparkSession.sparkContext.broadcast(packed)
    verdict = pa.struct([("score", pa.float64()), ("evidence_ids", pa.list_(pa.int64())), ("evidence_cosines", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = shared.value.examples
        for batch in slices(batches):
            scores, *evidence = zip(*examples.scores(list(_unpacked(batch))), strict=True)
            ends = pa.array(np.cumsum([0, *map(len, evidence[0])]), pa.int32())
            lists = [
                pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x), kind))
                for x, kind in zip(evidence, (pa.int64(), pa.float64()), strict=True)
            ]
            found = pa.StructArray.from_arrays([pa.array(scores, pa.float64()), *lists], fields=list(verdict))
            yield pa.RecordBatch.from_arrays([batch.column("row"), found], names=["row", "toxicity"])

    return counted.mapInArrow(run, _row_schema(counted)).select("row", "toxicity")


def _row_schema(kept: DataFrame) -> T.StructType:
    verdict = T.StructType(
        [
            T.StructField("score", T.DoubleType()),
            T.StructField("evidence_ids", T.ArrayType(T.LongType())),
            T.StructField("evidence_cosines", T.ArrayType(T.DoubleType())),
        ]
    )
    return T.StructType([T.StructField("row", kept.schema["row"].dataType), T.StructField("toxicity", verdict)])


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence_ids, evidence_cosines of each row.

    Learns from labelled documents whose crc32 of the id, modulo 5, is not 0; the others are
    held out.  An empty table gives an empty result.
    """
    _, packed, counted = _fit(docs, labels.filter(~held_out("doc_id", 5, 0)), ["doc_id"])
    scored = _scored(counted, packed)
    return scored.select(
        "row.doc_id",
        held_out("row.doc_id", 5, 0).alias("held_out"),
        "toxicity.score",
        (F.col("toxicity.score") >= REJECT).cast("int").alias("predicted"),
        "toxicity.evidence_ids",
        "toxicity.evidence_cosines",
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that score below REJECT, with all their columns."""
    _, packed, counted = _fit(docs, labels.filter(~held_out("doc_id", 5, 0)), docs.columns)
    return _scored(counted, packed).filter(F.col("toxicity.score") < REJECT).select("row.*")


def op5_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity(load(spark, sf, "documents"), load(spark, sf, "labels"))
