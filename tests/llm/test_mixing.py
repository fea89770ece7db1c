from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from entityframe.llm.mixing import mix, source_targets, take_mix, word_counts

SCHEMA = "doc_id long, text string, source string, size string, target int, rank int"


def rows_of(counts, start=0):
    """(source, words) pairs as rows with clashing extra columns."""
    return [(start + i, "w " * n if n is not None else None, s, "x", 1, 2) for i, (s, n) in enumerate(counts)]


def fair(sizes, weights=(5, 2, 1), most=3):
    """Targets by sharing out the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free} if free else {}
        above = [s for s in free if share[s] > most * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: most * sizes[s] for s in above}


@pytest.mark.parametrize(
    "counts",
    [
        [("a", 10)] * 50 + [("b", 3)] * 40 + [("c", 7)] * 30,
        [("big", 1000)] * 30 + [("tiny", 1)] * 3 + [(None, 2)] * 4 + [("é", 5)] * 6 + [("Z", 9)] * 10,
        [("only", 4)] * 9,
        [("a", 0), ("b", 0), ("c", None)],
    ],
)
def test_targets_and_taken(spark, counts):
    docs = spark.createDataFrame(rows_of(counts), SCHEMA)
    sizes = defaultdict(int)
    for s, n in counts:
        sizes[s] += n or 0
    want = fair(dict(sizes)) if sum(sizes.values()) else dict.fromkeys(sizes, 0.0)
    got = {r["source"]: r["target"] for r in source_targets(word_counts(docs.drop("size", "target"))).collect()}
    assert got == pytest.approx(want)
    rows = mix(docs).collect()
    assert len(rows) == len(counts)
    assert all(r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0) for r in rows)
    source = {i: s for i, (s, _) in enumerate(counts)}
    taken, largest = defaultdict(int), max(n or 0 for _, n in counts)
    for r in rows:
        taken[source[r["doc_id"]]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= largest / 2 for s in want)


def test_few_bins_and_reruns_agree(spark):
    docs = spark.createDataFrame(rows_of([("a", i % 17) for i in range(300)] + [("b", 40)] * 60), SCHEMA)
    first = sorted(map(tuple, mix(docs, bins=2).collect()))
    assert first == sorted(map(tuple, mix(docs.repartition(7), bins=4096).collect()))


def test_preferred_documents_are_taken_more_often(spark):
    rows = [(i, "w w w", "a", 3.0 if i % 2 else 0.5) for i in range(2000)] + [(5000 + i, "w w w", "b", 1.0) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, liking double")
    copies = mix(docs, weights=(1, 5), prefer="liking").filter("doc_id < 5000").groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.avg("copies").alias("n"))
    mean = {r["odd"]: r["n"] for r in copies.collect()}
    assert mean[1] > 4 * mean[0]


def test_take_mix_repeats_rows_and_shares_among_equal_ones(spark):
    rows = rows_of([("a", 5)] * 20 + [("b", 100)] * 10)
    rows += rows[:3] + [rows[0]]
    docs = spark.createDataFrame(rows, SCHEMA)
    taken = take_mix(docs)
    assert taken.columns == docs.columns
    words = sum(len(r["text"].split()) for r in taken.collect())
    assert words == mix(docs).agg(F.sum("taken")).first()[0]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mix(docs).collect() == [] and take_mix(docs).collect() == []
