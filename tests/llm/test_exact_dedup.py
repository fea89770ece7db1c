import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from entityframe.llm.exact_dedup import build_index, drop_copies, exact_dedup

SCHEMA = "doc_id long, text string, lang string, hash string, kept int"
ROWS = [
    (1, "same", "en", "x", 0), (9, "same", None, "y", 0), (9, "same", "fr", "z", 1), (3, None, "en", "x", 0), (2, "", "en", "x", 0),
    (None, "same", "en", "x", 0), (4, "other\u0000", "en", "x", 0), (5, "other", "en", "x", 0), (6, "é" * 200_000, "de", "x", 0),
    (None, "nobody", None, None, None), (7, "Same", "en", "x", 0),
]


def brute(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(t.encode()).hexdigest()
        left = 1
        for i in sorted(ids, key=lambda i: i is None):
            kept = i == keep and left == 1
            left -= kept
            out.append((i, keep, len(ids), kept, digest))
    return sorted(map(repr, out))


def result(df):
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())


# All hashes alike, few hashes, and the real one.
HASHES = [lambda t: F.lit(5).cast("bigint"), lambda t: F.xxhash64(F.length(t) % 2), None]


@pytest.mark.parametrize("text_hash", HASHES)
@pytest.mark.parametrize("capacity", [1, 100])
def test_matches_brute_force(spark, text_hash, capacity):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    args = {"text_hash": text_hash} if text_hash else {}
    assert result(exact_dedup(docs, capacity, **args)) == brute(ROWS)


def test_directory_doubles_until_buckets_hold_capacity(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    index = build_index(docs, capacity=7)
    assert index.groupBy("depth", "bucket").agg(F.countDistinct("hash").alias("n")).agg(F.max("n")).first()[0] <= 7
    assert index.count() == 500
    wrong = index.filter(F.expr("shiftrightunsigned(hash, cast(64 - depth as int))") != F.col("bucket"))
    assert wrong.count() == 0


def test_chains_hold_all_texts_of_a_hash(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(6)], "doc_id long, text string")
    index = build_index(docs, 1, lambda t: F.lit(1).cast("bigint"))
    assert sorted(r["chain"] for r in index.collect()) == list(range(6))


def test_drop_copies_keeps_one_row_of_each_text_with_all_columns(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sorted((r["text"] or "") for r in rows) == sorted({t or "" for _, t, *_ in ROWS})
    assert {r["doc_id"] for r in rows} == {9, 3, 4, 5, 6, 7, None}


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert exact_dedup(docs).collect() == [] and drop_copies(docs).collect() == []
