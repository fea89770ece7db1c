"""Exact deduplication over an extendible-hash index kept in shared files.

The index has one entry for each different text.  Entries are found by a 64-bit hash whose
leading bits choose a bucket.  A directory that starts at the depth the number of entries
asks for doubles wherever a bucket holds more than `capacity` different hashes; texts that
share a hash form a chain in their bucket.  Whether two texts are equal is decided by
comparing their bytes: the text itself is a grouping key, so a hash only says where to look.
Owner tasks each write one range of hashes, in order, to the shared folder.

Copies of a text are merged before any shuffle, so a text that makes up a third of all rows
reaches its bucket as one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from entityframe.llm.common import fresh_path, stage, text_or_empty

DEFAULT_CAPACITY = 65_536
_BITS = 64


def _prefix(depth: int) -> Column:
    """The leading `depth` bits of a hash."""
    return F.shiftrightunsigned("hash", _BITS - depth) if depth else F.lit(0).cast("bigint")


def _text_hash(text: Column) -> Column:
    return F.xxhash64(text)


def text_entries(docs: DataFrame, text_hash=_text_hash) -> DataFrame:
    """One row per different text: hash, text_sha256, keep_id (largest doc_id), group_size."""
    keyed = docs.select("doc_id", text_or_empty("text").alias("__text"))
    grouped = keyed.groupBy(text_hash(F.col("__text")).alias("hash"), "__text").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    return grouped.select("hash", F.sha2("__text", 256).alias("text_sha256"), "keep_id", "group_size")


def split_buckets(entries: DataFrame, capacity: int) -> DataFrame:
    """Adds `depth` and `bucket`: the directory is doubled where a bucket is overfull.

    Only the buckets that are overfull at one depth are looked at again at the next.
    Entries with one hash cannot be parted, so buckets are measured in different hashes.
    """
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    total = entries.count()
    depth = max(0, (max(total, 1) - 1) // capacity).bit_length()
    placed = entries.withColumns({"depth": F.lit(depth), "bucket": _prefix(depth)})
    while depth < _BITS:
        overfull = (
            placed.filter(F.col("depth") == depth)
            .groupBy("bucket")
            .agg(F.countDistinct("hash").alias("n"))
            .filter(F.col("n") > capacity)
            .select(F.col("bucket").alias("__full"))
        )
        overfull = stage(overfull, "overfull")
        if overfull.isEmpty():
            break
        split = (F.col("depth") == depth) & F.col("__full").isNotNull()
        placed = placed.join(overfull, (F.col("depth") == depth) & (F.col("bucket") == F.col("__full")), "left").select(
            *[c for c in placed.columns if c not in ("depth", "bucket")],
            F.when(split, depth + 1).otherwise(F.col("depth")).alias("depth"),
            F.when(split, _prefix(depth + 1)).otherwise(F.col("bucket")).alias("bucket"),
        )
        depth += 1
    return placed


def build_index(docs: DataFrame, capacity: int = DEFAULT_CAPACITY, text_hash=_text_hash) -> DataFrame:
    """The index of `docs` (doc_id, text; null text counts as empty), read back from its files.

    Columns: bucket, depth, hash, chain (place among the texts of one hash, from 0),
    text_sha256, keep_id, group_size.  An empty table gives an empty index.
    """
    entries = stage(text_entries(docs, text_hash), "texts")
    placed = split_buckets(entries, capacity)
    chain = F.row_number().over(Window.partitionBy("hash").orderBy("text_sha256")) - 1
    owned = placed.repartitionByRange("hash").withColumn("chain", chain)
    path = fresh_path(docs.sparkSession, "hash-index")
    owned.sortWithinPartitions("hash", "chain").write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def _members(docs: DataFrame, text_hash=_text_hash) -> DataFrame:
    """How often each document (doc_id and text) occurs; repeats are merged before the shuffle."""
    text = text_or_empty("text")
    keyed = docs.select(
        "doc_id", text_hash(text).alias("hash"), F.sha2(text, 256).alias("text_sha256")
    )
    return keyed.groupBy("doc_id", "hash", "text_sha256").agg(F.count(F.lit(1)).alias("rows"))


def exact_dedup(docs: DataFrame, capacity: int = DEFAULT_CAPACITY, text_hash=_text_hash) -> DataFrame:
    """Every row of `docs` with the document that stays for its text.

    Needs doc_id and text; other columns are ignored, whatever their names.  Null text is
    empty text.  Of equal texts the row with the largest doc_id stays (a null doc_id only if
    all are null); of rows that repeat this doc_id one stays.  Returns doc_id, keep_id,
    group_size, kept, text_sha256, bucket, chain.
    """
    index = build_index(docs, capacity, text_hash)
    found = _members(docs, text_hash).join(index, ["hash", "text_sha256"])
    one = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rows")))
    return found.withColumn("nth", one).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        "text_sha256",
        "bucket",
        "chain",
    )


def drop_copies(docs: DataFrame, capacity: int = DEFAULT_CAPACITY) -> DataFrame:
    """The rows of `docs` that exact_dedup keeps, with all their columns.

    Rows that agree in doc_id and text are one document; the first by their other columns'
    digest stays.
    """
    index = build_index(docs, capacity)
    text = text_or_empty("text")
    rows = docs.select(
        F.struct("*").alias("__row"),
        F.col("doc_id").alias("__id"),
        _text_hash(text).alias("hash"),
        F.sha2(text, 256).alias("text_sha256"),
    )
    heads = index.select("hash", "text_sha256", "keep_id")
    match = ["hash", "text_sha256"]
    kept = rows.join(heads, match).filter(F.col("__id").eqNullSafe(F.col("keep_id")))
    repeated = stage(
        _members(docs).filter("rows > 1").join(heads, match)
        .filter(F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(*match),
        "repeated",
    )
    if repeated.isEmpty():
        return kept.select("__row.*")
    alone = kept.join(repeated, match, "left_anti").select("__row")
    order = Window.partitionBy(*match).orderBy(F.xxhash64("__row"))
    first = (
        kept.join(repeated, match, "left_semi")
        .withColumn("__n", F.row_number().over(order)).filter("__n = 1").select("__row")
    )
    return alone.unionByName(first).select("__row.*")


def op8_exact_dedup(spark, sf):
    from entityframe.llm.common import load

    return exact_dedup(load(spark, sf, "documents")).drop("bucket", "chain")


OP8_SQL = """
SELECT doc_id,
       max(doc_id) OVER copies AS keep_id,
       count(*) OVER copies AS group_size,
       doc_id = max(doc_id) OVER copies AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW copies AS (PARTITION BY coalesce(text, ''))
"""
