"""Mixing sources to target weights by Pareto order sampling.

Each document's expected number of copies is its source's target over its size.  The whole
part is given as certain copies.  The rest is an inclusion probability p, which differs from
source to source, and within a source by the documents' own weights where a weight column
is named.  A document's rank is its random odds u / (1 - u) over its inclusion odds
p / (1 - p); the documents of smallest rank are taken until the source has its words, so
the size of the sample is fixed instead of random.

The cut is found without sorting a source in one task: ranks fall into bins, words are summed
by source and bin before any shuffle, and only the bin in which the target is reached is put
in order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from entityframe.llm.common import load, stage, uniform
from entityframe.operators.paging import numbered

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
BINS = 4096
SEED = "mix"


def word_counts(docs: DataFrame) -> DataFrame:
    size = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
    return docs.withColumn("size", size.cast("bigint"))


def _level(sources: DataFrame, most: int) -> tuple[int, int]:
    """Words per unit of weight as a fraction.  Sources above their cap are taken out at the
    cap and the level rises for the others, until none is above.  One row per round comes back."""
    exact = lambda c: c.cast("decimal(38,0)")
    cap, weight = exact(F.col("source_size") * most), exact(F.col("weight"))
    first = sources.agg(F.sum(exact(F.col("source_size"))), F.sum(weight)).first()
    words, num, den = int(first[0] or 0), int(first[0] or 0), int(first[1] or 0)
    while den:
        above = cap * F.lit(den).cast("decimal(20,0)") < weight * F.lit(num).cast("decimal(28,0)")
        row = sources.agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~above, weight)), F.lit(0))
        ).first()
        new = (words - int(row[0]), int(row[1]))
        if new == (num, den) or not new[1]:
            break
        num, den = new
    return num, den


def source_targets(docs: DataFrame, weights=WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size, weight, target.  Sources go by code point, null last, and weigh
    `weights` in turn; targets share all words, none above `most` times its source."""
    sums = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = numbered(sums, [F.col("source").asc_nulls_last()], "place")
    turn = (F.col("place") % len(weights)).cast("int")
    weight = reduce(lambda c, i: c.when(turn == i, weights[i]), range(1, len(weights)), F.when(turn == 0, weights[0]))
    sources = stage(placed.select("source", "source_size", weight.cast("bigint").alias("weight")), "sources")
    num, den = _level(sources, most)
    cap = (F.col("source_size") * most).cast("double")
    share = (F.col("weight") * F.lit(num)).cast("double") / F.lit(float(max(den, 1)))
    return sources.withColumn("target", F.least(cap, share))


def mix(
    docs: DataFrame,
    weights=WEIGHTS,
    most: int = MOST_COPIES,
    seed: str = SEED,
    bins: int = BINS,
    prefer: str | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Copies of each document in the mix: doc_id, size, source_size, target, copies, taken, and
    the columns named in `carry`.

    Needs doc_id, text, source; other columns are ignored, except `prefer`, which may name
    positive weights of documents within their source (null or none: 1).  Null text has size
    0 and takes nothing.  Rows that repeat a doc_id are documents of their own.  The same
    rows and seed give the same mix.  An empty table gives an empty mix.
    """
    liking = F.coalesce(F.col(prefer).cast("double"), F.lit(1.0)) if prefer else F.lit(1.0)
    sized = word_counts(docs.select("doc_id", "text", "source", liking.alias("liking"), *carry)).drop("text")
    sized = stage(sized, "sized")
    targets = stage(source_targets(sized, weights, most), "targets")
    mean = F.lit(1.0)
    if prefer:
        weighed = sized.groupBy("source").agg((F.sum(F.col("size") * F.col("liking")) / F.sum("size")).alias("mean"))
        targets = stage(
            targets.alias("t").join(weighed.alias("w"), F.col("t.source").eqNullSafe(F.col("w.source")))
            .select("t.*", "w.mean"), "targets",
        )
        mean = F.col("mean")
    joined = sized.alias("d").join(
        targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source"))
    ).drop(F.col("t.source"))
    expected = F.least(F.lit(float(most)), F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0) * F.col("liking") / mean)
    odds = F.col("p") / (1 - F.col("p"))
    random = uniform(seed, "doc_id")
    ranked = (
        joined.withColumn("expected", expected)
        .withColumn("whole", F.floor("expected"))
        .withColumn("p", F.col("expected") - F.col("whole"))
        .withColumn("u", random)
        .withColumn("rank", F.when((F.col("p") > 0) & (F.col("size") > 0), (F.col("u") / (1 - F.col("u"))) / odds))
        .withColumn("bin", F.floor(F.col("rank") / (1 + F.col("rank")) * bins))
        .drop("liking", "expected", "u", "mean")
    )
    ranked = stage(ranked, "ranked")
    given = ranked.groupBy("source").agg(F.sum(F.col("whole") * F.col("size")).alias("given"))
    totals = ranked.filter("bin IS NOT NULL").groupBy("source", "bin").agg(F.sum("size").alias("words"))
    running = F.sum("words").over(Window.partitionBy("source").orderBy("bin"))
    goals = targets.alias("t").join(given.alias("g"), F.col("t.source").eqNullSafe(F.col("g.source"))).select(
        F.col("t.source").alias("goal_source"), (F.col("target") - F.col("given")).alias("goal")
    )
    sums = totals.withColumn("upto", running)
    cut = (
        goals.join(sums, F.col("goal_source").eqNullSafe(F.col("source")), "left")
        .filter((F.col("upto") > F.col("goal")) | F.col("upto").isNull())
        .groupBy("goal_source", "goal")
        .agg(F.min("bin").alias("cut"), F.min(F.col("upto")).alias("upto"), F.min_by("words", "bin").alias("words"))
        .withColumn("before", F.col("upto") - F.col("words"))
        .drop("upto", "words")
    )
    # A source without a cut takes every document that can be taken.
    aimed = ranked.join(stage(cut, "cuts"), F.col("source").eqNullSafe(F.col("goal_source")), "left")
    inside = F.col("bin").isNotNull() & F.col("cut").isNotNull() & (F.col("bin") == F.col("cut"))
    sure = F.col("bin").isNotNull() & (F.col("cut").isNull() | (F.col("bin") < F.col("cut")))
    columns = ["doc_id", "size", "source_size", "target", "whole", *carry]
    settled = aimed.filter(~inside).select(*columns, F.when(sure, 1).otherwise(0).alias("extra"))
    order = Window.partitionBy("source").orderBy("rank", "doc_id", "size")
    upto = F.col("before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    edge = aimed.filter(inside).withColumn("upto", upto)
    near = F.col("upto") - F.col("goal") < F.col("goal") - (F.col("upto") - F.col("size"))
    edge = edge.select(*columns, F.when((F.col("upto") <= F.col("goal")) | near, 1).otherwise(0).alias("extra"))
    copies = (F.col("whole") + F.col("extra")).cast("bigint")
    return settled.unionByName(edge).select(
        "doc_id", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), *carry
    )


def take_mix(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of `docs` that the mix takes, each as often as it takes it, with all columns.

    Rows that agree in every column share what was allotted to them.
    """
    whole = [F.xxhash64(F.lit(seed), F.to_json(F.struct("*"))).alias(name) for seed, name in ((1, "__h1"), (2, "__h2"))]
    key = ["__h1", "__h2"]
    rows = docs.select(F.struct("*").alias("__row"), *whole)
    allotted = mix(rows.select("__row.*", *key), carry=tuple(key), **parameters)
    counts = allotted.groupBy(*key).agg(F.sum("copies").alias("__copies"), F.count(F.lit(1)).alias("__rows"))
    taken = rows.join(stage(counts.filter("__copies > 0"), "copies"), key)
    one = taken.filter("__rows > 1").withColumn("__n", F.row_number().over(Window.partitionBy(*key).orderBy("__copies")))
    each = taken.filter("__rows = 1").unionByName(one.filter("__n = 1").drop("__n"))
    repeated = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__copies"))).alias("__i")
    return each.select("__row", repeated).select("__row.*")


def op7_mixing(spark, sf):
    return mix(load(spark, sf, "documents")).drop("copies")


def _levels_sql(rounds: int = 12) -> str:
    """One step per round of capping; more rounds than the sources need change nothing."""
    steps = ["l0 AS (SELECT sum(source_size)::HUGEINT AS num, sum(weight)::HUGEINT AS den FROM src)"]
    for k in range(rounds):
        steps.append(
            f"l{k + 1} AS (SELECT (SELECT sum(source_size) FROM src)::HUGEINT"
            " - coalesce(sum(3 * source_size) FILTER (3 * source_size * den < weight * num), 0)::HUGEINT AS num,"
            f" sum(weight) FILTER (3 * source_size * den >= weight * num)::HUGEINT AS den FROM src, l{k} GROUP BY num, den)"
        )
    return ",\n".join(steps)


OP7_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, length(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents
), src AS (
  SELECT source, source_size::BIGINT AS source_size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::BIGINT AS weight
  FROM (SELECT source, sum(size) AS source_size FROM sized GROUP BY source)
), {_levels_sql()}, targets AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, (weight * num)::DOUBLE / den::DOUBLE) AS target FROM src, l12
), chance AS (
  SELECT doc_id, s.source, size, source_size, target,
         floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END) AS whole,
         (CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END) - whole AS p,
         ((('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), ranked AS (
  SELECT *, CASE WHEN p > 0 AND size > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS rank,
         target - sum(whole * size) OVER (PARTITION BY source) AS goal
  FROM chance
), summed AS (
  SELECT *, sum(CASE WHEN rank IS NOT NULL THEN size END) OVER (
           PARTITION BY source ORDER BY rank NULLS LAST, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM ranked
)
SELECT doc_id, size, source_size, target,
       ((whole + CASE WHEN rank IS NOT NULL AND (upto <= goal OR upto - goal < goal - (upto - size)) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM summed
"""
