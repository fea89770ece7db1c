"""Kinds that point at each other: key references, ancestors, property profiles."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from entityframe import fixed_values as fv
from entityframe.functions.convert import is_missing
from entityframe.functions.keys import EntityKey, key_ns_code, key_path_text
from entityframe.schema import column, field_types

# A reference is compared in this form.
_REF_NS, _REF_PATH = "__ref_ns__", "__ref_path__"


def _with_reference(df: DataFrame, reference: str) -> DataFrame:
    key = column(reference)
    return df.withColumns({_REF_NS: key_ns_code(key), _REF_PATH: key_path_text(key)})


def _targets(df: DataFrame) -> DataFrame:
    return df.select(F.col(fv.NS).alias(_REF_NS), F.col(fv.PATH).alias(_REF_PATH))


def follow_references(df: DataFrame, reference: str, targets: DataFrame) -> DataFrame:
    """Rows whose key property names one of the target entities."""
    found = _with_reference(df, reference).join(_targets(targets), [_REF_NS, _REF_PATH], "left_semi")
    return found.drop(_REF_NS, _REF_PATH)


def referencing(df: DataFrame, reference: str, key: EntityKey) -> DataFrame:
    """Rows whose key property is `key`: a filter, no join."""
    ref = column(reference)
    return df.filter((key_ns_code(ref) == key.ns_code) & (key_path_text(ref) == key.path_text))


def dangling_references(df: DataFrame, reference: str, targets: DataFrame) -> DataFrame:
    """Rows whose key property names no stored entity."""
    given = _with_reference(df.filter(column(reference).isNotNull()), reference)
    return given.join(_targets(targets), [_REF_NS, _REF_PATH], "left_anti").drop(_REF_NS, _REF_PATH)


def dangling_reference_counts(df: DataFrame, reference: str, targets: DataFrame) -> DataFrame:
    """Unresolved keys with their number of rows.

    Counted before the join, so a key that half of the rows point at is one row by
    the time it is shuffled.
    """
    given = _with_reference(df.filter(column(reference).isNotNull()), reference)
    counted = given.groupBy(_REF_NS, _REF_PATH).agg(F.count(F.lit(1)).alias("rows"))
    left = counted.join(_targets(targets), [_REF_NS, _REF_PATH], "left_anti")
    return left.select(F.col(_REF_NS).alias(fv.NS), F.col(_REF_PATH).alias(fv.PATH), "rows")


def ancestor_path(path: Column, depth: int) -> Column:
    """First `depth` elements of a `__path__` (each is kind/identifier/)."""
    return F.concat(F.substring_index(path, "/", 2 * depth), F.lit("/"))


def path_depth(path: Column) -> Column:
    slashes = F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))
    return F.call_function("div", slashes, F.lit(2))


def _nearest_paths(df: DataFrame, ancestors: DataFrame) -> DataFrame:
    """The longest ancestor path of each key of `df` that has any, and how many it has.

    A key is expanded to the beginnings of its path, itself included, as many as it has elements;
    so keys and ancestors of any depth meet in one equi-join, and only keys are shuffled.
    """
    path = F.col(fv.PATH)
    depths = F.explode(F.sequence(F.lit(1).cast("bigint"), path_depth(path))).alias("depth")
    probes = df.filter(path_depth(path) > 0).select(fv.NS, fv.PATH, depths)
    probes = probes.withColumn(_REF_PATH, _first_elements(path, F.col("depth")))
    wanted = _targets(ancestors).distinct()
    met = probes.join(wanted.withColumnRenamed(_REF_NS, fv.NS), [fv.NS, _REF_PATH])
    # A depth stands for the ancestor: numbers are aggregated by hash, and one shuffle serves both
    # aggregates and the join that follows.
    met = met.select(fv.NS, fv.PATH, "depth").repartition(F.col(fv.NS), F.col(fv.PATH))
    found = met.groupBy(fv.NS, fv.PATH).agg(F.max("depth").alias("depth"), F.count_distinct("depth").alias("n"))
    return found.select(fv.NS, fv.PATH, _first_elements(path, F.col("depth")).alias(_REF_PATH), "n")


def _first_elements(path: Column, n: Column) -> Column:
    return F.concat(F.call_function("substring_index", path, F.lit("/"), (2 * n).cast("int")), F.lit("/"))


def nearest_ancestors(
    df: DataFrame, ancestors: DataFrame, ancestor: str = "ancestor_path", count: str | None = None
) -> DataFrame:
    """Rows under any of the ancestors, with the path of the nearest one in `ancestor` and, if
    wanted, the number of ancestors they have in `count`.

    `ancestors` may lie at any depths, also under each other; a row that is an ancestor itself
    is its own nearest.  Paths count within a namespace.  Repeated ancestors count once.
    """
    near = _nearest_paths(df, ancestors).withColumnRenamed(_REF_PATH, ancestor)
    near = near.drop("n") if count is None else near.withColumnRenamed("n", count)
    return df.join(near, [fv.NS, fv.PATH])


def descendants(df: DataFrame, ancestors: DataFrame, depth: int | None = None) -> DataFrame:
    """Rows under any of the ancestors, the ancestors included.

    With ancestors that all have `depth` path elements, an equi-join on that part of the path;
    without it, they may have any depths.  No row is compared with every ancestor.
    """
    if depth is None:
        return df.join(_nearest_paths(df, ancestors).select(fv.NS, fv.PATH), [fv.NS, fv.PATH], "left_semi")
    probe = df.withColumns({_REF_NS: F.col(fv.NS), _REF_PATH: ancestor_path(F.col(fv.PATH), depth)})
    return probe.filter(path_depth(F.col(fv.PATH)) >= depth).join(
        _targets(ancestors), [_REF_NS, _REF_PATH], "left_semi"
    ).drop(_REF_NS, _REF_PATH)


def outside_ancestor_property(df: DataFrame, reference: str) -> DataFrame:
    """Rows that do not lie under the entity their key property names."""
    ref = column(reference)
    inside = (F.col(fv.NS) == key_ns_code(ref)) & F.startswith(F.col(fv.PATH), key_path_text(ref))
    return df.filter(ref.isNotNull() & ~inside)


def presence_counts(df: DataFrame) -> DataFrame:
    """Number of entities that hold each property: (property, entities)."""
    if fv.PRESENT in df.columns:
        names = df.select(F.explode(fv.PRESENT).alias("property"))
        return names.groupBy("property").agg(F.count(F.lit(1)).alias("entities"))
    # A plain frame: one pass, one counter per column, turned into rows afterwards.
    fields = {n: t for n, t in field_types(df).items() if n not in fv.SYSTEM_COLUMNS}
    counted = df.agg(*[F.count_if(~is_missing(column(n), t)).alias(n) for n, t in fields.items()])
    pairs = F.array(
        *[F.struct(F.lit(n).alias("property"), column(n).alias("entities")) for n in fields]
    )
    return counted.select(F.inline(pairs)).filter("entities > 0")


def clean_rows(
    df: DataFrame, required: Sequence[str], *, positive: Sequence[str] = ()
) -> DataFrame:
    """Rows that have every required field and positive values where asked."""
    fields = field_types(df)
    kept = df
    for name in required:
        kept = kept.filter(~is_missing(column(name), fields[name]))
    for name in positive:
        kept = kept.filter(column(name) > 0)
    return kept
