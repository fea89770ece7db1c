"""Counters and other values that depend on the stored ones: many read-modify-write steps as one keyed merge."""

from __future__ import annotations

from dataclasses import replace
from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from entityframe.errors import SchemaError
from entityframe.functions.convert import nan_to_null
from entityframe.functions.keys import EntityKey
from entityframe.functions.logical import Float64Type, Int64Type
from entityframe.plans.reports import WriteReport
from entityframe.plans.write_plan import plan_metrics, plan_rows, require_good_keys, require_scope
from entityframe.schema import UNSET, Schema, column, field_types
from entityframe.sources.staging import stage
from entityframe.sources.store import EntityStore


def merge_deltas(
    current: DataFrame, deltas: DataFrame, key: Sequence[str], value: str
) -> DataFrame:
    """New counter values: stored value (0 when absent) plus the sum of all deltas.

    Deltas are summed per key before they meet the stored rows, so a counter that a
    third of the deltas go to is one row in the join.
    """
    fields = field_types(deltas)
    summed = deltas.groupBy(*[column(k) for k in key]).agg(
        F.sum(nan_to_null(column(value), fields[value])).alias("__delta__")
    )
    both = current.select(*[column(k) for k in key], column(value)).join(
        summed, list(key), "full_outer"
    )
    total = F.coalesce(column(value), F.lit(0)) + F.coalesce(F.col("__delta__"), F.lit(0))
    return both.select(*[column(k) for k in key], total.alias(value))


# What several rows of one key come to before they meet the stored entity.
_FOLDS: dict[str, Callable[[Column], Column]] = {
    "add": lambda value: F.coalesce(F.sum(value), F.lit(0)),
    "min": F.min,
    "max": F.max,
    "keep": F.min,
}


def combine_entities(
    store: EntityStore,
    df: DataFrame,
    schema: Schema,
    rules: Mapping[str, str],
    *,
    dry_run: bool = False,
    read_only: bool = False,
    scope: EntityKey | None = None,
) -> WriteReport:
    """Change stored properties in place, each by its rule, as one keyed merge.

    `add` sums, `min` and `max` compare, `keep` sets a value only where none is stored (the
    smallest of the batch).  `df` has the columns that the key of the kind is made from, any
    number of rows per key, and the properties in `rules`; nulls and NaN change nothing, except
    that a counter without a value becomes 0.  Other properties of an entity stay as they are,
    and a key that is not stored becomes an entity with these and the parts of its key only.

    Rows of a key are folded before any shuffle, so a hot key costs one row per task.  Old and
    new values meet inside the merge, in the version of the kind that the call began with: if
    another writer commits meanwhile, `WriteConflictError` is raised and nothing is changed.
    """
    if schema.key is None:
        raise SchemaError("combining needs a key recipe in the schema")
    fields = field_types(df)
    for name, rule in rules.items():
        if rule not in _FOLDS:
            raise SchemaError(f"unknown rule for {name}: {rule!r}; there are {', '.join(_FOLDS)}")
        if name not in schema.properties or name not in fields:
            raise SchemaError(f"{name} is not both a property of {schema.kind} and a column")
        if rule == "add" and not isinstance(schema.properties[name].dtype, (Int64Type, Float64Type)):
            raise SchemaError(f"{name} is not a number, so nothing can be added to it")
    keys = sorted(schema.key.sources)
    if overlap := sorted(set(keys) & set(rules)):
        raise SchemaError(f"part of the key: {', '.join(overlap)}")
    folded = df.groupBy(*[column(k) for k in keys]).agg(
        *[_FOLDS[rule](nan_to_null(column(name), fields[name])).alias(name) for name, rule in rules.items()]
    )
    table = store.table(schema.kind)
    snapshot = table.snapshot()
    # Parts of the key that are properties too are stored with a new entity.
    named = [*rules, *[k for k in keys if k in schema.properties]]
    # A change that is missing must not turn into a default.
    plain = {n: replace(schema.properties[n], default=UNSET, missing_policy="omit", nullable=True) for n in named}
    changes = replace(schema, properties=plain, strict=False)
    plan = plan_rows(folded, changes, operation="patch", properties=named, buckets=table.layout(snapshot)[0])
    plan = plan.on(stage(plan.df, "combine"))
    if dry_run or read_only:
        return plan.to_report(dry_run=dry_run, read_only=read_only)
    require_good_keys(plan.df.agg(*plan_metrics()).first())
    if scope is not None:
        require_scope(plan.df, scope)
    table.commit_plan(plan.df, dict(rules), snapshot)
    return plan.executed_report()


def add_deltas(store: EntityStore, schema: Schema, deltas: DataFrame, value: str, **options) -> WriteReport:
    """Add `deltas` to the stored counters of a kind; see `combine_entities`.

    Counters that no delta touches are not read back; new ones start at 0.
    """
    return combine_entities(store, deltas, schema, {value: "add"}, **options)
