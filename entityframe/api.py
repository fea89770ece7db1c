"""Reading and writing kinds: the functional entry points."""

from __future__ import annotations

from dataclasses import replace
from typing import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, functions as F

from entityframe import fixed_values as fv
from entityframe.errors import SchemaError
from entityframe.functions.keys import EntityKey, KeySpec
from entityframe.operators.inference import SchemaInferenceReport, infer_schema_from_frame
from entityframe.operators.paging import Page, iter_chunks
from entityframe.plans.query import Filter, PagePosition, QuerySpec, page_end, sort_columns
from entityframe.plans.reports import WriteReport
from entityframe.plans.write_plan import (
    ROW_INDEX,
    WritePlan,
    classify,
    delete_plan,
    keep_latest,
    plan_metrics,
    plan_rows,
    property_types,
    require_good_keys,
    require_scope,
    require_unique_keys,
)
from entityframe.schema import Schema
from entityframe.sources.staging import stage
from entityframe.sources.store import NEWEST, EntityStore, Snapshot


# --- reading -----------------------------------------------------------------------


def scan(store: EntityStore, spec: QuerySpec, schema: Schema | None = None) -> DataFrame:
    """Raw entity frame of a restricted scan: properties and system columns."""
    spec.validate()
    return spec.apply(_raw(store, spec.kind, schema, spec.ancestor))


def _raw(store: EntityStore, kind: str, schema: Schema | None, ancestor: EntityKey | None = None) -> DataFrame:
    """What is stored of a kind, at least under the ancestor; declared properties that no entity
    has yet are null."""
    table = store.table(kind)
    raw = table.read() if ancestor is None else table.read_under(ancestor)
    if raw is None:
        return _empty(store, schema or Schema(kind))
    declared = schema.properties if schema else {}
    missing = {n: F.lit(None).cast(f.dtype.spark_type) for n, f in declared.items() if n not in raw.columns}
    return raw.withColumns(missing) if missing else raw


def _empty(store: EntityStore, schema: Schema) -> DataFrame:
    frame_type = store.table(schema.kind)._frame_type(schema.to_struct_type())
    return store.spark.createDataFrame([], frame_type)


def read_entities(
    store: EntityStore,
    kind: str,
    *,
    schema: Schema | None = None,
    filters: Sequence[Filter] = (),
    namespace: str | None = None,
    projection: Sequence[str] | None = None,
    order: Sequence[str] = (),
    distinct_on: Sequence[str] | None = None,
    ancestor: EntityKey | None = None,
    keys_only: bool = False,
    limit: int | None = None,
    after: PagePosition | None = None,
    include_key: bool = False,
    require_present: bool = False,
    infer_schema: bool = False,
    schema_sample_size: int | None = None,
) -> DataFrame:
    """Entities of a kind as a lazy DataFrame."""
    if infer_schema and schema is None:
        schema = infer_schema_of_kind(
            store, kind, namespace=namespace, filters=filters, ancestor=ancestor, sample_size=schema_sample_size
        ).schema
    spec = QuerySpec(
        kind,
        namespace=namespace,
        filters=filters,
        order=order,
        projection=projection,
        distinct_on=distinct_on,
        ancestor=ancestor,
        keys_only=keys_only,
        limit=limit,
        after=after,
        require_present=require_present,
    )
    return _to_user(scan(store, spec, schema), schema, include_key or keys_only)


def _to_user(raw: DataFrame, schema: Schema | None, include_key: bool) -> DataFrame:
    return (schema or Schema("Any", strict=False)).decode(raw, include_key=include_key)


def iter_entities(
    store: EntityStore,
    kind: str,
    *,
    chunksize: int = 1000,
    order: Sequence[str] = (),
    schema: Schema | None = None,
    include_key: bool = False,
    infer_schema: bool = False,
    schema_sample_size: int | None = None,
    **options,
) -> Iterator[DataFrame]:
    """The same rows, `chunksize` at a time, one DataFrame per chunk."""
    if infer_schema and schema is None:
        scope = {k: options[k] for k in ("namespace", "filters", "ancestor") if k in options}
        schema = infer_schema_of_kind(store, kind, sample_size=schema_sample_size, **scope).schema
    spec = QuerySpec(kind, order=order, **options)
    raw = scan(store, spec, schema)
    for chunk in iter_chunks(raw, chunksize, sort_columns(order, raw)):
        yield _to_user(chunk, schema, include_key or spec.keys_only)


def read_page(
    store: EntityStore,
    kind: str,
    limit: int,
    *,
    after: PagePosition | None = None,
    order: Sequence[str] = (),
    schema: Schema | None = None,
    include_key: bool = False,
    **options,
) -> Page:
    """One page in the given order, which the key completes; pass its `next` as `after` to go on.

    The end of the page is looked up in the properties of the order and the key alone.  Its rows
    are then those between two positions, so the other columns are read for that range only, and
    what lies before the page is neither sorted nor counted again.  Pages of an unchanged kind
    neither overlap nor leave gaps, also where properties of the order are missing or repeat.
    """
    spec = QuerySpec(kind, order=order, after=after, **options)
    raw = _raw(store, kind, schema, spec.ancestor)
    end = page_end(spec, raw, limit)
    if end is None:
        return Page(_to_user(spec.apply(raw).limit(0), schema, include_key), None)
    return Page(_to_user(replace(spec, until=end).apply(raw), schema, include_key), end)


def infer_schema_of_kind(
    store: EntityStore,
    kind: str,
    *,
    namespace: str | None = None,
    filters: Sequence[Filter] = (),
    ancestor: EntityKey | None = None,
    sample_size: int | None = None,
    key: KeySpec | None = None,
    mixed_type_policy: str = "object",
) -> SchemaInferenceReport:
    """Schema of stored entities, from all of them.

    `sample_size` is the caller's choice to look at so many only; properties of mixed type
    then stay objects.
    """
    spec = QuerySpec(
        kind, namespace=namespace, filters=filters, ancestor=ancestor, limit=sample_size
    )
    raw = scan(store, spec)
    return infer_schema_from_frame(
        raw, kind=kind, key=key, mixed_type_policy=mixed_type_policy, whole=sample_size is None
    )


# --- writing -----------------------------------------------------------------------


def plan_entities(
    store: EntityStore,
    df: DataFrame,
    schema: Schema,
    *,
    mode: str = "upsert",
    properties: Sequence[str] | None = None,
    patch: bool = False,
    skip_unchanged: bool = False,
    row_index: str | None = None,
    check_keys: bool = True,
    snapshot: Snapshot | None = NEWEST,
    latest_by: str | None = None,
) -> WritePlan:
    """Plan a write without carrying it out.

    Row problems become error rows.  A complete key that occurs twice raises, as does
    a request that makes no sense.  A plan that compares with stored entities is written once
    first, so that the input is read and encoded once and only the partitions its keys fall
    into are looked at.
    """
    table = store.table(schema.kind)
    snapshot = table.snapshot() if snapshot is NEWEST else snapshot
    plan = plan_rows(
        df,
        schema,
        operation="patch" if patch else "write",
        mode=mode,
        properties=properties,
        row_index=row_index,
        buckets=table.layout(snapshot)[0],
        latest_by=latest_by,
    )
    # What a default makes anew at every evaluation must be the same in all that is planned from it.
    if skip_unchanged or schema.row_defaults(properties):
        plan = plan.on(stage(plan.df, "plan"))
    if check_keys:
        require_unique_keys(plan.df)
    if skip_unchanged:
        plan = classify(plan, table.read_for(plan.df, snapshot))
        plan = WritePlan(plan.df, plan.operation, plan.mode, skip_unchanged=True)
    return plan


def write_entities(
    store: EntityStore,
    df: DataFrame,
    schema: Schema,
    *,
    mode: str = "upsert",
    properties: Sequence[str] | None = None,
    dry_run: bool = False,
    read_only: bool = False,
    skip_unchanged: bool = False,
    row_index: str | None = None,
    scope: EntityKey | None = None,
    batch: tuple[str, int] | None = None,
    latest_by: str | None = None,
    reject: Callable[[DataFrame], None] | None = None,
) -> WriteReport:
    """Write full entities: upsert, insert (new keys only) or update (stored keys only).

    A key may occur once, unless `latest_by` names the column that tells which of its rows is
    the latest; the others are skipped, and so is that one if the column is a property and the
    stored entity has a greater value.  `reject` is called with the rows that fail (row_index,
    error) before the others are committed; rows without a usable key are then among them
    instead of ending the write.  `batch` names the stream and number of a
    micro-batch, to be recorded with the commit.
    """
    return _run(
        store,
        df,
        schema,
        patch=False,
        mode=mode,
        properties=properties,
        dry_run=dry_run,
        read_only=read_only,
        skip_unchanged=skip_unchanged,
        row_index=row_index,
        scope=scope,
        batch=batch,
        latest_by=latest_by,
        reject=reject,
    )


def patch_entities(
    store: EntityStore,
    df: DataFrame,
    schema: Schema,
    *,
    properties: Sequence[str],
    dry_run: bool = False,
    read_only: bool = False,
    skip_unchanged: bool = False,
    row_index: str | None = None,
    scope: EntityKey | None = None,
    batch: tuple[str, int] | None = None,
) -> WriteReport:
    """Overwrite the named properties and keep the others; a missing entity is created."""
    return _run(
        store,
        df,
        schema,
        patch=True,
        mode="upsert",
        properties=properties,
        dry_run=dry_run,
        read_only=read_only,
        skip_unchanged=skip_unchanged,
        row_index=row_index,
        scope=scope,
        batch=batch,
    )


def _run(
    store,
    df,
    schema,
    *,
    patch,
    mode,
    properties,
    dry_run,
    read_only,
    skip_unchanged,
    row_index,
    scope,
    batch,
    latest_by=None,
    reject=None,
) -> WriteReport:
    # One version from classification to commit: what was compared is what gets replaced.
    table = store.table(schema.kind)
    snapshot = table.snapshot()
    plan = plan_rows(
        df,
        schema,
        operation="patch" if patch else "write",
        mode=mode,
        properties=properties,
        row_index=row_index,
        buckets=table.layout(snapshot)[0],
        latest_by=latest_by,
    )
    # Encoded once and written once: every later pass reads this table, so audit
    # stamps and row ids are the same in the stored data and in the report.
    plan = plan.on(stage(plan.df, "plan"))
    # Four narrow columns are read again for this; observing every row on its way costs more.
    seen = plan.df.agg(*plan_metrics()).first()
    carried_out = not (dry_run or read_only)
    if carried_out and not skip_unchanged and reject is None:
        require_good_keys(seen)
    if latest_by is not None:
        existing = table.read_for(plan.df, snapshot) if latest_by in property_types(plan.df) else None
        plan = plan.on(stage(keep_latest(plan, existing, latest_by).df, "latest"))
    # A plain insert or update looks for its targets; a plain patch only when some row
    # has no values, which skips a stored entity but creates a missing one.
    plain = seen["hollow"] > 0 if patch else mode != "upsert"
    # No key may occur twice, also among rows that are skipped or fail.  Where every
    # row gets written, the merge finds that out by itself.
    if not carried_out or skip_unchanged:
        require_unique_keys(plan.df)
    elif plain or seen["failed"]:
        require_unique_keys(plan.df if reject is None else plan.df.filter(F.col("error").isNull()), full_key=False)
    if scope is not None:
        require_scope(plan.df, scope)

    judged = skip_unchanged or (carried_out and plain)
    if judged:
        existing = table.read_for(plan.df, snapshot)
        plan = classify(plan, existing, check_values=skip_unchanged)
        plan = WritePlan(plan.df, plan.operation, plan.mode, skip_unchanged)
    if not carried_out:
        return plan.to_report(dry_run=dry_run, read_only=read_only)
    if judged:
        plan = plan.on(stage(plan.judged().df, "judged"))
    if reject is not None:
        reject(plan.df.filter(F.col("error").isNotNull()).select(ROW_INDEX, "error"))
    table.commit_plan(plan.df, "patch" if patch else "put", snapshot, batch)
    return plan.executed_report()


def delete_entities(
    store: EntityStore,
    kind: str,
    keys: DataFrame | Sequence[EntityKey],
    *,
    dry_run: bool = False,
    read_only: bool = False,
    scope: EntityKey | None = None,
) -> WriteReport:
    """Delete by key; keys that are not stored are ignored.

    A key outside `scope` is an error row; then, as with `read_only`, nothing is deleted.
    """
    if not isinstance(keys, DataFrame):
        keys = store.spark.createDataFrame(
            [(k.ns_code, k.path_text) for k in keys], f"{fv.NS} string, {fv.PATH} string"
        )
    elif fv.PATH not in keys.columns:
        raise SchemaError("delete needs __ns__ and __path__ columns, or a list of keys")
    plan = delete_plan(keys, scope)
    plan = plan.on(stage(plan.df, "delete"))
    blocked = dry_run or read_only or (scope is not None and plan.has_errors)
    if blocked:
        return plan.to_report(dry_run=dry_run or not read_only, read_only=read_only)
    store.table(kind).delete_keys(plan.df.filter("should_write"))
    return plan.executed_report()


def run_delete_plan(store: EntityStore, kind: str, plan: WritePlan) -> WriteReport:
    """Carry out a delete plan (duplicate cleanup)."""
    staged = plan.on(stage(plan.df, "delete"))
    store.table(kind).delete_keys(staged.df.filter("should_write"))
    return staged.executed_report()
