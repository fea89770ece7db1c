"""A kind bound to a store, with default scope, filters and write policies."""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Iterator, Sequence

from pyspark.sql import DataFrame

from entityframe import api
from entityframe.functions.keys import EntityKey
from entityframe.operators.audit import AuditPolicy
from entityframe.operators.dedup import plan_duplicate_cleanup
from entityframe.operators.paging import Page
from entityframe.plans.query import Filter, PagePosition, QuerySpec
from entityframe.plans.reports import WriteReport
from entityframe.plans.write_plan import WritePlan, require_scope
from entityframe.schema import Schema
from entityframe.sources.store import EntityStore


@dataclass(frozen=True)
class KindAccessor:
    """Reads and writes one kind; the fields are defaults of its methods."""

    schema: Schema
    store: EntityStore
    namespace: str | None = None
    ancestor: EntityKey | None = None
    filters: Sequence[Filter] = ()
    order: Sequence[str] = ()
    projection: Sequence[str] | None = None
    distinct_on: Sequence[str] | None = None
    read_only: bool = False
    audit: AuditPolicy | None = None
    enforce_ancestor: bool = True

    @property
    def kind(self) -> str:
        return self.schema.kind

    # --- reading ---

    def _scan_options(
        self, *, filters=None, namespace=None, projection=None, order=None, distinct_on=None, ancestor=None, **rest
    ) -> dict:
        """Call-time filters are added to the bound ones; everything else replaces.

        The namespace of an ancestor wins over any other."""

        def pick(given, bound):
            return bound if given is None else given

        scope = pick(ancestor, self.ancestor)
        return {
            "filters": [*self.filters, *(filters or ())],
            "namespace": scope.namespace if scope else pick(namespace, self.namespace),
            "projection": pick(projection, self.projection),
            "order": pick(order, self.order),
            "distinct_on": pick(distinct_on, self.distinct_on),
            "ancestor": scope,
            **rest,
        }

    def read(self, **options) -> DataFrame:
        return api.read_entities(
            self.store, self.kind, schema=self.schema, **self._scan_options(**options)
        )

    def iter(self, *, chunksize: int = 1000, **options) -> Iterator[DataFrame]:
        return api.iter_entities(
            self.store,
            self.kind,
            chunksize=chunksize,
            schema=self.schema,
            **self._scan_options(**options),
        )

    def page(self, limit: int, *, after: PagePosition | None = None, include_key: bool = False, **options) -> Page:
        """One page in the bound or given order, from the start or after another page's `next`."""
        return api.read_page(
            self.store,
            self.kind,
            limit,
            after=after,
            schema=self.schema,
            include_key=include_key,
            **self._scan_options(**options),
        )

    def raw(self, **options) -> DataFrame:
        """Matching entities with their system columns."""
        options = {k: v for k, v in self._scan_options(**options).items() if k != "include_key"}
        return api.scan(self.store, QuerySpec(self.kind, **options), self.schema)

    def count(self, **options) -> int:
        """Number of entities; only key columns are read."""
        return self.raw(projection=[], keys_only=True, order=(), **options).count()

    # --- writing ---

    def plan_write(self, df: DataFrame, **options) -> WritePlan:
        plan = api.plan_entities(self.store, self._prepared(df), self.schema, **options)
        scope = self._scope()
        if scope is not None:
            require_scope(plan.df, scope)
        return plan

    def write(self, df: DataFrame, *, read_only: bool | None = None, **options) -> WriteReport:
        return api.write_entities(
            self.store,
            self._prepared(df),
            self.schema,
            read_only=self.read_only if read_only is None else read_only,
            scope=self._scope(),
            **options,
        )

    def patch(
        self, df: DataFrame, *, properties: Sequence[str], read_only: bool | None = None, **options
    ) -> WriteReport:
        return api.patch_entities(
            self.store,
            self._prepared(df),
            self.schema,
            properties=properties,
            read_only=self.read_only if read_only is None else read_only,
            scope=self._scope(),
            **options,
        )

    def delete(self, keys, *, dry_run: bool = False, read_only: bool | None = None) -> WriteReport:
        """Delete by key, under the same guards as a write."""
        return api.delete_entities(
            self.store,
            self.kind,
            keys,
            dry_run=dry_run,
            read_only=self.read_only if read_only is None else read_only,
            scope=self._scope(),
        )

    # --- duplicates ---

    def plan_duplicate_cleanup(
        self,
        *,
        by: Sequence[str],
        frame: DataFrame | None = None,
        keep: str = "first",
        order: Sequence[str] = (),
        filters: Sequence[Filter] | None = None,
        limit: int | None = None,
        row_index: str | None = None,
    ) -> WritePlan:
        rows = self.raw(filters=filters, limit=limit) if frame is None else frame
        return plan_duplicate_cleanup(rows, by, order=order, keep=keep, row_index=row_index)

    def cleanup_duplicates(
        self, *, dry_run: bool = True, read_only: bool | None = None, **options
    ) -> WriteReport:
        """Plan, then report (by default) or delete."""
        plan = self.plan_duplicate_cleanup(**options)
        blocked = self.read_only if read_only is None else read_only
        if dry_run or blocked:
            return plan.to_report(dry_run=dry_run, read_only=blocked)
        return api.run_delete_plan(self.store, self.kind, plan)

    # --- narrower accessors ---

    def with_scope(
        self,
        *,
        namespace: str | None = None,
        ancestor: EntityKey | None = None,
        filters: Sequence[Filter] | None = None,
        read_only: bool | None = None,
        audit: AuditPolicy | None = None,
    ) -> KindAccessor:
        """Copy with some defaults replaced; None keeps the bound value."""
        given = {
            "namespace": namespace,
            "ancestor": ancestor,
            "filters": filters,
            "read_only": read_only,
            "audit": audit,
        }
        return replace(self, **{k: v for k, v in given.items() if v is not None})

    def with_order(self, *order: str) -> KindAccessor:
        """Copy that reads in this order; none is key order."""
        return replace(self, order=order)

    def with_ancestor(self, ancestor: EntityKey) -> KindAccessor:
        return self.with_scope(ancestor=ancestor)

    def _prepared(self, df: DataFrame) -> DataFrame:
        return df if self.audit is None else self.audit.apply(df)

    def _scope(self) -> EntityKey | None:
        return self.ancestor if self.enforce_ancestor else None


def kind(*, schema: Schema, store: EntityStore, **defaults) -> KindAccessor:
    """Bound accessor of one schema."""
    return KindAccessor(schema, store, **defaults)
