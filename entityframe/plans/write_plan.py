"""Write plans: one row per input row with its key, encoded values and action.

A plan is an ordinary DataFrame.  Row problems become `error` texts; nothing is
raised inside a task, so one bad row never hides the report of the others.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

from entityframe import fixed_values as fv
from entityframe.errors import KeyValidationError, SchemaError
from entityframe.functions.keys import KEY_TYPE, EntityKey, key_json
from entityframe.functions.logical import comparable, content_digest, same_type
from entityframe.plans.reports import WriteReport, result_columns, should_write
from entityframe.schema import Schema, column, incomplete_error

PROPERTIES = "properties"
ROW_INDEX = "row_index"
LATEST = "__latest__"
_SUPERSEDED = "a later row of the same key is written"
_STORED_LATER = "a later row of the same key is stored"


#: A number of buckets that keys are spread over, or the sorted key paths at which ranges begin.
Buckets = int | tuple[str, ...]


def bucket_column(ns: Column, path: Column, buckets: Buckets) -> Column:
    """Bucket of an entity: by hash, which spreads a hot namespace or ancestor over many files, or
    the range of key paths it lies in."""
    if isinstance(buckets, int):
        return F.pmod(F.xxhash64(ns, path), F.lit(buckets)).cast("int")

    def search(cuts: tuple[str, ...], first: int) -> Column:
        if not cuts:
            return F.lit(first)
        middle = len(cuts) // 2
        lower, upper = search(cuts[:middle], first), search(cuts[middle + 1 :], first + middle + 1)
        return F.when(path < cuts[middle], lower).otherwise(upper)

    return search(buckets, 0).cast("int")


@dataclass(frozen=True)
class WritePlan:
    """A planned write; `df` holds the rows."""

    df: DataFrame
    operation: str
    mode: str = "upsert"
    skip_unchanged: bool = False

    @property
    def has_errors(self) -> bool:
        return not self.df.filter(F.col("error").isNotNull()).isEmpty()

    def writable(self) -> DataFrame:
        return self.df.filter("should_write")

    def on(self, df: DataFrame) -> WritePlan:
        return WritePlan(df, self.operation, self.mode, self.skip_unchanged)

    def scoped(self, ancestor: EntityKey) -> WritePlan:
        """The plan in which every row outside the ancestor is an error row."""
        wrong = F.when(F.col("error").isNull() & F.col(fv.PATH).isNotNull(), outside(ancestor))
        error = F.coalesce(F.col("error"), wrong)
        action = F.when(error.isNull(), F.col("action")).otherwise(F.lit(fv.ERROR_ACTION))
        return self.on(self.df.withColumns({"error": error, "action": action, "should_write": F.col("should_write") & error.isNull()}))

    def to_report(self, *, dry_run: bool = False, read_only: bool = False) -> WriteReport:
        """Report of a plan that is not carried out."""
        error = F.col("error")
        if read_only:
            error = F.when(F.col("should_write"), F.lit(fv.ERROR_READ_ONLY)).otherwise(error)
        # A blocked row keeps its planned action, an error row of the plan its own.
        results = self.df.select(
            *result_columns(
                F.col("action"),
                error,
                F.col("reason"),
                dry_run=dry_run,
                planned=F.col("should_write"),
            )
        )
        return WriteReport(results, dry_run=dry_run, read_only=read_only)

    def executed_report(self) -> WriteReport:
        """Report of a plan whose writable rows have been committed.

        Rows count as planned only where stored entities were looked at first.
        """
        done = F.lit("patch" if self.operation == "patch" else self.mode)
        if self.operation == "delete":
            done = F.lit("delete")
        results = self.df.select(
            *result_columns(
                F.when(F.col("should_write"), done).otherwise(F.col("action")),
                F.col("error"),
                F.col("reason"),
                dry_run=False,
                planned=F.col("should_write") & F.lit(self.skip_unchanged),
            )
        )
        return WriteReport(results)


    def judged(self) -> WritePlan:
        """What is left to do once actions are known: a commit needs the values of writable rows, a
        report only key and verdict of the others."""
        needed = [fv.NS, fv.PATH, fv.BUCKET, fv.PRESENT, fv.UNINDEXED, fv.DIGEST, PROPERTIES]
        verdict = [ROW_INDEX, "action", fv.KEY, "reason", "error", "should_write"]
        values = [F.when(F.col("should_write"), F.col(n)).alias(n) for n in needed if n in self.df.columns]
        return self.on(self.df.select(*verdict, *values))


def plan_rows(
    df: DataFrame,
    schema: Schema,
    *,
    operation: str = "write",
    mode: str = "upsert",
    properties: Sequence[str] | None = None,
    row_index: str | None = None,
    buckets: Buckets = 1,
    latest_by: str | None = None,
) -> WritePlan:
    """Check, key and encode every row.  Lazy.

    `row_index` names the column that identifies input rows in the report; without
    it Spark's increasing row id is used.  `latest_by` names the column by which `keep_latest`
    chooses among the rows of a key.  Neither has to be declared.
    """
    if schema.key is None and fv.KEY not in df.columns:
        raise SchemaError("a write needs a key recipe in the schema or a __key__ column")
    if operation == "patch" and properties is None:
        raise SchemaError("a patch needs an explicit list of properties")
    if mode not in fv.WRITE_MODES:
        raise SchemaError(f"unknown write mode: {mode!r}")

    key = schema.key_columns(df)
    prepared = schema.with_row_defaults(df, properties)
    encoded, undeclared = schema.encode(prepared, properties)
    index = F.monotonically_increasing_id() if row_index is None else column(row_index)
    row_checks = []
    if operation == "write":
        row_checks = [schema.required_error(df), schema.unknown_error(df, [row_index, latest_by])]

    latest = [] if latest_by is None else [column(latest_by).alias(LATEST)]
    # Stage 1: every value and error once.
    stage = prepared.select(
        index.alias(ROW_INDEX),
        *latest,
        key.value.alias("__raw_key__"),
        key.error.alias("key_error"),
        F.when(key.error.isNull(), key.ns).alias(fv.NS),
        F.when(key.error.isNull(), key.path).alias(fv.PATH),
        F.coalesce(*row_checks, F.lit(None).cast("string")).alias("__row_error__"),
        undeclared.alias("__undeclared__"),
        *[
            F.struct(e.value.alias("value"), e.present.alias("present"), e.error.alias("error"))
            .alias(f"__p{i}__")
            for i, e in enumerate(encoded)
        ],
    )
    parts = [F.col(f"__p{i}__") for i in range(len(encoded))]
    incomplete = incomplete_error(F.col("__raw_key__"), operation)
    checks = [F.col("__row_error__"), F.col("key_error"), incomplete, F.col("__undeclared__")]
    stage = stage.withColumn("error", F.coalesce(*checks, *[p["error"] for p in parts]))

    # Stage 2: rows with an error carry neither key nor values (only the lookup
    # identity, which the uniqueness check of a carried out write needs).
    fine = F.col("error").isNull()
    names = [e.name for e in encoded]
    held = {e.name: p["present"] for p, e in zip(parts, encoded)}
    plain = {e.name: p["present"] for p, e in zip(parts, encoded) if not e.indexed}
    columns = [
        F.col(ROW_INDEX),
        *[F.col(LATEST) for _ in latest],
        F.when(fine, F.lit("patch" if operation == "patch" else mode))
        .otherwise(F.lit(fv.ERROR_ACTION))
        .alias("action"),
        F.when(fine, F.col("__raw_key__")).alias(fv.KEY),
        F.when(fine, _names(held)).alias(fv.PRESENT),
        F.when(fine, _names(plain)).alias(fv.UNINDEXED),
        F.lit(None).cast("string").alias("reason"),
        F.col("error"),
        F.col("key_error"),
        (F.col("key_error").isNull() & incomplete.isNotNull()).alias("incomplete"),
        F.col(fv.NS),
        F.col(fv.PATH),
    ]
    if parts:
        values = F.struct(*[p["value"].alias(n) for p, n in zip(parts, names)])
        columns.append(F.when(fine, values).alias(PROPERTIES))
    if operation == "write":
        types = {e.name: schema.properties[e.name].dtype.spark_type for e in encoded}
        given = {n: (p["value"], types[n]) for n, p in zip(names, parts)}
        columns.append(F.when(fine, content_digest(held, given)).alias(fv.DIGEST))
    planned = stage.select(*columns).withColumns(
        {
            fv.BUCKET: bucket_column(F.col(fv.NS), F.col(fv.PATH), buckets),
            "should_write": should_write(F.col("action"), F.col("error")),
        }
    )
    return WritePlan(planned, operation, mode)


def keep_latest(plan: WritePlan, existing: DataFrame | None = None, latest_by: str | None = None) -> WritePlan:
    """Of the good rows of a key, the one with the greatest `latest_by` is written (nulls are
    least, ties go to the greatest row index); the others are skipped and say why.  So is that one
    if `existing` (raw entities) holds the key with a greater value, which the column can tell where
    it is a property: batches may then come in any order.

    The winners are found by an aggregate, which sends one row per key and task, and joined back
    by row index, which no two rows share: a hot key is nowhere one task's work.  Needs a staged
    plan.
    """
    good = F.col("error").isNull() & F.col(fv.PATH).isNotNull()
    types, later = property_types(plan.df), F.lit(False)
    stored = {} if existing is None else {f.name: f.dataType for f in existing.schema.fields}
    # Compared as stored; values of mixed types have no order.
    given = latest_by in types and latest_by in stored and same_type(stored[latest_by], types[latest_by])
    held = given and not isinstance(types[latest_by], T.VariantType)
    mine = [F.col(PROPERTIES)[latest_by].alias("mine")] if held else []
    newest = F.max(F.struct(F.col(LATEST), F.col(ROW_INDEX), *mine)).alias("newest")
    winners = plan.df.filter(good).groupBy(fv.NS, fv.PATH).agg(newest)
    if held:
        known = existing.select(fv.NS, fv.PATH, column(latest_by).alias("__held__")).filter(F.col("__held__").isNotNull())
        winners = winners.join(known, [fv.NS, fv.PATH], "left")
        own = F.col("newest.mine")
        later = F.col("__held__").isNotNull() & (own.isNull() | (F.col("__held__") > own))
    winners = winners.select(F.col("newest")[ROW_INDEX].alias("__winner__"), later.alias("__later__"))
    joined = plan.df.join(winners, F.col(ROW_INDEX) == F.col("__winner__"), "left")
    older = good & F.coalesce(F.col("__later__"), F.lit(True))
    why = F.when(F.col("__later__"), F.lit(_STORED_LATER)).otherwise(F.lit(_SUPERSEDED))
    folded = joined.withColumns(
        {
            "action": F.when(older, F.lit(fv.SKIP_ACTION)).otherwise(F.col("action")),
            "reason": F.when(older, why).otherwise(F.col("reason")),
            "should_write": F.col("should_write") & ~older,
        }
    )
    return plan.on(folded.drop("__winner__", "__later__", LATEST))


def _names(flags: dict[str, Column]) -> Column:
    """Sorted names whose flag is set."""
    if not flags:
        return F.array().cast("array<string>")
    marked = [F.when(flags[n], F.lit(n)).otherwise(F.lit("")) for n in sorted(flags)]
    return F.array_remove(F.array(*marked), "")


def property_types(df: DataFrame) -> dict[str, T.DataType]:
    if PROPERTIES not in df.columns:
        return {}
    return {f.name: f.dataType for f in df.schema[PROPERTIES].dataType.fields}


def classify(plan: WritePlan, existing: DataFrame | None, *, check_values: bool = True) -> WritePlan:
    """Set each row's action by comparing it with the stored entity.

    `existing` is a raw entity frame (or None for an empty kind).  It is first cut to
    the keys of the batch, a semi join that needs no shuffle of the stored table while
    the batch's keys are small enough to broadcast; then one left join on the lookup
    identity pairs the rows.  With `check_values=False` only existence is looked at,
    which is what a plain insert, update or patch needs.  Full entities are compared by the digest
    stored with each, so that no property is read; a patch, which is a part of an entity, by the
    values of its properties.
    """
    df = plan.df
    types = property_types(df)
    if existing is None:
        return plan.on(_with_action(df, plan, None, {}, types, check_values))

    stored_types = {
        f.name: f.dataType
        for f in existing.schema.fields
        if f.name in types and f.name not in fv.SYSTEM_COLUMNS
    }
    by_digest = check_values and fv.DIGEST in df.columns and fv.DIGEST in existing.columns
    if by_digest:
        wanted = [F.col(fv.DIGEST).alias("digest")]
        stored_types = {}
    else:
        wanted = [F.col(fv.PRESENT).alias("present")]
        if check_values:
            wanted += [column(n) for n in stored_types]
    keys = [fv.NS, fv.PATH] + ([fv.BUCKET] if fv.BUCKET in existing.columns else [])
    batch = df.filter(F.col(fv.PATH).isNotNull()).select(*keys)
    stored = existing.join(batch, keys, "left_semi").select(
        *[F.col(k).alias(f"__s{i}__") for i, k in enumerate(keys)],
        F.struct(*wanted).alias("__stored__"),
    )
    # Rows without a usable key have no path.  Their own row index keeps NULL keys off one task.
    own = F.coalesce(F.col(fv.PATH), F.concat(F.lit("/"), F.col(ROW_INDEX).cast("string")))
    probe = df.withColumn("__probe__", own)
    on = [F.coalesce(probe[fv.NS], F.lit("")) == stored["__s0__"], probe["__probe__"] == stored["__s1__"]]
    if len(keys) == 3:
        on.append(F.coalesce(probe[fv.BUCKET], F.lit(-1)) == stored["__s2__"])
    joined = probe.join(stored, on, "left").drop("__probe__", "__s0__", "__s1__", "__s2__")
    out = _with_action(joined, plan, F.col("__stored__"), stored_types, types, check_values, by_digest)
    return plan.on(out.drop("__stored__"))


def _with_action(df, plan, stored, stored_types, types, check_values, by_digest=False) -> DataFrame:
    exists = F.lit(False) if stored is None else stored.isNotNull()
    full = plan.operation == "write"
    action, reason, error = F.col("action"), F.col("reason"), F.col("error")
    text = F.lit(None).cast("string")

    rules: list[tuple] = []  # (condition, action, reason, error), first match wins
    if full and plan.mode == "update":
        rules.append((~exists, fv.ERROR_ACTION, text, F.lit(fv.ERROR_UPDATE_TARGET)))
    if full and plan.mode == "insert":
        rules.append((exists, fv.ERROR_ACTION, text, F.lit(fv.ERROR_INSERT_TARGET)))
    nothing = F.size(fv.PRESENT) == 0
    if not full and not check_values:
        rules.append((exists & nothing, fv.SKIP_ACTION, F.lit(fv.REASON_PATCH_EMPTY), text))
    if check_values:
        rules.append((~exists, "create", F.lit(fv.REASON_NOT_STORED), text))
        if full:
            same = stored["digest"].eqNullSafe(F.col(fv.DIGEST)) if by_digest else _full_match(stored, stored_types, types)
            rules.append((same, fv.SKIP_ACTION, F.lit(fv.REASON_SAME), text))
            rules.append((F.lit(True), "update", F.lit(fv.REASON_DIFFERENT), text))
        else:
            same = _patch_match(stored, stored_types, types)
            rules.append((nothing, fv.SKIP_ACTION, F.lit(fv.REASON_PATCH_EMPTY), text))
            rules.append((same, fv.SKIP_ACTION, F.lit(fv.REASON_PATCH_SAME), text))
            rules.append((F.lit(True), "patch", F.lit(fv.REASON_PATCH_DIFFERENT), text))
    new_action, new_reason, new_error = action, reason, error
    for when, act, why, err in reversed(rules):
        new_action = F.when(when, F.lit(act)).otherwise(new_action)
        new_reason = F.when(when, why).otherwise(new_reason)
        new_error = F.when(when, err).otherwise(new_error)
    # A row that another one supersedes stays skipped.
    open_row = error.isNull() & (action != fv.SKIP_ACTION)
    judged = df.withColumns(
        {
            "__action__": F.when(open_row, new_action).otherwise(action),
            "__reason__": F.when(open_row, new_reason).otherwise(reason),
            "__error__": F.when(open_row, new_error).otherwise(error),
        }
    )
    return (
        judged.withColumns(
            {"action": F.col("__action__"), "reason": F.col("__reason__"), "error": F.col("__error__")}
        )
        .withColumn("should_write", should_write(F.col("action"), F.col("error")))
        .drop("__action__", "__reason__", "__error__")
    )


def _value_equal(name, stored, stored_types, types):
    mine = comparable(F.col(PROPERTIES)[name], types[name])
    if stored is None or name not in stored_types:
        return mine.isNull()
    if not same_type(stored_types[name], types[name]):
        return F.lit(False)
    return mine.eqNullSafe(comparable(stored[name], stored_types[name]))


def _full_match(stored, stored_types, types):
    """Same set of stored names and equal values."""
    if stored is None:
        return F.lit(False)
    return (stored["present"] == F.col(fv.PRESENT)) & _patch_match(stored, stored_types, types)


def _patch_match(stored, stored_types, types):
    """Equal on the patched names only; absent equals stored null."""
    if stored is None:
        return F.lit(False)
    match = F.lit(True)
    for name in types:
        held = F.array_contains(F.col(fv.PRESENT), name)
        match = match & (~held | _value_equal(name, stored, stored_types, types))
    return match


# --- eager guards ----------------------------------------------------------------


def duplicate_keys(df: DataFrame, *, full_key: bool = True) -> DataFrame:
    """Keys that occur more than once, with their counts; rows that a later one supersedes don't count.

    A partial count on the map side keeps a much repeated key cheap to shuffle.
    """
    df = df.filter(~F.col("reason").eqNullSafe(_SUPERSEDED)) if "reason" in df.columns else df
    if full_key:
        named = df.filter(F.col(fv.KEY).isNotNull()).select(key_json(F.col(fv.KEY)).alias("key"))
        return named.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    named = df.filter(F.col(fv.PATH).isNotNull())
    return (
        named.groupBy(fv.NS, fv.PATH)
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1")
        .select(F.concat_ws(" ", fv.NS, fv.PATH).alias("key"), "rows")
    )


def may_repeat(df: DataFrame, *, full_key: bool = True) -> bool:
    """Does a hash of the keys occur twice?  If not, no key does: equal keys have equal hashes.

    One long value a row is grouped, not the key's text.
    """
    df = df.filter(~F.col("reason").eqNullSafe(_SUPERSEDED)) if "reason" in df.columns else df
    parts = [fv.NS, fv.PATH, *([F.col(fv.KEY)["database"], F.col(fv.KEY)["project"]] if full_key else [])]
    named = df.filter(F.col(fv.KEY if full_key else fv.PATH).isNotNull()).select(F.xxhash64(*parts).alias("hash"))
    return not named.groupBy("hash").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").isEmpty()


def require_unique_keys(df: DataFrame, *, full_key: bool = True) -> None:
    if not may_repeat(df, full_key=full_key):
        return
    found = duplicate_keys(df, full_key=full_key).limit(1).collect()
    if found:
        raise KeyValidationError(f"key occurs {found[0]['rows']} times in one write: {found[0]['key']}")


def plan_metrics() -> list[Column]:
    """Aggregates of a staged plan: key problems, rows without values, rows with errors."""
    return [
        F.min("key_error").alias("key_error"),
        F.count_if("incomplete").alias("incomplete"),
        F.count_if(F.col("error").isNull() & (F.size(fv.PRESENT) == 0)).alias("hollow"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
    ]


def require_good_keys(found: Row) -> None:
    """A write that is carried out raises on key problems instead of reporting them."""
    if found["key_error"] is not None:
        raise KeyValidationError(found["key_error"])
    if found["incomplete"]:
        raise SchemaError(f"{found['incomplete']} row(s) have an incomplete key")


def outside(scope: EntityKey) -> Column:
    """Why a row's key is not under the ancestor; null if it is."""
    inside = F.startswith(F.col(fv.PATH), F.lit(scope.path_text))
    return F.when(F.col(fv.NS) != scope.ns_code, F.lit(fv.ERROR_SCOPE_NAMESPACE)).when(~inside, F.lit(fv.ERROR_SCOPE))


def delete_plan(keys: DataFrame, scope: EntityKey | None = None) -> WritePlan:
    """Plan to delete the keys of a frame with `__ns__` and `__path__`."""
    text = F.lit(None).cast("string")
    error = text if scope is None else outside(scope)
    key = F.col(fv.KEY) if fv.KEY in keys.columns else F.lit(None).cast(KEY_TYPE)
    planned = keys.select(
        F.concat_ws(" ", fv.NS, fv.PATH).alias(ROW_INDEX),
        F.when(error.isNull(), F.lit("delete")).otherwise(F.lit(fv.ERROR_ACTION)).alias("action"),
        key.alias(fv.KEY),
        text.alias("reason"),
        error.alias("error"),
        F.col(fv.NS),
        F.col(fv.PATH),
        error.isNull().alias("should_write"),
    )
    return WritePlan(planned, "delete")


def require_scope(df: DataFrame, ancestor: EntityKey) -> None:
    """All planned keys lie under the ancestor."""
    wrong = df.filter(F.col(fv.KEY).isNotNull()).select(fv.PATH, outside(ancestor).alias("why"))
    for row in wrong.filter("why IS NOT NULL").limit(1).collect():
        raise SchemaError(f"{row['why']}: {row[fv.PATH]}")
