"""Entity tables on Parquet.

A kind is a folder with two tables:

* `data/commit=<id>/[__ns__=<namespace>/]__b__=<bucket>/` holds the rows one commit
  wrote, sorted by `__path__` inside a file;
* `versions/<commit>/` lists the partitions that are live after a commit and the commit each
  one comes from; `versions/claims/<number>` names the commit that made that version.

A commit rewrites only the partitions its rows fall into, next to the old ones, and becomes
visible when its claim is created.  A claim is created once: of two writers that start from
one version, the second is told.  Readers keep the version they opened, and no job overwrites
a path it reads.  Files of a commit without a claim are never read.
"""

from __future__ import annotations

import bisect
import json
import uuid
from dataclasses import dataclass
from functools import reduce
from typing import Any, Callable, Collection, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from entityframe import fixed_values as fv
from entityframe.errors import KeyValidationError, SchemaError, WriteConflictError
from entityframe.functions.keys import KEY_TYPE, EntityKey, namespace_code
from entityframe.functions.logical import DIGEST_TYPE, content_digest, same_type
from entityframe.plans.write_plan import PROPERTIES, Buckets, bucket_column, property_types
from entityframe.schema import Schema, column, field_types
from entityframe.sources.pointer import create_if_absent, names_in, read_text
from entityframe.sources.staging import NO_DICTIONARY, compiled, small_splits, stage

_NAMES = T.ArrayType(T.StringType())
_VERSION_ROW = T.StructType(
    [
        T.StructField("ns", T.StringType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("written", T.StringType()),
        T.StructField("schema", T.StringType()),  # set on one row per version only
        T.StructField("buckets", T.IntegerType()),
        T.StructField("cuts", _NAMES),
        T.StructField("by_namespace", T.BooleanType()),
        T.StructField("streams", T.StringType()),
    ]
)
# "No snapshot given" is not the same as "the kind has no version yet".
NEWEST: Any = object()


@dataclass(frozen=True)
class Snapshot:
    """One committed version of a kind: its columns and its live partitions."""

    version: int
    properties: T.StructType
    partitions: frozenset[tuple[str | None, int, str]]  # (namespace code, bucket, commit)
    buckets: Buckets
    by_namespace: bool
    streams: Mapping[str, int]  # the last batch of each stream that is in this version


class EntityStore:
    """Entity tables under one root folder.

    `buckets` (or `ranges`) and `by_namespace` hold for kinds first written through this object; a
    kind keeps the layout it started with.  Pick `buckets` so that the largest
    namespace divided by it is a file size you like (a few hundred MB).  With
    `by_namespace` the namespace is a partition folder, which lets scans skip the
    others.  By hash, a batch of more rows than buckets touches all of them and rewrites the kind.
    `ranges`, a list of keys at which ranges of key paths begin, keeps neighbours together instead:
    a batch whose keys lie close by, such as a day's or a customer's, rewrites only their ranges,
    and a scan of an ancestor opens only its own; `choose_ranges` finds even ones.  For many small
    namespaces turn namespace folders off, as Parquet statistics on
    the sorted `__ns__` do that work with far fewer files.  A merge gives a partition one task
    for every `task_bytes` of files or `task_rows` rows of it, so a large namespace or bucket is not
    one task, and what a task sorts does not grow with the kind.  Files are cut
    into row groups of `row_group_bytes`; as they are sorted by key path, a lookup of few keys
    reads only the groups whose range of paths holds one.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        *,
        buckets: int = 8,
        ranges: Sequence[EntityKey | str] | None = None,
        by_namespace: bool = True,
        task_bytes: int = 256 << 20,
        task_rows: int = 100_000,
        row_group_bytes: int = 32 << 20,
    ) -> None:
        if spark.conf.get("spark.sql.session.timeZone").upper() not in ("UTC", "ETC/UTC", "Z"):
            raise SchemaError("entity timestamps need spark.sql.session.timeZone=UTC")
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets: Buckets = buckets
        if ranges is not None:
            cuts = {cut.path_text if isinstance(cut, EntityKey) else cut for cut in ranges}
            self.buckets = tuple(sorted(cuts, key=str.encode))
        self.by_namespace = by_namespace
        self.task_bytes = task_bytes
        self.task_rows = task_rows
        self.row_group_bytes = row_group_bytes

    def table(self, kind: str) -> EntityTable:
        return EntityTable(self, kind)


class EntityTable:
    def __init__(self, store: EntityStore, kind: str) -> None:
        self.store = store
        self.spark = store.spark
        self.kind = kind
        self.path = f"{store.root}/{kind}"

    # --- reading ---

    def snapshot(self, version: int | None = None) -> Snapshot | None:
        """The newest (or a given) version; None for a kind never written."""
        claims = f"{self.path}/versions/claims"
        known = sorted((int(n) for n in names_in(self.spark, claims) if n.isdigit()), reverse=True)
        if not known:
            return None
        if version is not None and version not in known:
            raise SchemaError(f"version {version} of {self.kind} does not exist")
        for number in known if version is None else [version]:
            commit = read_text(self.spark, _claim(claims, number))
            if commit:  # else it is just being written
                return self._listed(number, commit)
        return None

    def _listed(self, version: int, commit: str) -> Snapshot:
        # Bounded by the number of partition folders, not by rows of the table.
        rows = self.spark.read.schema(_VERSION_ROW).parquet(f"{self.path}/versions/{commit}").collect()
        head = next(r for r in rows if r["schema"] is not None)
        live = frozenset((r["ns"], r["bucket"], r["written"]) for r in rows if r["schema"] is None)
        properties = T.StructType.fromJson(json.loads(head["schema"]))
        streams = json.loads(head["streams"])
        buckets = head["buckets"] if head["cuts"] is None else tuple(head["cuts"])
        return Snapshot(version, properties, live, buckets, head["by_namespace"], streams)

    def layout(self, snapshot: Snapshot | None) -> tuple[Buckets, bool]:
        """Number of buckets or where their ranges begin, and whether namespaces are folders."""
        if snapshot is None:
            return self.store.buckets, self.store.by_namespace
        return snapshot.buckets, snapshot.by_namespace

    def exists(self) -> bool:
        return self.snapshot() is not None

    def read(
        self,
        snapshot: Snapshot | None = None,
        only: Iterable[tuple[str | None, int]] | None = None,
    ) -> DataFrame | None:
        """Raw entity frame of a version: system columns, then properties.

        `only` narrows it to some (namespace code, bucket) partitions; the condition
        is on partition columns alone, so the other folders are not opened.
        """
        snapshot = snapshot or self.snapshot()
        if snapshot is None:
            return None
        wanted = None if only is None else set(only)
        live = [p for p in snapshot.partitions if wanted is None or (p[0], p[1]) in wanted]
        if not live:
            return self.spark.createDataFrame([], self._frame_type(snapshot.properties))
        base = f"{self.path}/data"
        frame_type = self._frame_type(snapshot.properties)
        physical = T.StructType(
            [f for f in frame_type.fields if f.name != fv.BUCKET]
            + [T.StructField(fv.BUCKET, T.IntegerType()), T.StructField("commit", T.StringType())]
        )
        rows = (
            self.spark.read.schema(physical)
            .option("basePath", base)
            .parquet(*[f"{base}/commit={w}" for w in sorted({p[2] for p in live})])
        )
        if wanted is not None or snapshot.version > 1:
            parts = [F.col("commit"), F.col(fv.BUCKET).cast("string")]
            if snapshot.by_namespace:
                parts.append(F.col(fv.NS))
            labels = [
                f"{w}/{b}/{ns}" if snapshot.by_namespace else f"{w}/{b}" for ns, b, w in live
            ]
            rows = rows.filter(F.concat_ws("/", *parts).isin(labels))
        return rows.select(*[f.name for f in frame_type.fields])

    @staticmethod
    def _frame_type(properties: T.StructType) -> T.StructType:
        return T.StructType(
            [
                T.StructField(fv.KEY, KEY_TYPE),
                T.StructField(fv.NS, T.StringType()),
                T.StructField(fv.PATH, T.StringType()),
                T.StructField(fv.BUCKET, T.IntegerType()),
                T.StructField(fv.PRESENT, _NAMES),
                T.StructField(fv.UNINDEXED, _NAMES),
                T.StructField(fv.DIGEST, DIGEST_TYPE),
                *properties.fields,
            ]
        )

    def read_under(self, ancestor: EntityKey) -> DataFrame | None:
        """The partitions that descendants of a key can lie in; all of them if keys are hashed."""
        snapshot = self.snapshot()
        if snapshot is None or isinstance(snapshot.buckets, int):
            return self.read(snapshot)
        cuts, prefix = [cut.encode() for cut in snapshot.buckets], ancestor.path_text.encode()
        # Paths below end in a slash like this one, so the next larger text begins beyond them.
        last = bisect.bisect_left(cuts, prefix[:-1] + bytes([prefix[-1] + 1]))
        code = ancestor.ns_code if snapshot.by_namespace else None
        return self.read(snapshot, [(code, bucket) for bucket in range(bisect.bisect_right(cuts, prefix), last + 1)])

    def read_for(self, batch: DataFrame, snapshot: Snapshot | None = NEWEST) -> DataFrame | None:
        """The partitions that the keys of a (staged) batch fall into."""
        snapshot = self.snapshot() if snapshot is NEWEST else snapshot
        return None if snapshot is None else self.read(snapshot, self._touched(snapshot, batch))

    def _touched(self, snapshot: Snapshot | None, batch: DataFrame) -> set:
        return set(self._counted(snapshot, batch))

    def _counted(self, snapshot: Snapshot | None, rows: DataFrame) -> dict[tuple[str | None, int], int]:
        """The partitions that rows fall into, and how many each gets."""
        folders = self._folders(snapshot)
        # Bounded by the number of partition folders, not by rows or namespaces.
        found = rows.filter(F.col(fv.PATH).isNotNull()).groupBy(*folders).agg(F.count(F.lit(1)).alias("rows")).collect()
        return {((r[fv.NS] if fv.NS in folders else None), r[fv.BUCKET]): r["rows"] for r in found}

    # --- bulk lookup ---

    def get(self, keys: DataFrame | Sequence[EntityKey]) -> DataFrame | None:
        """Stored entities of the given keys (a frame with `__ns__`, `__path__`, or
        Python keys).

        Few keys are also named to the Parquet reader, which then passes over row groups and
        pages without any of them; many are joined.
        """
        snapshot = self.snapshot()
        if snapshot is None:
            return None
        listed = not isinstance(keys, DataFrame)
        if listed:
            pairs = [(k.ns_code, k.path_text) for k in keys]
            keys = self.spark.createDataFrame(pairs, f"{fv.NS} string, {fv.PATH} string")
        else:
            # Bounded; more rows than that are many, whatever they repeat.
            pairs = [tuple(r) for r in keys.select(fv.NS, fv.PATH).limit(_FEW_KEYS + 1).collect()]
        bucket = bucket_column(F.col(fv.NS), F.col(fv.PATH), snapshot.buckets)
        wanted = keys.select(fv.NS, fv.PATH, bucket.alias(fv.BUCKET))
        if not listed:
            wanted = stage(wanted, "wanted")
        rows = self.read(snapshot, self._touched(snapshot, wanted))
        if len(pairs) <= _FEW_KEYS:
            rows = rows.filter(_named(fv.PATH, sorted({path for _, path in pairs if path is not None})))
        return rows.join(wanted, [fv.NS, fv.PATH, fv.BUCKET], "left_semi")

    # --- writing ---

    def commit_plan(
        self,
        plan_df: DataFrame,
        how: str | Mapping[str, str],
        snapshot: Snapshot | None = NEWEST,
        batch: tuple[str, int] | None = None,
    ) -> int | None:
        """Merge the writable rows of a (staged) plan; `how` as in `merge`."""
        types = property_types(plan_df)
        values = [F.col(PROPERTIES)[n].alias(n) for n in types]
        digest = [fv.DIGEST] if fv.DIGEST in plan_df.columns else []
        changes = plan_df.filter("should_write").select(
            fv.KEY, fv.NS, fv.PATH, fv.BUCKET, fv.PRESENT, fv.UNINDEXED, *digest, *values
        )
        return self.merge(changes, how, snapshot, batch)

    def merge(
        self,
        changes: DataFrame,
        how: str | Mapping[str, str],
        snapshot: Snapshot | None = NEWEST,
        batch: tuple[str, int] | None = None,
    ) -> int | None:
        """New version with `changes` applied; None when there was nothing to do.

        `how` is put, patch or delete, or says for each changed property by which rule its stored
        and its new value become one.

        The new version follows `snapshot`, the one the changes were made for; if another
        writer has been faster, nothing is changed and a `WriteConflictError` says so.

        Old and new rows of the touched partitions are unioned, shuffled once by
        partition, and paired per key inside the task that writes the file.  That pairing
        also tells whether a key occurs twice in `changes`.
        """
        snapshot = self.snapshot() if snapshot is NEWEST else snapshot
        rows = self._counted(snapshot, changes)
        touched = set(rows)
        if not touched:
            return None
        target = self._merged_properties(snapshot, changes)
        existing = None if snapshot is None else self.read(snapshot, touched)
        folders = self._folders(snapshot)
        pieces = self._pieces(snapshot, existing, changes, rows)
        paired = pair_rows(existing, changes, target, folders, _partitions(self.spark, pieces.values()), pieces)
        if how == "delete":
            return self._commit(snapshot, merge_rows(paired, target, how), touched, target, batch=batch)
        # A key that occurs twice fails the job that writes the files; nothing is published then.
        text = F.concat(F.lit(_REPEATED), F.col(fv.PATH))
        once = paired.withColumn("new", F.when(F.col("changes") > 1, F.raise_error(text)).otherwise(F.col("new")))
        try:
            return self._commit(snapshot, merge_rows(once, target, how), touched, target, may_empty=False, batch=batch)
        except Exception as problem:
            if _REPEATED in str(problem):
                self._raise_repeated(changes)
            raise

    def _pieces(
        self, snapshot: Snapshot | None, existing: DataFrame | None, changes: DataFrame, rows: Mapping[tuple[str | None, int], int]
    ) -> dict[tuple[str | None, int], int]:
        """Tasks of each touched partition, from the sizes of the files to be read and the rows in it."""
        known = _scanned_bytes(changes) + (0 if existing is None else _scanned_bytes(existing))
        least = max(1, -(-known // (self.store.task_bytes * max(1, len(rows)))))
        # Files shrink repeated values that take their full size in a sort.
        held = {} if existing is None else self._counted(snapshot, existing)
        return {part: max(least, -(-(n + held.get(part, 0)) // self.store.task_rows)) for part, n in rows.items()}

    @staticmethod
    def _raise_repeated(changes: DataFrame) -> None:
        row = (
            changes.groupBy(fv.NS, fv.PATH)
            .agg(F.count(F.lit(1)).alias("rows"))
            .filter("rows > 1")
            .limit(1)
            .collect()[0]
        )
        raise KeyValidationError(f"key occurs {row['rows']} times in one write: {row[fv.PATH]}")

    def delete_keys(self, keys: DataFrame) -> int | None:
        """Delete the entities whose `__ns__` and `__path__` are listed."""
        snapshot = self.snapshot()
        buckets, _ = self.layout(snapshot)
        changes = keys.select(fv.NS, fv.PATH).withColumn(
            fv.BUCKET, bucket_column(F.col(fv.NS), F.col(fv.PATH), buckets)
        )
        return self.merge(stage(changes, "delete"), "delete", snapshot)

    def clear(self, namespace: str | None = None, *, all_namespaces: bool = False) -> int | None:
        """Delete one namespace (None is the default one), or the whole kind.

        With namespace folders this only writes a new version list.
        """
        snapshot = self.snapshot()
        if snapshot is None:
            return None
        if all_namespaces:
            return self._publish(snapshot, frozenset(), snapshot.properties)
        code = namespace_code(namespace)
        if snapshot.by_namespace:
            kept = frozenset(p for p in snapshot.partitions if p[0] != code)
            return self._publish(snapshot, kept, snapshot.properties)
        kept_rows = (
            self.read(snapshot)
            .filter(F.col(fv.NS) != code)
            .repartition(fv.BUCKET)
            .sortWithinPartitions(fv.BUCKET, fv.NS, fv.PATH)
        )
        touched = {(ns, b) for ns, b, _ in snapshot.partitions}
        return self._commit(snapshot, kept_rows, touched, snapshot.properties)

    def _merged_properties(self, snapshot: Snapshot | None, changes: DataFrame) -> T.StructType:
        """Known columns plus new ones; a column keeps its type for good."""
        known = [] if snapshot is None else list(snapshot.properties.fields)
        types = {f.name: f.dataType for f in known}
        for name, dtype in field_types(changes).items():
            if name in fv.SYSTEM_COLUMNS:
                continue
            if name not in types:
                known.append(T.StructField(name, _nullable(dtype)))
            elif not same_type(types[name], dtype):
                raise SchemaError(
                    f"{self.kind}.{name} is stored as {types[name].simpleString()}, not "
                    f"{dtype.simpleString()}; use ObjectType for properties of mixed type"
                )
        return T.StructType(known)

    def _commit(
        self,
        snapshot: Snapshot | None,
        rows: DataFrame,
        touched: set[tuple[str | None, int]],
        properties: T.StructType,
        *,
        may_empty: bool = True,
        batch: tuple[str, int] | None = None,
    ) -> int:
        commit = uuid.uuid4().hex
        folders = self._folders(snapshot)
        path = f"{self.path}/data/commit={commit}"
        with compiled(rows.sparkSession), small_splits(rows.sparkSession):
            writer = rows.write.option("parquet.block.size", str(self.store.row_group_bytes)).options(**NO_DICTIONARY)
            writer.partitionBy(*folders).parquet(path)
        kept_folders = self._written(path, folders) if may_empty else touched
        fresh = {(ns, bucket, commit) for ns, bucket in kept_folders}
        old = frozenset() if snapshot is None else snapshot.partitions
        kept = {p for p in old if (p[0], p[1]) not in touched}
        return self._publish(snapshot, frozenset(kept | fresh), properties, batch)

    def _folders(self, snapshot: Snapshot | None) -> list[str]:
        """Partition columns, outermost first."""
        return [fv.NS, fv.BUCKET] if self.layout(snapshot)[1] else [fv.BUCKET]

    def _written(self, path: str, folders: list[str]) -> set[tuple[str | None, int]]:
        """Folders a commit really has: a delete may leave a partition without rows."""
        types = {fv.NS: T.StringType(), fv.BUCKET: T.IntegerType()}
        columns = [fv.PATH, *folders]
        physical = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in columns])
        found = self.spark.read.schema(physical).parquet(path).select(*folders).distinct()
        return {((r[fv.NS] if fv.NS in folders else None), r[fv.BUCKET]) for r in found.collect()}

    def _publish(
        self,
        snapshot: Snapshot | None,
        partitions: frozenset[tuple[str | None, int, str]],
        properties: T.StructType,
        batch: tuple[str, int] | None = None,
    ) -> int:
        """Make the version after `snapshot`, or raise if there is one already."""
        version = 1 if snapshot is None else snapshot.version + 1
        streams = dict(snapshot.streams if snapshot else {}) | (dict([batch]) if batch else {})
        buckets, by_namespace = self.layout(snapshot)
        number, cuts = (buckets, None) if isinstance(buckets, int) else (None, list(buckets))
        rows = [(None, None, None, properties.json(), number, cuts, by_namespace, json.dumps(streams))]
        rows += [(*p, None, None, None, None, None) for p in sorted(partitions, key=str)]
        commit = uuid.uuid4().hex
        listing = self.spark.createDataFrame(rows, _VERSION_ROW)
        listing.coalesce(1).write.parquet(f"{self.path}/versions/{commit}")
        if not create_if_absent(self.spark, _claim(f"{self.path}/versions/claims", version), commit):
            raise WriteConflictError(f"version {version} of {self.kind} was committed by another writer")
        return version

    def expire(self, keep: int = 1) -> list[str]:
        """Commits that none of the newest `keep` versions reads; their folders under `data`
        and `versions` may be removed once no reader of an older version is left."""
        newest = self.snapshot()
        if newest is None:
            return []
        live: set[str] = set()
        for version in range(max(1, newest.version - keep + 1), newest.version + 1):
            live |= {written for _, _, written in self.snapshot(version).partitions}
        written = [n.removeprefix("commit=") for n in names_in(self.spark, f"{self.path}/data") if n.startswith("commit=")]
        return sorted(set(written) - live)


#: Rows whose keys `choose_ranges` looks at, the first by a hash.
_RANGE_SAMPLE = 20_000


def choose_ranges(df: DataFrame, schema: Schema, pieces: int) -> list[str]:
    """Where to begin ranges so that the keys of `df` fall evenly into some `pieces` of them.

    From a bounded sample of the keys; ranges are only as even as that, but any are right.
    """
    path = schema.key_columns(df).path
    keys = df.select(path.alias(fv.PATH)).filter(F.col(fv.PATH).isNotNull()).distinct()
    sample = keys.orderBy(F.xxhash64(fv.PATH), fv.PATH).limit(_RANGE_SAMPLE).collect()
    paths = sorted((r[fv.PATH] for r in sample), key=str.encode)
    return sorted({paths[i * len(paths) // pieces] for i in range(1, pieces)}, key=str.encode) if paths else []


_REPEATED = "more than one change of one key: "
_FEW_KEYS = 500


def _named(name: str, values: Sequence[str]) -> Column:
    """Membership in a short list, in two forms: as a set, by which rows are tested, and as equalities,
    by which the Parquet reader prunes; of a list of more than ten it would take the range only."""
    if not values:
        return F.lit(False)
    found = [F.col(name) == v for v in values]
    while len(found) > 1:  # a flat tree; a chain would be as deep as the list is long
        found = [reduce(Column.__or__, found[i : i + 2]) for i in range(0, len(found), 2)]
    return F.col(name).isin(list(values)) & found[0]


def _claim(folder: str, version: int) -> str:
    return f"{folder}/{version:012d}"


def _scanned_bytes(df: DataFrame) -> int:
    """Bytes of the tables that a frame reads, as far as Spark knows them."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    unknown = int(df.sparkSession.conf.get("spark.sql.defaultSizeInBytes", str(2**63 - 1)))
    return sum(size for size in sizes if size < unknown)


def _partitions(spark: SparkSession, pieces: Collection[int]) -> int | None:
    """Tasks of a merge: one per folder once there are more folders than the session's
    default; below that the default, which Spark may coalesce.  Where folders are cut, twice as many
    as pieces, so that few of them meet in a task."""
    if max(pieces) > 1:
        return 2 * sum(pieces)
    default = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return len(pieces) if len(pieces) > default else None


def pair_rows(
    existing: DataFrame | None,
    changes: DataFrame,
    properties: T.StructType,
    folders: Sequence[str],
    partitions: int | None = None,
    pieces: Mapping[tuple[str | None, int], int] | None = None,
) -> DataFrame:
    """Stored row (`old`) and changed row (`new`) of every key, side by side.

    One shuffle, by the folder columns: grouping by key starts with them, so it needs no
    other, and its sort leaves the rows in the order of folders and key paths in which
    the files are written.  `changes` counts the changed rows of the key.  A folder is dealt
    to as many tasks as `pieces` says by its keys, so that a large one is not one task.
    """
    body = [fv.KEY, fv.PRESENT, fv.UNINDEXED, fv.DIGEST, *[f.name for f in properties.fields]]
    body_type = T.StructType(
        [
            T.StructField(fv.KEY, KEY_TYPE),
            T.StructField(fv.PRESENT, _NAMES),
            T.StructField(fv.UNINDEXED, _NAMES),
            T.StructField(fv.DIGEST, DIGEST_TYPE),
            *properties.fields,
        ]
    )
    types = {f.name: f.dataType for f in body_type.fields}

    def side(df: DataFrame, stored: bool) -> DataFrame:
        have = set(df.columns)
        filled = F.struct(
            *[
                (column(n) if n in have else F.lit(None)).cast(types[n]).alias(n) for n in body
            ]
        )
        empty = F.lit(None).cast(body_type)
        return df.select(
            fv.NS,
            fv.BUCKET,
            fv.PATH,
            (filled if stored else empty).alias("old"),
            (empty if stored else filled).alias("new"),
        )

    both = side(changes, stored=False)
    if existing is not None:
        both = side(existing, stored=True).unionByName(both)
    deal = list(folders)
    dealt: dict[int, list[str]] = {}
    for (ns, bucket), n in (pieces or {}).items():
        dealt.setdefault(n, []).append(f"{bucket}/{ns}" if fv.NS in folders else str(bucket))
    if any(n > 1 for n in dealt):
        label = F.concat_ws("/", F.col(fv.BUCKET).cast("string"), *([F.col(fv.NS)] if fv.NS in folders else []))
        # Most partitions of a kind have few sizes, so this is a short list of long memberships.
        number = reduce(lambda rest, n: F.when(label.isin(dealt[n]), F.lit(n)).otherwise(rest), sorted(dealt)[1:], F.lit(min(dealt)))
        # Not the hash that buckets come from, of which a bucket has only some remainders.
        both = both.withColumn("__piece__", F.pmod(F.xxhash64(F.lit("piece"), fv.NS, fv.PATH), number))
        deal.append("__piece__")
    spread = both.repartition(*deal) if partitions is None else both.repartition(partitions, *deal)
    keys = [*folders, *[n for n in (fv.NS, fv.BUCKET, fv.PATH) if n not in folders], *deal[len(folders) :]]  # last, so that files are in key order
    return spread.groupBy(*keys).agg(
        F.first("old", ignorenulls=True).alias("old"),
        F.first("new", ignorenulls=True).alias("new"),
        F.count("new").alias("changes"),
    )


def merge_rows(paired: DataFrame, properties: T.StructType, how: str | Mapping[str, str]) -> DataFrame:
    """The entities that result from paired rows."""
    old, new = F.col("old"), F.col("new")
    if how == "delete":
        result = paired.filter(new.isNull()).withColumn("row", old)
    elif how == "put":
        result = paired.withColumn("row", F.coalesce(new, old))
    elif how == "patch":
        result = paired.withColumn("row", _patched(old, new, properties))
    elif not isinstance(how, str):
        result = paired.withColumn("row", _patched(old, new, properties, how))
    else:
        raise SchemaError(f"unknown merge: {how!r}")
    row = F.col("row")
    held = {f.name: F.array_contains(row[fv.PRESENT], f.name) for f in properties.fields}
    fresh = content_digest(held, {f.name: (row[f.name], f.dataType) for f in properties.fields})
    # A full row brings its digest along; a mixed one gets it here.
    digest = F.coalesce(row[fv.DIGEST], fresh).alias(fv.DIGEST)
    kept = [fv.KEY, fv.PRESENT, fv.UNINDEXED, *[f.name for f in properties.fields]]
    return result.select(fv.NS, fv.BUCKET, fv.PATH, digest, *[row[n].alias(n) for n in kept])


def _patched(old: Column, new: Column, properties: T.StructType, rules: Mapping[str, str] | None = None) -> Column:
    """The stored row with the values that the change holds, or what a rule makes of both."""
    none = F.array().cast(_NAMES)

    def union(name: str) -> Column:
        return F.sort_array(
            F.array_union(F.coalesce(old[name], none), F.coalesce(new[name], none))
        )

    def changed(name: str) -> Column:
        return combined((rules or {}).get(name, "replace"), old[name], new[name])

    values = [
        F.when(F.array_contains(new[fv.PRESENT], f.name), changed(f.name))
        .otherwise(old[f.name])
        .alias(f.name)
        for f in properties.fields
    ]
    mixed = F.struct(
        F.coalesce(old[fv.KEY], new[fv.KEY]).alias(fv.KEY),
        union(fv.PRESENT).alias(fv.PRESENT),
        union(fv.UNINDEXED).alias(fv.UNINDEXED),
        F.lit(None).cast(DIGEST_TYPE).alias(fv.DIGEST),
        *values,
    )
    return F.when(new.isNull(), old).otherwise(mixed)


# How a stored and a new value become one; a missing one leaves the other.
_RULES: dict[str, Callable[[Column, Column], Column]] = {
    "replace": lambda old, new: new,
    "add": lambda old, new: F.coalesce(old + new, old, new),
    "min": F.least,
    "max": F.greatest,
    "keep": F.coalesce,
}


def combined(rule: str, old: Column, new: Column) -> Column:
    if rule not in _RULES:
        raise SchemaError(f"unknown rule: {rule!r}; there are {', '.join(_RULES)}")
    return _RULES[rule](old, new)


def _nullable(dtype: T.DataType) -> T.DataType:
    """The same type with NULLs allowed at every level."""
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_nullable(dtype.elementType))
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in dtype.fields])
    return dtype

