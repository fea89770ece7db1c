"""Sparse, keyed entity data as Spark DataFrames."""

from entityframe.accessor import KindAccessor, kind
from entityframe.api import (
    delete_entities,
    infer_schema_of_kind,
    iter_entities,
    patch_entities,
    plan_entities,
    read_entities,
    read_page,
    run_delete_plan,
    scan,
    write_entities,
)
from entityframe.errors import (
    DerivedFrameWriteError,
    EntityFrameError,
    KeyValidationError,
    QueryValidationError,
    SchemaError,
    WriteConflictError,
    WriteFailedError,
)
from entityframe.functions.keys import KEY_TYPE, EntityKey, KeyPart, KeySpec, key_policy
from entityframe.functions.logical import (
    GEO_TYPE,
    ArrayType,
    BlobType,
    BoolType,
    EmbeddedEntityType,
    Float64Type,
    GeoPointType,
    Int64Type,
    KeyType,
    LogicalType,
    ObjectType,
    StringType,
    TimestampType,
)
from entityframe.model import EntityModel, entity_model
from entityframe.operators.aggregate import aggregate, busiest, summarize
from entityframe.operators.audit import AuditPolicy
from entityframe.operators.combine import concat
from entityframe.operators.dedup import plan_duplicate_cleanup, surplus, survivors
from entityframe.operators.delta import add_deltas, combine_entities, merge_deltas
from entityframe.operators.inference import (
    InferredField,
    SchemaInferenceReport,
    infer_schema_from_frame,
    infer_schema_from_records,
)
from entityframe.operators.linked import descendants, nearest_ancestors
from entityframe.operators.paging import Page, iter_chunks, with_chunks
from entityframe.plans.query import PagePosition, QuerySpec
from entityframe.plans.reports import ReportTotals, WriteReport
from entityframe.plans.write_plan import WritePlan
from entityframe.schema import Field, PerRow, Schema, per_row
from entityframe.sources.csvfiles import read_csv, write_csv
from entityframe.sources.staging import release, staged_count
from entityframe.sources.store import EntityStore, choose_ranges
from entityframe.streaming.upsert import read_rejected, start_upsert

__version__ = "0.1.0"

__all__ = sorted(
    name for name in dir() if not name.startswith("_") and name not in ("annotations",)
)
