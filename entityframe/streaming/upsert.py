"""Bulk load of a kind from a stream of files, chunk by chunk."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from entityframe.api import write_entities
from entityframe.plans.write_plan import ROW_INDEX
from entityframe.schema import Schema, column
from entityframe.sources.staging import release, stage, staged_count
from entityframe.sources.store import EntityStore

_ROW = "__row__"
REJECTED = "batch long, row string, error string"


def start_upsert(
    stream: DataFrame,
    store: EntityStore,
    schema: Schema,
    *,
    checkpoint: str,
    latest_by: str | None = None,
    rejected: str | None = None,
    **options,
) -> StreamingQuery:
    """Write every micro-batch of a stream, then stop when the input is used up.

    `checkpoint` is a folder of its own in shared storage; it is also the stream's name in the
    table.  The number of a batch is part of the commit that holds it, so a batch that is
    replayed after a failure is left out if it had been committed.

    With `latest_by`, a key may occur several times in a batch and the row with the greatest
    value of that column is written.  If the column is a property, a stored entity with a greater
    value stays, so batches may come in any order (files come by their times, not their names);
    otherwise a later batch replaces what an earlier one stored.  With `rejected`, rows that can't be written are appended
    to a Parquet table there as (batch, row as JSON, error) and the stream goes on; without it,
    the first such row ends the stream.  They are written before the batch is committed, and a
    replayed batch replaces them, so none is lost or counted twice.
    """
    table = store.table(schema.kind)

    def load(batch: DataFrame, number: int) -> None:
        newest = table.snapshot()
        if newest is not None and number <= newest.streams.get(checkpoint, -1):
            return
        chosen = {**options, "batch": (checkpoint, number), "latest_by": latest_by}
        if rejected is None:
            write_entities(store, batch, schema, **chosen).raise_for_errors()
            return
        before = staged_count(store.spark)
        # Written once, so that a row has the same number in the report and in the batch.
        rows = stage(batch.withColumn(_ROW, F.monotonically_increasing_id()), "batch")
        text = F.to_json(F.struct(*[column(c) for c in batch.columns]))

        def reject(failed: DataFrame) -> None:
            bad = rows.join(failed.withColumnRenamed(ROW_INDEX, _ROW), _ROW).select(text.alias("row"), "error")
            bad.write.mode("overwrite").parquet(f"{rejected}/batch={number}")

        write_entities(store, rows, schema, row_index=_ROW, reject=reject, **chosen)
        release(store.spark, before)

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_rejected(store: EntityStore, path: str) -> DataFrame:
    """The rows that a stream has rejected so far: batch, row (JSON) and error."""
    return store.spark.read.schema(REJECTED).parquet(path)
