"""Write reports: one result row per input row, and totals from one aggregate."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F

from entityframe import fixed_values as fv
from entityframe.errors import WriteFailedError

_NOTHING = "conflict detected"


def should_write(action: Column, error: Column) -> Column:
    """A planned write.  Inserts count as writes like every other mode."""
    return error.isNull() & action.isin(*fv.WRITE_ACTIONS)


def result_columns(
    action: Column,
    error: Column,
    reason: Column,
    *,
    dry_run: bool,
    planned: Column,
) -> list[Column]:
    """The columns of a result row."""
    skipped = F.coalesce(action == fv.SKIP_ACTION, F.lit(False))
    ok = error.isNull()
    return [
        F.col("row_index"),
        F.col(fv.KEY),
        action.alias("action"),
        skipped.alias("skipped"),
        F.lit(dry_run).alias("dry_run"),
        reason.alias("reason"),
        error.alias("error"),
        F.lit(False).alias("conflict_detected"),
        planned.alias("planned_write"),
        ok.alias("ok"),
        (
            ok
            & F.lit(not dry_run)
            & ~skipped
            & F.coalesce(action.isin(*fv.WRITE_ACTIONS), F.lit(False))
        ).alias("wrote"),
    ]


@dataclass(frozen=True)
class ReportTotals:
    rows: int
    succeeded: int
    failed: int
    skipped: int
    wrote: int
    planned_writes: int

    @property
    def would_write(self) -> int:
        return self.planned_writes


class WriteReport:
    """Result rows of one write; `planned_write` marks rows a plan wanted to write."""

    def __init__(
        self, results: DataFrame, *, dry_run: bool = False, read_only: bool = False
    ) -> None:
        self.results = results
        self.dry_run = dry_run
        self.read_only = read_only

    def totals_frame(self) -> DataFrame:
        """Totals as a one-row DataFrame, from a single aggregate."""
        return self.results.agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if("ok").alias("succeeded"),
            F.count_if(~F.col("ok")).alias("failed"),
            F.count_if("skipped").alias("skipped"),
            F.count_if("wrote").alias("wrote"),
            F.count_if("planned_write").alias("planned_writes"),
        )

    @cached_property
    def totals(self) -> ReportTotals:
        row = self.totals_frame().first()
        return ReportTotals(**row.asDict())

    @property
    def succeeded(self) -> int:
        return self.totals.succeeded

    @property
    def failed(self) -> int:
        return self.totals.failed

    @property
    def skipped(self) -> int:
        return self.totals.skipped

    @property
    def wrote(self) -> int:
        return self.totals.wrote

    @property
    def planned_writes(self) -> int:
        return self.totals.planned_writes

    @property
    def would_write(self) -> int:
        return self.totals.planned_writes

    def failures(self) -> DataFrame:
        return self.results.filter(~F.col("ok"))

    def extend(self, other: WriteReport) -> WriteReport:
        """Report over the rows of both."""
        return WriteReport(
            self.results.unionByName(other.results),
            dry_run=self.dry_run,
            read_only=self.read_only,
        )

    def raise_for_errors(self) -> None:
        failed = self.failed
        if failed:
            shown = [r["error"] or _NOTHING for r in self.failures().limit(3).collect()]
            raise WriteFailedError(f"{failed} write(s) failed: {'; '.join(shown)}")

