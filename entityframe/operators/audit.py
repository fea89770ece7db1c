"""Audit stamps on the columns of a frame."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any, Callable

from pyspark.sql import Column, DataFrame, functions as F

from entityframe import fixed_values as fv
from entityframe.errors import SchemaError
from entityframe.functions.convert import is_missing
from entityframe.schema import column, field_types


def _utc_now() -> datetime:
    return datetime.now(timezone.utc)


@dataclass(frozen=True)
class AuditPolicy:
    """Column names of the six audit stamps and when each is set.

    Modes: "missing" fills empty cells, "always" overwrites, "never" leaves alone.
    `now` is called once per frame, on the driver.
    """

    created: str | None = None
    created_at: str | None = None
    modified: str | None = None
    modified_at: str | None = None
    updated_at: str | None = None
    imported_at: str | None = None
    now: Callable[[], Any] = _utc_now
    set_created: str = "missing"
    set_created_at: str = "missing"
    set_modified: str = "always"
    set_modified_at: str = "always"
    set_updated_at: str = "always"
    set_imported_at: str = "missing"

    def __post_init__(self) -> None:
        for _, mode in self.stamps():
            if mode not in fv.STAMP_MODES:
                raise SchemaError(f"unknown audit mode: {mode!r}")

    def stamps(self) -> list[tuple[str, str]]:
        """(column, mode) of every stamp in use."""
        slots = ("created", "created_at", "modified", "modified_at", "updated_at", "imported_at")
        used = [(getattr(self, slot), getattr(self, f"set_{slot}")) for slot in slots]
        return [(name, mode) for name, mode in used if name]

    def apply(self, df: DataFrame) -> DataFrame:
        stamps = [(name, mode) for name, mode in self.stamps() if mode != "never"]
        if not stamps:
            return df
        now = self.now()
        stamp = now if isinstance(now, Column) else F.lit(now)
        fields = field_types(df)
        made = {}
        for name, mode in stamps:
            if mode == "missing" and name in fields:
                empty = is_missing(column(name), fields[name])
                made[name] = F.when(empty, stamp).otherwise(column(name))
            else:
                made[name] = stamp
        return df.withColumns(made)
