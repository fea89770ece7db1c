"""Small text and time helpers used when rows are prepared for keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from entityframe import fixed_values as fv
from entityframe.functions.convert import strip


def slug(text: Column) -> Column:
    """Lower case, every run of other characters than a-z0-9 becomes one dash."""
    dashed = F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-")
    return F.btrim(dashed, F.lit("-"))


def station_key(station_id: Column, station_name: Column, prefix: str = "station-") -> Column:
    """The trimmed id where there is one, otherwise prefix plus slug of the name."""
    given = strip(station_id.cast("string"))
    return F.coalesce(
        F.when(given != "", given), F.concat(F.lit(prefix), slug(station_name))
    )


def whole_seconds(start: Column, end: Column) -> Column:
    """Seconds from start to end, the fraction cut off."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return F.call_function("div", micros, F.lit(1_000_000).cast("bigint"))


def lenient_bool(text: Column) -> Column:
    """NULL for blank text, true for the known words, false for anything else."""
    word = F.lower(strip(text.cast("string")))
    return F.when(text.isNotNull() & (text.cast("string") != ""), word.isin(*fv.TRUE_WORDS))
