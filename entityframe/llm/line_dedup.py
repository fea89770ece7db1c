"""Removal of repeated passages by overlapping windows of three lines.

Every three consecutive lines of a document are hashed.  A window that occurs more than once
in all documents is repeated; its first occurrence (smallest document id, then position)
stays.  The lines under later occurrences are merged into covered positions and removed.
Windows are made inside their row, so only hashes and positions are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from entityframe.llm.common import load, stage, text_or_empty

WINDOW = 3


def _window_hashes(lines: Column, width: int) -> Column:
    """(pos, h1, h2) for each window with a line that is not blank.  Two 64-bit hashes with
    different seeds, since one is too short for the windows of a very large corpus."""

    def window(i: Column) -> Column:
        covered = [F.get(lines, i + k) for k in range(width)]
        return F.struct(
            i.alias("pos"),
            F.xxhash64(*covered).alias("h1"),
            F.xxhash64(F.lit("second"), *covered).alias("h2"),
            (F.length(F.trim(F.concat(*covered))) > 0).alias("filled"),
        )

    starts = F.when(F.size(lines) >= width, F.sequence(F.lit(0), F.size(lines) - width)).otherwise(
        F.array().cast("array<int>")
    )
    return F.filter(F.transform(starts, window), lambda w: w["filled"])


def repeated_lines(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """doc_id, text_hash, removed: the sorted positions (from 0) to remove from each document
    that has any."""
    text = text_or_empty("text")
    # Rows that agree in doc_id and text are one document.
    keyed = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.split(text, "\n").alias("lines"))
    windows = keyed.select("doc_id", "text_hash", F.explode(_window_hashes(F.col("lines"), width)).alias("w")).select(
        "doc_id", "text_hash", "w.pos", "w.h1", "w.h2"
    )
    windows = stage(windows, "windows")
    place = F.struct("doc_id", "text_hash", "pos")
    firsts = (
        windows.groupBy("h1", "h2")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter(F.col("first") != F.col("last"))
        .select("h1", "h2", "first")
    )
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    # An occurrence that overlaps the first one of its window is part of it, not a copy.
    later = windows.join(firsts, ["h1", "h2"]).filter(~same | (F.col("pos") >= F.col("first.pos") + width))
    covered = later.select("doc_id", "text_hash", F.explode(F.sequence(F.col("pos"), F.col("pos") + (width - 1))).alias("line"))
    return covered.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("line")).alias("removed"))


def line_dedup(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """doc_id, n_lines, removed, text: each row of `docs` without its repeated passages.

    Needs doc_id and text; other columns are ignored.  Null text is empty text (one empty
    line).  Lines are compared as they are; windows of blank lines are never repeated.
    Documents of fewer lines than a window keep everything.  Rows that agree in doc_id and
    text are one document and have the same result.  An empty table gives an empty result.
    """
    text = text_or_empty("text")
    left = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("text_hash"))
    right = repeated_lines(docs, width).select(
        F.col("doc_id").alias("other_id"), F.col("text_hash").alias("other_hash"), "removed"
    )
    joined = left.join(
        right, (F.col("text_hash") == F.col("other_hash")) & F.col("doc_id").eqNullSafe(F.col("other_id")), "left"
    )
    lines = F.split("text", "\n")
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "removed")
    kept = F.transform(places, lambda i: F.get(lines, i))
    return joined.select(
        "doc_id",
        F.size(lines).alias("n_lines"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
        F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
    )


def op2_line_dedup(spark, sf):
    cleaned = line_dedup(load(spark, sf, "documents"))
    return cleaned.select("doc_id", "n_lines", F.size("removed").alias("n_removed"), "text")


OP2_SQL = """
WITH doc AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), line AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS pos FROM doc
), win AS (
  SELECT doc_id, pos, line AS a, lead(line, 1) OVER w AS b, lead(line, 2) OVER w AS c
  FROM line WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), marked AS (
  SELECT doc_id, pos,
         first_value(doc_id) OVER g AS first_doc, first_value(pos) OVER g AS first_pos
  FROM win WHERE c IS NOT NULL AND length(trim(a || b || c)) > 0
  WINDOW g AS (PARTITION BY a, b, c ORDER BY doc_id, pos)
), covered AS (
  SELECT DISTINCT doc_id, pos + k AS pos
  FROM marked, (VALUES (0), (1), (2)) AS t(k)
  WHERE doc_id <> first_doc OR pos >= first_pos + 3
)
SELECT l.doc_id, count(*)::INTEGER AS n_lines, count(c.pos)::INTEGER AS n_removed,
       coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (c.pos IS NULL), '') AS text
FROM line l LEFT JOIN covered c ON l.doc_id = c.doc_id AND l.pos = c.pos
GROUP BY l.doc_id
"""
