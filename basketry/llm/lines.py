"""Line dedup by overlapping three-line windows.

Every three consecutive lines of a text are a window, known by a 128-bit hash.
Windows that occur more than once are found globally; all occurrences but the
first (by doc_id, then row, then place) are later ones, and the lines they cover
are merged and removed. Only DataFrame functions: hashes are counted with partial
aggregation, and only repeated windows are joined back (two exchanged sides,
so that a hot window is split by the skew join).

Defined results: a null text counts as empty; a text has one line more than
line feeds and is never dropped, though all its lines may go (an empty text is
left); texts of fewer lines than a window stay; rows that share a doc_id are
documents of their own, in the order stored (so are rows without one, which come
after all others); other columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm import common


def line_dedup(docs: DataFrame, window: int = 3) -> DataFrame:
    """One row per document: doc_id, text (what is left), n_lines, n_removed."""
    own = common.parked(docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
                        .withColumn("row_id", F.monotonically_increasing_id()))
    # rows in order as one value, null ids last: the first occurrence is a minimum
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row_id", "at")

    def hashed(at: Column) -> Column:
        near = [F.get("lines", at + i) for i in range(window)]
        return F.struct(at.alias("at"), F.xxhash64(*near).alias("h1"), F.xxhash64(F.lit("second"), *near[::-1]).alias("h2"))

    windows = common.stored(
        own.select("doc_id", "row_id", F.split("text", "\n").alias("lines")).where(F.size("lines") >= window)
        .select("doc_id", "row_id", F.explode(F.transform(F.sequence(F.lit(0), F.size("lines") - window), hashed)).alias("w"))
        .select("doc_id", "row_id", "w.at", "w.h1", "w.h2"))
    repeated = common.stored(windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    later = windows.join(repeated, ["h1", "h2"]).where(F.struct("row_id", "at") != F.struct("first.row_id", "first.at"))
    covered = (later.select("row_id", F.explode(F.sequence("at", F.col("at") + F.lit(window - 1))).alias("line"))
               .groupBy("row_id").agg(F.collect_set("line").alias("covered")))
    lines = F.split("text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("covered"))
    return (own.join(covered, "row_id", "left")
            .select("doc_id",
                    F.when(F.col("covered").isNull(), F.col("text")).otherwise(
                        F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")).alias("text"),
                    F.size(lines).cast("long").alias("n_lines"),
                    F.greatest(F.size("covered"), F.lit(0)).cast("long").alias("n_removed")))
