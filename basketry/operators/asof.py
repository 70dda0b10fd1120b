"""As-of lookup: which intervals of a key hold a given time.

Times are cut into granules. An interval is covered by the canonical nodes of
the binary tree over granules (at most two a level, so O(log) of its length),
a time lies in one node of each level. Equal (key, level, node) meet in an
equi-join, and the exact bounds are tested on the few pairs that meet: every
holding pair meets in exactly one node. Neither a long interval nor a key with
many of them is expanded over time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import epoch_micros

HOUR_US = 3_600_000_000


def granule(ts: str, granule_us: int) -> Column:
    return F.floor(epoch_micros(ts) / F.lit(granule_us))


def holding(requests: DataFrame, intervals: DataFrame, keys: Sequence[str], at: str, since: str, until: str,
            granule_us: int = HOUR_US) -> DataFrame:
    """Requests joined with the intervals of their keys for which since <= at < until.

    A null ``until`` stands for ever; rows with a null ``since`` or ``at`` meet
    nothing. The number of levels follows from the span of the times (one
    aggregate over both sides); columns besides the keys must differ.
    """
    lo, hi = (requests.agg(F.min(granule(at, granule_us)).alias("lo"), F.max(granule(at, granule_us)).alias("hi"))
              .first())
    if lo is None:
        return requests.join(intervals, [*keys]).where("false")  # nothing is asked
    span = hi - lo + 1
    levels = max(1, int(span - 1).bit_length() + 1)

    def clamp(c: Column) -> Column:
        return F.greatest(F.lit(0), F.least(c - F.lit(lo), F.lit(span - 1))).cast("bigint")

    # the granules of an interval, within those that are asked for
    held = intervals.where(F.col(since).isNotNull() & (F.col(until).isNull() | (F.col(since) < F.col(until))))
    held = held.where((granule(since, granule_us) <= hi) & (F.col(until).isNull() | (granule(until, granule_us) >= lo)))
    held = held.withColumns({"_a": clamp(granule(since, granule_us)),
                             "_z": F.when(F.col(until).isNull(), F.lit(span - 1).cast("bigint")).otherwise(clamp(granule(until, granule_us)))})
    top = levels - 1

    def node(level: Column, place: Column) -> Column:
        """One number for a node: the root is 1, those of a level follow each other."""
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.lit(top) - level).cast("int")) + place

    # a node of a level holds 2^level granules, so an interval has none above the log of its length
    length = F.col("_z") - F.col("_a") + 1
    highest = F.lit(0)
    for level in range(1, levels):
        highest = highest + F.when(length >= F.lit(1 << level), 1).otherwise(0)
    held = held.withColumn("_level", F.explode(F.sequence(F.lit(0), highest)))
    level = F.col("_level")
    size = F.call_function("shiftleft", F.lit(1).cast("bigint"), level)
    held = held.withColumns({"_a": F.call_function("shiftright", F.col("_a") + size - 1, level),
                             "_z": F.call_function("shiftright", F.col("_z") + 1, level) - 1})
    a, z, at_top = F.col("_a"), F.col("_z"), level == top
    left = F.when((a <= z) & (at_top | (a % 2 == 1)), node(level, a))
    right = F.when((a < z) & (at_top | (z % 2 == 0)) | (a == z) & ~at_top & (z % 2 == 0), node(level, z))
    held = held.withColumn("_node", F.explode(F.array(left, right))).where("_node is not null").drop("_a", "_z", "_level")
    place = clamp(granule(at, granule_us))
    asked = requests.where(F.col(at).isNotNull()).withColumn("_node", F.explode(F.array(
        *[node(F.lit(k), F.call_function("shiftright", place, F.lit(k))) for k in range(levels)])))
    met = asked.join(held, [*keys, "_node"])
    return met.where((F.col(since) <= F.col(at)) & (F.col(until).isNull() | (F.col(at) < F.col(until)))).drop("_node")
