"""Skew-safe running aggregates over an ordered key.

A plain ``Window.partitionBy(key)`` puts every row of a key in one task; if
one session holds a third of the data, that task holds a third of the data.
``prefix_scan`` computes the same running sum (and running minimum) in two
levels instead:

1. rows are cut into (key, time bucket) chunks; a window per chunk gives the
   local running values — the big shuffle is on (key, bucket), so a hot key
   spreads over as many tasks as it has buckets;
2. one summary row per chunk (sum, lowest local prefix) is scanned per key —
   a window over the small summary table, bounded by buckets per key;
3. the chunk offsets are joined back on (key, bucket) and added.

The result equals the one-level window exactly (checked in tests). Nulls in a
key are a key of their own, rows without a time come first (as null sorts
first), so no row is lost.

Both the per-chunk window and the per-chunk summary read the bucketed input,
so it is checkpointed first (eagerly, into the shared folder named by
``spark.checkpoint.dir``): nested scans — W1 feeds W2 feeds S6 — then cost
one pass per level instead of recomputing the whole upstream in both
branches at every level, and the lineage a lost executor would replay stays
one level deep.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.columns import epoch_micros
from basketry.session import checkpoint_root

HOUR_US = 3_600_000_000


def materialize(d: DataFrame) -> DataFrame:
    """Computed once into the shared checkpoint folder; several branches then read it."""
    checkpoint_root(d.sparkSession)
    return d.checkpoint(eager=True)


#: Bucket of rows without a time: before all others, as nulls sort first.
NO_TIME = -(1 << 62)


def time_bucket(ts: str, bucket_us: int) -> Column:
    return F.coalesce(F.floor(epoch_micros(ts) / F.lit(bucket_us)), F.lit(NO_TIME))


def join_back(rows: DataFrame, summary: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys meet null keys, so no row of a null session, line or time is lost."""
    s = summary.select(*[F.col(c).alias("_on_" + c) if c in on else F.col(c) for c in summary.columns])
    cond = F.lit(True)
    for c in on:
        cond = cond & F.col(c).eqNullSafe(F.col("_on_" + c))
    return rows.join(s, cond, how).drop(*["_on_" + c for c in on])


def prefix_scan(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: str, value: Column | str,
                out: str, bucket_us: int = HOUR_US, with_min: bool = False) -> DataFrame:
    """Add ``out`` = running sum of ``value`` per ``keys`` ordered by (ts, tiebreak).

    With ``with_min``, also ``out + '_min'`` = min(0, lowest running sum so far,
    inclusive) and ``out + '_min_before'`` = the same, exclusive of the row.
    """
    keys = list(keys)
    v = F.col(value) if isinstance(value, str) else value
    b = "_bkt_" + out
    d = materialize(df.withColumn(b, time_bucket(ts, bucket_us)).withColumn("_v_" + out, v))
    order = [F.col(ts), F.col(tiebreak)]
    w_local = Window.partitionBy(*keys, b).orderBy(*order)
    run = w_local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("_loc_" + out, F.sum("_v_" + out).over(run))
    if with_min:
        before = w_local.rowsBetween(Window.unboundedPreceding, -1)
        d = (d.withColumn("_lmin_" + out, F.min("_loc_" + out).over(run))
              .withColumn("_lminb_" + out, F.min("_loc_" + out).over(before)))

    aggs = [F.sum("_v_" + out).alias("_tot")]
    if with_min:
        aggs.append(F.min("_loc_" + out).alias("_bmin"))
    summary = d.groupBy(*keys, b).agg(*aggs)
    w_b = Window.partitionBy(*keys).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn("_off", F.coalesce(F.sum("_tot").over(w_b), F.lit(0)))
    if with_min:
        summary = summary.withColumn("_cmin", F.min(F.col("_off") + F.col("_bmin")).over(w_b))
    summary = summary.drop("_tot", "_bmin")

    j = join_back(d, summary, [*keys, b])
    j = j.withColumn(out, F.col("_off") + F.col("_loc_" + out))
    if with_min:
        j = (j.withColumn(out + "_min", F.least(F.lit(0), F.col("_cmin"), F.col("_off") + F.col("_lmin_" + out)))
              .withColumn(out + "_min_before",
                          F.least(F.lit(0), F.col("_cmin"), F.col("_off") + F.col("_lminb_" + out))))
    drop = [b, "_v_" + out, "_loc_" + out, "_off"]
    if with_min:
        drop += ["_lmin_" + out, "_lminb_" + out, "_cmin"]
    return j.drop(*drop)


def prev_value(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: str, cols: Sequence[str],
               prefix: str = "prev_", bucket_us: int = HOUR_US) -> DataFrame:
    """``lag`` of ``cols`` per key ordered by (ts, tiebreak), in two levels like
    ``prefix_scan``: a local lag per (key, bucket), and for the first row of a
    bucket the last row of the previous non-empty bucket (from a small
    per-bucket summary)."""
    keys = list(keys)
    b = "_pb"
    d = materialize(df.withColumn(b, time_bucket(ts, bucket_us)))
    w = Window.partitionBy(*keys, b).orderBy(F.col(ts), F.col(tiebreak))
    d = d.withColumn("_pfirst", F.lag(F.lit(1)).over(w).isNull())
    for c in cols:
        d = d.withColumn("_plag_" + c, F.lag(c).over(w))
    last = d.groupBy(*keys, b).agg(F.max(F.struct(F.col(ts).alias("_o_ts"), F.col(tiebreak).alias("_o_tb"),
                                                  *[F.col(c).alias(c) for c in cols])).alias("_plast"))
    wb = Window.partitionBy(*keys).orderBy(b)
    carry = last.withColumn("_pcarry", F.lag("_plast").over(wb)).drop("_plast")
    j = join_back(d, carry, [*keys, b])
    for c in cols:
        j = j.withColumn(prefix + c, F.when(F.col("_pfirst"), F.col("_pcarry." + c)).otherwise(F.col("_plag_" + c)))
    return j.drop(b, "_pfirst", "_pcarry", *["_plag_" + c for c in cols])


# (time, id) as one DECIMAL(38,0): time_us * 1e20 + (id + 2^63). It orders
# exactly like the pair, and unlike a struct its min/max run in a hash
# aggregate (decimals are updatable in place), not a sort aggregate.
_E20 = "CAST('100000000000000000000' AS DECIMAL(38,0))"
_S63 = "CAST('9223372036854775808' AS DECIMAL(38,0))"


def order_key(ts: str, tiebreak: str) -> Column:
    return (epoch_micros(ts).cast("decimal(38,0)") * F.expr(_E20)
            + (F.col(tiebreak).cast("decimal(38,0)") + F.expr(_S63))).cast("decimal(38,0)")


def key_time(key: Column) -> Column:
    """The timestamp part of an ``order_key``."""
    us = F.floor(key / F.expr(_E20)).cast("bigint")
    return F.timestamp_add("MICROSECOND", us, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def key_id(key: Column) -> Column:
    """The tie-break part of an ``order_key``."""
    return (key - F.floor(key / F.expr(_E20)) * F.expr(_E20) - F.expr(_S63)).cast("bigint")
