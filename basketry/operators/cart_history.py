"""The add/remove/clear fold of carts as one scan, and what follows from it.

Rows are cut into (session, time bucket) chunks: the one big exchange. Inside a
chunk, windows give for each line the running sum of its steps and the lowest
sum so far; both together are the chunk's transition of the line's quantity,
q -> sum + max(q, -lowest), and a clear makes it a constant. Transitions of the
chunks are composed on a table of one row per (session, bucket, line), which
tells each chunk the quantities, lives, prices and totals it starts with. A hot
session spreads over as many tasks as it has buckets.

The chunked rows are stored once; everything else reads them.

Nulls: a null session or barcode is a key of its own, a row without a time
comes first in its session, a null price leaves the totals as they are. Rows of
other kinds (HELP, null) take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.operators.scan import HOUR_US, join_back, materialize, time_bucket
from basketry.schemas import CART_TTL

LINE = ["session_id", "_b", "barcode", "_cleared"]
BEFORE = (Window.unboundedPreceding, -1)
UPTO = (Window.unboundedPreceding, Window.currentRow)


def _count(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0)


def _chunks(events: DataFrame, bucket_us: int) -> DataFrame:
    """Cart rows with their bucket, the clears of the chunk so far, and the running and lowest sums of the line's steps."""
    ev = events.where(F.col("kind").isin("ADD", "REMOVE", "CLEAR")).select("event_id", "event_time", "session_id", "barcode", "kind", "price")
    clear = F.col("kind") == "CLEAR"
    chunk = Window.partitionBy("session_id", "_b").orderBy("event_time", "event_id").rowsBetween(*UPTO)
    line = Window.partitionBy(*LINE, clear).orderBy("event_time", "event_id")
    d = ev.withColumn("_b", time_bucket("event_time", bucket_us)).withColumn("_cleared", F.sum(_count(clear)).over(chunk))
    d = d.withColumn("_step", F.when(clear, 0).when(F.col("kind") == "ADD", 1).otherwise(-1))
    d = d.withColumn("_sum", F.sum("_step").over(line.rowsBetween(*UPTO)))
    d = d.withColumn("_low", F.least(F.lit(0), F.coalesce(F.min("_sum").over(line.rowsBetween(*BEFORE)), F.lit(0))))
    return materialize(d)


def _epochs(chunks: DataFrame) -> DataFrame:
    """(session_id, _b, _epochs): clears of the session before the chunk."""
    w = Window.partitionBy("session_id").orderBy("_b").rowsBetween(*BEFORE)
    return (chunks.groupBy("session_id", "_b").agg(F.sum(_count(F.col("kind") == "CLEAR")).alias("_n"))
            .select("session_id", "_b", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_epochs")))


def _lines(chunks: DataFrame, epochs: DataFrame) -> DataFrame:
    """Adds and removes with epoch, quantity after, rejected, and whether a life starts."""
    rows = chunks.where("kind <> 'CLEAR'")
    parts = join_back(rows.groupBy(*LINE).agg(F.sum("_step").alias("_total"), F.min("_sum").alias("_lowest")), epochs, ["session_id", "_b"])
    parts = parts.withColumn("epoch", (F.col("_epochs") + F.col("_cleared")).cast("bigint"))
    w = Window.partitionBy("session_id", "barcode", "epoch").orderBy("_b").rowsBetween(*BEFORE)
    parts = parts.withColumn("_at", F.coalesce(F.sum("_total").over(w), F.lit(0)))
    parts = parts.withColumn("_q0", F.col("_at") + F.greatest(F.lit(0), -F.coalesce(F.min(F.col("_at") + F.col("_lowest")).over(w), F.lit(0))))
    d = join_back(rows, parts.select(*LINE, "epoch", "_q0"), LINE)
    add = F.col("kind") == "ADD"
    d = d.withColumn("_was", F.col("_sum") - F.col("_step") + F.greatest("_q0", -F.col("_low")))
    return d.withColumns({"quantity": F.greatest(F.lit(0), F.col("_was") + F.col("_step")).cast("int"),
                          "rejected": ~add & (F.col("_was") == 0), "_start": add & (F.col("_was") == 0)})


def quantities(events: DataFrame, bucket_us: int = HOUR_US) -> DataFrame:
    """One row per add or remove: epoch, quantity after it, rejected (a remove at 0)."""
    chunks = _chunks(events, bucket_us)
    return _lines(chunks, _epochs(chunks)).select("event_id", "event_time", "session_id", "barcode", "kind", "epoch", "price", "quantity", "rejected")


def history(events: DataFrame, bucket_us: int = HOUR_US, with_clears: bool = False, with_totals: bool = True) -> DataFrame:
    """``quantities`` with ``life`` (starts of the line in its epoch so far), ``line_price``
    (the price of the life's first add) and, of the whole cart after the row, ``item_count``
    and ``total`` (unless ``with_totals`` is off). With ``with_clears``, clears come as rows
    too (null quantity, empty cart)."""
    chunks = _chunks(events, bucket_us)
    epochs = _epochs(chunks)
    d = _lines(chunks, epochs)
    line = Window.partitionBy(*LINE).orderBy("event_time", "event_id").rowsBetween(*UPTO)
    d = d.withColumns({"_starts": F.sum(_count(F.col("_start"))).over(line),
                       "_paid": F.last(F.when(F.col("_start"), F.struct("price")), ignorenulls=True).over(line),
                       "_dq": F.when(F.col("rejected"), 0).otherwise(F.col("_step"))})
    parts = d.groupBy(*LINE, "epoch").agg(
        F.sum(_count(F.col("_start"))).alias("_n"), F.max_by("_paid", "_starts").alias("_last"), F.sum("_dq").alias("_items"),
        F.sum(F.when(F.col("_paid").isNull(), F.col("_dq"))).alias("_early"), F.sum(F.col("_dq") * F.col("_paid.price")).alias("_money"))
    w = Window.partitionBy("session_id", "barcode", "epoch").orderBy("_b").rowsBetween(*BEFORE)
    parts = parts.withColumns({"_lives": F.coalesce(F.sum("_n").over(w), F.lit(0)), "_carried": F.last("_last", ignorenulls=True).over(w)})
    starts = parts.select(*LINE, "_lives", "_carried")
    if with_totals:
        worth = F.coalesce("_money", F.lit(0)) + F.coalesce(F.col("_early") * F.col("_carried.price"), F.lit(0))
        carts = parts.groupBy("session_id", "_b", "_cleared", "epoch").agg(F.sum("_items").alias("_items"), F.sum(worth).alias("_worth"))
        w = Window.partitionBy("session_id", "epoch").orderBy("_b").rowsBetween(*BEFORE)
        carts = carts.select("session_id", "_b", "_cleared", F.coalesce(F.sum("_items").over(w), F.lit(0)).alias("_items0"),
                             F.coalesce(F.sum("_worth").over(w), F.lit(0)).alias("_worth0"))
        starts = join_back(starts, carts, ["session_id", "_b", "_cleared"])
    d = join_back(d, starts, LINE)
    d = d.withColumns({"life": (F.col("_lives") + F.col("_starts")).cast("bigint"),
                       "line_price": F.coalesce("_paid", "_carried").getField("price")})
    columns = ["event_id", "event_time", "session_id", "barcode", "kind", "epoch", "price", "quantity", "rejected", "life", "line_price"]
    if with_totals:
        cart = Window.partitionBy("session_id", "_b", "_cleared").orderBy("event_time", "event_id").rowsBetween(*UPTO)
        d = d.withColumns({
            "item_count": (F.col("_items0") + F.sum("_dq").over(cart)).cast("bigint"),
            "total": (F.col("_worth0") + F.coalesce(F.sum(F.col("_dq") * F.col("line_price")).over(cart), F.lit(0))).cast("decimal(38,4)")})
        columns += ["item_count", "total"]
    out = d.select(*columns)
    if not with_clears:
        return out
    empty = [F.lit(0).cast("bigint").alias("item_count"), F.lit(0).cast("decimal(38,4)").alias("total")] if with_totals else []
    clears = join_back(chunks.where("kind = 'CLEAR'"), epochs, ["session_id", "_b"]).select(
        "event_id", "event_time", "session_id", "barcode", "kind", (F.col("_epochs") + F.col("_cleared")).cast("bigint").alias("epoch"), "price",
        F.lit(None).cast("int").alias("quantity"), F.lit(False).alias("rejected"), F.lit(None).cast("bigint").alias("life"),
        F.lit(None).cast(out.schema["line_price"].dataType).alias("line_price"), *empty)
    return out.unionByName(clears)


# --- the keyed cart map with its 24 hours ------------------------------------------

def _ttl() -> Column:
    return F.expr(f"INTERVAL {CART_TTL}")


def ttl_parts(puts: DataFrame, bucket_us: int = HOUR_US) -> DataFrame:
    """Puts per (session, epoch, bucket) with the number of their lifetime of the map.

    No gap of 24 hours fits into a bucket (at most 24 hours wide), so lifetimes
    follow from the first and last put of the buckets, never from single rows."""
    if bucket_us > 24 * HOUR_US:
        raise ValueError("buckets of at most 24 hours are needed")
    parts = (puts.groupBy("session_id", "epoch", time_bucket("event_time", bucket_us).alias("_b"))
             .agg(F.min("event_time").alias("_first"), F.max("event_time").alias("_last"), F.count(F.lit(1)).alias("_puts")))
    w = Window.partitionBy("session_id", "epoch").orderBy("_b")
    prev = F.lag("_last").over(w)
    new = _count(F.lag(F.lit(1)).over(w).isNull() | F.coalesce(F.col("_first") >= prev + _ttl(), F.col("_first").isNotNull()))
    parts = parts.withColumn("_new", new)
    return parts.withColumn("window_no", F.sum("_new").over(w.rowsBetween(*UPTO))).drop("_new")


def lifetimes(puts: DataFrame, bucket_us: int = HOUR_US) -> DataFrame:
    """One row per lifetime of a session's map: first and last put, their number, and when it expires."""
    g = (ttl_parts(puts, bucket_us).groupBy("session_id", "epoch", "window_no")
         .agg(F.min("_first").alias("first_put"), F.max("_last").alias("last_put"), F.sum("_puts").alias("puts")))
    return g.select("session_id", "epoch", "first_put", "last_put", "puts", (F.col("last_put") + _ttl()).alias("expires_at"))


def put_spans(puts: DataFrame, bucket_us: int = HOUR_US) -> DataFrame:
    """Distinct put times (session_id, _put, _end of their map) with ``_next_put``: the session's next put, or _end if that is earlier."""
    p = puts.withColumn("_b", time_bucket("_put", bucket_us))
    firsts = p.groupBy("session_id", "_b").agg(F.min("_put").alias("_first"))
    after = firsts.select("session_id", "_b", F.lead("_first").over(Window.partitionBy("session_id").orderBy("_b")).alias("_after"))
    p = p.withColumn("_next", F.lead("_put").over(Window.partitionBy("session_id", "_b").orderBy("_put")))
    p = join_back(p, after, ["session_id", "_b"])
    return p.select("session_id", "_put", F.least(F.coalesce("_next", "_after"), "_end").alias("_next_put"))


def line_states(events: DataFrame, bucket_us: int = HOUR_US) -> DataFrame:
    """What each line is from when until when: session_id, barcode, quantity, price,
    ``since``, ``until`` (the next change of the line or clear of the session; null
    while it stands) and ``expires_at``, when the map that the state was put into ends."""
    rows = history(events, bucket_us, with_clears=True, with_totals=False).withColumn("_b", time_bucket("event_time", bucket_us))
    rows = materialize(rows)
    lines = rows.where("kind <> 'CLEAR'")
    in_part = Window.partitionBy("session_id", "_b", "barcode", "epoch").orderBy("event_time", "event_id")
    lines = lines.withColumn("_next", F.lead("event_time").over(in_part))
    firsts = lines.groupBy("session_id", "_b", "barcode", "epoch").agg(F.min("event_time").alias("_first"))
    over = Window.partitionBy("session_id", "barcode", "epoch").orderBy("_b")
    after = firsts.select("session_id", "_b", "barcode", "epoch", F.lead("_first").over(over).alias("_after"))
    lines = join_back(lines, after, ["session_id", "_b", "barcode", "epoch"])
    clears = rows.where("kind = 'CLEAR'").select("session_id", (F.col("epoch") - 1).alias("epoch"), F.col("event_time").alias("_cleared_at"))
    states = join_back(lines.where("not rejected and quantity > 0"), clears, ["session_id", "epoch"], "left")
    puts = lines.where("not rejected and quantity > 0")
    parts = ttl_parts(puts, bucket_us)
    ends = (parts.withColumn("_end", F.max("_last").over(Window.partitionBy("session_id", "epoch", "window_no")) + _ttl())
            .select("session_id", "epoch", "_b", F.col("_end").alias("expires_at")))
    states = join_back(states, ends, ["session_id", "epoch", "_b"])
    return states.select("session_id", "barcode", F.col("quantity").cast("bigint").alias("quantity"), F.col("line_price").alias("price"),
                         F.col("event_time").alias("since"), F.coalesce("_next", "_after", "_cleared_at").alias("until"), "expires_at")
