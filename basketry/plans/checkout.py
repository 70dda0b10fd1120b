"""The add/remove/clear request path as one plan.

Request -> session check (J2) -> product lookup (J1) -> fold (W1/W2) ->
snapshot after each change (S6). A command refused by the session check or
the product lookup never touches the cart, as in the service; a remove of a
line at 0 is refused as ``cart_item_not_found``; an add takes the catalog
price. Clears need no session check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators import cart_history
from basketry.operators.sessions import session_access_check


def cart_commands(events: DataFrame, sessions: DataFrame, access: DataFrame) -> DataFrame:
    """Cart commands of the event log, each sent by the event's user (the
    access-log header, '' when absent) against that user's first session."""
    first = sessions.groupBy(F.col("user_id").alias("_u")).agg(F.min("session_id").alias("_s"))
    ev = events.where(F.col("kind").isin("ADD", "REMOVE", "CLEAR"))
    c = (ev.join(first, ev.session_id == first._u, "left")
           .withColumn("session_id", F.coalesce(F.col("_s"), F.lit(-1).cast("bigint"))).drop("_u", "_s")
           .join(access.select("event_id", "header_user_id"), "event_id", "left"))
    return c.select("event_id", "event_time", "session_id", "barcode", "kind",
                    F.col("session_id").cast("string").alias("session_text"),
                    F.coalesce(F.col("header_user_id").cast("string"), F.lit("")).alias("user_text"))


def cart_request_flow(commands: DataFrame, sessions: DataFrame, catalog: DataFrame,
                      bucket_us: int = 3_600_000_000) -> DataFrame:
    """One row per command: ``outcome`` (ok / invalid_session /
    product_not_found / cart_item_not_found) and, for accepted changes, the
    event type and the cart's item count and total after it."""
    chk = session_access_check(commands, sessions).select("event_id", "valid")
    cat = catalog.select("barcode", F.col("name").alias("_name"), F.col("price").alias("_cat_price"))
    c = commands.join(chk, "event_id").join(cat, "barcode", "left")
    pre = (F.when((F.col("kind") != "CLEAR") & ~F.col("valid"), "invalid_session")
           .when((F.col("kind") == "ADD") & F.col("_name").isNull(), "product_not_found"))
    c = c.withColumn("_pre", pre)
    refused = c.where(F.col("_pre").isNotNull()).select(
        "event_id", "session_id", "kind", F.col("_pre").alias("outcome"),
        F.lit(None).cast("string").alias("event_type"), F.lit(None).cast("bigint").alias("item_count"),
        F.lit(None).cast("decimal(38,4)").alias("total"))
    passing = (c.where(F.col("_pre").isNull())
                .select("event_id", "event_time", "session_id", "barcode", "kind",
                        F.col("_cat_price").alias("price")))
    rows = cart_history.history(passing, bucket_us, with_clears=True)
    ok = ~F.col("rejected")
    done = rows.select(
        "event_id", "session_id", "kind", F.when(ok, "ok").otherwise("cart_item_not_found").alias("outcome"),
        F.when(ok, F.when(F.col("kind") == "ADD", "ITEM_ADDED").when(F.col("kind") == "REMOVE", "ITEM_REMOVED").otherwise("CLEARED")).alias("event_type"),
        F.when(ok, F.col("item_count")).alias("item_count"), F.when(ok, F.col("total")).alias("total"))
    return refused.unionByName(done)
