"""Event topics: rows -> (topic, key, JSON value) and back.

The five topics carry JSON maps keyed by session id; the time field name
differs per topic. ``encode_events`` writes them (null fields kept),
``decode_topics`` reads them with one declared schema, normalises the time
to ``event_time`` and flags malformed values for quarantine. The same frames
feed a Kafka sink/source where that connector is installed
(``write_kafka`` / ``read_kafka``); here they go through files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.columns import iso_instant
from basketry.schemas import CART_EVENT_SCHEMA

JSON_OPTS = {"ignoreNullFields": "false"}


def _json(*cols: Column) -> Column:
    return F.to_json(F.struct(*cols), JSON_OPTS)


def encode_events(fold: DataFrame, catalog: DataFrame, helps: DataFrame, receipts: DataFrame) -> DataFrame:
    """The rows each topic would have received.

    ``fold``: W1 rows (accepted adds carry the quantity after the add);
    ``catalog``: product names; ``helps``: the accepted
    help requests (J11); a refused one is never published; ``receipts``: T16."""
    names = catalog.select("barcode", F.col("name").alias("product_name"))
    ok = fold.where(~F.col("rejected"))
    sid = F.col("session_id").cast("string")
    added = (ok.where(F.col("kind") == "ADD").join(names, "barcode", "left")
               .select("event_id", F.lit("cart.item.added").alias("topic"), sid.alias("key"),
                       _json(sid.alias("sessionId"), F.col("barcode"), F.col("product_name").alias("productName"),
                             F.col("price"), F.col("quantity"), iso_instant("event_time").alias("timestamp"))
                       .alias("value")))
    removed = (ok.where(F.col("kind") == "REMOVE")
                 .select("event_id", F.lit("cart.item.removed").alias("topic"), sid.alias("key"),
                         _json(sid.alias("sessionId"), F.col("barcode"), iso_instant("event_time").alias("timestamp"))
                         .alias("value")))
    helps = helps.select("event_id", F.lit("help.requested").alias("topic"), "key", "value")
    rs = receipts.select("session_id", "paid_event", "completed_event")
    paid = rs.select(F.lit(None).cast("bigint").alias("event_id"), F.lit("session.paid").alias("topic"),
                     F.col("session_id").alias("key"), F.col("paid_event").alias("value"))
    done = rs.select(F.lit(None).cast("bigint").alias("event_id"), F.lit("session.completed").alias("topic"),
                     F.col("session_id").alias("key"), F.col("completed_event").alias("value"))
    return added.unionByName(removed).unionByName(helps).unionByName(paid).unionByName(done)


def decoded_time(value: str) -> Column:
    """The time inside a JSON value, from timestamp / paidAt / completedAt."""
    t = F.coalesce(*[F.get_json_object(value, f"$.{f}") for f in ("timestamp", "paidAt", "completedAt")])
    return F.regexp_replace(t, "Z$", "").try_cast("timestamp_ntz")


def decode_topics(feed: DataFrame) -> DataFrame:
    """Typed columns from each JSON value, one ``event_time`` from
    timestamp / paidAt / completedAt, and ``malformed`` for values that are not
    JSON, hold a field of another type, or have no readable time. Their typed
    columns are null; the raw ``value`` stays, so a quarantine can keep it."""
    bad = T.StructField("_bad", T.StringType())
    schema = T.StructType([*CART_EVENT_SCHEMA.fields, bad])
    j = F.from_json(F.col("value"), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    d = feed.select("topic", "key", "value", j.alias("j"))
    t = F.coalesce("j.timestamp", "j.paidAt", "j.completedAt")
    d = d.withColumn("_at", F.regexp_replace(t, "Z$", "").try_cast("timestamp_ntz"))
    good = F.col("j").isNotNull() & F.col("j._bad").isNull() & F.col("_at").isNotNull()
    d = d.withColumn("malformed", ~good)
    pick = lambda c: F.when(~F.col("malformed"), c)
    return d.select(
        "topic", "key",
        pick(F.col("j.sessionId")).alias("session_id"), pick(F.col("j.barcode")).alias("barcode"),
        pick(F.col("j.productName")).alias("product_name"), pick(F.col("j.price")).alias("price"),
        pick(F.col("j.quantity")).alias("quantity"), pick(F.col("j.aisleNumber")).alias("aisle_number"),
        pick(F.col("j.userId")).alias("user_id"), pick(F.col("_at")).alias("event_time"), "malformed", "value")


def write_kafka(feed: DataFrame, servers: str, checkpoint: str):
    """Stream sink option for a cluster with the Kafka connector installed."""
    return (feed.selectExpr("topic", "key", "value").writeStream.format("kafka")
                .option("kafka.bootstrap.servers", servers).option("checkpointLocation", checkpoint))


def read_kafka(spark, servers: str, topics: list[str]) -> DataFrame:
    """Stream source option: (topic, key, value) strings from Kafka."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
                 .option("subscribe", ",".join(topics)).load()
                 .selectExpr("topic", "CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value"))
