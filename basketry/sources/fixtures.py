"""Made-up damage, secrets and logs that the registered queries run on: derived
from the driver's tables, never used by an operator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import b64url, epoch_micros, hmac_b64, qr_sign

# Signing secrets of the fixtures alone; a deployment passes its own.
QR_SECRET = "basket of test pears"
JWT_SECRET = "sixty-four or more bytes are not needed to sign the tokens of a test"


def stored_qr_tokens(qr: DataFrame, secret: str = QR_SECRET) -> DataFrame:
    """The QR table with the signature it was stored with: over the payload, or
    over altered text when ``tampered``."""
    signed = F.when(F.col("tampered"), F.concat(F.col("payload"), F.lit("#"))).otherwise(F.col("payload"))
    return qr.withColumn("vault_signature", qr_sign(signed, secret))


def bearer_headers(access: DataFrame, users: DataFrame, secret: str = JWT_SECRET) -> DataFrame:
    """Authorization headers for the access log, as the auth service would have
    issued them (HS512 JWT with sub/email/role, 15 min life): some requests
    carry none, a wrong scheme or a forged signature (derived from event ids)."""
    u = users.select(F.col("id").alias("header_user_id"), "email", "role")
    a = access.join(u, "header_user_id", "left")
    iat = F.floor(epoch_micros("event_time") / 1_000_000).cast("bigint")
    eid = F.col("event_id")
    iat = F.when(eid % 11 == 0, iat - 3600).otherwise(iat)
    alg = F.when(eid % 31 == 0, "none").when(eid % 37 == 0, "HS256").otherwise("HS512")
    head = b64url(F.base64(F.concat(F.lit('{"alg":"'), alg, F.lit('"}')).cast("binary")))
    claims = F.to_json(F.struct(F.col("header_user_id").cast("string").alias("sub"), F.col("email"),
                                F.col("role"), iat.alias("iat"), (iat + 900).alias("exp")))
    body = b64url(F.regexp_replace(F.base64(claims.cast("binary")), r"[\r\n]", ""))
    signing_input = F.concat(head, F.lit("."), body)
    sig = b64url(F.when(eid % 37 == 0, hmac_b64(signing_input, secret, 256)).otherwise(hmac_b64(signing_input, secret, 512)))
    sig = F.when(eid % 23 == 0, F.reverse(sig)).otherwise(sig)
    jwt = F.concat(signing_input, F.lit("."), sig)
    header = (F.when(F.col("header_user_id").isNull(), F.lit(None).cast("string"))
              .when(eid % 29 == 0, F.concat(F.lit("Basic "), jwt))
              .otherwise(F.concat(F.lit("Bearer "), jwt)))
    return a.select("event_id", "event_time", "path", header.alias("authorization"))


def price_texts(part: DataFrame) -> DataFrame:
    """Prices as a product service would send them: plain, padded, non-numeric, blank."""
    k = F.col("p_partkey")
    plain = F.col("p_retailprice").cast("decimal(19,2)").cast("string")
    text = (F.when(k % 4 == 0, plain).when(k % 4 == 1, F.concat(F.lit(" "), plain, F.lit(" ")))
            .when(k % 4 == 2, F.lit("n/a")).otherwise(F.lit("")))
    return part.select(k.alias("p_partkey"), text.alias("price_text"))


def corrupt_some(feed: DataFrame, every: int = 50) -> DataFrame:
    """Deliveries cut in half, with a quantity that is no number or a time that
    is none (every ``every``-th cart event each), for the quarantine."""
    cut = F.substring(F.col("value"), 1, (F.length("value") / 2).cast("int"))
    at = lambda k: F.coalesce(F.col("event_id") % every == k, F.lit(False))
    return feed.withColumn("value", F.when(at(0), cut)
                           .when(at(1), F.regexp_replace("value", '"quantity":[0-9]+', '"quantity":"x"'))
                           .when(at(2), F.regexp_replace("value", '"timestamp":"[^"]*"', '"timestamp":"nope"'))
                           .otherwise(F.col("value")))


def redeliver(feed: DataFrame, every: int = 10) -> DataFrame:
    """At-least-once delivery: some messages arrive twice (sent inside the DB
    transaction, no outbox, no event id)."""
    again = feed.where(F.coalesce(F.col("event_id") % every == 3, F.lit(False)))
    return feed.unionByName(again)


def version_log(lines: DataFrame) -> DataFrame:
    """Writes to products with the version each writer produced (from the
    stored lines: a line is a write to its product at version = line number)."""
    return lines.select("barcode", F.col("seq").cast("bigint").alias("version"),
                        F.col("session_id").alias("writer"), "price")


def unpaired(feed: DataFrame) -> DataFrame:
    """The feed without the completions of every third user's sessions: those payments stay unpaired."""
    user = F.split_part("key", F.lit("-"), F.lit(1)).try_cast("bigint")
    return feed.where(~F.coalesce((F.col("topic") == "session.completed") & (user % 3 == 0), F.lit(False)))
