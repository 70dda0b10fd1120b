"""Session operators: the state machine in bulk, access checks, gate tokens.

Inputs: ``sessions`` (session_id, user_id, store_id, status, created_at,
expires_at), ``session_log`` (event_id, event_time, user_id, session_id,
target: a command "move to target"), ``qr_tokens`` and request views.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.columns import (epoch_millis, iso_instant, parse_long, parse_uuid, qr_sign,
                                        qr_verify)
from basketry.operators.scan import materialize, order_key, prev_value
from basketry.operators.replay import replay
from basketry.schemas import DEFAULTS, QR_TTL, SESSION_EDGES, SESSION_STATES, SESSION_TTL, TERMINAL_STATES, edges_df


# --- T1 / U2 / W4: edges --------------------------------------------------------------

def naive_chain(log: DataFrame) -> DataFrame:
    """Each command read as an audit row: from = the previous command's target
    (first: CREATED), to = its own target. Two-level lag, skew-safe."""
    p = prev_value(log, ["session_id"], "event_time", "event_id", ["target"])
    return p.select("event_id", "event_time", "session_id",
                    F.coalesce(F.col("prev_target"), F.lit("CREATED")).alias("from_state"),
                    F.col("target").alias("to_state"))


def transition_check(spark: SparkSession, pairs: DataFrame) -> DataFrame:
    """Legal flag and message for (from_state, to_state) rows, by a join on
    the 6-row edge table (broadcast: a fixed literal)."""
    e = edges_df(spark).withColumn("legal", F.lit(True))
    j = pairs.join(e, (pairs.from_state == e.from_state) & (pairs.to_state == e.to_state), "left")
    legal = F.coalesce(F.col("legal"), F.lit(False))
    return j.select(pairs["*"], legal.alias("legal"),
                    F.when(~legal, F.concat(F.lit("Cannot transition from "), pairs.from_state,
                                            F.lit(" to "), pairs.to_state)).alias("message"))


def illegal_edges(spark: SparkSession, pairs: DataFrame) -> DataFrame:
    """Observed (from, to) pairs minus the allowed edges, with counts."""
    observed = pairs.groupBy("from_state", "to_state").agg(F.count(F.lit(1)).alias("n"))
    return observed.join(edges_df(spark), ["from_state", "to_state"], "left_anti")


# --- T2: replay ---------------------------------------------------------------------------

def session_replay(log: DataFrame) -> DataFrame:
    """Per command the state before it, accepted or not (rejected ones leave
    the state unchanged), the state after it, and the session's final state.
    One pass over the log: see ``operators/replay.py``."""
    return replay(log, "session_id", "target", SESSION_STATES, SESSION_EDGES).select(
        "event_id", "event_time", "session_id", "user_id", "target", "from_state", "accepted", "to_state", "final_state")


def transition_audit(log: DataFrame) -> DataFrame:
    """The audit rows the replay writes: one per accepted command (at most four
    per session, so per-session windows over them are bounded)."""
    r = session_replay(log).where(F.col("accepted"))
    return r.select("event_id", F.col("event_time").alias("transitioned_at"), "session_id", "user_id",
                    "from_state", "to_state")


def transition_chain_audit(spark: SparkSession, audit: DataFrame) -> DataFrame:
    """Each audit row's from_state equals the previous row's to_state (first:
    CREATED) and the edge is allowed."""
    p = prev_value(audit.withColumnRenamed("transitioned_at", "event_time"), ["session_id"],
                   "event_time", "event_id", ["to_state"])
    expected = F.coalesce(F.col("prev_to_state"), F.lit("CREATED"))
    chk = transition_check(spark, p.select("event_id", "event_time", "session_id", "from_state", "to_state",
                                           expected.alias("expected_from")))
    return chk.select("event_id", F.col("event_time").alias("transitioned_at"), "session_id", "from_state",
                      "to_state", (F.col("from_state") == F.col("expected_from")).alias("chain_ok"),
                      F.col("legal").alias("edge_ok"))


def state_dwell_time(audit: DataFrame) -> DataFrame:
    """Time spent in each state entered by an accepted transition, until
    the next one (sessions still in a state are left out), in microseconds."""
    from pyspark.sql import Window
    w = Window.partitionBy("session_id").orderBy("transitioned_at", "event_id")
    d = audit.withColumn("left_at", F.lead("transitioned_at").over(w))
    us = F.timestamp_diff("MICROSECOND", F.col("transitioned_at"), F.col("left_at"))
    d = d.where(F.col("left_at").isNotNull()).withColumn("us", us)
    # exact integer microseconds (a float average would depend on summation order)
    return d.groupBy(F.col("to_state").alias("state")).agg(
        F.count(F.lit(1)).alias("n"), F.expr("sum(us) div count(1)").alias("avg_micros"),
        F.min("us").alias("min_micros"), F.max("us").alias("max_micros"))


def moment(as_of: str | None) -> Column:
    """A given time, or now."""
    return F.localtimestamp() if as_of is None else F.lit(as_of).cast("timestamp_ntz")


def stuck_payments(log: DataFrame, as_of: str | None = None, older_than: str = "15 minutes") -> DataFrame:
    """Sessions whose last state is PAYING, entered more than ``older_than``
    before ``as_of`` (payment is two transactions, so PAYING can stick)."""
    cut = moment(as_of) - F.expr(f"INTERVAL {older_than}")
    entered = session_replay(log).where(F.col("accepted") & (F.col("to_state") == "PAYING") & (F.col("final_state") == "PAYING"))
    # the last entry counts, also where an edge table lets a session come back
    last = entered.groupBy("session_id").agg(F.max("event_time").alias("paying_since"))
    return last.where(F.col("paying_since") < cut).select("session_id", "paying_since")


def payment_receipts(log: DataFrame, secret: str) -> DataFrame:
    """Each accepted completion -> the session.paid and session.completed
    event values and the signed exit token."""
    r = session_replay(log).where(F.col("accepted") & (F.col("target") == "COMPLETED"))
    at = iso_instant("event_time")
    paid = F.to_json(F.struct(F.col("session_id").alias("sessionId"), F.col("user_id").alias("userId"),
                              at.alias("paidAt")))
    done = F.to_json(F.struct(F.col("session_id").alias("sessionId"), at.alias("completedAt")))
    tok = issue_token_cols("session_id", "user_id", F.lit("EXIT"), F.col("event_time"), secret)
    return r.select("session_id", "user_id", F.col("event_time").alias("paid_at"),
                    paid.alias("paid_event"), done.alias("completed_event"), *tok)


# --- T3 / T4: new sessions and tokens ---------------------------------------------------

def uuid_from(text: Column, random: bool = False) -> Column:
    """UUID of a new row: from its key, so that a retried job gives the same one, or a random one.

    Random ids differ between reads of a frame; write it before reading it twice."""
    if random:
        return F.uuid()
    h = F.sha2(text, 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def issue_token_cols(session_col: str, user_col: str, token_type: Column, now: Column,
                     secret: str, random_ids: bool = False) -> list[Column]:
    """T4 columns: correlation id, payload JSON, signature, expiry (+24 h),
    status ACTIVE, key version 1."""
    expires = now + F.expr(f"INTERVAL {QR_TTL}")
    payload = F.to_json(F.struct(F.col(session_col).cast("string").alias("sessionId"),
                                 F.col(user_col).alias("userId"), token_type.alias("type"),
                                 iso_instant(expires).alias("expiresAt")))
    corr = uuid_from(F.concat(F.lit("qr:"), F.col(session_col).cast("string"), F.lit(":"), token_type), random_ids)
    return [corr.alias("correlation_id"), token_type.alias("token_type"), payload.alias("payload"),
            qr_sign(payload, secret).alias("signature"), F.lit(1).alias("key_version"),
            expires.alias("expires_at"), F.lit("ACTIVE").alias("status")]


def issue_tokens(sessions: DataFrame, secret: str, random_ids: bool = False) -> DataFrame:
    """T4: an entry token for live sessions, an exit token for completed ones."""
    tt = F.when(F.col("status") == "COMPLETED", "EXIT").otherwise("ENTRY")
    return sessions.select("session_id", "user_id",
                           *issue_token_cols("session_id", "user_id", tt, F.col("created_at"), secret, random_ids))


def resolve_user(access: DataFrame) -> DataFrame:
    """Header user id wins over the parameter; neither -> error row."""
    u = F.coalesce(F.col("header_user_id"), F.col("param_user_id"))
    return access.select("event_id", "path", u.alias("user_id"),
                         F.when(u.isNull(), "missing_user").otherwise("ok").alias("outcome"))


def start_sessions(access: DataFrame, secret: str, random_ids: bool = False) -> DataFrame:
    """Session-start requests -> new session rows (the request's store, else
    1; CREATED, +24 h) with their signed entry token; requests without a user
    are left out."""
    req = resolve_user(access.where(F.col("path").startswith("/api/sessions/"))).where(F.col("outcome") == "ok")
    req = req.join(access.select("event_id", "event_time", "store_id"), "event_id")
    sid = uuid_from(F.concat(F.lit("session:"), F.col("event_id").cast("string")), random_ids)
    s = req.select("event_id", sid.alias("session_id"), "user_id",
                   F.coalesce(F.col("store_id"), F.lit(DEFAULTS["store_id"])).cast("bigint").alias("store_id"),
                   F.lit(DEFAULTS["status"]).alias("status"), F.col("event_time").alias("created_at"),
                   (F.col("event_time") + F.expr(f"INTERVAL {SESSION_TTL}")).alias("expires_at"))
    *token, expires, status = issue_token_cols("session_id", "user_id", F.lit("ENTRY"), F.col("created_at"), secret, random_ids)
    return s.select("*", *token, expires.alias("token_expires_at"), status.alias("token_status"))


# --- T5 / T6 / T7: gates --------------------------------------------------------------

def validate_tokens(requests: DataFrame, qr: DataFrame, secret: str) -> DataFrame:
    """T5: a request against its token as stored; first failing check wins: not
    found -> not active -> expired (requested_at > expires_at, strict) -> bad
    signature -> ok.

    A signature is checked once a token, before the join: payloads and
    signatures are not shuffled."""
    t = qr.select("correlation_id", "session_id", "status", "expires_at", (~qr_verify("payload", "vault_signature", secret)).alias("_forged"))
    j = requests.join(t, "correlation_id", "left")
    outcome = (F.when(F.col("session_id").isNull(), "not_found")
               .when(F.col("status") != "ACTIVE", "not_active")
               .when(F.col("requested_at") > F.col("expires_at"), "expired")
               .when(F.col("_forged"), "bad_signature")
               .otherwise("ok"))
    return j.select(requests["*"], "session_id", F.col("status").alias("token_status"), outcome.alias("verdict"))


def gate_history(requests: DataFrame, qr: DataFrame, sessions: DataFrame,
                 secret: str, as_run: bool = False) -> DataFrame:
    """All requests of both gates as one history per session, in order of
    (requested_at, request_id): what each finds and does.

    A token has one status, whatever the gate. A valid entry request activates
    its session if that is CREATED, and uses the token; so of all tokens of a
    session only the first valid entry succeeds, later ones fail as illegal
    transitions and leave their token active. A valid exit request uses its
    token if the session is COMPLETED. A used token is not active afterwards,
    at either gate. The first expired presentation marks a token EXPIRED
    (``as_run=True``: at the entry gate that update is rolled back with the
    error, so only exit presentations mark it).

    Closed form by grouped minima of one order key (hash aggregates, combined
    on the map side): the session's first valid entry, the token's first valid
    exit and its first committed expiry. A token that is used is used before
    it can expire, so the two never compete. Adds ``result`` (ok, not_found,
    not_active, expired, bad_signature, illegal_transition, not_completed),
    ``status_now`` of a token that is not active, and ``session_now``."""
    key = order_key("requested_at", "request_id")
    c = validate_tokens(requests, qr, secret).withColumn("_key", key)
    c = c.join(sessions.select("session_id", F.col("status").alias("_session")), "session_id", "left")
    c = materialize(c)
    valid = F.col("verdict") == "ok"
    entries = (c.where(valid & (F.col("gate") == "entry") & (F.col("_session") == "CREATED")).groupBy("session_id")
                .agg(F.min("_key").alias("_entered"), F.min_by("correlation_id", "_key").alias("_entry_token")))
    expiry = F.col("verdict") == "expired"
    if as_run:
        expiry = expiry & (F.col("gate") == "exit")
    by_token = (c.where(valid | expiry).groupBy("correlation_id").agg(
        F.min(F.when(valid & (F.col("gate") == "exit") & (F.col("_session") == "COMPLETED"), F.col("_key"))).alias("_left"),
        F.min(F.when(expiry, F.col("_key"))).alias("_marked")))
    j = c.join(entries, "session_id", "left").join(by_token, "correlation_id", "left")
    used = F.when(F.col("_entry_token") == F.col("correlation_id"), F.col("_entered")).otherwise(F.col("_left"))
    j = j.withColumn("_used", used)
    now = F.when(F.col("_entered") < F.col("_key"), "ACTIVE").otherwise(F.col("_session"))
    status = (F.when(F.col("verdict") == "not_active", F.col("token_status"))
              .when(F.col("_used") < F.col("_key"), "USED").when(F.col("_marked") < F.col("_key"), "EXPIRED"))
    result = (F.when(F.col("verdict") == "not_found", "not_found").when(F.col("status_now").isNotNull(), "not_active")
              .when(F.col("verdict") != "ok", F.col("verdict")).when(F.col("_used") == F.col("_key"), "ok")
              .when(F.col("gate") == "entry", "illegal_transition").otherwise("not_completed"))
    return (j.withColumn("status_now", status).withColumn("session_now", now).withColumn("result", result)
             .select("request_id", "requested_at", "correlation_id", "gate", "session_id", "result", "status_now",
                     "session_now"))


def _refusal() -> Column:
    """The text of a refused token."""
    return (F.when(F.col("result") == "not_found",
                   F.concat(F.lit("QR token not found for correlationId="), F.col("correlation_id")))
            .when(F.col("result") == "not_active",
                  F.concat(F.lit("QR token is not active, status="), F.col("status_now")))
            .when(F.col("result") == "expired", "QR token has expired")
            .when(F.col("result") == "bad_signature", "QR token signature verification failed"))


def gate_entry(history: DataFrame) -> DataFrame:
    """The entry requests of a ``gate_history``: outcome, message, and the
    audit row of an accepted one (CREATED -> ACTIVE, triggered by the gate)."""
    ok = F.col("result") == "ok"
    message = F.coalesce(_refusal(), F.when(F.col("result") == "illegal_transition", F.concat(
        F.lit("Cannot transition from "), F.col("session_now"), F.lit(" to ACTIVE"))))
    return history.where(F.col("gate") == "entry").select(
        "request_id", "correlation_id", "session_id", F.col("result").alias("outcome"), message.alias("message"),
        ok.alias("token_used"), F.when(ok, "CREATED").alias("from_state"), F.when(ok, "ACTIVE").alias("to_state"),
        F.when(ok, "gate-entry").alias("triggered_by"), F.lit(None).cast("string").alias("reason"))


def gate_exit(history: DataFrame) -> DataFrame:
    """The exit requests of a ``gate_history``: a valid token of a COMPLETED
    session is used (valid = true); otherwise valid = false with a message,
    never an error."""
    ok = F.col("result") == "ok"
    message = (F.when(ok, "Exit authorized")
               .when(F.col("result") == "not_completed", "Session is not in COMPLETED state").otherwise(_refusal()))
    return history.where(F.col("gate") == "exit").select(
        "request_id", "correlation_id",
        F.when(ok | (F.col("result") == "not_completed"), F.col("session_id")).alias("session_id"),
        ok.alias("valid"), message.alias("message"), ok.alias("token_used"))


# --- J2 / J8 / T8 / P7 / P10 / T15 --------------------------------------------------------

def parse_session_id(c: Column, id_format: str) -> Column:
    """Session id text -> key; ``uuid`` in production, ``long`` for the test
    tables (their sessions have integer ids)."""
    return parse_uuid(c) if id_format == "uuid" else parse_long(c)


def session_access_check(requests: DataFrame, sessions: DataFrame, id_format: str = "long") -> DataFrame:
    """Per (session text, user text): malformed -> INVALID_ARGUMENT; unknown
    -> NOT_FOUND; other owner -> PERMISSION_DENIED; else valid = status ACTIVE."""
    sid = parse_session_id(F.col("session_text"), id_format)
    uid = parse_long(F.col("user_text"))
    r = requests.withColumn("_sid", sid).withColumn("_uid", uid)
    s = sessions.select(F.col("session_id").alias("_sid"), F.col("user_id").alias("_owner"),
                        F.col("status").alias("_status"))
    j = r.join(s, "_sid", "left")
    outcome = (F.when(F.col("_sid").isNull() | F.col("_uid").isNull(), "INVALID_ARGUMENT")
               .when(F.col("_owner").isNull(), "NOT_FOUND")
               .when(F.col("_owner") != F.col("_uid"), "PERMISSION_DENIED")
               .otherwise("OK"))
    return j.select(requests["*"], outcome.alias("outcome"),
                    ((outcome == "OK") & (F.col("_status") == "ACTIVE")).alias("valid"))


def verify_owner(requests: DataFrame, sessions: DataFrame) -> DataFrame:
    """A session is visible only to its owner; a mismatch reads as missing.
    One left join on the session's key; the owner is compared in the row."""
    own = sessions.select("session_id", F.col("user_id").alias("_owner"))
    return requests.join(own, "session_id", "left").select(
        requests["*"], F.coalesce(F.col("_owner") == F.col("user_id"), F.lit(False)).alias("visible"))


def exit_token_eligibility(requests: DataFrame, sessions: DataFrame, secret: str,
                           id_format: str = "long") -> DataFrame:
    """Malformed -> INVALID_ARGUMENT; unknown -> NOT_FOUND; not COMPLETED ->
    FAILED_PRECONDITION; else a signed exit token with expiry in epoch millis."""
    r = requests.withColumn("_sid", parse_session_id(F.col("session_text"), id_format))
    s = sessions.select(F.col("session_id").alias("_sid"), "user_id", F.col("status").alias("_status"))
    j = r.join(s, "_sid", "left")
    outcome = (F.when(F.col("_sid").isNull(), "INVALID_ARGUMENT").when(F.col("_status").isNull(), "NOT_FOUND")
               .when(F.col("_status") != "COMPLETED", "FAILED_PRECONDITION").otherwise("OK"))
    expires = F.col("event_time") + F.expr(f"INTERVAL {QR_TTL}")
    corr = uuid_from(F.concat(F.lit("exit:"), F.col("event_id").cast("string")))
    _, _, payload, signature, *_ = issue_token_cols("_sid", "user_id", F.lit("EXIT"), F.col("event_time"), secret)
    ok = lambda c: F.when(outcome == "OK", c)
    return j.select("event_id", "session_text", outcome.alias("outcome"), ok(corr).alias("correlation_id"),
                    ok(payload).alias("payload"), ok(signature).alias("signature"),
                    ok(epoch_millis(expires)).alias("expires_at_epoch"))


def session_view(sessions: DataFrame) -> DataFrame:
    """The 4-field session response."""
    return sessions.select("session_id", "user_id", "status", "created_at")


def sessions_by_user_status(users: DataFrame, sessions: DataFrame, status: str = "ACTIVE") -> DataFrame:
    """P10: sessions of the requested users in the requested status (a filter that reaches the scan)."""
    return sessions.where(F.col("status") == status).join(users.select(F.col("id").alias("user_id")), "user_id", "left_semi")


def expired_sessions(sessions: DataFrame, as_of: str | None = None) -> DataFrame:
    """Sessions past expires_at that are still not terminal (filter pushed
    to the scan where the column is stored)."""
    now = moment(as_of)
    return sessions.where((F.col("expires_at") < now) & ~F.col("status").isin(*TERMINAL_STATES))
