"""Refresh-token history, family revocation, lineage and token audits.

Inputs: ``tokens`` (token, family_id, user_id, created_at, expires_at,
revoked, revocation_reason) — the stored refresh tokens, looked up by the
SHA-256 of the raw text as the service does — and ``token_log`` (event_id,
event_time, family_id, token, kind PRESENT/LOGOUT).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.columns import (b64url, b64url_to_text, epoch_micros, hmac_b64, parse_price,
                                        qr_verify, sha256_hex)
from basketry.operators.scan import key_id, key_time, materialize, order_key, prefix_scan, prev_value
from basketry.operators.sessions import uuid_from
from basketry.schemas import REFRESH_TOKEN_TTL



def _k() -> Column:
    return order_key("event_time", "event_id")


def hash_tokens(tokens: DataFrame) -> DataFrame:
    """stored form of each raw token (SHA-256 hex)."""
    return tokens.select("token", sha256_hex("token").alias("token_hash"))


def stored_tokens(tokens: DataFrame) -> DataFrame:
    return tokens.withColumn("token_hash", sha256_hex("token"))


def token_states(log: DataFrame, tokens: DataFrame, as_run: bool = False) -> DataFrame:
    """T9 core: one row per stored token, with the order keys that decide its
    history and its family's.

    Closed form (all steps are monotone, so no sequential fold is needed):
    a known token's first presentation rotates it when the token was not
    already revoked, was unexpired then (equality still valid) and came before
    the family was compromised; any later presentation of it is reuse. The
    family is compromised at the earliest of: its first logout of a known
    token, a presentation of an already-revoked token, or the second
    presentation of a rotated token. Every presentation after that is reuse.
    ``as_run=True`` keeps the effect of the rollback in the service: a reuse
    revokes nothing, only logouts compromise the family.

    One scan of the log: the first two events of each (token, kind) are a
    ranked limit, which Spark applies before the exchange as well, so a hot
    token sends two rows per map task. The rest works on one row per token."""
    k = _k()
    rank = F.row_number().over(Window.partitionBy("token", "kind").orderBy("_key"))
    firsts = log.select("token", "kind", k.alias("_key")).withColumn("_rn", rank).where(F.col("_rn") <= 2)
    at = lambda kind, n: F.min(F.when((F.col("kind") == kind) & (F.col("_rn") == n), F.col("_key")))
    keys = (firsts.groupBy("token").agg(at("PRESENT", 1).alias("k1"), at("PRESENT", 2).alias("k2"), at("LOGOUT", 1).alias("c_logout"))
            .withColumn("token_hash", sha256_hex("token")).drop("token"))
    t = materialize(stored_tokens(tokens).join(keys, "token_hash", "left"))
    first_ok = (~F.col("revoked")) & (key_time(F.col("k1")) <= F.col("expires_at"))
    t = t.withColumn("first_ok", F.coalesce(first_ok, F.lit(False)))
    reuse = F.when(F.col("revoked"), F.col("k1")).when(F.col("first_ok"), F.col("k2"))
    fam = t.groupBy("family_id").agg(F.min("c_logout").alias("f_logout"), F.min(reuse).alias("f_reuse"))
    comp = F.col("f_logout") if as_run else F.least("f_logout", "f_reuse")
    fam = fam.select("family_id", comp.alias("compromised_at"),
                     F.when(comp == F.col("f_logout"), "LOGOUT").when(comp.isNotNull(), "REUSE_DETECTED").alias("cause"))
    t = t.join(fam, "family_id", "left")
    rotated = F.col("first_ok") & (F.col("compromised_at").isNull() | (F.col("k1") < F.col("compromised_at")))
    return t.withColumn("rotated", F.coalesce(rotated, F.lit(False)))


def refresh_history(log: DataFrame, tokens: DataFrame, as_run: bool = False) -> DataFrame:
    """The outcome of every presentation and logout: the log joined once with
    ``token_states``."""
    st = token_states(log, tokens, as_run).select(
        "token_hash", "family_id", "user_id", "expires_at", F.col("revoked").alias("_revoked"), "k1", "compromised_at", "rotated")
    j = log.select("event_id", "event_time", "kind", "token", sha256_hex("token").alias("token_hash")).join(st, "token_hash", "left")
    k = _k()
    outcome = (F.when(F.col("family_id").isNull(), "invalid")
               .when(F.col("kind") == "LOGOUT", "logged_out")
               .when(F.col("_revoked"), "reuse")
               .when(F.coalesce(k > F.col("compromised_at"), F.lit(False)), "reuse")
               .when((k != F.col("k1")) & F.col("rotated"), "reuse")
               .when(F.col("expires_at") < F.col("event_time"), "expired")
               .otherwise("rotate"))
    return j.select("event_id", "event_time", "kind", "token", "family_id", "user_id", outcome.alias("outcome"))


def refresh_outcomes(log: DataFrame, tokens: DataFrame, as_run: bool = False) -> DataFrame:
    """Per presented token: invalid (unknown) / reuse / expired / rotate."""
    h = refresh_history(log, tokens, as_run)
    return h.where(F.col("kind") == "PRESENT").select("event_id", "event_time", "token", "family_id",
                                                     "outcome")


def reuse_detection(log: DataFrame, tokens: DataFrame) -> DataFrame:
    """Families compromised by reuse, and from when (from the tokens' states, not the log)."""
    return (token_states(log, tokens).where(F.col("cause") == "REUSE_DETECTED")
            .groupBy("family_id").agg(F.min("compromised_at").alias("_at"))
            .select("family_id", key_time(F.col("_at")).alias("compromised_at"), key_id(F.col("_at")).alias("reuse_event_id")))


def logout_revocation(log: DataFrame, tokens: DataFrame) -> DataFrame:
    """A logout revokes the whole family (reason LOGOUT); unknown token ->
    invalid. Needs the token's family only, so the logouts meet the stored
    tokens directly."""
    st = stored_tokens(tokens).select("token_hash", "family_id")
    out = log.where(F.col("kind") == "LOGOUT").withColumn("token_hash", sha256_hex("token"))
    return out.drop("family_id").join(st, "token_hash", "left").select(
        "event_id", "event_time", "token", "family_id",
        F.when(F.col("family_id").isNull(), "invalid").otherwise("ok").alias("outcome"))


def family_revoke(log: DataFrame, tokens: DataFrame) -> DataFrame:
    """Final state of each stored token: rows of revoked families that were
    not yet revoked take the family's reason; earlier reasons stay."""
    reason = (F.when(F.col("revoked"), F.col("revocation_reason"))
              .when(F.col("rotated"), F.lit("ROTATED"))
              .otherwise(F.col("cause")))
    return token_states(log, tokens).select("token", "family_id", "user_id", reason.isNotNull().alias("revoked"),
                                            reason.alias("revocation_reason"))


def revoked_per_family(log: DataFrame, tokens: DataFrame) -> DataFrame:
    """A4: rows each family revocation changed (count of tokens taking its reason)."""
    fr = family_revoke(log, tokens)
    return (fr.where(F.col("revocation_reason").isin("REUSE_DETECTED", "LOGOUT"))
              .groupBy("family_id", F.col("revocation_reason").alias("reason"))
              .agg(F.count(F.lit(1)).alias("revoked_count")))


def rotation_lineage(tokens: DataFrame) -> DataFrame:
    """Tokens of a family in issue order: generation number, previous and
    next token. Generation is a two-level running count; next is the row whose
    previous is this one (an equi-join, no window over the family)."""
    t = tokens.select("token", "family_id", "created_at").withColumn("one", F.lit(1))
    g = prefix_scan(t, ["family_id"], "created_at", "token", "one", "generation", bucket_us=24 * 3_600_000_000)
    p = prev_value(g, ["family_id"], "created_at", "token", ["token"], bucket_us=24 * 3_600_000_000)
    nxt = p.select(F.col("prev_token").alias("token"), F.col("token").alias("next_token"))
    return (p.join(nxt, "token", "left")
             .select("token", "family_id", "created_at", F.col("generation").cast("bigint").alias("generation"),
                     "prev_token", "next_token"))


def issue_refresh_tokens(access: DataFrame, log: DataFrame, tokens: DataFrame) -> DataFrame:
    """One row per issued refresh token: a new family on login (auth calls
    with a user), the same family on each rotation; hash, +7 days, not revoked."""
    logins = (access.where(F.col("path").startswith("/api/auth/") & F.col("header_user_id").isNotNull())
                    .select("event_id", "event_time", F.col("header_user_id").alias("user_id"),
                            uuid_from(F.concat(F.lit("family:"), F.col("event_id").cast("string")))
                            .cast("string").alias("family_id")))
    rot = (refresh_history(log, tokens).where(F.col("outcome") == "rotate")
           .select("event_id", "event_time", "user_id", F.col("family_id").cast("string").alias("family_id")))
    both = logins.unionByName(rot)
    raw = uuid_from(F.concat(F.lit("refresh:"), F.col("event_id").cast("string")))
    return both.select("event_id", sha256_hex(raw).alias("token_hash"), "family_id", "user_id",
                       F.col("event_time").alias("created_at"),
                       (F.col("event_time") + F.expr(f"INTERVAL {REFRESH_TOKEN_TTL}")).alias("expires_at"),
                       F.lit(False).alias("revoked"))


def token_with_session(qr: DataFrame, sessions: DataFrame, tokens: DataFrame | None = None,
                       users: DataFrame | None = None, audit: DataFrame | None = None) -> DataFrame:
    """Many-to-one hops as inner equi joins: QR token -> its session
    (status), refresh token -> its user (e-mail), and transition (``audit``:
    request_id, session_id) -> its session, in one schema (hop, child_key,
    parent_key, parent_label)."""
    s = sessions.select("session_id", F.col("status").alias("parent_label"))
    out = (qr.select("correlation_id", "session_id").join(s, "session_id", "inner")
             .select(F.lit("qr_token").alias("hop"), F.col("correlation_id").alias("child_key"),
                     F.col("session_id").cast("string").alias("parent_key"), "parent_label"))
    if tokens is not None and users is not None:
        u = users.select(F.col("id").alias("user_id"), F.col("email").alias("parent_label"))
        rt = (tokens.select("token", "user_id").join(u, "user_id", "inner")
                    .select(F.lit("refresh_token").alias("hop"), F.col("token").alias("child_key"),
                            F.col("user_id").cast("string").alias("parent_key"), "parent_label"))
        out = out.unionByName(rt)
    if audit is not None:
        out = out.unionByName(audit.select("request_id", "session_id").join(s, "session_id", "inner").select(
            F.lit("transition").alias("hop"), F.col("request_id").cast("string").alias("child_key"),
            F.col("session_id").cast("string").alias("parent_key"), "parent_label"))
    return out


def tokens_by_family(log: DataFrame, tokens: DataFrame) -> DataFrame:
    """Stored tokens of the requested families (those named by logouts)."""
    fams = log.where(F.col("kind") == "LOGOUT").select("family_id").distinct()
    return tokens.join(fams, "family_id", "left_semi")


def sign_verify(qr: DataFrame, secret: str) -> DataFrame:
    """F16: verify each stored QR signature (hmac: prefix, recomputed HMAC)."""
    return qr.select("correlation_id", "vault_signature",
                     qr_verify("payload", "vault_signature", secret).alias("valid"))


def parse_prices(rows: DataFrame) -> DataFrame:
    """``price_text`` -> DECIMAL(19,4), malformed -> 0."""
    return rows.withColumn("price", parse_price(F.col("price_text")))


# --- T13: access-token audit ---------------------------------------------------------

def token_audit(requests: DataFrame, secret: str) -> DataFrame:
    """Per request: open path / missing header / wrong scheme / bad
    signature / expired / ok, with sub, email, role ('' when absent). The
    digest is the one the token's own header names (HS256 or HS512; any other
    algorithm, and "none", is a bad signature)."""
    from basketry.schemas import OPEN_PATHS
    p = F.col("path")
    open_path = F.lit(False)
    for o in OPEN_PATHS:
        open_path = open_path | p.startswith(o)
    h = F.col("authorization")
    part = lambda i: F.get("_parts", F.lit(i))
    # one column at a time: an expression used twice is computed once
    r = requests.withColumn("_parts", F.split(h.substr(F.lit(8), F.length(h)), r"\."))
    r = r.withColumn("_alg", F.get_json_object(b64url_to_text(part(0)), "$.alg"))
    r = r.withColumn("_input", F.concat(part(0), F.lit("."), part(1)))
    r = r.withColumn("_sig", F.when(F.col("_alg") == "HS512", hmac_b64("_input", secret, 512))
                     .when(F.col("_alg") == "HS256", hmac_b64("_input", secret, 256)))
    r = r.withColumn("_claims", b64url_to_text(part(1)))
    now = F.floor(epoch_micros("event_time") / 1_000_000).cast("bigint")
    r = r.withColumn("outcome", F.when(open_path, "open")
                     .when(h.isNull(), "missing_header")
                     .when(~h.startswith("Bearer "), "wrong_scheme")
                     .when((F.size("_parts") != 3) | ~F.coalesce(b64url(F.col("_sig")) == part(2), F.lit(False)), "bad_signature")
                     .when(F.get_json_object("_claims", "$.exp").cast("bigint") < now, "expired")
                     .otherwise("ok"))
    claim = lambda n: F.when(F.col("outcome") == "ok", F.coalesce(F.get_json_object("_claims", f"$.{n}"), F.lit("")))
    return r.select("event_id", "path", "outcome",
                    claim("sub").alias("x_user_id"), claim("email").alias("x_user_email"),
                    claim("role").alias("x_user_role"))
