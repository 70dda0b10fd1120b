"""Brute-force checks for the keys without a SQL twin (small fixture)."""

import base64
import hashlib
import hmac
import json

from basketry.operators import tokens
from basketry.schemas import OPEN_PATHS
from basketry.sources import fixtures
from basketry.sources.tables import Views
from conftest import SF_SMALL


def _b64url_decode(s):
    return base64.urlsafe_b64decode(s + "=" * (-len(s) % 4))


def test_token_audit_against_python(spark):
    v = Views(spark, SF_SMALL)
    hdr = fixtures.bearer_headers(v.access_log, v.users)
    audit = {r["event_id"]: r for r in tokens.token_audit(hdr, fixtures.JWT_SECRET).collect()}
    key = fixtures.JWT_SECRET.encode()
    seen = set()
    for r in hdr.collect():
        path, h = r["path"], r["authorization"]
        now = int(r["event_time"].replace(tzinfo=__import__("datetime").timezone.utc).timestamp())
        if any(path.startswith(o) for o in OPEN_PATHS):
            exp = ("open", None)
        elif h is None:
            exp = ("missing_header", None)
        elif not h.startswith("Bearer "):
            exp = ("wrong_scheme", None)
        else:
            head, body, sig = h[7:].split(".")
            digest = {"HS512": hashlib.sha512, "HS256": hashlib.sha256}.get(json.loads(_b64url_decode(head))["alg"])
            good = digest and base64.urlsafe_b64encode(hmac.new(key, f"{head}.{body}".encode(), digest).digest()) \
                .decode().rstrip("=")
            claims = json.loads(_b64url_decode(body))
            if good != sig:
                exp = ("bad_signature", None)
            elif claims["exp"] < now:
                exp = ("expired", None)
            else:
                exp = ("ok", claims)
        got = audit[r["event_id"]]
        assert got["outcome"] == exp[0], (r["event_id"], got["outcome"], exp[0])
        if exp[1] is not None:
            assert got["x_user_id"] == (exp[1]["sub"] or "")
            assert got["x_user_email"] == (exp[1].get("email") or "")
            assert got["x_user_role"] == (exp[1].get("role") or "")
        seen.add(exp[0])
    assert {"open", "missing_header", "wrong_scheme", "bad_signature", "expired", "ok"} <= seen


def test_long_tokens_are_read_whole(spark):
    from pyspark.sql import functions as F
    v = Views(spark, SF_SMALL)
    users = v.users.where("id < 10").withColumn("email", F.repeat(F.lit("e"), 100_001))
    audit = tokens.token_audit(fixtures.bearer_headers(v.access_log.where("event_id < 60"), users), fixtures.JWT_SECRET)
    assert audit.where("outcome = 'ok' and length(x_user_email) = 100001").count() > 0


def test_lookup_dedup_loads_again_after_an_hour(spark):
    """Several micro-batches, a late row and a tie, against a plain fold."""
    import datetime as dt

    from basketry.streaming.queries import stream_lookup_dedup
    t0 = dt.datetime(2024, 1, 1)
    at = [0, 10, 59, 60, 61, 119, 120, 121, 300, 300, 365, 900]
    rows = [(i, f"b{b}", t0 + dt.timedelta(minutes=m + b)) for b in range(3) for i, m in enumerate(at, 100 * b)]
    got = {(r["barcode"], r["request_id"]) for r in stream_lookup_dedup(
        spark, spark.createDataFrame(rows, "request_id long, barcode string, requested_at timestamp_ntz")).collect()}
    want, last = set(), {}
    mark = max(r[2] for r in rows) - dt.timedelta(hours=1)
    for i, b, t in sorted(rows, key=lambda r: (r[2], r[0])):
        if t <= mark and (b not in last or t >= last[b] + dt.timedelta(hours=1)):
            last[b] = t
            want.add((b, i))
    assert got == want and len(want) == 3 * 5
