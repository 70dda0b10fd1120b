"""The reference's manual request scenarios, as literal DataFrame tests."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from basketry.sources import fixtures
from basketry.operators import access, carts, catalog, sessions, tokens

T0 = dt.datetime(2024, 3, 1, 10, 0, 0)


def _t(sec):
    return T0 + dt.timedelta(seconds=sec)


def seed_catalog(spark):
    cats, prods = catalog.seed_frames(spark)
    return prods.join(cats, "category_id").select("barcode", "name", "brand", "price",
                                                  F.col("category_name").alias("category"))


def test_basket_spaghetti_twice_and_cola(spark):
    cat = seed_catalog(spark)
    scans = spark.createDataFrame([(1, "8076802085738"), (2, "5449000000996"), (3, "8076802085738")],
                                  "request_id long, barcode string")
    enriched = carts.enrich_scans(scans, cat)
    lines = enriched.select(F.lit(1).cast("long").alias("session_id"), "barcode", F.lit(1).alias("quantity"),
                            "price", F.lit(T0).alias("scanned_at"), F.col("request_id").cast("int").alias("seq"))
    merged = carts.scan_merge(lines).collect()
    assert len(merged) == 2
    totals = carts.cart_totals(carts.scan_merge(lines).select(
        "session_id", "barcode", "quantity", F.col("price_at_addition").alias("price"))).first()
    assert totals["item_count"] == 3
    assert totals["total"] == Decimal("5.0900")


def test_search_on_name_not_brand(spark):
    cat = seed_catalog(spark)
    assert catalog.product_search(cat, "barilla", 5).count() == 0
    hits = catalog.product_search(cat, "choc", 10).collect()
    assert [r["name"] for r in hits] == ["Chocolat au Lait"]


def test_unknown_barcode_not_found(spark):
    cat = seed_catalog(spark)
    req = spark.createDataFrame([(1, "0000000000000")], "request_id long, barcode string")
    assert carts.enrich_scans(req, cat).first()["outcome"] == "product_not_found"
    assert catalog.product_by_barcode(req, cat).count() == 0


def test_add_remove_clear_fold(spark):
    ev = spark.createDataFrame([
        (1, _t(1), 7, "A", "ADD", Decimal("1.00")), (2, _t(2), 7, "A", "ADD", Decimal("2.00")),
        (3, _t(3), 7, "A", "REMOVE", None), (4, _t(4), 7, "A", "REMOVE", None),
        (5, _t(5), 7, "A", "REMOVE", None), (6, _t(6), 7, "A", "ADD", Decimal("3.00")),
        (7, _t(7), 7, "B", "CLEAR", None), (8, _t(8), 7, "A", "ADD", Decimal("4.00")),
    ], "event_id long, event_time timestamp_ntz, session_id long, barcode string, kind string, price decimal(19,4)")
    rows = {r["event_id"]: r for r in carts.price_at_addition(ev).collect()}
    assert [rows[i]["quantity"] for i in (1, 2, 3, 4, 5, 6, 8)] == [1, 2, 1, 0, 0, 1, 1]
    assert rows[5]["rejected"] and not rows[4]["rejected"]
    assert rows[2]["price_at_addition"] == Decimal("1.0000")
    assert rows[6]["price_at_addition"] == Decimal("3.0000")   # a new life takes the new price
    assert rows[8]["epoch"] == 1 and rows[8]["price_at_addition"] == Decimal("4.0000")


def test_entry_twice_and_exit_twice(spark):
    qr = spark.createDataFrame([
        ("c-in", 1, "ENTRY", '{"s":1}', False, "ACTIVE", T0, T0 + dt.timedelta(hours=24)),
        ("c-out", 2, "EXIT", '{"s":2}', False, "ACTIVE", T0, T0 + dt.timedelta(hours=24)),
    ], "correlation_id string, session_id long, token_type string, payload string, tampered boolean, "
       "status string, created_at timestamp_ntz, expires_at timestamp_ntz")
    qr = fixtures.stored_qr_tokens(qr)
    sess = spark.createDataFrame([(1, 5, "CREATED"), (2, 5, "COMPLETED")],
                                 "session_id long, user_id long, status string")
    req = spark.createDataFrame([
        (1, _t(10), "c-in", "entry"), (2, _t(20), "c-in", "entry"),
        (3, _t(30), "c-out", "exit"), (4, _t(40), "c-out", "exit"),
    ], "request_id long, requested_at timestamp_ntz, correlation_id string, gate string")
    hist = sessions.gate_history(req, qr, sess, fixtures.QR_SECRET)
    entry = {r["request_id"]: r["outcome"] for r in sessions.gate_entry(hist).collect()}
    assert entry == {1: "ok", 2: "not_active"}
    exit_ = {r["request_id"]: r["valid"] for r in sessions.gate_exit(hist).collect()}
    assert exit_ == {3: True, 4: False}


def test_tampered_token_fails_signature(spark):
    qr = spark.createDataFrame([("c1", 1, "ENTRY", "{}", True, "ACTIVE", T0, T0 + dt.timedelta(hours=1))],
                               "correlation_id string, session_id long, token_type string, payload string, "
                               "tampered boolean, status string, created_at timestamp_ntz, expires_at timestamp_ntz")
    req = spark.createDataFrame([(1, T0, "c1", "entry")],
                                "request_id long, requested_at timestamp_ntz, correlation_id string, gate string")
    out = sessions.validate_tokens(req, fixtures.stored_qr_tokens(qr), fixtures.QR_SECRET).first()
    assert out["verdict"] == "bad_signature"


def test_signatures_are_checked_before_the_join(spark):
    """Neither payloads nor signatures reach the join of requests and tokens."""
    qr = spark.createDataFrame([("c1", 1, "{}", "hmac:x", "ACTIVE", T0)], "correlation_id string, session_id long, payload string, "
                               "vault_signature string, status string, expires_at timestamp_ntz")
    req = spark.createDataFrame([(1, T0, "c1", "entry")], "request_id long, requested_at timestamp_ntz, correlation_id string, gate string")
    plan = sessions.validate_tokens(req, qr, fixtures.QR_SECRET)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Join LeftOuter", 1)
    assert "sha2" not in above and "sha2" in below


def test_outcomes_of_two_services_come_in_one_part(spark):
    bad = "MethodArgumentNotValidException"
    part = spark.createDataFrame([("fields", bad), ("fields", bad), ("cart_fields", bad), ("fields", None)], "source string, exception string")
    more = spark.createDataFrame([(bad,), (None,)], "exception string")
    got = {r.service: r.n for r in access.outcome_counts(spark, {"fields": part, "signups": more}).collect()}
    assert got == {"auth": 3, "cart": 1}


def test_pay_from_created_is_illegal(spark):
    log = spark.createDataFrame([(1, _t(1), 5, "s1", "PAYING"), (2, _t(2), 5, "s1", "ACTIVE"),
                                 (3, _t(3), 5, "s1", "PAYING"), (4, _t(4), 5, "s1", "COMPLETED"),
                                 (5, _t(5), 5, "s1", "CANCELLED")],
                                "event_id long, event_time timestamp_ntz, user_id long, session_id string, target string")
    r = {x["event_id"]: x for x in sessions.session_replay(log).collect()}
    assert [r[i]["accepted"] for i in range(1, 6)] == [False, True, True, True, False]
    assert r[1]["from_state"] == "CREATED" and r[5]["final_state"] == "COMPLETED"


def test_refresh_rotate_then_reuse_then_logout(spark):
    toks = spark.createDataFrame([("t1", 9, 9, T0, T0 + dt.timedelta(days=7), False, None),
                                  ("t2", 9, 9, T0, T0 + dt.timedelta(days=7), False, None)],
                                 "token string, family_id long, user_id long, created_at timestamp_ntz, "
                                 "expires_at timestamp_ntz, revoked boolean, revocation_reason string")
    log = spark.createDataFrame([(1, _t(1), 9, "t1", "PRESENT"), (2, _t(2), 9, "t1", "PRESENT"),
                                 (3, _t(3), 9, "t2", "PRESENT"), (4, _t(4), 9, "nope", "PRESENT")],
                                "event_id long, event_time timestamp_ntz, family_id long, token string, kind string")
    out = {r["event_id"]: r["outcome"] for r in tokens.refresh_outcomes(log, toks).collect()}
    assert out == {1: "rotate", 2: "reuse", 3: "reuse", 4: "invalid"}
    fr = {r["token"]: r["revocation_reason"] for r in tokens.family_revoke(log, toks).collect()}
    assert fr == {"t1": "ROTATED", "t2": "REUSE_DETECTED"}


def test_register_duplicate_and_bad_input(spark):
    users = spark.createDataFrame([(1, "a@x.org", "alice", "ROLE_CUSTOMER")],
                                  "id long, email string, username string, role string")
    req = spark.createDataFrame([
        (1, T0, "a@x.org", "bob", "password123"), (2, T0, "b@x.org", "alice", "password123"),
        (3, T0, "not-an-email", "ab", "short"), (4, T0, "c@x.org", "carol", "password123"),
        (5, T0, "c@x.org", "dave", "password123")],
        "request_id long, requested_at timestamp_ntz, email string, username string, password string")
    out = {r["request_id"]: r["outcome"] for r in access.register_batch(spark, req, users).collect()}
    assert out == {1: "email_taken", 2: "username_taken", 3: "invalid", 4: "registered", 5: "email_taken"}
    errs = access.validate_requests(req).where("request_id = 3").first()["errors"]
    assert errs.count(":") == 3


def test_random_ids_and_the_current_time(spark):
    """Issued ids are random UUIDs on request, else the same for the same key; a missing time is now."""
    import re
    rows = spark.createDataFrame([(i, 7, "ACTIVE", dt.datetime(2024, 1, 1)) for i in range(50)], "session_id long, user_id long, status string, created_at timestamp_ntz")
    ids = [[r.correlation_id for r in sessions.issue_tokens(rows, fixtures.QR_SECRET, random_ids=x).collect()] for x in (True, True, False, False)]
    assert len(set(ids[0] + ids[1])) == 100 and ids[2] == ids[3] and len(set(ids[2])) == 50
    assert all(re.fullmatch(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", x) for x in ids[0] + ids[2])
    live = spark.createDataFrame([("old", "ACTIVE", dt.datetime(2020, 1, 1)), ("new", "ACTIVE", dt.datetime(2999, 1, 1))], "session_id string, status string, expires_at timestamp_ntz")
    assert [r.session_id for r in sessions.expired_sessions(live).collect()] == ["old"]
