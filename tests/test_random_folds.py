"""Closed forms against direct simulations of the service logic on random
histories (with equal timestamps, tokens revoked from the start, expiry at
the boundary, logouts before and after rotations)."""

import datetime as dt
import random

from basketry.operators import access, sessions, tokens
from basketry.schemas import SESSION_EDGES

T0 = dt.datetime(2024, 5, 1)
ALLOWED = {}
for f, t in SESSION_EDGES:
    ALLOWED.setdefault(f, set()).add(t)


def test_replay_matches_simulation(spark):
    rnd = random.Random(11)
    rows = []
    eid = 0
    for s in range(40):
        for _ in range(rnd.randint(0, 9)):
            eid += 1
            rows.append((eid, T0 + dt.timedelta(minutes=rnd.randint(0, 6)), 1, f"s{s}",
                         rnd.choice(["ACTIVE", "PAYING", "COMPLETED", "CANCELLED"])))
    log = spark.createDataFrame(rows, "event_id long, event_time timestamp_ntz, user_id long, session_id string, "
                                      "target string")
    got = {r["event_id"]: (r["from_state"], r["accepted"], r["to_state"], r["final_state"])
           for r in sessions.session_replay(log).collect()}
    exp = {}
    by = {}
    for r in sorted(rows, key=lambda r: (r[3], r[1], r[0])):
        by.setdefault(r[3], []).append(r)
    for s, rs in by.items():
        cur = "CREATED"
        out = []
        for r in rs:
            ok = r[4] in ALLOWED.get(cur, set())
            nxt = r[4] if ok else cur
            out.append((r[0], cur, ok, nxt))
            cur = nxt
        for e, f, ok, n in out:
            exp[e] = (f, ok, n, cur)
    assert got == exp


def test_refresh_history_matches_simulation(spark):
    rnd = random.Random(5)
    toks, log = [], []
    eid = 0
    for fam in range(30):
        names = [f"{fam}:{k}" for k in range(rnd.randint(1, 4))]
        for n in names:
            created = T0 + dt.timedelta(hours=rnd.randint(0, 5))
            toks.append((n, fam, fam, created, created + dt.timedelta(hours=rnd.choice([1, 3, 48])),
                         rnd.random() < 0.2, None))
        for _ in range(rnd.randint(0, 8)):
            eid += 1
            tok = rnd.choice(names + [f"{fam}:x"])
            log.append((eid, T0 + dt.timedelta(hours=rnd.randint(0, 6)), fam, tok,
                        "LOGOUT" if rnd.random() < 0.15 else "PRESENT"))
    # exact boundary: presented exactly at expiry is still valid
    toks.append(("edge", 99, 99, T0, T0 + dt.timedelta(hours=2), False, None))
    log.append((10_000, T0 + dt.timedelta(hours=2), 99, "edge", "PRESENT"))
    tdf = spark.createDataFrame(toks, "token string, family_id long, user_id long, created_at timestamp_ntz, "
                                      "expires_at timestamp_ntz, revoked boolean, revocation_reason string")
    ldf = spark.createDataFrame(log, "event_id long, event_time timestamp_ntz, family_id long, token string, "
                                     "kind string")
    got = {r["event_id"]: r["outcome"] for r in tokens.refresh_outcomes(ldf, tdf).collect()}
    stored = {t[0]: {"family": t[1], "expires": t[4], "revoked": t[5]} for t in toks}
    exp = {}
    for e, ts, _f, tok, kind in sorted(log, key=lambda r: (r[1], r[0])):
        row = stored.get(tok)
        if kind == "LOGOUT":
            if row is not None:
                for other in stored.values():
                    if other["family"] == row["family"]:
                        other["revoked"] = True
            continue
        if row is None:
            exp[e] = "invalid"
        elif row["revoked"]:
            exp[e] = "reuse"
            for other in stored.values():
                if other["family"] == row["family"]:
                    other["revoked"] = True
        elif row["expires"] < ts:
            exp[e] = "expired"
        else:
            exp[e] = "rotate"
            row["revoked"] = True
    assert got == exp
    assert exp[10_000] == "rotate"


def test_route_prefix_edges(spark):
    rows = [(1, "/api/products"), (2, "/api/productsX/1"), (3, "/ws"), (4, "/ws/x/y"), (5, "/api/gate/entry"),
            (6, "/"), (7, "/api"), (8, "/api/auth/login")]
    df = spark.createDataFrame(rows, "event_id long, path string")
    got = {r["event_id"]: r["route_id"] for r in access.route_requests(spark, df).collect()}
    assert got == {1: "product-service", 2: "unrouted", 3: "cart-service-websocket", 4: "cart-service-websocket",
                   5: "session-service-gate", 6: "unrouted", 7: "unrouted", 8: "auth-service"}
