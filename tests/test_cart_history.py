"""The one-scan cart fold and the as-of lookup against sequential folds, null keys included."""

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest

from basketry.operators import cart_history, carts
from basketry.operators.asof import holding

SCHEMA = "event_id long, event_time timestamp_ntz, session_id long, barcode string, kind string, price decimal(19,4)"
T0 = dt.datetime(2024, 1, 1)
DAY = dt.timedelta(hours=24)


def events_of(seed, n=700, nulls=True):
    """A hot session, ties in time, gaps of days, clears; nulls in every key if asked for."""
    rng = random.Random(seed)
    out, t = [], T0
    for i in range(n):
        t += dt.timedelta(minutes=rng.choice([0, 0, 1, 7, 45, 200])) + (dt.timedelta(hours=30) if rng.random() < 0.02 else dt.timedelta())
        out.append((i, None if nulls and rng.random() < 0.03 else t, rng.choice([1, 1, 1, 2, None] if nulls else [1, 1, 1, 2]),
                    rng.choice(["a", "b", "c", None] if nulls else ["a", "b", "c"]),
                    rng.choice(["ADD"] * 9 + ["REMOVE"] * 9 + ["CLEAR", "HELP"] + ([None] if nulls else [])),
                    None if nulls and rng.random() < 0.05 else Decimal(rng.randint(1, 99)).quantize(Decimal("0.0001"))))
    return out


def fold(rows):
    """event_id -> (epoch, quantity, rejected, life, line price, items, total), one event after the other."""
    first = dt.datetime(1, 1, 1)
    out, carts_, epochs, lives = {}, defaultdict(dict), defaultdict(int), defaultdict(int)
    totals = defaultdict(lambda: [0, Decimal(0)])
    for e, t, s, b, kind, price in sorted(rows, key=lambda r: (r[1] or first, r[0])):
        if kind not in ("ADD", "REMOVE", "CLEAR"):
            continue
        cart = carts_[s]
        if kind == "CLEAR":
            cart.clear()
            epochs[s] += 1
            totals[s] = [0, Decimal(0)]
            out[e] = (epochs[s], None, False, None, None, 0, Decimal(0))
            continue
        key = (s, b, epochs[s])
        q, p, rejected = (*cart.get(b, (0, None)), False)
        if kind == "ADD":
            if q == 0:
                lives[key] += 1
                p = price
            q, sign = q + 1, 1
        else:
            rejected, q, sign = q == 0, max(0, q - 1), -1
            if rejected:
                p, sign = out_price.get(key), 0
        totals[s][0] += sign
        totals[s][1] += sign * (p or 0)
        cart[b] = (q, p)
        out_price[key] = p
        if q == 0:
            del cart[b]
        out[e] = (epochs[s], q, rejected, lives[key], p, totals[s][0], totals[s][1])
    return out


out_price: dict = {}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fold_equals_sequential_fold_with_null_keys(spark, seed):
    out_price.clear()
    rows = events_of(seed)
    want = fold(rows)
    frame = spark.createDataFrame(rows, SCHEMA)
    for bucket in (3_600_000_000, 24 * 3_600_000_000, 60_000_000):
        got = {r.event_id: (r.epoch, r.quantity, r.rejected, r.life, r.line_price, r.item_count, r.total)
               for r in cart_history.history(frame, bucket, with_clears=True).collect()}
        assert got == want
    w1 = {r.event_id: (r.epoch, r.quantity, r.rejected) for r in carts.cart_running_quantity(frame).collect()}
    assert w1 == {e: v[:3] for e, v in want.items() if v[1] is not None}


def test_no_row_is_lost_for_a_null_key(spark):
    """One normal row, and one without a barcode, a session and a time each."""
    p = Decimal("1.0000")
    rows = [(1, T0, 1, "a", "ADD", p), (2, T0, 1, None, "ADD", p), (3, T0, None, "a", "ADD", p), (4, None, 1, "a", "ADD", p)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {r.event_id: r.quantity for r in carts.cart_running_quantity(frame).collect()}
    assert got == {1: 2, 2: 1, 3: 1, 4: 1}
    for q in (carts.price_at_addition, carts.cart_change_feed):
        assert {r.event_id for r in q(frame).collect()} == {1, 2, 3, 4}
    assert {(r.session_id, r.puts) for r in carts.cart_ttl_view(frame).collect()} == {(1, 1), (1, 2), (None, 1)}


def state_at(rows, session, at):
    """(cached lines, stored lines, expiry) of a session at a time: puts and deletes one after the other."""
    cache, store, end, prices = {}, {}, None, {}
    for e, t, s, b, kind, price in sorted(rows, key=lambda r: (r[1], r[0])):
        if s != session or t > at or kind not in ("ADD", "REMOVE", "CLEAR"):
            continue
        if end is not None and t >= end:
            cache, end = {}, None
        if kind == "CLEAR":
            cache, store, end = {}, {}, None
        elif kind == "ADD":
            q = store.get(b, 0)
            if not q:
                prices[b] = price
            store[b] = q + 1
            cache[b], end = (q + 1, prices[b]), t + DAY
        elif store.get(b, 0) > 1:
            store[b] -= 1
            cache[b], end = (store[b], prices[b]), t + DAY
        elif b in store:
            del store[b]
            cache.pop(b, None)
    if end is not None and at >= end:
        cache, end = {}, None
    return cache, {b: (q, prices[b]) for b, q in store.items()}, end


@pytest.mark.parametrize("seed", [4, 5])
def test_cart_as_of_any_time(spark, seed):
    rows = events_of(seed, nulls=False)
    rng = random.Random(seed)
    times = [r[1] for r in rows]
    asked = [(i, rng.choice([1, 2, 3]), rng.choice([rng.choice(times), rng.choice(times) + DAY, rng.choice(times) + dt.timedelta(minutes=rng.randint(-3000, 3000))]))
             for i in range(300)] + [(1000, None, times[5]), (1001, 1, None)]
    events, requests = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(asked, "request_id long, session_id long, as_of timestamp_ntz")
    want_cache, want_read = set(), set()
    for i, s, at in asked:
        if s is None or at is None:
            continue
        cache, store, end = state_at(rows, s, at)
        want_cache |= {(i, b, q, p, end) for b, (q, p) in cache.items()}
        lines, source = (cache, "cache") if cache else (store, "store")
        want_read |= {(i, b, q, p, source) for b, (q, p) in lines.items()}
    assert {x[4] for x in want_read} == {"cache", "store"}
    got = carts.cart_as_of(requests, events).collect()
    assert len(got) == len(want_cache) and {(r.request_id, r.barcode, r.quantity, r.price, r.expires_at) for r in got} == want_cache
    got = carts.cart_read_through_as_of(requests, events).collect()
    assert len(got) == len(want_read) and {(r.request_id, r.barcode, r.quantity, r.price, r.source) for r in got} == want_read
    assert carts.cart_as_of(requests.where("false"), events).collect() == []


def test_cart_as_of_looks_up_its_lines_once(spark):
    """The cached lines are stored: the rest of the plan expands only the requests and puts of their end."""
    events = spark.createDataFrame(events_of(6, 60, nulls=False), SCHEMA)
    requests = spark.createDataFrame([(1, 1, T0 + DAY)], "request_id long, session_id long, as_of timestamp_ntz")
    plan = carts.cart_as_of(requests, events)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 3


def test_short_intervals_have_few_nodes(spark):
    """An interval is not expanded over the levels above its length, though far times are asked for."""
    a = spark.createDataFrame([(1, 1, T0), (2, 1, T0 + 400 * DAY)], "rid long, k long, t timestamp_ntz")
    b = spark.createDataFrame([(1, 1, T0, T0 + dt.timedelta(minutes=5))], "sid long, k long, since timestamp_ntz, until timestamp_ntz")
    met = holding(a, b, ["k"], "t", "since", "until")
    assert [(r.rid, r.sid) for r in met.collect()] == [(1, 1)]
    assert "lambdafunction" not in met._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("granule", [1_000_000, 3_600_000_000, 10**15])
def test_holding_meets_each_pair_once(spark, granule):
    rng = random.Random(8)
    at = lambda: T0 + dt.timedelta(seconds=rng.randint(0, 20_000))
    spans = [(i, rng.choice([1, 2, None]), at(), rng.choice([None, at(), at()])) for i in range(120)] + [(900, 1, None, at()), (901, 1, T0, T0)]
    asked = [(i, rng.choice([1, 2, 3, None]), at()) for i in range(80)] + [(500, 1, None), (501, 1, spans[0][2])]
    a = spark.createDataFrame(asked, "rid long, k long, t timestamp_ntz")
    b = spark.createDataFrame(spans, "sid long, k long, since timestamp_ntz, until timestamp_ntz")
    got = sorted((r.rid, r.sid) for r in holding(a, b, ["k"], "t", "since", "until", granule).collect())
    assert got == sorted((i, j) for i, k, t in asked for j, m, s, u in spans
                         if k is not None and k == m and t is not None and s is not None and s <= t and (u is None or t < u))


def test_the_fold_stores_its_rows_once(spark):
    """One materialisation, and one big exchange of the events before it."""
    stored = []
    real = cart_history.materialize
    cart_history.materialize = lambda d: stored.append(d) or real(d)
    try:
        out = cart_history.history(spark.createDataFrame(events_of(1, 50), SCHEMA), with_clears=True)
        out.collect()
    finally:
        cart_history.materialize = real
    assert len(stored) == 1
    plan = stored[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1
