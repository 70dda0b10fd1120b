"""Properties: the two-level scans equal plain windows; folds equal
sequential replays; stream results equal batch results."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from basketry.operators import carts
from basketry.operators.scan import prefix_scan, prev_value
from basketry.sources import fixtures
from basketry.sources.tables import Views
from conftest import SF_SMALL


def test_prefix_scan_equals_window(spark):
    rnd = random.Random(7)
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    rows = [(i, base + dt.timedelta(minutes=rnd.randint(0, 5000)), rnd.choice("ab"), rnd.choice([-1, 1, 2]))
            for i in range(600)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, k string, v int")
    got = prefix_scan(df, ["k"], "ts", "id", "v", "s", bucket_us=3_600_000_000, with_min=True)
    w = Window.partitionBy("k").orderBy("ts", "id")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    exp = (df.withColumn("s", F.sum("v").over(run))
             .withColumn("s_min", F.least(F.lit(0), F.min("s").over(run)))
             .withColumn("s_min_before", F.least(F.lit(0), F.coalesce(
                 F.min("s").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))))
    a = sorted(tuple(r) for r in got.select("id", "s", "s_min", "s_min_before").collect())
    b = sorted(tuple(r) for r in exp.select("id", "s", "s_min", "s_min_before").collect())
    assert a == b
    lag = prev_value(df, ["k"], "ts", "id", ["v"])
    exp_lag = df.withColumn("prev_v", F.lag("v").over(w))
    assert sorted(tuple(r) for r in lag.select("id", "prev_v").collect()) == \
        sorted(tuple(r) for r in exp_lag.select("id", "prev_v").collect())


def test_running_quantity_equals_sequential_fold(spark):
    ev = Views(spark, SF_SMALL).cart_events
    got = {r["event_id"]: (r["quantity"], r["rejected"]) for r in carts.cart_running_quantity(ev).collect()}
    rows = sorted(ev.where(F.col("kind").isin("ADD", "REMOVE", "CLEAR")).collect(),
                  key=lambda r: (r["session_id"], r["event_time"], r["event_id"]))
    cart: dict = {}
    exp = {}
    for r in rows:
        s = r["session_id"]
        if r["kind"] == "CLEAR":
            cart[s] = {}
            continue
        lines = cart.setdefault(s, {})
        q = lines.get(r["barcode"], 0)
        if r["kind"] == "ADD":
            q += 1
            rej = False
        else:
            rej = q == 0
            q = max(0, q - 1)
        lines[r["barcode"]] = q
        exp[r["event_id"]] = (q, rej)
    assert got == exp
    assert all(q >= 0 for q, _ in got.values())


def test_streams_do_not_depend_on_batches_order_or_restarts(spark):
    """Rows out of order across micro-batches, a row that is too late, and a restart in between."""
    import datetime as dt

    from basketry.streaming import queries as st
    t0 = dt.datetime(2024, 1, 1, 10)
    m = lambda minutes: t0 + dt.timedelta(minutes=minutes)
    schema = "event_id long, event_time timestamp, session_id long, barcode string, kind string, price decimal(19,4)"
    first = [(1, m(2), 1, "a", "ADD", 1), (2, m(10), 2, "b", "ADD", 2), (3, m(20), 2, "b", "ADD", 3)]
    second = [(4, m(1), 1, "a", "REMOVE", None), (5, m(25), 2, "b", "REMOVE", None), (6, m(600), 3, "z", "ADD", 1)]
    third = [(7, m(5), 1, "a", "ADD", 9), (8, m(601), 3, "z", "ADD", 1), (9, m(1600), 4, "y", "ADD", 1)]   # 7 is too late
    home = st.stream_home(spark, "restarts")
    read = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
    got = None
    for rows in (first, second, third):
        st.land(spark.createDataFrame([(*r[:5], None if r[5] is None else __import__("decimal").Decimal(r[5])) for r in rows], schema),
                f"{home}/in", files=1)
        got = st.cart_state_of(spark, read.json(f"{home}/in"), home)
    # the remove at minute 1 comes before the add at minute 2 and is refused; carts 1 and 2 end after a day
    assert [(r["session_id"], r["barcode"], r["quantity"]) for r in got.collect()] == [(3, "z", 2)]
    zeros = spark.read.parquet(f"{home}/out").where("quantity = 0").select("session_id", "barcode").distinct().collect()
    assert {tuple(r) for r in zeros} == {(1, "a"), (2, "b")}
    seen = {(r["session_id"], r["barcode"], r["quantity"]) for r in spark.read.parquet(f"{home}/out").collect()}
    assert (1, "a", 1) in seen and (2, "b", 1) in seen and (1, "a", 2) not in seen


def test_a_deep_tree_and_a_cycle(spark):
    import pytest

    from basketry.operators.catalog import category_tree
    rows = [(str(i), str(i - 1) if i else None, f"n{i}") for i in range(70)]
    got = {r["node_id"]: r for r in category_tree(spark, spark.createDataFrame(rows, "node_id string, parent_id string, name string")).collect()}
    assert len(got) == 70 and got["69"]["depth"] == 69 and got["69"]["path"].startswith("n0/n1/") and got["0"]["depth"] == 0
    with pytest.raises(ValueError, match="cycle"):
        category_tree(spark, spark.createDataFrame([("a", "b", "a"), ("b", "a", "b")], "node_id string, parent_id string, name string")).collect()


def test_replay_never_leaves_terminal_and_tokens_used_once(spark):
    from basketry.operators import sessions
    v = Views(spark, SF_SMALL)
    r = sessions.session_replay(v.session_log)
    bad = r.where(F.col("from_state").isin("COMPLETED", "CANCELLED") & F.col("accepted"))
    assert bad.count() == 0
    h = sessions.gate_history(v.gate_requests, v.gate_tokens, v.gate_sessions, fixtures.QR_SECRET)
    seen = {(r["gate"], r["result"]) for r in h.select("gate", "result").distinct().collect()}
    results = {"ok", "not_found", "not_active", "expired", "bad_signature"}
    assert seen == {("entry", x) for x in results | {"illegal_transition"}} | {("exit", x) for x in results | {"not_completed"}}
    admitted = sessions.gate_entry(h).where("token_used").groupBy("session_id").count()
    assert admitted.where("count > 1").count() == 0
    g = sessions.gate_exit(h)
    used = g.where("token_used").groupBy("correlation_id").count().where("count > 1")
    assert used.count() == 0
