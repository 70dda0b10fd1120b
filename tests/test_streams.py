"""Streams: bounded state, true puts, a snapshot whose parts are rewritten only where a batch falls."""

import datetime as dt
import glob
import os
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketry.operators import carts
from basketry.streaming import queries as st

T0 = dt.datetime(2024, 1, 1, 10)
EVENTS = "event_id long, event_time timestamp_ntz, session_id long, barcode string, kind string, price decimal(19,4)"
BATCH = "event_id long, event_time timestamp_ntz, session_id long, barcode string, kind string, quantity long, price decimal(19,4)"


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def batch(spark, rows):
    return spark.createDataFrame([(e, at(m), s, b, k, q, None if p is None else Decimal(p)) for e, m, s, b, k, q, p in rows], BATCH)


def snapshot(spark, out):
    return {(r.session_id, r.barcode, r.quantity) for r in st.read_snapshot(spark, out).where("barcode is not null and quantity > 0").collect()}


def test_a_batch_rewrites_only_its_parts_of_the_snapshot(spark):
    out = f"{st.stream_home(spark, 'parts')}/out"
    fn = st._snapshot_sink(out, 32)
    fn(batch(spark, [(i, i, i, "a", "ADD", 1, 2) for i in range(200)]), 0)
    assert len(snapshot(spark, out)) == 200
    first = {p: os.path.getmtime(p) for p in glob.glob(f"{out.removeprefix('file:')}/data/v=0/part=*/*.parquet")}
    fn(batch(spark, [(900, 900, 7, "a", "ADD", 2, 2), (901, 901, 7, "b", "ADD", 1, 3)]), 1)
    parts = glob.glob(f"{out.removeprefix('file:')}/data/v=1/part=*")
    assert len(parts) == 1 and {p: os.path.getmtime(p) for p in first} == first
    assert {x for x in snapshot(spark, out) if x[0] == 7} == {(7, "a", 2), (7, "b", 1)} and len(snapshot(spark, out)) == 201
    fn(batch(spark, [(902, 902, 7, "a", "ADD", 9, 2)]), 1)  # the batch again: nothing happens
    assert (7, "a", 2) in snapshot(spark, out)


def test_late_rows_and_clears_in_the_snapshot(spark):
    out = f"{st.stream_home(spark, 'late')}/out"
    fn = st._snapshot_sink(out, 4)
    fn(batch(spark, [(10, 10, 1, "a", "ADD", 3, 2), (11, 11, 2, "b", "ADD", 1, 2)]), 0)
    fn(batch(spark, [(5, 5, 1, "a", "ADD", 2, 2), (20, 20, 2, None, "CLEAR", None, None)]), 1)  # an older state, a clear
    assert snapshot(spark, out) == {(1, "a", 3)}
    fn(batch(spark, [(15, 15, 2, "c", "ADD", 1, 2), (21, 21, 2, "b", "ADD", 1, 2), (22, 22, 1, "a", "REMOVE", 0, None), (1, 1, None, "x", "ADD", 1, 1)]), 2)
    assert snapshot(spark, out) == {(2, "b", 1)}
    fn(batch(spark, []), 3)
    assert snapshot(spark, out) == {(2, "b", 1)}


def test_a_part_that_cannot_be_read_raises(spark):
    home = st.stream_home(spark, "broken")
    fn = st._snapshot_sink(f"{home}/out")
    fn(batch(spark, [(1, 1, 1, "a", "ADD", 1, 1)]), 0)
    spark.createDataFrame([("7",)], "value string").write.mode("overwrite").text(f"{home}/out/_latest")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        fn(batch(spark, [(2, 2, 1, "a", "ADD", 1, 1)]), 8)


def state_rows(spark, home):
    return spark.read.format("statestore").load(f"{home}/ckpt").count()


def test_the_state_of_finished_sessions_leaves(spark):
    """Sessions of a first day are forgotten once the watermark is past their life; decisions until then hold."""
    schema = "event_id long, event_time timestamp, user_id long, session_id string, target string"
    home = st.stream_home(spark, "ttl")
    read = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
    first = [(i, at(i % 50), 1, f"s{i}", "ACTIVE") for i in range(60)] + [(100 + i, at(60 + i % 50), 1, f"s{i}", "CANCELLED") for i in range(60)]
    second = [(900, at(300), 1, "s1", "ACTIVE"), (901, at(302), 1, "late", "ACTIVE")]
    third = [(902, at(60 * 80), 1, "end", "ACTIVE")]
    counts = []
    for rows in (first, second, third):
        st.land(spark.createDataFrame(rows, schema), f"{home}/in", files=1)
        out = st.session_state_of(spark, read.json(f"{home}/in"), home, 2 * st.DAY_US)
        counts.append(state_rows(spark, home))
    got = {r.event_id: (r.from_state, r.accepted) for r in out.collect()}
    assert got[900] == ("CANCELLED", False) and got[901] == ("CREATED", True)
    assert counts[0] == 60 and counts[2] <= 1


def test_expiry_streams_true_puts(spark):
    """Removes to 0 do not refresh, removes above 0 do, clears end the map; the batch view says the same."""
    day = 24 * 60
    rows = [(1, 0, 1, "a", "ADD"), (2, 60, 1, "a", "ADD"), (3, 120, 1, "a", "REMOVE"), (4, 180, 1, "a", "REMOVE"), (5, 240, 1, "a", "REMOVE"),
            (6, 0, 2, "b", "ADD"), (7, 30, 2, "c", "ADD"), (8, 40, 2, None, "CLEAR"), (9, 50, 2, "c", "ADD"),
            (10, 0, 3, "d", "ADD"), (11, day, 3, "d", "REMOVE"), (12, day + 1, 3, "d", "ADD"), (13, 10, 4, None, "ADD"), (99, 20 * day, 9, "z", "ADD")]
    frame = spark.createDataFrame([(e, at(m), s, b, k, Decimal(1)) for e, m, s, b, k in rows], EVENTS)
    got = {(r.session_id, r.first_put, r.expires_at, r.puts) for r in st.stream_cart_expiry(spark, frame).collect()}
    end = lambda m: at(m + day)
    assert got == {(1, at(0), end(120), 3), (2, at(0), end(30), 2), (2, at(50), end(50), 1), (3, at(0), end(0), 1), (3, at(day + 1), end(day + 1), 1), (4, at(10), end(10), 1)}
    batch_view = {(r.session_id, r.first_put, r.expires_at, r.puts) for r in carts.cart_ttl_view(frame).collect()}
    assert got == {x for x in batch_view if x[0] != 9}


def test_landing_follows_the_size(spark, monkeypatch):
    monkeypatch.setattr(st, "ROWS_PER_FILE", 20)
    d = spark.range(300).select(F.timestamp_add("SECOND", F.col("id").cast("int"), F.lit(T0)).alias("event_time"), "id")
    home = st.stream_home(spark, "land")
    assert st.land(d, f"{home}/in") == 5
    assert len(glob.glob(f"{home.removeprefix('file:')}/in/*.json")) >= 13
    assert spark.read.json(f"{home}/in").count() == 300


def test_a_hot_cart_with_many_held_rows(spark):
    """100,000 rows of one cart arrive before the watermark moves; a batch later they are all in, and the state is small."""
    schema = "event_id long, event_time timestamp, session_id long, barcode string, kind string, price decimal(19,4)"
    n = 100_000
    rows = spark.range(n).select(
        F.col("id").alias("event_id"), F.timestamp_add("MICROSECOND", F.col("id") * 30_000, F.lit(T0)).cast("timestamp").alias("event_time"),
        F.lit(1).cast("long").alias("session_id"), F.concat(F.lit("b"), (F.col("id") % 50).cast("string")).alias("barcode"),
        F.when(F.floor(F.col("id") / 50) % 3 == 2, "REMOVE").otherwise("ADD").alias("kind"), F.lit(1).cast("decimal(19,4)").alias("price"))
    home = st.stream_home(spark, "hot")
    read = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
    st.land(rows, f"{home}/in", files=1)
    assert st.cart_state_of(spark, read.json(f"{home}/in"), home).count() == 0  # all within the hour that rows may be late
    st.land(spark.createDataFrame([(n, at(600), 2, "z", "ADD", Decimal(1))], schema), f"{home}/in", files=1)
    got = st.cart_state_of(spark, read.json(f"{home}/in"), home)
    want = sum(-1 if i % 3 == 2 else 1 for i in range(n // 50))
    assert {(r.session_id, r.barcode, r.quantity) for r in got.collect()} == {(1, f"b{i}", want) for i in range(50)}


def test_many_keys_share_a_bounded_number_of_states(spark, monkeypatch):
    """A state function is called for a group of keys, not for each of them; what each key gets stays its own."""
    monkeypatch.setattr(st, "STATE_PARTS", 8)
    homes, home_of = [], st.stream_home
    monkeypatch.setattr(st, "stream_home", lambda spark, name: (homes.append(home_of(spark, name)), homes[-1])[1])
    lookups = [(1000 * b + m, f"b{b}", at(m)) for b in range(200) for m in (0, 30, 70)] + [(9, None, at(5)), (10, "no time", None), (None, "b0", at(1)), (99, "end", at(600))]
    got = {(r.request_id, r.barcode) for r in st.stream_lookup_dedup(spark, spark.createDataFrame(lookups, "request_id long, barcode string, requested_at timestamp")).collect()}
    assert got == {(1000 * b + m, f"b{b}") for b in range(200) for m in (0, 70)} | {(9, None)}
    rows = [(10 * s + k, at(k), s, "a", kind, Decimal(s)) for s in range(100, 300) for k, kind in enumerate(("ADD", "ADD", "REMOVE"))]
    rows += [(1, at(3), 101, None, "CLEAR", None), (2, at(4), None, "n", "ADD", None), (3, None, 102, "a", "ADD", None), (4, at(600), 5, "z", "ADD", Decimal(1))]
    events = spark.createDataFrame(rows, EVENTS)
    carts_now = {(r.session_id, r.barcode, r.quantity, r.price) for r in st.stream_cart_state(spark, events).collect()}
    assert carts_now == {(s, "a", 1, Decimal(s)) for s in range(100, 300) if s != 101} | {(None, "n", 1, None)}
    assert st.stream_cart_expiry(spark, events).where("session_id = 101").count() == 1
    counts = [state_rows(spark, homes[0]), state_rows(spark, homes[2]),
              spark.read.format("statestore").option("stateVarName", "timer").load(f"{homes[1]}/ckpt").count()]
    assert all(c <= 8 for c in counts)


def test_a_stream_has_no_more_state_stores_than_cores(spark, tmp_path, monkeypatch):
    name, asked = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(st, "stream_home", lambda spark, name: f"{tmp_path}/{name}")
    rows = [(i, "help.requested", str(i % 5), f'{{"sessionId":"{i % 5}","aisleNumber":{i % 3},"timestamp":"{at(i).isoformat()}Z"}}') for i in range(240)]
    spark.conf.set(name, "64")
    try:
        got = st.stream_help_by_aisle(spark, spark.createDataFrame(rows, st.FEED_SCHEMA), slide="5 minutes").collect()
        assert spark.conf.get(name) == "64"
    finally:
        spark.conf.set(name, asked)
    want = Counter()
    for i in range(240):
        for k in range(3):
            begin = i // 5 * 5 - 5 * k
            if begin + 15 <= 239 - 30:
                want[i % 3, at(begin)] += 1
    assert {(r.aisle_number, r.window_start): r.requests for r in got} == want and len(got) == len(want)
    assert len(glob.glob(f"{tmp_path}/help_by_aisle/ckpt/state/0/[0-9]*")) == max(st.MIN_STORES, spark.sparkContext.defaultParallelism)
