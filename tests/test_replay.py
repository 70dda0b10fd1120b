"""Replay by composed state maps against a sequential fold: any edge table, null keys, hot keys over many batches."""

import datetime as dt
import random

import pytest

from basketry.operators import sessions
from basketry.operators.replay import replay

T0 = dt.datetime(2024, 5, 1)
SCHEMA = "event_id long, event_time timestamp_ntz, k string, cmd string, extra int"


def fold(rows, states, edges):
    at, out = {}, {}
    for e, t, k, cmd, _ in sorted(rows, key=lambda r: (r[1] or dt.datetime(1, 1, 1), r[0])):
        now = at.get(k, states[0])
        ok = (now, cmd) in edges
        at[k] = cmd if ok else now
        out[e] = (now, ok, at[k])
    return {e: (*v, at[k]) for (e, _, k, _, _) in rows for v in [out[e]]}


@pytest.mark.parametrize("seed, n", [(1, 200), (2, 15_000)])
def test_any_edge_table(spark, seed, n):
    rng = random.Random(seed)
    states = [f"S{i}" for i in range(rng.choice([2, 6, 15]))]
    edges = [(a, b) for a in states for b in states if rng.random() < 0.4]  # cycles and loops
    rows = [(i, None if rng.random() < 0.01 else T0 + dt.timedelta(seconds=rng.randint(0, 9000 if n > 1000 else 600_000)),
             rng.choice(["hot", "hot", "hot", "b", "c", None]), rng.choice([*states, "no such state", None]), i % 7) for i in range(n)]
    want = fold(rows, states, set(edges))
    frame = spark.createDataFrame(rows, SCHEMA)
    for bucket in (3_600_000_000, 10**15):
        got = replay(frame, "k", "cmd", states, edges, bucket_us=bucket).collect()
        assert len(got) == n
        assert {r.event_id: (r.from_state, r.accepted, r.to_state, r.final_state) for r in got} == want
        assert all(r.extra == r.event_id % 7 for r in got)


def test_session_queries_read_one_pass(spark):
    """Of an empty log nothing comes; stuck payments are the last state of a replay."""
    log = spark.createDataFrame([(1, T0, 7, "s", "ACTIVE"), (2, T0, 7, "s", "PAYING"), (3, T0, 8, "t", "ACTIVE")],
                                "event_id long, event_time timestamp_ntz, user_id long, session_id string, target string")
    assert [(r.session_id, r.paying_since) for r in sessions.stuck_payments(log, "2024-05-01 00:16:00").collect()] == [("s", T0)]
    assert sessions.stuck_payments(log, "2024-05-01 00:15:00").collect() == []
    assert sessions.session_replay(log.where("false")).collect() == []
