"""Sign-up conflicts against the service's own order: random batches, long chains, hot keys."""

import random

import pytest

from basketry.operators import access

SCHEMA = "request_id long, email string, username string, password string"


def simulate(rows, users):
    emails, names, out = {u[1] for u in users}, {u[2] for u in users}, {}
    for rid, email, name, password in sorted(rows):
        if "@" not in email or len(name) < 3 or len(password) < 8:
            out[rid] = "invalid"
        elif email in emails:
            out[rid] = "email_taken"
        elif name in names:
            out[rid] = "username_taken"
        else:
            out[rid] = "registered"
            emails.add(email)
            names.add(name)
    return out


def run(spark, rows, users=((1, "old@x.org", "olduser"),)):
    u = spark.createDataFrame(list(users), "id long, email string, username string")
    out = access.registration_outcomes(spark, spark.createDataFrame(rows, SCHEMA), u).collect()
    assert len(out) == len(rows)
    assert {r.request_id: r.outcome for r in out} == simulate(rows, users)


@pytest.mark.parametrize("seed", range(3))
def test_random_batches(spark, seed):
    rng = random.Random(seed)
    n = 160
    rows = [(i, rng.choice(["old@x.org", "bad", "hot@x.org", *[f"e{rng.randrange(n // 3)}@x.org"] * 9]),
             rng.choice(["olduser", "ab", *[f"user{rng.randrange(n // 3)}"] * 9]), "password") for i in range(n)]
    run(spark, rows)


def test_a_chain_of_a_thousand_settles_in_log_many_steps(spark, monkeypatch):
    """Each row shares one key with the row before it and the other with the next; ids are shuffled among other rows."""
    rows = [(i, f"e{(i + 1) // 2}@x.org", f"user{i // 2}", "password") for i in range(1000)]
    rows += [(5000 + i, "hot@x.org", f"lone{i}", "password") for i in range(300)]
    steps = []
    real = access.materialize
    monkeypatch.setattr(access, "materialize", lambda d: steps.append(1) or real(d))
    run(spark, rows)
    assert len(steps) <= 20


def test_no_rows(spark):
    users = spark.createDataFrame([(1, "a@x.org", "abc")], "id long, email string, username string")
    assert access.registration_outcomes(spark, spark.createDataFrame([], SCHEMA), users).collect() == []
