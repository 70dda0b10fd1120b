"""Declared constraints: every one can fail, tables are scanned once, nulls never equal, cascades reach the fixpoint."""

import pytest
from conftest import SF_CHECK

from basketry.operators import quality
from basketry.schemas import DOMAINS, FOREIGN_KEYS, UNIQUE_KEYS
from basketry.sources.relations import relations


@pytest.fixture(scope="module")
def tables(spark):
    return relations(spark, SF_CHECK)


def test_every_constraint_fails_somewhere(tables):
    assert {r.constraint_name for r in quality.unique_violations(tables).collect()} == {n for named in UNIQUE_KEYS.values() for n in named}
    assert {r.fk_name for r in quality.fk_orphans(tables).collect()} == {f"{t}.{c}" for t, c, *_ in FOREIGN_KEYS}
    rules = set()
    for t, columns in DOMAINS.items():
        for c, (required, longest, allowed, least) in columns.items():
            rules |= {(t, f"{c}_{k}") for k, on in (("not_null", required), (f"len_{longest}", longest), ("enum", allowed), ("range", least is not None)) if on}
    assert {(r.table_name, r.rule) for r in quality.domain_violations(tables).select("table_name", "rule").distinct().collect()} == rules


@pytest.mark.parametrize("check, used", [
    (quality.unique_violations, set(UNIQUE_KEYS)), (quality.domain_violations, set(DOMAINS)),
    (quality.fk_orphans, {x for f in FOREIGN_KEYS for x in (f[0], f[2])})])
def test_each_table_is_scanned_once(tables, check, used):
    plan = check(tables)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == len(used)


def test_nulls_equal_nothing_and_keys_are_not_mixed_up(spark):
    t = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "x"), (None, "x"), ("q", "r"), ("q", "r")], "m string, n string")
    got = quality.unique_violations({"t": t}, {"t": {"t.m_n": ["m", "n"]}}).collect()
    assert [(r.key_value, r.n) for r in got] == [("q|r", 2)]


def test_a_cascade_follows_chains_and_cycles(spark):
    """1 <- 2 <- ... <- 12 in one table, a cycle 20 <-> 21 under 12, and leaves in another table."""
    nodes = spark.createDataFrame([(1, None), *[(i, i - 1) for i in range(2, 13)], (20, 21), (21, 20), (22, 12), (30, None)], "id long, up long")
    leaves = spark.createDataFrame([(100, 12), (101, 30), (102, None), (103, 22), (103, 22)], "id long, node long")
    fks = [("nodes", "up", "nodes", "id", True), ("leaves", "node", "nodes", "id", True)]
    got = sorted((r.table_name, int(r.row_key)) for r in quality.cascade({"nodes": nodes, "leaves": leaves}, {"nodes": nodes.where("id = 3")}, fks).collect())
    assert got == sorted([*[("nodes", i) for i in [*range(3, 13), 22]], ("leaves", 100), ("leaves", 103), ("leaves", 103)])
    assert sorted(int(r.row_key) for r in quality.cascade({"nodes": nodes}, {"nodes": nodes.where("id = 20")}, fks[:1]).collect()) == [20, 21]
    assert quality.cascade({"nodes": nodes, "leaves": leaves}, {"nodes": nodes.where("id = 99")}, fks).collect() == []
