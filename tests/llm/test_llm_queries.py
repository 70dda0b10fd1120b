"""The registered queries: SQL parity, and the pipeline against a plain version."""

import re
from itertools import combinations

import corpus_pipeline
import pytest
from check import compare
from conftest import SF_SMALL
from llm_frames import groups, no_docs, odd_docs
from test_llm_dedup import plain_fingerprint
from test_llm_text import check_packing

import __spark_entry__ as E
from basketry.llm import oracle, pii, queries


def test_all_are_registered():
    assert sorted(int(re.match(r"op(\d+)_", k).group(1)) for k in queries.QUERIES) == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())
    assert set(oracle.oracle_sql()) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", sorted(oracle.oracle_sql()))
def test_matches_sql(spark, key):
    assert compare(spark, SF_SMALL, [key], verbose=False)[key][0] == "match"


def plain_pipeline(rows, detector):
    """(doc_id, text) after all but the last stage, with loops over pairs."""
    rows = [(d, t) for d, t in rows if any(c.isalpha() for c in t or "")]
    best = {}
    for d, t in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", t)
        best[key] = min(best.get(key, (0, d, t)), (-len(t), d, t))
    rows = sorted((d, t) for _, d, t in best.values())
    fps = [plain_fingerprint(t) for _, t in rows]
    top = groups(len(rows), ((i, j) for i, j in combinations(range(len(rows)), 2) if (fps[i] ^ fps[j]).bit_count() <= 4))
    rows = [r for i, r in enumerate(rows) if top[i] == i]
    return [(d, pii.redacted(t, detector.spans(t)[1])) for d, t in rows]


def test_pipeline_against_plain_version(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    after = docs
    for _, stage in corpus_pipeline.STAGES[:3]:
        after = stage(spark, after, SF_SMALL)
        assert after.columns == docs.columns
    want = plain_pipeline([(r.doc_id, r.text) for r in docs.collect()], pii.train(after))
    used, least = check_packing(want, corpus_pipeline.run(spark, SF_SMALL))
    assert used <= least * 1.05 + 2


def test_stages_take_odd_and_empty_tables(spark):
    for docs in (odd_docs(spark), no_docs(spark)):
        at = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            at = stage(spark, at, SF_SMALL)
            assert at.columns == docs.columns
        out = corpus_pipeline.STAGES[-1][1](spark, at, SF_SMALL)
        assert (out.count() > 0) == (docs.count() > 0)
