"""SimHash, exact, line and embedding dedup against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash
from conftest import SF_SMALL
from llm_frames import groups, no_docs, odd_docs, plain_words

from basketry.llm import common, embeddings, exact, lines, simhash


def plain_fingerprint(text, k=4):
    w = plain_words(text)
    shingles = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)) if h else 0


def check_simhash(rows, out):
    fps = [plain_fingerprint(t) for _, t in rows]
    top = groups(len(rows), ((i, j) for i, j in combinations(range(len(rows)), 2) if (fps[i] ^ fps[j]).bit_count() <= 4))
    least = defaultdict(list)
    for (d, _), g in zip(rows, top):
        least[g].append(d)
    want = Counter((d, f"{f:016x}", min((x for x in least[g] if x is not None), default=None)) for (d, _), f, g in zip(rows, fps, top))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in out.collect()) == want


def test_simhash_small_table(spark):
    docs = common.table(spark, SF_SMALL, "documents")
    check_simhash([(r.doc_id, r.text) for r in docs.collect()], simhash.simhash_dedup(docs))


def test_simhash_odd_rows(spark):
    docs = odd_docs(spark)
    check_simhash([(r.doc_id, r.text) for r in docs.collect()], simhash.simhash_dedup(docs))
    assert simhash.simhash_dedup(no_docs(spark)).collect() == []
    assert simhash.keep_first(docs).columns == docs.columns


def test_every_choice_of_agreeing_bytes_holds_a_listed_set():
    for d in range(1, 8):
        sets = [set(s) for s in simhash.position_sets(d)]
        for rest in combinations(range(8), 8 - d):
            assert any(s <= set(rest) for s in sets), (d, rest)
    assert len(simhash.position_sets(4)) == 20


@pytest.mark.parametrize("limit", [2048, 16])
def test_simhash_links_of_dense_groups(spark, limit):
    """Near fingerprints in crowds; small cells must give the same components."""
    rng = random.Random(5)
    fps = {0}
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(40):
            y = x
            for b in rng.sample(range(64), rng.randint(0, 5)):
                y ^= 1 << b
            fps.add(y)
    fps = sorted(fps)
    frame = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    got = {r.node: r.root for r in common.components(simhash.links(frame, 4, limit)).collect()}
    top = groups(len(fps), ((i, j) for i, j in combinations(range(len(fps)), 2) if (fps[i] ^ fps[j]).bit_count() <= 4))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    by_group = defaultdict(set)
    for s, g in zip(signed, top):
        by_group[g].add(got.get(s, s))
    assert all(len(v) == 1 for v in by_group.values())
    assert len({min(v) for v in by_group.values()}) == len(by_group)


def test_components_of_chains_stars_and_pairs(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(150)] + [(7, 7)]
    nodes = sorted({x for e in edges if e[0] != e[1] for x in e})
    at = {x: i for i, x in enumerate(nodes)}
    top = groups(len(nodes), ((at[a], at[b]) for a, b in edges if a != b))
    got = common.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert Counter((r.node, r.root) for r in got) == Counter((n, nodes[g]) for n, g in zip(nodes, top))


def check_exact(rows, out):
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    same = defaultdict(list)
    for (d, t), n in zip(rows, norm):
        same[n].append((-len(t or ""), d is None, d))
    want = Counter((d, min(same[n], key=lambda x: (x[0], x[1], x[2] or 0))[2], len(same[n]), hashlib.sha256(n.encode()).hexdigest())
                   for (d, _), n in zip(rows, norm))
    got = out.collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len(same) and len({r.text_sha256 for r in kept}) == len(same)
    assert all(r.doc_id == r.keep_id for r in kept)


def test_exact_dedup(spark):
    docs = common.table(spark, SF_SMALL, "documents")
    check_exact([(r.doc_id, r.text) for r in docs.collect()], exact.exact_dedup(docs))
    docs = odd_docs(spark)
    check_exact([(r.doc_id, r.text) for r in docs.collect()], exact.exact_dedup(docs))
    assert exact.exact_dedup(no_docs(spark)).collect() == []
    left = exact.keep_one(docs)
    assert left.columns == docs.columns
    texts = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in left.collect() if r.doc_id is not None]
    assert len(texts) == len(set(texts))


def test_exact_dedup_splits_colliding_fingerprints(spark, monkeypatch):
    """With fingerprints of few bits, the chunkwise comparison must keep different texts apart."""
    rows = [(i, f"{chr(97 + i % 26)}{i % 40}") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = exact.fingerprints
    monkeypatch.setattr(exact, "fingerprints", lambda d, bits=62: whole(d, 3))
    monkeypatch.setattr(exact, "unequal_groups", lambda d, m: m.select(m.fp.alias("h"), "n_bytes").distinct())
    check_exact(rows, exact.exact_dedup(docs))


def test_chunks_that_differ_are_found(spark):
    docs = spark.createDataFrame([(1, "ab"), (2, "ab"), (3, "x" * 200_000), (4, "x" * 200_000)], "doc_id long, text string")
    members = spark.createDataFrame([(i, 0, 0) for i in range(1, 5)], "doc_id long, fp long, n_bytes long")
    assert exact.unequal_groups(docs, members).collect() == []


def test_fingerprints_compose():
    rng = random.Random(2)
    data = rng.randbytes(300_000)
    whole = exact.polynomial(data)
    assert whole[2] == len(data)
    for cut in (1, 65_535, 65_536, 65_537, 200_001):
        assert exact.combine(exact.polynomial(data[:cut]), exact.polynomial(data[cut:])) == whole
    assert len({exact.polynomial(bytes(k)) for k in range(50)}) == 50
    assert exact.polynomial(b"ab") != exact.polynomial(b"ba")


def plain_lines(rows):
    cut = [(d, (t or "").split("\n")) for d, t in rows]
    first, gone = {}, [set() for _ in cut]
    for r in sorted(range(len(cut)), key=lambda r: (cut[r][0] is None, cut[r][0] or 0, r)):
        x = cut[r][1]
        for i in range(len(x) - 2):
            if first.setdefault(tuple(x[i:i + 3]), (r, i)) != (r, i):
                gone[r].update(range(i, i + 3))
    return Counter((d, "\n".join(v for j, v in enumerate(x) if j not in g), len(x), len(g)) for (d, x), g in zip(cut, gone))


def test_line_dedup(spark):
    for docs in (common.table(spark, SF_SMALL, "documents"), odd_docs(spark)):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        assert Counter(map(tuple, lines.line_dedup(docs).collect())) == plain_lines(rows)
    assert lines.line_dedup(no_docs(spark)).collect() == []
    docs = spark.createDataFrame([(1, "a\n" * 9), (2, "a\na\na\nb"), (3, "q\na\na\na")], "doc_id long, text string")
    assert Counter(map(tuple, lines.line_dedup(docs).collect())) == plain_lines([tuple(r) for r in docs.collect()])


def test_line_dedup_of_rows_that_share_an_id_or_have_none(spark):
    """Each row is a document: of two rows with one id, or without one, the second loses the shared lines."""
    rows = [(8, "a\nb\nc\nmine"), (8, "a\nb\nc\nother"), (None, "d\ne\nf\n1"), (None, "d\ne\nf\n2"), (-2**63, "g\nh\ni"), (2**63 - 1, "g\nh\ni"),
            (5, "k\nl\nm"), (5, "k\nl\nm")]
    got = Counter(map(tuple, lines.line_dedup(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()))
    assert got == plain_lines(rows)
    assert sorted(n for _, _, _, n in got.elements()) == [0, 0, 0, 0, 3, 3, 3, 3]


def test_exact_dedup_of_extreme_ids(spark):
    rows = [(-2**63, "same text"), (2**63 - 1, "sametext"), (-2**63, "same  text"), (0, "other"), (-1, "other"), (None, "other")]
    got = exact.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.keep_id, r.group_size) for r in got} == {(-2**63, -2**63, 3), (2**63 - 1, -2**63, 3), (0, -1, 3), (-1, -1, 3), (None, -1, 3)}
    assert sum(r.kept for r in got) == 2


def check_embeddings(rows, out, least=0.93):
    fine = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) and lab is not None and i is not None for i, v, lab in rows]
    pairs = []
    for a, b in combinations(range(len(rows)), 2):
        if fine[a] and fine[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
            x, y = np.array(rows[a][1], dtype=float), np.array(rows[b][1], dtype=float)
            if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                pairs.append((a, b))
    top, n = groups(len(rows), pairs), Counter(i for p in pairs for i in p)
    low = {g: min((rows[i][0] for i in range(len(rows)) if top[i] == g and rows[i][0] is not None), default=None) for g in set(top)}
    want = Counter((rows[i][0], n[i], low[top[i]], rows[i][0] == low[top[i]]) for i in range(len(rows)))
    got = out.collect()
    assert Counter(tuple(r) for r in got) == want


@pytest.mark.parametrize("limit", [1024, 8])
def test_embeddings_with_crowds(spark, limit):
    rng = np.random.default_rng(4)
    rows = []
    for c in range(6):
        x = rng.normal(size=16)
        for _ in range(30):
            rows.append((len(rows), [float(v) for v in x + 0.08 * rng.normal(size=16)], c % 2))
        rows += [(len(rows) + k, rows[-1][1], c % 2) for k in range(5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    check_embeddings([tuple(r) for r in frame.collect()], embeddings.embedding_dedup(frame, limit=limit, nearest=8))


def test_embeddings_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 1), (2, v, 1), (3, v, None), (4, None, 1), (5, [], 1), (6, [0.0, 0.0, 0.0], 1), (7, [1.0, None, 2.0], 1), (8, [1.0, float("nan"), 2.0], 1),
            (9, [float("inf"), 1.0, 1.0], 1), (10, [2.0, 4.0, 6.0], 1), (11, v, 2), (12, [1.0, 2.0], 1), (13, [1.0, 2.0], 1), (None, v, 1), (-4, [1.0, 2.0, 3.01], 1)]
    frame = spark.createDataFrame([(*r, None, None) for r in rows], "vec_id long, embedding array<float>, label int, rep string, size string")
    check_embeddings([tuple(r)[:3] for r in frame.collect()], embeddings.embedding_dedup(frame))
    assert embeddings.embedding_dedup(frame.where("false")).collect() == []


def test_embeddings_of_extreme_sizes(spark):
    """Tiny and huge doubles have a cosine as any others."""
    rows = [(1, [1e-200, 1e-200], 1), (2, [1e-200, -1e-200], 1), (3, [1e300, 1e300], 1), (4, [2e-310, 2e-310], 1), (5, [1e300, -1e300], 1), (6, [5.0, 5.1], 1)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {1: (3, 1), 3: (3, 1), 4: (3, 1), 6: (3, 1), 2: (1, 2), 5: (1, 2)}


def planted(kind, n, dims, rng):
    """Vectors of which each tenth has a neighbour of a cosine just above the threshold."""
    x = rng.normal(size=(n, dims))
    if kind == "common mean":
        x += 1.7 * rng.normal(size=dims)
    elif kind == "clusters":
        x = rng.normal(size=(n // 300, dims))[rng.integers(0, n // 300, n)] + 0.6 * x
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    some = rng.choice(n, n // 10, replace=False)
    noise = rng.normal(size=(len(some), dims))
    noise -= (noise * x[some]).sum(1, keepdims=True) * x[some]
    cos = rng.uniform(0.93, 0.96, size=(len(some), 1))
    return np.concatenate([x, cos * x[some] + np.sqrt(1 - cos**2) * noise / np.linalg.norm(noise, axis=1, keepdims=True)])


@pytest.mark.parametrize("kind, most", [("isotropic", 0.05), ("common mean", 0.05), ("clusters", 1.0)])
def test_embedding_recall_and_cost(spark, kind, most):
    """End to end against all pairs; the lists compare a small share of them, and never more than all."""
    x = planted(kind, 5500, 64, np.random.default_rng(0))
    frame = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    want = (x @ x.T >= 0.93).sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in embeddings.embedding_dedup(frame).collect()}
    found = np.array([got[i] for i in range(len(x))])
    assert (found <= want).all() and found.sum() >= 0.95 * want.sum() > 500
    classes = frame.selectExpr("vec_id as rep", "'1' as label", "64 as dim", "1L as size", "embedding as vec")
    lists = embeddings.postings(classes, 8, 1024, 0.5).groupBy("label", "p", "q").count().collect()
    assert sum(r["count"] ** 2 for r in lists) <= most * len(x) ** 2


def test_a_label_whose_lists_are_too_long_is_one_list(spark):
    """Vectors on a line through the mean: no index can cut them, so all pairs are compared once."""
    rng = np.random.default_rng(1)
    x = np.array([1.0, 2.0, 3.0]) + 0.01 * rng.normal(size=(300, 1)) * np.array([1.0, -1.0, 0.5])
    frame = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    assert {r.n_links for r in embeddings.embedding_dedup(frame, limit=20).collect()} == {299}
