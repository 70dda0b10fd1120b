"""Phrase mining against a plain version."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF_SMALL
from llm_frames import lower, no_docs, odd_docs

from basketry.llm import common, phrases


def plain(rows, least=30, most=2000, covered=80):
    """Rows of (text, lang) as the contract words them."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, count in f.items():
        found = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in found.items():
            for w in range(2, len(p)):
                for s in range(len(p) - w + 1):
                    longer[p[s:s + w]] = max(longer[p[s:s + w]], a)
        scored = []
        for p, a in found.items():
            if 100 * longer[p] >= covered * a:
                continue
            score, k = min((2000000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:most], 1)]
    return sorted(out)


def got(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def test_small_table(spark):
    docs = common.table(spark, SF_SMALL, "documents")
    want = plain([(r.text, r.lang) for r in docs.collect()])
    assert want
    assert got(phrases.collocations(docs)) == want


def test_odd_rows(spark):
    docs = odd_docs(spark)
    assert got(phrases.collocations(docs, least=2)) == plain([(r.text, r.lang) for r in docs.collect()], least=2)
    assert phrases.collocations(no_docs(spark)).collect() == []
    assert phrases.collocations(docs.where("text is null")).collect() == []


def made(seed):
    rng = random.Random(seed)
    words = [*"abcdefgh", "The", "the", "ünï", "\xa0", "x\x1cy", "日本", "und"]
    shared = " ".join(rng.choice(words) for _ in range(70))
    out = []
    for _ in range(60):
        t = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b"]) for _ in range(rng.randint(0, 60)))
        out.append((t + " " + shared if rng.random() < 0.4 else t, rng.choice(["en", None, "und", ""])))
    return out


@pytest.mark.parametrize("trigger, step", [(16, 1 << 20), (1, 64), (3, 1000)])
def test_made_texts(spark, monkeypatch, trigger, step):
    """Any trigger and any step give the same counts; a crowded bitmap too."""
    monkeypatch.setattr(phrases, "TRIGGER", trigger)
    monkeypatch.setattr(phrases, "STEP_GRAMS", step)
    monkeypatch.setattr(phrases, "SEGMENT", step)
    if trigger == 3:
        monkeypatch.setattr(phrases, "LEAST_BITS", 64)
        monkeypatch.setattr(phrases, "MOST_BITS", 64)
    rows = made(trigger)
    docs = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(rows)], "doc_id long, text string, lang string").repartition(5)
    for least in (2, 12):
        assert got(phrases.collocations(docs, least=least, most=50)) == plain(rows, least=least, most=50)


def test_parse_overlaps_and_covers():
    """The own parts of the chunks of a piece, in order, are its words; repeated chunks count."""
    rng = random.Random(4)
    for _ in range(200):
        words = [rng.choice(["a", "B", "c", "é"]) for _ in range(rng.randint(1, 80))]
        code, chunks, last, own, times = phrases.parse([" ".join(words).encode(), b"", b"  .\t!"], np.array([0, 1, 2]))
        assert set(code) == {0} and sum(times[last]) == 1 and sum(own * times) == len(words)
        met = Counter()
        for chunk, mine, n in zip(chunks.to_pylist(), own, times):
            part = chunk.split(" ")
            for k in range(1, 5):
                for i in range(mine):
                    if i + k <= len(part):
                        met[tuple(part[i:i + k])] += n
        low = [w.lower() if w.isascii() else w for w in words]
        assert met == Counter(tuple(low[i:i + k]) for k in range(1, 5) for i in range(len(low) - k + 1))


def test_long_texts_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(phrases, "SEGMENT", 50)
    text = b"".join(b"word%d and more of it. " % i for i in range(40)) + b"x" * 200
    parts = list(phrases.segments(["en", "de"], [text, b"short"]))
    assert b"".join(t for _, some in parts for t in some) == text + b"short"
    assert all(p.endswith(b".") for p in [t for _, some in parts for t in some][:-2])


def test_hashes_of_stretches():
    buffer = np.frombuffer(b"abc abc  abd" * 3, dtype=np.uint8)
    for base in phrases.BASES:
        r = phrases.Rolling(buffer, base)
        h = r.of(np.array([0, 4, 9, 12, 0]), np.array([3, 7, 12, 15, 0]))
        assert h[0] == h[1] == h[3] != h[2]
