"""Cross-tokenizer alignment against the libraries' whole-text encodings."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from conftest import SF_SMALL
from llm_frames import no_docs, odd_docs
from tokenizers import Tokenizer

from basketry.llm import alignment, common
from basketry.llm.tokens import ALPHABET

A_FILE, B_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A = Tokenizer.from_file(A_FILE)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
BACK = {c: b for b, c in ALPHABET.items()}


def plain_groups(text):
    """Groups of (ids of A, ids of B) of a whole text by its byte offsets; none where bytes differ."""
    if not text:
        return []
    a = A.encode(" " + text, add_special_tokens=False).ids
    b = B.encode(text)
    xa = [bytes(BACK[c] for c in A.id_to_token(i)) for i in a]
    xb = [bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if b"".join(xa) != (" " + text).encode() or b"".join(xb) != (" " + text).encode():
        return []

    def ends(tokens):
        at, out = 0, []
        for t in tokens:
            at += len(t)
            out.append(at)
        return out

    ea, eb = ends(xa), ends(xb)
    out, start = [], 0
    for cut in sorted(set(ea) & set(eb)):
        out.append(([i for i, e in zip(a, ea) if start < e <= cut], [i for i, e in zip(b, eb) if start < e <= cut]))
        start = cut
    return out


def plain(rows):
    """Rows of (doc_id, text) as the contract words them."""
    groups = [plain_groups(t) for _, t in rows]
    links = [[(x, y) for ga, gb in g for x in ga for y in gb] for g in groups]
    held = Counter(p for doc in links for p in set(doc))
    best = {}
    for (x, _), n in held.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for (doc_id, _), g, found in zip(rows, groups, links):
        text = ";".join(f"{','.join(map(str, ga))}|{','.join(map(str, gb))}" for ga, gb in g)
        out.append((doc_id, sum(len(ga) for ga, _ in g), sum(len(gb) for _, gb in g), len(g), len(found),
                    sum(held[p] == best[p[0]] for p in found), sum(held[p] for p in found),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return Counter(out)


def got(df):
    return Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


def test_small_table(spark):
    docs = common.table(spark, SF_SMALL, "documents")
    assert got(alignment.align_tokenizers(docs)) == plain([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(spark):
    docs = odd_docs(spark)
    short = docs.where("text is null or length(text) < 50000")
    assert got(alignment.align_tokenizers(short)) == plain([(r.doc_id, r.text) for r in short.collect()])
    assert alignment.align_tokenizers(docs).count() == docs.count()
    assert alignment.align_tokenizers(no_docs(spark)).collect() == []


def test_counts_over_many_blocks(spark, monkeypatch):
    """Every batch of rows is a block of its own: the same counts as in one block."""
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 1)
    docs = common.table(spark, SF_SMALL, "documents").repartition(7)
    assert got(alignment.align_tokenizers(docs)) == plain([(r.doc_id, r.text) for r in docs.collect()])


def fuzz(n, seed):
    rng = random.Random(seed)
    bits = [" ", "  ", "   ", "\n", "\t", "\r\n", "a", "the", "The", " cat", "ing", "'s", "'", "1234", "é", "ñ", "漢字", "。", "日本", "▁", "<s>",
            "<0x41>", "<|endoftext|>", " ", "　", "​", "\x00", "﻿", "🙂", "é", "ﬁ", "Ⅳ", ".", ",", "...", "=====", "ß", "к", "ال"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(1, 24))) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_units_align_as_whole_texts(seed):
    of = alignment.Aligner(A_FILE, B_FILE)
    texts = fuzz(1500, seed)
    for t, (n_a, n_b, groups, text, codes) in zip(texts, of.documents(texts)):
        want = plain_groups(t)
        assert (n_a, n_b, groups) == (sum(len(x) for x, _ in want), sum(len(y) for _, y in want), len(want)), repr(t)
        assert text == ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in want), repr(t)
        assert len(codes) == 8 * sum(len(x) * len(y) for x, y in want)
