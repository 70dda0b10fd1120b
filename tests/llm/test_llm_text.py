"""Token counts, packing, PII, language ID, pieces and licenses against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_CHECK, SF_SMALL
from llm_frames import TEXTS, lower, no_docs, odd_docs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basketry.llm import common, language, licenses, packing, pieces, pii, queries, tokens

HARD = ["", "  a  b", " a", "a ", "a \n b", "x<|endoftext|> <|endoftext|>y <|ENDOFTEXT|>", "don't won't I'LL ' s", "a\t b 　c", "日本 語  x  y ź ́q J̌ H̱",
        "é ß. ü, ÀÉ: foo; a.b. c?! d? Σας ΟΔΟΣ İstanbul K", "\x1c a \x85 b", "x" * 3000 + " " + "y" * 300, "12 345 6, 7. ---- ... .a ª º µ", "\xad ​ x"]


def texts_of(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def test_token_counts(spark):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for docs in (common.table(spark, SF_SMALL, "documents"), odd_docs(spark)):
        want = Counter((d, len((x or "").encode()), n := len(t.encode(x or "", add_special_tokens=False).ids), n > 1024) for d, x in texts_of(docs))
        assert Counter(map(tuple, tokens.token_counts(docs).collect())) == want
    assert tokens.token_counts(no_docs(spark)).collect() == []


def test_token_counts_of_hard_texts():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(1)
    texts = HARD + ["".join(rng.choice(" \n\tab'.,sé1　<|") for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    assert tokens.Counter(public_tokenizers.path("byte_bpe_50k.json")).counts(texts) == [len(t.encode(x, add_special_tokens=False).ids) for x in texts]


def test_batches_are_balanced_by_bytes():
    got = list(tokens.by_bytes(["a" * n for n in (5, 5, 5, 40, 1, 1)], 12))
    assert [[len(p) for p in b] for b in got] == [[5, 5], [5], [40], [1, 1]]
    assert [len(b) for b in tokens.by_bytes(["漢" * 4] * 5, 24)] == [2, 2, 1]


@pytest.mark.parametrize("stretch", [3, 20, 4096])
def test_texts_without_spaces_are_cut_at_safe_edges(monkeypatch, stretch):
    """Lists, Chinese, code, special tokens, contractions: the counts of the whole, and no long call."""
    monkeypatch.setattr(tokens, "STRETCH", stretch)
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole, of, rng = Tokenizer.from_file(path), tokens.Counter(path), random.Random(stretch)
    bits = [" ", "  ", "\n", "\t", "\r\n", "a", "The", "'s", "'ll", "'", "12", "é", "漢字", "。", "<|endoftext|>", "<|endof", "text|>", "\xa0", "🙂", "Ⅳ", "²", ".", ",", "=="]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    texts += ["x\n" * 30_000, "漢字。\n" * 30_000, "key=12;" * 9_000]
    assert of.counts(texts) == [len(c.ids) for c in whole.encode_batch_fast(texts, add_special_tokens=False)]
    assert max(len(p) for t in texts for p in of.cut(t)) <= 2 * max(stretch, 60)



def test_ids_of_hard_texts():
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(1)
    texts = HARD + ["".join(rng.choice(" \n\tAB'.,sÉé1　̌<|") for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    got = packing.Encoder(public_tokenizers.path("word_bpe_49k.json")).encode(texts)
    assert [np.frombuffer(g, dtype="<u4").tolist() for g in got] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def check_packing(rows, out):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for d, x in rows:
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for k, at in enumerate(range(0, len(ids), 2048)):
            want[d, k, at, len(ids[at:at + 2048]), zlib.crc32(ids[at:at + 2048].tobytes())] += 1
    got = out.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for spans in held.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    return len(held), sum(r.length for r in got) / 2048


def test_packing(spark):
    used, least = check_packing(texts_of(common.table(spark, SF_SMALL, "documents")), packing.best_fit_pack(common.table(spark, SF_SMALL, "documents")))
    assert used <= least * 1.05 + 2
    check_packing(texts_of(odd_docs(spark)), packing.best_fit_pack(odd_docs(spark)))
    assert packing.best_fit_pack(no_docs(spark)).collect() == []
    row = packing.best_fit_pack(odd_docs(spark), with_ids=True).where("doc_id = 4 and piece = 0").first()
    assert zlib.crc32(np.array(row.ids, dtype="<u4").tobytes()) == row.ids_crc32


def test_bins_are_best_fit_and_bounded():
    rng = random.Random(2)
    bins, free, closed = packing.Bins(100, 8), {}, set()
    for _ in range(4000):
        n = rng.randint(1, 100)
        before = dict(free)
        b, offset = bins.place(n)
        fits = [f for f in before.values() if f >= n]
        if fits:
            assert before[b] == min(fits) and offset == 100 - before[b]
        else:
            assert b not in before and b not in closed and offset == 0
        free[b] = before.get(b, 100) - n
        if not free[b]:
            del free[b]
        if len(free) > 8:  # the fullest of those open before has closed
            gone = min((f for k, f in free.items() if k != b))
            k = next(k for k, f in free.items() if f == gone and k != b and k not in bins.by_space.get(f, []))
            closed.add(k)
            del free[k]
        assert bins.open == len(free) <= 8


PLAIN = [re.compile(p) for p in (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                                 r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain_pii(text):
    def fine(k, s):
        d = re.sub("[^0-9]", "", s)
        odd = [int(c) for c in d[::-1]]
        luhn = sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(odd)) % 10 == 0
        return (True, k == 1 and all(int(p) <= 255 for p in s.split(".")), 16 <= len(d) <= 19 and luhn, 8 <= len(d) <= 15)[k]

    return [(k, *m.span()) for k in range(4) for m in PLAIN[k].finditer(text or "") if fine(k, m.group())]


def check_pii(docs, detector):
    got = pii.find_pii(docs, detector).collect()
    want = Counter()
    for d, t in texts_of(docs):
        base = plain_pii(t)
        want[(d, *(sum(s[0] == k for s in base) for k in range(4)), hashlib.sha256(pii.listing(base).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == want
    by_id = defaultdict(set)
    for d, t in texts_of(docs):
        by_id[d] |= set(filter(None, pii.listing(plain_pii(t)).split(",")))
    for r in got:
        if r.doc_id is not None:
            assert r.n_added == len(set(filter(None, r.spans.split(","))) - by_id[r.doc_id])


def test_pii(spark):
    docs = common.table(spark, SF_CHECK, "documents")
    detector = pii.train(docs)
    check_pii(docs, detector)
    check_pii(odd_docs(spark), detector)
    assert pii.find_pii(no_docs(spark), detector).collect() == []
    assert pii.train(no_docs(spark)).trees is None
    check_pii(odd_docs(spark), pii.train(no_docs(spark)))
    for text, found in (("write to jo.smith at example dot com please", {0}), ("and was 1234567 of 89 thand", set()), ("version 1.2.3 of 2024-01-02", set()),
                        ("x 4539578763621487 y", set()), ("10.0.0.256 is none", set())):
        assert {s[0] for s in detector.spans(text)[1]} == found, text
    out = pii.redact(odd_docs(spark), detector)
    assert out.columns == odd_docs(spark).columns
    text = {r.doc_id: r.text for r in out.collect()}[25]
    assert text == "Mail <EMAIL> or <PHONE>, card <CARD>, ip <IP>."


GREEDY = re.compile(r"(?<![0-9A-Za-z])(?:\+|00)?\(?[0-9]{1,19}\)?(?:[ ./()‐-–-]{1,3}[0-9]{1,19}){0,6}(?![0-9A-Za-z])")


def plain_runs(text):
    """(kind, digits' start, digits' end) of every part of a text that is digit groups with separators and has a fitting number of digits."""
    run, edge = re.compile(r"[0-9]+(?:\)?[ ./()‐-–-]{1,3}[0-9]+)*"), re.compile("[0-9A-Za-z]")
    for a in range(len(text)):
        for b in range(a + 7, len(text) + 1):
            if run.fullmatch(text, a, b) and not edge.match(text[a - 1:a]) and not edge.match(text[b:b + 1]):
                n = len(re.sub("[^0-9]", "", text[a:b]))
                yield from ((k, a, b) for k, low, high in ((3, 7, 15), (2, 13, 19)) if low <= n <= high)


def test_every_run_of_digit_groups_is_proposed():
    for text, kind, part in (("card 4111/1111/1111/1111 12/27", 2, "4111/1111/1111/1111"), ("2024 4111.1111.1111.1111", 2, "4111.1111.1111.1111"),
                             ("tel 555-123-4567 555-987-6543 555-111-2222", 3, "555-987-6543"), ("2024-01-02 555-123-4567", 3, "555-123-4567"),
                             ("12 (514) 555-8389 7", 3, "(514) 555-8389")):
        assert (kind, part) in {(k, text[a:b]) for k, a, b in pii.proposals(text)}, text
    rng = random.Random(4)
    for _ in range(5000):
        text = "".join(rng.choice(["123", "4567", "12", "9", "12345678901234567890", "5551234", " ", "-", ") ", " (", "+", "a", ", ", "  -  "]) for _ in range(rng.randint(0, 14)))
        got = list(pii.numbers(text))
        assert sorted((k, a + len(s) - len(s.lstrip("+(")), a + len(s.rstrip(")"))) for k, a, b in got for s in [text[a:b]]) == sorted(plain_runs(text)), text
        for m in GREEDY.finditer(text):
            n = len(re.sub("[^0-9]", "", m.group()))
            assert not 7 <= n <= 15 or (3, *m.span()) in got, text
            assert not 13 <= n <= 19 or (2, *m.span()) in got, text


def test_numbers_beside_numbers_are_redacted(spark):
    detector = pii.train(common.table(spark, SF_CHECK, "documents"))
    for text, want in (("card 4111/1111/1111/1111 12/27", "card <CARD> 12/27"), ("2024 4111.1111.1111.1111", "2024 <CARD>"),
                       ("call (555) 123-4567 12.50", "call <PHONE> 12.50")):
        assert pii.redacted(text, detector.spans(text)[1]) == want


def test_base_spans_of_random_texts():
    rng = random.Random(1)
    for _ in range(30_000):
        s = "".join(rng.choice(rng.choice(["a1+@.- 0(9Z_%", "0123456789 .-+"])) for _ in range(rng.randint(0, 45)))
        assert pii.base_spans(s) == plain_pii(s), s


def test_long_runs_take_linear_time():
    for c in ("1", "a", "+", "@", "a@", "1.", "1 ", "+1", "at "):
        pii.Detector(np.zeros((0, 1)), np.zeros(0, dtype=int)).spans(c * 100_000)
        pii.proposals(c * 100_000)


def test_trees_learn_and_thresholds_hold():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1500, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(int)
    s = pii.Trees(x[:1000], y[:1000]).scores(x[1000:])
    assert ((s > 0.5) == y[1000:]).mean() > 0.93
    t = pii.threshold(s, y[1000:], 0.99)
    assert y[1000:][s >= t].mean() >= 0.99
    assert pii.threshold(np.array([0.9, 0.8]), np.array([0, 0]), 0.99) > 1


def test_language_id_held_out(spark):
    docs = common.table(spark, SF_CHECK, "documents")
    got = {r.doc_id: r for r in language.language_id(docs).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert {r.doc_id for r in held} == {d for d, r in got.items() if r.held_out}
    words = [r for r in held if len(r.text.split()) >= 5]
    assert np.mean([got[r.doc_id].lang_pred == r.lang for r in words]) > 0.99
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_id_odd_rows(spark):
    docs = odd_docs(spark)
    got = language.language_id(docs).collect()
    assert len(got) == docs.count()
    blank = {d for d, t in texts_of(docs) if d is not None and not any(c.isalpha() for c in t or "")}
    assert {r.doc_id for r in got if r.doc_id is not None and r.lang_pred == "und"} == blank
    assert all(r.score == 0 for r in got if r.lang_pred == "und")
    kept = language.keep_known(docs)
    assert kept.columns == docs.columns and kept.count() == sum(any(c.isalpha() for c in t or "") for _, t in texts_of(docs))
    assert language.language_id(no_docs(spark)).collect() == []
    assert {r.lang_pred for r in language.language_id(docs.withColumn("lang", docs.fp)).collect()} == {"und"}
    one = language.train(docs.where("lang = 'en'"))
    assert one.langs == ["en"] and one.predict(["abc", "12"])[:2] == (["en", "und"], [1.0, 0.0])


def test_codewords_are_apart():
    for k in range(2, 8):
        code = language.codewords(k)
        assert code.shape == (k, 2 ** (k - 1) - 1)
        assert min((code[i] != code[j]).sum() for i in range(k) for j in range(i)) >= max(1, 2 ** (k - 2))
    code = language.codewords(12)
    assert min((code[i] != code[j]).sum() for i in range(12) for j in range(i)) >= 15


def test_counts_do_not_depend_on_the_chunk(monkeypatch):
    whole = language.counts("Some text with Words. " * 30)
    monkeypatch.setattr(language, "CHUNK", 17)
    assert np.allclose(language.counts("Some text with Words. " * 30), whole, atol=1e-6)


def test_pieces_against_all_segmentations():
    rng = random.Random(0)
    table = {"".join(rng.choice("ab▁") if z == 0 else rng.choice("ab") for z in range(rng.randint(1, 3))): (k + 256, -rng.random() * 5) for k in range(60)}
    table |= {"▁": (1000, -1.0), "a": (1001, -2.0)}
    m = pieces.Pieces(table, list(range(256)), 8)

    def every(s):
        if not s:
            yield 0.0
            return
        for j in range(1, len(s) + 1):
            if s[:j] in m.pieces:
                yield from (m.pieces[s[:j]][1] + x for x in every(s[j:]))
        if s[0] not in m.pieces:
            yield from (m.floor * len(s[0].encode()) + x for x in every(s[1:]))

    for _ in range(200):
        w = "".join(rng.choice("abbc") for _ in range(rng.randint(0, 3))) + " " + "".join(rng.choice("ab é") for _ in range(rng.randint(0, 4)))
        got = m.nbest(w, 5)
        want = sorted(every("▁" + w.replace(" ", "▁")), reverse=True)[:5]
        assert np.allclose([s for s, _ in got], want)
        assert len({ids for _, ids in got}) == len(got) and all(m.decode(list(ids)) == w for _, ids in got)


def test_pieces_side_by_side():
    """The search over arrays gives what the search of one part gives, to the last bit and also where scores tie."""
    rng = random.Random(8)
    for scores in ([-1.0, -2.0], [-rng.random() * 10 for _ in range(50)]):
        table = {"".join(rng.choice("abc▁") for _ in range(rng.randint(1, 7))): (300 + i, rng.choice(scores)) for i in range(120)}
        table |= {c: (600 + i, rng.choice(scores)) for i, c in enumerate("abc▁")}
        m = pieces.Pieces(table, list(range(256)), 2)
        parts = sorted({"".join(rng.choice("abc ") for _ in range(rng.randint(1, pieces.CHUNK_PART))) for _ in range(400)} | {"a"})
        want = [m.best(p, 2) for p in parts]
        assert any(len(w) == 1 for w in want)
        got = m.lattices.best_two(parts)
        assert [[(s, tuple(np.frombuffer(i, dtype="<u4").tolist())) for i, s in zip(*g)] for g in got] == want
        assert m.entries(parts) == {p: m.entry(p) for p in parts}
    of = pieces.from_file(public_tokenizers.path("piece_bpe_32k.model"), 2)
    texts = ["the same words, over and over", "naïve café 北京 x" + "ab" * 90, ""]
    want = [of.nbest(t, 2) for t in texts]

    def alone(part, n):
        assert len(part) > pieces.CHUNK_PART or not of.lattices.single.issuperset(part)   # all others are searched side by side
        return best(part, n)

    best, of.best = of.best, alone
    for text, w, units in zip(texts, want, of.units(texts)):
        got = of.combined(units)
        assert [np.frombuffer(i, dtype="<u4").tolist() for i, _ in got] == [list(i) for _, i in w] and [s for _, s in got] == pytest.approx([s for s, _ in w])


def test_pieces_of_runs_of_spaces():
    of = pieces.loaded(public_tokenizers.path("piece_bpe_32k.model"), 2)
    assert sum("▁" in p[1:] for p in of.pieces) == 14

    def plain(text):
        """The best score over all pieces of the file, by places; a literal mark is no space."""
        s, best = ("▁" + text.replace("▁", "\0").replace(" ", "▁")) if text else "", [0.0]
        for j in range(1, len(s) + 1):
            raw = [] if s[j - 1] in of.pieces else [best[j - 1] + of.floor * len(s[j - 1].replace("\0", "▁").encode())]
            best.append(max(raw + [best[i] + of.pieces[s[i:j]][1] for i in range(max(0, j - 48), j) if s[i:j] in of.pieces]))
        return best[-1]

    rng = random.Random(6)
    texts = ["x\n    return y", "    ", " a  b   ", "▁ ▁  ▁", "a" + " " * 40 + "b", "  "]
    texts += ["".join(rng.choice([" ", "  ", "    ", "\n", "return", "x", "é", "▁", "\t"]) for _ in range(rng.randint(0, 12))) for _ in range(300)]
    for t, units in zip(texts, of.units(texts), strict=True):
        assert np.isclose(sum(u[1] for u in units), plain(t), rtol=1e-12) and all(u[3] for u in units), t
        score, ids = of.nbest(t, 1)[0]
        assert np.isclose(score, plain(t), rtol=1e-12) and of.decode(list(ids)) == t

    small = pieces.Pieces({"▁": (300, -1.0), "▁▁": (301, -1.5), "a▁b": (302, -0.5), "a": (303, -1.0), "b": (304, -1.0), "▁▁a": (305, -1.2)}, list(range(256)), 2)
    assert small.nbest("a b  a", 2)[0] == (-1.0 - 0.5 - 1.2, (300, 302, 305))


def test_pieces_n_best_of_whole_texts(spark):
    """The operator gives the n best segmentations of each text, not only the best and a gap."""
    texts = ["", "a", "the quick brown fox", "aaaa aaaa aaaa", "x  y   z", "naïve café ▁ 日本語 \U0001f600", "one two three four five six seven"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for n in (1, 2, 4):
        of = pieces.loaded(public_tokenizers.path("piece_bpe_32k.model"), n)
        for r in pieces.encode(docs, n=n, with_ids=True).collect():
            want = of.nbest(texts[r.doc_id], n)
            assert np.allclose(r.nbest_score, [s for s, _ in want]) and r.ids == r.nbest_ids[0] and r.score == r.nbest_score[0]
            assert len({tuple(i) for i in r.nbest_ids}) == len(want) and {of.decode(list(i)) for i in r.nbest_ids if i} <= {texts[r.doc_id]}
            assert r.nbest_crc32 == [zlib.crc32(np.array(i, dtype="<u4").tobytes()) for i in r.nbest_ids] and r.nbest_pieces == [len(i) for i in r.nbest_ids]


def test_pieces_round_trip(spark):
    for docs in (common.table(spark, SF_SMALL, "documents"), odd_docs(spark)):
        enc = pieces.encode(docs, with_ids=True)
        rows = enc.collect()
        assert all(r.round_trip for r in rows)
        assert Counter((r.doc_id, r.text) for r in pieces.decode(enc).collect()) == Counter((d, t or "") for d, t in texts_of(docs))
        assert all(r.gap is None or r.gap >= 0 for r in rows)
        assert all(zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.n_pieces for r in rows)
    assert pieces.encode(no_docs(spark)).collect() == []
    of = pieces.loaded(public_tokenizers.path("piece_bpe_32k.model"), 2)
    for t in ("a▁b  c ▁", "  ", "日本\U0001f600 x\n\t y"):
        assert of.decode(list(of.nbest(t, 1)[0][1])) == t


def test_pieces_query_decodes_what_it_encoded(spark):
    """The registered query decodes the whole ids of each of its segmentations, and gives a digest of the text that came out."""
    rows = queries.op8_pieces(spark, SF_SMALL).collect()
    want = {d: (t or "").encode() for d, t in texts_of(common.table(spark, SF_SMALL, "documents"))}
    assert len(rows) == len(want) > 50
    assert all(r.round_trip and (r.decoded_bytes, r.decoded_crc32) == (len(want[r.doc_id]), zlib.crc32(want[r.doc_id])) for r in rows)
    odd = odd_docs(spark)
    rows = pieces.encode(odd, with_decoded=True).collect()
    assert Counter((r.doc_id, r.decoded_bytes, r.decoded_crc32, r.round_trip) for r in rows) == Counter(
        (d, len(t), zlib.crc32(t), True) for d, t in ((d, (t or "").encode()) for d, t in texts_of(odd)))
    # it is the ids that are decoded: other ids, another text
    of = pieces.from_file(public_tokenizers.path("piece_bpe_32k.model"), 2)
    ids = [np.frombuffer(data, dtype="<u4") for data, _ in of.combined(of.units(["one two  three \u2581 \u65e5\u672c"])[0])]
    assert len(ids) == 2 and {of.decoded(i).decode() for i in ids} == {"one two  three \u2581 \u65e5\u672c"}
    assert of.decoded(ids[0][::-1]) != of.decoded(ids[0]) and of.decoded(ids[0][:-1]) != of.decoded(ids[0])


def test_licenses(spark):
    for docs in (common.table(spark, SF_CHECK, "documents"), odd_docs(spark)):
        want = Counter()
        for d, t in texts_of(docs):
            t = lower(t or "")
            find = lambda s: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", s)
            w = find(t)
            base = [(i, lab) for p, lab in licenses.PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
            labels, share = {lab for _, lab in base}, 0.0
            for line in t.split("\n"):
                for p, lab in licenses.TEMPLATES.items():
                    both, n = len(set(find(line)) & set(p.split())), len(set(p.split()))
                    if both >= 0.8 * n:
                        labels.add(lab)
                        share = max(share, both / n)
            want[d, len(w), len(base), min((i for i, _ in base), default=None), max((i for i, _ in base), default=None),
                 ",".join(sorted({lab for _, lab in base})), ",".join(sorted(labels)), 1.0 if base else share] += 1
        assert Counter(map(tuple, licenses.license_scan(docs).collect())) == want
    assert licenses.license_scan(no_docs(spark)).collect() == []


WRAPPED = {
    "mit": "# Permission is hereby granted, free of charge, to any person obtaining a copy of\n# this software and associated documentation files (the \"Software\")\n",
    "gpl": " * This program is free software; you can redistribute it and/or\n * modify it under the terms of the GNU General\n * Public License",
    "bsd": "x = 1\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:\n",
    "cc-by-nc": "licensed\nunder\r\nCC\nBY\nNC\n4",
}


def plain_blocks(text, length):
    """Lines, and windows of ``length`` words of the text, as sets of words."""
    find = lambda s: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(s))
    w = find(text)
    return [set(find(line)) for line in text.split("\n")] + [set(w[i:i + length]) for i in range(max(1, len(w) - length + 1))]


def test_wrapped_notices(spark):
    rows = list(WRAPPED.values()) + ["Permission is hereby granted " + "x " * 20 + "\nto any person obtaining a copy of this software"]
    got = {r.doc_id: r for r in licenses.license_scan(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    assert [got[i].labels for i in range(len(rows))] == [*WRAPPED, ""]
    assert [got[i].score for i in (0, 2)] == [1.0, 1.0] and got[4].score == 0

    rng, known = random.Random(3), [t.split() for t in licenses.TEMPLATES]
    rows = list(WRAPPED.values())
    for _ in range(300):
        text = ["x"] * rng.randint(0, 12)
        for t in rng.sample(known, rng.randint(1, 2)):
            text += [rng.choice([w] * 12 + ["x", "", "x y", w + " " + w]) for w in t] + ["the"] * rng.randint(0, 9)
        rows.append("".join(w + rng.choice("     \n") for w in text))
    got = {r.doc_id: r for r in licenses.license_scan(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    some = 0
    for i, text in enumerate(rows):
        labels, share = set(filter(None, got[i].base_labels.split(","))), 0.0
        for p, lab in licenses.TEMPLATES.items():
            n = len(set(p.split()))
            both = max(len(b & set(p.split())) for b in plain_blocks(text, len(p.split())))
            if both >= 0.8 * n:
                labels.add(lab)
                share = max(share, both / n)
        assert (got[i].labels, got[i].score) == (",".join(sorted(labels)), 1.0 if got[i].n_base else share), text
        some += 0 < share < 1
    assert some > 30


def test_the_license_scan_runs_no_python(spark):
    plan = licenses.license_scan(odd_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_the_odd_texts_are_odd():
    assert None in TEXTS and "" in TEXTS and max(len(t or "") for t in TEXTS) > 200_000


def test_spelt_addresses_are_read_whole():
    """Long local parts and domains of many labels are not cut; many "at"s in one run are read once."""
    local, domain = "x" * 70 + ".y", ".".join(["l" * 70] * 9)
    for text in (f"write to {local} at {domain} now", f"{local} (at) {domain}"):
        assert [text[a:b] for _, a, b in pii.spelt(text) if text[a:b].startswith("x")] == [text[text.index("x"):text.index(domain) + len(domain)]]
    assert list(pii.spelt("at." * 200_000)) == []
    assert [s[1:] for s in pii.spelt("joe.smith at mail dot com")] == [(0, 25)]


def plain_decode(model, text):
    """Loss-weighted decoding of one text with loops."""
    x = language.counts(text)
    loss = []
    for k in range(len(model.langs)):
        total = 0.0
        for j in range(model.code.shape[1]):
            f = float(np.dot(x.astype(np.float64), model.w[:, j].astype(np.float64)) + model.b[j])
            total += float(np.ravel(np.broadcast_to(model.weights, model.code.shape)[k])[j]) * np.log1p(np.exp(-model.code[k, j] * f))
        loss.append(total)
    share = [np.exp(-4 * (v - min(loss))) for v in loss]
    order = sorted(loss)
    return model.langs[loss.index(min(loss))], max(share) / sum(share), order[1] - order[0] < 0.05


def many_languages(spark, n):
    """Documents in ``n`` made-up languages, each with favourite letters."""
    rng = random.Random(6)
    letters = {f"l{i:02}": "".join(chr(97 + (i * 7 + k * k + k) % 26) for k in range(7)) + "aeiou"[i % 5] * 4 for i in range(n)}
    rows = [(i, " ".join("".join(rng.choice(letters[g]) for _ in range(rng.randint(2, 8))) for _ in range(60)), g)
            for i, g in enumerate(list(letters) * 60)]
    return spark.createDataFrame([(*r, "x", None, None) for r in rows], "doc_id long, text string, lang string, source string, ambiguous int, score string")


@pytest.mark.parametrize("n", [3, 11])
def test_decoding_against_a_plain_decoder(spark, n):
    """Every prediction, score and flag is the plain decoder's; held-out rows are named right, with more than seven languages too."""
    docs = many_languages(spark, n)
    model = language.train(docs)
    rows = docs.collect()
    got = {r.doc_id: r for r in language.language_id(docs).collect()}
    right = 0
    for r in rows[:400]:
        lang, score, unsure = plain_decode(model, r.text)
        assert got[r.doc_id].lang_pred == lang and got[r.doc_id].ambiguous == unsure
        assert abs(got[r.doc_id].score - score) < 1e-4
        right += lang == r.lang
    assert right >= 0.95 * min(400, len(rows))
    assert {r.held_out for r in got.values()} == {True, False}


def test_documents_of_wanted_languages_stay(spark):
    docs = many_languages(spark, 3)
    kept = language.keep_known(docs, wanted=["l01"])
    assert kept.columns == docs.columns
    assert 55 <= kept.where("lang = 'l01'").count() <= kept.count() <= 70
    blank = docs.withColumn("lang", F.when(F.col("doc_id") % 5 != 0, F.col("lang")))
    filled = {r.doc_id: r.lang for r in language.keep_known(blank).collect()}
    assert len(filled) == 180 and sum(filled[r.doc_id] == r.lang for r in docs.collect()) >= 175
