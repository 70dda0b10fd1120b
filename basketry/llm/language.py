"""Language ID by error-correcting output codes.

Each language has a codeword of +1 and -1; each bit has a binary classifier
(logistic regression over hashed byte bigrams and trigrams of the text's
letters). A prediction is the codeword with the smallest loss, each bit's loss
weighted by how well that bit does on that language in held-back rows. The gap
to the second codeword flags ambiguous texts.

Fitted on a bounded sample (``per_language`` rows of each language, chosen by
a hash of the id, whole texts; the driver gets count vectors, not texts). Only
rows whose crc32(doc_id) mod 4 is not 2 are ever learned from.

Defined results: null text, or one without letters: ``und``, score 0, not
ambiguous; a null lang is not learned; a null doc_id is never learned from and
counts as held out; with one language to learn all letters mean that one, with
none all is ``und``; repeated rows come back as often as they came; extra
columns are carried by ``with_language`` and named as they were.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from basketry.llm import common

UND = "und"
SIZE_BITS = 12
#: Bytes counted at a time; neighbours share two bytes, so that no n-gram is lost.
CHUNK = 1 << 20
#: ASCII bytes that are no letters become a space, letters lower case; other bytes stay.
FOLD = bytes((b | 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]")


def has_letters(text: str | None) -> bool:
    return bool(text) and (LATIN.search(text) is not None or any(map(str.isalpha, text)))


def counts(text: str) -> np.ndarray:
    """Hashed bigram and trigram counts of a whole text, square roots, scaled to length 1."""
    data, shift, mul = text.encode("utf-8", "surrogatepass").translate(FOLD), np.uint32(32 - SIZE_BITS), np.uint32(2654435761)
    out = np.zeros(1 << SIZE_BITS)
    for at in range(0, max(1, len(data)), CHUNK):
        x = np.frombuffer(data, dtype=np.uint8, offset=at, count=min(CHUNK + 2, len(data) - at)).astype(np.uint32)
        two = x[:-1] << np.uint32(8) | x[1:]
        three = two[:-1] << np.uint32(8) | x[2:]
        for grams in ((two[:CHUNK] | np.uint32(1 << 31)), three[:CHUNK]):
            out += np.bincount((grams * mul) >> shift, minlength=1 << SIZE_BITS)
    out = np.sqrt(out)
    return (out / max(1e-9, np.linalg.norm(out))).astype(np.float32)


def codewords(classes: int) -> np.ndarray:
    """classes x bits of +1 and -1: all splits for up to 7 classes, else the most apart of random codes."""
    if classes <= 7:
        rows = [(1, *p) for p in product((1, -1), repeat=classes - 1)]
        return np.array([p for p in rows if -1 in p], dtype=np.int8).T.reshape(classes, -1)
    rng, best, apart = np.random.default_rng(7), None, -1
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], dtype=np.int8), size=(classes, int(15 * np.ceil(np.log2(classes)))))
        code = code[:, np.abs(code.sum(axis=0)) < classes]
        least = min(int((code[i] != code[:i]).sum(axis=1).min()) for i in range(1, classes))
        if least > apart:
            best, apart = code, least
    return best


class Model:
    """langs, code (langs x bits), bits' weights and offsets, and the decoding weights (langs x bits)."""

    def __init__(self, langs: list[str], x: np.ndarray, y: np.ndarray, rounds: int = 150):
        self.langs = langs
        self.code = codewords(len(langs)) if len(langs) > 1 else np.zeros((len(langs), 0), dtype=np.int8)
        held = np.arange(len(y)) % 4 == 3
        self.fit(x[~held], y[~held], rounds)
        self.weights = np.ones(self.code.shape)
        if self.code.shape[1]:
            right = (np.sign(self.bits(x[held])) == self.code[y[held]]) if held.any() else np.zeros((0, self.code.shape[1]))
            for k in range(len(langs)):
                mine = right[y[held] == k]
                self.weights[k] = (mine.sum(axis=0) + 1) / (len(mine) + 2)
            self.weights /= self.weights.sum(axis=1, keepdims=True)

    def fit(self, x: np.ndarray, y: np.ndarray, rounds: int) -> None:
        """Logistic regression of all bits at once, by gradient steps with momentum."""
        target = self.code[y].astype(np.float32)
        self.w = np.zeros((x.shape[1], self.code.shape[1]), dtype=np.float32)
        self.b = np.zeros(self.code.shape[1], dtype=np.float32)
        dw, db, n = np.zeros_like(self.w), np.zeros_like(self.b), max(1, len(y))
        for _ in range(rounds if len(y) else 0):
            g = -target / (1 + np.exp(target * (x @ self.w + self.b)))
            dw = 0.9 * dw - 4.0 * (x.T @ g / n + 1e-5 * self.w)
            db = 0.9 * db - 0.5 * g.mean(axis=0)
            self.w += dw
            self.b += db

    def bits(self, x: np.ndarray) -> np.ndarray:
        return x @ self.w + self.b

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        """Languages, scores and flags of ambiguity."""
        known = [i for i, t in enumerate(texts) if has_letters(t)]
        lang, score, unsure = [UND] * len(texts), [0.0] * len(texts), [False] * len(texts)
        if not self.langs or not known:
            return lang, score, unsure
        if len(self.langs) == 1:
            for i in known:
                lang[i], score[i] = self.langs[0], 1.0
            return lang, score, unsure
        f = self.bits(np.stack([counts(texts[i]) for i in known])).astype(np.float64)
        loss = np.logaddexp(0, -self.code[None] * f[:, None, :])
        loss = (loss * self.weights[None]).sum(axis=2)
        share = np.exp(-4 * (loss - loss.min(axis=1, keepdims=True)))
        share /= share.sum(axis=1, keepdims=True)
        best = loss.argmin(axis=1)
        two = np.sort(loss, axis=1)[:, :2]
        for i, k, s, gap in zip(known, best, share.max(axis=1), two[:, 1] - two[:, 0], strict=True):
            lang[i], score[i], unsure[i] = self.langs[k], float(s), bool(gap < 0.05)
        return lang, score, unsure


#: Most sample rows in all: their n-gram counts (16 KB each) go to the driver.
MOST_ROWS = 20_000


def held_out() -> Column:
    """Never learned from: crc32 of the id as text, mod 4, is 2 (or there is no id)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(True))


def train(docs: DataFrame, per_language: int = 400) -> Model:
    """Fit on about ``per_language`` rows of each language, fewer where more than 50 languages share ``MOST_ROWS``,
    chosen by a hash of the id."""
    rows = docs.select(F.col("doc_id").cast("long"), "text", "lang").where("lang is not null").where(~held_out())
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return Model([], np.zeros((0, 1 << SIZE_BITS), dtype=np.float32), np.zeros(0, dtype=int))
    per_language = max(4, min(per_language, MOST_ROWS // len(sizes)))
    pick = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 62))
    share = docs.sparkSession.createDataFrame([(k, int(min(1.0, per_language / n) * (1 << 62))) for k, n in sizes.items()], "_lang string, _share long")
    side = F.broadcast(share) if len(sizes) <= common.BROADCAST_ROWS else share
    chosen = rows.join(side, F.col("lang") == F.col("_lang")).where(pick < F.col("_share")).drop("_lang", "_share")

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            found = [(d, g, counts(t).tobytes()) for d, t, g in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "lang")), strict=True)
                     if has_letters(t)]
            yield common.batch_of({"doc_id": [x[0] for x in found], "lang": [x[1] for x in found], "x": [x[2] for x in found]},
                                  {"doc_id": pa.int64(), "lang": pa.string(), "x": pa.binary()})

    found = common.arrow_pass(chosen, run, "doc_id long, lang string, x binary").collect()
    found.sort(key=lambda r: (hash_of(r.doc_id), r.lang, r.x))
    langs = sorted({r.lang for r in found})
    at = {g: k for k, g in enumerate(langs)}
    x = np.stack([np.frombuffer(r.x, dtype=np.float32) for r in found]) if found else np.zeros((0, 1 << SIZE_BITS), dtype=np.float32)
    return Model(langs, x, np.array([at[r.lang] for r in found], dtype=int))


def hash_of(doc_id: int) -> int:
    """A fixed mixed order, so that each part of the sample has all languages."""
    return doc_id * 0x9E3779B97F4A7C15 % (1 << 64)


def with_language(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` as they are, then lang_pred, score and ambiguous; one pass, no shuffle."""
    text_at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            lang, score, unsure = model.predict(b.column(text_at).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lang, type=pa.string()), pa.array(score, type=pa.float64()),
                                              pa.array(unsure, type=pa.bool_())], names=names)

    added = [c if c not in docs.columns else f"{c}_" for c in ("lang_pred", "score", "ambiguous")]
    names = [*docs.columns, *added]
    out = common.arrow_pass(docs, run, StructType([*docs.schema.fields, StructField(added[0], StringType()), StructField(added[1], DoubleType()), StructField(added[2], BooleanType())]))
    return out


def language_id(docs: DataFrame, per_language: int = 400) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, ambiguous."""
    own = docs.select(F.col("doc_id").cast("long"), "text", "lang")
    return (with_language(own.select("doc_id", "text"), train(own, per_language))
            .select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous"))


def keep_known(docs: DataFrame, per_language: int = 400, wanted: list[str] | None = None) -> DataFrame:
    """The documents whose predicted language is wanted (None: any but ``und``), columns unchanged.

    A document without ``lang`` gets the predicted one; an ambiguous prediction
    neither rejects a document nor fills it in."""
    named = with_language(docs, train(docs, per_language))
    pred, _, unsure = named.columns[-3:]
    fits = F.col(pred) != UND if wanted is None else F.col(unsure) | F.col(pred).isin(*wanted)
    lang = F.coalesce(F.col("lang"), F.when(~F.col(unsure), F.col(pred)).cast(docs.schema["lang"].dataType))
    return named.where((F.col(pred) != UND) & fits).select(*[lang.alias(c) if c == "lang" else F.col(c) for c in docs.columns])
