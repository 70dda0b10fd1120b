"""Phrase collocation mining by prefix-free parsing.

Every piece of text is parsed into chunks of words that overlap: a chunk ends,
and the next begins, with each window of three words whose hash is 0 modulo
``TRIGGER``; the ends of pieces end chunks too. Boundaries follow content only,
so repeated passages give the same chunks. Distinct chunks form a dictionary
with the frequency of each in the parse, and n-grams are counted inside
distinct chunks only, weighted by it. An n-gram of up to four words belongs to
the chunk in whose own part (all but the three words that the next chunk
repeats) it starts, so overlaps count once.

n-grams are counted level by level, the longer ones only where all their parts
are frequent. Which are frequent a bitmap of hashes tells (16 bits an entry, 2 MB
to 16 MB): it may let rare ones pass, which are then counted and dropped, and
never loses one, so counts are exact at any size. All work on words is done on
byte buffers with numpy, a few MB at a time, so a text of any length is never
held as words; a piece is.

Defined results: a null text counts as empty, a null lang as ``und``; repeated
rows count as often as they come; equal scores are ordered by count, then by
the phrase's bytes; other columns do not matter; an empty table, or one without
frequent phrases, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm import common

#: Longest phrase; words that neighbouring chunks share; one window in so many is a boundary.
LONGEST, SHARED, TRIGGER = 4, 3, 16
#: Bytes of text parsed at a time, and n-grams summed at a time.
SEGMENT, STEP_GRAMS = 1 << 20, 1 << 21
#: Parts in which a language is ranked.
PARTS = 32
#: Bits of a bitmap: sixteen an entry, within these bounds.
LEAST_BITS, MOST_BITS = 1 << 24, 1 << 27

#: Bytes as they count: 0 in a word, 1 between words, 2 at the end of a piece. Only A to Z are lower-cased.
KIND = np.zeros(256, dtype=np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[list(b".,;:!?\x0a\x0b\x0c\x0d")] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Rolling:
    """Polynomial hashes modulo 2^64 of any stretches of a buffer, from one running sum."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, buffer: np.ndarray, base: int):
        known = Rolling._powers.get(base)
        if known is None or len(known[0]) <= len(buffer):
            size = max(SEGMENT, len(buffer)) + 1
            steps = np.ones((2, size), dtype=np.uint64)
            steps[:, 1:] = np.array([[base], [pow(base, -1, 1 << 64)]], dtype=np.uint64)
            known = tuple(np.cumprod(steps, axis=1, dtype=np.uint64))
            if size <= 4 * SEGMENT:
                Rolling._powers[base] = known
        self.down = known[1]
        self.sums = np.zeros(len(buffer) + 1, dtype=np.uint64)
        np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * known[0][:len(buffer)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over the word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of two neighbours in this order."""
    return mixed(a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1))


#: Bases of the two hashes that tell stretches apart within a step.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def taken(buffer: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.StringArray:
    """Stretches of a buffer as strings."""
    size = end - start
    ends = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(start - ends[:-1], size) + np.arange(ends[-1])
    return pa.StringArray.from_buffers(len(start), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(buffer[at]))


def parse(texts: list[bytes], codes: np.ndarray) -> tuple:
    """The distinct chunks of some texts: (code of their language, chunk, last, own words, how often)."""
    raw = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    kind = KIND[raw]
    word = kind == 0
    before = np.concatenate([[False], word[:-1]])
    starts = np.flatnonzero(word & ~before)
    keep = word | before  # words, each with one mark behind it
    text = LOWER[raw[keep]]
    text[~word[keep]] = 32
    at = np.concatenate([[0], np.cumsum(np.flatnonzero(~word & before) - starts + 1)])  # word i is text[at[i]:at[i + 1] - 1]
    n = len(starts)
    piece = np.cumsum(kind == 2)[starts]
    new = np.ones(n, dtype=bool)
    new[1:] = piece[1:] != piece[:-1]
    lanes = [Rolling(text, base) for base in BASES]
    h = lanes[0].of(at[:-1], at[1:] - 1)
    cut = new.copy()
    if n > SHARED:
        window = mixed(h[:-2] + np.uint64(3) * h[1:-1] + np.uint64(7) * h[2:])
        cut[:-2] |= (piece[:-2] == piece[2:]) & (window % np.uint64(TRIGGER) == 0)
    first = np.flatnonzero(cut)
    following = np.concatenate([first[1:], [n]])
    last = np.concatenate([new, [True]])[following]
    start, end = at[first], at[following + np.where(last, 0, SHARED)] - 1
    code = codes[np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts[first], side="right")]
    x, y = lanes[0].of(start, end), joined(lanes[1].of(start, end), (code * 2 + last).astype(np.uint64))
    by = np.lexsort((y, x))
    fresh = np.ones(len(by), dtype=bool)
    fresh[1:] = (x[by][1:] != x[by][:-1]) | (y[by][1:] != y[by][:-1])
    heads = np.flatnonzero(fresh)
    pick = by[heads]
    times = np.diff(np.concatenate([heads, [len(by)]]))
    return code[pick], taken(text, start[pick], end[pick]), last[pick], (following - first)[pick], times


def segments(langs: list[str], texts: list[bytes]) -> Iterator[tuple[list[str], list[bytes]]]:
    """Texts of some SEGMENT bytes at a time; a longer text is cut behind an end of a piece."""
    some, size = ([], []), 0
    for lang, text in zip(langs, texts):
        while text:
            part = text
            if len(text) > SEGMENT:
                ends = np.flatnonzero(KIND[np.frombuffer(text, dtype=np.uint8)] == 2)
                ends = ends[np.searchsorted(ends, SEGMENT - 1):]
                part = text[:int(ends[0]) + 1] if len(ends) else text
            text = text[len(part):]
            some[0].append(lang)
            some[1].append(part)
            size += len(part)
            if size >= SEGMENT:
                yield some
                some, size = ([], []), 0
    if some[0]:
        yield some


def dictionary(docs: DataFrame) -> DataFrame:
    """lang, chunk, last, own (words of the own part), n: the distinct chunks of the parse and how often each stands there."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for langs, texts in segments(b.column("lang").to_pylist(), b.column("text").cast(pa.binary()).to_pylist()):
                names = list(dict.fromkeys(langs))
                number = {x: i for i, x in enumerate(names)}
                code, chunk, last, own, n = parse(texts, np.array([number[x] for x in langs]))
                yield pa.RecordBatch.from_arrays([pa.array(names, type=pa.string()).take(pa.array(code)), chunk, pa.array(last), pa.array(own), pa.array(n)],
                                                 names=["lang", "chunk", "last", "own", "n"])

    kept = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text").where("text is not null")
    parts = common.arrow_pass(kept, run, "lang string, chunk string, last boolean, own long, n long")
    return common.parked(parts.groupBy("lang", "chunk", "last", "own").agg(F.sum("n").alias("n")))


class Entries:
    """n-grams of some dictionary entries, by their place in a buffer."""

    def __init__(self, batch: pa.RecordBatch, bases: tuple[int, ...]):
        chunk = batch.column("chunk")
        ends = np.frombuffer(chunk.buffers()[1], dtype=np.int32)[chunk.offset:chunk.offset + len(chunk) + 1].astype(np.int64)
        self.buffer = np.frombuffer(chunk.buffers()[2], dtype=np.uint8)[ends[0]:ends[-1]]
        ends -= ends[0]
        head = np.zeros(len(self.buffer) + 1, dtype=np.int8)
        head[np.flatnonzero(self.buffer == 32) + 1] = 1
        head[ends[:-1]] = 2
        self.start = np.flatnonzero(head[:-1])
        new = head[self.start] == 2
        self.chunk = np.cumsum(new) - 1
        self.end = np.concatenate([self.start[1:], [len(self.buffer)]]) - np.concatenate([~new[1:], [False]])
        words = np.bincount(self.chunk, minlength=len(chunk))
        self.left = np.cumsum(words)[self.chunk] - np.arange(len(self.start))  # words from here to the chunk's end
        self.own = (self.left > SHARED) | batch.column("last").to_numpy(zero_copy_only=False)[self.chunk]
        self.n = batch.column("n").to_numpy()[self.chunk]
        lang = batch.column("lang").dictionary_encode()
        self.names = lang.dictionary.to_pylist()
        self.lang = lang.indices.to_numpy()
        seed = np.array([xxhash.xxh64_intdigest(x.encode(), seed=42) for x in self.names], dtype=np.uint64)[self.lang][self.chunk]
        self.lanes = [joined(Rolling(self.buffer, base).of(self.start, self.end), seed) for base in bases]
        self.at = np.arange(len(self.start))

    def sift(self, bits: np.ndarray) -> None:
        """Only n-grams that may be frequent stay."""
        place = (self.lanes[0] & np.uint64(len(bits) * 8 - 1)).astype(np.int64)
        fine = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
        self.at, self.lanes = self.at[fine], [x[fine] for x in self.lanes]

    def lengthen(self, k: int) -> None:
        """From the k-grams to the (k + 1)-grams both of whose k-grams are there."""
        both = np.flatnonzero((self.at[1:] == self.at[:-1] + 1) & (self.left[self.at[:-1]] > k))
        self.at, self.lanes = self.at[both], [joined(x[both], x[both + 1]) for x in self.lanes]



def grams(chunks: DataFrame, k: int, maps: list) -> DataFrame:
    """lang, phrase, f: the k-grams of the dictionary whose shorter parts pass the bitmaps (broadcast variables)."""
    def counted(parts: list[Entries]) -> Iterator[pa.RecordBatch]:
        own = [np.flatnonzero(e.own[e.at]) for e in parts]  # those that start in the own part of their chunk
        x, y, at, n = (np.concatenate(v) for v in zip(*((e.lanes[0][o], e.lanes[1][o], e.at[o], e.n[e.at[o]]) for e, o in zip(parts, own))))
        if not len(x):
            return
        of = np.repeat(np.arange(len(parts)), [len(o) for o in own])
        by = np.lexsort((y, x))
        fresh = np.ones(len(by), dtype=bool)
        fresh[1:] = (x[by][1:] != x[by][:-1]) | (y[by][1:] != y[by][:-1])
        heads = np.flatnonzero(fresh)
        total, first = np.add.reduceat(n[by], heads), by[heads]
        for i, e in enumerate(parts):
            mine = np.flatnonzero(of[first] == i)
            place = at[first[mine]]
            if len(mine):
                yield pa.RecordBatch.from_arrays([pa.array(e.names, type=pa.string()).take(pa.array(e.lang[e.chunk[place]])),
                                                  taken(e.buffer, e.start[place], e.end[place + k - 1]), pa.array(total[mine])], names=["lang", "phrase", "f"])

    def run(batches: Iterator[pa.RecordBatch]):
        parts, size = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            e = Entries(b, BASES)
            for shorter, m in enumerate(maps, 1):
                e.sift(m.value)
                e.lengthen(shorter)
            parts.append(e)
            size += len(e.at)
            if size >= STEP_GRAMS:
                yield from counted(parts)
                parts, size = [], 0
        if parts:
            yield from counted(parts)

    common.ship(chunks.sparkSession)
    return (chunks.select("lang", "chunk", "last", "n").mapInArrow(run, "lang string, phrase string, f long")
            .groupBy("lang", "phrase").agg(F.sum("f").alias("f")))


def hashed(frequent: DataFrame, k: int) -> DataFrame:
    """h: the hash that ``Entries`` gives each of the k-grams."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            if b.num_rows:
                one = pa.array(np.ones(b.num_rows, dtype=np.int64))
                e = Entries(pa.RecordBatch.from_arrays([b.column("lang"), b.column("phrase"), pa.array(np.ones(b.num_rows, dtype=bool)), one],
                                                       names=["lang", "chunk", "last", "n"]), BASES[:1])
                for shorter in range(1, k):
                    e.lengthen(shorter)
                yield pa.RecordBatch.from_arrays([pa.array(e.lanes[0].view(np.int64))], names=["h"])

    common.ship(frequent.sparkSession)
    return frequent.select("lang", "phrase").mapInArrow(run, "h long")


def bitmap(frequent: DataFrame) -> np.ndarray:
    """Bits of the hashes ``h``, put together by partial aggregation; at most ``MOST_BITS``."""
    size = LEAST_BITS
    entries = frequent.count()
    while size < min(16 * entries, MOST_BITS):
        size *= 2
    parts = frequent.select(F.expr(f"h & {size - 1}L").alias("place")).selectExpr("place div 64 as at", "shiftleft(1L, cast(place % 64 as int)) as bit")
    found = parts.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(size // 64, dtype=np.int64)
    bits[found.column("at").to_numpy()] = found.column("bits").to_numpy()
    return bits.view(np.uint8)


def exact(c: str) -> Column:
    return F.col(c).cast("decimal(20,0)")


def collocations(docs: DataFrame, least: int = 30, most: int = 2000, covered: int = 80) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``most`` best phrases of each language.

    ``least``: smallest count of a candidate. ``covered``: a candidate goes where
    a longer one around it holds at least so many percent of its count.
    """
    spark = docs.sparkSession
    chunks = dictionary(docs)
    totals = chunks.groupBy("lang").agg(F.sum(F.col("n") * F.col("own")).alias("n"))
    levels: list[DataFrame] = []
    maps: list = []
    for k in range(1, LONGEST + 1):
        levels.append(common.parked(grams(chunks, k, maps).where(F.col("f") >= least).withColumn("k", F.lit(k))))
        if k < LONGEST:
            maps.append(spark.sparkContext.broadcast(bitmap(common.parked(hashed(levels[-1], k)))))
    frequent = levels[0].unionByName(levels[1]).unionByName(levels[2]).unionByName(levels[3])
    found = frequent.where("k > 1")

    cut = found.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1))).selectExpr(
        "lang", "phrase", "f as a", "cut", "substring_index(phrase, ' ', cut) as head", "substring_index(phrase, ' ', cut - k) as tail")
    for part, side in (("l", "head"), ("r", "tail")):
        cut = cut.join(frequent.select("lang", F.col("phrase").alias(side), F.col("f").alias(part)), ["lang", side])
    score = F.expr("cast((cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as long)")
    scored = (cut.withColumn("score", score).groupBy("lang", "phrase")
              .agg(F.first("a").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("low")))

    inner = [F.struct(F.lit(s).alias("s"), F.lit(w).alias("w"), F.lit(k).alias("k")) for k in (3, 4) for w in range(2, k) for s in range(k - w + 1)]
    around = (found.where("k > 2").withColumn("part", F.explode(F.filter(F.array(*inner), lambda x: x.k == F.col("k"))))
              .select("lang", F.concat_ws(" ", F.slice(F.split("phrase", " "), F.col("part.s") + 1, F.col("part.w"))).alias("phrase"), "f")
              .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    kept = (scored.join(around, ["lang", "phrase"], "left").withColumn("longer", F.coalesce("longer", F.lit(0)))
            .where(exact("longer") * 100 < exact("a") * covered)
            .select("lang", "phrase", "a", "low.l", "low.r", "low.score"))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # the best of a language are among the best of its parts: no task ranks a language whole
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    near = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(F.col("rank") <= most)
    best = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= most)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
