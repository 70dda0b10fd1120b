"""Best-fit packing: bounded-space online best-fit.

Documents become token ids with an end id, and only those longer than a
sequence are cut. Pieces arrive in hash order; each goes into the open bin with
the least free space that holds it. A fixed number of bins is open, found
through a bitset keyed by free space (one shift and one lowest set bit a
piece); when a new bin is needed beyond that number, the fullest closes first.

Ids are made in one pass without a shuffle; only the pieces' lengths are dealt
anew, into tasks large enough that the bins left open at their ends hardly
count, and few enough rows (some 50 bytes each) that a task is small.

Defined results: a null or empty text is one piece, the end id; repeated rows
are packed as often as they come; null doc_ids are packed too; other columns
do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from basketry.llm import common
from basketry.llm.tokens import ALPHABET, CALL_BYTES, KEPT_CHARS, by_bytes, load

#: A Latin word with marks the tokenizer sets apart. Upper case never comes here.
SIMPLE = re.compile(rb"((?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+)([.,;:?]?)")
#: Marks that compose with the letter before them: there lower case and composition may not commute.
COMBINING = re.compile("[̀-ͯ]")
KEPT_WORDS = 300_000
SEQUENCE, OPEN_BINS = 2048, 256
#: Tokens that one packing task gets, at least: some 4,000 sequences.
TASK_TOKENS = 8_000_000


class Encoder:
    """Ids of whole texts with a tokenizer that drops white space, as little-endian bytes.

    White space always ends a word there, so a text is its words between
    ASCII white space. Words repeat; the ids of those met are kept, up to a
    bounded number, and new ones are encoded in batches balanced by bytes.
    """

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.word = self.tokenizer.model.tokenize
        self.kept = common.Memory(KEPT_WORDS)
        self.marks: dict[bytes, bytes] = {}

    def ids(self, codes: list[int]) -> bytes:
        return np.array(codes, dtype="<u4").tobytes()

    def learn(self, words: set[bytes]) -> None:
        """Put the ids of new words into ``kept.now``."""
        now, rest, simple, marks = self.kept.now, [], SIMPLE.fullmatch, self.marks
        for w in words:
            m = simple(w)
            if m and len(w) <= KEPT_CHARS:
                letters, mark = m.groups()
                of = now.get(letters)
                if of is None:
                    text = letters.decode() if letters.isascii() else letters.decode("latin-1").translate(ALPHABET)
                    of = now[letters] = array("I", [t.id for t in self.word(text)]).tobytes()
                if mark:
                    if mark not in marks:
                        marks[mark] = self.ids([t.id for t in self.word(mark.decode())])
                    now[w] = of + marks[mark]
            else:
                rest.append(w)
        for batch in by_bytes(rest, CALL_BYTES):
            codes = self.tokenizer.encode_batch_fast([w.decode() for w in batch], add_special_tokens=False)
            now.update(zip(batch, (self.ids(c.ids) for c in codes), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = []
        for t in texts:
            data = t.encode()
            # lower case first makes more words equal; not where special strings or combining marks could tell
            cut.append((data if "<|" in t or not t.isascii() and COMBINING.search(t) else data.lower()).split())
        new = self.kept.missing(set().union(*cut))
        self.learn(new)
        now = self.kept.now
        get = now.__getitem__
        out = [b"".join(map(get, words)) for words in cut]
        for w in new:
            if len(w) > KEPT_CHARS:
                del now[w]
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder: what it has met stays from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", size: int = SEQUENCE, end_id: int = 0,
           with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, ids."""
    types = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()}
    types |= {"ids": pa.list_(pa.int64())} if with_ids else {}

    def run(batches: Iterator[pa.RecordBatch]):
        of, end = encoder(public_tokenizers.path(tokenizer)), np.array([end_id], dtype="<u4").tobytes()
        for b in batches:
            out: dict = {k: [] for k in types}
            for doc, data in zip(b.column("doc_id").to_pylist(), of.encode([t or "" for t in b.column("text").to_pylist()]), strict=True):
                data += end
                for k, at in enumerate(range(0, len(data), 4 * size)):
                    part = data[at:at + 4 * size]
                    row = (doc, k, at // 4, len(part) // 4, zlib.crc32(part))
                    for name, value in zip(types, row, strict=False):
                        out[name].append(value)
                    if with_ids:
                        out["ids"].append(np.frombuffer(part, dtype="<u4"))
            yield common.batch_of(out, types)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return common.arrow_pass(docs.select(F.col("doc_id").cast("long"), "text"), run, schema)


class Bins:
    """Open bins by free space. ``spaces`` has bit f set if some open bin has f free."""

    def __init__(self, size: int, most: int):
        self.size, self.most, self.made, self.open = size, most, 0, 0
        self.spaces, self.by_space = 0, {}

    def _take(self, free: int) -> int:
        held = self.by_space[free]
        bin_no = held.pop()
        if not held:
            self.spaces &= ~(1 << free)
        self.open -= 1
        return bin_no

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece: the tightest open bin, else a new one."""
        fits = self.spaces >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            bin_no = self._take(free)
        else:
            free, bin_no = self.size, self.made
            self.made += 1
        left = free - length
        if left:
            if self.open == self.most:
                self._take((self.spaces & -self.spaces).bit_length() - 1)  # closes: never found again
            self.spaces |= 1 << left
            self.by_space.setdefault(left, []).append(bin_no)
            self.open += 1
        return bin_no, self.size - free


def pack(parts: DataFrame, size: int = SEQUENCE, open_bins: int = OPEN_BINS, task_tokens: int = TASK_TOKENS) -> DataFrame:
    """The pieces (with doc_id, piece, length) and their sequence_id and offset."""
    parts = common.stored(parts)
    total = parts.agg(F.sum("length")).first()[0] or 0
    schema = StructType([*parts.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def run(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext

        bins, first = Bins(size, open_bins), TaskContext.get().partitionId() << 40
        for b in batches:
            placed = [bins.place(n) for n in b.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([first + i for i, _ in placed], type=pa.int64()), pa.array([o for _, o in placed], type=pa.int64())],
                names=[*b.schema.names, "sequence_id", "offset"])

    # hash order: lengths come mixed, and the order is the same when a lost task runs again
    dealt = parts.repartition(max(1, total // task_tokens)).sortWithinPartitions(F.xxhash64("doc_id", "piece"), "doc_id", "piece", "length", "ids_crc32")
    return dealt.mapInArrow(run, schema)


def best_fit_pack(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", size: int = SEQUENCE, open_bins: int = OPEN_BINS,
                  with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids), sequence_id, offset."""
    return pack(pieces(docs, tokenizer, size, with_ids=with_ids), size, open_bins)
