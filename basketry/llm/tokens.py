"""Token counts: batch encoding in Arrow functions that return lengths only.

A text is cut at safe boundaries: before a space that is followed by a visible
character. A byte-level pre-tokenizer always starts a word there, so counts of
the parts add up to the count of the whole. A part that is still long (text
without spaces, such as lists or Chinese) is cut on at the other edges where
words always end: between letters, digits and marks and behind a lone line feed,
never behind an apostrophe and never inside a special token. So no call gets
more than some ``CALL_BYTES``, unless one word alone is longer. Parts repeat a
lot; each worker keeps the counts of the parts it has met (a bounded table) and
encodes only new ones, in batches balanced by their bytes.

Defined results: a null text counts as empty and has 0 tokens; strings of
special tokens inside a text are single tokens, the library's default;
repeated rows come back as often as they came; other columns do not matter; an
empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import common

#: A cut: a space before a printable character of the usual scripts (never white space).
CUT = re.compile(" (?=[!-~¡-ᙿ、-퟿])")
#: A space that is no cut.
ODD = re.compile(" (?![!-~¡-ᙿ、-퟿])")
#: Edges inside a part where a word of the pre-tokenizer always ends.
EDGE = regex.compile(r"(?<=\p{L})(?=[^\s\p{L}])|(?<=\p{N})(?=[^\s\p{N}])|(?<=[^\s\p{L}\p{N}'])(?=[\p{L}\p{N}])|(?<=\S\n)(?=\S)")
#: Bytes of one call of the library, parts and longest part that are kept in a worker.
CALL_BYTES, KEPT_PARTS, KEPT_CHARS = 1 << 18, 400_000, 64
#: Characters after which a part without spaces is cut at the next edge.
STRETCH = 4096


def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte: itself, or the next one from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


ALPHABET = byte_alphabet()
_LOADED: dict = {}


def load(path: str):
    """The tokenizer, once for each worker; it must not start threads of its own there."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        _LOADED[path] = Tokenizer.from_file(path)
    return _LOADED[path]


def by_bytes(parts: Iterable[str | bytes], most: int) -> Iterator[list]:
    """Batches of at most ``most`` bytes; a longer part is a batch of its own."""
    batch, size = [], 0
    for p in parts:
        n = len(p) if isinstance(p, bytes) or p.isascii() else len(p.encode("utf-8", "surrogatepass"))
        if batch and size + n > most:
            yield batch
            batch, size = [], 0
        batch.append(p)
        size += n
    if batch:
        yield batch


def pieces_of(text: str) -> list[str]:
    """The text cut at its safe boundaries; the space of each cut is left out."""
    return CUT.split(text) if ODD.search(text) else text.split(" ")


class Counter:
    """Counts tokens of whole texts with a byte-level tokenizer file."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.kept = common.Memory(KEPT_PARTS)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    def cut(self, text: str) -> list[str]:
        """A long part, cut into stretches of about ``STRETCH`` characters at its edges."""
        if len(text) <= STRETCH:
            return [text]
        out = []
        for i, run in enumerate(self.special.split(text) if self.special else [text]):
            if i % 2:  # a special token
                out.append(run)
                continue
            start = 0
            while len(run) - start > STRETCH:
                edge = EDGE.search(run, start + STRETCH)
                if edge is None:
                    break
                out.append(run[start:edge.start()])
                start = edge.start()
            out.append(run[start:])
        return [x for x in out if x]

    def encoded(self, texts: list[str]) -> list[int]:
        """Counts of texts as they are, long ones in parts."""
        parts = [self.cut(t) for t in texts]
        n = [len(c.ids) for batch in by_bytes((p for x in parts for p in x), CALL_BYTES)
             for c in self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)]
        out, at = [], 0
        for x in parts:
            out.append(sum(n[at:at + len(x)]))
            at += len(x)
        return out

    def counts(self, texts: list[str]) -> list[int]:
        cut = [pieces_of(t) for t in texts]
        heads = self.encoded([c[0] for c in cut])
        new = list(self.kept.missing(set().union(*(c[1:] for c in cut))))
        now = self.kept.now
        now.update(zip(new, self.encoded([" " + p for p in new]), strict=True))
        get = now.__getitem__
        out = [h + sum(map(get, c[1:])) for h, c in zip(heads, cut, strict=True)]
        for p in new:
            if len(p) > KEPT_CHARS:
                del now[p]
        return out


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """This worker's counter: what it has met stays from task to task."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 1024) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    One pass without a shuffle; a task holds one batch of texts.
    """
    types = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "n_tokens": pa.int64(), "over_limit": pa.bool_()}

    def run(batches: Iterator[pa.RecordBatch]):
        of = counter(public_tokenizers.path(tokenizer))
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            n = of.counts(texts)
            yield common.batch_of({"doc_id": b.column("doc_id"), "n_bytes": [len(t.encode("utf-8", "surrogatepass")) for t in texts],
                                   "n_tokens": n, "over_limit": [x > limit for x in n]}, types)

    return common.arrow_pass(docs.select(F.col("doc_id").cast("long"), "text"), run,
                             "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
