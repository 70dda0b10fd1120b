"""Cross-tokenizer alignment: which ids of one tokenizer stand where which ids of another do.

Byte offsets where tokens of both tokenizers end cut a text into groups. A
group of one token on each side is a one-to-one group: both tokens have the
same bytes, so for the first id the second is read from an identity map (id of
A to the id of B with the same bytes), made once from the two files. Such
pairs are counted, once a document, in a vector as long as A's vocabulary; only
the pairs of irregular groups enter the pair shuffle.

Texts are cut into units before a single space that a visible character
follows. Both tokenizers end a token there, so units align on their own, and a
worker keeps the units it has met. Documents are dealt into blocks of some
16 MB of text: a block writes its documents as positions in its own list of
pairs, and asks for the corpus-wide counts of that list alone, so neither the
texts nor a row for each pair of each document is shuffled.

Defined results: texts that are null, empty, or whose joined bytes under either
tokenizer differ from a space and the text have zeros and the empty string;
repeated rows come back as often as they came and count as documents of their
own; null ids stay null; other columns do not matter; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import common
from basketry.llm.tokens import ALPHABET

#: A cut: a lone space before a printable character of the usual scripts. No token of B spans it (see Aligner).
CUT = re.compile("(?<! ) (?=[!-~¡-ᙿ、-퟿])")
#: Text of a block, units that a worker keeps, and the length up to which they are kept.
BLOCK_BYTES, KEPT_UNITS, KEPT_CHARS = 1 << 24, 200_000, 64
#: Units of one call of A.
JOINED = 256
#: Pairs of the identity map are written as their id of A, other pairs as (a + 1) * WIDE + b.
WIDE = 1 << 16
NOTHING = (0, 0, 0, "", b"")


def units_of(text: str) -> list[str]:
    """The text, with a space before it, cut at its safe boundaries; the space of each cut is left out."""
    head, *rest = CUT.split(" " + text)
    return [head[1:], *rest] if head else rest


class Aligner:
    """Aligns units under both tokenizers; keeps what it has met."""

    def __init__(self, a_file: str, b_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # no threads beside Spark's own
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        back = {c: b for b, c in ALPHABET.items()}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for entry, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(back[c] for c in entry) if all(c in back for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        if max(len(self.a_bytes), len(self.b_bytes)) >= WIDE or any("▁" in p.lstrip("▁") for p in pieces if "▁" in p):
            raise ValueError("vocabularies below 65,536 ids, without pieces that hold a space after a letter, are needed")
        by_bytes = {x: i for i, x in reversed(list(enumerate(self.b_bytes))) if not self.b.is_byte(i)}
        by_bytes = {x: i for i, x in enumerate(self.b_bytes) if self.b.is_byte(i)} | by_bytes
        self.same = np.array([by_bytes.get(x, -1) for x in self.a_bytes])
        self.a_size, self.b_size = (np.array([len(x) for x in v]) for v in (self.a_bytes, self.b_bytes))
        self.numbers = [str(i) for i in range(WIDE)]
        self.alone = [f"{i}|{x}" for i, x in enumerate(self.same.tolist())]  # a one-to-one group of the identity map, as text
        self.kept = common.Memory(KEPT_UNITS)

    @staticmethod
    def fits(ids: np.ndarray, count: np.ndarray, token_bytes: list[bytes], token_size: np.ndarray, raw: list[bytes], size: np.ndarray) -> bool:
        """Are the tokens' bytes those of the units, of each?"""
        upto = np.concatenate([[0], np.cumsum(token_size[ids])])
        return bool((upto[np.cumsum(count)] == np.cumsum(size)).all()) and b"".join(map(token_bytes.__getitem__, ids.tolist())) == b"".join(raw)

    def ids_a(self, units: list[str], size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units, how many each has) under A; ``size``: bytes of each unit and its space.

        Many units make one call: a token ends wherever one ends, so the calls' ids are dealt out by their bytes."""
        texts = ["".join([" " + u for u in units[i:i + JOINED]]) for i in range(0, len(units), JOINED)]
        ids = np.fromiter(chain.from_iterable(e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)), dtype=np.int64)
        ends, upto = np.cumsum(self.a_size[ids]), np.cumsum(size)
        last = np.searchsorted(ends, upto)
        if len(units) and (len(ends) <= last[-1] or (ends[last] != upto).any()):  # no unit of its own here: each for itself
            found = [e.ids for e in self.a.encode_batch_fast([" " + u for u in units], add_special_tokens=False)]
            return np.fromiter(chain.from_iterable(found), dtype=np.int64), np.array([len(x) for x in found])
        return ids, np.diff(last, prepend=-1)

    def learn(self, units: list[str]) -> dict[str, tuple | None]:
        """Of each unit: (tokens of A, of B, groups, groups as text, codes of the links as bytes); None where bytes differ.

        The units stand one behind the other, so their byte offsets are cut into groups in one go.
        """
        out: dict[str, tuple | None] = {}
        odd = [u for u in units if not u or u[0].isspace() or u[-1].isspace()]  # white space may join that of a neighbour
        if odd and len(units) > 1:
            for u in odd:
                out |= self.learn([u])
            gone = set(odd)
            units = [u for u in units if u not in gone]
        raw = [(" " + u).encode() for u in units]
        size = np.array([len(t) for t in raw], dtype=np.int64)
        ids_a, count_a = self.ids_a(units, size)
        b = self.b.encode(units, num_threads=1)
        ids_b, count_b = np.fromiter(chain.from_iterable(b), dtype=np.int64), np.array([len(x) for x in b], dtype=np.int64)
        if not (self.fits(ids_a, count_a, self.a_bytes, self.a_size, raw, size) and self.fits(ids_b, count_b, self.b_bytes, self.b_size, raw, size)):
            if len(units) > 1:  # some unit does not come back: halves find it
                half = len(units) // 2
                return out | self.learn(units[:half]) | self.learn(units[half:])
            return out | dict.fromkeys(units)
        ends_a, ends_b = np.cumsum(self.a_size[ids_a]), np.cumsum(self.b_size[ids_b])
        last_a, last_b = np.flatnonzero(np.isin(ends_a, ends_b, assume_unique=True)), np.flatnonzero(np.isin(ends_b, ends_a, assume_unique=True))
        first_a, first_b = (np.concatenate([[0], v[:-1] + 1])[:len(v)] for v in (last_a, last_b))
        n_a, n_b = last_a - first_a + 1, last_b - first_b + 1
        number = self.numbers
        text = list(map(self.alone.__getitem__, ids_a[last_a].tolist()))
        mixed = np.flatnonzero((n_a > 1) | (n_b > 1) | (self.same[ids_a[last_a]] != ids_b[last_b]))
        of_a, of_b = ids_a.tolist(), ids_b.tolist()
        for g, i, j, k, m in zip(*(v.tolist() for v in (mixed, first_a[mixed], last_a[mixed], first_b[mixed], last_b[mixed]))):
            text[g] = ",".join([number[x] for x in of_a[i:j + 1]]) + "|" + ",".join([number[y] for y in of_b[k:m + 1]])
        links = np.cumsum(n_a * n_b)
        group = np.repeat(np.arange(len(links)), n_a * n_b)
        place = np.arange(len(group)) - (links - n_a * n_b)[group]
        x, y = ids_a[first_a[group] + place // n_b[group]], ids_b[first_b[group] + place % n_b[group]]
        codes = np.where(self.same[x] == y, x, (x + 1) * WIDE + y).tobytes()
        upto = np.searchsorted(ends_a[last_a], np.cumsum(size), side="right")
        bytes_upto = (8 * np.concatenate([[0], links])[upto]).tolist()
        g0 = c0 = 0
        for u, x, y, g, c in zip(units, count_a.tolist(), count_b.tolist(), upto.tolist(), bytes_upto):
            out[u] = (x, y, g - g0, ";".join(text[g0:g]), codes[c0:c])
            g0, c0 = g, c
        return out

    def documents(self, texts: list[str]) -> list[tuple]:
        """(tokens of A, of B, groups, groups as text, codes of the links) of whole texts."""
        cut = [units_of(t) if t else [] for t in texts]
        new = list(self.kept.missing(set().union(*cut)))
        now = self.kept.now
        now.update(self.learn(new))
        out = []
        for units in cut:
            met = [now[u] for u in units]
            if not met or None in met:
                out.append(NOTHING)
            else:
                n_a, n_b, groups, text, codes = zip(*met)
                out.append((sum(n_a), sum(n_b), sum(groups), ";".join(text), b"".join(codes)))
        for u in new:
            if len(u) > KEPT_CHARS:
                del now[u]
        return out


_ALIGNERS: dict = {}


def aligner(a_file: str, b_file: str) -> Aligner:
    """This worker's aligner: what it has met stays from task to task."""
    if (a_file, b_file) not in _ALIGNERS:
        _ALIGNERS[a_file, b_file] = Aligner(a_file, b_file)
    return _ALIGNERS[a_file, b_file]


#: Rows of a block: its documents (0), its irregular pairs (1), and, once a task, the vector (2).
ROWS = {"kind": pa.int32(), "block": pa.int64(), "doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(),
        "n_links": pa.int64(), "groups_sha256": pa.string(), "same": pa.list_(pa.int32()), "same_times": pa.list_(pa.int32()),
        "pairs": pa.list_(pa.int32()), "pair_times": pa.list_(pa.int32()),
        "a": pa.int32(), "b": pa.int32(), "place": pa.int32(), "n": pa.int64()}
ROWS_DDL = ("kind int, block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, same array<int>, "
            "same_times array<int>, pairs array<int>, pair_times array<int>, a int, b int, place int, n long")


def lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32)))


def rows_of(kind: int, n: int, columns: dict) -> pa.RecordBatch:
    """A batch of ``ROWS`` with nulls in the columns that this kind has not."""
    full = {"kind": np.full(n, kind)} | columns
    return pa.RecordBatch.from_arrays([pa.nulls(n, t) if k not in full else full[k] if isinstance(full[k], pa.Array) else pa.array(full[k], type=t)
                                       for k, t in ROWS.items()], names=list(ROWS))


class Block:
    """Documents of one block, as codes and how often each stands in the document."""

    def __init__(self, number: int):
        self.number, self.size, self.rows, self.codes, self.times = number, 0, [], [], []

    def add(self, doc_id: int | None, size: int, found: tuple, vector: np.ndarray) -> None:
        *numbers, text, codes = found
        code, times = np.unique(np.frombuffer(codes, dtype=np.int64), return_counts=True)
        vector[code[:np.searchsorted(code, WIDE)]] += 1
        self.rows.append((doc_id, *numbers, len(codes) // 8, hashlib.sha256(text.encode()).hexdigest() if text else ""))
        self.codes.append(code)
        self.times.append(times)
        self.size += size

    def batches(self) -> Iterator[pa.RecordBatch]:
        if not self.rows:
            return
        at = [int(np.searchsorted(c, WIDE)) for c in self.codes]
        odd = [c[k:] for c, k in zip(self.codes, at)]
        pairs, place, n = np.unique(np.concatenate(odd), return_inverse=True, return_counts=True)
        place = np.split(place, np.cumsum([len(o) for o in odd])[:-1])
        doc_id, n_a, n_b, groups, links, digest = map(list, zip(*self.rows))
        here = np.full(len(self.rows), self.number)
        yield rows_of(0, len(self.rows), {
            "block": here, "doc_id": doc_id, "n_a": n_a, "n_b": n_b, "n_groups": groups, "n_links": links, "groups_sha256": digest,
            "same": lists([c[:k] for c, k in zip(self.codes, at)]), "same_times": lists([t[:k] for t, k in zip(self.times, at)]),
            "pairs": lists(place), "pair_times": lists([t[k:] for t, k in zip(self.times, at)])})
        for s in range(0, len(pairs), 65536):
            p = pairs[s:s + 65536]
            yield rows_of(1, len(p), {"block": np.full(len(p), self.number), "a": p // WIDE - 1, "b": p % WIDE,
                                      "place": np.arange(s, s + len(p)), "n": n[s:s + 65536]})


def blocks(docs: DataFrame, a_name: str, b_name: str) -> DataFrame:
    """Documents, irregular pairs and vectors of every block, written once into the shared folder."""
    def run(batches: Iterator[pa.RecordBatch]):
        of = aligner(public_tokenizers.path(a_name), public_tokenizers.path(b_name))
        vector = np.zeros(len(of.same), dtype=np.int64)
        number = TaskContext.get().partitionId() << 32
        block = Block(number)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc_id, t, found in zip(batch.column("doc_id").to_pylist(), texts, of.documents(texts), strict=True):
                block.add(doc_id, len(t.encode()), found, vector)
            if block.size >= BLOCK_BYTES or len(block.rows) >= 8192:
                yield from block.batches()
                block = Block(block.number + 1)
        yield from block.batches()
        met = np.flatnonzero(vector)
        yield rows_of(2, len(met), {"a": met, "n": vector[met]})

    return common.parked(common.arrow_pass(docs.select(F.col("doc_id").cast("long"), "text"), run, ROWS_DDL))


def sums(values: np.ndarray, column: pa.ListArray, times: pa.ListArray) -> np.ndarray:
    """For each list: the sum of the values at its numbers, each as often as ``times`` says."""
    ends = column.offsets.to_numpy()
    weighted = values[column.flatten().to_numpy()] * times.flatten().to_numpy()
    total = np.concatenate([[0], np.cumsum(weighted)])
    return total[ends[1:] - ends[0]] - total[ends[:-1] - ends[0]]


def align_tokenizers(docs: DataFrame, a_name: str = "byte_bpe_50k.json", b_name: str = "piece_bpe_32k.model") -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    The driver gets two vectors as long as A's vocabulary, never pairs or documents.
    """
    met = blocks(docs, a_name, b_name)
    asked = met.where("kind = 1").select("block", "a", "b", "place", "n")
    odd = common.parked(asked.groupBy("a", "b").agg(F.sum("n").alias("n")))
    tops = odd.groupBy("a").agg(F.lit(0).cast("long").alias("same"), F.max("n").alias("odd"))
    vectors = (met.where("kind = 2").groupBy("a").agg(F.sum("n").alias("same"), F.lit(0).cast("long").alias("odd")).unionByName(tops)
               .groupBy("a").agg(F.max("same").alias("same"), F.max("odd").alias("odd")))
    size = len(aligner(public_tokenizers.path(a_name), public_tokenizers.path(b_name)).same)
    same, top = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
    for r in vectors.toLocalIterator():
        same[r.a], top[r.a] = r.same, max(r.same, r.odd)
    same_best = (same == top).astype(np.int64)
    answers = asked.drop("n").join(odd, ["a", "b"]).select(F.col("block").alias("asker"), "a", "place", "n")

    out = {"doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(),
           "n_best": pa.int64(), "count_sum": pa.int64(), "groups_sha256": pa.string()}

    def tell(block: pa.Table, told: pa.Table) -> pa.Table:
        n = np.zeros(told.num_rows, dtype=np.int64)
        best = np.zeros(told.num_rows, dtype=np.int64)
        place, count = told.column("place").to_numpy(), told.column("n").to_numpy()
        n[place] = count
        best[place] = count == top[told.column("a").to_numpy()]
        lists_of = {k: block.column(k).combine_chunks() for k in ("same", "same_times", "pairs", "pair_times")}
        lists_of = {k: v.chunk(0) if isinstance(v, pa.ChunkedArray) else v for k, v in lists_of.items()}
        found = {"n_best": sums(same_best, lists_of["same"], lists_of["same_times"]) + sums(best, lists_of["pairs"], lists_of["pair_times"]),
                 "count_sum": sums(same, lists_of["same"], lists_of["same_times"]) + sums(n, lists_of["pairs"], lists_of["pair_times"])}
        return pa.table({k: pa.chunked_array([pa.array(found[k], type=t)]) if k in found else block.column(k) for k, t in out.items()})

    documents = met.where("kind = 0").drop("kind", "a", "b", "place", "n")
    return documents.groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(
        tell, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
