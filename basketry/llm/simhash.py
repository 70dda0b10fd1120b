"""SimHash near-dedup: a byte-position inverted index with count filtering.

A fingerprint has 8 bytes. Two fingerprints that differ in at most ``d`` bits
(``d`` < 8) agree in at least 8 - d byte positions, whichever they are. The
index lists fingerprints by (byte positions, their bytes). Lists of one byte
would hold 1/256 of all rows, so that work would grow with the square of the
table; so each list stands for a set of positions (three of them for d = 4),
and the sets are chosen such that every choice of 8 - d agreeing positions
holds one of them. No pair is missed, and a random list has N / 2^24 rows.
Within a list each pair's shared positional bytes are tallied, pairs under the
guaranteed minimum are dropped, and the rest is verified by the bit distance.

Lists are processed in cells of bounded size (``common.cells``); a cell gives
a spanning forest of its links, never all pairs.

Defined results: a null text counts as empty; a text without words has
fingerprint zero and links like any other; a text of fewer words than a
shingle is one shingle; equal fingerprints link at distance 0; repeated rows
come back as often as they came; a null doc_id is kept and never the smallest
id (component_id is null only if no linked row has an id); other columns do
not matter; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import common

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SEED = 42
#: Shingles hashed at a time: bounds a task's memory for texts of any length.
CHUNK = 1 << 16
BITS = ((np.arange(256)[:, None] >> np.arange(8)[None, :]) & 1).astype(np.int64)
OFFSETS = np.arange(8, dtype=np.uint16) * 256


def fingerprint(text: str | None, words: int) -> int:
    """Bit i is set if it is set in more than half of the shingles' XXH64; repeats count."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    n = max(1, len(found) - words + 1)
    starts, ends = starts[:n], ends[len(found) - n:] - 1
    digest, counts = xxhash.xxh64_intdigest, np.zeros((8, 256), dtype=np.int64)
    for at in range(0, n, CHUNK):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at:at + CHUNK].tolist(), ends[at:at + CHUNK].tolist())],
                     dtype=np.uint64)
        places = h.view(np.uint8).reshape(-1, 8) + OFFSETS
        counts += np.bincount(places.ravel(), minlength=2048).reshape(8, 256)
    bits = (counts @ BITS).ravel() * 2 > n
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            fp = np.array([fingerprint(t, words) for t in b.column("text").to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp)], names=["doc_id", "fp"])

    return common.arrow_pass(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, fp long")


def position_sets(distance: int) -> list[tuple[int, ...]]:
    """Sets of byte positions of which each choice of 8 - distance positions holds one.

    For distance 4: the 20 triples of Turan's construction, by three groups of
    positions: inside a group, or two of a group and one of the next. For
    other distances all sets of half the agreeing positions, at least one.
    """
    if distance == 4:
        group = [0, 0, 0, 1, 1, 1, 2, 2]
        kinds = {(0, 0, 0), (1, 1, 1), (0, 0, 1), (1, 1, 2), (0, 2, 2)}
        return [c for c in combinations(range(8), 3) if tuple(sorted(group[i] for i in c)) in kinds]
    return list(combinations(range(8), max(1, (8 - distance + 1) // 2)))


def link_cell(x: np.ndarray, distance: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """A spanning forest of the links within a cell: (roots, members)."""
    roots, members, left = [], [], x
    while left.size > 1:
        root, left = left[0], left[1:]
        queue = [root]
        while queue and left.size:
            differ = left ^ queue.pop()
            tally = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
            near = tally >= 8 - distance
            near[near] = np.bitwise_count(differ[near]) <= distance
            if near.any():
                hit = left[near]
                roots.append(np.full(hit.size, root))
                members.append(hit)
                queue.extend(hit)
                left = left[~near]
    return roots, members


def links(fps: DataFrame, distance: int, limit: int) -> DataFrame:
    """(a, b) of distinct fingerprints: links that keep all components of the link graph."""
    sets = position_sets(distance)
    key = lambda s: F.concat(*[F.substring("bytes", p + 1, 1) for p in s])
    listed = (fps.select("fp", F.unhex(F.lpad(F.hex("fp"), 16, "0")).alias("bytes"))
              .select("fp", F.posexplode(F.array(*[key(s) for s in sets])).alias("set", "part"))
              .select("fp", (F.conv(F.hex("part"), 16, 10).cast("long") * len(sets) + F.col("set")).alias("key")))

    def run(batches: Iterator[pa.RecordBatch]):
        a: list = []
        b: list = []
        rows = 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(v).view(np.int64)) for v in (a, b)], names=["a", "b"])

        for _, (fp,) in common.sorted_groups(batches, ["key", "lo", "hi"], ["fp"]):
            roots, members = link_cell(np.ascontiguousarray(fp).view(np.uint64), distance)
            a += roots
            b += members
            rows += sum(map(len, members))
            if rows >= 1 << 16:
                yield out()
                a, b, rows = [], [], 0
        if rows:
            yield out()

    return common.cells(listed, "fp", limit).select("key", "lo", "hi", "fp").mapInArrow(run, "a long, b long").distinct()


def simhash_dedup(docs: DataFrame, words: int = 4, distance: int = 4, limit: int = 2048) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    ``docs`` has doc_id and text. ``words``: shingle length. ``distance``: most
    bits that linked fingerprints differ in, under 8. ``limit``: largest cell
    of a posting list; longer lists are cut into cells, not dropped.
    """
    rows = common.stored(fingerprints(docs, words))
    fps = common.stored(rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = common.components(links(fps, distance, limit))
    linked = fps.join(roots, fps.fp == roots.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    least = common.stored(linked.groupBy("root").agg(F.min("low").alias("component_id")))
    named = common.stored(linked.join(least, "root").select("fp", "component_id"))
    return (rows.join(named, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_first(docs: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """The documents that are the first (smallest doc_id) of their group; columns unchanged.

    Rows without a doc_id stay: nothing can be told about them by id.
    """
    found = simhash_dedup(docs, words, distance)
    drop = found.where("doc_id <> component_id").select(F.col("doc_id").alias("dropped_id")).distinct()
    return docs.join(drop, docs.doc_id == drop.dropped_id, "left_anti")
