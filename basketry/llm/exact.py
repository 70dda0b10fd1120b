"""Exact dedup by composable polynomial fingerprints.

A text's bytes, white space deleted, are hashed as a polynomial modulo two
primes. The hash of a concatenation is ``h(a) * B^len(b) + h(b)``, so chunks
are hashed on their own (one vectorised dot product each) and combined by
length-shifted arithmetic; a huge text never needs one pass over one buffer.
Texts with equal (fingerprint, length) are then compared chunk by chunk: the
chunks of all members stream through a grouped minimum and maximum, which
combine on the map side, so one group may hold any share of the rows. Groups
in which some chunk differs are split by the SHA-256 of the text.

Defined results: a null text counts as empty; texts of white space only are
equal to it; of rows that repeat a doc_id and a text one stays (the first as
stored); a null doc_id comes after all others; other columns do not matter;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import common

SPACE = b"\x20\t\n\x0b\x0c\r"
#: Two primes below 2^31: the product of two residues fits in 64 bits.
PRIMES = (2147483647, 2147483629)
BASES = (1000003, 912383)
#: Bytes of one chunk. A chunk's dot product stays below 2^31 * 2^8 * 2^16 = 2^55.
CHUNK = 1 << 16


def _powers(base: int, prime: int) -> np.ndarray:
    out, x = np.empty(CHUNK, dtype=np.uint64), 1
    for i in range(CHUNK - 1, -1, -1):
        out[i], x = x, x * base % prime
    return out


_POWERS: dict[int, np.ndarray] = {}


def chunk_hash(data: bytes) -> tuple[int, int, int]:
    """(h1, h2, length) of up to CHUNK bytes; bytes count from 1, so that zeros matter."""
    if not _POWERS:
        _POWERS.update({p: _powers(b, p) for b, p in zip(BASES, PRIMES, strict=True)})
    x = np.frombuffer(data, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    h = [int((x * _POWERS[p][CHUNK - x.size:]).sum() % np.uint64(p)) for p in PRIMES]
    return h[0], h[1], x.size


def combine(a: tuple[int, int, int], b: tuple[int, int, int]) -> tuple[int, int, int]:
    """The fingerprint of a text from those of its two parts."""
    h = [(x * pow(base, b[2], p) + y) % p for x, y, base, p in zip(a[:2], b[:2], BASES, PRIMES, strict=True)]
    return h[0], h[1], a[2] + b[2]


def polynomial(data: bytes) -> tuple[int, int, int]:
    out = (0, 0, 0)
    for i in range(0, len(data), CHUNK):
        part = chunk_hash(data[i:i + CHUNK])
        out = combine(out, part) if i else part
    return out


def normalised(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(None, SPACE)


def fingerprints(docs: DataFrame, bits: int = 62) -> DataFrame:
    """(doc_id, fp, n_bytes, n_chars, text_sha256); ``bits`` under 62 is for tests of collisions."""
    types = {"doc_id": pa.int64(), "fp": pa.int64(), "n_bytes": pa.int64(), "n_chars": pa.int64(), "text_sha256": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            out: dict = {k: [] for k in types}
            out["doc_id"] = b.column("doc_id")
            for t in b.column("text").to_pylist():
                data = normalised(t)
                h1, h2, n = polynomial(data)
                out["fp"].append((h1 << 31 | h2) & ((1 << bits) - 1))
                out["n_bytes"].append(n)
                out["n_chars"].append(len(t or ""))
                out["text_sha256"].append(hashlib.sha256(data).hexdigest())
            yield common.batch_of(out, types)

    return common.arrow_pass(docs.select(F.col("doc_id").cast("long"), "text"), run,
                             "doc_id long, fp long, n_bytes long, n_chars long, text_sha256 string")


def unequal_groups(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(fp, n_bytes) of groups whose members' texts are not all the same, compared chunk by chunk.

    ``members``: doc_id, fp, n_bytes of the rows in groups of two or more.
    Rows are matched to their group again by the fingerprint of the text, so
    that repeated ids do no harm.
    """
    ids = members.select(F.col("doc_id").alias("member_id")).distinct()
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(ids, F.col("doc_id").eqNullSafe(F.col("member_id")), "left_semi")
    types = {"h": pa.int64(), "n_bytes": pa.int64(), "chunk_no": pa.int32(), "chunk": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for t in b.column("text").to_pylist():
                data = normalised(t)
                h1, h2, n = polynomial(data)
                at = range(0, len(data), CHUNK)
                yield common.batch_of({"h": [h1 << 31 | h2] * len(at), "n_bytes": [n] * len(at), "chunk_no": list(range(len(at))),
                                       "chunk": [data[i:i + CHUNK] for i in at]}, types)

    chunks = common.arrow_pass(texts.select("text"), run, "h long, n_bytes long, chunk_no int, chunk binary")
    return (chunks.groupBy("h", "n_bytes", "chunk_no").agg((F.min("chunk") != F.max("chunk")).alias("differs"))
            .where("differs").select("h", "n_bytes").distinct())


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the one with the most code points stays, then the smallest doc_id.
    """
    rows = common.stored(fingerprints(docs).withColumn("row_id", F.monotonically_increasing_id()))
    repeated = common.stored(rows.groupBy("fp", "n_bytes").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    members = rows.join(repeated, ["fp", "n_bytes"]).select("doc_id", "fp", "n_bytes")
    unequal = common.stored(unequal_groups(docs, members).select(F.col("h").alias("fp"), "n_bytes", F.lit(True).alias("split")))
    if not unequal.isEmpty():
        rows = rows.join(unequal, ["fp", "n_bytes"], "left").withColumn("split", F.when(F.col("split"), F.col("text_sha256")).otherwise(""))
    else:
        rows = rows.withColumn("split", F.lit(""))
    key = ["fp", "n_bytes", "split"]
    order = F.struct("n_chars", F.col("doc_id").isNotNull().alias("known"), F.bitwise_not("doc_id"), F.bitwise_not("row_id"))  # ~x: smaller first, for every long
    groups = common.stored(rows.groupBy(*key).agg(F.max(F.struct(order.alias("o"), "doc_id", "row_id")).alias("first"),
                                                  F.count(F.lit(1)).alias("group_size"))
                           .select(*key, F.col("first.doc_id").alias("keep_id"), F.col("first.row_id").alias("keep_row"), "group_size"))
    return (rows.join(groups, key)
            .select("doc_id", "keep_id", "group_size", (F.col("row_id") == F.col("keep_row")).alias("kept"), "text_sha256"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents that stay, columns unchanged.

    Dropped are ids of which no row stays; rows that repeat the id of a row
    that stays are reduced to one row per equal text.
    """
    found = common.stored(exact_dedup(docs))
    drop = (found.groupBy("doc_id").agg(F.max("kept").alias("stays")).where("not stays")
            .select(F.col("doc_id").alias("dropped_id")))
    out = docs.join(drop, F.col("doc_id").cast("long").eqNullSafe(F.col("dropped_id")), "left_anti")
    return out.dropDuplicates() if found.groupBy("doc_id").count().where("count > 1").limit(1).count() else out
