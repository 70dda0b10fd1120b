"""Exact top-k search: tiled matrix products, partial selection per tile, tree merging.

The queries (rows whose id is divisible by ``every``) are dealt into slabs that
fit a worker, all rows into shards; each slab meets each shard in one cell.
A cell first holds its slab, then streams its shard: a tile is the product of
some queries and some rows, from which only the best k per query are selected
(one partition of unique keys: score, then smaller id) and merged with what the
cell has. Lists of a query are merged as a tree, a fixed number of lists at a
time, so no task ever holds more than that many lists of a query.

The integers are exact: a product runs in float32 or float64 while the sums
provably fit its mantissa, and in Python's integers beyond. Scores beyond 64
bits are reported, and ranked, as the nearest long.

Defined results: vectors that are null or hold null or non-finite components
and rows without an id take no part, neither as query nor as candidate; vectors
of different lengths do not meet; a repeated row is a row of its own (it is a
candidate for its twin, and a query of its own); equal scores go to the smaller
id, then to any of the rows of that id; other columns do not matter; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm import common

#: Bytes of a slab as 8-byte numbers, queries and rows of a tile.
SLAB_BYTES, TILE_QUERIES, TILE_ROWS = 1 << 25, 1024, 4096
#: Rows of a shard: this many at least, at most, and at most so many shards until that.
SHARD_ROWS, MOST_SHARD_ROWS, SHARDS = 8192, 1 << 20, 64
#: Lists that are merged into one.
FAN = 16
TOP = (1 << 63) - 1


def integers(vectors: pa.ListArray, scale: float) -> np.ndarray:
    """floor(scale * x) of vectors of one length, as doubles (whole numbers)."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(flat * scale), -1e300, 1e300).reshape(len(vectors), -1)


def largest(x: np.ndarray) -> float:
    return float(np.abs(x).max(initial=0))


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products as int64, exact up to the ends of a long."""
    bound = q.shape[1] * max(1.0, largest(q)) * max(1.0, largest(c))
    if bound < 1 << 24:
        return (q.astype(np.float32) @ c.T.astype(np.float32)).astype(np.int64)
    if bound < 1 << 53:
        return (q @ c.T).astype(np.int64)
    whole = [[int(v) for v in r] for r in c]
    out = np.empty((len(q), len(c)), dtype=np.int64)
    for i, r in enumerate(q):
        mine = [int(v) for v in r]
        out[i] = [max(-TOP, min(TOP, sum(a * b for a, b in zip(mine, other)))) for other in whole]
    return out


def select(score: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k best of each row, by score, then by ``order`` (ascending and unique in a row); in no order."""
    n = score.shape[1]
    if n <= k:
        return np.broadcast_to(np.arange(n), score.shape)
    if largest(score) * n < 1 << 61:
        return np.argpartition(score * n + (n - 1 - order), n - k, axis=1)[:, n - k:]
    rows = np.broadcast_to(np.arange(len(score))[:, None], score.shape)
    by = np.lexsort((np.broadcast_to(order, score.shape).ravel(), -score.ravel(), rows.ravel())).reshape(score.shape)
    return (by % n)[:, :k]


class Slab:
    """Queries of a cell and the best rows that each has met."""

    def __init__(self, row: np.ndarray, vec_id: np.ndarray, x: np.ndarray, k: int):
        by = np.argsort(row)
        self.row, self.vec_id, self.x, self.k = row[by], vec_id[by], x[by], k
        self.score = np.full((len(row), k), -TOP - 1)  # the sign of an empty place
        self.met_id = np.full((len(row), k), TOP)
        self.met_row = np.full((len(row), k), TOP)

    def tile(self, row: np.ndarray, vec_id: np.ndarray, x: np.ndarray) -> None:
        by = np.lexsort((row, vec_id))
        row, vec_id, x = row[by], vec_id[by], x[by]
        own = np.searchsorted(self.row, row)
        own[own == len(self.row)] = 0
        own = np.where(self.row[own] == row, own, -1)
        for s in range(0, len(self.row), TILE_QUERIES):
            e = min(s + TILE_QUERIES, len(self.row))
            score = products(self.x[s:e], x)
            mine = np.flatnonzero((own >= s) & (own < e))
            at = select(score, np.arange(len(row)), self.k + 1)  # one more: the query's own row may be among them
            best, ids, rows = np.take_along_axis(score, at, 1), vec_id[at], row[at]
            if len(mine):
                same = rows == self.row[s:e, None]
                best, ids, rows = np.where(same, -TOP - 1, best), np.where(same, TOP, ids), np.where(same, TOP, rows)
            best, ids, rows = (np.concatenate([old[s:e], new], axis=1) for old, new in ((self.score, best), (self.met_id, ids), (self.met_row, rows)))
            line = np.broadcast_to(np.arange(e - s)[:, None], best.shape).ravel()
            order = np.lexsort((rows.ravel(), ids.ravel(), -np.maximum(best, -TOP).ravel(), (best == -TOP - 1).ravel(), line)).reshape(best.shape) % best.shape[1]
            order = order[:, :self.k]
            self.score[s:e], self.met_id[s:e], self.met_row[s:e] = (np.take_along_axis(v, order, 1) for v in (best, ids, rows))

    def lists(self, shard: int) -> pa.RecordBatch:
        """One row for each place that is taken."""
        q, place = np.nonzero(self.score != -TOP - 1)
        return pa.RecordBatch.from_arrays(
            [pa.array(v) for v in (self.row[q], self.vec_id[q], np.full(len(q), shard), -self.score[q, place], self.met_id[q, place], self.met_row[q, place])],
            names=["query", "query_id", "shard", "minus", "vec_id", "row"])


def cell_lists(batches: Iterator[pa.RecordBatch], scale: float, k: int) -> Iterator[pa.RecordBatch]:
    """Lists of the cells of a task: of each, first its queries come, then its rows."""
    cell, held, slab, waiting = None, [], None, []

    def numbers(part: pa.RecordBatch):
        return part.column("row").to_numpy(), part.column("vec_id").to_numpy(), integers(part.column("vec"), scale)

    def joined(parts: list):
        return [np.concatenate(v) for v in zip(*parts)]

    def flush():
        if slab is not None and waiting:
            slab.tile(*joined(waiting))
            waiting.clear()

    for batch in batches:
        key = np.stack([batch.column(c).to_numpy() for c in ("dim", "slab", "shard", "asks")], axis=1)
        starts = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, [len(key)]])
        for a, e in zip(starts[:-1], starts[1:]):
            if e == a:
                continue
            here, asks = tuple(int(v) for v in key[a][:3]), key[a][3]
            if here != cell:
                flush()
                if slab is not None:
                    yield slab.lists(cell[2])
                cell, held, slab = here, [], None
                waiting.clear()
            if asks == 0:
                held.append(numbers(batch.slice(a, e - a)))
                continue
            if slab is None and held:
                slab, held = Slab(*joined(held), k), []
            if slab is not None:
                waiting.append(numbers(batch.slice(a, e - a)))
                if sum(len(w[0]) for w in waiting) >= TILE_ROWS:
                    flush()
    flush()
    if slab is not None:
        yield slab.lists(cell[2])


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, scale: float = 256.0) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` rows of the greatest inner product for each query.

    ``vectors`` has vec_id and embedding; components count as floor(scale * x).
    Nothing reaches the driver but three counts.
    """
    kind = vectors.schema["embedding"].dataType.simpleString()
    own = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast(kind if kind == "array<float>" else "array<double>").alias("vec"))
    fine = F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & ~F.exists(
        "vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    rows = common.parked(own.where(fine).withColumns({"row": F.monotonically_increasing_id(), "dim": F.size("vec")}))
    asks = F.col("vec_id") % every == 0
    n, asked, dim = rows.agg(F.count(F.lit(1)), F.count(F.when(asks, 1)), F.coalesce(F.max("dim"), F.lit(0))).first()
    slabs = max(1, -(-asked // max(256, SLAB_BYTES // (8 * max(1, dim)))))
    shard_rows = min(MOST_SHARD_ROWS, max(SHARD_ROWS, n // SHARDS))
    shards = max(1, -(-n // shard_rows))

    def number(name: str, most: int):
        return F.pmod(F.xxhash64(F.lit(name), "row"), F.lit(most)).cast("long")

    def all_of(most: int):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(most - 1).cast("long")))

    columns = ["dim", "slab", "shard", "asks", "row", "vec_id", "vec"]
    queries = rows.where(asks).withColumns({"slab": number("slab", slabs), "asks": F.lit(0)}).withColumn("shard", all_of(shards))
    shelf = rows.withColumns({"shard": number("shard", shards), "asks": F.lit(1)}).withColumn("slab", all_of(slabs))
    cells = (queries.select(columns).unionByName(shelf.select(columns)).withColumn("dim", F.col("dim").cast("long"))
             .withColumn("asks", F.col("asks").cast("long"))
             .repartition(slabs * shards, "dim", "slab", "shard").sortWithinPartitions("dim", "slab", "shard", "asks"))

    def run(batches: Iterator[pa.RecordBatch]):
        return cell_lists(batches, scale, k)

    common.ship(vectors.sparkSession)
    best = cells.mapInArrow(run, "query long, query_id long, shard long, minus long, vec_id long, row long")
    lists = shards
    while lists > 1:
        lists = -(-lists // FAN)
        best = (best.withColumn("shard", F.floor(F.col("shard") / FAN).cast("long"))
                .withColumn("place", F.row_number().over(Window.partitionBy("query", "shard").orderBy("minus", "vec_id", "row")))
                .where(F.col("place") <= k).drop("place"))
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy("minus", "vec_id", "row")))
    return ranked.select("query_id", "rank", "vec_id", (-F.col("minus")).alias("score"))
