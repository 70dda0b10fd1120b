"""Embedding near-dedup: a pivot-permutation index.

Each label with many vectors has reference points (pivots) of its own: the mean
direction of a bounded hash sample is subtracted, and of the centred sample
points are chosen farthest-first, so neither a common mean nor crowds of near
copies use them up; their number grows with the square root of the label's
size, so that lists stay short. Each vector is described by the ordered numbers
of its nearest pivots; near vectors see nearly the same order. Inverted lists
hold the vectors by label and pivot; a candidate must share at least two of its
pivots, so a list stands for a pair of pivots (and the label and dimension),
which is the shared-pivot count built into the key. Candidates of a list are
verified by their cosine in double precision, and a pair that shares more lists
counts in one of them only: that of its two smallest shared pivots. A label of
few vectors is one list; so is one whose lists would compare more than half of
all its pairs: the index never does more than all pairs.

Equal vectors of a label are one class from the start (grouped on the map
side), so copies are never expanded into pairs. Lists are processed in cells
of bounded size; a cell returns sums of links and a spanning forest. The driver
gets nothing but counts.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, rows without a label and rows without an id link with nothing
(n_links 0, own component, kept); vectors of different dimensions never link;
vectors are scaled by their largest component first, so tiny and huge ones have
a cosine too; a repeated row is one more copy of its vector; an id is taken to
have one vector; other columns do not matter; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import common


#: Smallest and largest number of a label's pivots, sample rows for each, and classes that one task describes.
LEAST_PIVOTS, MOST_PIVOTS, SAMPLE, PART = 64, 8192, 3, 200_000


def matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def directions(x: np.ndarray) -> np.ndarray:
    """Rows of length one; the largest component is divided out first, so no square over- or underflows."""
    top = np.abs(x).max(axis=1, keepdims=True)
    x = x / np.where(top == 0, 1, top)
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(length == 0, 1, length)


def farthest_first(x: np.ndarray, most: int, apart: float = 0.8) -> np.ndarray:
    """Rows, each the farthest (by cosine) from those before it, until all are within ``apart`` of one:
    pivots that crowd in one group of near copies would order its members at random."""
    taken = [0]
    near = x @ x[0]
    while len(taken) < min(most, len(x)):
        far = int(near.argmin())
        if near[far] > apart:
            break
        taken.append(far)
        near = np.maximum(near, x @ x[far])
    return x[taken]


def pivots(classes: DataFrame, sizes: DataFrame) -> DataFrame:
    """(label, dim, no, vec): a label's mean direction (no -1) and pivots, from a hash sample of ``SAMPLE`` times as many rows."""
    pick = F.pmod(F.xxhash64(F.lit("pivot"), "rep", "label"), F.lit(1 << 62)) < (F.least(F.lit(1.0), SAMPLE * F.col("m") / F.col("n")) * (1 << 62)).cast("long")
    sample = (classes.join(sizes.where("m > 0"), ["label", "dim"]).where(pick).select("label", "dim", "m", "rep", "vec"))

    def fit(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by("rep")
        x = directions(matrix(group.column("vec").chunk(0)))
        mean = x.mean(axis=0)
        found = np.concatenate([mean[None], farthest_first(directions(x - mean), group.column("m")[0].as_py())])
        label, dim = group.column("label")[0].as_py(), group.column("dim")[0].as_py()
        return pa.table({"label": pa.array([label] * len(found), type=pa.string()), "dim": pa.array([dim] * len(found), type=pa.int32()),
                         "no": pa.array(np.arange(-1, len(found) - 1, dtype=np.int32)), "vec": pa.array(list(found), type=pa.list_(pa.float64()))})

    common.ship(classes.sparkSession)
    return common.parked(sample.groupBy("label", "dim").applyInArrow(fit, "label string, dim int, no int, vec array<double>"))


def described(classes: DataFrame, sizes: DataFrame, chosen: DataFrame, nearest: int) -> DataFrame:
    """Classes with ``near``: their nearest pivots in order (empty for labels without pivots).

    A task gets a label's pivots first and then streams a part of its classes;
    only the pivots of a label with many classes go to several tasks."""
    parts = sizes.select("label", "dim", F.ceil(F.col("n") / PART).cast("int").alias("parts"))
    deal = F.pmod(F.xxhash64(F.lit("part"), "rep"), F.col("parts")).cast("int")
    first = (chosen.join(parts, ["label", "dim"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("label", "dim", "part", F.lit(0).alias("kind"), "no", F.lit(0).cast("long").alias("rep"), F.lit(0).cast("long").alias("size"), "vec"))
    then = (classes.join(parts, ["label", "dim"]).withColumn("part", deal)
            .select("label", "dim", "part", F.lit(1).alias("kind"), F.lit(0).alias("no"), "rep", "size", "vec"))
    rows = first.unionByName(then).repartition("label", "dim", "part").sortWithinPartitions("label", "dim", "part", "kind", "no")

    def run(batches: Iterator[pa.RecordBatch]):
        now, points, held = None, None, []
        for b in batches:
            keys = list(zip(*(b.column(c).to_pylist() for c in ("label", "dim", "part", "kind"))))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for s, e in zip(cuts, cuts[1:]):
                if s == e:
                    continue
                part = b.slice(s, e - s)
                if keys[s][:3] != now:
                    now, points, held = keys[s][:3], None, []
                if keys[s][3] == 0:
                    held.append(matrix(part.column("vec")))
                    continue
                if held:
                    points, held = np.concatenate(held), []
                if points is None:
                    near = [[]] * part.num_rows
                else:
                    x = directions(directions(matrix(part.column("vec"))) - points[0])
                    near = list(np.argsort(-(x @ points[1:].T), axis=1, kind="stable")[:, :nearest].astype(np.int32))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("rep", "label", "dim", "size", "vec")), pa.array(near, type=pa.list_(pa.int32()))],
                                                 names=["rep", "label", "dim", "size", "vec", "near"])

    return common.parked(common.arrow_pass(rows, run, "rep long, label string, dim int, size long, vec array<double>, near array<int>", 4096))


def cell_links(rep: np.ndarray, size: np.ndarray, block: np.ndarray, vec: np.ndarray, near: np.ndarray, pair: tuple[int, int],
               across: bool, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of each class of one cell (rows of the other classes), and its root in the cell's forest."""
    x = directions(vec)
    met = x @ x.T >= least
    np.fill_diagonal(met, False)
    if across:
        met &= block[:, None] != block[None, :]
    if met.any():
        low, high = pair
        smaller = [p for p in np.unique(near) if p < high and p != low]  # a shared one makes another list the owner
        held = (near[:, :, None] == np.array(smaller)[None, None, :]).any(axis=1).astype(np.float32) if smaller else np.zeros((len(rep), 1), np.float32)
        met &= held @ held.T == 0
    root, left = rep.copy(), np.arange(len(rep))
    while left.size:
        queue, first = [left[0]], rep[left[0]]
        left = left[1:]
        while queue and left.size:
            hit = met[queue.pop()][left]
            queue.extend(left[hit])
            root[left[hit]] = first
            left = left[~hit]
    return met @ size, root


def postings(classes: DataFrame, nearest: int, limit: int, share: float) -> DataFrame:
    """rep, label, dim, size, vec, near, p, q: a row for each list of each class (p = q = 0: the one list of its label)."""
    counted = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    grown = F.least(F.greatest(F.ceil(4 * F.sqrt("n")), F.lit(LEAST_PIVOTS)), F.lit(MOST_PIVOTS)).cast("int")
    sizes = common.stored(counted.withColumn("m", F.when(F.col("n") > limit, grown).otherwise(0)))
    known = described(classes, sizes, pivots(classes, sizes), nearest)
    near = lambda i: F.get("near", F.lit(i))
    whole = F.array(F.struct(F.lit(0).alias("p"), F.lit(0).alias("q")))
    both = [F.when(near(j).isNotNull(), F.struct(F.least(near(i), near(j)).alias("p"), F.greatest(near(i), near(j)).alias("q")))
            for i, j in combinations(range(nearest), 2)]
    keys = known.select("label", "dim", F.explode(F.array_compact(F.array(*both))).alias("pq"))
    lists = keys.groupBy("label", "dim", "pq").agg(F.count(F.lit(1)).alias("c"))
    cost = lists.groupBy("label", "dim").agg(F.sum(F.col("c").cast("double") * F.col("c")).alias("cost"))
    good = (sizes.join(cost, ["label", "dim"]).where(F.col("cost") <= share * F.col("n").cast("double") * F.col("n"))
            .select("label", "dim", F.lit(True).alias("indexed")))
    return (known.join(common.stored(good), ["label", "dim"], "left")
            .withColumn("pq", F.explode(F.when(F.col("indexed"), F.array_compact(F.array(*both))).otherwise(whole)))
            .select("rep", "label", "dim", "size", "vec", "near", "pq.p", "pq.q"))


def links(classes: DataFrame, nearest: int, least: float, limit: int, share: float = 0.5) -> DataFrame:
    """(rep, root, links): what each cell found; links sum up over the rows of a class."""
    listed = postings(classes, nearest, limit, share).withColumn("key", F.struct("label", "dim", "p", "q"))

    def run(batches: Iterator[pa.RecordBatch]):
        for (*_, p, q, lo, hi), (rep, size, block, vec, near) in common.sorted_groups(
                batches, ["label", "dim", "p", "q", "lo", "hi"], ["rep", "size", "block", "vec", "near"], step=4096):
            count, root = cell_links(rep, size, block, vec, near, (p, q), lo != hi, least)
            hit = np.flatnonzero(count)
            if hit.size:
                yield pa.RecordBatch.from_arrays([pa.array(rep[hit]), pa.array(root[hit]), pa.array(count[hit])], names=["rep", "root", "links"])

    dealt = common.cells(listed, "rep", limit)
    flat = dealt.select("label", "dim", "p", "q", "lo", "hi", "block", "rep", "size", "vec", "near")
    return flat.mapInArrow(run, "rep long, root long, links long")


def embedding_dedup(vectors: DataFrame, least: float = 0.93, nearest: int = 8, limit: int = 1024) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    ``vectors`` has vec_id, embedding and label. ``least``: smallest cosine of
    a link. ``nearest``: length of a vector's permutation prefix; more raise
    recall. ``limit``: largest cell of a list, and largest label without
    pivots; longer lists are cut into cells, not dropped.
    """
    own = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vec"), F.col("label").cast("string"))
    fine = F.coalesce((F.size("vec") > 0) & ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
                      & F.exists("vec", lambda x: x != 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False))
    # equal vectors are told by 128 bits from here on: vectors themselves are exchanged once
    rows = own.withColumns({"fine": fine, "h1": F.xxhash64("vec"), "h2": F.xxhash64(F.lit("second"), "vec")})
    key = ["label", "h1", "h2"]
    classes = common.parked(rows.where("fine").groupBy(*key).agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("size"), F.first("vec").alias("vec"))
                            .withColumn("dim", F.size("vec")))
    found = common.stored(links(classes.select("rep", "label", "dim", "size", "vec"), nearest, least, limit))
    direct = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = common.components(found.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "rep")
    named = common.stored(classes.select(*key, "rep", "size").join(direct, "rep", "left").join(roots, "rep", "left")
                          .select(*key, (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "rep").alias("component_id")))
    linked = rows.where("fine").select("vec_id", *key).join(named, key).select("vec_id", "n_links", "component_id")
    alone = rows.where("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
