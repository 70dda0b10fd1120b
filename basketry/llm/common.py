"""Helpers shared by the operators: Arrow passes, cut lineage, bounded cells, components.

Every Python step here is an Arrow function over a stream of record batches,
so a task holds one batch (or one bounded cell) at a time, whatever the size
of its partition or of a key.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.session import checkpoint_root

#: Rows of one slice of an Arrow batch; texts of some 100 kB make it some 25 MB at most in practice.
BATCH_ROWS = 256
#: Broadcast a side only below so many rows of a few numbers each (some 4 MB).
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """The frame, computed once into the shared checkpoint folder; lineage is cut there."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def parked(df: DataFrame) -> DataFrame:
    """The frame, written once as Parquet into the shared checkpoint folder and read again: compressed, and cut from its lineage."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/parked-{uuid.uuid4()}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Give the workers this package, as ``--py-files`` would, once for each Spark context."""
    name = "basketry-workers.zip"
    if any(f.endswith(name) for f in spark.sparkContext.listFiles):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(), name)
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(top):
            for f in files:
                if f.endswith(".py"):
                    z.write(os.path.join(folder, f), os.path.relpath(os.path.join(folder, f), os.path.dirname(top)))
    spark.sparkContext.addPyFile(path)


def arrow_pass(df: DataFrame, fn: Callable, schema: str, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """mapInArrow over small slices: rows with long texts must not add up in a worker.

    Spark bounds the bytes of its own batches (spark.sql.execution.arrow.maxBytesPerBatch,
    64 MB); the session's settings stay as they are."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]):
        return fn(b.slice(s, batch_rows) for b in batches for s in range(0, max(1, b.num_rows), batch_rows))

    return df.mapInArrow(run, schema)


class Memory:
    """What a worker has met, bounded: entries in use survive in one of two generations of up to ``most`` each."""

    def __init__(self, most: int):
        self.most, self.now, self.before = most, {}, {}

    def missing(self, keys: set) -> set:
        """The keys not met so far; those met are in ``now`` afterwards."""
        if len(self.now) > self.most:
            self.before, self.now = self.now, {}
        new = keys.difference(self.now)
        if self.before:
            old = [k for k in new if k in self.before]
            self.now.update((k, self.before[k]) for k in old)
            new.difference_update(old)
        return new


def batch_of(columns: dict, types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[k], type=t) for k, t in types.items()], names=list(types))


def sorted_groups(batches: Iterator[pa.RecordBatch], key: list[str], value: list[str],
                  step: int = 65536) -> Iterator[tuple[tuple, list]]:
    """Groups of two or more rows from batches sorted by ``key``: (key values, value arrays).

    Groups of one row are passed over, batches are joined up to ``step`` rows,
    and only the last, unfinished group is carried on.
    """
    def table_of(parts):
        return pa.Table.from_batches(parts).combine_chunks()

    def col(t, name):
        c = t.column(name)
        c = c.chunk(0) if c.num_chunks else pa.array([], type=c.type)
        return c if pa.types.is_list(c.type) else c.to_numpy(zero_copy_only=False)

    def part(c, a, b):
        """Rows a to b; lists, which have one length within a group, as a matrix."""
        return c.slice(a, b - a).flatten().to_numpy(zero_copy_only=False).reshape(b - a, -1) if isinstance(c, pa.Array) else c[a:b]

    def split(t, last):
        keys = [col(t, k) for k in key]
        n = t.num_rows
        if not n:
            return [], t
        new = np.zeros(n, dtype=bool)
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        starts = np.concatenate([[0], np.flatnonzero(new), [n]])
        if not last:
            keep = int(starts[-2])
            rest, starts = t.slice(keep), starts[:-1]
        else:
            rest = t.slice(n)
        sizes = np.diff(starts)
        big = np.flatnonzero(sizes >= 2)
        vals = [col(t, v) for v in value] if len(big) else []
        return [(tuple(k[starts[i]] for k in keys), [part(v, starts[i], starts[i + 1]) for v in vals]) for i in big], rest

    parts: list = []
    rows = 0
    for b in batches:
        parts.append(b)
        rows += b.num_rows
        if rows >= step:
            groups, rest = split(table_of(parts), False)
            parts, rows = rest.to_batches() if rest.num_rows else [], 0
            yield from groups
    if parts:
        yield from split(table_of(parts), True)[0]


def cells(postings: DataFrame, item: str, limit: int) -> DataFrame:
    """Postings dealt into cells of bounded size, sorted for ``sorted_groups``.

    ``postings`` has ``key`` (one posting list each) and ``item``. A list of
    up to ``limit`` items is one cell. A longer list is cut by a hash of the
    item into blocks of about ``limit``; every pair of blocks is a cell of its
    own, so any two items of a list meet in exactly one cell (``lo`` < ``hi``:
    only pairs across the blocks count) and no task holds a hot list.
    Adds ``lo``, ``hi`` and ``block``. Only the sizes of hot lists are joined;
    they are broadcast when a count shows that they are few.
    """
    hot = stored(postings.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit))
    side = F.broadcast(hot) if hot.count() <= BROADCAST_ROWS else hot
    blocks = F.ceil(F.coalesce("n", F.lit(1)) / F.lit(limit)).cast("int")
    dealt = (postings.join(side, "key", "left")
             .withColumn("blocks", blocks)
             .withColumn("block", F.when(F.col("blocks") == 1, 0)
                         .otherwise(F.pmod(F.xxhash64(F.lit("block"), item), F.col("blocks")).cast("int"))))
    cold = dealt.where("blocks = 1").withColumns({"lo": F.lit(0), "hi": F.lit(0)})
    if hot.isEmpty():
        out = cold
    else:
        split = dealt.where("blocks > 1").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        out = cold.unionByName(split.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
                               .drop("other"))
    return out.drop("n", "blocks").repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; root is the smallest node reachable.

    ``edges`` has longs ``a`` and ``b``. Large-star and small-star steps
    (Kiveris et al., 2014) until nothing changes; each keeps the components and
    leaves at most as many edges. Grouped minima combine on the map side, are
    stored, and are then joined back, so that a star with many leaves is split
    by the skew join. Every round is stored in the checkpoint folder.
    """
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    seen = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if tuple(now) == seen or not now[0]:
            return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
                e.select(F.col("lo").alias("node"), F.col("lo").alias("root"))).distinct()
        seen = tuple(now)
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        low = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        e = stored(both.where("v > u").join(low, "u").where("v <> m")
                   .select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())
        low = stored(e.groupBy("hi").agg(F.min("lo").alias("m")))
        small = e.join(low, "hi")
        e = stored(small.select("hi", F.col("m").alias("lo")).unionByName(
            small.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))).distinct())
