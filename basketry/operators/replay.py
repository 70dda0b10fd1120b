"""State machines over command logs by composition of state maps.

A command is a map from every state to the state after it (the target where the
edge is allowed, else the state itself). Maps compose associatively, so a log is
replayed in two levels: rows are cut into (key, time bucket) chunks, the one
big exchange; in a chunk the maps of the rows before each row are composed by
doubling; one map per chunk is composed along the key, a table of one row per
(key, bucket), and tells each chunk the state it starts in. Any edge table will
do, also one with cycles; a hot key spreads over as many tasks as it has buckets.

A map is one long: four bits per state, up to 15 states.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.operators.scan import HOUR_US, join_back, materialize, time_bucket

BITS = 4


def packed(mapping: Sequence[int]) -> int:
    return sum(t << BITS * s for s, t in enumerate(mapping))


def _map_of(target: Column, states: Sequence[str], edges: Sequence[tuple[str, str]]) -> Column:
    """The packed map of a command; commands without an edge leave every state as it is."""
    number = {s: i for i, s in enumerate(states)}
    out = F.lit(packed(range(len(states)))).cast("long")
    for t in sorted({b for _, b in edges}):
        m = [number[t] if (s, t) in set(edges) else i for s, i in number.items()]
        out = F.when(target == t, F.lit(packed(m)).cast("long")).otherwise(out)
    return out


def _scan(states: int, keys: int, after: bool):
    """A pass over rows sorted by their first ``keys`` columns: the packed composition of the maps (last column) of the
    key's rows before each row, and, with ``after``, those up to it. Shipped by value: workers need no package."""
    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        shifts = np.arange(states, dtype=np.int64) * BITS
        same = np.arange(states)
        carried, carry = None, same
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            maps = (b.column(b.num_columns - 1).to_numpy()[:, None] >> shifts) & (1 << BITS) - 1
            new = np.zeros(n, dtype=bool)
            for i in range(keys):
                code = b.column(i).dictionary_encode(null_encoding="encode").indices.to_numpy()
                new[1:] |= code[1:] != code[:-1]
            first = tuple(b.column(i)[0].as_py() for i in range(keys))
            new[0] = first != carried
            if new[0]:
                carry = same
            segment = np.cumsum(new)
            upto, step = maps.copy(), 1
            longest = int(np.bincount(segment).max())
            while step < longest:  # upto[i] covers the step rows up to i, or all of its segment so far
                hit = np.flatnonzero(segment[step:] == segment[:-step]) + step
                upto[hit] = np.take_along_axis(upto[hit], upto[hit - step], axis=1)
                step *= 2
            running = segment == segment[0]
            upto[running] = upto[running][:, carry]
            before = np.empty_like(upto)
            before[1:] = upto[:-1]
            before[new] = same
            if not new[0]:
                before[0] = carry
            carried, carry = tuple(b.column(i)[n - 1].as_py() for i in range(keys)), upto[-1]
            columns = [*b.columns[:-1], pa.array((before << shifts).sum(axis=1))]
            names = [*b.schema.names[:-1], "_before"]
            if after:
                columns.append(pa.array((upto << shifts).sum(axis=1)))
                names.append("_after")
            yield pa.RecordBatch.from_arrays(columns, names=names)
    return run


def _state(mapping: str, state: Column | str) -> Column:
    """The state after a packed map from a state number."""
    start = state if isinstance(state, Column) else F.col(state)
    return F.call_function("shiftright", F.col(mapping), (start * BITS).cast("int")).bitwiseAND(F.lit((1 << BITS) - 1))


def replay(log: DataFrame, key: str, target: str, states: Sequence[str], edges: Sequence[tuple[str, str]],
           ts: str = "event_time", tiebreak: str = "event_id", bucket_us: int = HOUR_US) -> DataFrame:
    """The log with from_state, accepted, to_state and the key's final_state.

    Every key starts in the first of ``states``. Rows are ordered by (ts,
    tiebreak), nulls first; a null key is a key of its own; a null or unknown
    target is refused."""
    if len(states) > 15:
        raise ValueError("at most 15 states")
    columns = log.columns
    rows = log.withColumn("_b", time_bucket(ts, bucket_us)).withColumn("_map", _map_of(F.col(target), states, edges))
    kind = {f.name: f for f in rows.schema}
    lead = [key, "_b"]
    ordered = rows.select(*lead, *[c for c in columns if c != key], "_map").repartition(*lead).sortWithinPartitions(*lead, ts, tiebreak)
    out = T.StructType([T.StructField(f.name, f.dataType) for f in ordered.schema.fields[:-1]]
                       + [T.StructField(n, T.LongType()) for n in ("_before", "_after")])
    run = materialize(ordered.withColumn("_at", F.monotonically_increasing_id()).select(*lead, "_at", *[c for c in columns if c != key], "_map")
                      .mapInArrow(_scan(len(states), 2, True), T.StructType([*out.fields[:2], T.StructField("_at", T.LongType()), *out.fields[2:]])))
    chunks = run.groupBy(*lead).agg(F.max_by("_after", "_at").alias("_map"))
    along = chunks.select(*lead, "_map").repartition(key).sortWithinPartitions(*lead)
    summary = T.StructType([T.StructField(key, kind[key].dataType), T.StructField("_b", T.LongType()),
                            T.StructField("_starts", T.LongType()), T.StructField("_ends", T.LongType())])
    starts = materialize(along.mapInArrow(_scan(len(states), 1, True), summary))
    ends = starts.groupBy(key).agg(F.max_by("_ends", "_b").alias("_last"))
    d = join_back(join_back(run, starts.drop("_ends"), lead), ends, [key])
    names = F.array(*[F.lit(s) for s in states])
    zero = F.lit(0).cast("long")
    d = d.withColumn("_from", _state("_before", _state("_starts", zero))).withColumn("_to", _state("_after", _state("_starts", zero)))
    of = lambda c: F.get(names, c.cast("int"))
    d = d.withColumns({"from_state": of(F.col("_from")), "to_state": of(F.col("_to")), "final_state": of(_state("_last", zero))})
    moved = F.lit(False)
    for a, b in edges:
        moved = moved | ((F.col("from_state") == a) & (F.col(target) == b))
    return d.withColumn("accepted", F.coalesce(moved, F.lit(False))).select(*columns, "from_state", "accepted", "to_state", "final_state")
