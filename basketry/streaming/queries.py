"""Structured Streaming readers of the checkout topics (ST1-ST9).

Every stream reads ``(topic, key, value)`` JSON rows from a file source (the
Kafka source where that connector exists), runs with ``availableNow`` into a
sink under the shared checkpoint folder, and the registered query returns a
batch read of that sink. Time columns are instants (session time zone UTC);
watermarks bound all state.
"""

from __future__ import annotations

import json
import sys
import uuid
from contextlib import contextmanager
from decimal import Decimal

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.state import GroupStateTimeout

from basketry.schemas import SESSION_EDGES
from basketry.session import checkpoint_root
from basketry.operators.scan import materialize
from basketry.sources.topics import decode_topics, decoded_time

FEED_SCHEMA = "event_id long, topic string, key string, value string"
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
#: Rows of one landed file; at least two files land for each slice of time, and a slice is a micro-batch.
ROWS_PER_FILE = 500_000
#: State stores of a stream that has fewer cores (executors may still be starting).
MIN_STORES = 8

# The state functions below run on executors; ship them by value so the
# workers need no copy of this package on their import path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def stream_home(spark: SparkSession, name: str) -> str:
    """A fresh folder for one stream run inside the shared checkpoint root."""
    return f"{checkpoint_root(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex}"


def land(df: DataFrame, path: str, order: str = "event_time", files: int = 3) -> int:
    """Write rows as the JSON files a file-stream source will pick up (input
    landing for tests; production reads the topics directly): ``files`` slices
    of time, one write after the other, so that the source meets them in order
    and a run has several micro-batches. Returns the files of a slice, which
    follow its size: the source takes so many at a time."""
    d = materialize(df.withColumn("_at", F.unix_micros(F.col(order).cast("timestamp"))))
    each = max(1 if files == 1 else 2, -(-d.count() // (files * ROWS_PER_FILE)))
    cuts = d.approxQuantile("_at", [k / files for k in range(1, files)], 0.01) if files > 1 else []
    edges = [None, *cuts, None]
    for low, high in zip(edges, edges[1:]):
        part = d.where(F.lit(True) if low is None else F.col("_at") >= low)
        part = part if high is None else part.where(F.col("_at") < high)
        if low is None and high is not None:   # rows without a time come first
            part = part.unionByName(d.where(F.col("_at").isNull()))
        part.drop("_at").repartition(each).write.mode("append").options(
            timestampFormat=MICROS, timestampNTZFormat=MICROS).json(path)
    return each


def exists(spark: SparkSession, path: str) -> bool:
    """If a file or folder is there; any failure to look raises."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


@contextmanager
def state_stores(spark: SparkSession):
    """Streams that start within get at most one state store for each core. A store commits its files in every batch,
    rows or not, so more stores than cores cost time and no store shares the work. A stream copies the settings as it
    starts and keeps the number in its checkpoint; the session has its own again afterwards."""
    name = "spark.sql.shuffle.partitions"
    asked = spark.conf.get(name)
    spark.conf.set(name, str(min(int(asked), max(MIN_STORES, spark.sparkContext.defaultParallelism))))
    try:
        yield
    finally:
        spark.conf.set(name, asked)


def run_available(sdf: DataFrame, home: str, mode: str = "append", foreach=None) -> str:
    """Run a streaming frame to the end of its input; returns the sink path."""
    out = f"{home}/out"
    w = sdf.writeStream.outputMode(mode).option("checkpointLocation", f"{home}/ckpt").trigger(availableNow=True)
    if foreach is not None:
        q = w.foreachBatch(foreach(out)).start()   # its batches shuffle as the session says
    else:
        with state_stores(sdf.sparkSession):
            q = w.format("parquet").option("path", out).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return out


def _append_batches(out: str):
    def fn(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(out)
    return fn


def read_feed(spark: SparkSession, path: str, files: int) -> DataFrame:
    """The decoded topic stream, event time as an instant for watermarks.
    Malformed rows are not lost: ``stream_quarantine`` keeps them."""
    raw = spark.readStream.schema(FEED_SCHEMA).option("maxFilesPerTrigger", files).json(path)
    d = decode_topics(raw).where(~F.col("malformed"))
    return d.withColumn("event_time", F.col("event_time").cast("timestamp"))


def land_feed(feed: DataFrame, path: str) -> int:
    """Topic rows in order of the time in their value."""
    timed = feed.select("event_id", "topic", "key", "value", decoded_time("value").alias("_time"))
    return land(timed, path, order="_time")


def _ntz(c: str):
    return F.col(c).cast("timestamp_ntz")


def _read_out(spark: SparkSession, out: str, schema: str) -> DataFrame:
    """What a stream wrote; a run without any output leaves no folder."""
    if not exists(spark, out):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(out)


def stream_quarantine(spark: SparkSession, feed: DataFrame) -> DataFrame:
    """The malformed rows of the topics, as they came, for repair and replay."""
    home = stream_home(spark, "quarantine")
    land(feed.withColumn("_time", F.lit(None).cast("timestamp")), f"{home}/in", order="_time", files=1)
    raw = spark.readStream.schema(FEED_SCHEMA).json(f"{home}/in")
    bad = decode_topics(raw).where("malformed").select("topic", "key", "value")
    return _read_out(spark, run_available(bad, home), "topic string, key string, value string")


# --- stateless / built-in stateful ------------------------------------------------------

def stream_scan_enrich(spark: SparkSession, feed: DataFrame, catalog: DataFrame) -> DataFrame:
    """ST5: added items joined to the (static) catalog; missing products flagged."""
    home = stream_home(spark, "scan_enrich")
    files = land_feed(feed, f"{home}/in")
    s = read_feed(spark, f"{home}/in", files).where(F.col("topic") == "cart.item.added")
    j = s.join(catalog.select("barcode", F.col("name").alias("catalog_name")), "barcode", "left")
    out = j.select("session_id", "barcode", _ntz("event_time").alias("event_time"), "catalog_name",
                   F.col("catalog_name").isNotNull().alias("found"))
    return spark.read.parquet(run_available(out, home))


def stream_help_by_aisle(spark: SparkSession, feed: DataFrame, slide: str | None = None) -> DataFrame:
    """ST6: help requests per aisle per 15-minute window (optionally sliding),
    30-minute watermark, append mode: a window is final once the watermark
    passes its end; later rows are dropped."""
    home = stream_home(spark, "help_by_aisle")
    files = land_feed(feed, f"{home}/in")
    s = read_feed(spark, f"{home}/in", files).where(F.col("topic") == "help.requested")
    w = F.window("event_time", "15 minutes", slide) if slide else F.window("event_time", "15 minutes")
    agg = (s.withWatermark("event_time", "30 minutes").groupBy(w.alias("w"), "aisle_number")
            .agg(F.count(F.lit(1)).alias("requests")))
    out = agg.select("aisle_number", F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                     F.col("w.end").cast("timestamp_ntz").alias("window_end"), "requests")
    return _read_out(spark, run_available(out, home),
                     "aisle_number int, window_start timestamp_ntz, window_end timestamp_ntz, requests long")


def stream_paid_completed(spark: SparkSession, feed: DataFrame) -> DataFrame:
    """ST7: each session.paid paired with its session.completed within 5
    minutes (stream-stream left outer join, both sides watermarked); a payment
    with no completion is emitted unpaired once the watermark passes."""
    home = stream_home(spark, "paid_completed")
    files = land_feed(feed, f"{home}/in")
    s = read_feed(spark, f"{home}/in", files)
    paid = (s.where(F.col("topic") == "session.paid")
             .select(F.col("key").alias("paid_key"), F.col("event_time").alias("paid_at"))
             .withWatermark("paid_at", "10 minutes"))
    done = (s.where(F.col("topic") == "session.completed")
             .select(F.col("key").alias("done_key"), F.col("event_time").alias("completed_at"))
             .withWatermark("completed_at", "10 minutes"))
    cond = ((F.col("paid_key") == F.col("done_key")) & (F.col("completed_at") >= F.col("paid_at"))
            & (F.col("completed_at") <= F.col("paid_at") + F.expr("INTERVAL 5 MINUTES")))
    j = paid.join(done, cond, "leftOuter")
    out = j.select(F.col("paid_key").alias("session_id"), _ntz("paid_at").alias("paid_at"),
                   _ntz("completed_at").alias("completed_at"))
    return _read_out(spark, run_available(out, home),
                     "session_id string, paid_at timestamp_ntz, completed_at timestamp_ntz")


def stream_event_dedup(spark: SparkSession, feed: DataFrame) -> DataFrame:
    """ST8: repeated deliveries dropped by (topic, key, event_time, barcode)
    within a 1-hour watermark (state is bounded by the watermark)."""
    home = stream_home(spark, "event_dedup")
    files = land_feed(feed, f"{home}/in")
    s = read_feed(spark, f"{home}/in", files)
    d = (s.withWatermark("event_time", "1 hour")
          .dropDuplicatesWithinWatermark(["topic", "key", "event_time", "barcode"]))
    out = d.select("topic", "key", "session_id", "barcode", "price", "quantity", "aisle_number", "user_id",
                   _ntz("event_time").alias("event_time"))
    return spark.read.parquet(run_available(out, home))


STATE_OUT = "session_id long, barcode string, event_time timestamp_ntz, event_id long, quantity long, price decimal(19,4)"
STATE_IN = "event_id long, event_time timestamp, session_id long, barcode string, kind string, quantity long, price decimal(19,4)"


def stream_upsert_sink(spark: SparkSession, states: DataFrame, parts: int = 16) -> DataFrame:
    """ST9: the newest state of each (session, barcode) kept as a keyed snapshot.

    ``states``: what each cart change leaves (event_id, event_time, session_id,
    barcode, kind, quantity, price); a CLEAR ends the lines of its session. The
    snapshot is dealt into ``parts`` by session; a manifest names the newest
    file version of each part, and a batch reads and writes only the parts that
    its sessions fall into. Newest is by (event_time, event_id), so order
    across batches does not matter. A replayed batch changes nothing; a part
    that cannot be read raises, so no earlier row is ever lost. Lines at 0 are
    not returned."""
    home = stream_home(spark, "upsert_sink")
    files = land(states, f"{home}/in")
    rows = spark.readStream.schema(STATE_IN).option("maxFilesPerTrigger", files).json(f"{home}/in")
    out = run_available(rows.withColumn("event_time", _ntz("event_time")), home, foreach=lambda o: _snapshot_sink(o, parts))
    return read_snapshot(spark, out).where("barcode is not null and quantity > 0").drop("event_id")


def _manifest(sp: SparkSession, out: str) -> tuple[int, dict[int, int]]:
    """The last batch and the newest version of each part (at most as many rows as there are parts)."""
    if not exists(sp, f"{out}/_latest"):
        return -1, {}
    last = int(sp.read.text(f"{out}/_latest").first()[0])
    return last, {r.part: r.version for r in sp.read.schema("part int, version long").json(f"{out}/manifest/v={last}").collect()}


def _part_paths(out: str, versions: dict[int, int]) -> list[str]:
    return [f"{out}/data/v={v}/part={p}" for p, v in sorted(versions.items())]


def read_snapshot(sp: SparkSession, out: str) -> DataFrame:
    """The rows of the newest version of every part; a clear has no barcode."""
    _, versions = _manifest(sp, out)
    if not versions:
        return sp.createDataFrame([], STATE_OUT)
    return sp.read.schema(STATE_OUT).parquet(*_part_paths(out, versions))


def _snapshot_sink(out: str, parts: int = 16):
    def fn(batch: DataFrame, batch_id: int) -> None:
        sp = batch.sparkSession
        last, versions = _manifest(sp, out)
        if last >= batch_id:
            return
        clear = F.col("kind") == "CLEAR"
        news = materialize(batch.where(F.col("session_id").isNotNull() & F.col("event_time").isNotNull() & (clear | F.col("barcode").isNotNull())).select(
            "session_id", F.when(~clear, F.col("barcode")).alias("barcode"), "event_time", "event_id",
            F.when(~clear, F.col("quantity")).alias("quantity"), "price", F.pmod(F.xxhash64("session_id"), F.lit(parts)).cast("int").alias("part")))
        touched = {r.part for r in news.select("part").distinct().collect()}
        old = {p: v for p, v in versions.items() if p in touched}
        part = F.pmod(F.xxhash64("session_id"), F.lit(parts)).cast("int").alias("part")
        both = news if not old else news.unionByName(sp.read.schema(STATE_OUT).parquet(*_part_paths(out, old)).select("*", part))
        newest = both.groupBy("part", "session_id", "barcode").agg(F.max(F.struct("event_time", "event_id", "quantity", "price")).alias("l"))
        cleared = newest.where("barcode is null").select(F.col("session_id").alias("_s"), F.struct("l.event_time", "l.event_id").alias("_c"))
        kept = (newest.join(cleared, F.col("session_id") == F.col("_s"), "left")
                .where(F.col("barcode").isNull() | F.col("_c").isNull() | (F.struct("l.event_time", "l.event_id") > F.col("_c"))))
        rows = kept.select("session_id", "barcode", "l.event_time", "l.event_id", "l.quantity", "l.price", "part")
        rows.repartition(max(1, len(touched)), "part").write.partitionBy("part").mode("overwrite").parquet(f"{out}/data/v={batch_id}")
        held = sorted((versions | dict.fromkeys(touched, batch_id)).items())
        sp.createDataFrame(held, "part int, version long").coalesce(1).write.mode("overwrite").json(f"{out}/manifest/v={batch_id}")
        sp.createDataFrame([(str(batch_id),)], "value string").coalesce(1).write.mode("overwrite").text(f"{out}/_latest")
    return fn


# --- custom stateful (applyInPandasWithState): rows in event-time order ----------------

DAY_US, HOUR_US = 86_400_000_000, 3_600_000_000


#: Groups that the keys of a stateful stream are dealt into. A call of a state function costs as much for one key as
#: for hundreds, so their number is bounded, however many keys there are; it must stay as it is while a stream lives.
STATE_PARTS = 1 << 12


def dealt(rows: DataFrame, key: str, tie: str) -> DataFrame:
    """Rows with their key as text (``state_key``) and the group that it falls into (``state_part``); the tie-break id is text too,
    so that a null among them does not make the others inexact."""
    text = F.col(key).cast("string")
    return rows.withColumns({"state_key": text, "state_part": F.pmod(F.xxhash64(text), F.lit(STATE_PARTS)).cast("int"), tie: F.col(tie).cast("string")})


def _micros(p: pd.DataFrame, at: str) -> list[int]:
    return ((p[at] - pd.Timestamp(0)) // pd.Timedelta("1us")).tolist()


def _texts(values) -> list:
    return [None if pd.isna(v) else str(v) for v in values.tolist()]


def _ids(values) -> list:
    return [None if pd.isna(v) else int(v) for v in values.tolist()]


def _by_time(row) -> tuple:
    """Order of (time, id, ...) rows; null ids come first."""
    return row[0], row[1] is not None, row[1] or 0


def _frame(out: list[dict]) -> pd.DataFrame:
    cols = {c: [r[c] for r in out] for c in out[0]}
    return pd.DataFrame({c: pd.array(v, dtype="Int64") if all(x is None or type(x) is int for x in v) else v for c, v in cols.items()})


def _in_order(names: list[str], step):
    """A state function of a group of keys that hands each key's rows to ``step`` in event-time order.

    Rows are held until the watermark has passed them, so input that is out of
    order across micro-batches (within the watermark) gives the same result as
    in order. The first of ``names`` is the time, the second breaks ties, the
    others are texts; rows without a time take no part.
    ``step(key, fold state or None, rows, watermark)`` returns the new fold state
    (None: nothing to keep), output rows, and the time at which it wants to be
    called again though no row comes (None: never). Times are microseconds. The
    state of a group holds no key that has neither rows nor a fold state."""
    def run(_, frames, state):
        held, stored = json.loads(state.get[0]) if state.exists else ([], [])
        folds = {k: (fold, wake) for k, fold, wake in stored}
        if not state.hasTimedOut:
            for p in frames:
                p = p[p[names[0]].notna()]
                held += zip(p["state_key"].tolist(), _micros(p, names[0]), _ids(p[names[1]]), *[_texts(p[c]) for c in names[2:]])
        now = state.getCurrentWatermarkMs() * 1000
        ready: dict = {k: [] for k, (_, wake) in folds.items() if wake is not None and wake <= now}
        for r in held:
            if r[1] <= now:
                ready.setdefault(r[0], []).append(r[1:])
        held, out = [r for r in held if r[1] > now], []
        for k, rows in ready.items():
            fold, more, wake = step((k,), folds.pop(k, (None, None))[0], sorted(rows, key=_by_time), now)
            out += more
            if fold is not None:
                folds[k] = (fold, wake)
        if not held and not folds:
            if state.exists:
                state.remove()
        else:
            state.update((json.dumps([held, [[k, *v] for k, v in folds.items()]]),))
            wakes = [r[1] for r in held] + [wake for _, wake in folds.values() if wake is not None]
            if wakes:
                state.setTimeoutTimestamp(max(min(wakes) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        if out:
            yield _frame(out)
    return run


def cart_rows(touched):
    """Output rows from (session, barcode) -> (quantity, price text, time)."""
    plain = {"session_id": [s for s, _ in touched], "barcode": [b for _, b in touched], "quantity": [q for q, _, _ in touched.values()],
             "price": [None if p is None else Decimal(p) for _, p, _ in touched.values()]}
    out = pd.DataFrame({c: pd.Series(v, dtype=object) for c, v in plain.items()})
    return out.assign(event_time=pd.to_datetime([t for _, _, t in touched.values()], unit="us"))


class CartProcessor(StatefulProcessor):
    """Lines of a group of carts over adds (+1; the price is that of the line's
    first add), removes (-1; refused at 0) and clears. A cart ends 24 hours after
    its last event: its lines go to 0 and its state leaves.

    Rows wait in a list, which a batch only appends to; an event-time timer at
    the earliest of them, or at the earliest end of a cart, hands over, in order,
    those that the watermark has passed. Lines and last events are maps, each read
    in one go; a batch writes only the lines and carts that it changes."""

    def init(self, handle):
        self.handle = handle
        self.held = handle.getListState("held", "session string, at long, event_id long, kind string, barcode string, price string")
        self.lines = handle.getMapState("lines", "session string, barcode string", "quantity long, price string")
        self.last = handle.getMapState("last", "session string", "at long")
        self.timer = handle.getValueState("timer", "ms long")

    def handleInputRows(self, key, rows, timerValues):
        first = None
        for p in rows:
            p = p[p["event_time"].notna()]
            us = _micros(p, "event_time")
            if us:
                self.held.appendList(list(zip(_texts(p["state_key"]), us, _ids(p["event_id"]), *[_texts(p[c]) for c in ("kind", "barcode", "price")])))
                first = min([*us, first] if first is not None else us)
        if first is not None:
            self._call_at(first, timerValues)
        yield cart_rows({})

    def _call_at(self, us, timerValues):
        """One timer, at the earliest time that was asked for."""
        ms = max(us // 1000 + 1, timerValues.getCurrentWatermarkInMs() + 1)
        set_for = self.timer.get()[0] if self.timer.exists() else None
        if set_for is None or ms < set_for:
            if set_for is not None:
                self.handle.deleteTimer(set_for)
            self.handle.registerTimer(ms)
            self.timer.update((ms,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentWatermarkInMs() * 1000
        self.timer.clear()
        ready, rest = {}, []
        for row in self.held.get() if self.held.exists() else ():
            if row[1] <= now:
                ready.setdefault(row[0], []).append(tuple(row)[1:])
            else:
                rest.append(tuple(row))
        if ready:
            self.held.put(rest) if rest else self.held.clear()
        lasts = {k[0]: v[0] for k, v in self.last.iterator()} if self.last.exists() else {}
        stored: dict = {}  # session -> barcode -> (quantity, price)
        for k, v in self.lines.iterator() if self.lines.exists() else ():
            stored.setdefault(k[0], {})[k[1]] = tuple(v)
        touched: dict = {}
        for session in [*ready, *(s for s, at in lasts.items() if s not in ready and at + DAY_US < now)]:
            lines, last = dict(stored.get(session, {})), lasts.get(session)
            changed: dict = {}

            def end(when):
                for barcode in lines:
                    changed[barcode] = (0, None, when)
                lines.clear()

            for when, _, kind, barcode, price in sorted(ready.get(session, ()), key=_by_time):
                if kind == "CLEAR" or last is not None and when > last + DAY_US:
                    end(min(when, last + DAY_US) if last is not None else when)
                if kind == "ADD":
                    q, p = lines.get(barcode) or (0, price)
                    lines[barcode] = (q + 1, p)
                    changed[barcode] = (q + 1, p, when)
                elif kind == "REMOVE" and barcode in lines:
                    q, p = lines.pop(barcode)
                    if q > 1:
                        lines[barcode] = (q - 1, p)
                    changed[barcode] = (q - 1, p if q > 1 else None, when)
                last = when
            over = last + DAY_US < now
            if over:
                end(last + DAY_US)
            for barcode in changed:  # what changed is written once
                if barcode in lines:
                    self.lines.updateValue((session, barcode), lines[barcode])
                elif barcode in stored.get(session, {}):
                    self.lines.removeKey((session, barcode))
            if not over:
                self.last.updateValue((session,), (last,))
                lasts[session] = last
            elif session in lasts:
                self.last.removeKey((session,))
                del lasts[session]
            touched |= {(session, barcode): row for barcode, row in changed.items()}
        wakes = [r[1] for r in rest] + [at + DAY_US for at in lasts.values()]
        if wakes:
            self._call_at(min(wakes), timerValues)
        yield cart_rows(touched)

    def close(self):
        pass


def cart_stream(spark: SparkSession, events: DataFrame, home: str) -> DataFrame:
    """The cart events, landed and read again as a stream."""
    files = land(events.where(F.col("kind").isin("ADD", "REMOVE", "CLEAR")), f"{home}/in")
    return (spark.readStream.schema("event_id long, event_time timestamp, session_id long, barcode string, kind string, price decimal(19,4)")
            .option("maxFilesPerTrigger", files).json(f"{home}/in"))


EXPIRY_OUT = "session_id long, first_put timestamp, expires_at timestamp, puts long"
#: Stored lines of a cart that nobody has touched for so long are forgotten by the stream.
LINES_US = 30 * DAY_US


def _expiry_step(key, fold, rows, now):
    """Lifetimes of the keyed cart map, 24 hours after the last put: an add is a
    put, a remove that leaves the line above 0 too; a remove to 0 is none, one at
    0 is refused, and a clear ends the map. Lines outlive the map, as stored
    lines do."""
    lines, life, last = fold or [{}, None, None]
    out = []

    def end():
        out.append({"session_id": key[0], "first_put": pd.Timestamp(life[0], unit="us"),
                    "expires_at": pd.Timestamp(life[1] + DAY_US, unit="us"), "puts": life[2]})

    for at, _, kind, barcode in rows:
        last = at
        if life and at >= life[1] + DAY_US:
            end()
            life = None
        q, name = 0, json.dumps(barcode)
        if kind == "CLEAR":
            if life:
                end()
            lines, life = {}, None
        else:
            q = lines.get(name, 0) + (1 if kind == "ADD" else -1)
            if q > 0:
                lines[name] = q
                life = [at, at, 1] if life is None else [life[0], at, life[2] + 1]
            else:
                lines.pop(name, None)
    if life and life[1] + DAY_US <= now:
        end()
        life = None
    if not life and (not lines or last + LINES_US < now):
        return None, out, None
    return [lines, life, last], out, life[1] + DAY_US if life else last + LINES_US


def stream_cart_expiry(spark: SparkSession, events: DataFrame) -> DataFrame:
    """ST3: the lifetimes of the cart map (S7) as they end, up to the last watermark."""
    home = stream_home(spark, "cart_expiry")
    fold = _in_order(["event_time", "event_id", "kind", "barcode"], _expiry_step)
    st = (dealt(cart_stream(spark, events, home).withWatermark("event_time", "1 hour"), "session_id", "event_id").groupBy("state_part")
          .applyInPandasWithState(fold, EXPIRY_OUT.replace("session_id long", "session_id string"), "fold string", "append", GroupStateTimeout.EventTimeTimeout)
          .withColumn("session_id", F.col("session_id").cast("long")))
    out = _read_out(spark, run_available(st, home), EXPIRY_OUT)
    return out.withColumns({"first_put": _ntz("first_put"), "expires_at": _ntz("expires_at")})


CART_OUT = "session_id long, barcode string, quantity long, price decimal(19,4), event_time timestamp"
#: The state store that lists, maps and timers need.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_cart_state(spark: SparkSession, events: DataFrame) -> DataFrame:
    """ST1: live line quantities per session from the add/remove/clear stream
    (clears come from the change feed, not the topics), up to the last
    watermark. Update-mode output has several rows per line; the last one per
    line is returned, lines at 0 dropped."""
    home = stream_home(spark, "cart_state")
    return cart_state_of(spark, cart_stream(spark, events, home), home)


def cart_state_of(spark: SparkSession, stream: DataFrame, home: str) -> DataFrame:
    st = (dealt(stream.withWatermark("event_time", "1 hour"), "session_id", "event_id").groupBy("state_part")
          .transformWithStateInPandas(CartProcessor(), CART_OUT.replace("session_id long", "session_id string"), "update", "eventTime")
          .withColumn("session_id", F.col("session_id").cast("long")))
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKSDB)
    try:
        out = run_available(st, home, mode="update", foreach=_append_batches)
    finally:
        spark.conf.set(name, before)
    r = _read_out(spark, out, CART_OUT + ", batch_id long")
    last = (r.groupBy("session_id", "barcode")
             .agg(F.max(F.struct("batch_id", "event_time", "quantity", "price")).alias("_l")))
    return (last.where(F.col("_l.quantity") > 0)
                .select("session_id", "barcode", F.col("_l.quantity").alias("quantity"),
                        F.col("_l.price").alias("price")))


_ALLOWED = {}
for _f, _t in SESSION_EDGES:
    _ALLOWED.setdefault(_f, set()).add(_t)

SESSION_OUT = "event_id long, session_id string, target string, from_state string, accepted boolean, to_state string"


def _session_step(ttl_us):
    """The current state; each command is accepted when its edge is allowed, else
    refused (state unchanged). The state, a terminal one too, is kept until the
    session has had no command for ``ttl_us``: until then a finished session
    never starts again."""
    def step(key, fold, rows, now):
        (cur, last), out = fold or ("CREATED", None), []
        for at, eid, target in rows:
            ok = target in _ALLOWED.get(cur, set())
            out.append({"event_id": eid, "session_id": key[0], "target": target, "from_state": cur, "accepted": ok,
                        "to_state": target if ok else cur})
            cur, last = target if ok else cur, at
        if last is None or last + ttl_us < now:
            return None, out, None
        return [cur, last], out, last + ttl_us
    return step


def stream_session_state(spark: SparkSession, log: DataFrame, ttl_us: int = 2 * DAY_US) -> DataFrame:
    """ST2: the session state machine over a stream of commands, up to the last
    watermark; refused commands are flagged. Equals the batch replay (T2) of
    sessions whose commands are never ``ttl_us`` apart (a session lives a day)."""
    home = stream_home(spark, "session_state")
    files = land(log, f"{home}/in")
    s = (spark.readStream.schema("event_id long, event_time timestamp, user_id long, session_id string, target string")
         .option("maxFilesPerTrigger", files).json(f"{home}/in"))
    return session_state_of(spark, s, home, ttl_us)


def session_state_of(spark: SparkSession, stream: DataFrame, home: str, ttl_us: int) -> DataFrame:
    st = (dealt(stream.withWatermark("event_time", "1 hour"), "session_id", "event_id").groupBy("state_part")
          .applyInPandasWithState(_in_order(["event_time", "event_id", "target"], _session_step(ttl_us)), SESSION_OUT, "fold string", "append",
                                  GroupStateTimeout.EventTimeTimeout))
    out = run_available(st, home, mode="append", foreach=_append_batches)
    return _read_out(spark, out, SESSION_OUT + ", batch_id long").drop("batch_id")


LOOKUP_OUT = "request_id long, barcode string, requested_at timestamp"


def _lookup_step(key, fold, rows, now):
    """A product is loaded by the first lookup, and again by the first one at
    least an hour after its last load; the others find it in the cache."""
    out = []
    for at, rid in rows:
        if fold is None or at >= fold + HOUR_US:
            fold = at
            out.append({"request_id": rid, "barcode": key[0], "requested_at": pd.Timestamp(at, unit="us")})
    if fold is None or fold + HOUR_US < now:
        return None, out, None
    return fold, out, fold + HOUR_US


def stream_lookup_dedup(spark: SparkSession, lookups: DataFrame) -> DataFrame:
    """ST4: the lookups that reach the store behind a cache with a fixed life of
    an hour, up to the last watermark."""
    home = stream_home(spark, "lookup_dedup")
    files = land(lookups, f"{home}/in", order="requested_at")
    s = (spark.readStream.schema("request_id long, barcode string, requested_at timestamp")
         .option("maxFilesPerTrigger", files).json(f"{home}/in"))
    st = (dealt(s.withWatermark("requested_at", "1 hour"), "barcode", "request_id").groupBy("state_part")
           .applyInPandasWithState(_in_order(["requested_at", "request_id"], _lookup_step), LOOKUP_OUT, "fold string", "append",
                                   GroupStateTimeout.EventTimeTimeout))
    out = _read_out(spark, run_available(st, home), LOOKUP_OUT)
    return out.withColumn("requested_at", _ntz("requested_at"))
