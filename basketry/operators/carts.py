"""Cart operators: line views, totals, the add/remove/clear fold and its feeds.

Inputs are the ``cart_lines`` view (stored lines, one row per scan) and the
``cart_events`` view (event_id, event_time, session_id, barcode, kind in
ADD/REMOVE/CLEAR/HELP, price, aisle_number).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators import cart_history
from basketry.operators.asof import holding
from basketry.operators.scan import HOUR_US, join_back, materialize
from basketry.schemas import CART_TTL


# --- A1 / A3 / A2 / O1 / P6 / P9 over stored lines --------------------------------

def cart_totals(lines: DataFrame) -> DataFrame:
    """A1: per session exact Σ price×quantity and Σ quantity (itemCount).

    A two-phase hash aggregate: partial sums map-side, so a hot session costs
    one row per map task in the shuffle."""
    return (lines.groupBy("session_id")
                 .agg(F.sum(F.col("price") * F.col("quantity")).cast("decimal(38,4)").alias("total"),
                      F.sum("quantity").cast("bigint").alias("item_count"),
                      F.count(F.lit(1)).alias("scan_count")))


def scan_merge(lines: DataFrame) -> DataFrame:
    """A3: repeated scans of one product in a session become one line; the
    quantity is summed and the first scan's price is kept (ties: time, seq, price)."""
    first = F.min(F.struct("scanned_at", "seq", "price")).alias("_f")
    return (lines.groupBy("session_id", "barcode")
                 .agg(F.sum("quantity").cast("bigint").alias("quantity"), first)
                 .select("session_id", "barcode", "quantity",
                         F.col("_f.price").alias("price_at_addition"),
                         F.col("_f.scanned_at").alias("added_at")))


def cart_snapshot(sessions: DataFrame, lines: DataFrame) -> DataFrame:
    """A2 (flat form): one row per merged line with the session's totals after
    it; a requested session without lines gives one row with no barcode and
    zero totals. Lines are not gathered into one array per session, so a hot
    session never becomes one giant row."""
    merged = scan_merge(lines)
    totals = (merged.groupBy("session_id")
                    .agg(F.sum(F.col("price_at_addition") * F.col("quantity")).cast("decimal(38,4)").alias("total"),
                         F.sum("quantity").cast("bigint").alias("item_count")))
    req = sessions.select("session_id").distinct()
    t = req.join(totals, "session_id", "left")
    out = t.join(merged, "session_id", "left")
    return out.select(
        "session_id", "barcode", "quantity", "price_at_addition",
        F.coalesce(F.col("total"), F.lit(0).cast("decimal(38,4)")).alias("total"),
        F.coalesce(F.col("item_count"), F.lit(0).cast("bigint")).alias("item_count"))


def sorted_cart_lines(lines: DataFrame) -> DataFrame:
    """O1: merged lines ordered by session then product id (range-partitioned sort)."""
    return scan_merge(lines).orderBy("session_id", "barcode")


def cart_item_view(lines: DataFrame, catalog: DataFrame) -> DataFrame:
    """The 6-field line view (productId, name, quantity, price, image, addedAt)."""
    merged = scan_merge(lines)
    names = catalog.select("barcode", "name")
    return (merged.join(names, "barcode", "left")
                  .select("session_id", F.col("barcode").alias("product_id"),
                          F.col("name").alias("product_name"), "quantity", "price_at_addition",
                          F.lit(None).cast("string").alias("image_url"), "added_at"))


def path_key(path_col: str, prefix: str):
    """Numeric id right after ``prefix`` in a request path, else null."""
    return F.when(F.col(path_col).startswith(prefix),
                  F.regexp_extract(F.col(path_col), "^" + prefix + "([0-9]+)", 1)
                  .try_cast("bigint"))


def cart_lines_by_session(access: DataFrame, lines: DataFrame) -> DataFrame:
    """The stored lines of each requested session (cart GETs in the access log)."""
    req = (access.select("event_id", path_key("path", "/api/cart/").alias("session_id"))
                 .where(F.col("session_id").isNotNull()))
    return req.join(lines, "session_id", "inner").select(
        "event_id", "session_id", "barcode", "quantity", "price", "seq")


def cart_line_by_session_product(requests: DataFrame, lines: DataFrame) -> DataFrame:
    """P9 by (session, product): the stored lines of each requested pair, or a
    row without a quantity when there is none."""
    stored = lines.select("session_id", "barcode", "seq", "quantity", "price")
    return requests.join(stored, ["session_id", "barcode"], "left").select(
        "session_id", "barcode", "seq", "quantity", "price", F.col("quantity").isNotNull().alias("found"))


# --- J1: scans enriched from the catalog ------------------------------------------

def enrich_scans(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    """Scanned barcode ⋈ product; no product -> outcome ``product_not_found``.

    The catalog grows with the data, so no broadcast is forced: AQE turns the
    join into a broadcast only when the measured catalog side is small."""
    image = F.col("image_url") if "image_url" in catalog.columns else F.lit(None).cast("string").alias("image_url")
    cat = catalog.select("barcode", "name", "price", image)
    j = requests.join(cat, "barcode", "left")
    return j.select("request_id", "barcode", "name", "price", "image_url",
                    F.when(F.col("name").isNull(), "product_not_found").otherwise("ok").alias("outcome"))


# --- W1 / W2 / W3: the add/remove/clear fold (see cart_history) ---------------------

def cart_running_quantity(events: DataFrame, bucket_us: int = HOUR_US) -> DataFrame:
    """Line quantity after each add/remove; a remove at 0 is rejected and a
    clear starts a new epoch for the whole session."""
    return cart_history.quantities(events, bucket_us)


def price_at_addition(events: DataFrame, bucket_us: int = HOUR_US) -> DataFrame:
    """The price a line keeps is the price of the add that created it; a line
    removed to 0 and added again starts a new life with the new price."""
    return cart_history.history(events, bucket_us).select(
        "event_id", "event_time", "session_id", "barcode", "kind", "epoch", "life", "quantity",
        "rejected", F.col("price").alias("event_price"),
        F.when(F.col("quantity") > 0, F.col("line_price")).alias("price_at_addition"),
    )


def price_drift(events: DataFrame, bucket_us: int = HOUR_US) -> DataFrame:
    """Accepted adds whose event price differs from the price the line keeps."""
    w2 = price_at_addition(events, bucket_us)
    return (w2.where((F.col("kind") == "ADD") & (F.col("event_price") != F.col("price_at_addition")))
              .select("event_id", "session_id", "barcode", "event_price", "price_at_addition",
                      (F.col("event_price") - F.col("price_at_addition")).alias("drift")))


def change_rows(history: DataFrame) -> DataFrame:
    """S6 of a history with clears: one row per accepted change (see ``cart_change_feed``)."""
    clear = F.col("kind") == "CLEAR"
    return history.where(~F.col("rejected")).select(
        "event_id", "event_time", "session_id",
        F.when(clear, "CLEARED").when(F.col("kind") == "ADD", "ITEM_ADDED").otherwise("ITEM_REMOVED").alias("event_type"),
        F.when(~clear, F.col("barcode")).alias("barcode"), F.col("quantity").alias("line_quantity"), "item_count", "total",
        F.concat(F.lit("/topic/cart/"), F.col("session_id").cast("string")).alias("destination"))


def cart_change_feed(events: DataFrame, bucket_us: int = HOUR_US) -> DataFrame:
    """S6 (flat): one row per accepted change with the destination, the event
    type and the snapshot after it — the changed line's quantity plus the
    cart's item count and exact total. A clear gives an empty snapshot.

    Totals come from the fold itself, so nothing is gathered again per event."""
    return change_rows(cart_history.history(events, bucket_us, with_clears=True))


def live_lines(events: DataFrame, bucket_us: int = HOUR_US) -> DataFrame:
    """Current cart lines from the fold: the last state of each line in the
    session's last epoch, kept while its quantity is above 0."""
    rows = materialize(cart_history.history(events, bucket_us, with_clears=True, with_totals=False))
    last = (rows.where("kind <> 'CLEAR'").groupBy("session_id", "barcode")
                .agg(F.max(F.struct("event_time", "event_id", "epoch", "quantity", "line_price")).alias("_l")))
    j = join_back(last, rows.groupBy("session_id").agg(F.max("epoch").alias("_now")), ["session_id"])
    return (j.where((F.col("_l.epoch") == F.col("_now")) & (F.col("_l.quantity") > 0))
             .select("session_id", "barcode", F.col("_l.quantity").cast("bigint").alias("quantity"), F.col("_l.line_price").alias("price")))


def cart_read_through(events: DataFrame, lines: DataFrame, bucket_us: int = HOUR_US) -> DataFrame:
    """Per session the cached (live) lines when any exist, else the stored lines."""
    cache = live_lines(events, bucket_us).withColumn("source", F.lit("cache"))
    stored = scan_merge(lines).select("session_id", "barcode", "quantity",
                                      F.col("price_at_addition").alias("price"))
    cached_sessions = cache.select("session_id").distinct()
    rest = stored.join(cached_sessions, "session_id", "left_anti").withColumn("source", F.lit("store"))
    return cache.unionByName(rest)


def cart_ttl_view(events: DataFrame, bucket_us: int = HOUR_US) -> DataFrame:
    """Lifetimes of the keyed cart map. Every put (an accepted add, or a
    remove that leaves the line above 0) refreshes 24 h for the whole session;
    a delete to 0 does not refresh; a clear drops the key (new epoch). Expiry
    is the last put + 24 h.

    Lifetimes follow from the first and last put per hour (one partial
    aggregate), so a hot session never lands whole in one task, as it would
    with Spark's batch ``session_window``."""
    w1 = cart_running_quantity(events, bucket_us)
    return cart_history.lifetimes(w1.where("not rejected and quantity > 0"), bucket_us)


def _cached(requests: DataFrame, states: DataFrame) -> DataFrame:
    held = states.select("session_id", "barcode", "quantity", "price", F.col("since").alias("_since"),
                         F.least("until", "expires_at").alias("_until"))
    return holding(requests.select("request_id", "session_id", "as_of"), held, ["session_id"], "as_of", "_since", "_until").drop("_until")


def cart_as_of(requests: DataFrame, events: DataFrame, bucket_us: int = HOUR_US) -> DataFrame:
    """S7 at any time: the lines of the keyed cart map at each requested (session, time).

    A line is there from its put until its next change, the next clear or the
    end of the map (24 h without a put in the session); ``expires_at`` is when
    the map would end if nothing followed: the session's last put so far + 24 h.
    Requests of empty or expired maps give no row. A change at the very time
    counts; an expiry at the very time has happened."""
    states = materialize(cart_history.line_states(events, bucket_us))
    cached = materialize(_cached(requests, states))   # three branches read it
    puts = states.groupBy("session_id", F.col("since").alias("_put")).agg(F.max("expires_at").alias("_end"))
    ends = holding(cached.select("request_id", "session_id", "as_of").distinct(), cart_history.put_spans(puts, bucket_us), ["session_id"],
                   "as_of", "_put", "_next_put")
    ends = ends.select("request_id", (F.col("_put") + F.expr(f"INTERVAL {CART_TTL}")).alias("expires_at"))
    return cached.join(ends, "request_id").select("request_id", "session_id", "as_of", "barcode", "quantity", "price", "expires_at")


def cart_read_through_as_of(requests: DataFrame, events: DataFrame, bucket_us: int = HOUR_US) -> DataFrame:
    """J7 at any time: the cached lines of each requested (session, time) when the
    map holds any, else the stored lines, which do not expire. Both come from one
    fold, so ids are shared. A read does not fill the map here: requests are
    independent of each other."""
    states = materialize(cart_history.line_states(events, bucket_us))
    cached = materialize(_cached(requests, states).drop("_since"))
    held = states.select("session_id", "barcode", "quantity", "price", "since", "until")
    rest = requests.select("request_id", "session_id", "as_of").join(cached.select("request_id").distinct(), "request_id", "left_anti")
    stored = holding(rest, held, ["session_id"], "as_of", "since", "until").drop("since", "until")
    return cached.withColumn("source", F.lit("cache")).unionByName(stored.withColumn("source", F.lit("store")))


def delete_by_key(events: DataFrame, lines: DataFrame, bucket_us: int = HOUR_US) -> DataFrame:
    """Stored lines left after deleting whole sessions (clears) and single
    (session, product) lines (removes that took a line to 0)."""
    clears = events.where(F.col("kind") == "CLEAR").select("session_id").distinct()
    w1 = cart_running_quantity(events, bucket_us)
    gone = (w1.where((F.col("kind") == "REMOVE") & ~F.col("rejected") & (F.col("quantity") == 0))
              .select("session_id", "barcode").distinct())
    return (lines.join(clears, "session_id", "left_anti")
                 .join(gone, ["session_id", "barcode"], "left_anti"))


def accepted_help_requests(events: DataFrame, access: DataFrame, sessions: DataFrame,
                           id_format: str = "long") -> DataFrame:
    """Help requests whose session check passes (J2: owner matches and the
    session is ACTIVE) become ``help.requested`` event rows; no aisle -> 0;
    a missing user becomes '' and fails the check as INVALID_ARGUMENT."""
    from basketry.functions.columns import iso_instant
    from basketry.operators.sessions import session_access_check
    help_ev = events.where(F.col("kind") == "HELP").select("event_id", "event_time", "session_id", "aisle_number")
    hdr = access.select("event_id", "header_user_id")
    req = (help_ev.join(hdr, "event_id", "left")
                  .withColumn("session_text", F.col("session_id").cast("string"))
                  .withColumn("user_text", F.coalesce(F.col("header_user_id").cast("string"), F.lit(""))))
    chk = session_access_check(req, sessions, id_format)
    ok = chk.where(F.col("valid"))
    value = F.to_json(F.struct(F.col("session_id").cast("string").alias("sessionId"),
                               F.coalesce(F.col("aisle_number"), F.lit(0)).alias("aisleNumber"),
                               F.col("header_user_id").alias("userId"),
                               iso_instant("event_time").alias("timestamp")))
    return ok.select("event_id", F.lit("help.requested").alias("topic"),
                     F.col("session_id").cast("string").alias("key"), value.alias("value"))
