"""S1 scans and the adapter views that give the driver tables the checkout shapes.

Each view is a lazy projection over one parquet scan; Catalyst prunes the
columns a caller does not use and pushes its filters into the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.columns import qr_sign
from basketry.schemas import MONEY, QR_TTL
from basketry.sources.fixtures import QR_SECRET

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A parquet scan of one driver table (schema from the footer)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_jdbc(spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int,
              partitions: int, properties: dict | None = None) -> DataFrame:
    """S1 for a live relational store: a range-partitioned JDBC read (option only)."""
    return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=properties or {})


def barcode_of(key: Column) -> Column:
    return F.lpad(key.cast("string"), 13, "0")


def first_int(props: Column) -> Column:
    """The first integer inside the events' ``props`` text."""
    return F.regexp_extract(props, "[0-9]+", 0).cast("int")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        barcode_of(k).alias("barcode"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").cast(MONEY).alias("price"),
        F.lit("EUR").alias("currency_code"),
        F.col("p_type").alias("category"),
        F.col("p_size").alias("aisle_number"),
        F.when(k % 7 == 0, F.lit(None).cast("string"))
         .otherwise(F.substring(F.lit("abcde"), (k % 5 + 1).cast("int"), 1)).alias("nutriscore_grade"),
        (k % 20 == 0).alias("rfid_security_required"),
        F.lit(100).alias("stock_quantity"),
        F.concat(F.lit('{"type":"'), F.col("p_type"), F.lit('","size":'),
                 F.col("p_size").cast("string"), F.lit("}")).alias("attributes"),
        F.lit(0).cast("bigint").alias("version"),
    )


def cart_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("session_id"),
        barcode_of(F.col("l_partkey")).alias("barcode"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("price"),
        F.col("l_shipdate").alias("scanned_at"),
        F.col("l_linenumber").alias("seq"),
    )


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("session_id"),
        F.col("o_custkey").alias("user_id"),
        F.lit(1).cast("bigint").alias("store_id"),
        F.when(F.col("o_orderstatus") == "O", "ACTIVE").when(F.col("o_orderstatus") == "P", "PAYING")
         .otherwise("COMPLETED").alias("status"),
        F.col("o_orderdate").alias("created_at"),
        (F.col("o_orderdate") + F.expr(f"INTERVAL {QR_TTL}")).alias("expires_at"),
    )


def cart_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    n = first_int(F.col("props"))
    et = F.col("event_type")
    return e.select(
        F.col("event_id"),
        F.col("ts").alias("event_time"),
        F.col("user_id").alias("session_id"),
        barcode_of(n % 5).alias("barcode"),
        F.when(et.isin("view", "purchase"), "ADD").when(et == "click", "REMOVE")
         .when(et == "error", "HELP").when(F.col("event_id") % 10 == 0, "CLEAR")
         .otherwise("ADD").alias("kind"),
        F.col("value").cast(MONEY).alias("price"),
        n.alias("aisle_number"),
    )


def cart_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads of carts at a time: staff look into a cart some hours (up to 59) after each help request."""
    e = read_table(spark, sf_dir, "events")
    return e.where(F.col("event_type") == "error").select(
        F.col("event_id").alias("request_id"), F.col("user_id").alias("session_id"),
        F.timestamp_add("HOUR", (F.col("event_id") % 60).cast("int"), F.col("ts")).alias("as_of"))


def session_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    et = F.col("event_type")
    return (e.where(et.isin("signup", "click", "purchase")
                    | ((et == "error") & (F.col("event_id") % 4 == 0)))
             .select(
                 F.col("event_id"),
                 F.col("ts").alias("event_time"),
                 F.col("user_id"),
                 F.concat(F.col("user_id").cast("string"), F.lit("-"),
                          F.to_date(F.col("ts")).cast("string")).alias("session_id"),
                 F.when(et == "signup", "ACTIVE").when(et == "click", "PAYING")
                  .when(et == "purchase", "COMPLETED").otherwise("CANCELLED").alias("target"),
             ))


def token_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    et = F.col("event_type")
    return (e.where((et == "view") | ((et == "signup") & (F.col("event_id") % 20 == 0)))
             .select(
                 F.col("event_id"),
                 F.col("ts").alias("event_time"),
                 F.col("user_id").alias("family_id"),
                 F.concat(F.col("user_id").cast("string"), F.lit(":"),
                          (first_int(F.col("props")) % 10).cast("string")).alias("token"),
                 F.when(et == "view", "PRESENT").otherwise("LOGOUT").alias("kind"),
             ))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    k = first_int(F.col("props")) % 10
    return (e.select("user_id", "ts", k.alias("k"))
             .groupBy("user_id", "k")
             .agg(F.min("ts").alias("created_at"))
             .select(
                 F.concat(F.col("user_id").cast("string"), F.lit(":"), F.col("k").cast("string")).alias("token"),
                 F.col("user_id").alias("family_id"),
                 F.col("user_id"),
                 F.col("created_at"),
                 (F.col("created_at") + F.expr("INTERVAL 7 DAYS")).alias("expires_at"),
                 (F.col("k") % 4 == 0).alias("revoked"),
                 F.when(F.col("k") % 4 == 0, F.lit("ROTATED")).alias("revocation_reason"),
             ))


def qr_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    pr = F.col("o_orderpriority")
    return o.select(
        F.concat(F.lit("corr-"), k.cast("string")).alias("correlation_id"),
        k.alias("session_id"),
        F.when(k % 2 == 0, "ENTRY").otherwise("EXIT").alias("token_type"),
        F.concat(F.lit('{"sessionId":"'), k.cast("string"), F.lit('","userId":'),
                 F.col("o_custkey").cast("string"), F.lit("}")).alias("payload"),
        (k % 10 == 0).alias("tampered"),
        F.when(pr == "1-URGENT", "USED").when(pr == "5-LOW", "REVOKED").otherwise("ACTIVE").alias("status"),
        F.col("o_orderdate").alias("created_at"),
        (F.col("o_orderdate") + F.expr(f"INTERVAL {QR_TTL}")).alias("expires_at"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    return c.select(
        k.alias("id"),
        F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))),
                 F.when(k % 11 == 0, F.lit("")).otherwise(F.lit("@example.org"))).alias("email"),
        F.concat(F.lit("u"), (k % 1400).cast("string")).alias("username"),
        F.when(seg == "BUILDING", "ROLE_ADMIN").when(seg == "MACHINERY", "ROLE_WORKER")
         .otherwise("ROLE_CUSTOMER").alias("role"),
    )


def access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    et = F.col("event_type")
    prefix = (F.when(et == "view", "/api/products/").when(et == "click", "/api/cart/")
              .when(et == "purchase", "/api/sessions/").when(et == "signup", "/api/auth/")
              .otherwise("/other/"))
    return e.select(
        eid,
        F.col("ts").alias("event_time"),
        F.concat(prefix, eid.cast("string")).alias("path"),
        F.when(eid % 5 == 0, F.lit(None).cast("bigint")).otherwise(F.col("user_id")).alias("header_user_id"),
        F.when(eid % 7 == 0, F.lit(None).cast("bigint")).otherwise(F.col("user_id")).alias("param_user_id"),
        F.when(eid % 3 == 0, F.lit(None).cast("bigint")).otherwise(eid % 4 + 1).alias("store_id"),
    )


def _own_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.groupBy(F.col("o_custkey").alias("user_id")).agg(F.max("o_orderkey").alias("own"))


def access_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Access checks as text: half of them for a session of the user's own, the
    rest for others' and unknown sessions, some malformed."""
    e = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return e.join(_own_sessions(spark, sf_dir), "user_id", "left").select(
        eid, F.col("ts").alias("event_time"),
        F.when(eid % 19 == 0, F.lit("x")).when(eid % 4 == 1, F.concat(F.lit("-"), eid.cast("string")))
         .when((eid % 2 == 0) & F.col("own").isNotNull(), F.col("own").cast("string"))
         .otherwise(eid.cast("string")).alias("session_text"),
        F.when(eid % 13 == 0, F.lit("")).when(eid % 17 == 0, F.lit("abc"))
         .otherwise(F.col("user_id").cast("string")).alias("user_text"))


def owner_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session reads by id: a third of the user's own session, the rest of any."""
    e = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return e.join(_own_sessions(spark, sf_dir), "user_id", "left").select(
        eid, F.when(eid % 3 == 0, F.col("own")).otherwise(eid).alias("session_id"), "user_id")


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    body = F.concat(
        F.lit('{"status":'), F.when(k % 9 == 0, F.lit("0")).otherwise(F.lit("1")),
        F.lit(',"product":{'),
        F.when(k % 4 == 0, F.lit("")).otherwise(F.concat(F.lit('"product_name":"'), F.col("p_name"), F.lit('",'))),
        F.lit('"brands":"'), F.when(k % 6 == 0, F.lit(" ")).otherwise(F.col("p_brand")),
        F.lit('","nutriscore_grade":"'), F.when(k % 8 == 3, F.lit("unknown")).when(k % 8 == 4, F.lit("")).otherwise(F.lit("b")),
        F.lit('","nutriments":{"energy-kcal_100g":'),
        F.when(k % 5 == 0, F.lit('"n/a"')).otherwise(F.col("p_size").cast("string")),
        F.lit("}}}"),
    )
    return p.select(F.concat(F.lit("9"), F.lpad(k.cast("string"), 12, "0")).alias("barcode"), body.alias("body"))


def barcode_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product lookups by barcode, two in five of a few popular ones, the rest spread over all
    parts: a third hit the catalog, a third only the fallback source (barcodes with a 9 in
    front), a third nothing (an 8)."""
    e = read_table(spark, sf_dir, "events")
    every = read_table(spark, sf_dir, "part").agg(F.max("p_partkey")).first()[0] or 0   # one number: keys are drawn from all parts
    eid = F.col("event_id")
    key = F.lpad(F.when(eid % 5 < 2, eid % 4).otherwise(eid * 7919 % (every + 1)).cast("string"), 12, "0")
    return e.select(eid.alias("request_id"), F.concat(F.when(eid % 3 == 0, "9").when(eid % 3 == 1, "0").otherwise("8"), key).alias("barcode"))


def full_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with all stored columns: texts, list and map as well."""
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    codes = F.split(F.lit("gluten,milk,nuts,soy,egg"), ",")
    return p.select(
        (k + 1).alias("id"), barcode_of(k).alias("barcode"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"),
        F.col("p_retailprice").cast(MONEY).alias("price"), F.lit("EUR").alias("currency_code"), (k % 5 + 1).alias("category_id"),
        F.col("p_size").alias("aisle_number"),
        F.when(k % 6 != 0, F.concat(F.lit("https://img.example.org/"), barcode_of(k), F.lit(".jpg"))).alias("image_url"),
        F.when(k % 7 != 0, F.substring(F.lit("abcde"), (k % 5 + 1).cast("int"), 1)).alias("nutriscore_grade"),
        F.when(k % 8 != 0, (k % 4 + 1).cast("smallint")).alias("nova_group"),
        F.when(k % 9 != 0, F.concat(F.lit("made of "), F.col("p_name"))).alias("ingredients_text"),
        F.when(k % 10 != 0, F.slice(codes, 1, (k % 4).cast("int"))).alias("allergen_codes"),
        F.lit(100).alias("stock_quantity"), (k % 20 == 0).alias("rfid_security_required"),
        F.when(k % 11 != 0, F.map_from_arrays(F.array(F.lit("energy"), F.lit("sugar")), F.array(F.col("p_size").cast("double"), (k % 30).cast("double"))))
         .alias("nutriments"),
        F.concat(F.lit('{"type":"'), F.col("p_type"), F.lit('"}')).alias("attributes"), F.lit(0).cast("bigint").alias("version"))


def search_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name searches: one per supplier, a fragment of a part-name word plus a limit."""
    s = read_table(spark, sf_dir, "supplier")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    k = F.col("s_suppkey")
    every = p.agg(F.max("p_partkey")).first()[0] or 0   # one number: keys are drawn from all parts
    j = s.join(p, (s.s_suppkey * 7) % (every + 1) == p.p_partkey, "left")
    word = F.element_at(F.split(F.coalesce(F.col("p_name"), F.lit("zzz qq")), " "), (k % 2 + 1).cast("int"))
    q = (F.when(k % 50 == 7, F.lit("%")).when(k % 50 == 8, F.lit("__")).when(k % 50 == 9, F.concat(F.substring(word, 1, 1), F.lit("_"), F.substring(word, 3, 2)))
         .when(k % 5 == 0, F.substring(word, 1, 2)).otherwise(F.substring(word, 2, 4)))
    return j.select(k.alias("query_id"), F.upper(q).alias("query"), (k % 4 + 2).cast("int").alias("lim"))


def gate_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One shopping session per order, in all states a gate can meet."""
    o = read_table(spark, sf_dir, "orders")
    k, st = F.col("o_orderkey"), F.col("o_orderstatus")
    return o.select(k.alias("session_id"), F.col("o_custkey").alias("user_id"),
                    F.when(st == "F", "COMPLETED").when(k % 7 == 0, "PAYING").when(k % 11 == 0, "CANCELLED")
                     .otherwise("CREATED").alias("status"))


def gate_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two QR tokens per order, valid for a day of the gates' month: some used or
    revoked before, some with an altered or a vault signature."""
    o = read_table(spark, sf_dir, "orders").withColumn("no", F.explode(F.array(F.lit(0), F.lit(1))))
    k, no, pr = F.col("o_orderkey"), F.col("no"), F.col("o_orderpriority")
    payload = F.concat(F.lit('{"sessionId":"'), k.cast("string"), F.lit('","userId":'), F.col("o_custkey").cast("string"),
                       F.lit(',"no":'), no.cast("string"), F.lit("}"))
    created = F.timestamp_add("HOUR", (k * 5 % 600 + no).cast("int"), F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'"))
    signed = qr_sign(F.when(k % 10 == 9, F.concat(payload, F.lit("#"))).otherwise(payload), QR_SECRET)
    return o.select(
        F.concat(F.lit("gate-"), k.cast("string"), F.lit("-"), no.cast("string")).alias("correlation_id"),
        k.alias("session_id"),
        F.when(F.col("o_orderstatus") == "F", "EXIT").otherwise("ENTRY").alias("token_type"),
        payload.alias("payload"),
        F.when(k % 13 == 12, F.concat(F.lit("vault:v1:"), payload)).otherwise(signed).alias("vault_signature"),
        F.when((pr == "1-URGENT") & (no == 1), "USED").when((pr == "5-LOW") & (no == 0), "REVOKED")
         .otherwise("ACTIVE").alias("status"),
        created.alias("created_at"), (created + F.expr(f"INTERVAL {QR_TTL}")).alias("expires_at"))


def gate_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One to six gate scans per order, around the life of its tokens: repeated,
    at both gates, with either token, some of unknown ids, some too late."""
    o = read_table(spark, sf_dir, "orders").withColumn(
        "i", F.explode(F.sequence(F.lit(0), (F.col("o_orderkey") % 6).cast("int"))))
    k, i = F.col("o_orderkey"), F.col("i")
    hours = (k * 5 % 600 + (k * 7 + i * 11) % 40).cast("int")
    return o.select(
        (k * 8 + i).alias("request_id"),
        F.timestamp_add("HOUR", hours, F.expr("TIMESTAMP_NTZ'2024-01-01 01:00:00'")).alias("requested_at"),
        F.concat(F.lit("gate-"), k.cast("string"),
                 F.when((k * 3 + i) % 23 == 0, F.lit("-x")).when((k + i) % 3 == 0, F.lit("-1")).otherwise(F.lit("-0")))
         .alias("correlation_id"),
        F.when((F.col("o_orderstatus") == "F") == ((k + i) % 5 == 0), "entry").otherwise("exit").alias("gate"))


def field_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of five kinds with their fields, some blank, missing or malformed."""
    e = read_table(spark, sf_dir, "events")
    eid, et = F.col("event_id"), F.col("event_type")
    bad = F.when(eid % 8 == 0, F.lit("")).when(eid % 8 == 1, F.lit("  ")).when(eid % 8 == 2, F.lit(None).cast("string"))
    customer = F.concat(F.lit("customer."), F.lpad(F.col("user_id").cast("string"), 9, "0"), F.lit("@example.org"))
    kind = (F.when(et == "view", "add_item").when(et == "click", "gate").when(et == "purchase", "login")
            .when(et == "signup", "refresh").otherwise("logout"))
    return e.select(eid.alias("request_id"), kind.alias("kind"),
                    F.when(eid % 8 < 3, bad).when(eid % 8 == 3, F.lit("not-an-email")).when(eid % 8 == 4, F.lit("nobody@example.org"))
                     .otherwise(customer).alias("email"),
                    F.when(eid % 7 == 0, F.lit("")).otherwise(F.lit("secret")).alias("password"),
                    *[F.when(eid % 8 < 3, bad).otherwise(F.concat(F.lit("x"), eid.cast("string"))).alias(c)
                      for c in ("refresh_token", "barcode", "correlation_id")])


def price_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates to the catalog: a 10% price rise on every third part, a rename of
    every fifth, a second rise for some, and new products."""
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    rows = p.where((k % 3 == 0) | (k % 5 == 0)).select(
        barcode_of(k).alias("barcode"), F.when(k % 5 == 0, F.upper("p_name")).alias("name"),
        F.when(k % 3 == 0, (F.col("p_retailprice") * 1.1).cast(MONEY)).alias("price"), F.lit(1).alias("seq"))
    again = p.where(k % 15 == 0).select(
        barcode_of(k).alias("barcode"), F.lit(None).cast("string").alias("name"),
        (F.col("p_retailprice") * 1.2).cast(MONEY).alias("price"), F.lit(2).alias("seq"))
    fresh = p.where(k % 50 == 7).select(F.concat(F.lit("9"), barcode_of(k)).alias("barcode"), F.col("p_name").alias("name"),
                                        F.col("p_retailprice").cast(MONEY).alias("price"), F.lit(1).alias("seq"))
    return rows.unionByName(again).unionByName(fresh)


def partial_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with every column that has a default, each null in part of them."""
    k = F.col("p_partkey")
    gap = lambda n, c: F.when(k % n != 0, c)
    return read_table(spark, sf_dir, "part").select(
        barcode_of(k).alias("barcode"), gap(2, k % 9).alias("store_id"), gap(3, F.col("p_size")).alias("aisle_number"),
        gap(4, F.lit("USD")).alias("currency_code"), gap(5, (k % 50).cast("int")).alias("stock_quantity"),
        gap(6, F.lit(True)).alias("rfid_security_required"), gap(7, F.lit("ACTIVE")).alias("status"),
        gap(8, (k % 4).cast("int")).alias("quantity"), gap(9, k % 11).alias("version"))


def landed_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog columns as a store of fixed-width text lands them."""
    return catalog(spark, sf_dir).select(
        "barcode", F.rpad("currency_code", 3, " ").alias("currency_code"),
        F.rpad(F.coalesce("nutriscore_grade", F.lit("")), 1, " ").alias("nutriscore_grade"),
        F.rpad("category", 25, " ").alias("category"))


def damaged_audit(audit: DataFrame) -> DataFrame:
    """An audit log with lost rows and rows whose target was altered."""
    eid = F.col("event_id")
    return audit.where(eid % 9 != 0).withColumn("to_state", F.when(eid % 10 == 1, "CREATED").otherwise(F.col("to_state")))


def signups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registration requests from the ``signup`` events: some reuse an existing
    customer's e-mail or user name, some repeat within the batch, some break
    the field rules."""
    e = read_table(spark, sf_dir, "events").where(F.col("event_type") == "signup")
    eid, uid = F.col("event_id"), F.col("user_id")
    cust = F.concat(F.lit("customer."), F.lpad(uid.cast("string"), 9, "0"))
    email = (F.when(eid % 6 == 0, F.concat(cust, F.lit("@example.org")))
             .when(eid % 6 == 1, F.lit("not-an-email"))
             .when(eid % 6 == 2, F.concat(F.lit("shopper"), (uid % 40).cast("string"), F.lit("@shop.example")))
             .otherwise(F.concat(F.lit("new"), eid.cast("string"), F.lit("@shop.example"))))
    username = (F.when(eid % 5 == 0, F.concat(F.lit("u"), (uid % 1400).cast("string")))
                .when(eid % 5 == 1, F.lit("ab"))
                .when(eid % 5 == 2, F.concat(F.lit("shopper"), (uid % 25).cast("string")))
                .otherwise(F.concat(F.lit("user"), eid.cast("string"))))
    password = F.when(eid % 7 == 0, F.lit("short")).otherwise(F.concat(F.lit("secret-password-"), eid.cast("string")))
    return e.select(eid.alias("request_id"), F.col("ts").alias("requested_at"), email.alias("email"),
                    username.alias("username"), password.alias("password"))


ADAPTERS = {
    "catalog": catalog, "cart_lines": cart_lines, "sessions": sessions,
    "cart_events": cart_events, "cart_reads": cart_reads, "session_log": session_log, "token_log": token_log,
    "tokens": tokens, "qr_tokens": qr_tokens, "users": users, "access_log": access_log,
    "raw_products": raw_products, "full_products": full_products, "barcode_requests": barcode_requests,
    "access_requests": access_requests, "owner_requests": owner_requests,
    "landed_catalog": landed_catalog, "partial_rows": partial_rows, "price_updates": price_updates, "field_requests": field_requests,
    "search_requests": search_requests, "gate_sessions": gate_sessions, "gate_tokens": gate_tokens,
    "gate_requests": gate_requests,
    "signups": signups,
}


class Views:
    """Lazy access to the adapter views of one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in ADAPTERS:
            return ADAPTERS[name](self.spark, self.sf_dir)
        if name in DRIVER_TABLES:
            return read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)
