"""Catalog operators: lookups, projections, fallback source, upserts, ids,
search and the declared-only access paths (tree, attributes, trigrams)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.columns import blank_to_null, is_blank
from basketry.operators.expand import expand
from basketry.operators.scan import materialize
from basketry.schemas import COLUMN_LIMITS, DEFAULTS, MONEY, SEARCH_DEFAULT_LIMIT, SEED_CATEGORIES, SEED_PRODUCTS
from basketry.session import checkpoint_root


# --- P1 / P2 / P4 / P5 / O2 ------------------------------------------------------------

def product_by_barcode(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    """Unique-key lookup per request; an absent product gives no row."""
    return requests.select("request_id", "barcode").join(
        catalog.select("barcode", "name", "brand", "price"), "barcode", "inner")


def products_by_barcodes(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    """IN-list lookup: unknown keys dropped, repeated keys returned once
    (a semi join; AQE broadcasts the key side when it is measured small)."""
    keys = requests.select("barcode").distinct()
    return catalog.join(keys, "barcode", "left_semi").select("barcode", "name", "brand", "price")


def product_dto(products: DataFrame) -> DataFrame:
    """The 17-field product view (no created_at / updated_at / version); nutriments as JSON text."""
    return products.select(
        "id", "barcode", "name", "brand", "price", "currency_code", "category_id", "aisle_number", "image_url", "nutriscore_grade",
        "nova_group", "ingredients_text", "allergen_codes", "stock_quantity", "rfid_security_required",
        F.to_json("nutriments").alias("nutriments"), "attributes")


def product_nutrition(products: DataFrame) -> DataFrame:
    """list and map columns read: is an allergen in the list, its number of codes, a nutriment by key (0 if absent)."""
    return products.select(
        "barcode", F.coalesce(F.array_contains("allergen_codes", "milk"), F.lit(False)).alias("has_milk"),
        F.coalesce(F.array_size("allergen_codes"), F.lit(0)).alias("n_allergens"),
        F.coalesce(F.element_at("nutriments", F.lit("sugar")), F.lit(0.0)).alias("sugar"),
        F.coalesce(F.element_at("nutriments", F.lit("salt")), F.lit(0.0)).alias("salt"))


def product_wire_row(catalog: DataFrame) -> DataFrame:
    """P5: the 10-field wire message; unset strings read as '', aisle 0, rfid
    false, price as plain decimal text, attributes as JSON text."""
    e = F.lit("")
    return catalog.select(
        "barcode", "name", F.coalesce("brand", e).alias("brand"), F.col("price").cast("string").alias("price"),
        F.coalesce("currency_code", e).alias("currency_code"),
        F.coalesce("aisle_number", F.lit(0)).alias("aisle_number"),
        e.alias("image_url"), F.coalesce("nutriscore_grade", e).alias("nutriscore_grade"),
        F.coalesce("rfid_security_required", F.lit(False)).alias("rfid_flag"),
        F.coalesce("attributes", e).alias("attributes_json"))


def first_page(catalog: DataFrame, n: int = SEARCH_DEFAULT_LIMIT) -> DataFrame:
    """O2: page 0 of size n (n >= 1) by barcode: a top-n (TakeOrderedAndProject)."""
    if n < 1:
        raise ValueError("page size must be at least 1")
    return catalog.orderBy("barcode").limit(n).select("barcode", "name", "price")


def product_search(catalog: DataFrame, query: str, limit: int = SEARCH_DEFAULT_LIMIT,
                   literal: bool = False) -> DataFrame:
    """Case-insensitive substring search on the name, first ``limit`` rows.
    ``%`` and ``_`` in the query act as wildcards unless ``literal``; ties
    are broken by barcode so the page is deterministic."""
    name = F.lower(F.col("name"))
    hit = name.contains(query.lower()) if literal else name.like(f"%{query.lower()}%")
    return catalog.where(hit).orderBy("barcode").limit(limit).select("barcode", "name", "price")


# --- Q7 / O3: n-gram candidate search ------------------------------------------------------

def _grams(text: Column, n: int) -> Column:
    """Distinct n-grams of a text as an array (empty when shorter than n; the
    one 0-gram is the empty text)."""
    if not n:
        return F.array(F.lit(""))
    ln = F.char_length(text)
    return F.array_distinct(F.when(
        ln >= n, F.transform(F.sequence(F.lit(1), ln - n + 1), lambda i: text.substr(i, F.lit(n))))
        .otherwise(F.array().cast("array<string>")))


def name_gram_index(names: DataFrame, sizes=(0, 1, 2, 3)) -> DataFrame:
    """(gram, n, low) postings of lower-cased names, in one pass for all gram sizes."""
    def posts(n: int) -> Column:
        return F.transform(_grams(F.col("low"), n), lambda g: F.struct(g.alias("gram"), F.lit(n).alias("n")))

    return names.select("low", F.explode(F.concat(*[posts(n) for n in sizes])).alias("p")).select("p.gram", "p.n", "low")


def _literal_core(q: Column) -> Column:
    """Longest wildcard-free run of a LIKE pattern (what every match contains)."""
    runs = F.split(q, "[%_]")
    return F.aggregate(runs, F.lit(""), lambda acc, x: F.when(F.char_length(x) > F.char_length(acc), x)
                       .otherwise(acc))


def matching_names(queries: DataFrame, catalog: DataFrame) -> DataFrame:
    """(pattern ``q``, matching name ``low``) over distinct patterns and distinct
    names: both repeat a lot, so each is looked up and verified once.

    Each pattern is joined on one gram only - the rarest of its literal core
    (gram frequencies are a grouped count over the index), with size 3, or the
    whole core when it is 1-2 characters - and every candidate is verified
    with LIKE. A pattern of wildcards only has the empty core, which is the
    0-gram of every name, and is verified like the others."""
    names = catalog.select(F.lower(F.col("name")).alias("low")).where("low is not null").distinct()
    idx = name_gram_index(names)
    freq = idx.groupBy("gram", "n").agg(F.count(F.lit(1)).alias("freq"))
    q = (queries.select(F.lower(F.col("query")).alias("q")).where("q is not null").distinct()
         .withColumn("core", _literal_core(F.col("q"))))
    size = F.least(F.char_length("core"), F.lit(3))
    qg = q.select("q", size.alias("n"), F.explode(F.when(size == 3, _grams(F.col("core"), 3))
                                                  .otherwise(F.array("core"))).alias("gram"))
    pick = (qg.join(freq, ["gram", "n"], "left").groupBy("q", "n")
              .agg(F.min(F.struct(F.coalesce("freq", F.lit(0)).alias("f"), F.col("gram"))).alias("_r"))
              .select("q", "n", F.col("_r.gram").alias("gram")))
    hit = F.when(F.col("q").rlike("[%_]"), F.like(F.col("low"), F.concat(F.lit("%"), F.col("q"), F.lit("%")))) \
           .otherwise(F.contains(F.col("low"), F.col("q")))
    return pick.join(idx, ["gram", "n"]).where(hit).select("q", "low")


def trigram_search(queries: DataFrame, catalog: DataFrame) -> DataFrame:
    """Q7: every (query, product) where lower(name) LIKE '%' || lower(query) || '%',
    wildcard-only queries included. Exact, no nested loop; a common gram (a hot
    key) is never chosen while a rarer one exists. A match of a pattern and a name
    takes in the fewer of its queries and its products first, so what is stored on
    the way stays small when patterns or names repeat and when they do not; the
    others then come in by a join dealt by its own size (``expand``)."""
    asked = queries.select("query_id", F.lower(F.col("query")).alias("q"))
    named = catalog.select("barcode", "name", F.lower(F.col("name")).alias("low"))
    m = materialize(matching_names(queries, catalog)
                    .join(asked.groupBy("q").agg(F.count(F.lit(1)).alias("_asked")), "q")
                    .join(named.groupBy("low").agg(F.count(F.lit(1)).alias("_named")), "low"))
    few_queries, few_products = m.where("_asked < _named").select("q", "low"), m.where("_asked >= _named").select("q", "low")
    hits = materialize(expand(few_queries, asked, ["q"]).select("query_id", "low"))
    found = materialize(expand(few_products, named, ["low"]).select("q", "barcode", "name"))
    return (expand(named, hits, ["low"]).select("query_id", "barcode", "name")
            .unionByName(expand(found, asked, ["q"]).select("query_id", "barcode", "name")))


def top_n_per_query(queries: DataFrame, catalog: DataFrame, salts: int = 64) -> DataFrame:
    """O3: the search page of every query: its matches, first ``lim`` by barcode.

    A query that matches a name needs no more than the name's first
    max(``lim``) products, so each name is cut to those before anything is
    expanded per query (a salted two-level rank: a hot name is spread over
    ``salts`` tasks first). A query is then ranked in two levels as well."""
    lim = queries.select("query_id", F.lower(F.col("query")).alias("q"), "lim")
    most = int(lim.agg(F.max("lim")).first()[0] or 0)
    salt = F.pmod(F.xxhash64("barcode"), F.lit(salts))
    rank = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy("barcode"))
    named = (catalog.select("barcode", "name", F.lower(F.col("name")).alias("low")).withColumn("_salt", salt)
             .withColumn("_r", rank("low", "_salt")).where(F.col("_r") <= most)
             .withColumn("_r", rank("low")).where(F.col("_r") <= most).drop("_r"))
    m = matching_names(queries, catalog).join(named, "low").join(lim, "q")
    part = m.withColumn("_r", rank("query_id", "_salt")).where(F.col("_r") <= F.col("lim"))
    return (part.withColumn("rank", rank("query_id").cast("bigint")).where(F.col("rank") <= F.col("lim"))
            .select("query_id", "barcode", "name", "rank"))


# --- S3 / J6 / P17: fallback source ----------------------------------------------------

NUTRIMENT_KEYS = [("energy_kcal", "energy-kcal_100g"), ("fat", "fat_100g"),
                  ("carbohydrates", "carbohydrates_100g"), ("proteins", "proteins_100g"), ("salt", "salt_100g")]

_RAW_SCHEMA = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("product", T.StructType([
        T.StructField("product_name", T.StringType()),
        T.StructField("brands", T.StringType()),
        T.StructField("image_url", T.StringType()),
        T.StructField("nutriscore_grade", T.StringType()),
        T.StructField("nutriments", T.MapType(T.StringType(), T.StringType())),
    ])),
])


def product_json_normalize(raw: DataFrame) -> DataFrame:
    """S3: landed product documents -> catalog rows: keep status 1; name default
    'Unknown'; blank text -> null; price 0, stock 0, rfid false; the five
    nutriments read as numbers with 0 for absent or non-numeric values. A grade
    longer than its one-character column is null, and said so."""
    d = raw.select("barcode", F.from_json("body", _RAW_SCHEMA).alias("j"))
    status = F.col("j.status").try_cast("double").cast("int")
    d = d.where(status == 1)
    nut = F.col("j.product.nutriments")
    cols = [F.when(nut.isNotNull(), F.coalesce(F.element_at(nut, src).try_cast("double"), F.lit(0.0)))
            .alias(dst) for dst, src in NUTRIMENT_KEYS]
    name = F.col("j.product.product_name")
    grade = blank_to_null(F.col("j.product.nutriscore_grade"))
    return d.select(
        "barcode",
        F.when(is_blank(name), F.lit("Unknown")).otherwise(name).alias("name"),
        blank_to_null(F.col("j.product.brands")).alias("brand"),
        blank_to_null(F.col("j.product.image_url")).alias("image_url"),
        F.when(F.char_length(grade) <= COLUMN_LIMITS["nutriscore_grade"], grade).alias("nutriscore_grade"),
        F.coalesce(F.char_length(grade) > COLUMN_LIMITS["nutriscore_grade"], F.lit(False)).alias("grade_rejected"),
        F.lit(0).cast(MONEY).alias("price"), F.lit(0).alias("stock_quantity"),
        F.lit(False).alias("rfid_security_required"), *cols)


def apply_defaults(rows: DataFrame) -> DataFrame:
    """Entity defaults for absent fields: each column of ``rows`` that has a
    default (store, aisle, currency, stock, rfid, status, quantity, version)
    takes it where it is null."""
    return rows.withColumns({c: F.coalesce(F.col(c), F.lit(d).cast(rows.schema[c].dataType))
                             for c, d in DEFAULTS.items() if c in rows.columns})


def catalog_fallback(requests: DataFrame, catalog: DataFrame, raw: DataFrame) -> DataFrame:
    """Per requested barcode, the catalog row, else the fallback source's
    normalised row, else nothing; ``source`` says which."""
    cat = catalog.select("barcode", F.col("name").alias("c_name"), F.col("price").alias("c_price"))
    fb = product_json_normalize(raw).select("barcode", F.col("name").alias("f_name"),
                                            F.col("price").alias("f_price"))
    j = requests.select("request_id", "barcode").join(cat, "barcode", "left").join(fb, "barcode", "left")
    src = (F.when(F.col("c_name").isNotNull(), "catalog").when(F.col("f_name").isNotNull(), "fallback")
           .otherwise("none"))
    return j.select("request_id", "barcode", src.alias("source"),
                    F.coalesce("c_name", "f_name").alias("name"), F.coalesce("c_price", "f_price").alias("price"))


def write_through(requests: DataFrame, catalog: DataFrame, raw: DataFrame) -> DataFrame:
    """Fallback hits that the lookup adds to the catalog (new barcodes only)."""
    hits = catalog_fallback(requests, catalog, raw).where(F.col("source") == "fallback").select("barcode").distinct()
    found = product_json_normalize(raw).withColumns({
        c: F.lit(None).cast(t) for c, t in (("currency_code", "string"), ("aisle_number", "int"), ("version", "bigint"))})
    rows = apply_defaults(found).join(hits, "barcode", "left_semi")
    return rows.join(catalog.select("barcode"), "barcode", "left_anti")


# --- S2 / S8 / S10 ---------------------------------------------------------------------

def seed_frames(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    cats = spark.createDataFrame(SEED_CATEGORIES, "category_id long, category_name string, slug string, "
                                                  "parent_id long")
    prods = spark.createDataFrame(
        [(b, n, br, p, c, a, g, r) for b, n, br, p, c, a, g, r in SEED_PRODUCTS],
        "barcode string, name string, brand string, price string, category_id long, aisle_number int, "
        "nutriscore_grade string, rfid_security_required boolean").withColumn("price", F.col("price").cast(MONEY))
    return F.broadcast(cats), F.broadcast(prods)


def seed_dimensions(spark: SparkSession, catalog: DataFrame) -> DataFrame:
    """The seed products (20 literal rows with their 5 categories) added to
    the catalog where their barcode is new."""
    cats, prods = seed_frames(spark)
    seed = (prods.join(cats, "category_id")
                 .select("barcode", "name", "brand", "price", F.col("category_name").alias("category"),
                         "aisle_number", "nutriscore_grade", "rfid_security_required",
                         F.lit("seed").alias("source")))
    cat = catalog.select("barcode", "name", "brand", "price", "category", "aisle_number", "nutriscore_grade",
                         "rfid_security_required", F.lit("catalog").alias("source"))
    return cat.unionByName(seed.join(cat.select("barcode"), "barcode", "left_anti"))


def upsert_by_key(old: DataFrame, new: DataFrame, now: Column, key: str = "barcode",
                  cols: tuple[str, ...] = ("name", "price"), order: str = "seq") -> DataFrame:
    """Insert-or-update by unique key. Only non-null new values are applied
    (a partial update); the version moves on when something changed; rows
    whose new values equal the old ones are kept unchanged. ``created_at`` is
    set by the insert and kept for ever, ``updated_at`` moves with each change.

    Several new rows of one key are one change: each column takes its last
    non-null value by ``order`` (a grouped aggregate, combined on the map
    side), so no row is multiplied by the join."""
    o = old.select(key, *[F.col(c).alias("o_" + c) for c in cols], F.col("version").alias("o_version"), "created_at", "updated_at")
    n = (new.groupBy(key).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias("n_" + c) for c in cols])
         .withColumn("_new", F.lit(True)))
    j = o.join(n, key, "full")
    changed = F.lit(False)
    for c in cols:
        changed = changed | (F.col("n_" + c).isNotNull() & ~F.col("n_" + c).eqNullSafe(F.col("o_" + c)))
    op = (F.when(F.col("o_version").isNull(), "insert").when(F.col("_new") & changed, "update")
          .otherwise("keep"))
    version = (F.when(op == "insert", F.lit(0).cast("bigint"))
               .when(op == "update", F.col("o_version") + 1).otherwise(F.col("o_version")))
    return j.select(key, *[F.coalesce("n_" + c, "o_" + c).alias(c) for c in cols], version.alias("version"),
                    F.when(op == "insert", now).otherwise(F.col("created_at")).alias("created_at"),
                    F.when(op == "keep", F.col("updated_at")).otherwise(now).alias("updated_at"), op.alias("op"))


def assign_surrogate_ids(spark: SparkSession, new_rows: DataFrame, current_max: DataFrame,
                         key: str = "barcode") -> DataFrame:
    """Dense increasing ids for new rows in key order, starting after the
    current maximum — without a single-partition global window.

    Rows are range-sorted by key; each partition's row count gives its offset
    (a window over one row per partition); the id is offset + position in the
    partition (from ``monotonically_increasing_id``) + max. The sorted,
    tagged rows are checkpointed first so positions and counts come from the
    same materialised partitioning."""
    checkpoint_root(spark)
    tagged = (new_rows.orderBy(key)
                      .withColumn("_pid", F.spark_partition_id())
                      .withColumn("_mid", F.monotonically_increasing_id())
                      .checkpoint())
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    mx = current_max.agg(F.max("id")).first()[0] or 0   # one scalar
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    out = tagged.join(F.broadcast(offs), "_pid").withColumn("_max", F.lit(mx).cast("bigint"))
    return out.select(*new_rows.columns, (F.col("_max") + F.col("_off") + pos + 1).cast("bigint").alias("id"))


# --- Q5 / Q6 / Q8 ----------------------------------------------------------------------

def tree_nodes(region: DataFrame, nation: DataFrame, customer: DataFrame) -> DataFrame:
    """region -> nation -> customer as one (node_id, parent_id, name) table."""
    r = region.select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("node_id"),
                      F.lit(None).cast("string").alias("parent_id"), F.col("r_name").alias("name"))
    n = nation.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("node_id"),
                      F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("parent_id"),
                      F.col("n_name").alias("name"))
    c = customer.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("node_id"),
                        F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("parent_id"),
                        F.col("c_name").alias("name"))
    return r.unionByName(n).unionByName(c)


def category_tree(spark: SparkSession, nodes: DataFrame) -> DataFrame:
    """Q5: root, depth and path of every node, by pointer doubling: after step k
    a node knows its path up to 2^k levels above, so a tree of any depth takes
    log2(depth) joins. Only nodes that have not met a root go on; each step is
    checkpointed. Nodes still open after log2(node count) + 1 steps hang on a
    cycle, and that raises."""
    checkpoint_root(spark)
    state = nodes.select("node_id", F.col("parent_id").alias("cur"), F.col("name").alias("path"),
                         F.when(F.col("parent_id").isNull(), 0).otherwise(1).alias("depth")).checkpoint()
    steps = max(1, state.count()).bit_length() + 1
    done = state.where("cur is null")
    for _ in range(steps):
        open_ = state.where("cur is not null")
        if open_.isEmpty():
            return done.select("node_id", "depth", "path", F.split("path", "/").getItem(0).alias("root_name"))
        above = state.select(F.col("node_id").alias("cur"), F.col("cur").alias("_up"), F.col("path").alias("_path"),
                             F.col("depth").alias("_depth"))
        step = open_.join(above, "cur").select(
            "node_id", F.col("_up").alias("cur"), F.concat("_path", F.lit("/"), "path").alias("path"),
            (F.col("depth") + F.col("_depth")).alias("depth")).checkpoint()
        done = done.unionByName(step.where("cur is null"))
        state = step.unionByName(state.where("cur is null"))
    raise ValueError("the nodes' parents form a cycle")


def attribute_requests(supplier: DataFrame, part: DataFrame) -> DataFrame:
    """Attribute filters: each supplier asks for the (type, size) of one part."""
    every = part.agg(F.max("p_partkey")).first()[0] or 0   # one number: keys are drawn from all parts
    j = supplier.join(part, (supplier.s_suppkey * 7) % (every + 1) == part.p_partkey, "inner")
    return j.select(F.col("s_suppkey").alias("query_id"), F.col("p_type").alias("want_type"),
                    F.col("p_size").alias("want_size"))


def attribute_filter(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    """Q6: products whose JSON attributes contain every requested pair — the
    pairs are read out of the JSON once and matched by an equi-join, whose result
    is dealt by its own size (``expand``)."""
    attrs = catalog.select("barcode", F.get_json_object("attributes", "$.type").alias("want_type"),
                           F.get_json_object("attributes", "$.size").cast("int").alias("want_size"))
    return expand(attrs, requests, ["want_type", "want_size"]).select("query_id", "barcode")


def catalog_by_aisle_category(catalog: DataFrame) -> DataFrame:
    """Q8: stock and rfid counts per aisle and category (two-phase aggregate)."""
    return catalog.groupBy("aisle_number", "category").agg(
        F.count(F.lit(1)).alias("products"), F.sum("stock_quantity").cast("bigint").alias("stock"),
        F.count_if(F.col("rfid_security_required")).alias("rfid_products"))
