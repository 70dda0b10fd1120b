"""Schema and data-quality rules derived from the declared DDL: unique keys,
foreign keys, domains, fixed-width text, optimistic versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.operators.scan import materialize
from basketry.schemas import DOMAINS, FOREIGN_KEYS, ROW_KEYS, UNIQUE_KEYS


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _row_key(table: str) -> Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in ROW_KEYS.get(table, ["id"])])


def unique_violations(tables: dict[str, DataFrame], keys: dict[str, dict[str, list[str]]] = UNIQUE_KEYS) -> DataFrame:
    """Q1: values that occur more than once under a declared unique key.

    Each row is expanded to its (constraint, key) pairs, so all keys of a table
    take one scan, and all tables one exchange of partial counts. As in SQL, a
    key with a null in it equals nothing."""
    parts = []
    for table, named in keys.items():
        pairs = []
        for name, cols in named.items():
            whole = F.lit(True)
            for c in cols:
                whole = whole & F.col(c).isNotNull()
            pairs.append(F.when(whole, F.struct(F.lit(name).alias("constraint_name"), F.array(*[F.col(c).cast("string") for c in cols]).alias("key"))))
        parts.append(tables[table].select(F.explode(F.array(*pairs)).alias("p")).where("p is not null").select("p.constraint_name", "p.key"))
    g = _union(parts).groupBy("constraint_name", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return g.select("constraint_name", F.concat_ws("|", "key").alias("key_value"), "n")


def fk_orphans(tables: dict[str, DataFrame], fks=FOREIGN_KEYS) -> DataFrame:
    """Q2: child keys whose parent is missing, with their row counts.

    Every row names the keys it offers as a parent and those it refers to as a
    child; both sides of all foreign keys are counted together per referred key
    (combined on the map side), so each table is scanned once and a hot key is
    one row per map task. Null references are no orphans."""
    parts = []
    for table, df in tables.items():
        offers = sorted({(p, pc) for _, _, p, pc, _ in fks if p == table})
        refers = [(c, p, pc) for t, c, p, pc, _ in fks if t == table]
        pairs = [F.struct(F.lit(f"{p}.{pc}").alias("ref"), F.lit(None).cast("string").alias("fk_name"), F.col(pc).cast("string").alias("key")) for p, pc in offers]
        pairs += [F.struct(F.lit(f"{p}.{pc}").alias("ref"), F.lit(f"{table}.{c}").alias("fk_name"), F.col(c).cast("string").alias("key")) for c, p, pc in refers]
        if pairs:
            parts.append(df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").where("key is not null"))
    counted = _union(parts).groupBy("ref", "key", "fk_name").agg(F.count(F.lit(1)).alias("n"))
    keys = counted.groupBy("ref", "key").agg(F.max(F.col("fk_name").isNull()).alias("_held"),
                                             F.collect_list(F.struct("fk_name", "n")).alias("_by"))  # one per foreign key
    return (keys.where("not _held").select("key", F.explode("_by").alias("b"))
            .select("b.fk_name", F.col("key").alias("child_key"), F.col("b.n").alias("n_rows")))


def domain_violations(tables: dict[str, DataFrame], domains: dict = DOMAINS) -> DataFrame:
    """Q3: NOT NULL, length, allowed-value and range rules of every table, as one
    projection per table turned into long form (table, row key, rule)."""
    parts = []
    for table, columns in domains.items():
        rules = []
        for c, (required, longest, allowed, least) in columns.items():
            col = F.col(c)
            if required:
                rules.append((f"{c}_not_null", col.isNull()))
            if longest:
                rules.append((f"{c}_len_{longest}", F.char_length(col) > longest))
            if allowed:
                rules.append((f"{c}_enum", ~col.isin(*allowed)))
            if least is not None:
                rules.append((f"{c}_range", col < least))
        failed = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules]))
        parts.append(tables[table].select(F.lit(table).alias("table_name"), _row_key(table).alias("row_key"), F.explode(failed).alias("rule")))
    return _union(parts)


def cascade(tables: dict[str, DataFrame], deleted: dict[str, DataFrame], fks=FOREIGN_KEYS) -> DataFrame:
    """(table_name, row_key) of every row that goes when rows are deleted, along
    the foreign keys that delete children with their parents, to the fixpoint.

    ``deleted``: of some tables, the values of ``id`` to delete. Each round
    follows the rows found in the round before; a chain of any length ends, a
    cycle too. Keys without rows in the graph cost nothing."""
    edges = [f for f in fks if f[4]]
    names = {t for f in edges for t in (f[0], f[2])} | set(deleted)
    rows = {}
    for t in sorted(names & set(tables)):
        used = sorted({f[1] for f in edges if f[0] == t} | {f[3] for f in edges if f[2] == t} | ({"id"} if t in deleted else set()))
        rows[t] = materialize(tables[t].select(*used, _row_key(t).alias("row_key")).withColumn("_row", F.monotonically_increasing_id()))
    front = {t: rows[t].join(ids.select("id").distinct(), "id", "left_semi") for t, ids in deleted.items()}
    gone: dict[str, list[DataFrame]] = {t: [] for t in rows}
    while front:
        new: dict[str, list[DataFrame]] = {}
        for t, found in front.items():
            gone[t].append(found)
            for child, col, parent, pcol, _ in edges:
                if parent == t and child in rows:
                    keys = found.select(F.col(pcol).alias("_key")).distinct()
                    new.setdefault(child, []).append(rows[child].join(keys, F.col(col) == F.col("_key"), "left_semi"))
        front = {}
        for t, found in new.items():
            fresh = _union(found).dropDuplicates(["_row"])
            if gone[t]:
                fresh = fresh.join(_union(gone[t]).select("_row"), "_row", "left_anti")
            fresh = materialize(fresh)
            if not fresh.isEmpty():
                front[t] = fresh
    return _union([g.select(F.lit(t).alias("table_name"), "row_key") for t, found in gone.items() for g in found])


def schema_evolve(landed: DataFrame) -> DataFrame:
    """Q4: fixed-width text read as variable text: padding stripped (CHAR(3)
    currency, CHAR(1) grade, CHAR(25) category as landed), blank grades null."""
    grade = F.rtrim("nutriscore_grade")
    return landed.select("barcode", F.rtrim("currency_code").alias("currency_code"),
                         F.when(grade != "", grade).alias("nutriscore_grade"), F.rtrim("category").alias("category"))


def latest_version(writes: DataFrame) -> DataFrame:
    """The current row of each key is its highest version (ties: writer);
    two writers producing the same version from one base are a conflict.
    Both are grouped aggregates (no per-key window)."""
    cur = writes.groupBy("barcode").agg(F.max(F.struct("version", "writer", "price")).alias("_c"))
    conf = (writes.groupBy("barcode", "version").agg(F.count(F.lit(1)).alias("w"))
                  .where(F.col("w") > 1).groupBy("barcode").agg(F.count(F.lit(1)).alias("conflicts")))
    return (cur.join(conf, "barcode", "left")
               .select("barcode", F.col("_c.version").alias("current_version"),
                       F.col("_c.writer").alias("current_writer"), F.col("_c.price").alias("current_price"),
                       F.coalesce(F.col("conflicts"), F.lit(0)).alias("conflicts")))
