"""Key-value stores: scan, count, copy, verify, and merge by conflict policy.

A store is a DataFrame with ``key`` (binary), ``key_text`` (string) and ``value`` (binary); several databases
share a table through ``db``. A copy is a write; order is only asked for where it is observed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import HEIGHT_FAMILIES, TX_HEIGHT, HeightSpec, block_key_height, has_prefix, tx_key_height

POLICIES = ("skip", "replace", "replace_all", "ask")


# ------------------------------------------------------------------ scans


def scan(store: DataFrame, *, ordered: bool = False, descending: bool = False) -> DataFrame:
    """All rows; in byte order of the key only where that is asked for."""
    if not ordered:
        return store
    return store.orderBy(F.desc("key") if descending else F.asc("key"))


def prefix_scan(store: DataFrame, prefixes: list[str]) -> DataFrame:
    """Rows under any of the prefixes, as pushed-down text ranges; no prefixes is a full scan."""
    if not prefixes:
        return store
    return store.where(reduce(lambda a, b: a | b, (has_prefix(F.col("key_text"), p) for p in prefixes)))


def block_scan(store: DataFrame, spec: HeightSpec = HeightSpec()) -> DataFrame:
    """Block-store rows with a height; an empty spec scans everything."""
    if spec.is_empty:
        return store
    rows = prefix_scan(store, HEIGHT_FAMILIES).withColumn("height", block_key_height(F.col("key_text")))
    return rows.where(spec.column(F.col("height"))).drop("height")


def tx_scan(store: DataFrame, spec: HeightSpec = HeightSpec()) -> DataFrame:
    """Height-index rows of a transaction index; an empty spec scans everything."""
    if spec.is_empty:
        return store
    rows = prefix_scan(store, [TX_HEIGHT]).withColumn("height", tx_key_height(F.col("key_text")))
    return rows.where(spec.column(F.col("height"))).drop("height")


def includes(db: str, key_text: Column, spec: HeightSpec) -> Column:
    """Permissive test: keys without a height, and databases without heights, are included."""
    if db == "blockstore":
        return spec.column(block_key_height(key_text), missing=True)
    if db == "tx_index":
        return spec.column(tx_key_height(key_text), missing=True)
    return F.lit(True)


def get(store: DataFrame, key: bytes) -> DataFrame:
    """The row of one key, none if absent."""
    return store.where(F.col("key") == F.lit(key))


def get_many(store: DataFrame, keys: DataFrame, *, small: bool = False) -> DataFrame:
    """Rows of the given keys; absent ones are skipped. ``small`` says that the keys' number is bounded."""
    return store.join(F.broadcast(keys) if small else keys, "key", "left_semi")


# ------------------------------------------------------------------ copy and statistics


def copy(store: DataFrame, path: str, *, batch_size: int = 10_000, partition_by: tuple[str, ...] = ()) -> None:
    """Write a store as Parquet; the committer publishes the files at once or not at all."""
    writer = store.write.mode("overwrite").option("maxRecordsPerFile", batch_size * 100)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def progress(processed: Column, total: Column) -> Column:
    """Percent done; 0 where there is nothing to do."""
    return F.when(total == 0, F.lit(0.0)).otherwise(processed * 100.0 / total)


def total_stats(stats: DataFrame) -> DataFrame:
    """Sums over databases of (db, total, processed, errors), with a row per database and one for all."""
    return stats.groupBy("db").agg(*[F.sum(c).alias(c) for c in ("total", "processed", "errors")]).unionByName(
        stats.agg(*[F.sum(c).alias(c) for c in ("total", "processed", "errors")]).withColumn("db", F.lit("all"))
    )


def refused(rows: DataFrame) -> Column:
    """Rows that a store does not take: an empty key, or no value. A copy counts them and goes on."""
    return F.col("key").isNull() | (F.length("key") == 0) | F.col("value").isNull()


def copy_stats(store: DataFrame, *by: str) -> DataFrame:
    """(``by``, total, processed, errors) that copying a store comes to."""
    bad = F.count_if(refused(store))
    return store.groupBy(*by).agg(F.count("*").alias("total"), (F.count("*") - bad).alias("processed"), bad.alias("errors"))


def migrate(stores: dict[str, DataFrame], target: str, *, source_backend: str, target_backend: str, verify: bool = True) -> DataFrame:
    """Copy each database below ``target`` and verify it; (db, total, processed, errors, mismatches).

    Rows that the target would refuse are counted as errors and left out; they are not missed by the verification.
    """
    if source_backend == target_backend:
        raise ValueError("source and target backend are the same")
    spark = next(iter(stores.values())).sparkSession
    rows = []
    for db, store in stores.items():
        taken = store.where(~refused(store))
        copy(taken, f"{target}/{db}")
        counts = copy_stats(store).first()
        bad = verify_counts(taken, spark.read.parquet(f"{target}/{db}")).first()["mismatches"] if verify else 0
        rows.append((db, counts["total"], counts["processed"], counts["errors"], bad))
    return spark.createDataFrame(rows, "db string, total long, processed long, errors long, mismatches long")


# ------------------------------------------------------------------ verify


def compare(source: DataFrame, target: DataFrame, *, key: str = "key", value: str = "value") -> DataFrame:
    """(key, class): 'same', 'differs', 'missing' in the target or 'extra' there. One full outer join."""
    s = source.select(F.col(key).alias("key"), F.col(value).alias("sv"), F.lit(1).alias("s"))
    t = target.select(F.col(key).alias("key"), F.col(value).alias("tv"), F.lit(1).alias("t"))
    kind = F.when(F.col("t").isNull(), "missing").when(F.col("s").isNull(), "extra").when(F.col("sv").eqNullSafe(F.col("tv")), "same").otherwise("differs")
    return s.join(t, "key", "full_outer").select("key", kind.alias("class"))


def verify_counts(source: DataFrame, target: DataFrame, *, key: str = "key", value: str = "value") -> DataFrame:
    """One row: verified, missing, differing, extra, mismatches.

    A missing key is not verified, a differing one is. The final comparison of counts adds one mismatch
    when the target's keys and the verified keys differ in number, so one extra key counts twice.
    """
    classes = compare(source, target, key=key, value=value)
    n = lambda *names: F.coalesce(F.count_if(F.col("class").isin(*names)), F.lit(0)).cast("long")
    counts = classes.agg(n("same", "differs").alias("verified"), n("missing").alias("missing"), n("differs").alias("differing"), n("extra").alias("extra"))
    return counts.withColumn("mismatches", F.col("missing") + F.col("differing") + F.col("extra") + (F.col("extra") != 0).cast("long"))


def missing_keys(source: DataFrame, target: DataFrame) -> DataFrame:
    return source.join(target.select("key"), "key", "left_anti")


def store_diff(a: DataFrame, b: DataFrame, ignored: dict[str, list[bytes]] | None = None) -> DataFrame:
    """Rows of ``store, key`` whose values differ or that one side lacks; keys under ignored prefixes are left out."""
    left, right = a.select("store", "key", F.col("value").alias("a")), b.select("store", "key", F.col("value").alias("b"))
    out = left.join(right, ["store", "key"], "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
    for store, prefixes in (ignored or {}).items():
        for p in prefixes:
            out = out.where(~((F.col("store") == store) & F.col("key").startswith(F.lit(p))))
    return out


# ------------------------------------------------------------------ merge by policy


def conflicts(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source rows with whether their key exists in the target, and the target's value: what a person would decide on."""
    t = target.select("key", F.col("value").alias("target_value"), F.lit(True).alias("exists"))
    return source.join(t, "key", "left").withColumn("exists", F.coalesce("exists", F.lit(False)))


def merge(target: DataFrame, source: DataFrame, policy: str = "skip", decisions: DataFrame | None = None) -> DataFrame:
    """The target after the source's rows are merged in.

    'skip' keeps what exists, 'replace' and 'replace_all' overwrite it. 'ask' takes ``decisions`` (key, replace);
    keys without a decision are skipped. Rows must be unique by key within each side.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown policy: {policy!r}")
    names = [c for c in target.columns if c != "key"]
    s = source.select("key", F.struct(*names).alias("s"))
    t = target.select("key", F.struct(*names).alias("t"))
    both = t.join(s, "key", "full_outer")
    if policy == "ask":
        if decisions is None:
            raise ValueError("'ask' needs decisions")
        both = both.join(decisions.select("key", F.col("replace").alias("yes")), "key", "left")
        won = F.when(F.col("t").isNull() | (F.col("yes") & F.col("s").isNotNull()), F.col("s")).otherwise(F.col("t"))
    else:
        won = F.coalesce("t", "s") if policy == "skip" else F.coalesce("s", "t")
    return both.select("key", won.alias("w")).select("key", "w.*").select(*target.columns)


def drop_versions_after(rows: DataFrame, version: int) -> DataFrame:
    """Roll back: what was written after ``version`` goes."""
    return rows.where(F.col("version") <= version)
