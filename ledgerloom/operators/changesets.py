"""Change sets of versioned stores: dump, verify, build and restore; snapshots, retention and status.

A change set is rows (version, store, position, deleted, key, value): what each version did, in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .lookups import fold_changes

ORDER = ["version", "position"]


def dump(states: DataFrame) -> DataFrame:
    """Change sets of a table that has every key's value at each version it was written (version, store, key, value).

    A null value is a deletion. Writing the value that is there already changes nothing; positions follow the keys.
    """
    w = Window.partitionBy("store", "key").orderBy("version")
    before = F.lag("value").over(w)
    changed = states.withColumn("_before", before).where(~F.col("value").eqNullSafe(F.col("_before")))
    place = F.row_number().over(Window.partitionBy("version", "store").orderBy("key")) - 1
    return changed.select("version", "store", place.alias("position"), F.col("value").isNull().alias("deleted"), "key", "value")


def build(changes: DataFrame, version: int | None = None) -> DataFrame:
    """(store, key, value): the state that change sets come to, at a version or at their end."""
    rows = changes if version is None else changes.where(F.col("version") <= version)
    return fold_changes(rows, ["store", "key"], ORDER).select("store", "key", "value")


def store_digest(state: DataFrame) -> DataFrame:
    """(store, n, digest): an order-free digest of a store's rows, summed before the shuffle.

    Each row's SHA-256 is cut into four numbers that are added up; no task sees a store's rows together.
    """
    row = F.sha2(F.concat(F.sha2("key", 256), F.lit("/"), F.sha2(F.coalesce(F.col("value"), F.lit(b"")), 256)), 256)
    parts = [F.sum(F.conv(F.substring(row, 8 * i + 1, 8), 16, 10).cast("decimal(20,0)")).cast("string") for i in range(8)]
    return state.groupBy("store").agg(F.count("*").alias("n"), F.sha2(F.concat_ws(",", *parts), 256).alias("digest"))


def verify(changes: DataFrame, state: DataFrame, version: int | None = None) -> DataFrame:
    """(store, built, found, same): whether change sets come to a given state, store by store."""
    built = store_digest(build(changes, version)).select("store", F.col("n").alias("built"), F.col("digest").alias("a"))
    found = store_digest(state).select("store", F.col("n").alias("found"), F.col("digest").alias("b"))
    met = built.join(found, "store", "full_outer")
    return met.select("store", F.coalesce("built", F.lit(0)).alias("built"), F.coalesce("found", F.lit(0)).alias("found"), F.coalesce(F.col("a") == F.col("b"), F.lit(False)).alias("same"))


def restore(spark: SparkSession, changes: DataFrame, path: str, version: int | None = None) -> DataFrame:
    """Write the state of a version as a store partitioned by name, and read it back."""
    built = build(changes, version)
    built.write.mode("overwrite").partitionBy("store").parquet(path)
    return spark.read.schema("key binary, value binary, store string").parquet(path).select(*built.columns)


def snapshot(state: DataFrame, path: str, version: int, chunks: int = 16) -> DataFrame:
    """Write a state in chunks by the digest of its keys; returns the manifest (version, chunk, n, digest)."""
    chunked = state.withColumn("chunk", F.pmod(F.xxhash64("store", "key"), F.lit(chunks)).cast("int"))
    chunked.write.mode("overwrite").partitionBy("chunk").parquet(path)
    sums = store_digest(chunked.select(F.col("chunk").cast("string").alias("store"), "key", "value"))
    return sums.select(F.lit(version).cast("long").alias("version"), F.col("store").cast("int").alias("chunk"), "n", "digest")


def status(blocks: DataFrame) -> DataFrame:
    """One row: the earliest and the latest height and time that a node has, and how many heights are missing between."""
    ends = blocks.agg(F.min("height").alias("earliest"), F.max("height").alias("latest"), F.min("ts").alias("earliest_ts"), F.max("ts").alias("latest_ts"), F.count_distinct("height").alias("n"))
    return ends.select("earliest", "latest", "earliest_ts", "latest_ts", (F.col("latest") - F.col("earliest") + 1 - F.col("n")).alias("missing"))
