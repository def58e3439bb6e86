"""Block lists: filtering proposals, accepting blocks, allow lists, digests, mempool rules and forks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def addresses_of(txs: DataFrame, *, id_cols: list[str]) -> DataFrame:
    """(ids, address) of every address a transaction names: signers, recipient, authorities and their targets."""
    named = F.concat(
        F.coalesce("signers", F.array().cast("array<string>")), F.array("to"),
        F.coalesce("authorities", F.array().cast("array<string>")), F.coalesce("targets", F.array().cast("array<string>")),
    )
    return txs.select(*id_cols, F.explode(F.array_distinct(named)).alias("address")).where("address is not null")


def invalid(txs: DataFrame, blocked: DataFrame, *, id_cols: list[str], small: bool = True) -> DataFrame:
    """Ids of transactions that name a blocked address. ``small``: the list is one that governance writes by hand."""
    right = blocked.select("address").distinct()
    return addresses_of(txs, id_cols=id_cols).join(F.broadcast(right) if small else right, "address", "left_semi").select(*id_cols).distinct()


def filter_proposal(txs: DataFrame, blocked: DataFrame, *, block: str = "block", position: str = "position") -> DataFrame:
    """Valid transactions of each proposal in their old order, numbered anew."""
    kept = txs.join(invalid(txs, blocked, id_cols=[block, position]), [block, position], "left_anti")
    return kept.withColumn("new_position", F.row_number().over(Window.partitionBy(block).orderBy(position)) - 1)


def accept_blocks(txs: DataFrame, blocked: DataFrame, *, block: str = "block", position: str = "position") -> DataFrame:
    """(block, accepted): one invalid transaction rejects the whole block."""
    bad = invalid(txs, blocked, id_cols=[block, position]).select(block).distinct().withColumn("bad", F.lit(True))
    return txs.select(block).distinct().join(bad, block, "left").select(block, F.col("bad").isNull().alias("accepted"))


def all_valid(rows: DataFrame, by: str, valid: Column) -> DataFrame:
    return rows.groupBy(by).agg(F.bool_and(valid).alias("all_valid"))


def members(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    return rows.join(keys.select(on).distinct(), on, "left_semi")


def non_members(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    return rows.join(keys.select(on).distinct(), on, "left_anti")


def except_allowed(blocked: DataFrame, allowed: DataFrame) -> DataFrame:
    """Block list without what must never be blocked."""
    return blocked.select("address").distinct().join(allowed.select("address"), "address", "left_anti")


def digest(rows: DataFrame, column: str, *by: str) -> DataFrame:
    """SHA-256 of the sorted, concatenated values: equal lists have equal digests in any order."""
    joined = F.array_join(F.array_sort(F.collect_list(F.col(column).cast("string"))), "")
    return rows.groupBy(*by).agg(F.sha2(joined, 256).alias("digest"), F.count("*").alias("n"))


class BlockListMemo:
    """The active list, refreshed per blob. An identical blob is not read again, a bad one leaves the old list active
    but is remembered, an empty one clears it, and without an identity nothing happens."""

    def __init__(self, spark, decode) -> None:
        self.spark, self.decode, self.blob = spark, decode, None
        self.active = spark.createDataFrame([], "address string")

    def refresh(self, blob: bytes | None, *, has_identity: bool = True) -> bool:
        """True if the list changed."""
        if not has_identity or blob == self.blob:
            return False
        self.blob = blob
        if not blob:
            self.active = self.spark.createDataFrame([], "address string")
            return True
        try:
            addresses = self.decode(blob)
        except ValueError:
            return False
        self.active = self.spark.createDataFrame([(a,) for a in addresses], "address string")
        return True


def replaces(old: Column, new: Column, percent: int) -> Column:
    """A pending transaction may be replaced by one that pays enough more (whole-number division)."""
    return new >= F.floor(old.cast("decimal(20,0)") * (100 + percent) / 100)


def mempool_order(txs: DataFrame, most: int | None = None) -> DataFrame:
    """Senders' transactions in nonce order, senders by the priority of what is next.

    A transaction waits for those of lower nonce, so its effective priority is the least up to it.
    """
    w = Window.partitionBy("sender").orderBy("nonce").rowsBetween(Window.unboundedPreceding, 0)
    ranked = txs.withColumn("effective", F.min("priority").over(w)).orderBy(F.desc("effective"), "sender", "nonce")
    return ranked.limit(most) if most else ranked


def fork_at(forks: DataFrame, height: int, chain_id: str) -> DataFrame:
    """The first fork of the chain at the height; ``forks`` has (position, height, chain_id, ...)."""
    return forks.where((F.col("height") == height) & (F.col("chain_id") == chain_id)).orderBy("position").limit(1)
