"""The analytical part of a node's JSON-RPC and query services, as functions on tables.

``blocks`` has (height, hash, ts, ...), ``txs`` (hash, block, block_hash, index, sender, nonce, ...), ``accounts`` and ``storage`` are
versioned rows. A block is given as a number, a hex quantity or a tag; 'latest' and 'pending' are the last block recorded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .events import LogFilter
from .lookups import as_of


def resolve(blocks: DataFrame, block: int | str = "latest") -> int:
    """Height that a number, hex quantity or tag means. One aggregated row reaches the driver."""
    if isinstance(block, int):
        return block
    if block in ("latest", "pending", "safe", "finalized"):
        found = blocks.agg(F.max("height")).first()[0]
    elif block == "earliest":
        found = blocks.agg(F.min("height")).first()[0]
    elif block.startswith("0x"):
        return int(block, 16)
    else:
        raise ValueError(f"not a block: {block!r}")
    if found is None:
        raise ValueError("no blocks")
    return found


def block_number(blocks: DataFrame) -> DataFrame:
    return blocks.agg(F.max("height").alias("height"))


def block(blocks: DataFrame, which: int | str | bytes = "latest") -> DataFrame:
    """By number, tag or hash."""
    if isinstance(which, bytes):
        return blocks.where(F.col("hash") == F.lit(which))
    return blocks.where(F.col("height") == resolve(blocks, which))


def account(accounts: DataFrame, blocks: DataFrame, address: str, at: int | str = "latest") -> DataFrame:
    """Balance, nonce and code of an address as of a block; no row for an address never seen."""
    return as_of(accounts.where(F.col("address") == address), ["address"], resolve(blocks, at))


def balance(accounts: DataFrame, blocks: DataFrame, address: str, at: int | str = "latest") -> DataFrame:
    """One row: the balance, 0 for an address never seen."""
    return account(accounts, blocks, address, at).agg(F.coalesce(F.max("balance"), F.lit(0)).alias("balance"))


def transaction_count(accounts: DataFrame, blocks: DataFrame, address: str, at: int | str = "latest") -> DataFrame:
    return account(accounts, blocks, address, at).agg(F.coalesce(F.max("nonce"), F.lit(0)).alias("nonce"))


def storage_at(storage: DataFrame, blocks: DataFrame, address: str, slot: bytes, at: int | str = "latest") -> DataFrame:
    """One row: the 32-byte value of a slot, zero where nothing was written."""
    rows = storage.where((F.col("address") == address) & (F.col("slot") == F.lit(slot)))
    return as_of(rows, ["address", "slot"], resolve(blocks, at)).agg(F.coalesce(F.max("value"), F.lit(bytes(32))).alias("value"))


def block_transaction_count(txs: DataFrame, blocks: DataFrame, which: int | str | bytes = "latest") -> DataFrame:
    return txs.join(F.broadcast(block(blocks, which).select(F.col("height").alias("block"))), "block", "left_semi").agg(F.count("*").alias("n"))


def transaction(txs: DataFrame, tx_hash: bytes) -> DataFrame:
    return txs.where(F.col("hash") == F.lit(tx_hash))


def transaction_in(txs: DataFrame, blocks: DataFrame, which: int | str | bytes, index: int) -> DataFrame:
    found = block(blocks, which).select(F.col("height").alias("block"))
    return txs.where(F.col("index") == index).join(F.broadcast(found), "block", "left_semi")


def block_receipts(receipts: DataFrame, blocks: DataFrame, which: int | str | bytes = "latest") -> DataFrame:
    found = block(blocks, which).select(F.col("height").alias("block_number"))
    return receipts.join(F.broadcast(found), "block_number", "left_semi").orderBy("transaction_index")


def logs(rows: DataFrame, blocks: DataFrame, wanted: LogFilter, cap: int = 10_000) -> DataFrame:
    """Logs of a filter; its bounds default to the latest block, and at most ``cap`` come back, as the method has it."""
    return wanted.apply(rows, cap, latest=resolve(blocks))


def pool_status(pool: DataFrame) -> DataFrame:
    """Pending and queued transactions: queued ones wait for a lower nonce of their sender (``next_nonce``)."""
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("sender").orderBy("nonce")) - 1
    return pool.withColumn("pending", F.col("nonce") == F.col("next_nonce") + rank).agg(F.count_if("pending").alias("pending"), F.count_if(~F.col("pending")).alias("queued"))


def pool_content(pool: DataFrame) -> DataFrame:
    """(sender, transactions by nonce): one account's queue is bounded by the pool's limit per sender."""
    listed = F.array_sort(F.collect_list(F.struct("nonce", "hash")))
    return pool.groupBy("sender").agg(F.map_from_entries(F.transform(listed, lambda x: F.struct(x["nonce"].cast("string").alias("key"), x["hash"].alias("value")))).alias("by_nonce"))


def code(accounts: DataFrame, blocks: DataFrame, address: str, at: int | str = "latest") -> DataFrame:
    """One row: the code at an address, empty where there is none."""
    return account(accounts, blocks, address, at).agg(F.coalesce(F.max("code"), F.lit(b"")).alias("code"))


def fee_history(blocks: DataFrame, count: int, newest: int | str = "latest", cap: int = 100) -> DataFrame:
    """(height, base_fee, gas_used_ratio) of the last ``count`` blocks up to ``newest``, at most ``cap``, oldest first.

    ``blocks`` has gas_used, gas_limit and base_fee; a block without a limit has ratio 0.
    """
    top = resolve(blocks, newest)
    ratio = F.when(F.col("gas_limit") > 0, F.col("gas_used") / F.col("gas_limit")).otherwise(F.lit(0.0))
    return blocks.where((F.col("height") <= top) & (F.col("height") > top - min(count, cap))).select("height", "base_fee", ratio.alias("gas_used_ratio")).orderBy("height")


def proven_values(accounts: DataFrame, storage: DataFrame, blocks: DataFrame, address: str, slots: list[bytes], at: int | str = "latest") -> DataFrame:
    """(slot, value, balance, nonce): what a proof of an account and its slots is about. The proof's nodes need the tree, which is not recorded."""
    height = resolve(blocks, at)
    held = as_of(storage.where((F.col("address") == address) & F.col("slot").isin(*slots)), ["address", "slot"], height)
    asked = blocks.sparkSession.range(1).select(F.explode(F.array(*[F.lit(s) for s in slots])).alias("slot"))
    owner = account(accounts, blocks, address, height).agg(F.coalesce(F.max("balance"), F.lit(0)).alias("balance"), F.coalesce(F.max("nonce"), F.lit(0)).alias("nonce"))
    return asked.join(held.select("slot", "value"), "slot", "left").select("slot", F.coalesce("value", F.lit(bytes(32))).alias("value")).join(F.broadcast(owner))


def trace(calls: DataFrame, tx_hash: bytes) -> DataFrame:
    """Recorded calls of a transaction (hash, position, depth, op, from, to, value, gas, error) in order; nothing is run again."""
    return calls.where(F.col("hash") == F.lit(tx_hash)).orderBy("position")
