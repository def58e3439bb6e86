"""Block receipts: pairing transactions with results, running gas, indexes and projections.

Messages have one row per message of a transaction:
``block, tx, msg, gas_used, code, log, failed, is_evm`` (``code`` and ``log`` are the transaction's, ``failed`` the message's).
Windows are partitioned by block, so a task holds one block at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: the text by which a failed transaction is known to have used up the block's gas.
OVER_LIMIT = "out of gas in location: block gas meter; gasWanted:"
DYNAMIC_FEE = 2


def over_limit(log: Column, text: str = OVER_LIMIT) -> Column:
    return F.coalesce(log.contains(text), F.lit(False))


def counts_in_block(code: Column, log: Column, text: str = OVER_LIMIT) -> Column:
    """A transaction is kept if it succeeded, or failed only by exceeding the block's gas limit."""
    return (code == 0) | over_limit(log, text)


def status(code: Column, failed: Column) -> Column:
    """1 for success, 0 for failure: the chain's codes are the other way round."""
    return F.when((code != 0) | F.coalesce(failed, F.lit(False)), 0).otherwise(1)


def _within_block(*order: str):
    return Window.partitionBy("block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def cumulative_gas(messages: DataFrame, text: str = OVER_LIMIT) -> DataFrame:
    """Receipts of EVM messages with the block's running gas.

    Excluded transactions add no gas; successful non-EVM ones add theirs but get no receipt. So rows are
    filtered before the window by what counts, and after it by what has a receipt.
    """
    kept = messages.where(counts_in_block(F.col("code"), F.col("log"), text))
    run = kept.withColumn("cumulative_gas_used", F.sum(F.when(F.col("is_evm") | (F.col("code") == 0), F.col("gas_used")).otherwise(0)).over(_within_block("tx", "msg")))
    index = F.sum(F.col("is_evm").cast("int")).over(_within_block("tx", "msg")) - 1
    return run.withColumn("tx_index", index.cast("long")).where("is_evm").withColumn("status", status(F.col("code"), F.col("failed")))


def replay_cumulative_gas(messages: DataFrame, text: str = OVER_LIMIT) -> DataFrame:
    """Replay's running gas: EVM messages only, others never add."""
    kept = messages.where(counts_in_block(F.col("code"), F.col("log"), text) & F.col("is_evm"))
    order = _within_block("tx", "msg")
    return (
        kept.withColumn("cumulative_gas_used", F.sum("gas_used").over(order))
        .withColumn("tx_index", (F.count("*").over(order) - 1).cast("long"))
        .withColumn("status", status(F.lit(0), F.col("failed")))
    )


def fix_last_receipt(receipts: DataFrame, exceeded: Column, gas_limit: Column) -> DataFrame:
    """Where the block exceeded its gas, its last receipt fails, uses its whole limit and adds the refund.

    A failed transaction has no logs and creates nothing: of the columns ``logs``, ``logs_bloom`` and
    ``contract_address`` those that there are become empty, the empty bloom and null.
    """
    backwards = Window.partitionBy("block").orderBy(F.desc("tx_index"))
    last = (F.row_number().over(backwards) == 1) & exceeded
    kinds = dict(receipts.dtypes)
    new = {"status": F.lit(0), "cumulative_gas_used": F.col("cumulative_gas_used") + gas_limit - F.col("gas_used"), "gas_used": gas_limit}
    emptied = {"logs": F.array(), "logs_bloom": F.lit(bytes(256)), "contract_address": F.lit(None)}
    new |= {c: v.cast(kinds[c]) for c, v in emptied.items() if c in kinds}
    marked = receipts.withColumn("is_last", last)
    return marked.select(*[F.when(F.col("is_last"), new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in receipts.columns])


def zip_results(blocks: DataFrame) -> DataFrame:
    """One row per transaction: ``txs`` and ``results`` are arrays that pair by position."""
    pairs = F.posexplode(F.arrays_zip("txs", "results")).alias("tx", "pair")
    return blocks.select(*[c for c in blocks.columns if c not in ("txs", "results")], pairs).select("*", F.col("pair.txs").alias("tx_data"), F.col("pair.results").alias("result")).drop("pair")


def pair_messages(txs: DataFrame, msgs: str = "msgs", outcomes: str = "outcomes") -> DataFrame:
    """One row per message with its outcome; differing counts are an error, not a silent loss."""
    checked = F.when(F.size(msgs) == F.size(outcomes), F.arrays_zip(msgs, outcomes)).otherwise(
        F.raise_error(F.concat(F.lit("message count differs from result count: "), F.size(msgs).cast("string"), F.lit(" and "), F.size(outcomes).cast("string")))
    )
    rest = [c for c in txs.columns if c not in (msgs, outcomes)]
    return txs.select(*rest, F.posexplode(checked).alias("msg", "pair")).select(*rest, "msg", F.col(f"pair.{msgs}").alias("message"), F.col(f"pair.{outcomes}").alias("outcome"))


def effective_gas_price(base_fee: Column, tip_cap: Column, fee_cap: Column) -> Column:
    """The public rule of dynamic fees: the base fee and the tip, at most the cap."""
    return F.least(fee_cap, base_fee + tip_cap)


def project_receipt(rows: DataFrame) -> DataFrame:
    """The receipt of an EVM message; conditional fields are null where they do not apply."""
    is_creation = F.col("to").isNull()
    return rows.select(
        F.col("status"), F.col("cumulative_gas_used"), F.coalesce("logs_bloom", F.lit(b"")).alias("logs_bloom"),
        F.coalesce("logs", F.array().cast("array<string>")).alias("logs"), F.col("transaction_hash"), F.col("gas_used"),
        F.col("block_hash"), F.col("block").alias("block_number"), F.col("tx_index").alias("transaction_index"), F.col("from"), F.col("to"), F.col("type"),
        F.when(is_creation, F.col("created")).alias("contract_address"),
        F.when(F.col("type") == DYNAMIC_FEE, effective_gas_price(F.col("base_fee"), F.col("tip_cap"), F.col("fee_cap"))).alias("effective_gas_price"),
    )


def hashes_by_block(txs: DataFrame) -> DataFrame:
    """(block, hashes): a block's transaction hashes in order; what a block holds is bounded by its gas."""
    return txs.groupBy("block").agg(F.transform(F.array_sort(F.collect_list(F.struct("tx", "hash"))), lambda x: x["hash"]).alias("hashes"))
