"""Height-filtered patches of a block store and a transaction index.

Both return the rows that a patch would write; writing is the caller's (``migrate.merge`` and a write), so a dry
run is the same plan without the write.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import proto
from ..functions.keys import ETH_TX, HASH_FAMILY, HEIGHT_FAMILIES, TX_HEIGHT, HeightSpec, block_key_height, eth_key_parts, has_binary_prefix, has_prefix, normal_hash, tx_key_height, tx_key_index
from .migrate import prefix_scan


@dataclass
class Patch:
    """Rows to write by ``family``, and the counters of a run."""

    rows: DataFrame
    total: DataFrame  # one row: keys that the height filter selects
    processed: DataFrame  # one row: keys that count as processed


def _keep(rows: DataFrame, target: DataFrame | None, policy: str) -> DataFrame:
    """Without rows whose key exists, under 'skip'."""
    return rows.join(target.select("key"), "key", "left_anti") if target is not None and policy == "skip" else rows


def patch_blocks(source: DataFrame, spec: HeightSpec, target: DataFrame | None = None, policy: str = "replace") -> Patch:
    """Keys of the selected heights, with the hash-index row of every header written.

    Hash-index rows come along unasked: they bypass the conflict policy and are not counted.
    """
    if spec.is_empty:
        raise ValueError("a patch needs heights")
    picked = prefix_scan(source, HEIGHT_FAMILIES).withColumn("height", block_key_height(F.col("key_text")))
    picked = picked.where(spec.column(F.col("height")))
    chosen = _keep(picked, target, policy)
    headers = chosen.where(F.col("key_text").startswith("H:")).select(proto.block_hash(F.col("value")).alias("hash")).where("hash is not null")
    wanted = headers.select(F.concat(F.lit(HASH_FAMILY.encode()), F.col("hash")).alias("key")).distinct()
    by_hash = source.where(has_binary_prefix(F.col("key"), HASH_FAMILY.encode())).join(wanted, "key", "left_semi")
    names = source.columns
    family = F.regexp_extract("key_text", "^([A-Z]+):", 1)
    rows = chosen.select(*names).withColumn("family", family).unionByName(by_hash.select(*names).withColumn("family", F.lit("BH")))
    return Patch(rows, picked.agg(F.count("*").alias("total")), chosen.agg(F.count("*").alias("processed")))


def eth_hash_of(events):
    """Normalised hash of the first ``ethereum_tx`` event that has an ``ethereumTxHash`` attribute."""
    named = F.filter(events, lambda e: (e["type"] == "ethereum_tx") & F.exists(e["attributes"], lambda a: a["key"] == "ethereumTxHash"))
    attr = F.filter(F.get(named, F.lit(0))["attributes"], lambda a: a["key"] == "ethereumTxHash")
    return normal_hash(F.get(attr, F.lit(0))["value"])


def patch_txs(source: DataFrame, spec: HeightSpec, target: DataFrame | None = None, policy: str = "replace", *, skip_checks: bool = False) -> Patch:
    """Three passes over a transaction index, as joins.

    The height index selects keys; what survives the policy leads to results by hash, and results to Ethereum event keys
    by (hash, height) and an index that starts with the transaction's: ``1`` finds ``1`` and ``10``. A key that pass 1 skips
    reaches neither other pass. 'ask' must have been decided before (see ``migrate.conflicts``). The total counts pass 1
    only, processed all three.
    """
    if spec.is_empty:
        raise ValueError("a patch needs heights")
    against = None if skip_checks else target
    picked = prefix_scan(source, [TX_HEIGHT]).withColumn("height", tx_key_height(F.col("key_text")))
    picked = picked.where(spec.column(F.col("height"))).withColumn("index", tx_key_index(F.col("key_text")))
    first = _keep(picked, against, policy)
    names = source.columns

    wanted = first.select(F.col("value").alias("key"), "height", "index").distinct()
    results = source.join(wanted.select("key").distinct(), "key", "left_semi")
    second = _keep(results, against, policy)

    decoded = results.withColumn("result", proto.decode_tx_result(F.col("value"))).select("key", eth_hash_of(F.col("result.events")).alias("eth_hash")).where("eth_hash is not null")
    # Transactions with one Ethereum hash: the last by height and index stands.
    txs = wanted.where("index is not null").join(decoded, "key").groupBy("eth_hash").agg(F.max(F.struct("height", "index")).alias("at")).select("eth_hash", "at.*")
    tx_hash, height, index = eth_key_parts(F.col("key_text"))
    events = source.where(has_prefix(F.col("key_text"), ETH_TX)).withColumn("e_hash", tx_hash).withColumn("e_height", height).withColumn("e_index", index)
    met = events.join(txs, (F.col("e_hash") == F.col("eth_hash")) & (F.col("e_height") == F.col("height")))
    third = _keep(met.where(F.col("e_index").startswith(F.col("index").cast("string"))).select(*names), against, policy)

    rows = first.select(*names).withColumn("family", F.lit("height")).unionByName(second.select(*names).withColumn("family", F.lit("result")))
    rows = rows.unionByName(third.withColumn("family", F.lit("eth_event")))
    return Patch(rows, picked.agg(F.count("*").alias("total")), rows.agg(F.count("*").alias("processed")))
