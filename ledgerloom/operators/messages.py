"""Module messages and what they do to keeper state; upgrades; generated operations for property tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .lookups import CAN_CHANGE_MAPPING, has_permission, latest

# Message kinds, and the kind of state each one sets (turning the bridge sets nothing).
SETS = {"update_params": "params", "update_permissions": "permissions", "store_block_list": "block_list", "update_token_mapping": "mapping", "register_key": "key", "turn_bridge": None}


def authorised(messages: DataFrame, permissions: DataFrame, *, authority: str, admin: str) -> DataFrame:
    """Messages (seq, kind, sender, key, value) with ``outcome``: 'ok', 'unauthorised' or 'unknown'.

    Parameters are the governance authority's to set, permissions and the block list the admin's (no one's, if there
    is no admin), a mapping takes its permission or the admin, a key is its owner's, and anyone may turn the bridge,
    which does nothing. ``permissions`` has (address, permissions) as of before the messages.
    """
    kind, sender = F.col("kind"), F.col("sender")
    held = messages.join(permissions.select(F.col("address").alias("sender"), "permissions"), "sender", "left")
    is_admin = (sender == admin) if admin else F.lit(False)
    may = (
        F.when(kind == "update_params", sender == authority).when(kind.isin("update_permissions", "store_block_list"), is_admin)
        .when(kind == "update_token_mapping", is_admin | has_permission(F.coalesce("permissions", F.lit(0).cast("bigint")), CAN_CHANGE_MAPPING))
        .when(kind == "register_key", sender == F.col("key")).when(kind == "turn_bridge", F.lit(True))
    )
    return held.select(*messages.columns, F.when(may.isNull(), "unknown").when(may, "ok").otherwise("unauthorised").alias("outcome"))


def apply_messages(state: DataFrame, judged: DataFrame) -> DataFrame:
    """State rows (kind, key, value) after the accepted messages in order; an empty mapping or block list is deleted."""
    kinds = F.create_map(*[F.lit(x) for pair in SETS.items() if pair[1] for x in pair])
    sets = judged.where("outcome = 'ok'").select(F.try_element_at(kinds, F.col("kind")).alias("kind"), "key", "value", "seq").where("kind is not null")
    last = latest(sets, ["kind", "key"], "seq").drop("seq")
    kept = state.join(last.select("kind", "key"), ["kind", "key"], "left_anti")
    gone = F.col("kind").isin("mapping", "block_list") & (F.coalesce("value", F.lit("")) == "")
    return kept.select("kind", "key", "value").union(last.where(~gone).select("kind", "key", "value"))


def preinstall(accounts: DataFrame, contracts: DataFrame) -> DataFrame:
    """Accounts (address, nonce, code) with contracts (address, code) that an upgrade puts there.

    An address that has code already is an error, as it is for the chain; one without code keeps its nonce.
    """
    new = contracts.select("address", F.col("code").alias("_new"))
    met = accounts.join(new, "address", "full_outer")
    taken = F.col("code").isNotNull() & F.col("_new").isNotNull() & (F.col("code") != F.col("_new"))
    code = F.when(taken, F.raise_error(F.concat(F.lit("there is code at "), F.lower(F.hex("address"))))).otherwise(F.coalesce("_new", "code"))
    return met.select("address", F.coalesce("nonce", F.lit(0).cast("bigint")).alias("nonce"), code.alias("code"))


def digest_of(seed: str, number: Column) -> Column:
    """Hex that looks random and is the same on every run."""
    return F.sha2(F.concat_ws("/", F.lit(seed), number.cast("string")), 256)


def mapping_updates(spark: SparkSession, n: int, *, seed: str, accounts: list[str], admin: str) -> DataFrame:
    """``n`` generated mapping updates (seq, kind, sender, key, value): half by the admin, else by any account; random denominations and contracts."""
    rows = spark.range(n).withColumnRenamed("id", "seq").withColumn("d", digest_of(seed, F.col("seq")))
    draw = F.conv(F.substring("d", 1, 8), 16, 10).cast("bigint")
    anyone = F.element_at(F.array(*[F.lit(a) for a in accounts]), (F.conv(F.substring("d", 9, 8), 16, 10).cast("bigint") % len(accounts) + 1).cast("int"))
    sender = F.when(draw % 2 == 0, F.lit(admin)).otherwise(anyone)
    return rows.select("seq", F.lit("update_token_mapping").alias("kind"), sender.alias("sender"), F.concat(F.lit("ibc/"), F.upper(F.sha2("d", 256))).alias("key"), F.concat(F.lit("0x"), F.substring("d", 17, 40)).alias("value"))
