"""Keeper state: token mappings, keys, permissions and parameters; versions and change sets.

State is immutable here: an update returns the new table. Mappings are (denom, kind, contract) with kind
'external' or 'auto', and the reverse table is (contract, denom).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KINDS = ("external", "auto")


# ------------------------------------------------------------------ token mappings


def of_kind(mappings: DataFrame, kind: str) -> DataFrame:
    """Prefix iteration: all mappings of a kind."""
    return mappings.where(F.col("kind") == kind)


def show_mapping(mappings: DataFrame) -> DataFrame:
    return mappings.select("denom", F.concat(F.lit("0x"), F.lower(F.hex("contract"))).alias("contract"))


def contracts_of(rows: DataFrame, mappings: DataFrame, denom: str = "denom") -> DataFrame:
    """``rows`` with both contracts of their denomination and the preferred one (external before auto)."""
    kind = lambda k: of_kind(mappings, k).select(F.col("denom").alias(f"{k}_denom"), F.col("contract").alias(k))
    out = rows.join(kind("external"), F.col(denom) == F.col("external_denom"), "left").join(kind("auto"), F.col(denom) == F.col("auto_denom"), "left")
    return out.drop("external_denom", "auto_denom").withColumn("contract", F.coalesce("external", "auto"))


def contract_by_denom(rows: DataFrame, mappings: DataFrame, denom: str = "denom") -> DataFrame:
    """As the query of that name: a denomination with neither contract is an error."""
    out = contracts_of(rows, mappings, denom)
    return out.withColumn("contract", F.when(F.col("contract").isNull(), F.raise_error(F.concat(F.lit("no contract for "), F.col(denom)))).otherwise(F.col("contract")))


def denom_by_contract(rows: DataFrame, reverse: DataFrame, contract: str = "contract") -> DataFrame:
    """Reverse lookup, inner; it can be two to one after an external mapping came over an auto one."""
    return rows.join(reverse.select(F.col("contract").alias("_c"), F.col("denom").alias("found_denom")), F.col(contract) == F.col("_c")).drop("_c")


def set_external(mappings: DataFrame, reverse: DataFrame, denom: str, contract: bytes) -> tuple[DataFrame, DataFrame]:
    """Map a denomination to an external contract; a contract that is mapped already is an error.

    The reverse row of the denomination's previous external contract goes; that of an auto contract stays.
    """
    if not reverse.where(F.col("contract") == F.lit(contract)).isEmpty():
        raise ValueError("the contract is mapped already")
    spark = mappings.sparkSession
    old = mappings.where((F.col("denom") == denom) & (F.col("kind") == "external")).select("contract")
    new = spark.createDataFrame([(denom, "external", bytearray(contract))], "denom string, kind string, contract binary")
    kept = mappings.where(~((F.col("denom") == denom) & (F.col("kind") == "external")))
    back = reverse.join(old, "contract", "left_anti").select("contract", "denom")
    return kept.select("denom", "kind", "contract").union(new), back.union(new.select("contract", "denom"))


def set_auto(mappings: DataFrame, reverse: DataFrame, denom: str, contract: bytes) -> tuple[DataFrame, DataFrame]:
    """Map a denomination to an auto-deployed contract; not checked for uniqueness, the last one stands."""
    spark = mappings.sparkSession
    new = spark.createDataFrame([(denom, "auto", bytearray(contract))], "denom string, kind string, contract binary")
    kept = mappings.where(~((F.col("denom") == denom) & (F.col("kind") == "auto"))).select("denom", "kind", "contract")
    back = reverse.where(F.col("contract") != F.lit(contract)).select("contract", "denom")
    return kept.union(new), back.union(new.select("contract", "denom"))


def delete_external(mappings: DataFrame, reverse: DataFrame, denom: str) -> tuple[DataFrame, DataFrame]:
    """Drop both directions of an external mapping; False of nothing to drop shows as unchanged tables."""
    gone = mappings.where((F.col("denom") == denom) & (F.col("kind") == "external")).select("contract")
    return mappings.where(~((F.col("denom") == denom) & (F.col("kind") == "external"))), reverse.join(gone, "contract", "left_anti")


def update_mapping(mappings: DataFrame, reverse: DataFrame, denom: str, contract: bytes | None) -> tuple[DataFrame, DataFrame]:
    """By message or proposal: an empty contract deletes, another one registers or replaces."""
    return delete_external(mappings, reverse, denom) if not contract else set_external(mappings, reverse, denom, contract)


def channel_of_voucher(rows: DataFrame, traces: DataFrame, denom: str = "denom") -> DataFrame:
    """Source channel of ``ibc/<hash>`` by the first hop of its trace; other forms and unknown hashes are null.

    ``traces`` has (hash, trace) with trace an array of (port, channel).
    """
    parts = F.split(denom, "/")
    keyed = rows.withColumn("_hash", F.when((F.size(parts) == 2) & (parts[0] == "ibc"), F.upper(parts[1])))
    right = traces.select(F.upper("hash").alias("_hash"), F.get(F.col("trace"), F.lit(0))["channel"].alias("channel"))
    return keyed.join(right, "_hash", "left").drop("_hash")


# ------------------------------------------------------------------ keys and permissions


def keys_for(addresses: Column, request: DataFrame, keys: DataFrame, id_col: str = "request") -> DataFrame:
    """Keys of an ordered list of addresses: (id, position, address, key), duplicates kept, unknown as ''."""
    asked = request.select(id_col, F.posexplode(addresses).alias("position", "address"))
    return asked.join(keys.select("address", "key"), "address", "left").select(id_col, "position", "address", F.coalesce("key", F.lit("")).alias("key"))


def with_key_flag(validators: DataFrame, keys: DataFrame) -> DataFrame:
    """Bonded validators in descending power with their keys; those without are only flagged."""
    return validators.join(keys.select("address", "key"), "address", "left").withColumn("has_key", F.col("key").isNotNull()).orderBy(F.desc("power"), "address")


def has_permission(granted: Column, wanted: int) -> Column:
    """All wanted bits are granted; no bits are always granted."""
    return F.lit(True) if wanted == 0 else F.coalesce(granted.bitwiseAND(wanted) == wanted, F.lit(False))


def any_permission(accounts: DataFrame, permissions: DataFrame, wanted: int, admin: str, by: str = "request") -> DataFrame:
    """Whether any account of a request is the admin or holds all wanted bits."""
    held = accounts.join(permissions.select("address", "permissions"), "address", "left")
    allowed = has_permission(F.coalesce("permissions", F.lit(0).cast("bigint")), wanted) | (F.col("address") == admin)
    return held.groupBy(by).agg(F.bool_or(allowed).alias("allowed"))


# Permission bits.
CAN_CHANGE_MAPPING, CAN_TURN_BRIDGE = 1, 2


def show_permissions(granted: Column) -> tuple[Column, Column]:
    return has_permission(granted, CAN_CHANGE_MAPPING).alias("can_change_token_mapping"), has_permission(granted, CAN_TURN_BRIDGE).alias("can_turn_bridge")


def upsert(table: DataFrame, changes: DataFrame, key: str | list[str], order: str | None = None) -> DataFrame:
    """Last-wins: rows of ``changes`` replace rows of the same key; among changes the highest ``order`` stands."""
    keys = [key] if isinstance(key, str) else key
    if order:
        changes = latest(changes, keys, order).drop(order)
    return table.join(changes.select(*keys), keys, "left_anti").unionByName(changes.select(*table.columns))


def try_commit(table: DataFrame, step, problems) -> tuple[DataFrame, bool]:
    """``step(table)`` if ``problems(step(table))`` is empty, else the table as it was: a nested transaction."""
    new = step(table)
    return (new, True) if problems(new).isEmpty() else (table, False)


def fill_default(params: DataFrame, column: str, default: int) -> DataFrame:
    """Schema migration: an unset (0 or null) parameter gets its default."""
    return params.withColumn(column, F.when(F.coalesce(F.col(column), F.lit(0)) == 0, F.lit(default)).otherwise(F.col(column)))


# ------------------------------------------------------------------ versions and change sets


def latest(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the highest ``order`` per key, as one aggregation (combined before the shuffle)."""
    rest = [c for c in rows.columns if c not in keys]
    top = rows.groupBy(*keys).agg(F.max(F.struct(F.col(order).alias("_o"), *rest)).alias("_t"))
    return top.select(*keys, *[F.col(f"_t.{c}").alias(c) for c in rest]).select(*rows.columns)


def as_of(rows: DataFrame, keys: list[str], version: int, column: str = "version") -> DataFrame:
    """State at a version: the latest row at or below it."""
    return latest(rows.where(F.col(column) <= version), keys, column)


def explode_changes(wal: DataFrame) -> DataFrame:
    """(version, store, position, deleted, key, value) of change sets ``version, name, pairs``."""
    return wal.select("version", F.col("name").alias("store"), F.posexplode("pairs").alias("position", "pair")).select(
        "version", "store", "position", F.col("pair.delete").alias("deleted"), F.col("pair.key").alias("key"), F.col("pair.value").alias("value")
    )


def fold_changes(changes: DataFrame, keys: list[str], order: list[str], deleted: str = "deleted") -> DataFrame:
    """State after all changes: the last one per key, without deleted keys."""
    rest = [c for c in changes.columns if c not in keys]
    top = changes.groupBy(*keys).agg(F.max(F.struct(*order, *[c for c in rest if c not in order])).alias("_t"))
    return top.where(~F.col(f"_t.{deleted}")).select(*keys, *[F.col(f"_t.{c}").alias(c) for c in rest])


def apply_upgrades(state: DataFrame, upgrades: list[dict]) -> DataFrame:
    """Store upgrades in order: a deleted store goes, a renamed one takes its rows along, an added one is empty."""
    for u in upgrades:
        if u.get("delete"):
            state = state.where(F.col("store") != u["name"])
        elif u.get("rename_from"):
            state = state.withColumn("store", F.when(F.col("store") == u["rename_from"], u["name"]).otherwise(F.col("store")))
    return state


def running_state(changes: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Every version of every key with the version that ends it: a slowly changing dimension."""
    w = Window.partitionBy(*keys).orderBy(order)
    return changes.withColumn("valid_to", F.lead(order).over(w)).where(~F.col("deleted"))
