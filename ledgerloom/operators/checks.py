"""Validators of parameters and messages, decoding of store pairs, retention and transaction search."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.denoms import Denoms
from ..functions.encoding import bech32_decode

# What the first byte of a state key stands for.
STATE_KINDS = {1: "external_contract", 2: "auto_contract", 3: "reverse_denom", 4: "permissions", 5: "block_list"}


def is_bech32(text: Column, prefix: str | None = None) -> Column:
    """Whether a text is a bech32 address (with a prefix); null is none."""

    def test(s: pd.Series) -> pd.Series:
        found = [bech32_decode(t) if t else None for t in s]
        return pd.Series([bool(f and f[1] and (prefix is None or f[0] == prefix)) for f in found])

    return F.pandas_udf(test, "boolean")(text)


def is_uint64(text: Column) -> Column:
    return F.coalesce(text.rlike("^[0-9]{1,20}$") & (text.try_cast("decimal(20,0)") <= F.lit(str(2**64 - 1)).cast("decimal(20,0)")), F.lit(False))


def is_bool(text: Column) -> Column:
    return F.coalesce(text.isin("true", "false"), F.lit(False))


def coins_are_valid(coins: Column) -> Column:
    """At least one coin, all amounts positive, denominations rising."""
    names = F.transform(coins, lambda c: c["denom"])
    rising = F.size(F.array_distinct(names)) == F.size(names)
    return F.coalesce((F.size(coins) > 0) & F.forall(coins, lambda c: c["amount"] > 0) & rising & (F.array_sort(names) == names), F.lit(False))


def parameter_errors(params: DataFrame, denoms: Denoms) -> DataFrame:
    """(name, value, error) of (name, value) rows that a parameter set must not have."""
    name, value = F.col("name"), F.col("value")
    fine = (
        F.when(name == "ibc_denom", (value == "") | denoms.is_ibc(value))
        .when(name.isin("ibc_timeout", "max_callback_gas"), is_uint64(value) & (value != "0"))
        .when(name == "enable_auto_deployment", is_bool(value))
        .when(name == "admin", (value == "") | is_bech32(value))
        .otherwise(F.lit(False))
    )
    return params.withColumn("error", F.when(~F.coalesce(fine, F.lit(False)), F.concat(F.lit("invalid "), name))).where("error is not null")


def message_errors(messages: DataFrame, prefix: str) -> DataFrame:
    """(id, error) of conversion messages (id, address, coins): a bad address, or coins that are not valid."""
    error = F.when(~is_bech32(F.col("address"), prefix), "invalid address").when(~coins_are_valid(F.col("coins")), "invalid coins")
    return messages.select("id", error.alias("error")).where("error is not null")


def decode_pairs(pairs: DataFrame) -> DataFrame:
    """State pairs for display, by the first byte of their key."""
    first = F.conv(F.hex(F.substring("key", 1, 1)), 16, 10).cast("int")
    kinds = F.create_map(*[F.lit(x) for pair in STATE_KINDS.items() for x in pair])
    kind = F.coalesce(F.try_element_at(kinds, first), F.lit("unknown"))
    rest = F.expr("substring(key, 2)")
    shown = lambda c: F.concat(F.lit("0x"), F.lower(F.hex(c)))
    as_text = kind.isin("external_contract", "auto_contract")
    return pairs.select("key", "value", kind.alias("kind"), F.when(as_text, F.decode(rest, "UTF-8")).otherwise(shown(rest)).alias("name"), F.when(kind == "reverse_denom", F.decode("value", "UTF-8")).otherwise(shown(F.col("value"))).alias("shown"))


def prune(versions: DataFrame, keep: int, keys: list[str], order: str = "version") -> DataFrame:
    """Retention: the versions of the last ``keep`` heights, and of older ones the last per key, which is still in force."""
    from pyspark.sql import Window

    newest = versions.agg(F.max(order).alias("_top"))
    later = F.lead(order).over(Window.partitionBy(*keys).orderBy(order))
    marked = versions.withColumn("_later", later).join(F.broadcast(newest))
    return marked.where((F.col(order) > F.col("_top") - keep) | F.col("_later").isNull() | (F.col("_later") > F.col("_top") - keep)).drop("_later", "_top")


def search_txs(txs: DataFrame, predicate: Column, *, page: int = 1, per_page: int = 30, descending: bool = False) -> DataFrame:
    """A page of matching transactions by (height, index)."""
    order = [F.desc("height"), F.desc("index")] if descending else [F.asc("height"), F.asc("index")]
    return txs.where(predicate).orderBy(*order).offset((page - 1) * per_page).limit(per_page)
