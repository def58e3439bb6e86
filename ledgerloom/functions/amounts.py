"""Whole-number arithmetic on amounts, gas and times. Never doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(38,0)"
SCALE = 10**10  # between 8 and 18 decimals
COINS = "array<struct<denom:string,amount:decimal(38,0)>>"


def amount(value) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast(AMOUNT)


def scale_up(c: Column) -> Column:
    """8 to 18 decimals."""
    return (amount(c) * F.lit(SCALE).cast("decimal(11,0)")).cast(AMOUNT)


def remainder(c: Column) -> Column:
    """What is too small for 8 decimals."""
    return (amount(c) % F.lit(SCALE).cast("decimal(11,0)")).cast(AMOUNT)


def scale_down(c: Column) -> Column:
    """18 to 8 decimals, rounded down."""
    return F.floor((amount(c) - remainder(c)) / F.lit(SCALE).cast("decimal(11,0)")).cast(AMOUNT)


def burnable(c: Column) -> Column:
    """The part of an 18-decimal amount that has 8 decimals; null where that is nothing."""
    whole = (amount(c) - remainder(c)).cast(AMOUNT)
    return F.when(whole != 0, whole)


def parse_coins(text: Column) -> Column:
    """``10a,5b`` as coins, sorted by denomination with equal ones added; null where it is none."""
    parts = F.transform(F.split(text, ","), lambda p: F.trim(p))
    good = F.forall(parts, lambda p: p.rlike(r"^[0-9]{1,38}\s*[a-zA-Z][a-zA-Z0-9/:._-]{2,127}$"))
    coins = F.transform(parts, lambda p: F.struct(F.regexp_extract(p, r"^[0-9]+\s*(.*)$", 1).alias("denom"), F.regexp_extract(p, "^[0-9]+", 0).cast(AMOUNT).alias("amount")))
    return F.when(F.trim(text) == "", F.array().cast(COINS)).when(good, merge_coins(coins))


def merge_coins(coins: Column) -> Column:
    """Coin set: sorted by denomination, equal denominations added, zero amounts dropped."""
    names = F.array_sort(F.array_distinct(F.transform(coins, lambda c: c["denom"])))
    total = lambda name: F.aggregate(F.filter(coins, lambda c: c["denom"] == name), F.lit(0).cast(AMOUNT), lambda s, c: (s + c["amount"]).cast(AMOUNT))
    return F.filter(F.transform(names, lambda n: F.struct(n.alias("denom"), total(n).alias("amount"))), lambda c: c["amount"] != 0)


def parse_amount(text: Column) -> tuple[Column, Column]:
    """(coins, whole number): the coins if the text is a coin list, else the number, else both null."""
    coins = parse_coins(text)
    return coins, F.when(coins.isNull() & text.rlike(r"^[+-]?[0-9]{1,38}$"), text.try_cast(AMOUNT))


# ------------------------------------------------------------------ gas

# Gas by relayer method; other methods cost 100000.
RELAYER_GAS = {
    "createClient": 117462, "updateClient": 111894, "upgradeClient": 400000, "connectionOpenInit": 19755, "connectionOpenTry": 38468,
    "connectionOpenAck": 29603, "connectionOpenConfirm": 12865, "channelOpenInit": 68701, "channelOpenTry": 70562, "channelOpenAck": 22127,
    "channelOpenConfirm": 21190, "channelCloseConfirm": 31199, "recvPacket": 144025, "acknowledgement": 61781, "timeout": 104283,
    "registerPayee": 38000, "registerCounterpartyPayee": 37000,
}
DEFAULT_GAS = 100000


def relayer_gas(method: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in RELAYER_GAS.items() for x in pair])
    return F.coalesce(F.try_element_at(table, method), F.lit(DEFAULT_GAS))


def required_gas(method_gas: Column, input_bytes: Column, per_byte: int, intrinsic: Column | int = 0) -> Column:
    """Method gas and input cost less the intrinsic gas, at least 0; an unknown method costs its input only."""
    total = F.coalesce(method_gas, F.lit(0)) + input_bytes * per_byte
    return F.greatest(F.lit(0).cast("bigint"), (total - intrinsic).cast("bigint"))


def refund(gas_limit: Column, gas_used: Column) -> Column:
    return gas_limit - gas_used


def bumped(old: Column, new: Column, percent: int) -> Column:
    """Whether a replacement pays enough: at least the old priority plus ``percent``, by whole-number division."""
    scaled = old.cast("decimal(20,0)") * (100 + percent)
    return new >= F.floor(scaled / 100)


def context_height(n: Column) -> Column:
    """The state that a block ran on: its predecessor's, at least 1."""
    return F.greatest(n - 1, F.lit(1).cast("bigint"))


# ------------------------------------------------------------------ time


def timeout_ns(block_time_ns: Column, after_ns: int = 86_400_000_000_000) -> Column:
    return block_time_ns + F.lit(after_ns).cast("bigint")


def iso_time(text: Column) -> Column:
    return F.to_timestamp(text)


def hex_epoch_time(text: Column) -> Column:
    """Timestamp of hex seconds such as ``0x5f5e100``."""
    return F.timestamp_seconds(F.conv(F.regexp_replace(text, "^0[xX]", ""), 16, 10).cast("bigint"))


def seconds_between(a: Column, b: Column) -> Column:
    return (F.unix_micros(b) - F.unix_micros(a)) / 1_000_000


# ------------------------------------------------------------------ splitting


def even_split(total: int, parts: int) -> list[tuple[int, int]]:
    """Ranges that cover 0..total, the first ones longer by one."""
    size, more = divmod(total, parts)
    edges = [i * size + min(i, more) for i in range(parts + 1)]
    return list(zip(edges, edges[1:]))


def batches(total: int, size: int) -> list[tuple[int, int]]:
    size = max(1, size)
    return [(a, min(a + size, total)) for a in range(0, total, size)]
