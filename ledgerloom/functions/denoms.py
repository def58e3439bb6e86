"""Names: snake case, denominations, contracts and channels."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def snake_case(name: Column) -> Column:
    """``_`` before every A-Z but the first character, then lower case."""
    return F.lower(F.regexp_replace(name, "(?<!^)([A-Z])", "_$1"))


def snake(name: str) -> str:
    return "".join("_" + c if i and "A" <= c <= "Z" else c for i, c in enumerate(name)).lower()


@dataclass(frozen=True)
class Denoms:
    """Prefixes of the coin kinds of a chain; ``chain`` is the chain's own name in its denominations."""

    chain: str
    ibc: str = "ibc/"
    bridge: str = "gravity0x"

    @property
    def source(self) -> str:
        return f"{self.chain}0x"

    def is_ibc(self, denom: Column) -> Column:
        """Prefix and length only; the digits are not looked at."""
        return (F.length(denom) == len(self.ibc) + 64) & denom.startswith(self.ibc)

    def is_bridge(self, denom: Column) -> Column:
        return (F.length(denom) == len(self.bridge) + 40) & denom.startswith(self.bridge)

    def is_source(self, denom: Column) -> Column:
        return (F.length(denom) == len(self.source) + 40) & denom.startswith(self.source)

    def is_valid(self, denom: Column) -> Column:
        return self.is_ibc(denom) | self.is_bridge(denom) | self.is_source(denom)

    def contract(self, denom: Column) -> Column:
        """Hex address in a bridge or source denomination (from its ``0x`` on); null where it is none."""
        cut = F.when(denom.startswith(self.bridge), F.substr(denom, F.lit(len(self.bridge) - 1))).when(denom.startswith(self.source), F.substr(denom, F.lit(len(self.source) - 1)))
        return F.when(cut.rlike("^0[xX][0-9a-fA-F]{40}$"), cut)


def display_symbol(symbol: Column) -> Column:
    return F.lower(symbol)


def channel_name(number: Column) -> Column:
    return F.concat(F.lit("channel-"), number.cast("string"))


def evm_denom(prefix: str, contract: Column) -> Column:
    """Denomination of a contract's coins in the bank module."""
    return F.concat(F.lit(prefix), F.lit("0x"), F.hex(contract))
