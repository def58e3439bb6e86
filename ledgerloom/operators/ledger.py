"""Balances as signed entries: conversions, token contracts and supply.

An operation on coins becomes rows (address, denom, delta, seq); a balance is their sum, and an
operation is valid where no running balance falls below zero.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.amounts import AMOUNT, burnable, scale_down, scale_up
from ..functions.denoms import Denoms
from ..session import checkpointed

ENTRY = "seq long, address string, denom string, delta decimal(38,0)"
MODULE = "module"


def balances(entries: DataFrame, *by: str) -> DataFrame:
    """Sum per address and denomination (or ``by``), zero balances left out."""
    keys = by or ("address", "denom")
    return entries.groupBy(*keys).agg(F.sum("delta").cast(AMOUNT).alias("amount")).where("amount <> 0")


def supply(entries: DataFrame) -> DataFrame:
    return balances(entries, "denom")


def running(entries: DataFrame) -> DataFrame:
    """Entries with the balance after each; entries of one operation (``seq``) count together."""
    w = Window.partitionBy("address", "denom").orderBy("seq").rangeBetween(Window.unboundedPreceding, 0)
    return entries.withColumn("balance", F.sum("delta").over(w).cast(AMOUNT))


def overdrawn(entries: DataFrame) -> DataFrame:
    """Operations after which a balance is below zero; the module's own escrow is not checked."""
    return running(entries).where((F.col("balance") < 0) & (F.col("address") != MODULE)).select("seq").distinct()


def _entry(address, denom, delta) -> Column:
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(as_column(address).alias("address"), as_column(denom).alias("denom"), delta.cast(AMOUNT).alias("delta"))


def _entries(rows: DataFrame, moves: Column) -> DataFrame:
    return rows.select("seq", F.explode(moves).alias("e")).select("seq", "e.*").where("delta <> 0")


def native_to_token(address: Column, denom: Column, amount: Column, contract: Column, token: Column, denoms: Denoms) -> Column:
    """Native coins become contract tokens.

    A source coin is burnt and its tokens are released by the contract; another coin moves to the contract's
    address and tokens are minted. Tokens are kept under ``token``.
    """
    source = F.array(_entry(address, denom, -amount), _entry(contract, token, -amount), _entry(address, token, amount))
    other = F.array(_entry(address, denom, -amount), _entry(contract, denom, amount), _entry(address, token, amount))
    return F.when(denoms.is_source(denom), source).otherwise(other)


def token_to_native(address: Column, denom: Column, amount: Column, contract: Column, token: Column, denoms: Denoms) -> Column:
    """The other way: a source coin's tokens go to the contract and coins are minted; else coins come back and tokens are burnt."""
    source = F.array(_entry(address, token, -amount), _entry(contract, token, amount), _entry(address, denom, amount))
    other = F.array(_entry(contract, denom, -amount), _entry(address, denom, amount), _entry(address, token, -amount))
    return F.when(denoms.is_source(denom), source).otherwise(other)


def vouchers_to_evm(vouchers: DataFrame, *, base_denom: str, evm_denom: str, denoms: Denoms) -> tuple[DataFrame, DataFrame]:
    """(entries, rejected) of rows (seq, address, denom, amount, contract).

    The base voucher is escrowed and minted anew with 18 decimals; other coins become tokens of their contract.
    A denomination that is neither valid nor mapped is rejected.
    """
    base = F.col("denom") == base_denom
    good = base | (denoms.is_valid(F.col("denom")) & F.col("contract").isNotNull())
    minted = F.array(_entry(F.col("address"), F.col("denom"), -F.col("amount")), _entry(MODULE, F.col("denom"), F.col("amount")), _entry(F.col("address"), evm_denom, scale_up(F.col("amount"))))
    token = F.concat(F.lit("token/"), F.col("contract"))
    moved = native_to_token(F.col("address"), F.col("denom"), F.col("amount"), F.col("contract"), token, denoms)
    return _entries(vouchers.where(good), F.when(base, minted).otherwise(moved)), vouchers.where(~F.coalesce(good, F.lit(False)))


def transfer_out(coins: DataFrame, *, base_denom: str, evm_denom: str, denoms: Denoms) -> tuple[DataFrame, DataFrame]:
    """(entries, rejected) of IBC transfers of rows (seq, address, denom, amount).

    The EVM coin is burnt down to 8 decimals, its voucher leaves escrow and is sent; too small amounts do nothing.
    IBC vouchers and source coins are sent as they are; other denominations are rejected.
    """
    evm = F.col("denom") == evm_denom
    good = evm | denoms.is_ibc(F.col("denom")) | denoms.is_source(F.col("denom"))
    whole = F.coalesce(burnable(F.col("amount")), F.lit(0).cast(AMOUNT))
    burnt = F.array(_entry(F.col("address"), F.col("denom"), -whole), _entry(MODULE, base_denom, -scale_down(whole)), _entry("transfer", base_denom, scale_down(whole)))
    sent = F.array(_entry(F.col("address"), F.col("denom"), -F.col("amount")), _entry("transfer", F.col("denom"), F.col("amount")))
    return _entries(coins.where(good), F.when(evm, burnt).otherwise(sent)), coins.where(~F.coalesce(good, F.lit(False)))


def token_ledger(operations: DataFrame) -> DataFrame:
    """Entries of a token contract's operations (seq, op, token, sender, receiver, amount): mint, burn, transfer."""
    token, sender, receiver, amount = (F.col(c) for c in ("token", "sender", "receiver", "amount"))
    moves = (
        F.when(F.col("op") == "mint", F.array(_entry(receiver, token, amount)))
        .when(F.col("op") == "burn", F.array(_entry(sender, token, -amount)))
        .when(F.col("op") == "transfer", F.array(_entry(sender, token, -amount), _entry(receiver, token, amount)))
    )
    return _entries(operations.where(moves.isNotNull()), moves)


def _before(rows: DataFrame, value: Column, name: str, size: int) -> DataFrame:
    """Adds the sum of ``value`` over earlier operations of the same address and denomination.

    In two levels, so that one address with a third of all rows is many tasks: within ranges of ``size`` operations, and
    over the ranges' totals.
    """
    keys = ["address", "denom"]
    ranged = rows.withColumn("_range", F.floor(F.col("seq") / size)).withColumn("_value", value)
    totals = ranged.groupBy(*keys, "_range").agg(F.sum("_value").alias("_total"))
    earlier = F.sum("_total").over(Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.select(*[F.col(c).alias(f"_{c}") for c in keys], F.col("_range").alias("_of"), F.coalesce(earlier, F.lit(0)).alias("_base"))
    same = F.col("_address").eqNullSafe(F.col("address")) & F.col("_denom").eqNullSafe(F.col("denom")) & (F.col("_of") == F.col("_range"))
    within = Window.partitionBy(*keys, "_range").orderBy("seq").rangeBetween(Window.unboundedPreceding, -1)
    out = ranged.join(totals, same).withColumn(name, (F.col("_base") + F.coalesce(F.sum("_value").over(within), F.lit(0))).cast(AMOUNT))
    return out.drop("_range", "_value", "_address", "_denom", "_of", "_base")


def _integers(column) -> list:
    """Values of an Arrow decimal(38,0) column as integers, which are exact at any size; null stays None."""
    words = np.frombuffer(column.buffers()[1], np.int64)[2 * column.offset : 2 * (column.offset + len(column))].reshape(-1, 2)
    low, high = words[:, 0], words[:, 1]
    found = low.tolist() if (high == low >> 63).all() else [h * 2**64 + n for h, n in zip(high.tolist(), low.view(np.uint64).tolist())]
    if column.null_count:
        found = [n if v else None for n, v in zip(found, column.is_valid().to_pylist())]
    return found


def _names(column) -> list:
    """Values of an Arrow column in which few differ."""
    coded = column.dictionary_encode()
    names = [*coded.dictionary.to_pylist(), None]
    return [names[i] for i in coded.indices.fill_null(len(names) - 1).to_numpy().tolist()]


def _fold(batches):
    """Operations by token and order; of a token only the balances are kept, not its rows."""
    token, balance = object(), {}
    for batch in batches:
        column = {c: batch.column(c) for c in batch.schema.names}
        passed = []
        for op, of, sender, receiver, amount, base in zip(_names(column["op"]), _names(column["token"]), _names(column["sender"]), _names(column["receiver"]), _integers(column["amount"]), _integers(column["base"])):
            if of != token:
                token, balance = of, {}
            if base is None:
                raise OverflowError("a balance has more than 38 digits")
            fine = op == "mint" or base + balance.get(sender, 0) >= amount
            passed.append(fine)
            if fine and op != "mint":
                balance[sender] = balance.get(sender, 0) - amount
            if fine and op != "burn":
                balance[receiver] = balance.get(receiver, 0) + amount
        yield pa.RecordBatch.from_arrays([column["seq"], pa.array(passed, pa.bool_())], names=["seq", "accepted"])


def _in_order(moves: DataFrame) -> DataFrame:
    """(seq, accepted) by applying each token's operations in a row; ``base`` is what the sender has from operations that are not among them."""
    kind = moves.schema["seq"].dataType.simpleString()
    rows = moves.select("seq", "op", "token", "sender", "receiver", "amount", "base")
    return rows.repartition("token").sortWithinPartitions("token", "seq").mapInArrow(_fold, f"seq {kind}, accepted boolean")


def _by_bounds(moves: DataFrame, size: int) -> DataFrame:
    """(seq, accepted) without a task that holds a whole ledger.

    Whether an operation passes depends on those before it, so it is decided as soon as bounds do: it passes if the
    balance covers it even when all undecided debits pass and undecided credits do not, and fails if it is not covered
    the other way round. Each round decides at least the first undecided operation of every ledger. Where decisions
    depend on each other in a row a round decides few: the first that leaves more than half of the undecided is the
    last, and what is left is applied in order, on top of the balances that are decided. So rounds are at most as many
    as the logarithm of the operations, and only what depends on itself is left to one task.
    """
    debit = F.struct(F.col("sender").alias("address"), (-F.col("amount")).cast(AMOUNT).alias("delta"), F.lit(True).alias("debit"))
    credit = F.struct(F.col("receiver").alias("address"), F.col("amount").alias("delta"), F.lit(False).alias("debit"))
    parts = F.when(F.col("op") == "mint", F.array(credit)).when(F.col("op") == "burn", F.array(debit)).otherwise(F.array(debit, credit))
    entries = moves.select("seq", F.col("token").alias("denom"), F.explode(parts).alias("e")).select("seq", "denom", "e.*")
    needs = moves.where("op <> 'mint'").select("seq", F.col("amount").alias("need"))
    state = checkpointed(entries.join(needs, "seq", "left").withColumn("passes", F.when(F.col("need").isNull(), True).cast("boolean")))
    left = state.where("passes is null and debit").count()
    while left:
        sure, open_ = F.when(F.col("passes"), F.col("delta")).otherwise(F.lit(0)), F.col("passes").isNull()
        low = sure + F.when(open_ & (F.col("delta") < 0), F.col("delta")).otherwise(F.lit(0))
        high = sure + F.when(open_ & (F.col("delta") > 0), F.col("delta")).otherwise(F.lit(0))
        bounds = _before(_before(state, low, "low", size), high, "high", size)
        decided = bounds.where("passes is null and debit").select("seq", F.when(F.col("low") >= F.col("need"), True).when(F.col("high") < F.col("need"), False).alias("now")).where("now is not null")
        state = checkpointed(state.join(decided, "seq", "left").withColumn("passes", F.coalesce("passes", "now")).drop("now"))
        before, left = left, state.where("passes is null and debit").count()
        if 2 * left > before:
            break
    passed = state.where("passes is not null").groupBy("seq").agg(F.bool_and("passes").alias("accepted"))
    if left:
        based = _before(state, F.when(F.col("passes"), F.col("delta")).otherwise(F.lit(0)), "base", size)
        passed = passed.union(_in_order(moves.join(based.where("passes is null and debit").select("seq", "base"), "seq")))
    return passed


def guarded(operations: DataFrame, *, fold_limit: int = 5_000_000, size: int = 100_000) -> DataFrame:
    """Each operation (seq, op, token, sender, receiver, amount) with ``accepted``, as a contract that applies them in order.

    A burn or a transfer needs its amount on the sender's balance, and one that is refused changes nothing. A token of at
    most ``fold_limit`` operations (counted) is applied in order by one task, which keeps balances only; of the others
    bounds, in ranges of ``size`` operations, first decide what they can, with the same result. ``seq`` is unique.
    Amounts that are null or negative, operations of other names and such without a ``seq`` fail.
    """
    known = F.col("op").isin("mint", "burn", "transfer") & (F.col("amount") >= 0) & F.col("seq").isNotNull()
    plain = operations.select("seq", "op", "token", "sender", "receiver", F.col("amount").cast(AMOUNT).alias("amount"))
    moves = plain.where(F.coalesce(known, F.lit(False)))
    large = moves.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") > fold_limit).select("token")
    based = moves.withColumn("base", F.lit(0).cast(AMOUNT))
    if large.isEmpty():
        passed = _in_order(based)
    else:
        same = F.col("token").eqNullSafe(F.col("_token"))
        large = large.withColumnRenamed("token", "_token")
        passed = _in_order(based.join(large, same, "left_anti")).union(_by_bounds(moves.join(large, same, "left_semi"), size))
    return operations.join(passed, "seq", "left").withColumn("accepted", F.coalesce("accepted", F.lit(False)))


def valid_operations(operations: DataFrame, **options) -> DataFrame:
    """Entries of the operations that a contract accepts; see ``guarded``."""
    return token_ledger(guarded(operations, **options).where("accepted").drop("accepted"))


def tally(votes: DataFrame, power: DataFrame) -> DataFrame:
    """(proposal, option, power): the voters' power by option; of a voter's votes on a proposal the last stands."""
    last = votes.groupBy("proposal", "voter").agg(F.max_by("option", "seq").alias("option"))
    return last.join(power.select("voter", "power"), "voter").groupBy("proposal", "option").agg(F.sum("power").alias("power"))


def with_deployments(coins: DataFrame, mappings: DataFrame, denoms: Denoms, *, auto_deploy: bool, new_contract: Column) -> tuple[DataFrame, DataFrame]:
    """(coins with their contract, new auto mappings) of conversions (seq, address, denom, amount).

    The external contract is preferred to the auto-deployed one. A valid denomination without one gets ``new_contract``, an
    expression of the denomination, if ``auto_deploy``; others keep a null contract, by which conversion rejects them.
    """
    from .lookups import contracts_of

    met = contracts_of(coins, mappings).drop("external", "auto")
    missing = F.col("contract").isNull() & denoms.is_valid(F.col("denom")) & F.lit(auto_deploy)
    made = met.where(missing).select("denom").distinct().select("denom", F.lit("auto").alias("kind"), new_contract.alias("contract"))
    return met.withColumn("contract", F.when(missing, new_contract).otherwise(F.col("contract"))), made


def genesis_token(addresses: DataFrame, amount: int, slot: int = 0) -> DataFrame:
    """Storage rows of a token contract: key = Keccak of (address, slot), value = amount, both 32-byte words."""
    from ..functions.encoding import keccak

    word = lambda n: bytes(n.to_bytes(32, "big"))
    padded = F.concat(F.lit(bytes(12)), F.col("address"), F.lit(word(slot)))
    return addresses.select("address", keccak(padded).alias("key"), F.lit(word(amount)).alias("value"))
