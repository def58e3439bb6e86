"""What contracts do to native coins: log handlers, and calls of the built-in contracts (bank, relayer, interchain accounts).

No contract is executed here. Logs and calls are recorded rows; they are decoded, judged and turned into ledger entries.
Calldata and log data are read word by word with native functions.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import proto
from ..functions.amounts import AMOUNT
from ..functions.denoms import Denoms, channel_name, evm_denom
from ..functions.encoding import bech32_decode, keccak256, small_uint256, to_bech32, topic_address, word
from .events import Handler
from .ledger import _entry
from .lookups import denom_by_contract

# ------------------------------------------------------------------ ABI data, natively


def _size(w: Column) -> Column:
    """A word as a number that can be a length or an offset, below 2**30; else null."""
    low = F.conv(F.hex(F.substring(w, 29, 4)), 16, 10).cast("bigint")
    return F.when((F.length(w) == 32) & (F.substring(w, 1, 28) == F.lit(bytes(28))) & (low < 1 << 30), low)


def abi_size(data: Column, i: int) -> Column:
    """The ``i``-th word as a length or an offset; null if it is cut off or too large."""
    return _size(word(data, i))


def abi_bytes(data: Column, i: int) -> Column:
    """The dynamic value whose offset is the ``i``-th word; null if malformed."""
    at = abi_size(data, i)
    size = _size(F.substr(data, (at + 1).cast("int"), F.lit(32)))
    return F.when(at + 32 + size <= F.length(data), F.substr(data, (at + 33).cast("int"), size.cast("int")))


def abi_text(data: Column, i: int) -> Column:
    return F.try_validate_utf8(abi_bytes(data, i).cast("string"))


def abi_address(data: Column, i: int) -> Column:
    w = word(data, i)
    return F.when(F.length(w) == 32, F.substring(w, 13, 20))


def abi_amount(data: Column, i: int) -> Column:
    """The ``i``-th word as decimal(38,0); null if cut off or above what that holds."""
    w = word(data, i)
    return F.when(F.length(w) == 32, small_uint256(w))


# ------------------------------------------------------------------ log handlers

#: Handlers by name: the event's name and arguments after the chain's name, and how many topics it takes.
LOG_EVENTS = {
    "to_account": ("SendToAccount(address,uint256)", None),
    "to_ibc": ("SendToIbc(address,string,uint256)", None),
    "to_ibc_v2": ("SendToIbc(address,uint256,string,uint256,bytes)", 3),
    "native_to_ibc": ("Send{coin}ToIbc(address,string,uint256)", None),
}


def log_handlers(chain: str, coin: str) -> list[Handler]:
    """The handlers of a chain whose contracts' events are called ``__<chain>SendTo...``."""
    return [Handler(keccak256(f"__{chain}{form.format(coin=coin)}".encode()), name, n) for name, (form, n) in LOG_EVENTS.items()]


def handle_logs(logs: DataFrame, handlers: DataFrame, reverse: DataFrame, *, denoms: Denoms, native: str) -> DataFrame:
    """Logs (seq, contract, topics, data) that a handler takes, decoded and judged.

    Adds handler, sender, recipient (bytes of an account, or the text of an IBC address), amount, channel, denom and
    ``outcome``: 'ok'; 'ignored' where the data does not decode or the number of topics is wrong (a log line, no more); 'error'
    (the transaction fails) where the contract has no denomination, or one that cannot leave by IBC.
    """
    met = logs.join(F.broadcast(handlers), F.get(F.col("topics"), F.lit(0)) == F.col("topic0"))
    name, data = F.col("handler"), F.col("data")
    second = name == "to_ibc_v2"
    arity = F.col("n_topics").isNull() | (F.size("topics") == F.col("n_topics"))
    met = met.select(
        "seq", "contract", "handler", arity.alias("arity"),
        F.when(second, topic_address(F.get(F.col("topics"), F.lit(1)))).when(name == "to_account", F.col("contract")).otherwise(abi_address(data, 0)).alias("sender"),
        F.when(name == "to_account", abi_address(data, 0)).alias("to_account"),
        F.when(second, abi_text(data, 0)).when(name != "to_account", abi_text(data, 1)).alias("to_ibc"),
        F.when(second | (name == "to_account"), abi_amount(data, 1)).otherwise(abi_amount(data, 2)).alias("amount"),
        (~second | abi_bytes(data, 2).isNotNull()).alias("whole"),
        F.when(second, channel_name(small_uint256(F.get(F.col("topics"), F.lit(2))))).otherwise(F.lit("")).alias("channel"),
    )
    found = denom_by_contract(met.select("seq", "contract"), reverse).groupBy("seq").agg(F.min("found_denom").alias("found"))
    met = met.join(found, "seq", "left").withColumn("denom", F.when(name == "native_to_ibc", F.lit(native)).otherwise(F.col("found")))
    decoded = F.col("arity") & F.col("whole") & F.col("sender").isNotNull() & F.col("amount").isNotNull() & F.coalesce("to_account", F.col("to_ibc").cast("binary")).isNotNull()
    leaves = name.isin("to_account", "native_to_ibc") | denoms.is_ibc(F.col("denom")) | denoms.is_source(F.col("denom"))
    outcome = F.when(~F.coalesce(decoded, F.lit(False)), "ignored").when(F.col("denom").isNull() | ~F.coalesce(leaves, F.lit(False)), "error").otherwise("ok")
    return met.select("seq", "contract", "handler", "sender", "to_account", "to_ibc", "amount", "channel", "denom", outcome.alias("outcome"))


def log_entries(handled: DataFrame, *, denoms: Denoms) -> DataFrame:
    """Ledger entries (seq, address, denom, delta) of logs that were handled; addresses are lower-case hex.

    Coins go from the contract to the account; towards IBC they go to the sender first, who is refunded if the transfer
    fails. A source coin's are minted for the sender.
    """
    shown = lambda c: F.lower(F.hex(c))
    amount, denom = F.col("amount"), F.col("denom")
    give = _entry(shown("contract"), denom, -amount)
    account = F.array(give, _entry(shown("to_account"), denom, amount))
    through = F.array(_entry(shown("sender"), denom, amount), _entry(shown("sender"), denom, -amount), _entry("transfer", denom, amount))
    minted = denoms.is_source(denom) & (F.col("handler") != "native_to_ibc")
    moves = F.when(F.col("handler") == "to_account", account).when(minted, through).otherwise(F.concat(F.array(give), through))
    return handled.where("outcome = 'ok'").select("seq", F.explode(moves).alias("e")).select("seq", "e.*").where("delta <> 0")


# ------------------------------------------------------------------ calls of built-in contracts

# Methods of the built-in contracts.
BANK_METHODS = {"mint": "mint(address,uint256)", "burn": "burn(address,uint256)", "balanceOf": "balanceOf(address,address)", "transfer": "transfer(address,address,uint256)"}
RELAYER_METHODS = [
    "createClient", "updateClient", "upgradeClient", "submitMisbehaviour", "connectionOpenInit", "connectionOpenTry", "connectionOpenAck", "connectionOpenConfirm",
    "channelOpenInit", "channelOpenTry", "channelOpenAck", "channelOpenConfirm", "channelCloseInit", "channelCloseConfirm",
    "recvPacket", "acknowledgement", "timeout", "timeoutOnClose",
]
#: Priced and named, but never executed: one is not dispatched, the others take no bytes.
NOT_DISPATCHED = {"submitMisbehaviour", "registerPayee", "registerCounterpartyPayee"}
PAYEE_METHODS = {"registerPayee": "registerPayee(string,string,address)", "registerCounterpartyPayee": "registerCounterpartyPayee(string,string,string)"}
ICA_METHODS = {"registerAccount": "registerAccount(string,string,int32)", "queryAccount": "queryAccount(string,address)", "submitMsgs": "submitMsgs(string,bytes,uint256)"}


def selector(signature: str) -> bytes:
    return keccak256(signature.encode())[:4]


def with_method(calls: DataFrame, methods: dict[str, str]) -> DataFrame:
    """Calls (seq, caller, input, readonly) with ``method`` by the first four bytes, null if there is none, and ``args``."""
    table = F.create_map(*[x for name, s in methods.items() for x in (F.lit(selector(s).hex()), F.lit(name))])
    first = F.lower(F.hex(F.substring("input", 1, 4)))
    return calls.withColumn("method", F.try_element_at(table, first)).withColumn("args", F.expr("substring(input, 5)"))


def bank_calls(calls: DataFrame, blocked: DataFrame, *, prefix: str = "evm/") -> DataFrame:
    """Calls of the bank contract as (seq, op, token, sender, receiver, amount, outcome).

    The token is the caller's own denomination. 'ok' means that the call is sound; whether a balance covers it is for
    ``ledger.guarded``. Addresses are lower-case hex; ``blocked`` (address) is a list that is kept by hand.
    """
    shown = lambda c: F.lower(F.hex(c))
    known = with_method(calls, BANK_METHODS)
    method, args = F.col("method"), F.col("args")
    moves = method == "transfer"
    rows = known.select(
        "seq", method.alias("op"), evm_denom(prefix, F.col("caller")).alias("token"), "readonly",
        F.when(moves | (method == "burn"), shown(abi_address(args, 0))).alias("sender"),
        F.when(moves, shown(abi_address(args, 1))).when(method.isin("mint", "balanceOf"), shown(abi_address(args, 0))).alias("receiver"),
        F.when(moves, abi_amount(args, 2)).when(method != "balanceOf", abi_amount(args, 1)).alias("amount"),
        F.when(moves, shown(abi_address(args, 1))).otherwise(shown(abi_address(args, 0))).alias("touched"),
    )
    rows = rows.join(F.broadcast(blocked.select(F.col("address").alias("touched"), F.lit(True).alias("_blocked")).distinct()), "touched", "left")
    changes = F.col("op") != "balanceOf"
    outcome = (
        F.when(F.col("op").isNull(), "unknown method").when(changes & F.col("readonly"), "not readonly")
        .when(F.col("touched").isNull() | (changes & F.col("amount").isNull()), "bad arguments").when(changes & (F.col("amount") <= 0), "invalid amount")
        .when(changes & F.col("_blocked"), "blocked address").otherwise("ok")
    )
    return rows.select("seq", "op", "token", "sender", "receiver", F.col("amount").cast(AMOUNT).alias("amount"), outcome.alias("outcome"))


def relayer_calls(calls: DataFrame, signer_fields: dict[str, int]) -> DataFrame:
    """Calls of the relayer contract as (seq, method, payload, outcome): what the executor does with each.

    The argument is a message as bytes. ``signer_fields`` says which field of a method's message holds its signer, a bech32
    address; the message must have one signer, and that must be the caller.
    """
    methods = {m: f"{m}(bytes)" for m in RELAYER_METHODS} | PAYEE_METHODS
    known = with_method(calls, methods)
    rows = known.withColumn("payload", F.when(~F.col("method").isin(*PAYEE_METHODS), abi_bytes(F.col("args"), 0)))

    @F.pandas_udf("struct<decoded:boolean,signers:int,signer:binary>")
    def read(method: pd.Series, payload: pd.Series) -> pd.DataFrame:
        out = []
        for m, p in zip(method, payload):
            try:
                found = [v for n, v in proto.fields(bytes(p)) if n == signer_fields.get(m)] if p is not None else []
                address = bech32_decode(found[0].decode()) if len(found) == 1 else None
                out.append((p is not None, len(found), address[1] if address else None))
            except (ValueError, IndexError, AttributeError):
                out.append((False, 0, None))
        return pd.DataFrame(out, columns=["decoded", "signers", "signer"])

    rows = rows.withColumn("m", read("method", "payload"))
    outcome = (
        F.when(F.col("readonly"), "not readonly").when(F.length("input") < 4, "input too short").when(F.col("method").isNull(), "no such method")
        .when(F.col("method").isin(*PAYEE_METHODS), "bad arguments").when(F.col("payload").isNull(), "bad arguments")
        .when(F.col("method").isin(*NOT_DISPATCHED), "unknown method").when(~F.col("m.decoded"), "bad message")
        .when(F.col("m.signers") != 1, "not one signer").when(~F.col("m.signer").eqNullSafe(F.col("caller")), "not authenticated").otherwise("ok")
    )
    return rows.select("seq", "method", "payload", outcome.alias("outcome"))


def ica_calls(calls: DataFrame, *, prefix: str) -> DataFrame:
    """Calls of the interchain-account contract as (seq, method, owner, connection, version, ordering, timeout, memo, sequence, outcome).

    The owner is the caller's account (of a query: the address asked for). Messages that are submitted carry a memo that
    names the caller for the callback, and get the next sequence of their owner and connection.
    """
    known = with_method(calls, ICA_METHODS)
    method, args = F.col("method"), F.col("args")
    about = F.when(method == "queryAccount", abi_address(args, 1)).otherwise(F.col("caller"))
    rows = known.select(
        "seq", "method", "readonly", "input", about.alias("about"), abi_text(args, 0).alias("connection"),
        F.when(method == "registerAccount", abi_text(args, 1)).alias("version"), F.when(method == "registerAccount", abi_size(args, 2).cast("int")).alias("ordering"),
        F.when(method == "submitMsgs", abi_amount(args, 2)).alias("timeout"), F.when(method == "submitMsgs", abi_bytes(args, 1)).alias("data"),
        F.when(method == "submitMsgs", F.concat(F.lit('{"src_callback": {"address": "'), to_bech32(F.col("caller"), prefix), F.lit('"}}'))).alias("memo"),
    )
    whole = F.col("connection").isNotNull() & F.col("about").isNotNull() & ((method != "registerAccount") | (F.col("version").isNotNull() & F.col("ordering").isNotNull()))
    whole = whole & ((method != "submitMsgs") | (F.col("timeout").isNotNull() & F.col("data").isNotNull()))
    outcome = (
        F.when(F.length("input") < 4, "input too short").when(method.isNull(), "no such method").when((method != "queryAccount") & F.col("readonly"), "not readonly")
        .when(~F.coalesce(whole, F.lit(False)), "bad arguments").otherwise("ok")
    )
    rows = rows.withColumn("outcome", outcome).withColumn("owner", to_bech32(F.col("about"), prefix))
    sent = F.when((F.col("outcome") == "ok") & (method == "submitMsgs"), F.lit(1)).otherwise(F.lit(0))
    place = F.sum(sent).over(Window.partitionBy("owner", "connection").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("sequence", F.when(sent == 1, place.cast("long")))
    return rows.select("seq", "method", "owner", "connection", "version", "ordering", "timeout", "memo", "sequence", "outcome")
