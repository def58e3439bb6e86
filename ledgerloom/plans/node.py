"""Node queries: blocks, accounts, transactions, receipts and logs by RPC; event conversion; contract logs and calls."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import encoding as X
from ..functions.amounts import COINS
from ..functions.denoms import Denoms
from ..operators import checks as H
from ..operators import contracts as C
from ..operators import events as E
from ..operators import ledger as L
from ..operators import receipts as R
from ..operators import rpc
from ..operators import stats as S
from ..operators.lookups import channel_of_voucher
from ..sources import stores as Q
from . import twins as T
from .codecs import _address, _word
from .tables import MESSAGES_SQL, day, local_rows, messages, table

DENOMS = Denoms("source")


def _blocks(spark, sf_dir):
    """A block per order day, with its number of orders as gas."""
    per_day = table(spark, sf_dir, "orders").groupBy(day("o_orderdate").alias("height")).agg(F.count("*").alias("gas_used"), F.max("o_custkey").alias("base_fee"))
    hashed = F.unhex(F.sha2(F.col("height").cast("string"), 256))
    return per_day.select("height", hashed.alias("hash"), F.timestamp_seconds(F.col("height") * 86400).alias("ts"), "gas_used", F.lit(40).cast("long").alias("gas_limit"), "base_fee")


def _txs(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("*", day("o_orderdate").alias("block"))
    place = (F.row_number().over(Window.partitionBy("block").orderBy("o_orderkey")) - 1).cast("long")
    return orders.select("block", place.alias("index"), F.unhex(F.sha2(F.col("o_orderkey").cast("string"), 256)).alias("hash"), "o_orderkey", F.col("o_custkey").alias("sender"))


def _accounts(spark, sf_dir):
    """Accounts as of each order of a customer: the price as balance, the order's number as nonce."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    orders = table(spark, sf_dir, "orders").withColumn("nonce", F.row_number().over(w).cast("long")).withColumn("version", day("o_orderdate"))
    last = orders.groupBy("o_custkey", "version").agg(F.max(F.struct("nonce", F.floor("o_totalprice").cast("long").alias("balance"))).alias("t"))
    return last.select(F.col("o_custkey").cast("string").alias("address"), "version", "t.nonce", "t.balance", F.unhex(F.sha2(F.col("t.balance").cast("string"), 256)).alias("code"))


_BLOCKS_SQL = "b AS (SELECT date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS height, count(*) AS gas_used, max(o_custkey) AS base_fee FROM orders GROUP BY 1)"
_TXS_SQL = "t AS (SELECT date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS block, row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY o_orderkey) - 1 AS idx, o_orderkey, o_custkey FROM orders)"
_ACCOUNTS_SQL = """n AS (SELECT *, date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS version, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nonce FROM orders),
a AS (SELECT CAST(o_custkey AS VARCHAR) AS address, version, max(nonce) AS nonce, CAST(floor(arg_max(o_totalprice, nonce)) AS BIGINT) AS balance FROM n GROUP BY 1, 2)"""


def rpc_blocks(spark, sf_dir):
    """Blocks by tag, number, hex quantity and hash."""
    blocks = _blocks(spark, sf_dir)
    ends = blocks.agg(F.min("height"), F.max("height")).first()
    asked = {"latest": "latest", "earliest": "earliest", "number": ends[0] + 1, "quantity": hex(ends[1] - 1)}
    shown = lambda rows, name: rows.select(F.lit(name).alias("asked"), "height", F.lower(F.hex("hash")).alias("hash"))
    out = shown(rpc.block(blocks, blocks.where(F.col("height") == ends[0]).first()["hash"]), "hash")
    for name, which in asked.items():
        out = out.union(shown(rpc.block(blocks, which), name))
    by_source = Q.block_by(blocks, number=ends[0] + 2).select(F.lit("source").alias("asked"), "height", F.lower(F.hex("hash")).alias("hash"))
    number = rpc.block_number(blocks).select(F.lit("block number").alias("asked"), "height", F.lit(None).cast("string").alias("hash"))
    return out.union(by_source).union(number)


def rpc_accounts(spark, sf_dir):
    """Balance, nonce and code of an account at three blocks, and of one never seen."""
    accounts, blocks = _accounts(spark, sf_dir), _blocks(spark, sf_dir)
    ends = blocks.agg(F.min("height"), F.max("height")).first()
    middle = (ends[0] + ends[1]) // 2
    out = None
    for address, name, at in [("7", "middle", middle), ("7", "latest", "latest"), ("7", "before", ends[0] - 1), ("none", "latest", "latest")]:
        row = rpc.balance(accounts, blocks, address, at).join(rpc.transaction_count(accounts, blocks, address, at)).join(rpc.code(accounts, blocks, address, at))
        row = row.select(F.lit(address).alias("address"), F.lit(name).alias("at"), "balance", "nonce", F.lower(F.hex("code")).alias("code"))
        out = row if out is None else out.union(row)
    return out


def rpc_storage(spark, sf_dir):
    """Slots of an account: one read, and those that a proof is about."""
    events = table(spark, sf_dir, "events").select(F.lit("a").alias("address"), (F.col("user_id") % 3).cast("string").cast("binary").alias("slot"), F.col("event_id").alias("version"), _word(F.col("event_id")).alias("value"))
    blocks = table(spark, sf_dir, "events").select(F.col("event_id").alias("height"))
    accounts = local_rows(spark, [("a", 1, 5, 9, b"")], "address string, version long, balance long, nonce long, code binary")
    proven = rpc.proven_values(accounts, events, blocks, "a", [b"0", b"2", b"9"], 500)
    one = rpc.storage_at(events, blocks, "a", b"1").select(F.lit(b"1").alias("slot"), "value", F.lit(-1).cast("long").alias("balance"), F.lit(-1).cast("long").alias("nonce"))
    return proven.union(one).select(F.col("slot").cast("string").alias("slot"), F.lower(F.hex("value")).alias("value"), "balance", "nonce")


def rpc_transactions(spark, sf_dir):
    """Transactions by hash and by place, and counts of blocks."""
    blocks, txs = _blocks(spark, sf_dir), _txs(spark, sf_dir)
    low = blocks.agg(F.min("height")).first()[0]
    sha = lambda n: bytes.fromhex(spark.range(1).select(F.sha2(F.lit(str(n)), 256)).first()[0])
    by_hash = rpc.transaction(txs, sha(7)).select(F.lit("hash").alias("asked"), "o_orderkey", "block", "index")
    placed = rpc.transaction_in(txs, blocks, low, 1).select(F.lit("place").alias("asked"), "o_orderkey", "block", "index")
    count = rpc.block_transaction_count(txs, blocks, "latest").select(F.lit("count").alias("asked"), F.col("n").alias("o_orderkey"), F.lit(None).cast("long").alias("block"), F.lit(None).cast("long").alias("index"))
    return by_hash.union(placed).union(count)


def rpc_block_receipts(spark, sf_dir):
    receipts = R.cumulative_gas(messages(spark, sf_dir)).select(F.col("block").alias("block_number"), F.col("tx_index").alias("transaction_index"), "gas_used", "status")
    blocks = receipts.select(F.col("block_number").alias("height")).distinct()
    return rpc.block_receipts(receipts, blocks, "latest")


def rpc_logs(spark, sf_dir):
    """The logs of a filter up to the latest block, capped as the method is."""
    events = table(spark, sf_dir, "events")
    logs = events.select(F.col("event_id").alias("block"), F.lit(0).alias("index"), F.col("user_id").cast("string").alias("address"), F.array("event_type").alias("topics"))
    blocks = events.select(F.col("event_id").alias("height"))
    top = blocks.agg(F.max("height")).first()[0]
    return rpc.logs(logs, blocks, E.LogFilter(from_block=max(0, top - 900), topics=(["click", "view"],)), cap=50).select("block", "address")


def rpc_fee_history(spark, sf_dir):
    return rpc.fee_history(_blocks(spark, sf_dir), 500).select("height", "base_fee", F.round("gas_used_ratio", 9).alias("gas_used_ratio"))


def rpc_pool(spark, sf_dir):
    """The pool's status and each sender's pending nonces."""
    orders = table(spark, sf_dir, "orders")
    pool = orders.select(F.col("o_custkey").cast("string").alias("sender"), F.col("o_orderkey").alias("nonce"), F.min("o_orderkey").over(Window.partitionBy("o_custkey")).alias("next_nonce"), F.sha2(F.col("o_orderkey").cast("string"), 256).alias("hash"))
    status = rpc.pool_status(pool).select(F.lit("status").alias("sender"), F.concat_ws("/", F.col("pending").cast("string"), F.col("queued").cast("string")).alias("found"))
    content = rpc.pool_content(pool).select("sender", F.array_join(F.array_sort(F.transform(F.map_entries("by_nonce"), lambda e: F.concat(e["key"], F.lit(":"), F.substring(e["value"], 1, 4)))), ",").alias("found"))
    return status.union(content)


def rpc_trace(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    calls = line.select(F.unhex(F.sha2(F.col("l_orderkey").cast("string"), 256)).alias("hash"), F.col("l_linenumber").alias("position"), F.lit(1).alias("depth"), "l_partkey", "l_suppkey")
    wanted = spark.range(1).select(F.unhex(F.sha2(F.lit("1"), 256))).first()[0]
    return rpc.trace(calls, wanted).select("position", "l_partkey", "l_suppkey")


def tx_search(spark, sf_dir):
    """The third page of matching transactions, newest first."""
    txs = _txs(spark, sf_dir).select(F.col("block").alias("height"), "index", "o_orderkey", "sender")
    return H.search_txs(txs, F.col("sender") % 3 == 1, page=3, per_page=20, descending=True).select("height", "index", "o_orderkey")


# ------------------------------------------------------------------ receipts and logs


def receipt_projection(spark, sf_dir):
    """The whole receipt: a contract's address only for a creation, an effective price only for dynamic fees."""
    rows = R.cumulative_gas(messages(spark, sf_dir)).withColumns({
        "transaction_hash": F.sha2(F.concat_ws("/", "block", "tx"), 256), "block_hash": F.sha2(F.col("block").cast("string"), 256), "from": F.col("block") % 100, "logs_bloom": F.lit(None).cast("binary"),
        "logs": F.when(F.col("tx") == 0, F.array(F.lit("log"))), "to": F.when(F.col("tx") % 3 != 0, F.col("gas_used")), "type": (F.col("tx") % 3).cast("int"), "created": F.concat(F.lit("new"), F.col("tx").cast("string")),
        "base_fee": F.col("gas_used"), "tip_cap": F.lit(5).cast("long"), "fee_cap": F.lit(30).cast("long"),
    })
    out = R.project_receipt(rows)
    return out.select("block_number", "transaction_index", "transaction_hash", "block_hash", "from", "to", "type", "status", "gas_used", "cumulative_gas_used", F.size("logs").alias("n_logs"), F.length("logs_bloom").alias("bloom_size"), "contract_address", "effective_gas_price")


def last_receipt_emptied(spark, sf_dir):
    """Receipts with logs, blooms and contracts: the last one of a block over its gas loses them."""
    rows = R.replay_cumulative_gas(messages(spark, sf_dir)).withColumns({"logs": F.array(F.col("tx").cast("string")), "logs_bloom": F.unhex(F.lit("01" * 256)), "contract_address": F.concat(F.lit("new"), F.col("tx").cast("string"))})
    out = R.fix_last_receipt(rows, F.col("block") % 2 == 0, F.col("gas_used") + 7)
    return out.select("block", "tx", "tx_index", "gas_used", "cumulative_gas_used", "status", F.array_join("logs", ",").alias("logs"), F.substring(F.hex("logs_bloom"), 1, 2).alias("bloom"), "contract_address")


def log_construction(spark, sf_dir):
    """Logs that a block's events become, numbered on from where the transaction is."""
    events = table(spark, sf_dir, "events")
    at = (F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1).cast("long")
    log = E.new_logs(F.col("user_id").cast("string"), F.array("event_type", F.col("event_id").cast("string")), F.col("props").cast("binary"), at)
    return events.select("event_id", log.alias("l")).select("event_id", "l.address", F.array_join("l.topics", ",").alias("topics"), F.col("l.data").cast("string").alias("data"), "l.index")


def hashes_by_block(spark, sf_dir):
    txs = _txs(spark, sf_dir).select("block", F.col("index").alias("tx"), F.substring(F.lower(F.hex("hash")), 1, 8).alias("hash"))
    return R.hashes_by_block(txs).select("block", F.array_join("hashes", ",").alias("hashes"))


def message_outcomes(spark, sf_dir):
    """Messages of a transaction and their outcomes, position by position."""
    line = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set(F.struct("l_linenumber", "l_partkey", "l_suppkey"))).alias("x"))
    txs = line.select("l_orderkey", F.transform("x", lambda x: x["l_partkey"]).alias("msgs"), F.transform("x", lambda x: x["l_suppkey"]).alias("outcomes"))
    return R.pair_messages(txs).select("l_orderkey", "msg", "message", "outcome")


# ------------------------------------------------------------------ events


ABI = [
    {"type": "event", "name": "Signup", "inputs": [{"name": "userId", "type": "uint256", "indexed": True}, {"name": "props", "type": "string", "indexed": False}]},
    {"type": "event", "name": "Purchase", "inputs": [{"name": "eventType", "type": "string", "indexed": True}, {"name": "amount", "type": "uint256", "indexed": False}]},
    {"type": "event", "name": "Click", "inputs": [{"name": "packetData", "type": "string", "indexed": True}]},
    {"type": "event", "name": "Error", "inputs": [{"name": "missing", "type": "string", "indexed": False}]},
    {"type": "function", "name": "none", "inputs": []},
]


def _attributes():
    packet = F.hex(F.concat(F.lit('{"sender": "s'), F.col("user_id").cast("string"), F.lit('", "receiver": "0x'), F.substring(F.sha2(F.col("user_id").cast("string"), 256), 1, 40), F.lit('", "amount": "5", "denom": "d"}')))
    pairs = [("userId", F.col("user_id").cast("string")), ("eventType", F.lit("first")), ("eventType", F.col("event_type")), ("amount", (F.col("event_id") * 3).cast("string")), ("props", F.col("props")), ("packetData", packet)]
    return F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in pairs])


def event_conversion(spark, sf_dir):
    """Native events to logs: indexed arguments as topics, others as data; unknown types go, a missing attribute is an error."""
    decoders = {"user_id": E.unsigned, "amount": E.unsigned, "packet_data": E.packet_data("acc", "accval"), "": E.as_is}
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("type"), _attributes().alias("attributes"))
    rows = E.Converter(E.descriptors(ABI), decoders).rows(events)
    return rows.select("id", F.array_join(F.transform("topics", lambda t: F.lower(F.hex(t))), ",").alias("topics"), F.lower(F.hex("data")).alias("data"), "values", "error")


def log_decoding(spark, sf_dir):
    """Logs by their first topic: the event's name by its signature's hash; others are dropped."""
    names = {d.id: d.name for d in E.descriptors(ABI).values()}
    handlers = E.handler_table(spark, [E.Handler(topic, name) for topic, name in names.items()])
    ids = {d.type: d.id for d in E.descriptors(ABI).values()}
    topic = F.lit(None).cast("binary")
    for kind, value in ids.items():
        topic = F.when(F.col("event_type") == kind, F.lit(value)).otherwise(topic)
    logs = table(spark, sf_dir, "events").select("event_id", F.array(F.coalesce(topic, F.lit(b"none"))).alias("topics"))
    return E.route(logs, handlers).select("event_id", F.col("handler").alias("name"))


def events_as_dicts(spark, sf_dir):
    """Type to attributes over a user's events, later ones win; keys and values are base64 or as they are."""
    attr = F.array(F.struct(F.base64(F.lit("id").cast("binary")).alias("key"), F.base64(F.col("event_id").cast("string").cast("binary")).alias("value")), F.struct(F.lit("raw-key").alias("key"), F.col("props").alias("value")))
    listed = table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", F.struct(F.col("event_type").alias("type"), attr.alias("attributes")).alias("e")))).alias("x"))
    found = listed.select("user_id", E.events_by_type(F.transform("x", lambda x: x["e"])).alias("m"))
    return found.select("user_id", F.explode("m").alias("type", "a")).select("user_id", "type", F.try_element_at("a", F.lit("id")).alias("id"), F.try_element_at("a", F.lit("raw-key")).alias("props"))


def token_reshape(spark, sf_dir):
    """Tokens from JSON, reshaped: amount, base denomination and trace."""
    hop = F.struct(F.lit("transfer").alias("port_id"), F.concat(F.lit("channel-"), F.col("p_size").cast("string")).alias("channel_id"))
    token = F.struct(F.col("p_partkey").cast("string").alias("amount"), F.struct(F.col("p_brand").alias("base"), F.when(F.col("p_partkey") % 2 == 0, F.array(hop)).otherwise(F.array(hop, hop)).alias("trace")).alias("denom"))
    rows = table(spark, sf_dir, "part").select("p_partkey", F.to_json(F.array(token)).alias("text"))
    parsed = rows.withColumn("t", F.from_json("text", "array<struct<amount:string,denom:struct<base:string,trace:array<struct<port_id:string,channel_id:string>>>>>"))
    out = parsed.select("p_partkey", F.explode(E.reshape_tokens(F.col("t"))).alias("x"))
    return out.select("p_partkey", F.col("x.amount").cast("string").alias("amount"), "x.denom.base", F.array_join(F.transform("x.denom.trace", lambda h: F.concat_ws("/", h["port"], h["channel"])), "/").alias("path"))


def trace_vouchers(spark, sf_dir):
    """Traces of received coins: a hop undone where the coin came back, put before where it did not; and the voucher's name."""
    hop = lambda c: F.struct(F.lit("transfer").alias("port"), F.concat(F.lit("channel-"), c.cast("string")).alias("channel"))
    trace = F.when(F.col("p_partkey") % 3 == 0, F.array().cast("array<struct<port:string,channel:string>>")).otherwise(F.array(hop(F.col("p_size") % 5), hop(F.lit(9))))
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_brand", trace.alias("trace"))
    got = rows.withColumn("new", E.received_trace(F.col("trace"), F.lit("transfer"), F.lit("channel-2"), F.lit("transfer"), F.lit("channel-0")))
    return got.select("p_partkey", F.array_join(F.transform("new", lambda h: h["channel"]), ",").alias("hops"), E.voucher(F.col("new"), F.col("p_brand")).alias("voucher"))


def voucher_channels(spark, sf_dir):
    """The channel of a voucher by the first hop of its trace; other forms and unknown hashes have none."""
    parts = table(spark, sf_dir, "part")
    traces = parts.where("p_partkey % 2 = 0").select(F.sha2("p_name", 256).alias("hash"), F.array(F.struct(F.lit("transfer").alias("port"), F.concat(F.lit("channel-"), F.length("p_name").cast("string")).alias("channel"))).alias("trace")).dropDuplicates(["hash"])
    denom = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("ibc/a/"), F.sha2("p_name", 256))).otherwise(F.concat(F.lit("ibc/"), F.sha2("p_name", 256)))
    return channel_of_voucher(parts.select("p_partkey", denom.alias("denom")), traces).select("p_partkey", "channel")


# ------------------------------------------------------------------ contract logs and calls


def _nation_reverse(spark, sf_dir):
    """Contracts of three denominations: a source coin, an IBC voucher and one that cannot leave."""
    name = F.when(F.col("n_nationkey") % 4 == 0, F.concat(F.lit("source0x"), F.substring(F.sha2("n_name", 256), 1, 40))).when(F.col("n_nationkey") % 4 == 1, F.concat(F.lit("ibc/"), F.sha2("n_name", 256))).when(F.col("n_nationkey") % 4 == 2, F.col("n_name"))
    return table(spark, sf_dir, "nation").select(_address("n_name").alias("contract"), name.alias("denom")).where("denom is not null")


def _contract_logs(spark, sf_dir):
    """A log per customer from its nation's contract: each handler's form, every 13th cut off, every 17th with a topic too few."""
    ids = {h.name: h.topic for h in C.log_handlers("Chain", "Base")}
    c = table(spark, sf_dir, "customer").join(F.broadcast(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")), "c_nationkey")
    kind, owner, amount = F.col("c_custkey") % 4, F.concat(F.lit(bytes(12)), _address("c_name")), _word(F.col("c_custkey") * 10**9)
    text = lambda s: F.concat(_word(F.length(s)), s.cast("binary"), F.expr("unhex(repeat('00', 14))"))  # noqa: E731  names have 18 letters
    to_account = F.concat(owner, amount)
    to_ibc = F.concat(owner, _word(F.lit(96)), amount, text(F.col("c_name")))
    second = F.concat(_word(F.lit(96)), amount, _word(F.lit(160)), text(F.col("c_name")), _word(F.lit(0)))
    data = F.when(kind == 0, to_account).when(kind == 2, second).otherwise(to_ibc)
    data = F.when(F.col("c_custkey") % 13 == 0, F.expr("substring(d, 1, length(d) - 33)")).otherwise(F.col("d")), data
    topics = F.when(kind == 0, F.array(F.lit(ids["to_account"]))).when(kind == 1, F.array(F.lit(ids["to_ibc"]))).when(kind == 3, F.array(F.lit(ids["native_to_ibc"])))
    topics = topics.when(F.col("c_custkey") % 17 == 0, F.array(F.lit(ids["to_ibc_v2"]), owner)).otherwise(F.array(F.lit(ids["to_ibc_v2"]), owner, _word(F.col("c_nationkey"))))
    rows = c.withColumn("d", data[1]).select(F.col("c_custkey").alias("seq"), _address("n_name").alias("contract"), topics.alias("topics"), data[0].alias("data"))
    return rows, E.handler_table(spark, C.log_handlers("Chain", "Base"))


def _handled(spark, sf_dir):
    logs, handlers = _contract_logs(spark, sf_dir)
    return C.handle_logs(logs, handlers, _nation_reverse(spark, sf_dir), denoms=DENOMS, native="base")


def log_handling(spark, sf_dir):
    """Contract logs decoded and judged: done, ignored or an error."""
    ok = F.col("outcome") == "ok"
    shown = lambda c: F.when(ok, F.lower(F.hex(c)))
    return _handled(spark, sf_dir).select("seq", "handler", "outcome", shown("sender").alias("sender"), shown("to_account").alias("to_account"), F.when(ok, F.col("to_ibc")).alias("to_ibc"), F.when(ok, F.col("amount").cast("string")).alias("amount"), F.when(ok, F.col("channel")).alias("channel"), F.when(ok, F.col("denom")).alias("denom"))


def log_balances(spark, sf_dir):
    """What contract logs do to balances."""
    return L.balances(C.log_entries(_handled(spark, sf_dir), denoms=DENOMS)).select("address", "denom", F.col("amount").cast("string").alias("amount"))


def _bank(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    who = lambda c: F.concat(F.lit(bytes(12)), F.unhex(F.substring(F.sha2(c.cast("string"), 256), 1, 40)))
    kind, amount = F.col("o_orderkey") % 6, _word(F.floor("o_totalprice"))
    call = lambda name, *words: F.concat(F.lit(C.selector(C.BANK_METHODS[name])), *words)
    data = F.when(kind == 0, call("mint", who(F.col("o_custkey")), amount)).when(kind == 1, call("burn", who(F.col("o_custkey")), amount)).when(kind == 2, call("balanceOf", who(F.col("o_custkey")), who(F.col("o_custkey"))))
    data = data.when(kind == 3, call("transfer", who(F.col("o_custkey")), who(F.col("o_custkey") + 1), amount)).when(kind == 4, F.lit(b"\x01\x02\x03\x04")).otherwise(call("mint", who(F.col("o_custkey")), _word(F.lit(0))))
    calls = o.select(F.col("o_orderkey").alias("seq"), F.unhex(F.substring(F.sha2((F.col("o_custkey") % 40).cast("string"), 256), 1, 40)).alias("caller"), data.alias("input"), (F.col("o_orderkey") % 50 == 3).alias("readonly"))
    blocked = table(spark, sf_dir, "customer").where("c_custkey % 31 = 5").select(F.substring(F.sha2(F.col("c_custkey").cast("string"), 256), 1, 40).alias("address"))
    return C.bank_calls(calls, blocked)


def bank_outcomes(spark, sf_dir):
    return _bank(spark, sf_dir).select("seq", "op", "sender", "receiver", F.col("amount").cast("string").alias("amount"), "outcome")


def token_guard(spark, sf_dir):
    """Operations of forty token ledgers, applied in order: what a balance does not cover is refused and changes nothing."""
    ops = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seq"), F.when(F.col("o_orderkey") % 3 == 0, "mint").when(F.col("o_orderkey") % 3 == 1, "burn").otherwise("transfer").alias("op"), (F.col("o_custkey") % 40).cast("string").alias("token"),
        (F.col("o_custkey") % 7).cast("string").alias("sender"), ((F.col("o_custkey") + F.col("o_orderkey")) % 7).cast("string").alias("receiver"), F.floor("o_totalprice").cast("decimal(38,0)").alias("amount"),
    )
    return L.guarded(ops).select("seq", "accepted")


def relayer_outcomes(spark, sf_dir):
    """Calls of the relayer contract: each refusal, and messages that their one signer sends."""
    o = table(spark, sf_dir, "orders")
    account = F.unhex(F.substring(F.sha2(F.col("o_custkey").cast("string"), 256), 1, 40))
    text = X.to_bech32(F.col("account"), "acc").cast("binary")
    signer = F.concat(F.lit(bytes([4 << 3 | 2])), F.unhex(F.lpad(F.hex(F.length("text")), 2, "0")), F.col("text"))
    kind = F.col("o_orderkey") % 8
    message = F.when(kind == 1, F.concat(signer, signer)).when(kind == 2, F.lit(b"\x22\x7f")).otherwise(F.concat(F.lit(b"\x08\x05"), signer))
    padded = F.concat(_word(F.lit(32)), _word(F.length("message")), F.col("message"), F.expr("unhex(repeat('00', CAST(pmod(-length(message), 32) AS INT)))"))
    pick = lambda name: F.lit(C.selector(f"{name}(bytes)"))
    first = F.when(kind == 3, pick("submitMisbehaviour")).when(kind == 4, F.lit(b"abcd")).when(kind == 5, F.lit(C.selector(C.PAYEE_METHODS["registerPayee"]))).otherwise(pick("recvPacket"))
    data = F.when(kind == 6, F.lit(b"ab")).otherwise(F.concat(first, padded))
    rows = o.withColumn("account", account).withColumn("text", text).withColumn("message", message)
    calls = rows.select(F.col("o_orderkey").alias("seq"), F.when(F.col("o_orderkey") % 5 == 0, F.lit(bytes(20))).otherwise(F.col("account")).alias("caller"), data.alias("input"), (F.col("o_orderkey") % 40 == 7).alias("readonly"))
    return C.relayer_calls(calls, {"recvPacket": 4, "submitMisbehaviour": 4}).select("seq", "method", "outcome", F.length("payload").alias("payload_bytes"))


def ica_outcomes(spark, sf_dir):
    """Calls of the interchain-account contract: accounts by owner, sequences by owner and connection."""
    o = table(spark, sf_dir, "orders")
    caller = F.unhex(F.substring(F.sha2((F.col("o_custkey") % 50).cast("string"), 256), 1, 40))
    text = lambda s: F.concat(_word(F.lit(len(s))), F.lit(s.encode().ljust(32, b"\0")))
    kind = F.col("o_orderkey") % 4
    call = lambda name, *words: F.concat(F.lit(C.selector(C.ICA_METHODS[name])), *words)
    link = F.when(F.col("o_orderkey") % 3 == 0, text("connection-0")).otherwise(text("connection-1"))
    data = F.when(kind == 0, call("registerAccount", _word(F.lit(96)), _word(F.lit(160)), _word(F.lit(1)), link, text("v1")))
    data = data.when(kind == 1, call("queryAccount", _word(F.lit(64)), F.concat(F.lit(bytes(12)), F.col("caller")), link))
    data = data.when(kind == 2, call("submitMsgs", _word(F.lit(96)), _word(F.lit(160)), _word(F.col("o_orderkey")), link, text("data"))).otherwise(F.lit(b"abcd"))
    rows = o.withColumn("caller", caller)
    calls = rows.select(F.col("o_orderkey").alias("seq"), "caller", data.alias("input"), (F.col("o_orderkey") % 100 < 10).alias("readonly"))
    out = C.ica_calls(calls, prefix="acc")
    return out.select("seq", "method", "owner", "connection", "version", "ordering", F.col("timeout").cast("string").alias("timeout"), "memo", "sequence", "outcome")


def coin_checks(spark, sf_dir):
    """Conversion messages with a bad address or coins that are no set."""
    address = F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).when(F.col("c_custkey") % 3 == 1, X.to_bech32(_address("c_name"), "acc")).otherwise(X.to_bech32(_address("c_name"), "other"))
    coin = lambda d, a: F.struct(F.lit(d).alias("denom"), a.cast("decimal(38,0)").alias("amount"))
    n = F.col("c_custkey") % 4
    coins = F.when(n == 0, F.array(coin("a", F.lit(1)), coin("b", F.lit(2)))).when(n == 1, F.array(coin("b", F.lit(1)), coin("a", F.lit(2)))).when(n == 2, F.array(coin("a", F.lit(0)))).otherwise(F.array().cast(COINS))
    return H.message_errors(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), address.alias("address"), coins.alias("coins")), "acc")


def parameter_checks(spark, sf_dir):
    """Parameters that a set must not have."""
    rows = [("ibc_denom", "ibc/" + "A" * 64), ("ibc_denom", "ibc/x"), ("ibc_denom", ""), ("ibc_timeout", "86400000000000"), ("ibc_timeout", "0"), ("ibc_timeout", "18446744073709551616"), ("ibc_timeout", "18446744073709551615"),
            ("max_callback_gas", "-1"), ("enable_auto_deployment", "true"), ("enable_auto_deployment", "yes"), ("admin", ""), ("admin", "nobody"), ("admin", X.bech32_encode("acc", bytes(20))), ("other", "1"), ("ibc_denom", None)]
    return H.parameter_errors(local_rows(spark, rows, "name string, value string"), DENOMS)


def block_stats_report(spark, sf_dir):
    blocks = _blocks(spark, sf_dir).withColumn("n_txs", F.col("gas_used"))
    return S.stats_lines(S.sliding_tps(blocks))


def output_files(spark, sf_dir):
    """Files of a run to archive: databases of the leading nodes only."""
    files = table(spark, sf_dir, "customer").select(F.concat(F.lit("node"), F.col("c_nationkey").cast("string")).alias("node"), F.concat(F.lit("/data/"), F.when(F.col("c_custkey") % 3 == 0, "state.db/").when(F.col("c_custkey") % 3 == 1, "other.db/").otherwise("log/"), F.col("c_custkey").cast("string")).alias("path"))
    return S.kept_outputs(files, ["node0", "node7"], ["state", "application"])


def governance_tally(spark, sf_dir):
    """Votes on proposals by the power of their voters; of several votes the last counts."""
    votes = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 3).alias("proposal"), F.col("o_custkey").alias("voter"), F.col("o_orderstatus").alias("option"), F.col("o_orderkey").alias("seq"))
    power = table(spark, sf_dir, "customer").where("c_custkey % 4 <> 1").select(F.col("c_custkey").alias("voter"), F.col("c_nationkey").cast("long").alias("power"))
    return L.tally(votes, power)


QUERIES = {f.__name__: f for f in (
    rpc_blocks, rpc_accounts, rpc_storage, rpc_transactions, rpc_block_receipts, rpc_logs, rpc_fee_history, rpc_pool, rpc_trace, tx_search, receipt_projection, last_receipt_emptied, log_construction, hashes_by_block,
    message_outcomes, event_conversion, log_decoding, events_as_dicts, token_reshape, trace_vouchers, voucher_channels, log_handling, log_balances, bank_outcomes, token_guard, relayer_outcomes, ica_outcomes,
    coin_checks, parameter_checks, block_stats_report, output_files, governance_tally,
)}

_WINDOW = "OVER (PARTITION BY block ORDER BY tx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_RECEIPTS = f"""WITH {MESSAGES_SQL}, kept AS (SELECT *, CAST(sum(CASE WHEN is_evm OR code = 0 THEN gas_used ELSE 0 END) {_WINDOW} AS BIGINT) AS cumulative_gas_used, CAST(sum(CASE WHEN is_evm THEN 1 ELSE 0 END) {_WINDOW} - 1 AS BIGINT) AS tx_index
    FROM messages WHERE code = 0 OR over_limit), r AS (SELECT *, CAST(CASE WHEN code <> 0 OR failed THEN 0 ELSE 1 END AS INTEGER) AS status FROM kept WHERE is_evm)"""
_REPLAY = f"""WITH {MESSAGES_SQL}, r AS (SELECT block, tx, CAST(count(*) {_WINDOW} - 1 AS BIGINT) AS tx_index, gas_used, CAST(sum(gas_used) {_WINDOW} AS BIGINT) AS cumulative_gas_used, CASE WHEN failed THEN 0 ELSE 1 END AS status
    FROM messages WHERE (code = 0 OR over_limit) AND is_evm), m AS (SELECT *, block % 2 = 0 AND row_number() OVER (PARTITION BY block ORDER BY tx_index DESC) = 1 AS is_last FROM r)"""
_SIG = lambda s: T.keccak(f"'{s.encode().hex()}'")
_JSON = "json_quote"
_SHORT = "substr(sha256({}), 1, 40)"
_HANDLED = f"""x AS (SELECT c_custkey AS seq, c_custkey % 4 AS k, c_name, n_name, c_nationkey, {_SHORT.format('c_name')} AS owner, {_SHORT.format('n_name')} AS contract,
        CASE WHEN c_custkey % 4 = 3 THEN 'base' WHEN n_nationkey % 4 = 0 THEN 'source0x' || {_SHORT.format('n_name')} WHEN n_nationkey % 4 = 1 THEN 'ibc/' || sha256(n_name) WHEN n_nationkey % 4 = 2 THEN n_name END AS denom,
        CASE WHEN c_custkey % 13 = 0 OR (c_custkey % 4 = 2 AND c_custkey % 17 = 0) THEN 'ignored'
             WHEN c_custkey % 4 = 3 THEN 'ok' WHEN n_nationkey % 4 = 3 THEN 'error' WHEN c_custkey % 4 = 0 THEN 'ok' WHEN n_nationkey % 4 = 2 THEN 'error' ELSE 'ok' END AS outcome
        FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

ORACLES = {
    "rpc_blocks": f"""WITH {_BLOCKS_SQL}, e AS (SELECT min(height) AS a, max(height) AS z FROM b), q AS (SELECT unnest(['hash', 'latest', 'earliest', 'number', 'quantity', 'source']) AS asked, unnest([a, z, a, a + 1, z - 1, a + 2]) AS h FROM e)
        SELECT asked, height, sha256(CAST(height AS VARCHAR)) AS hash FROM q JOIN b ON h = height UNION ALL SELECT 'block number', z, NULL FROM e""",
    "rpc_accounts": f"""WITH {_ACCOUNTS_SQL}, {_BLOCKS_SQL}, e AS (SELECT min(height) AS a, max(height) AS z FROM b), q AS (SELECT unnest(['7', '7', '7', 'none']) AS address, unnest(['middle', 'latest', 'before', 'latest']) AS "at", unnest([(a + z) // 2, z, a - 1, z]) AS h FROM e),
        f AS (SELECT q.address, "at", arg_max(balance, version) AS balance, arg_max(nonce, version) AS nonce FROM q LEFT JOIN a ON a.address = q.address AND version <= h GROUP BY 1, 2)
        SELECT address, "at", coalesce(balance, 0) AS balance, coalesce(nonce, 0) AS nonce, CASE WHEN balance IS NULL THEN '' ELSE sha256(CAST(balance AS VARCHAR)) END AS code FROM f""",
    "rpc_storage": """SELECT s AS slot, lpad(lower(to_hex(coalesce(max(event_id) FILTER (event_id <= 500), 0))), 64, '0') AS value, 5::BIGINT AS balance, 9::BIGINT AS nonce FROM (VALUES ('0'), ('2'), ('9')) v(s) LEFT JOIN events ON CAST(user_id % 3 AS VARCHAR) = s GROUP BY 1
        UNION ALL SELECT '1', lpad(lower(to_hex(max(event_id))), 64, '0'), -1, -1 FROM events WHERE user_id % 3 = 1""",
    "rpc_transactions": f"""WITH {_TXS_SQL} SELECT 'hash' AS asked, o_orderkey, block, idx AS "index" FROM t WHERE o_orderkey = 7 UNION ALL SELECT 'place', o_orderkey, block, idx FROM t WHERE idx = 1 AND block = (SELECT min(block) FROM t)
        UNION ALL SELECT 'count', count(*), NULL, NULL FROM t WHERE block = (SELECT max(block) FROM t)""",
    "rpc_block_receipts": f"{_RECEIPTS} SELECT block AS block_number, tx_index AS transaction_index, gas_used, status FROM r WHERE block = (SELECT max(block) FROM r)",
    "rpc_logs": "SELECT event_id AS block, CAST(user_id AS VARCHAR) AS address FROM events WHERE event_id >= (SELECT greatest(0, max(event_id) - 900) FROM events) AND event_type IN ('click', 'view') ORDER BY event_id LIMIT 50",
    "rpc_fee_history": f"WITH {_BLOCKS_SQL} SELECT height, base_fee, round(gas_used / 40.0::DOUBLE, 9) AS gas_used_ratio FROM b WHERE height > (SELECT max(height) FROM b) - 100",
    "rpc_pool": """WITH p AS (SELECT CAST(o_custkey AS VARCHAR) AS sender, o_orderkey AS nonce, o_orderkey = min(o_orderkey) OVER (PARTITION BY o_custkey) + row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS pending FROM orders)
        SELECT 'status' AS sender, CAST(count(*) FILTER (pending) AS VARCHAR) || '/' || CAST(count(*) FILTER (NOT pending) AS VARCHAR) AS found FROM p
        UNION ALL SELECT sender, string_agg(e, ',' ORDER BY e) FROM (SELECT sender, CAST(nonce AS VARCHAR) || ':' || substr(sha256(CAST(nonce AS VARCHAR)), 1, 4) AS e FROM p) GROUP BY 1""",
    "rpc_trace": "SELECT l_linenumber AS position, l_partkey, l_suppkey FROM lineitem WHERE l_orderkey = 1",
    "tx_search": f'WITH {_TXS_SQL} SELECT block AS height, idx AS "index", o_orderkey FROM t WHERE o_custkey % 3 = 1 ORDER BY block DESC, idx DESC LIMIT 20 OFFSET 40',
    "receipt_projection": f"""{_RECEIPTS} SELECT block AS block_number, tx_index AS transaction_index, sha256(CAST(block AS VARCHAR) || '/' || CAST(tx AS VARCHAR)) AS transaction_hash, sha256(CAST(block AS VARCHAR)) AS block_hash, block % 100 AS "from", CASE WHEN tx % 3 <> 0 THEN gas_used END AS "to", CAST(tx % 3 AS INTEGER) AS type,
        status, gas_used, cumulative_gas_used, CASE WHEN tx = 0 THEN 1 ELSE 0 END AS n_logs, 0 AS bloom_size, CASE WHEN tx % 3 = 0 THEN 'new' || CAST(tx AS VARCHAR) END AS contract_address, CASE WHEN tx % 3 = 2 THEN least(30, gas_used + 5) END AS effective_gas_price FROM r""",
    "last_receipt_emptied": f"""{_REPLAY} SELECT block, tx, tx_index, CASE WHEN is_last THEN gas_used + 7 ELSE gas_used END AS gas_used, CASE WHEN is_last THEN cumulative_gas_used + 7 ELSE cumulative_gas_used END AS cumulative_gas_used, CAST(CASE WHEN is_last THEN 0 ELSE status END AS INTEGER) AS status,
        CASE WHEN is_last THEN '' ELSE CAST(tx AS VARCHAR) END AS logs, CASE WHEN is_last THEN '00' ELSE '01' END AS bloom, CASE WHEN NOT is_last THEN 'new' || CAST(tx AS VARCHAR) END AS contract_address FROM m""",
    "log_construction": """SELECT event_id, CAST(user_id AS VARCHAR) AS address, event_type || ',' || CAST(event_id AS VARCHAR) AS topics, props AS data, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS "index" FROM events""",
    "hashes_by_block": f"WITH {_TXS_SQL} SELECT block, string_agg(substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 8), ',' ORDER BY idx) AS hashes FROM t GROUP BY 1",
    "message_outcomes": "SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS INTEGER) AS msg, l_partkey AS message, l_suppkey AS outcome FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem)",
    "event_conversion": f"""WITH e AS (SELECT event_id AS id, event_type AS k, user_id, props, {_SIG('Signup(uint256,string)')} AS s, {_SIG('Purchase(string,uint256)')} AS p, {_SIG('Click(string)')} AS c FROM events WHERE event_type IN ('signup', 'purchase', 'click', 'error'))
        SELECT id, CASE k WHEN 'signup' THEN s || ',' || lpad(lower(to_hex(user_id)), 64, '0') WHEN 'purchase' THEN p || ',' || {T.keccak("'7075726368617365'")} WHEN 'click' THEN c || ',' || {T.keccak("lower(hex('s' || CAST(user_id AS VARCHAR)))")} || ',' || {T.keccak("lower(hex('0x' || substr(sha256(CAST(user_id AS VARCHAR)), 1, 40)))")} END AS topics,
        CASE k WHEN 'signup' THEN lpad('20', 64, '0') || lpad(lower(to_hex(length(props))), 64, '0') || rpad(lower(hex(props)), CAST(64 * ((length(props) + 31) // 32) AS INTEGER), '0') WHEN 'purchase' THEN lpad(lower(to_hex(id * 3)), 64, '0') WHEN 'click' THEN '' END AS data,
        CASE k WHEN 'signup' THEN '[' || CAST(to_json(props) AS VARCHAR) || ']' WHEN 'purchase' THEN '[' || CAST(id * 3 AS VARCHAR) || ']' WHEN 'click' THEN '[]' END AS values, CASE k WHEN 'error' THEN 'attribute missing not found' END AS error FROM e""",
    "log_decoding": "SELECT event_id, upper(substr(event_type, 1, 1)) || substr(event_type, 2) AS name FROM events WHERE event_type IN ('signup', 'purchase', 'click', 'error')",
    "events_as_dicts": "SELECT user_id, event_type AS type, CAST(max(event_id) AS VARCHAR) AS id, arg_max(props, event_id) AS props FROM events GROUP BY 1, 2",
    "token_reshape": "SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS amount, p_brand AS base, CASE WHEN p_partkey % 2 = 0 THEN h ELSE h || '/' || h END AS path FROM (SELECT *, 'transfer/channel-' || CAST(p_size AS VARCHAR) AS h FROM part)",
    "trace_vouchers": """WITH h AS (SELECT p_partkey, p_brand, CASE WHEN p_partkey % 3 = 0 THEN ['channel-0'] WHEN p_size % 5 = 2 THEN ['channel-9'] ELSE ['channel-0', 'channel-' || CAST(p_size % 5 AS VARCHAR), 'channel-9'] END AS n FROM part)
        SELECT p_partkey, array_to_string(n, ',') AS hops, 'ibc/' || upper(sha256(array_to_string(list_transform(n, lambda x: 'transfer/' || x), '/') || '/' || p_brand)) AS voucher FROM h""",
    "voucher_channels": "SELECT p_partkey, CASE WHEN p_partkey % 3 <> 0 AND p_name IN (SELECT p_name FROM part WHERE p_partkey % 2 = 0) THEN 'channel-' || CAST(length(p_name) AS VARCHAR) END AS channel FROM part",
    "log_handling": f"""WITH {_HANDLED} SELECT seq, CASE k WHEN 0 THEN 'to_account' WHEN 1 THEN 'to_ibc' WHEN 2 THEN 'to_ibc_v2' ELSE 'native_to_ibc' END AS handler, outcome, CASE WHEN outcome = 'ok' THEN CASE WHEN k = 0 THEN contract ELSE owner END END AS sender,
        CASE WHEN outcome = 'ok' AND k = 0 THEN owner END AS to_account, CASE WHEN outcome = 'ok' AND k <> 0 THEN c_name END AS to_ibc, CASE WHEN outcome = 'ok' THEN CAST(seq * 1000000000 AS VARCHAR) END AS amount,
        CASE WHEN outcome = 'ok' THEN CASE WHEN k = 2 THEN 'channel-' || CAST(c_nationkey AS VARCHAR) ELSE '' END END AS channel, CASE WHEN outcome = 'ok' THEN denom END AS denom FROM x""",
    "log_balances": f"""WITH {_HANDLED}, o AS (SELECT *, seq * 1000000000 AS amount, k IN (1, 2) AND starts_with(denom, 'source0x') AS minted FROM x WHERE outcome = 'ok'),
        e AS (SELECT contract AS address, denom, -amount AS d FROM o WHERE NOT minted UNION ALL SELECT owner, denom, amount FROM o WHERE k = 0 UNION ALL SELECT 'transfer', denom, amount FROM o WHERE k <> 0)
        SELECT address, denom, CAST(CAST(sum(d) AS HUGEINT) AS VARCHAR) AS amount FROM e GROUP BY 1, 2 HAVING sum(d) <> 0""",
    "bank_outcomes": """WITH c AS (SELECT o_orderkey AS seq, o_orderkey % 6 AS k, o_custkey, substr(sha256(CAST(o_custkey AS VARCHAR)), 1, 40) AS a, substr(sha256(CAST(o_custkey + 1 AS VARCHAR)), 1, 40) AS b, CAST(floor(o_totalprice) AS BIGINT) AS n, o_orderkey % 50 = 3 AS ro FROM orders),
        l AS (SELECT c_custkey AS id FROM customer WHERE c_custkey % 31 = 5)
        SELECT seq, CASE WHEN k IN (0, 5) THEN 'mint' WHEN k = 1 THEN 'burn' WHEN k = 2 THEN 'balanceOf' WHEN k = 3 THEN 'transfer' END AS op, CASE WHEN k IN (1, 3) THEN a END AS sender, CASE WHEN k IN (0, 2, 5) THEN a WHEN k = 3 THEN b END AS receiver,
        CASE WHEN k IN (0, 1, 3) THEN CAST(n AS VARCHAR) WHEN k = 5 THEN '0' END AS amount,
        CASE WHEN k = 4 THEN 'unknown method' WHEN k <> 2 AND ro THEN 'not readonly' WHEN k = 5 THEN 'invalid amount' WHEN k IN (0, 1) AND o_custkey IN (SELECT id FROM l) OR k = 3 AND o_custkey + 1 IN (SELECT id FROM l) THEN 'blocked address' ELSE 'ok' END AS outcome FROM c""",
    "token_guard": """WITH RECURSIVE o AS (SELECT o_orderkey AS seq, o_orderkey % 3 AS op, o_custkey % 40 AS token, CAST(o_custkey % 7 AS INTEGER) + 1 AS s, CAST((o_custkey + o_orderkey) % 7 AS INTEGER) + 1 AS r, CAST(floor(o_totalprice) AS HUGEINT) AS a,
            row_number() OVER (PARTITION BY o_custkey % 40 ORDER BY o_orderkey) AS i FROM orders),
        g AS (SELECT 0::BIGINT AS i, token, NULL::BIGINT AS seq, true AS accepted, [0, 0, 0, 0, 0, 0, 0]::HUGEINT[] AS b FROM (SELECT DISTINCT token FROM o)
            UNION ALL SELECT o.i, o.token, o.seq, o.op = 0 OR b[s] >= a,
                CASE WHEN o.op = 0 OR b[s] >= a THEN list_transform(range(1, 8), lambda k: b[k] - CASE WHEN o.op <> 0 AND k = s THEN a ELSE 0 END + CASE WHEN o.op <> 1 AND k = r THEN a ELSE 0 END) ELSE b END
            FROM g JOIN o ON o.token = g.token AND o.i = g.i + 1)
        SELECT seq, accepted FROM g WHERE seq IS NOT NULL""",
    "relayer_outcomes": f"""WITH c AS (SELECT o_orderkey AS seq, o_orderkey % 8 AS k, o_orderkey % 5 = 0 AS other, o_orderkey % 40 = 7 AS ro FROM orders), n AS (SELECT {T.let('ln', "length(" + T.bech32('acc', "repeat('0', 40)") + ")", 'ln')} AS t)
        SELECT seq, CASE WHEN k IN (4, 6) THEN NULL WHEN k = 3 THEN 'submitMisbehaviour' WHEN k = 5 THEN 'registerPayee' ELSE 'recvPacket' END AS method,
        CASE WHEN ro THEN 'not readonly' WHEN k = 6 THEN 'input too short' WHEN k = 4 THEN 'no such method' WHEN k = 5 THEN 'bad arguments' WHEN k = 3 THEN 'unknown method' WHEN k = 2 THEN 'bad message' WHEN k = 1 THEN 'not one signer' WHEN other THEN 'not authenticated' ELSE 'ok' END AS outcome,
        CAST(CASE WHEN k IN (4, 5, 6) THEN NULL WHEN k = 1 THEN 2 * (t + 2) WHEN k = 2 THEN 2 ELSE t + 4 END AS INTEGER) AS payload_bytes FROM c, n""",
    "ica_outcomes": f"""WITH c AS (SELECT o_orderkey AS seq, o_orderkey % 4 AS k, {T.bech32('acc', 'substr(sha256(CAST(o_custkey % 50 AS VARCHAR)), 1, 40)')} AS owner, CASE WHEN o_orderkey % 3 = 0 THEN 'connection-0' ELSE 'connection-1' END AS link, o_orderkey % 100 < 10 AS ro FROM orders),
        j AS (SELECT *, CASE WHEN k = 3 THEN 'no such method' WHEN k <> 1 AND ro THEN 'not readonly' ELSE 'ok' END AS outcome FROM c)
        SELECT seq, CASE k WHEN 0 THEN 'registerAccount' WHEN 1 THEN 'queryAccount' WHEN 2 THEN 'submitMsgs' END AS method, owner, CASE WHEN k < 3 THEN link END AS connection, CASE WHEN k = 0 THEN 'v1' END AS version, CASE WHEN k = 0 THEN 1 END AS ordering,
        CASE WHEN k = 2 THEN CAST(seq AS VARCHAR) END AS timeout, CASE WHEN k = 2 THEN '{{"src_callback": {{"address": "' || owner || '"}}}}' END AS memo,
        CASE WHEN k = 2 AND outcome = 'ok' THEN count(*) FILTER (k = 2 AND outcome = 'ok') OVER (PARTITION BY owner, CASE WHEN k < 3 THEN link END ORDER BY seq) END AS sequence, outcome FROM j""",
    "coin_checks": "SELECT c_custkey AS id, CASE WHEN c_custkey % 3 <> 1 THEN 'invalid address' ELSE 'invalid coins' END AS error FROM customer WHERE c_custkey % 3 <> 1 OR c_custkey % 4 <> 0",
    "parameter_checks": """SELECT * FROM (VALUES ('ibc_denom', 'ibc/x', 'invalid ibc_denom'), ('ibc_timeout', '0', 'invalid ibc_timeout'), ('ibc_timeout', '18446744073709551616', 'invalid ibc_timeout'), ('max_callback_gas', '-1', 'invalid max_callback_gas'),
        ('enable_auto_deployment', 'yes', 'invalid enable_auto_deployment'), ('admin', 'nobody', 'invalid admin'), ('other', '1', 'invalid other'), ('ibc_denom', NULL, 'invalid ibc_denom')) AS t(name, value, error)""",
    "block_stats_report": f"""WITH {_BLOCKS_SQL}, t AS (SELECT height, gas_used AS n, CASE WHEN height - first_value(height) OVER w <= 0 THEN 0.0 ELSE CAST(sum(gas_used) OVER w - first_value(gas_used) OVER w AS DOUBLE) / ((height - first_value(height) OVER w) * 86400.0) END AS tps
            FROM b WINDOW w AS (ORDER BY height ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
        SELECT 'block ' || CAST(height AS VARCHAR) || ' ' || strftime(to_timestamp(height * 86400) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') || ' ' || CAST(n AS VARCHAR) || ' ' || printf('%.2f', tps) AS line FROM t
        UNION ALL SELECT 'top_tps ' || string_agg(printf('%.2f', tps), ', ' ORDER BY tps DESC) FROM (SELECT tps FROM t ORDER BY tps DESC, height LIMIT 5)""",
    "output_files": """SELECT node, path FROM (SELECT 'node' || CAST(c_nationkey AS VARCHAR) AS node, '/data/' || CASE c_custkey % 3 WHEN 0 THEN 'state.db/' WHEN 1 THEN 'other.db/' ELSE 'log/' END || CAST(c_custkey AS VARCHAR) AS path, c_custkey % 3 AS k FROM customer) WHERE k <> 0 OR node IN ('node0', 'node7')""",
    "governance_tally": """WITH v AS (SELECT o_custkey % 3 AS proposal, o_custkey AS voter, arg_max(o_orderstatus, o_orderkey) AS option FROM orders GROUP BY 1, 2)
        SELECT proposal, option, CAST(sum(c_nationkey) AS BIGINT) AS power FROM v JOIN customer ON voter = c_custkey AND c_custkey % 4 <> 1 GROUP BY 1, 2""",
}
