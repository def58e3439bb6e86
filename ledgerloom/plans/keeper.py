"""Keeper queries: mapping and state updates, messages, conversions, versions and change sets, driver-side documents."""

from __future__ import annotations

import json

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import encoding as X
from ..functions import proto
from ..functions.denoms import Denoms
from ..operators import changesets as V
from ..operators import checks as H
from ..operators import ledger as L
from ..operators import lookups as K
from ..operators import messages as G
from ..operators import migrate as M
from ..operators import patch as P
from ..functions.keys import parse_heights
from ..sources import stores as Q
from ..streaming import streams as S
from . import twins as T
from .codecs import _address, with_tx_result
from .stores import _PERTURBED_SQL, _perturbed
from .tables import day, local_rows, table

DENOMS = Denoms("source")


# ------------------------------------------------------------------ mappings


def _mapping_tables(spark, sf_dir):
    """Even nations have an external contract, those that three divides an auto one; with the reverse rows."""
    n = table(spark, sf_dir, "nation")
    external = n.where("n_nationkey % 2 = 0").select(F.col("n_name").alias("denom"), F.lit("external").alias("kind"), _address("n_name").alias("contract"))
    auto = n.where("n_nationkey % 3 = 0").select(F.col("n_name").alias("denom"), F.lit("auto").alias("kind"), _address(F.concat(F.lit("a"), "n_name")).alias("contract"))
    maps = external.union(auto)
    return maps, maps.select("contract", "denom")


def _both(maps, back):
    shown = lambda c: F.lower(F.hex(c))
    return maps.select("denom", "kind", shown("contract").alias("contract")).union(back.select("denom", F.lit("reverse").alias("kind"), shown("contract").alias("contract")))


def set_external_mapping(spark, sf_dir):
    """A new external contract for a denomination that has both kinds: its old external reverse row goes."""
    return _both(*K.set_external(*_mapping_tables(spark, sf_dir), "NATION_6", bytes(range(20))))


def set_auto_mapping(spark, sf_dir):
    """A new auto contract: nothing of the old one goes but its mapping."""
    return _both(*K.set_auto(*_mapping_tables(spark, sf_dir), "NATION_6", bytes(range(20))))


def delete_mapping(spark, sf_dir):
    return _both(*K.delete_external(*_mapping_tables(spark, sf_dir), "NATION_6"))


def update_mappings(spark, sf_dir):
    """Proposals in order: one registers, one deletes; a contract that is mapped already is refused."""
    maps, back = K.update_mapping(*_mapping_tables(spark, sf_dir), "NATION_1", bytes(range(20)))
    maps, back = K.update_mapping(maps, back, "NATION_4", None)
    try:
        maps, back = K.update_mapping(maps, back, "NATION_8", bytes(range(20)))
    except ValueError:
        pass
    return _both(maps, back)


def shown_mappings(spark, sf_dir):
    """Prefix iteration of a kind, as it is shown; and both contracts of every nation, the external one preferred."""
    maps, _ = _mapping_tables(spark, sf_dir)
    listed = K.show_mapping(K.of_kind(maps, "external")).select("denom", "contract", F.lit("listed").alias("how"))
    known = table(spark, sf_dir, "nation").where("n_nationkey % 2 = 0 or n_nationkey % 3 = 0").select(F.col("n_name").alias("denom"))
    preferred = K.contract_by_denom(known, maps).select("denom", F.concat(F.lit("0x"), F.lower(F.hex("contract"))).alias("contract"), F.lit("preferred").alias("how"))
    return listed.union(preferred)


def nested_commit(spark, sf_dir):
    """A step whose result has a problem leaves the table as it was; another one stands."""
    state = table(spark, sf_dir, "supplier").select("s_suppkey", F.floor("s_acctbal").cast("long").alias("balance"))
    spend = lambda n: lambda t: t.withColumn("balance", F.col("balance") - n)
    bad = lambda t: t.where("balance < -100000")
    one, ok = K.try_commit(state, spend(10), bad)
    two, not_ok = K.try_commit(one, spend(10**6), bad)
    return two.select("s_suppkey", "balance", F.lit(ok).alias("first"), F.lit(not_ok).alias("second"))


def key_listing(spark, sf_dir):
    """Keys of a prefix with their addresses as text, and validators in descending key order."""
    keys = table(spark, sf_dir, "supplier").select(X.to_bech32(_address("s_name"), "acc").alias("address"), F.col("s_name").alias("key"), F.col("s_nationkey").cast("long").alias("place"))
    store = table(spark, sf_dir, "nation").select(F.col("n_name").cast("binary").alias("key"), F.col("n_nationkey").alias("value"))
    down = M.scan(store, ordered=True, descending=True).withColumn("place", F.row_number().over(Window.orderBy(F.desc("key"))).cast("long"))
    return keys.union(down.select(F.lit("validator").alias("address"), F.col("key").cast("string").alias("key"), "place"))


# ------------------------------------------------------------------ messages, upgrades, generators


def _messages(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    kinds = [*G.SETS, "other"]
    kind = F.element_at(F.array(*[F.lit(k) for k in kinds]), (F.col("o_orderkey") % len(kinds) + 1).cast("int"))
    sender = F.when(F.col("o_custkey") % 4 == 0, "admin").when(F.col("o_custkey") % 4 == 1, "gov").otherwise(F.col("o_custkey").cast("string"))
    key = F.when(F.col("o_orderkey") % 2 == 0, sender).otherwise((F.col("o_custkey") % 20).cast("string"))
    return o.select(F.col("o_orderkey").alias("seq"), kind.alias("kind"), sender.alias("sender"), key.alias("key"), F.when(F.col("o_orderkey") % 5 == 0, "").otherwise(F.col("o_orderkey").cast("string")).alias("value"))


def _judged(spark, sf_dir):
    held = table(spark, sf_dir, "customer").where("c_custkey % 4 = 2").select(F.col("c_custkey").cast("string").alias("address"), (F.col("c_custkey") % 8).cast("long").alias("permissions"))
    return G.authorised(_messages(spark, sf_dir), held, authority="gov", admin="admin")


def message_authority(spark, sf_dir):
    """Who may send what."""
    return _judged(spark, sf_dir).select("seq", "kind", "sender", "outcome")


def message_state(spark, sf_dir):
    """Keeper state after all accepted messages."""
    start = local_rows(spark, [("params", "0", "start"), ("mapping", "1", "start"), ("key", "none", "start")], "kind string, key string, value string")
    return G.apply_messages(start, _judged(spark, sf_dir))


def preinstalled_contracts(spark, sf_dir):
    """Accounts after an upgrade that puts contracts at new addresses and at accounts without code."""
    accounts = table(spark, sf_dir, "supplier").select(_address("s_name").alias("address"), F.col("s_suppkey").alias("nonce"), F.when(F.col("s_suppkey") % 2 == 0, F.lit(b"\x60")).alias("code"))
    contracts = table(spark, sf_dir, "supplier").where("s_suppkey % 2 = 1 and s_suppkey < 20").select(_address("s_name").alias("address"), F.lit(b"\x61").alias("code"))
    contracts = contracts.union(spark.range(1).select(F.lit(bytes(range(20))), F.lit(b"\x62")))
    out = G.preinstall(accounts, contracts)
    return out.select(F.lower(F.hex("address")).alias("address"), "nonce", F.hex("code").alias("code"))


def generated_updates(spark, sf_dir):
    return G.mapping_updates(spark, 500, seed="s", accounts=["a", "b", "c"], admin="admin")


def state_pairs_shown(spark, sf_dir):
    """State pairs by the first byte of their key."""
    kind = (F.col("n_nationkey") % 6 + 1).cast("int")
    key = F.concat(F.unhex(F.lpad(F.hex(kind), 2, "0")), F.col("n_name").cast("binary"))
    pairs = table(spark, sf_dir, "nation").select(key.alias("key"), F.concat(F.lit("v"), "n_name").cast("binary").alias("value"))
    return H.decode_pairs(pairs).select("kind", "name", "shown")


# ------------------------------------------------------------------ conversions


def _vouchers(spark, sf_dir):
    """An order is a voucher of its customer: base coins, coins with and without a contract, and junk."""
    kind = F.col("o_orderkey") % 5
    hexed = F.substring(F.sha2((F.col("o_custkey") % 9).cast("string"), 256), 1, 40)
    denom = F.when(kind == 0, "base").when(kind == 1, F.concat(F.lit("ibc/"), F.sha2((F.col("o_custkey") % 9).cast("string"), 256))).when(kind == 2, F.concat(F.lit("source0x"), hexed)).when(kind == 3, F.concat(F.lit("gravity0x"), hexed)).otherwise("junk")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("seq"), (F.col("o_custkey") % 50).cast("string").alias("address"), denom.alias("denom"), F.floor("o_totalprice").cast("decimal(38,0)").alias("amount"))


def auto_deployed_conversions(spark, sf_dir):
    """Vouchers converted, with a contract made for every valid denomination that has none."""
    maps = local_rows(spark, [("ibc/" + "0" * 64, "external", "x")], "denom string, kind string, contract string")
    coins, made = L.with_deployments(_vouchers(spark, sf_dir), maps, DENOMS, auto_deploy=True, new_contract=F.concat(F.lit("c"), F.substring(F.sha2("denom", 256), 1, 6)))
    entries, rejected = L.vouchers_to_evm(coins, base_denom="base", evm_denom="evm", denoms=DENOMS)
    out = L.balances(entries).select("address", "denom", F.col("amount").cast("string").alias("amount"))
    out = out.union(made.select(F.lit("new").alias("address"), "denom", F.col("contract").alias("amount")))
    return out.union(rejected.groupBy(F.lit("rejected").alias("address"), "denom").agg(F.count("*").cast("string").alias("amount")))


def outgoing_transfers(spark, sf_dir):
    """EVM coins burnt down to eight decimals, other coins sent as they are, unknown ones refused."""
    coins = _vouchers(spark, sf_dir).withColumn("denom", F.when(F.col("denom") == "base", "evm").otherwise(F.col("denom"))).withColumn("amount", F.when(F.col("denom") == "evm", F.col("amount") * F.lit(123456789).cast("decimal(12,0)")).otherwise(F.col("amount")).cast("decimal(38,0)"))
    entries, rejected = L.transfer_out(coins, base_denom="base", evm_denom="evm", denoms=DENOMS)
    out = L.balances(entries).select("address", "denom", F.col("amount").cast("string").alias("amount"))
    return out.union(rejected.groupBy(F.lit("rejected").alias("address"), "denom").agg(F.count("*").cast("string").alias("amount")))


def returned_tokens(spark, sf_dir):
    """Tokens back to native coins: minted for source coins, released by the contract for others."""
    coins = _vouchers(spark, sf_dir).where("denom <> 'junk' and denom <> 'base'")
    move = L.token_to_native(F.col("address"), F.col("denom"), F.col("amount"), F.lit("contract"), F.lit("token"), DENOMS)
    return L.balances(L._entries(coins, move)).select("address", "denom", F.col("amount").cast("string").alias("amount"))


def packet_conversions(spark, sf_dir):
    """IBC packets credit the receiver, or the sender on a failure; coins with a contract become tokens."""
    hop = lambda c: F.struct(F.lit("transfer").alias("port"), c.alias("channel"))
    kind = F.when(F.col("o_orderkey") % 3 == 0, "receive").when(F.col("o_orderkey") % 3 == 1, "acknowledgement").otherwise("timeout")
    packets = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seq"), kind.alias("kind"), (F.col("o_orderkey") % 2 == 0).alias("success"), F.lit("basecoin").alias("base"),
        F.when(F.col("o_orderkey") % 4 == 0, F.array(hop(F.lit("channel-1")))).otherwise(F.array(hop(F.lit("channel-2")), hop(F.lit("channel-3")))).alias("trace"),
        F.lit("transfer").alias("source_port"), F.lit("channel-1").alias("source_channel"), F.lit("transfer").alias("port"), F.lit("channel-0").alias("channel"),
        F.concat(F.lit("s"), (F.col("o_custkey") % 30).cast("string")).alias("sender"), F.concat(F.lit("r"), (F.col("o_custkey") % 30).cast("string")).alias("receiver"), F.floor("o_totalprice").cast("long").alias("amount"),
    )
    voucher = lambda path: "ibc/" + __import__("hashlib").sha256(path.encode()).hexdigest().upper()
    maps = local_rows(spark, [(voucher("transfer/channel-2/transfer/channel-3/basecoin"), "external", "c23")], "denom string, kind string, contract string")
    entries, _ = S.converted_packets(packets, maps, base_denom="basecoin", evm_denom="evm", denoms=DENOMS)
    return L.balances(entries).select("address", "denom", F.col("amount").cast("string").alias("amount"))


# ------------------------------------------------------------------ versions, change sets, stores


def _states(spark, sf_dir):
    """Each user's last event as a store row per version; errors delete."""
    value = F.when(F.col("event_type") != "error", F.concat(F.col("event_type"), F.col("event_id").cast("string"))).cast("binary")
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("version"), F.when(F.col("user_id") % 2 == 0, "bank").otherwise("evm").alias("store"), F.col("user_id").cast("string").cast("binary").alias("key"), value.alias("value"))


def changeset_dump(spark, sf_dir):
    """Change sets of a versioned table; what does not change a value is no change."""
    out = V.dump(_states(spark, sf_dir))
    return out.select("version", "store", F.col("position").cast("long").alias("position"), "deleted", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def changeset_build(spark, sf_dir):
    """The state that change sets come to at a version, written and read back."""
    from .streams import _work

    out = V.restore(spark, V.dump(_states(spark, sf_dir)), f"{_work(spark)}/restored", 3000)
    return out.select("store", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def changeset_verify(spark, sf_dir):
    """Whether change sets come to a state, store by store: one row of one store is wrong."""
    changes = V.dump(_states(spark, sf_dir))
    state = V.build(changes)
    wrong = state.withColumn("value", F.when((F.col("store") == "evm") & (F.col("key") == F.lit(b"1")), F.lit(b"x")).otherwise(F.col("value")))
    return V.verify(changes, state).withColumn("state", F.lit("right")).union(V.verify(changes, wrong).withColumn("state", F.lit("wrong")))


def wal_replay(spark, sf_dir):
    """State after replaying change sets batch by batch, stores renamed and dropped by upgrades between."""
    changes = V.dump(_states(spark, sf_dir))
    state = None
    for low, high in ((-1, 1000), (1000, 4000), (4000, 1 << 40)):
        state = S.replay_changes(state, changes.where((F.col("version") > low) & (F.col("version") <= high)), ["store", "key"], ["version", "position"])
    state = K.apply_upgrades(state.select("store", "key", "value"), [{"name": "ledger", "rename_from": "bank"}, {"name": "evm", "delete": True}, {"name": "new"}])
    return state.select("store", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def exploded_changes(spark, sf_dir):
    """Pairs of logged change sets in order."""
    pair = F.struct((F.col("event_type") == "error").alias("delete"), F.col("user_id").cast("string").alias("key"), F.col("event_type").alias("value"))
    wal = table(spark, sf_dir, "events").groupBy(F.floor(F.col("event_id") / 10).alias("version")).agg(F.transform(F.array_sort(F.collect_list(F.struct("event_id", pair.alias("p")))), lambda x: x["p"]).alias("pairs")).withColumn("name", F.lit("bank"))
    return K.explode_changes(wal)


def pruned_versions(spark, sf_dir):
    """Retention: the last thousand heights, and of older ones what is still in force."""
    rows = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("version"))
    return H.prune(rows, 1000, ["user_id"])


def store_snapshot(spark, sf_dir):
    """A snapshot's chunks hold every row once; the node's status beside it."""
    from .streams import _work

    state = V.build(V.dump(_states(spark, sf_dir)))
    manifest = V.snapshot(state, f"{_work(spark)}/snapshot", 7, chunks=4)
    blocks = table(spark, sf_dir, "orders").select(day("o_orderdate").alias("height"), F.col("o_orderdate").alias("ts"))
    total = manifest.groupBy("version").agg(F.sum("n").alias("n"), F.count("*").alias("chunks")).select(F.lit("snapshot").alias("what"), F.col("version").alias("a"), "n", F.col("chunks").alias("z"))
    return total.union(V.status(blocks).select(F.lit("status").alias("what"), F.col("earliest").alias("a"), F.col("missing").alias("n"), F.col("latest").alias("z")))


def store_differences(spark, sf_dir):
    """Rows of two stores that differ or that one lacks; keys under an ignored prefix are left out."""
    part = lambda df: df.select(F.when(F.col("key") % 2 == 0, "even").otherwise("odd").alias("store"), F.col("key").cast("string").cast("binary").alias("key"), "value")
    a, b = _perturbed(spark, sf_dir)
    out = M.store_diff(part(a), part(b), {"even": [b"1", b"-"]})
    return out.select("store", F.col("key").cast("string").alias("key"), "a", "b")


def copy_errors(spark, sf_dir):
    """A copy counts the rows that a store refuses, and goes on."""
    empty, none = F.col("o_orderkey") % 50 == 3, F.col("o_orderkey") % 70 == 5
    store = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("db"), F.when(empty, F.lit(b"")).otherwise(F.col("o_orderkey").cast("string").cast("binary")).alias("key"), F.when(~none, F.col("o_orderpriority").cast("binary")).alias("value"))
    return M.copy_stats(store, "db")


# ------------------------------------------------------------------ patches on the operators themselves


def _tx_index(spark, sf_dir):
    """A transaction index of the orders: height keys, results by hash, and event keys of EVM transactions."""
    o = table(spark, sf_dir, "orders").select("*", F.col("o_orderkey").alias("h"), (F.col("o_custkey") % 12).alias("i"), F.sha2(F.col("o_orderkey").cast("string"), 256).alias("digest"), (F.col("o_orderkey") % 2 == 0).alias("evm"))
    text = lambda *parts: F.concat(*[p.cast("string") if not isinstance(p, str) else F.lit(p) for p in parts])
    h, i = F.col("h"), F.col("i")
    name = text("hash-", h)
    row = lambda k, v: F.struct(k.alias("key_text"), v.cast("binary").alias("value"))
    o = with_tx_result(o, h, i, F.concat(F.lit("0x"), F.col("digest")), F.col("evm"), "result")
    event = lambda tail: text("ethereum_tx.ethereumTxHash/0x", F.col("digest"), "/", h, "/", i, tail)
    rows = F.array(row(text("tx.height/", h, "/", h, "/", i), name), F.struct(name.alias("key_text"), F.col("result").alias("value")))
    rows = F.when(F.col("evm"), F.concat(rows, F.array(row(event(""), name), row(event("$es$0"), name), row(event("7"), name)))).otherwise(rows)
    kv = o.select(F.explode(rows).alias("r")).select("r.*")
    return kv.select(F.col("key_text").cast("binary").alias("key"), "key_text", "value")


def patch_tx_index(spark, sf_dir):
    """The three passes of a height-filtered patch, keys by family."""
    out = P.patch_txs(_tx_index(spark, sf_dir), parse_heights("100-400"))
    return out.rows.select("key_text", "family")


def patch_tx_skip(spark, sf_dir):
    """A patch that skips what is there: a key that pass 1 skips reaches neither other pass."""
    source = _tx_index(spark, sf_dir)
    target = source.where("key_text like 'tx.height/%' and key_text like '%0/%'")
    out = P.patch_txs(source, parse_heights("100-400"), target, "skip")
    return out.rows.groupBy("family").agg(F.count("*").alias("n")).union(out.total.select(F.lit("total"), "total"))


def patch_block_store(spark, sf_dir):
    """Block-store keys of heights with the hash index of every header."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("h"), F.unhex(F.sha2(F.col("o_orderkey").cast("string"), 256)).alias("hash"))
    meta = F.concat(F.lit(bytes([0x0A, 0x22, 0x0A, 0x20])), F.col("hash"), F.lit(bytes([0x12, 0])))
    text = lambda p, tail="": F.concat(F.lit(p), F.col("h").cast("string"), F.lit(tail))
    row = lambda k, v: F.struct(k.cast("binary").alias("key"), k.alias("key_text"), v.alias("value"))
    by_hash = F.struct(F.concat(F.lit(b"BH:"), F.col("hash")).alias("key"), F.concat(F.lit("BH:"), F.lower(F.hex("hash"))).alias("key_text"), F.col("h").cast("string").cast("binary").alias("value"))
    store = o.select(F.explode(F.array(row(text("H:"), meta), row(text("P:", ":0"), meta), row(text("C:"), meta), row(text("SC:"), meta), row(text("EC:"), meta), by_hash)).alias("r")).select("r.*")
    out = P.patch_blocks(store, parse_heights("7, 77, 777"))
    return out.rows.select("key_text", "family")


# ------------------------------------------------------------------ documents (driver side)


def merged_genesis(spark, sf_dir):
    """Documents merged by key: lists join, nested documents merge, other values are overwritten; and a patched configuration."""
    base, more = {"accounts": [1], "app": {"bank": {"balances": ["a"]}, "n": 1}, "x": 1}, {"accounts": [2, 3], "app": {"bank": {"balances": ["b"]}, "n": 2}, "y": None}
    shown = lambda d: json.dumps(d, sort_keys=True)
    return local_rows(spark, [("merged", shown(Q.merge_genesis(base, more))), ("patched", shown(Q.patch_config(base, more)))], "what string, document string")


QUERIES = {f.__name__: f for f in (
    set_external_mapping, set_auto_mapping, delete_mapping, update_mappings, shown_mappings, nested_commit, key_listing, message_authority, message_state, preinstalled_contracts, generated_updates,
    state_pairs_shown, auto_deployed_conversions, outgoing_transfers, returned_tokens, packet_conversions, changeset_dump, changeset_build, changeset_verify, wal_replay, exploded_changes, pruned_versions,
    store_snapshot, store_differences, copy_errors, patch_tx_index, patch_tx_skip, patch_block_store, merged_genesis,
)}

_SHORT = "substr(sha256({}), 1, 40)"
_NEW = "".join(f"{i:02x}" for i in range(20))
_MAPS = f"""m AS (SELECT n_name AS denom, 'external' AS kind, {_SHORT.format('n_name')} AS contract FROM nation WHERE n_nationkey % 2 = 0 UNION ALL SELECT n_name, 'auto', {_SHORT.format("'a' || n_name")} FROM nation WHERE n_nationkey % 3 = 0)"""
_REVERSED = "UNION ALL SELECT denom, 'reverse', contract FROM"
_MESSAGES = """g AS (SELECT o_orderkey AS seq, ['update_params', 'update_permissions', 'store_block_list', 'update_token_mapping', 'register_key', 'turn_bridge', 'other'][o_orderkey % 7 + 1] AS kind, o_custkey,
        CASE o_custkey % 4 WHEN 0 THEN 'admin' WHEN 1 THEN 'gov' ELSE CAST(o_custkey AS VARCHAR) END AS sender, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS value FROM orders),
    h AS (SELECT *, CASE WHEN seq % 2 = 0 THEN sender ELSE CAST(o_custkey % 20 AS VARCHAR) END AS key FROM g),
    j AS (SELECT *, CASE WHEN kind = 'other' THEN 'unknown' WHEN kind = 'turn_bridge' OR kind = 'update_params' AND sender = 'gov' OR kind IN ('update_permissions', 'store_block_list', 'update_token_mapping') AND sender = 'admin' OR kind = 'register_key' AND sender = key
        OR kind = 'update_token_mapping' AND o_custkey % 4 = 2 AND o_custkey % 8 & 1 = 1 AND o_custkey IN (SELECT c_custkey FROM customer) THEN 'ok' ELSE 'unauthorised' END AS outcome FROM h)"""
_VOUCHERS = f"""v AS (SELECT o_orderkey AS seq, CAST(o_custkey % 50 AS VARCHAR) AS address, CASE o_orderkey % 5 WHEN 0 THEN 'base' WHEN 1 THEN 'ibc/' || sha256(CAST(o_custkey % 9 AS VARCHAR)) WHEN 2 THEN 'source0x' || {_SHORT.format('CAST(o_custkey % 9 AS VARCHAR)')}
        WHEN 3 THEN 'gravity0x' || {_SHORT.format('CAST(o_custkey % 9 AS VARCHAR)')} ELSE 'junk' END AS denom, o_orderkey % 5 AS k, CAST(floor(o_totalprice) AS HUGEINT) AS n FROM orders)"""
_SUMMED = "SELECT address, denom, CAST(CAST(sum(d) AS HUGEINT) AS VARCHAR) AS amount FROM e GROUP BY 1, 2 HAVING sum(d) <> 0"
_REJECTED = "UNION ALL SELECT 'rejected', denom, CAST(count(*) AS VARCHAR) FROM v WHERE k = 4 GROUP BY 2"
_STATES = """s AS (SELECT event_id AS version, CASE WHEN user_id % 2 = 0 THEN 'bank' ELSE 'evm' END AS store, CAST(user_id AS VARCHAR) AS key, CASE WHEN event_type <> 'error' THEN event_type || CAST(event_id AS VARCHAR) END AS value FROM events)"""
_LAST = "SELECT store, key, max(version) AS version, arg_max(coalesce(value, ''), version) AS value FROM s {where} GROUP BY 1, 2"

ORACLES = {
    "set_external_mapping": f"WITH {_MAPS}, n AS (SELECT * FROM m WHERE NOT (denom = 'NATION_6' AND kind = 'external') UNION ALL SELECT 'NATION_6', 'external', '{_NEW}') SELECT * FROM n {_REVERSED} n",
    "set_auto_mapping": f"WITH {_MAPS}, n AS (SELECT * FROM m WHERE NOT (denom = 'NATION_6' AND kind = 'auto') UNION ALL SELECT 'NATION_6', 'auto', '{_NEW}'), r AS (SELECT * FROM m UNION ALL SELECT 'NATION_6', '', '{_NEW}') SELECT * FROM n {_REVERSED} r",
    "delete_mapping": f"WITH {_MAPS}, n AS (SELECT * FROM m WHERE NOT (denom = 'NATION_6' AND kind = 'external')) SELECT * FROM n {_REVERSED} n",
    "update_mappings": f"WITH {_MAPS}, n AS (SELECT * FROM m WHERE NOT (denom = 'NATION_4' AND kind = 'external') UNION ALL SELECT 'NATION_1', 'external', '{_NEW}') SELECT * FROM n {_REVERSED} n",
    "shown_mappings": f"WITH {_MAPS} SELECT denom, '0x' || contract AS contract, 'listed' AS how FROM m WHERE kind = 'external' UNION ALL SELECT denom, '0x' || arg_max(contract, kind), 'preferred' FROM m GROUP BY 1",
    "nested_commit": "SELECT s_suppkey, CAST(floor(s_acctbal) AS BIGINT) - 10 AS balance, true AS first, false AS second FROM supplier",
    "key_listing": f"SELECT {T.bech32('acc', _SHORT.format('s_name'))} AS address, s_name AS key, CAST(s_nationkey AS BIGINT) AS place FROM supplier UNION ALL SELECT 'validator', n_name, row_number() OVER (ORDER BY n_name DESC) FROM nation",
    "message_authority": f"WITH {_MESSAGES} SELECT seq, kind, sender, outcome FROM j",
    "message_state": f"""WITH {_MESSAGES}, o AS (SELECT CASE kind WHEN 'update_params' THEN 'params' WHEN 'update_permissions' THEN 'permissions' WHEN 'store_block_list' THEN 'block_list' WHEN 'update_token_mapping' THEN 'mapping' WHEN 'register_key' THEN 'key' END AS kind, key, value, seq FROM j WHERE outcome = 'ok' AND kind <> 'turn_bridge'
            UNION ALL SELECT * FROM (VALUES ('params', '0', 'start', -1), ('mapping', '1', 'start', -1), ('key', 'none', 'start', -1))), l AS (SELECT kind, key, arg_max(value, seq) AS value FROM o GROUP BY 1, 2)
        SELECT * FROM l WHERE NOT (kind IN ('mapping', 'block_list') AND value = '')""",
    "preinstalled_contracts": f"SELECT {_SHORT.format('s_name')} AS address, s_suppkey AS nonce, CASE WHEN s_suppkey % 2 = 0 THEN '60' WHEN s_suppkey < 20 THEN '61' END AS code FROM supplier UNION ALL SELECT '{_NEW}', 0, '62'",
    "generated_updates": """WITH d AS (SELECT range AS seq, sha256('s/' || CAST(range AS VARCHAR)) AS d FROM range(500))
        SELECT seq, 'update_token_mapping' AS kind, CASE WHEN CAST('0x' || substr(d, 1, 8) AS BIGINT) % 2 = 0 THEN 'admin' ELSE ['a', 'b', 'c'][CAST('0x' || substr(d, 9, 8) AS BIGINT) % 3 + 1] END AS sender, 'ibc/' || upper(sha256(d)) AS key, '0x' || substr(d, 17, 40) AS value FROM d""",
    "state_pairs_shown": """WITH k AS (SELECT n_name AS n, n_nationkey % 6 + 1 AS k FROM nation) SELECT CASE k WHEN 1 THEN 'external_contract' WHEN 2 THEN 'auto_contract' WHEN 3 THEN 'reverse_denom' WHEN 4 THEN 'permissions' WHEN 5 THEN 'block_list' ELSE 'unknown' END AS kind,
        CASE WHEN k < 3 THEN n ELSE '0x' || lower(hex(n)) END AS name, CASE WHEN k = 3 THEN 'v' || n ELSE '0x' || lower(hex('v' || n)) END AS shown FROM k""",
    "auto_deployed_conversions": f"""WITH {_VOUCHERS}, c AS (SELECT *, 'c' || substr(sha256(denom), 1, 6) AS c FROM v WHERE k < 4),
        e AS (SELECT address, denom, -n AS d FROM c UNION ALL SELECT 'module', denom, n FROM c WHERE k = 0 UNION ALL SELECT address, 'evm', n * 10000000000 FROM c WHERE k = 0 UNION ALL SELECT c, 'token/' || c, -n FROM c WHERE k = 2
            UNION ALL SELECT c, denom, n FROM c WHERE k IN (1, 3) UNION ALL SELECT address, 'token/' || c, n FROM c WHERE k > 0)
        {_SUMMED} UNION ALL SELECT DISTINCT 'new', denom, c FROM c WHERE k > 0 {_REJECTED}""",
    "outgoing_transfers": f"""WITH {_VOUCHERS}, c AS (SELECT address, k, denom, CASE WHEN k = 0 THEN n * 123456789 // 10000000000 * 10000000000 ELSE n END AS n FROM v WHERE k < 3),
        e AS (SELECT address, CASE WHEN k = 0 THEN 'evm' ELSE denom END AS denom, -n AS d FROM c UNION ALL SELECT 'module', 'base', -n // 10000000000 FROM c WHERE k = 0 UNION ALL SELECT 'transfer', denom, CASE WHEN k = 0 THEN n // 10000000000 ELSE n END FROM c)
        {_SUMMED} UNION ALL SELECT 'rejected', denom, CAST(count(*) AS VARCHAR) FROM v WHERE k > 2 GROUP BY 2""",
    "returned_tokens": f"""WITH {_VOUCHERS}, e AS (SELECT address, 'token' AS denom, -n AS d FROM v WHERE k IN (1, 2, 3) UNION ALL SELECT address, denom, n FROM v WHERE k IN (1, 2, 3) UNION ALL SELECT 'contract', 'token', n FROM v WHERE k = 2 UNION ALL SELECT 'contract', denom, -n FROM v WHERE k IN (1, 3)) {_SUMMED}""",
    "packet_conversions": f"""WITH p AS (SELECT o_orderkey % 3 AS k, o_orderkey % 2 = 0 AS ok, o_orderkey % 4 = 0 AS one, CAST(o_custkey % 30 AS VARCHAR) AS who, CAST(floor(o_totalprice) AS HUGEINT) AS n FROM orders),
        c AS (SELECT CASE WHEN k = 0 THEN 'r' ELSE 's' END || who AS address, CASE WHEN k = 0 AND one THEN 'basecoin' WHEN k <> 0 AND NOT one THEN 'ibc/' || upper(sha256('transfer/channel-2/transfer/channel-3/basecoin')) END AS denom, n FROM p WHERE k <> 1 OR NOT ok),
        e AS (SELECT address, denom, -n AS d FROM c WHERE denom IS NOT NULL UNION ALL SELECT 'module', denom, n FROM c WHERE denom = 'basecoin' UNION ALL SELECT address, 'evm', n * 10000000000 FROM c WHERE denom = 'basecoin'
            UNION ALL SELECT 'c23', denom, n FROM c WHERE denom <> 'basecoin' UNION ALL SELECT address, 'token/c23', n FROM c WHERE denom <> 'basecoin') {_SUMMED}""",
    "changeset_dump": f"""WITH {_STATES}, c AS (SELECT *, lag(value) OVER (PARTITION BY store, key ORDER BY version) AS b FROM s), d AS (SELECT * FROM c WHERE value IS DISTINCT FROM b)
        SELECT version, store, row_number() OVER (PARTITION BY version, store ORDER BY key) - 1 AS position, value IS NULL AS deleted, key, value FROM d""",
    "changeset_build": f"WITH {_STATES}, l AS ({_LAST.format(where='WHERE version <= 3000')}) SELECT store, key, value FROM l WHERE value <> ''",
    "changeset_verify": f"""WITH {_STATES}, l AS ({_LAST.format(where='')}), n AS (SELECT store, count(*) AS n, bool_or(key = '1') AS one FROM l WHERE value <> '' GROUP BY 1)
        SELECT store, n AS built, n AS found, true AS same, 'right' AS state FROM n UNION ALL SELECT store, n, n, NOT (store = 'evm' AND one), 'wrong' FROM n""",
    "wal_replay": f"WITH {_STATES}, l AS ({_LAST.format(where='')}) SELECT 'ledger' AS store, key, value FROM l WHERE value <> '' AND store = 'bank'",
    "exploded_changes": "SELECT event_id // 10 AS version, 'bank' AS store, CAST(row_number() OVER (PARTITION BY event_id // 10 ORDER BY event_id) - 1 AS INTEGER) AS position, event_type = 'error' AS deleted, CAST(user_id AS VARCHAR) AS key, event_type AS value FROM events",
    "pruned_versions": """WITH w AS (SELECT user_id, event_id AS version, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS later, (SELECT max(event_id) FROM events) - 1000 AS t FROM events)
        SELECT user_id, version FROM w WHERE version > t OR later IS NULL OR later > t""",
    "store_snapshot": f"""WITH {_STATES}, l AS ({_LAST.format(where='')}), d AS (SELECT date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS h FROM orders)
        SELECT 'snapshot' AS what, 7::BIGINT AS a, count(*) AS n, 4::BIGINT AS z FROM l WHERE value <> '' UNION ALL SELECT 'status', min(h), max(h) - min(h) + 1 - count(DISTINCT h), max(h) FROM d""",
    "store_differences": f"""WITH {_PERTURBED_SQL}, j AS (SELECT coalesce(s.key, t.key) AS k, s.value AS a, t.value AS b FROM src s FULL OUTER JOIN tgt t ON s.key = t.key), r AS (SELECT CASE WHEN k % 2 = 0 THEN 'even' ELSE 'odd' END AS store, CAST(k AS VARCHAR) AS key, a, b FROM j WHERE a IS DISTINCT FROM b)
        SELECT * FROM r WHERE NOT (store = 'even' AND (starts_with(key, '1') OR starts_with(key, '-')))""",
    "copy_errors": "SELECT o_orderstatus AS db, count(*) AS total, count(*) FILTER (NOT (o_orderkey % 50 = 3 OR o_orderkey % 70 = 5)) AS processed, count(*) FILTER (o_orderkey % 50 = 3 OR o_orderkey % 70 = 5) AS errors FROM orders GROUP BY 1",
    "patch_tx_index": """WITH o AS (SELECT CAST(o_orderkey AS VARCHAR) AS h, CAST(o_custkey % 12 AS VARCHAR) AS i, 'ethereum_tx.ethereumTxHash/0x' || sha256(CAST(o_orderkey AS VARCHAR)) || '/' || CAST(o_orderkey AS VARCHAR) || '/' || CAST(o_custkey % 12 AS VARCHAR) AS e, o_orderkey % 2 = 0 AS evm FROM orders WHERE o_orderkey BETWEEN 100 AND 400)
        SELECT 'tx.height/' || h || '/' || h || '/' || i AS key_text, 'height' AS family FROM o UNION ALL SELECT 'hash-' || h, 'result' FROM o UNION ALL SELECT e || unnest(['', '$es$0', '7']), 'eth_event' FROM o WHERE evm""",
    "patch_tx_skip": """WITH o AS (SELECT o_orderkey AS h, o_orderkey % 2 = 0 AS evm FROM orders WHERE o_orderkey BETWEEN 100 AND 400), f AS (SELECT * FROM o WHERE h % 10 <> 0)
        SELECT 'height' AS family, count(*) AS n FROM f UNION ALL SELECT 'result', count(*) FROM f UNION ALL SELECT 'eth_event', 3 * count(*) FILTER (evm) FROM f UNION ALL SELECT 'total', count(*) FROM o""",
    "patch_block_store": """WITH o AS (SELECT CAST(o_orderkey AS VARCHAR) AS h FROM orders WHERE o_orderkey IN (7, 77, 777)), p AS (SELECT h, unnest(['H', 'P', 'C', 'SC', 'EC']) AS f FROM o)
        SELECT f || ':' || h || CASE WHEN f = 'P' THEN ':0' ELSE '' END AS key_text, f AS family FROM p UNION ALL SELECT 'BH:' || sha256(h), 'BH' FROM o""",
    "merged_genesis": """SELECT * FROM (VALUES ('merged', '{"accounts": [1, 2, 3], "app": {"bank": {"balances": ["a", "b"]}, "n": 2}, "x": 1, "y": null}'), ('patched', '{"accounts": [2, 3], "app": {"bank": {"balances": ["b"]}, "n": 2}, "x": 1, "y": null}')) AS t(what, document)""",
}
