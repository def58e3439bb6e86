"""State queries: lookups, versions, permissions, block lists and ledgers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import amounts as A
from ..functions.denoms import Denoms, channel_name, display_symbol, snake_case
from ..operators import blocklist as B
from ..operators import ledger as L
from ..operators import lookups as K
from .tables import table

DENOMS = Denoms("source")


def _mappings(spark, sf_dir):
    """Nations as denominations: their least supplier is the external contract, their least customer the auto one."""
    least = lambda t, key, nation, kind: table(spark, sf_dir, t).groupBy(F.col(nation).alias("denom")).agg(F.min(key).alias("contract")).withColumn("kind", F.lit(kind))
    external = least("supplier", "s_suppkey", "s_nationkey", "external").where("denom % 3 <> 0")
    return external.union(least("customer", "c_custkey", "c_nationkey", "auto").where("denom % 5 <> 0")).select("denom", "kind", "contract")


_MAPPINGS_SQL = """
ext AS (SELECT s_nationkey AS denom, min(s_suppkey) AS contract FROM supplier WHERE s_nationkey % 3 <> 0 GROUP BY 1),
auto AS (SELECT c_nationkey AS denom, min(c_custkey) AS contract FROM customer WHERE c_nationkey % 5 <> 0 GROUP BY 1)"""


def denom_lookup_preferred(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("denom"))
    return K.contracts_of(nations, _mappings(spark, sf_dir))


def reverse_lookup(spark, sf_dir):
    reverse = _mappings(spark, sf_dir).select("contract", "denom")
    wanted = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("contract"))
    return K.denom_by_contract(wanted, reverse)


def mappings_of_kind(spark, sf_dir):
    return K.of_kind(_mappings(spark, sf_dir), "auto")


def _positional_lookup(spark, sf_dir, orders):
    asked = orders.select("o_orderkey", F.array(F.col("o_custkey"), F.col("o_custkey") + 1_000_000, F.col("o_custkey"), F.col("o_orderkey")).alias("addresses"))
    keys = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("address"), F.col("c_name").alias("key"))
    return K.keys_for(F.col("addresses"), asked, keys, "o_orderkey")


def positional_left_lookup(spark, sf_dir):
    """Names of a list of keys per order: order and duplicates stay, unknown keys are ''."""
    return _positional_lookup(spark, sf_dir, table(spark, sf_dir, "orders"))


def validators_with_keys(spark, sf_dir):
    validators = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("address"), F.col("s_nationkey").alias("power"))
    keys = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("address"), F.col("c_name").alias("key"))
    return K.with_key_flag(validators, keys)


def permission_mask(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    change, turn = K.show_permissions(F.col("p_size").cast("bigint"))
    return parts.select("p_partkey", change, turn, K.has_permission(F.col("p_size").cast("bigint"), 3).alias("has_all"))


def any_permission(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("request"), F.col("l_partkey").cast("string").alias("address"))
    held = table(spark, sf_dir, "part").where("p_partkey % 4 <> 0").select(F.col("p_partkey").cast("string").alias("address"), F.col("p_size").cast("bigint").alias("permissions"))
    return K.any_permission(line, held, 12, "17")


def upsert_last_wins(spark, sf_dir):
    state = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").cast("long").alias("v"))
    changes = table(spark, sf_dir, "orders").where("o_orderkey % 3 = 0").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("v"), F.col("o_orderkey").alias("seq"))
    return K.upsert(state, changes, "k", "seq")


def migration_default(spark, sf_dir):
    params = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") % 7).cast("long").alias("gas"))
    return K.fill_default(params, "gas", 50_000).select("p_partkey", F.col("gas").cast("long").alias("gas"))


def state_as_of(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("version"), "event_type")
    return K.as_of(rows, ["user_id"], 5000)


def changeset_fold(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("version"), "event_type", (F.col("event_type") == "error").alias("deleted"))
    return K.fold_changes(rows, ["user_id"], ["version"]).select("user_id", "version", "event_type")


def version_intervals(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("version"), (F.col("event_type") == "error").alias("deleted"))
    return K.running_state(rows, ["user_id"], "version").select("user_id", "version", "valid_to")


# ------------------------------------------------------------------ block lists


def _blocked(spark, sf_dir):
    return table(spark, sf_dir, "customer").where("c_custkey % 11 = 3").select(F.col("c_custkey").alias("o_custkey"))


def blocklist_semi(spark, sf_dir):
    return B.members(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), _blocked(spark, sf_dir), "o_custkey")


def blocklist_anti(spark, sf_dir):
    return B.non_members(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), _blocked(spark, sf_dir), "o_custkey")


def blocklist_except(spark, sf_dir):
    blocked = _blocked(spark, sf_dir).select(F.col("o_custkey").alias("address"))
    allowed = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("address"))
    return B.except_allowed(blocked, allowed)


def _proposals(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.datediff(F.to_date("o_orderdate"), F.lit("1970-01-01").cast("date")).cast("long").alias("block"), F.col("o_orderkey").alias("position"),
        F.array(F.col("o_custkey").cast("string")).alias("signers"), ((F.col("o_custkey") * 7) % 1500).cast("string").alias("to"),
        F.array().cast("array<string>").alias("authorities"), F.array().cast("array<string>").alias("targets"),
    )


def _block_list(spark, sf_dir):
    return table(spark, sf_dir, "customer").where("c_custkey % 97 = 3").select(F.col("c_custkey").cast("string").alias("address"))


def proposal_filter(spark, sf_dir):
    kept = B.filter_proposal(_proposals(spark, sf_dir), _block_list(spark, sf_dir))
    return kept.select("block", "position", F.col("new_position").cast("long").alias("new_position"))


def block_accept(spark, sf_dir):
    return B.accept_blocks(_proposals(spark, sf_dir), _block_list(spark, sf_dir))


def block_all_valid(spark, sf_dir):
    return B.all_valid(table(spark, sf_dir, "lineitem"), "l_orderkey", F.col("l_quantity") <= 45)


def blocklist_digest(spark, sf_dir):
    return B.digest(table(spark, sf_dir, "customer"), "c_name", "c_nationkey")


def fee_bump(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("long").alias("old"), ((F.col("p_partkey") * 7) % 60).cast("long").alias("new"))
    return parts.select("p_partkey", B.replaces(F.col("old"), F.col("new"), 10).alias("replaces"))


def _mempool(orders):
    txs = orders.select(F.col("o_custkey").alias("sender"), F.col("o_orderkey").alias("nonce"), F.floor("o_totalprice").cast("long").alias("priority"))
    return B.mempool_order(txs).select("sender", "nonce", "effective")


def mempool_order(spark, sf_dir):
    return _mempool(table(spark, sf_dir, "orders"))


def fork_at(spark, sf_dir):
    forks = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("position"), (F.col("n_regionkey") * 10).cast("long").alias("height"), F.lit("main").alias("chain_id"))
    return B.fork_at(forks, 20, "main")


# ------------------------------------------------------------------ amounts and ledgers


def scale_amounts(spark, sf_dir):
    a = F.col("o_orderkey") * 123_456_789_012
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", A.scale_up(a).cast("string").alias("up"), A.remainder(a).cast("string").alias("rest"), A.scale_down(a).cast("string").alias("down"), A.burnable(a).cast("string").alias("burn"),
    )


def coin_merge(spark, sf_dir):
    coins = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_returnflag").alias("denom"), F.col("l_quantity").cast("long").cast("decimal(38,0)").alias("amount"))).alias("coins"))
    merged = A.merge_coins(F.col("coins"))
    return coins.select("l_orderkey", F.array_join(F.transform(merged, lambda c: F.concat(c["amount"].cast("string"), c["denom"])), ",").alias("coins"))


def coins_parse(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, F.concat(F.col("p_size").cast("string"), F.lit("bbb,"), F.col("p_partkey").cast("string"), F.lit("aaa"))).otherwise(F.col("p_size").cast("string")).alias("text"))
    coins, number = A.parse_amount(F.col("text"))
    return parts.select("p_partkey", F.array_join(F.transform(coins, lambda c: F.concat(c["amount"].cast("string"), c["denom"])), ",").alias("coins"), number.cast("string").alias("amount"))


def token_balances(spark, sf_dir):
    """Customers pay their orders to their nation: balances of a token ledger."""
    paid = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seq"), F.when(F.col("o_orderkey") % 3 == 0, "mint").when(F.col("o_orderkey") % 3 == 1, "burn").otherwise("transfer").alias("op"), F.lit("token").alias("token"),
        F.col("o_custkey").cast("string").alias("sender"), (F.col("o_custkey") % 25).cast("string").alias("receiver"), F.floor("o_totalprice").cast("decimal(38,0)").alias("amount"),
    )
    return L.balances(L.token_ledger(paid)).select("address", "denom", F.col("amount").cast("string").alias("amount"))


def overdrawn_operations(spark, sf_dir):
    entries = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seq"), F.col("o_custkey").cast("string").alias("address"), F.lit("token").alias("denom"),
        F.when(F.col("o_orderkey") % 2 == 0, F.lit(100)).otherwise(F.lit(-70)).cast("decimal(38,0)").alias("delta"),
    )
    return L.overdrawn(entries)


def denom_kinds(spark, sf_dir):
    digits = F.sha2(F.col("p_name"), 256)
    made = F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("ibc/"), digits)).when(F.col("p_partkey") % 4 == 1, F.concat(F.lit("gravity0x"), F.substring(digits, 1, 40))).when(F.col("p_partkey") % 4 == 2, F.concat(F.lit("source0x"), F.substring(digits, 1, 40))).otherwise(F.col("p_name"))
    rows = table(spark, sf_dir, "part").select("p_partkey", made.alias("denom"))
    return rows.select("p_partkey", DENOMS.is_valid(F.col("denom")).alias("valid"), DENOMS.is_source(F.col("denom")).alias("source"), DENOMS.contract(F.col("denom")).alias("contract"))


def snake_case_names(spark, sf_dir):
    camel = F.concat(F.initcap("c_mktsegment"), F.lit("Of"), F.initcap(F.lower("c_name")))
    return table(spark, sf_dir, "customer").select("c_custkey", snake_case(camel).alias("snake"), display_symbol(F.col("c_mktsegment")).alias("symbol"), channel_name(F.col("c_custkey")).alias("channel"))


def gas_required(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    method = F.when(F.col("p_partkey") % 3 == 0, "recvPacket").when(F.col("p_partkey") % 3 == 1, "timeout").otherwise("other")
    return parts.select("p_partkey", A.required_gas(A.relayer_gas(method), F.col("p_size"), 30, 104_000).alias("gas"))


QUERIES = {f.__name__: f for f in (
    denom_lookup_preferred, reverse_lookup, mappings_of_kind, positional_left_lookup, validators_with_keys, permission_mask, any_permission, upsert_last_wins, migration_default,
    state_as_of, changeset_fold, version_intervals, blocklist_semi, blocklist_anti, blocklist_except, proposal_filter, block_accept, block_all_valid, blocklist_digest, fee_bump,
    mempool_order, fork_at, scale_amounts, coin_merge, coins_parse, token_balances, overdrawn_operations, denom_kinds, gas_required,
)} | {"snake_case": snake_case_names}

_PROPOSALS_SQL = """
p AS (SELECT date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS block, o_orderkey AS position,
             o_custkey % 97 = 3 AND o_custkey IN (SELECT c_custkey FROM customer) OR (o_custkey * 7) % 1500 % 97 = 3 AND (o_custkey * 7) % 1500 IN (SELECT c_custkey FROM customer) AS bad FROM orders)"""
_A = "CAST(o_orderkey AS HUGEINT) * 123456789012"

ORACLES = {
    "denom_lookup_preferred": f"WITH {_MAPPINGS_SQL} SELECT n_nationkey AS denom, e.contract AS external, a.contract AS auto, coalesce(e.contract, a.contract) AS contract FROM nation LEFT JOIN ext e ON n_nationkey = e.denom LEFT JOIN auto a ON n_nationkey = a.denom",
    "reverse_lookup": f"WITH {_MAPPINGS_SQL}, r AS (SELECT * FROM ext UNION ALL SELECT * FROM auto) SELECT o_orderkey, o_custkey AS contract, denom AS found_denom FROM orders JOIN r ON o_custkey = contract",
    "mappings_of_kind": f"WITH {_MAPPINGS_SQL} SELECT denom, 'auto' AS kind, contract FROM auto",
    "positional_left_lookup": """WITH a AS (SELECT o_orderkey, unnest([0, 1, 2, 3]) AS position, unnest([o_custkey, o_custkey + 1000000, o_custkey, o_orderkey]) AS address FROM orders)
        SELECT o_orderkey, CAST(position AS INTEGER) AS position, address, coalesce(c_name, '') AS key FROM a LEFT JOIN customer ON address = c_custkey""",
    "validators_with_keys": "SELECT s_suppkey AS address, s_nationkey AS power, c_name AS key, c_name IS NOT NULL AS has_key FROM supplier LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 2 = 0) c ON s_suppkey = c_custkey",
    "permission_mask": "SELECT p_partkey, p_size & 1 = 1 AS can_change_token_mapping, p_size & 2 = 2 AS can_turn_bridge, p_size & 3 = 3 AS has_all FROM part",
    "any_permission": "SELECT l_orderkey AS request, bool_or(coalesce(p_size & 12 = 12, false) OR l_partkey = 17) AS allowed FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_partkey % 4 <> 0) ON l_partkey = p_partkey GROUP BY 1",
    "upsert_last_wins": """WITH ch AS (SELECT o_custkey AS k, max(o_orderkey) AS v FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1)
        SELECT c_custkey AS k, CAST(c_nationkey AS BIGINT) AS v FROM customer WHERE c_custkey NOT IN (SELECT k FROM ch) UNION ALL SELECT k, v FROM ch""",
    "migration_default": "SELECT p_partkey, CAST(CASE WHEN p_size % 7 = 0 THEN 50000 ELSE p_size % 7 END AS BIGINT) AS gas FROM part",
    "state_as_of": "SELECT user_id, max(event_id) AS version, arg_max(event_type, event_id) AS event_type FROM events WHERE event_id <= 5000 GROUP BY 1",
    "changeset_fold": "SELECT * FROM (SELECT user_id, max(event_id) AS version, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1) WHERE event_type <> 'error'",
    "version_intervals": "SELECT user_id, version, valid_to FROM (SELECT user_id, event_id AS version, event_type, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS valid_to FROM events) WHERE event_type <> 'error'",
    "blocklist_semi": "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_custkey % 11 = 3)",
    "blocklist_anti": "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 11 = 3)",
    "blocklist_except": "SELECT c_custkey AS address FROM customer WHERE c_custkey % 11 = 3 EXCEPT SELECT s_suppkey FROM supplier",
    "proposal_filter": f"WITH {_PROPOSALS_SQL} SELECT block, position, row_number() OVER (PARTITION BY block ORDER BY position) - 1 AS new_position FROM p WHERE NOT bad",
    "block_accept": f"WITH {_PROPOSALS_SQL} SELECT block, NOT bool_or(bad) AS accepted FROM p GROUP BY 1",
    "block_all_valid": "SELECT l_orderkey, bool_and(l_quantity <= 45) AS all_valid FROM lineitem GROUP BY 1",
    "blocklist_digest": "SELECT c_nationkey, sha256(string_agg(c_name, '' ORDER BY c_name)) AS digest, count(*) AS n FROM customer GROUP BY 1",
    "fee_bump": "SELECT p_partkey, (p_partkey * 7) % 60 >= (p_size * 110) // 100 AS replaces FROM part",
    "mempool_order": """SELECT o_custkey AS sender, o_orderkey AS nonce, min(CAST(floor(o_totalprice) AS BIGINT)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS effective
        FROM orders""",
    "fork_at": "SELECT n_nationkey AS position, CAST(n_regionkey * 10 AS BIGINT) AS height, 'main' AS chain_id FROM nation WHERE n_regionkey = 2 ORDER BY n_nationkey LIMIT 1",
    "scale_amounts": f"SELECT o_orderkey, CAST({_A} * 10000000000 AS VARCHAR) AS up, CAST({_A} % 10000000000 AS VARCHAR) AS rest, CAST({_A} // 10000000000 AS VARCHAR) AS down, CAST(nullif({_A} - {_A} % 10000000000, 0) AS VARCHAR) AS burn FROM orders",
    "coin_merge": "WITH s AS (SELECT l_orderkey, l_returnflag AS d, sum(CAST(l_quantity AS BIGINT)) AS a FROM lineitem GROUP BY 1, 2) SELECT l_orderkey, string_agg(CAST(a AS VARCHAR) || d, ',' ORDER BY d) AS coins FROM s GROUP BY 1",
    "coins_parse": "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN CASE WHEN p_partkey = 0 THEN '' ELSE CAST(p_partkey AS VARCHAR) || 'aaa,' END || CAST(p_size AS VARCHAR) || 'bbb' END AS coins, CASE WHEN p_partkey % 2 = 1 THEN CAST(p_size AS VARCHAR) END AS amount FROM part",
    "token_balances": """WITH o AS (SELECT o_orderkey % 3 AS op, CAST(o_custkey AS VARCHAR) AS s, CAST(o_custkey % 25 AS VARCHAR) AS r, CAST(floor(o_totalprice) AS HUGEINT) AS a FROM orders),
        e AS (SELECT r AS address, a AS d FROM o WHERE op IN (0, 2) UNION ALL SELECT s, -a FROM o WHERE op IN (1, 2))
        SELECT address, 'token' AS denom, CAST(sum(d) AS VARCHAR) AS amount FROM e GROUP BY 1 HAVING sum(d) <> 0""",
    "overdrawn_operations": """SELECT seq FROM (SELECT o_orderkey AS seq, sum(CASE WHEN o_orderkey % 2 = 0 THEN 100 ELSE -70 END) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS b FROM orders) WHERE b < 0""",
    "denom_kinds": "SELECT p_partkey, p_partkey % 4 < 3 AS valid, p_partkey % 4 = 2 AS source, CASE WHEN p_partkey % 4 IN (1, 2) THEN '0x' || substr(sha256(p_name), 1, 40) END AS contract FROM part",
    "gas_required": "SELECT p_partkey, CAST(greatest(0, CASE p_partkey % 3 WHEN 0 THEN 144025 WHEN 1 THEN 104283 ELSE 100000 END + p_size * 30 - 104000) AS BIGINT) AS gas FROM part",
    "snake_case": """WITH c AS (SELECT c_custkey, c_mktsegment, upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) || 'Of' || upper(substr(c_name, 1, 1)) || lower(substr(c_name, 2)) AS n FROM customer)
        SELECT c_custkey, lower(substr(n, 1, 1) || regexp_replace(substr(n, 2), '([A-Z])', '_\\1', 'g')) AS snake, lower(c_mktsegment) AS symbol, 'channel-' || CAST(c_custkey AS VARCHAR) AS channel FROM c""",
}
