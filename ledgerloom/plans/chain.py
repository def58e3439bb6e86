"""Chain queries: block statistics, batches, events, logs, blooms, codecs and genesis round trips."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import encoding as X
from ..functions.amounts import iso_time, seconds_between, timeout_ns
from ..operators import events as E
from ..operators import receipts as R
from ..operators import stats as S
from .tables import LINE_ORDER, day, table


def _blocks(spark, sf_dir):
    """A block per order day: its number of orders, at the day's start."""
    orders = table(spark, sf_dir, "orders").withColumn("height", day("o_orderdate"))
    return S.tx_counts(orders).withColumn("ts", F.timestamp_seconds(F.col("height") * 86400))


_BLOCKS_SQL = "b AS (SELECT date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS height, count(*) AS n_txs FROM orders GROUP BY 1)"


def block_tx_count(spark, sf_dir):
    return _blocks(spark, sf_dir).select("height", "n_txs")


def tps_sliding(spark, sf_dir):
    return S.sliding_tps(_blocks(spark, sf_dir)).select("height", F.round("tps", 9).alias("tps"))


def tps_sliding_blocked(spark, sf_dir):
    """Only where heights are dense, as on a chain: days without orders are filled in."""
    blocks = _blocks(spark, sf_dir)
    ends = blocks.agg(F.min("height").alias("a"), F.max("height").alias("b"))
    spine = ends.select(F.explode(F.sequence("a", "b")).alias("height"))
    dense = spine.join(blocks.drop("ts"), "height", "left").select("height", F.coalesce("n_txs", F.lit(0)).alias("n_txs"), F.timestamp_seconds(F.col("height") * 86400).alias("ts"))
    return S.sliding_tps_blocked(dense, size=100).select("height", F.round("tps", 9).alias("tps"))


def tps_top5(spark, sf_dir):
    return S.top_tps(S.sliding_tps(_blocks(spark, sf_dir))).select("height", F.round("tps", 9).alias("tps"))


def consecutive_gap(spark, sf_dir):
    return S.gaps(_blocks(spark, sf_dir)).select("height", "previous", "consecutive")


def idle_runs(spark, sf_dir):
    """Blocks are quarter hours of the event stream; a run of three without a purchase is idle."""
    quarter = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 900)
    counts = table(spark, sf_dir, "events").where("event_type = 'purchase'").groupBy(quarter.alias("height")).agg(F.count("*").alias("n"))
    ends = counts.agg(F.min("height").alias("a"), F.max("height").alias("b"))
    spine = ends.select(F.explode(F.sequence("a", "b")).alias("height"))
    blocks = spine.join(counts, "height", "left").select("height", F.coalesce("n", F.lit(0)).alias("n_txs"))
    return S.idle(blocks, run=3).where("idle").select("height")


def nonce_sequence(spark, sf_dir):
    return S.nonces(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], F.col("o_custkey") % 10).select("o_orderkey", "o_custkey", F.col("nonce").cast("long").alias("nonce"))


def round_robin_interleave(spark, sf_dir):
    txs = S.nonces(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("account"), "o_orderkey"), "account", ["o_orderkey"])
    return S.interleaved_position(txs).select("account", F.col("nonce").cast("long").alias("nonce"), "position")


def split_ranges(spark, sf_dir):
    """Order numbers from 0 to the last in batches of 1000, and in seven even parts."""
    orders = S.batch_numbers(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("i")), "i", 1000)
    total = (orders.agg(F.max("i")).first()[0] or 0) + 1
    return S.even_parts(orders, "i", total, 7).groupBy("batch", "part").agg(F.count("*").alias("n"))


def batch_fee_sum(spark, sf_dir):
    txs = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_quantity").cast("long").alias("gas"), F.round(F.col("l_extendedprice"), 2).cast("decimal(18,2)").alias("gas_price"))
    return S.batch_fees(txs, "l_orderkey").select("l_orderkey", F.col("fee").cast("decimal(38,2)").cast("string").alias("fee"), "gas")


def peer_cross(spark, sf_dir):
    return S.all_pairs(table(spark, sf_dir, "nation").select(F.col("n_name").alias("peer")))


def duplicate_events(spark, sf_dir):
    return S.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def min_max_by_type(spark, sf_dir):
    return S.min_max(table(spark, sf_dir, "events"), "event_id", "event_type")


# ------------------------------------------------------------------ events and logs


def _events(spark, sf_dir):
    """Events with their properties and columns as attributes, camel-cased as in a binding."""
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "props",
        F.struct(F.col("event_type").alias("type"), F.array(
            F.struct(F.lit("userId").alias("key"), F.col("user_id").cast("string").alias("value")), F.struct(F.lit("userId").alias("key"), (F.col("user_id") + 1).cast("string").alias("value")),
            F.struct(F.lit("eventType").alias("key"), F.col("event_type").alias("value")),
        ).alias("attributes")).alias("event"),
    )


def event_attr_map(spark, sf_dir):
    """The last attribute of a name stands; a rename copies it."""
    found = _events(spark, sf_dir).select("event_id", E.attribute_map(F.col("event"), {"who": "user_id"}).alias("m"))  # made once, read three times
    return found.select("event_id", *[F.try_element_at("m", F.lit(c)).alias(c) for c in ("user_id", "event_type", "who")])


def first_matching_event(spark, sf_dir):
    events = _events(spark, sf_dir).groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", "event"))).alias("e"))
    listed = events.select("user_id", F.transform("e", lambda x: F.struct(x["event"]["type"].alias("type"), F.filter(x["event"]["attributes"], lambda a: a["key"] == "eventType").alias("attributes"))).alias("events"))
    return listed.select("user_id", F.try_element_at(E.first_event(F.col("events"), "purchase"), F.lit("eventType")).alias("found"))


def _logs(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select(F.col("event_id").alias("block"), F.lit(0).alias("index"), F.col("user_id").cast("string").alias("address"), F.array("event_type", (F.col("event_id") % 7).cast("string")).alias("topics"))


def log_filter(spark, sf_dir):
    wanted = E.LogFilter(from_block=100, to_block=8000, topics=(["click", "error"], ["1", "2", "3"]))
    return _logs(spark, sf_dir).where(wanted.predicate()).select("block", "address")


def log_router(spark, sf_dir):
    handlers = spark.createDataFrame([("click", "send", 2), ("error", "cancel", 3), ("signup", "open", None)], "topic0 string, handler string, n_topics int")
    return E.route(_logs(spark, sf_dir), handlers).select("block", "handler")


def event_query(spark, sf_dir):
    attrs = F.create_map(F.lit("tm.event"), F.lit("Tx"), F.lit("transfer.user"), F.col("user_id").cast("string"), F.lit("transfer.type"), F.col("event_type"))
    rows = table(spark, sf_dir, "events").select("event_id", attrs.alias("attributes"))
    return rows.where(E.event_query("tm.event='Tx' AND transfer.user>=10 AND transfer.type CONTAINS 'ic' AND transfer.user EXISTS")).select("event_id")


def bitor_bloom_lane(spark, sf_dir):
    lane = F.expr("shiftleft(CAST(1 AS BIGINT), CAST((l_partkey * 31 + l_suppkey) % 62 AS INT))")
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.bit_or(lane).alias("lane"))


def message_pairing(spark, sf_dir):
    """Transactions and their results pair by position."""
    line = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(*LINE_ORDER))).alias("lines"))
    blocks = line.select("l_orderkey", F.transform("lines", lambda x: x["l_partkey"]).alias("txs"), F.transform("lines", lambda x: x["l_suppkey"]).alias("results"))
    return R.zip_results(blocks).select("l_orderkey", "tx", F.col("tx_data").alias("part"), F.col("result").alias("supp"))


def time_parse(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("iso"))
    return orders.select("o_orderkey", seconds_between(F.timestamp_seconds(F.lit(0)), iso_time(F.col("iso"))).cast("long").alias("seconds"), timeout_ns(F.col("o_orderkey")).alias("timeout"))


def hex_quantities(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return parts.select("p_partkey", X.quantity(F.col("p_partkey")).alias("quantity"), X.hex_data(F.col("p_name").cast("binary")).alias("data"), X.bytes_u64(X.u64_bytes(F.col("p_partkey"))).cast("long").alias("again"))


# ------------------------------------------------------------------ extensions that Spark has anyway


def ext_tumbling(spark, sf_dir):
    w = F.window("ts", "1 hour")
    return table(spark, sf_dir, "events").groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.unix_seconds(F.col("w.start").cast("timestamp")).alias("start"), "event_type", "n")


def ext_rollup(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (
    block_tx_count, tps_sliding, tps_sliding_blocked, tps_top5, consecutive_gap, idle_runs, nonce_sequence, round_robin_interleave, split_ranges, batch_fee_sum, peer_cross,
    duplicate_events, min_max_by_type, event_attr_map, first_matching_event, log_filter, log_router, event_query, bitor_bloom_lane, message_pairing, time_parse, hex_quantities,
    ext_tumbling, ext_rollup,
)}

_TPS = """CASE WHEN height - first_value(height) OVER w <= 0 THEN 0.0 ELSE
    CAST(sum(n_txs) OVER w - first_value(n_txs) OVER w AS DOUBLE) * 1000000.0 / (CAST(height - first_value(height) OVER w AS DOUBLE) * 86400000000.0) END"""
_W5 = "WINDOW w AS (ORDER BY height ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"

ORACLES = {
    "block_tx_count": f"WITH {_BLOCKS_SQL} SELECT height, n_txs FROM b",
    "tps_sliding": f"WITH {_BLOCKS_SQL} SELECT height, round({_TPS}, 9) AS tps FROM b {_W5}",
    "tps_sliding_blocked": f"""WITH {_BLOCKS_SQL}, s AS (SELECT unnest(range((SELECT min(height) FROM b), (SELECT max(height) + 1 FROM b))) AS height), d AS (SELECT s.height, coalesce(n_txs, 0) AS n_txs FROM s LEFT JOIN b ON s.height = b.height)
        SELECT height, round({_TPS}, 9) AS tps FROM d {_W5}""",
    "tps_top5": f"WITH {_BLOCKS_SQL}, t AS (SELECT height, {_TPS} AS tps FROM b {_W5}) SELECT height, round(tps, 9) AS tps FROM t ORDER BY t.tps DESC, height LIMIT 5",
    "consecutive_gap": f"WITH {_BLOCKS_SQL}, g AS (SELECT height, lag(height) OVER (ORDER BY height) AS previous FROM b) SELECT height, previous, previous IS NULL OR height = previous + 1 AS consecutive FROM g",
    "idle_runs": """WITH c AS (SELECT CAST(floor(epoch(ts) / 900) AS BIGINT) AS height, count(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY 1), s AS (SELECT unnest(range((SELECT min(height) FROM c), (SELECT max(height) + 1 FROM c))) AS height),
        f AS (SELECT s.height, max(coalesce(n, 0)) OVER w AS m, count(*) OVER w AS k FROM s LEFT JOIN c ON s.height = c.height WINDOW w AS (ORDER BY s.height ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)) SELECT height FROM f WHERE m = 0 AND k = 3""",
    "nonce_sequence": "SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 + o_custkey % 10 AS nonce FROM orders",
    "round_robin_interleave": "WITH n AS (SELECT o_custkey AS account, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS nonce FROM orders) SELECT account, nonce, row_number() OVER (ORDER BY nonce, account) - 1 AS position FROM n",
    "split_ranges": "WITH t AS (SELECT (max(o_orderkey) + 1) // 7 AS s, (max(o_orderkey) + 1) % 7 AS m FROM orders) SELECT o_orderkey // 1000 AS batch, CASE WHEN o_orderkey < m * (s + 1) THEN o_orderkey // (s + 1) ELSE m + (o_orderkey - m * (s + 1)) // s END AS part, count(*) AS n FROM orders, t GROUP BY 1, 2",
    "batch_fee_sum": "SELECT l_orderkey, CAST(CAST(sum(CAST(l_quantity AS BIGINT) * CAST(round(l_extendedprice, 2) AS DECIMAL(18, 2))) AS DECIMAL(38, 2)) AS VARCHAR) AS fee, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS gas FROM lineitem GROUP BY 1",
    "peer_cross": "SELECT a.n_name AS peer, string_agg(b.n_name, ',' ORDER BY b.n_name) AS others FROM nation a JOIN nation b ON a.n_name <> b.n_name GROUP BY 1",
    "duplicate_events": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "min_max_by_type": "SELECT event_type, min(event_id) AS least, max(event_id) AS most, count(DISTINCT event_id) AS distinct FROM events GROUP BY 1",
    "event_attr_map": "SELECT event_id, CAST(user_id + 1 AS VARCHAR) AS user_id, event_type, CAST(user_id + 1 AS VARCHAR) AS who FROM events",
    "first_matching_event": "SELECT user_id, max(CASE WHEN event_type = 'purchase' THEN 'purchase' END) AS found FROM events GROUP BY 1",
    "log_filter": "SELECT event_id AS block, CAST(user_id AS VARCHAR) AS address FROM events WHERE event_id BETWEEN 100 AND 8000 AND event_type IN ('click', 'error') AND event_id % 7 IN (1, 2, 3)",
    "log_router": "SELECT event_id AS block, CASE event_type WHEN 'click' THEN 'send' ELSE 'open' END AS handler FROM events WHERE event_type IN ('click', 'signup')",
    "event_query": "SELECT event_id FROM events WHERE user_id >= 10 AND contains(event_type, 'ic')",
    "bitor_bloom_lane": "SELECT l_orderkey, bit_or(CAST(1 AS BIGINT) << CAST((l_partkey * 31 + l_suppkey) % 62 AS BIGINT)) AS lane FROM lineitem GROUP BY 1",
    "message_pairing": f"SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE_ORDER)}) - 1 AS INTEGER) AS tx, l_partkey AS part, l_suppkey AS supp FROM lineitem",
    "time_parse": "SELECT o_orderkey, CAST(epoch(date_trunc('second', o_orderdate)) AS BIGINT) AS seconds, o_orderkey + 86400000000000 AS timeout FROM orders",
    "hex_quantities": "SELECT p_partkey, '0x' || lower(to_hex(p_partkey)) AS quantity, '0x' || lower(hex(p_name)) AS data, p_partkey AS again FROM part",
    "ext_tumbling": "SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) * 3600 AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "ext_rollup": "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)",
}
del Window
