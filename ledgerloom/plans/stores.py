"""Store queries: scans, height parsing, verification and patches over keys made from orders and lines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import keys as K
from ..operators import migrate as M
from .tables import LINE_ORDER, table


def _orders_store(spark, sf_dir):
    """Orders as a store: ``H:<orderkey>`` and ``SC:<orderkey>`` keys with the price as value."""
    orders = table(spark, sf_dir, "orders")
    part = lambda p: orders.select(F.concat(F.lit(p), F.col("o_orderkey").cast("string")).alias("key_text"), F.col("o_totalprice").alias("price"))
    return part("H:").union(part("SC:")).union(part("C:")).union(part("BS:"))


_STORE_SQL = "store AS (SELECT p || CAST(o_orderkey AS VARCHAR) AS key_text FROM orders, (VALUES ('H:'), ('SC:'), ('C:'), ('BS:')) AS f(p))"


def kv_full_scan_count(spark, sf_dir):
    names = ["orders", "lineitem", "events"]
    return reduce(lambda a, b: a.union(b), (M.scan(table(spark, sf_dir, n)).agg(F.count("*").alias("n")).select(F.lit(n).alias("tbl"), "n") for n in names))


def kv_prefix_scan(spark, sf_dir):
    store = _orders_store(spark, sf_dir)
    rows = M.prefix_scan(store, ["H:", "C:"])
    return rows.groupBy(K.block_key_family(F.col("key_text")).alias("family")).agg(F.count("*").alias("n"))


def height_extract(spark, sf_dir):
    rows = _orders_store(spark, sf_dir).withColumn("height", K.block_key_height(F.col("key_text")))
    spec = K.parse_heights("100-5000")
    return rows.where(spec.column(F.col("height"))).agg(F.count("*").alias("n"), F.sum("height").alias("total"))


def tx_key_parse(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    key = F.concat(F.lit("tx.height/"), F.col("l_orderkey").cast("string"), F.lit("/"), F.col("l_orderkey").cast("string"), F.lit("/"), F.col("l_linenumber").cast("string"), F.when(F.col("l_linenumber") % 2 == 0, "$es$0").otherwise(""))
    return line.select(key.alias("k")).select(K.tx_key_height(F.col("k")).alias("height"), K.tx_key_index(F.col("k")).alias("idx"))


def _orders_by(spark, sf_dir, spec):
    return table(spark, sf_dir, "orders").where(K.parse_heights(spec).column(F.col("o_orderkey")) if isinstance(spec, str) else spec.column(F.col("o_orderkey"))).select("o_orderkey", "o_custkey")


def height_range_filter(spark, sf_dir):
    return _orders_by(spark, sf_dir, "1000-2000")


def height_in_list(spark, sf_dir):
    return _orders_by(spark, sf_dir, "7, 77, 777, 7777,77777")


def height_open_ended(spark, sf_dir):
    return _orders_by(spark, sf_dir, K.HeightSpec(start=9000))


def height_missing_policy(spark, sf_dir):
    rows = _orders_store(spark, sf_dir).withColumn("height", K.block_key_height(F.col("key_text")))
    spec = K.parse_heights("100-5000")
    return rows.agg(F.count_if(spec.column(F.col("height"))).alias("dropped_nulls"), F.count_if(M.includes("blockstore", F.col("key_text"), spec)).alias("kept_nulls"))


def lexical_vs_numeric_order(spark, sf_dir):
    from pyspark.sql import Window

    keys = table(spark, sf_dir, "supplier").select(F.concat(F.lit("H:"), F.col("s_suppkey").cast("string")).alias("k"))
    height = K.block_key_height(F.col("k"))
    ranked = keys.withColumn("numeric_rank", F.row_number().over(Window.orderBy(height)).cast("long")).withColumn("lexical_rank", F.row_number().over(Window.orderBy("k")).cast("long"))
    return ranked.where("lexical_rank <= 10")


def _perturbed(spark, sf_dir):
    """Orders without every 97th key, with every 89th changed, and 20 keys that the source has not."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("value"))
    changed = orders.where("key % 97 <> 0").withColumn("value", F.when(F.col("key") % 89 == 0, -F.col("value") - 1).otherwise(F.col("value")))
    return orders, changed.union(orders.where("key <= 20").select((-F.col("key") - 1).alias("key"), "value"))


_PERTURBED_SQL = """
src AS (SELECT o_orderkey AS key, o_custkey AS value FROM orders),
tgt AS (SELECT key, CASE WHEN key % 89 = 0 THEN -value - 1 ELSE value END AS value FROM src WHERE key % 97 <> 0
        UNION ALL SELECT -key - 1, value FROM src WHERE key <= 20)"""


def migrate_verify(spark, sf_dir):
    source, target = _perturbed(spark, sf_dir)
    return M.verify_counts(source, target)


def migrate_classes(spark, sf_dir):
    source, target = _perturbed(spark, sf_dir)
    return M.compare(source, target).where("class <> 'same'")


def _patched(spark, sf_dir, policy):
    source, target = _perturbed(spark, sf_dir)
    picked = source.where(K.parse_heights("50-4000").column(F.col("key")))
    return M.merge(target, picked, policy)


def patch_skip(spark, sf_dir):
    return _patched(spark, sf_dir, "skip")


def patch_replace(spark, sf_dir):
    return _patched(spark, sf_dir, "replace")


def patch_three_pass(spark, sf_dir):
    """Orders of a range lead to customers, and those to nations: three families of keys."""
    first = table(spark, sf_dir, "orders").where(K.parse_heights("100-900").column(F.col("o_orderkey")))
    second = table(spark, sf_dir, "customer").join(first.select(F.col("o_custkey").alias("c_custkey")).distinct(), "c_custkey", "left_semi")
    third = table(spark, sf_dir, "nation").join(F.broadcast(second.select(F.col("c_nationkey").alias("n_nationkey")).distinct()), "n_nationkey", "left_semi")
    tag = lambda df, c, name: df.select(F.col(c).cast("long").alias("id"), F.lit(name).alias("family"))
    return tag(first, "o_orderkey", "height").unionByName(tag(second, "c_custkey", "result")).unionByName(tag(third, "n_nationkey", "eth_event"))


def _prefix_join(lines):
    line = lines.select("l_orderkey", F.col("l_suppkey").alias("idx")).distinct()
    tx = line.where("idx < 10")
    met = line.alias("e").join(tx.alias("t"), F.col("e.l_orderkey") == F.col("t.l_orderkey")).where(F.col("e.idx").cast("string").startswith(F.col("t.idx").cast("string")))
    return met.select(F.col("t.l_orderkey").alias("height"), F.col("t.idx").alias("tx_index"), F.col("e.idx").alias("event_index"))


def prefix_range_join(spark, sf_dir):
    """Events of a transaction by hash, height and an index that starts with its own."""
    return _prefix_join(table(spark, sf_dir, "lineitem"))


def point_get(spark, sf_dir):
    wanted = table(spark, sf_dir, "orders").where("o_orderkey % 1000 = 7").select(F.col("o_orderkey").alias("key"))
    store = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), "o_orderstatus")
    return M.get_many(store, wanted)


def total_stats(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    stats = line.groupBy(F.col("l_returnflag").alias("db")).agg(F.count("*").alias("total"), F.count_if(F.col("l_linestatus") == "O").alias("processed"), F.count_if(F.col("l_tax") > 0.07).alias("errors"))
    return M.total_stats(stats)


def progress_ratio(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count("*").alias("total"), F.count_if(F.col("l_linestatus") == "O").alias("done"))
    return line.select("l_returnflag", F.round(M.progress(F.col("done"), F.col("total")), 6).alias("percent"))


def hash_validate(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    digest = F.sha2(F.col("p_name"), 256)
    made = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("0x"), digest)).when(F.col("p_partkey") % 3 == 1, digest).otherwise(F.substring(digest, 1, 60))
    return parts.select("p_partkey", K.normal_hash(made).alias("tx_hash"))


def rollback_version(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("version"))
    return M.drop_versions_after(rows, 500)


QUERIES = {f.__name__: f for f in (
    kv_full_scan_count, kv_prefix_scan, height_extract, tx_key_parse, height_range_filter, height_in_list, height_open_ended, height_missing_policy,
    lexical_vs_numeric_order, migrate_verify, migrate_classes, patch_skip, patch_replace, patch_three_pass, prefix_range_join, point_get, total_stats,
    progress_ratio, hash_validate, rollback_version,
)}

_HEIGHT = "CASE WHEN regexp_matches(key_text, '^(H|C|SC|EC):[+-]?[0-9]+') THEN CAST(regexp_extract(key_text, '^(?:H|C|SC|EC):([+-]?[0-9]+)', 1) AS BIGINT) END"
_MERGE = "SELECT coalesce(t.key, s.key) AS key, {won} AS value FROM tgt t FULL OUTER JOIN (SELECT * FROM src WHERE key BETWEEN 50 AND 4000) s ON t.key = s.key"

ORACLES = {
    "kv_full_scan_count": "SELECT 'orders' AS tbl, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'events', count(*) FROM events",
    "kv_prefix_scan": f"WITH {_STORE_SQL} SELECT split_part(key_text, ':', 1) AS family, count(*) AS n FROM store WHERE starts_with(key_text, 'H:') OR starts_with(key_text, 'C:') GROUP BY 1",
    "height_extract": f"WITH {_STORE_SQL}, h AS (SELECT {_HEIGHT} AS height FROM store) SELECT count(*) AS n, CAST(sum(height) AS BIGINT) AS total FROM h WHERE height BETWEEN 100 AND 5000",
    "tx_key_parse": "SELECT l_orderkey AS height, CAST(l_linenumber AS BIGINT) AS idx FROM lineitem",
    "height_range_filter": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey BETWEEN 1000 AND 2000",
    "height_in_list": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (7, 77, 777, 7777, 77777)",
    "height_open_ended": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey >= 9000",
    "height_missing_policy": f"WITH {_STORE_SQL}, h AS (SELECT {_HEIGHT} AS height FROM store) SELECT count(*) FILTER (height BETWEEN 100 AND 5000) AS dropped_nulls, count(*) FILTER (height IS NULL OR height BETWEEN 100 AND 5000) AS kept_nulls FROM h",
    "lexical_vs_numeric_order": "WITH k AS (SELECT 'H:' || CAST(s_suppkey AS VARCHAR) AS k, s_suppkey FROM supplier), r AS (SELECT k, row_number() OVER (ORDER BY s_suppkey) AS numeric_rank, row_number() OVER (ORDER BY k) AS lexical_rank FROM k) SELECT * FROM r WHERE lexical_rank <= 10",
    "migrate_verify": f"""WITH {_PERTURBED_SQL}, c AS (SELECT CASE WHEN t.key IS NULL THEN 'm' WHEN s.key IS NULL THEN 'e' WHEN s.value = t.value THEN 's' ELSE 'd' END AS c FROM src s FULL OUTER JOIN tgt t ON s.key = t.key)
        SELECT count(*) FILTER (c IN ('s', 'd')) AS verified, count(*) FILTER (c = 'm') AS missing, count(*) FILTER (c = 'd') AS differing, count(*) FILTER (c = 'e') AS extra,
               count(*) FILTER (c IN ('m', 'd', 'e')) + CASE WHEN count(*) FILTER (c <> 'm') <> count(*) FILTER (c IN ('s', 'd')) THEN 1 ELSE 0 END AS mismatches FROM c""",
    "migrate_classes": f"""WITH {_PERTURBED_SQL} SELECT * FROM (SELECT coalesce(s.key, t.key) AS key, CASE WHEN t.key IS NULL THEN 'missing' WHEN s.key IS NULL THEN 'extra' WHEN s.value = t.value THEN 'same' ELSE 'differs' END AS class
        FROM src s FULL OUTER JOIN tgt t ON s.key = t.key) WHERE class <> 'same'""",
    "patch_skip": f"WITH {_PERTURBED_SQL} {_MERGE.format(won='CASE WHEN t.key IS NOT NULL THEN t.value ELSE s.value END')}",
    "patch_replace": f"WITH {_PERTURBED_SQL} {_MERGE.format(won='CASE WHEN s.key IS NOT NULL THEN s.value ELSE t.value END')}",
    "patch_three_pass": """WITH f AS (SELECT * FROM orders WHERE o_orderkey BETWEEN 100 AND 900), s AS (SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM f)), t AS (SELECT * FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM s))
        SELECT o_orderkey AS id, 'height' AS family FROM f UNION ALL SELECT c_custkey, 'result' FROM s UNION ALL SELECT CAST(n_nationkey AS BIGINT), 'eth_event' FROM t""",
    "prefix_range_join": """WITH l AS (SELECT DISTINCT l_orderkey, l_suppkey AS idx FROM lineitem)
        SELECT t.l_orderkey AS height, t.idx AS tx_index, e.idx AS event_index FROM l e JOIN l t ON e.l_orderkey = t.l_orderkey AND t.idx < 10 AND starts_with(CAST(e.idx AS VARCHAR), CAST(t.idx AS VARCHAR))""",
    "point_get": "SELECT o_orderkey AS key, o_orderstatus FROM orders WHERE o_orderkey % 1000 = 7",
    "total_stats": """WITH s AS (SELECT l_returnflag AS db, count(*) AS total, count(*) FILTER (l_linestatus = 'O') AS processed, count(*) FILTER (l_tax > 0.07) AS errors FROM lineitem GROUP BY 1)
        SELECT * FROM s UNION ALL SELECT 'all', CAST(sum(total) AS BIGINT), CAST(sum(processed) AS BIGINT), CAST(sum(errors) AS BIGINT) FROM s""",
    "progress_ratio": "SELECT l_returnflag, round(CASE WHEN count(*) = 0 THEN 0 ELSE count(*) FILTER (l_linestatus = 'O') * 100.0::DOUBLE / count(*) END, 6) AS percent FROM lineitem GROUP BY 1",
    "hash_validate": "SELECT p_partkey, CASE WHEN p_partkey % 3 < 2 THEN '0x' || sha256(p_name) END AS tx_hash FROM part",
    "rollback_version": "SELECT user_id, event_id AS version FROM events WHERE event_id <= 500",
}
del LINE_ORDER
