"""Source and sink queries: documents, transaction files, stores and blocks, written to the shared folder and read back."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..functions.denoms import Denoms
from ..operators import migrate as M
from ..sources import stores as Q
from ..sources.leveldb import write_leveldb
from .streams import _work
from .tables import local_rows, table

DENOMS = Denoms("source")


def _put(spark, path: str, text: str) -> None:
    """A small file at a path that any Hadoop file system has."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    out.write(bytearray(text.encode()))
    out.close()


def _mappings(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    denom = F.when(F.col("n_nationkey") % 5 == 4, F.col("n_name")).otherwise(F.concat(F.lit("ibc/"), F.upper(F.sha2("n_name", 256))))
    size = F.when(F.col("n_nationkey") % 7 == 3, 38).otherwise(40)
    return n.select(denom.alias("denom"), F.when(F.col("n_nationkey") % 2 == 0, "external").otherwise("auto").alias("kind"), F.unhex(F.substr(F.sha2("n_name", 256), F.lit(1), size)).alias("contract"))


def genesis_round_trip(spark, sf_dir):
    """Mappings exported as a genesis document and read again, with what a genesis must not have."""
    path = f"{_work(spark)}/genesis.json"
    _put(spark, path, Q.export_genesis(_mappings(spark, sf_dir), {"timeout": 1}))
    found = Q.genesis_mappings(Q.read_genesis(spark, path))
    bad = Q.invalid_mappings(found, DENOMS).select("denom", "kind").withColumn("invalid", F.lit(True))
    return found.join(bad, ["denom", "kind"], "left").select("denom", "kind", F.lower(F.hex("contract")).alias("contract"), F.coalesce("invalid", F.lit(False)).alias("invalid"))


def zero_height_export(spark, sf_dir):
    """Validators exported for height zero: heights reset, those outside the allow list jailed."""
    validators = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("address"), (F.col("s_nationkey") % 4 == 0).alias("jailed"), F.col("s_suppkey").alias("unbonding_height"), F.lit(9).cast("long").alias("height"))
    allowed = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("address"))
    return Q.zero_height(validators, allowed).select("address", "jailed", "unbonding_height", "height")


def tx_files(spark, sf_dir):
    """Transactions saved as JSON and loaded again; a file that is not there is none."""
    work = _work(spark)
    txs = table(spark, sf_dir, "orders").select("o_orderkey", F.array("o_orderstatus", "o_orderpriority").alias("tx"))
    Q.save_txs(txs, f"{work}/txs")
    missing = Q.load_txs(spark, f"{work}/none", txs.schema) is None
    return Q.load_txs(spark, f"{work}/txs", txs.schema).select("o_orderkey", F.array_join("tx", "/").alias("tx"), F.lit(missing).alias("missing"))


def staged_store(spark, sf_dir):
    """A store written beside its target and renamed once it is complete; a second publication is refused."""
    work = _work(spark)
    rows = table(spark, sf_dir, "supplier").select(F.lit("state").alias("db"), F.col("s_name").cast("binary").alias("key"), F.col("s_name").alias("key_text"), F.col("s_suppkey").cast("string").cast("binary").alias("value"))
    path = Q.stage_then_publish(rows, f"{work}/store")
    try:
        Q.stage_then_publish(rows.limit(0), path)
        twice = True
    except FileExistsError:
        twice = False
    found = Q.open_with_retry(lambda: spark.read.parquet(path))
    return found.select("key_text", F.col("value").cast("string").alias("value"), F.lit(twice).alias("twice"))


def store_export(spark, sf_dir):
    """Databases exported by name, sorted by key; one is read without the others."""
    work = _work(spark)
    key = F.concat_ws("/", F.lit("k"), F.col("o_orderkey").cast("string"))
    rows = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 2 == 0, "state").otherwise("evidence").alias("db"), key.cast("binary").alias("key"), key.alias("key_text"), F.col("o_orderstatus").cast("binary").alias("value"))
    Q.write_store(rows, f"{work}/export")
    return M.prefix_scan(Q.read_store(spark, f"{work}/export", "state"), ["k/1"]).select("key_text", F.col("value").cast("string").alias("value"))


def leveldb_store(spark, sf_dir):
    """A LevelDB folder written from a table, with a log that overwrites and deletes, and read by its file format."""
    path = f"{_work(spark)}/state.db"
    rows = table(spark, sf_dir, "orders").select(F.concat_ws("/", F.lit("k"), F.col("o_orderkey").cast("string")).cast("binary").alias("key"), F.col("o_orderpriority").cast("binary").alias("value"))
    write_leveldb(rows, path, log=[(b"k/7", b"seven"), (b"k/8", None), (b"k/9", None), (b"k/9", b"nine"), (b"new", b"")])
    return Q.read_store(spark, path.removesuffix("/state.db"), "state", "leveldb").select("key_text", F.col("value").cast("string").alias("value"))


def migrated_databases(spark, sf_dir):
    """Databases copied and verified, with the rows that the target refuses."""
    o = table(spark, sf_dir, "orders")
    store = lambda status: o.where(F.col("o_orderstatus") == status).select(F.when(F.col("o_orderkey") % 50 != 3, F.col("o_orderkey").cast("string").cast("binary")).otherwise(F.lit(b"")).alias("key"), F.col("o_orderpriority").cast("binary").alias("value"))
    return M.migrate({"state": store("F"), "evidence": store("O")}, f"{_work(spark)}/copied", source_backend="goleveldb", target_backend="rocksdb")


def block_replies(spark, sf_dir):
    """Blocks from a node's replies, in both forms that nodes have."""
    work = _work(spark)
    nations = [r["n_nationkey"] for r in table(spark, sf_dir, "nation").select("n_nationkey").collect()]  # a node's replies to a few requests
    for n in nations:
        _put(spark, f"{work}/comet/{n}.json", json.dumps({"result": {"block": {"header": {"time": f"2024-01-01T00:00:{n:02d}Z"}, "data": {"txs": ["t"] * (n % 3) or None}}}}))
        _put(spark, f"{work}/eth/{n}.json", json.dumps({"result": {"number": hex(n), "timestamp": hex(1_704_067_200 + n), "transactions": [{"hash": f"0x{n}"}] * (n % 3)}}))
    Q.register(spark)
    read = lambda kind: spark.read.format("ledgerloom_blocks").options(url=f"{work}/{kind}" if "://" in work or work.startswith("file:") else f"file:{work}/{kind}", kind=kind, perPartition="10").option("from", str(min(nations))).option("to", str(max(nations))).load()
    out = lambda kind: read(kind).select(F.lit(kind).alias("kind"), "height", F.unix_seconds(F.to_timestamp("time")).alias("ts"), F.size("txs").cast("long").alias("n_txs"))
    return out("comet").union(out("eth"))


def broadcast_counts(spark, sf_dir):
    """Transactions sent with retries: a third fails once before it goes, and none is lost or sent twice."""
    sent, failed = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)
    tried: dict = {}

    def send(tx):
        if tx["o_orderkey"] % 3 == 0 and tx["o_orderkey"] not in tried:
            tried[tx["o_orderkey"]] = True
            failed.add(1)
            raise OSError("try again")
        sent.add(1)

    Q.broadcast_txs(table(spark, sf_dir, "orders").select("o_orderkey"), send, first_wait=0.0)
    return local_rows(spark, [(sent.value, failed.value)], "sent long, failed long")


QUERIES = {f.__name__: f for f in (genesis_round_trip, zero_height_export, tx_files, staged_store, store_export, leveldb_store, migrated_databases, block_replies, broadcast_counts)}

ORACLES = {
    "genesis_round_trip": """SELECT CASE WHEN n_nationkey % 5 = 4 THEN n_name ELSE 'ibc/' || upper(sha256(n_name)) END AS denom, CASE WHEN n_nationkey % 2 = 0 THEN 'external' ELSE 'auto' END AS kind,
        substr(sha256(n_name), 1, CASE WHEN n_nationkey % 7 = 3 THEN 38 ELSE 40 END) AS contract, n_nationkey % 5 = 4 OR n_nationkey % 7 = 3 AS invalid FROM nation""",
    "zero_height_export": "SELECT s_suppkey AS address, s_nationkey % 4 = 0 OR s_suppkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0) AS jailed, 0::BIGINT AS unbonding_height, 0::BIGINT AS height FROM supplier",
    "tx_files": "SELECT o_orderkey, o_orderstatus || '/' || o_orderpriority AS tx, true AS missing FROM orders",
    "staged_store": "SELECT s_name AS key_text, CAST(s_suppkey AS VARCHAR) AS value, false AS twice FROM supplier",
    "store_export": "SELECT 'k/' || CAST(o_orderkey AS VARCHAR) AS key_text, o_orderstatus AS value FROM orders WHERE o_orderkey % 2 = 0 AND starts_with(CAST(o_orderkey AS VARCHAR), '1')",
    "leveldb_store": """SELECT 'k/' || CAST(o_orderkey AS VARCHAR) AS key_text, CASE o_orderkey WHEN 7 THEN 'seven' WHEN 9 THEN 'nine' ELSE o_orderpriority END AS value FROM orders WHERE o_orderkey <> 8 UNION ALL SELECT 'new', ''""",
    "migrated_databases": "SELECT CASE o_orderstatus WHEN 'F' THEN 'state' ELSE 'evidence' END AS db, count(*) AS total, count(*) FILTER (o_orderkey % 50 <> 3) AS processed, count(*) FILTER (o_orderkey % 50 = 3) AS errors, 0::BIGINT AS mismatches FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1",
    "block_replies": "SELECT unnest(['comet', 'eth']) AS kind, CAST(n_nationkey AS BIGINT) AS height, CAST(1704067200 + n_nationkey AS BIGINT) AS ts, CAST(n_nationkey % 3 AS BIGINT) AS n_txs FROM nation",
    "broadcast_counts": "SELECT count(*) AS sent, count(*) FILTER (o_orderkey % 3 = 0) AS failed FROM orders",
}
