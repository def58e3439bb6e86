"""Streaming queries, run to the end over a file stream of ``events`` and read back from their sink."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..operators import blocklist as B
from ..operators.events import LogFilter
from ..operators.lookups import fold_changes
from ..streaming import streams as T
from .tables import table


def _work(spark) -> str:
    """A folder that driver and executors share; on a cluster it must be named, locally the warehouse will do."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not shared and not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{(shared or spark.conf.get('spark.sql.warehouse.dir') + '/_streams').rstrip('/')}/stream-{uuid.uuid4().hex[:12]}"


def _stream(spark, sf_dir, work):
    """Events as a growing table: four files in the order of ids, as a chain writes them, one file per batch."""
    rows = table(spark, sf_dir, "events")
    path = f"{work}/input"
    step = (rows.agg(F.max("event_id")).first()[0] or 0) // 4 + 1
    for part in range(4):
        rows.where((F.col("event_id") >= part * step) & (F.col("event_id") < (part + 1) * step)).coalesce(1).sortWithinPartitions("event_id").write.mode("append").parquet(path)
    return T.read_stream(spark, path, rows.schema)


def _deliver(spark, sf_dir, select):
    work = _work(spark)
    out = select(_stream(spark, sf_dir, work))
    T.run_once(out, f"{work}/out", f"{work}/checkpoint")
    return spark.read.schema(out.schema).parquet(f"{work}/out")


def stream_new_heads(spark, sf_dir):
    heads = lambda s: T.new_heads(s.select(F.col("event_id").alias("height"), "ts")).select("height")
    return _deliver(spark, sf_dir, heads)


def stream_logs_filter(spark, sf_dir):
    wanted = LogFilter(addresses=("1", "2", "3", "5", "8"), topics=(["click", "purchase"],))
    logs = lambda s: T.logs_of(s.select(F.col("event_id").alias("block"), F.col("user_id").cast("string").alias("address"), F.array("event_type").alias("topics")), wanted).select("block", "address")
    return _deliver(spark, sf_dir, logs)


def stream_idle_detector(spark, sf_dir):
    """Chains are users modulo 16, a block is empty where its event is no purchase; idle after three empty ones."""
    T.use_rocksdb(spark)
    blocks = lambda s: s.select((F.col("user_id") % 16).alias("chain"), F.col("event_id").alias("height"), F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("n_txs"))
    out = _deliver(spark, sf_dir, lambda s: T.detect_idle(blocks(s), run=3, halt_ms=None))
    return out.where("not halted").select("chain", "height", "empty_run", "idle")


def _polls(spark, rows, first_id, second_id):
    """Click events of two polls, one after each id; those up to the first id are there before the filter."""
    work = _work(spark)
    path = f"{work}/input"
    rows.where(F.col("event_id") <= first_id).coalesce(1).write.parquet(path)
    filters = T.PollingFilters(spark, f"{work}/filters", lambda: T.read_stream(spark, path, rows.schema), lambda: spark.read.schema(rows.schema).parquet(path))
    which = filters.install(lambda s: s.where("event_type = 'click'").select("event_id"))
    rows.where((F.col("event_id") > first_id) & (F.col("event_id") <= second_id)).coalesce(2).write.mode("append").parquet(path)
    first = filters.changes(which).withColumn("poll", F.lit(1))
    rows.where(F.col("event_id") > second_id).coalesce(2).write.mode("append").parquet(path)
    return first.union(filters.changes(which).withColumn("poll", F.lit(2)))


def poll_filter_changes(spark, sf_dir):
    """Over all events: a twentieth is there before the filter, one poll follows after the half, one after the rest."""
    rows = table(spark, sf_dir, "events")
    first, second = rows.agg(F.percentile("event_id", F.array(F.lit(0.05), F.lit(0.5)))).first()[0] or (0, 0)
    return _polls(spark, rows, int(first), int(second))


def poll_block_filter(spark, sf_dir):
    """A block filter and a pending-transaction filter side by side; an uninstalled filter's id is not used again."""
    rows, work = table(spark, sf_dir, "events"), _work(spark)
    path = f"{work}/input"
    half = int(rows.agg(F.percentile("event_id", F.lit(0.5))).first()[0] or 0)
    rows.where(F.col("event_id") <= half).write.parquet(path)
    filters = T.PollingFilters(spark, f"{work}/filters", lambda: T.read_stream(spark, path, rows.schema, files_per_trigger=100), lambda: spark.read.schema(rows.schema).parquet(path))
    blocks = filters.install(lambda s: s.select(F.col("event_id").cast("string").alias("what")))
    gone = filters.uninstall(blocks), filters.uninstall(blocks)
    again = filters.install(lambda s: s.select(F.col("event_id").cast("string").alias("what")))
    pending = filters.install(lambda s: s.where("event_type = 'purchase'").select(F.concat(F.lit("tx"), F.col("event_id").cast("string")).alias("what")))
    rows.where(F.col("event_id") > half).write.mode("append").parquet(path)
    ids = F.lit(",".join([blocks, again, pending, *map(str, gone)]))
    changes = filters.changes(again).union(filters.changes(pending)).select("what", F.lit("changes").alias("how"), ids.alias("ids"))
    return changes.union(filters.logs(pending).select("what", F.lit("all"), ids))


def stream_fan_out(spark, sf_dir):
    """One stream to two listeners, each called with every batch."""
    work = _work(spark)
    stream = _stream(spark, sf_dir, work).select("event_id", "event_type")
    write = lambda name: lambda rows, number: rows.withColumn("sink", F.lit(name)).write.mode("append").parquet(f"{work}/{name}")
    stream.writeStream.foreachBatch(T.fan_out([write("a"), write("b")])).option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{work}/a").union(spark.read.parquet(f"{work}/b"))


def stream_follow(spark, sf_dir):
    """A subscription that stays on the tip until all is delivered, is ended once and cannot be ended twice."""
    work = _work(spark)
    stream = _stream(spark, sf_dir, work).select("event_id")
    query = T.follow(stream, lambda rows, number: rows.write.mode("append").parquet(f"{work}/out"), f"{work}/checkpoint", every="0 seconds")
    query.processAllAvailable()
    running = T.Subscriptions()
    which = running.subscribe(query)
    ended = running.unsubscribe(which), running.unsubscribe(which)
    return spark.read.schema(stream.schema).parquet(f"{work}/out").select("event_id", F.lit(str(ended)).alias("ended"))


def stream_block_list(spark, sf_dir):
    """Batches joined with a block list that is read anew for each: the list changes between two blobs, a bad one is ignored."""
    work = _work(spark)
    stream = _stream(spark, sf_dir, work).select("event_id", F.col("user_id").cast("string").alias("address"))

    def decode(blob):
        if blob == b"bad":
            raise ValueError("no list")
        return blob.decode().split(",")

    memo, blobs = B.BlockListMemo(spark, decode), [b"1,2,3", b"1,2,3", b"bad", b"4,5"]

    def now(rows):
        return rows.join(F.broadcast(memo.active), "address", "left_semi")

    def sink(rows, number):
        rows.write.mode("append").parquet(f"{work}/out")

    def on_batch(rows, number):
        memo.refresh(blobs[min(number, 3)])
        T.with_static(rows, now, sink)(rows, number)

    stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{work}/out")


def first_block_after(spark, sf_dir):
    """The first block at or after a time, and one that has not come."""
    blocks = table(spark, sf_dir, "events").select(F.col("event_id").alias("height"), "ts")
    middle = F.lit("2024-01-02").cast("timestamp_ntz") if dict(blocks.dtypes)["ts"] == "timestamp_ntz" else F.lit("2024-01-02").cast("timestamp")
    return T.first_block_at(blocks, middle).select("height").union(T.first_block_at(blocks, F.lit("2999-01-01").cast("timestamp")).select("height"))


def stream_versions(spark, sf_dir):
    """Changes appended to a versioned table batch by batch, folded afterwards."""
    work = _work(spark)
    stream = _stream(spark, sf_dir, work).select("user_id", F.col("event_id").alias("version"), "event_type", (F.col("event_type") == "error").alias("deleted"))
    listener = T.VersionedListener(f"{work}/versions")
    stream.writeStream.foreachBatch(listener).option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return fold_changes(spark.read.schema(stream.schema).parquet(f"{work}/versions"), ["user_id"], ["version"]).select("user_id", "version", "event_type")


QUERIES = {f.__name__: f for f in (
    stream_new_heads, stream_logs_filter, stream_idle_detector, poll_filter_changes, poll_block_filter, stream_fan_out, stream_follow, stream_block_list, first_block_after, stream_versions,
)}
_PART = "(SELECT max(event_id) // 4 + 1 AS step FROM events)"
ORACLES = {
    "stream_new_heads": "SELECT event_id AS height FROM events",
    "stream_logs_filter": "SELECT event_id AS block, CAST(user_id AS VARCHAR) AS address FROM events WHERE user_id IN (1, 2, 3, 5, 8) AND event_type IN ('click', 'purchase')",
    "stream_idle_detector": """WITH b AS (SELECT user_id % 16 AS chain, event_id AS height, event_type = 'purchase' AS tx FROM events),
        g AS (SELECT *, count(*) FILTER (tx) OVER (PARTITION BY chain ORDER BY height) AS grp FROM b),
        r AS (SELECT *, count(*) FILTER (NOT tx) OVER (PARTITION BY chain, grp ORDER BY height) AS n FROM g) SELECT chain, height, CASE WHEN tx THEN 0 ELSE n END AS empty_run, NOT tx AND n >= 3 AS idle FROM r""",
    "poll_filter_changes": """WITH q AS (SELECT CAST(floor(quantile_cont(event_id, 0.05)) AS BIGINT) AS a, CAST(floor(quantile_cont(event_id, 0.5)) AS BIGINT) AS b FROM events)
        SELECT event_id, CASE WHEN event_id <= b THEN 1 ELSE 2 END AS poll FROM events, q WHERE event_type = 'click' AND event_id > a""",
    "poll_block_filter": """WITH q AS (SELECT CAST(floor(quantile_cont(event_id, 0.5)) AS BIGINT) AS h FROM events)
        SELECT CAST(event_id AS VARCHAR) AS what, 'changes' AS how, '0x1,0x2,0x3,True,False' AS ids FROM events, q WHERE event_id > h UNION ALL SELECT 'tx' || CAST(event_id AS VARCHAR), 'changes', '0x1,0x2,0x3,True,False' FROM events, q WHERE event_id > h AND event_type = 'purchase'
        UNION ALL SELECT 'tx' || CAST(event_id AS VARCHAR), 'all', '0x1,0x2,0x3,True,False' FROM events WHERE event_type = 'purchase'""",
    "stream_fan_out": "SELECT event_id, event_type, unnest(['a', 'b']) AS sink FROM events",
    "stream_follow": "SELECT event_id, '(True, False)' AS ended FROM events",
    "stream_block_list": f"SELECT event_id, CAST(user_id AS VARCHAR) AS address FROM events, {_PART} WHERE CASE WHEN event_id // step < 3 THEN user_id IN (1, 2, 3) ELSE user_id IN (4, 5) END",
    "first_block_after": "SELECT min(event_id) AS height FROM events WHERE ts >= TIMESTAMP '2024-01-02'",
    "stream_versions": "SELECT * FROM (SELECT user_id, max(event_id) AS version, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1) WHERE event_type <> 'error'",
}
del os
