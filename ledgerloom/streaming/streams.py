"""Subscriptions, polling filters, state listeners and detectors as Structured Streaming queries.

Blocks are final and ordered by height, so nothing is late and no query needs a watermark. Each filter is a query
with a checkpoint of its own: it delivers what is new since its last run, and forgets nothing on restart.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from ..operators.events import LogFilter


def read_stream(spark: SparkSession, path: str, schema, *, files_per_trigger: int = 1) -> DataFrame:
    """Files of a growing table as a stream, a bounded number per batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def new_heads(blocks: DataFrame) -> DataFrame:
    """Headers of new blocks."""
    return blocks.select(*[c for c in ("height", "hash", "ts") if c in blocks.columns])


def logs_of(logs: DataFrame, wanted: LogFilter) -> DataFrame:
    """New logs that pass a filter; a subscription has no block range."""
    return logs.where(LogFilter(addresses=wanted.addresses, topics=wanted.topics).predicate())


def run_once(stream: DataFrame, sink: str, checkpoint: str, *, mode: str = "append") -> None:
    """Deliver all that is there to a Parquet sink and stop."""
    stream.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", checkpoint).option("path", sink).trigger(availableNow=True).start().awaitTermination()


def follow(stream: DataFrame, on_batch, checkpoint: str, *, every: str = "1 second") -> StreamingQuery:
    """Stay on the tip: call ``on_batch(rows, number)`` for each batch."""
    return stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()


class Subscriptions:
    """Running subscriptions by id; the second unsubscribe says False."""

    def __init__(self) -> None:
        self.queries: dict[str, StreamingQuery] = {}

    def subscribe(self, query: StreamingQuery) -> str:
        self.queries[query.id] = query
        return query.id

    def unsubscribe(self, which: str) -> bool:
        query = self.queries.pop(which, None)
        if query is None:
            return False
        query.stop()
        return True


class PollingFilters:
    """Installed filters over a table that grows by files: changes since the last poll, all logs, uninstall.

    ``stream`` makes the streaming input, ``batch`` the same rows as a table.
    """

    def __init__(self, spark: SparkSession, folder: str, stream, batch) -> None:
        self.spark, self.folder, self.stream, self.batch = spark, folder.rstrip("/"), stream, batch
        self.installed: dict[str, tuple] = {}
        self.polls: dict[str, int] = {}
        self.issued = 0  # ids are not given out twice: a filter's folder and checkpoint are its own

    def install(self, select) -> str:
        """``select`` takes rows (streaming or not) to what the filter delivers. Starts at what comes next."""
        self.issued += 1
        which = f"0x{self.issued:x}"
        self.installed[which], self.polls[which] = (select,), 0
        self.changes(which)
        return which

    def changes(self, which: str) -> DataFrame:
        """Rows since the last call."""
        (select,) = self.installed[which]
        self.polls[which] += 1
        sink = f"{self.folder}/{which}/{self.polls[which]}"
        rows = select(self.stream())
        query = rows.writeStream.foreachBatch(lambda df, n: df.write.mode("append").parquet(sink)).option("checkpointLocation", f"{self.folder}/{which}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
        try:
            return self.spark.read.schema(rows.schema).parquet(sink)
        except Exception as e:  # no batch, no folder
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], rows.schema)

    def logs(self, which: str) -> DataFrame:
        (select,) = self.installed[which]
        return select(self.batch())

    def uninstall(self, which: str) -> bool:
        return self.installed.pop(which, None) is not None


def fan_out(sinks):
    """One batch to several listeners; each is called with the same, once computed rows."""

    def on_batch(rows: DataFrame, number: int) -> None:
        rows.persist()
        try:
            for sink in sinks:
                sink(rows, number)
        finally:
            rows.unpersist()

    return on_batch


class VersionedListener:
    """State changes appended to a versioned table; a batch that would leave a gap of versions is an error."""

    def __init__(self, path: str) -> None:
        self.path, self.version = path, None

    def __call__(self, rows: DataFrame, number: int) -> None:
        ends = rows.agg(F.min("version").alias("low"), F.max("version").alias("high")).first()
        if ends["low"] is None:
            return
        if self.version is not None and ends["low"] > self.version + 1:
            raise RuntimeError(f"versioned store is at {self.version}, changes start at {ends['low']}")
        rows.write.mode("append").parquet(self.path)
        self.version = max(ends["high"], self.version or ends["high"])


def with_static(stream: DataFrame, static_now, sink):
    """A batch function that joins each batch with a table read anew, such as a block list: (batch, table) -> rows."""
    return lambda rows, number: sink(static_now(rows), number)


DETECTED = StructType([StructField("chain", LongType()), StructField("height", LongType()), StructField("empty_run", LongType()), StructField("idle", BooleanType()), StructField("halted", BooleanType())])


class IdleDetector(StatefulProcessor):
    """Counts consecutive empty blocks of a chain; idle at ``run`` of them, halted after ``halt_ms`` without a block."""

    def __init__(self, run: int = 20, halt_ms: int | None = 120_000) -> None:
        self.run, self.halt_ms = run, halt_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "height long, empty long")

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        height, empty = self.state.get() if self.state.exists() else (0, 0)
        out = []
        blocks = pd.concat(list(rows)).sort_values("height")
        for h, n in zip(blocks["height"], blocks["n_txs"]):
            empty = empty + 1 if n == 0 else 0
            height = int(h)
            out.append((int(key[0]), height, int(empty), bool(empty >= self.run), False))
        self.state.update((height, int(empty)))
        if self.halt_ms:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.halt_ms)
        yield pd.DataFrame(out, columns=DETECTED.names)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        height, empty = self.state.get()
        yield pd.DataFrame([(int(key[0]), int(height), int(empty), bool(empty >= self.run), True)], columns=DETECTED.names)

    def close(self) -> None:
        pass


def detect_idle(blocks: DataFrame, run: int = 20, halt_ms: int | None = 120_000) -> DataFrame:
    """Streaming detector over (chain, height, n_txs); needs the RocksDB state store.

    Halts are found by timers, which keep a query alive: a query that is to end with its input passes no ``halt_ms``.
    """
    return blocks.groupBy("chain").transformWithStateInPandas(IdleDetector(run, halt_ms), DETECTED, "Append", "processingTime" if halt_ms else "none")


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def first_block_at(blocks: DataFrame, when) -> DataFrame:
    """The first block at or after a time: what waiting for that time ends with. No row while it has not come."""
    return blocks.where(F.col("ts") >= when).agg(F.min_by(F.struct(*blocks.columns), F.col("height")).alias("b")).where("b is not null").select("b.*")


def replay_changes(table: DataFrame | None, changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """State after one more batch of change-set rows."""
    from ..operators.lookups import fold_changes

    rows = changes if table is None else table.withColumn("deleted", F.lit(False)).select(*changes.columns).union(changes)
    return fold_changes(rows, keys, order)


def convert_packets(packets: DataFrame) -> DataFrame:
    """Credits of IBC packets: the receiver's when received, the sender's on a failed acknowledgement or timeout."""
    back = (F.col("kind") == "timeout") | ((F.col("kind") == "acknowledgement") & ~F.col("success"))
    to = F.when(back, F.col("sender")).when(F.col("kind") == "receive", F.col("receiver"))
    return packets.withColumn("credited", to).where("credited is not null")


def packet_denom(packets: DataFrame) -> DataFrame:
    """Packets (kind, success, base, trace, source_port, source_channel, port, channel) with the ``denom`` credited here.

    A received coin loses the hop it came back by, or gets this end's hop before its trace; a refunded one keeps its trace.
    """
    from ..operators.events import received_trace, voucher

    received = received_trace(F.col("trace"), F.col("source_port"), F.col("source_channel"), F.col("port"), F.col("channel"))
    return packets.withColumn("denom", voucher(F.when(F.col("kind") == "receive", received).otherwise(F.col("trace")), F.col("base")))


def converted_packets(packets: DataFrame, mappings: DataFrame, *, base_denom: str, evm_denom: str, denoms) -> tuple[DataFrame, DataFrame]:
    """(ledger entries, rejected) of the coins that packets credit, converted as vouchers of the credited address.

    Coins that cannot be converted (no base voucher, and no contract for their denomination) stay as they are: they
    are in neither result.
    """
    from ..operators.ledger import vouchers_to_evm
    from ..operators.lookups import contracts_of

    credited = convert_packets(packet_denom(packets)).select("seq", F.col("credited").alias("address"), "denom", F.col("amount").cast("decimal(38,0)").alias("amount"))
    met = contracts_of(credited, mappings).drop("external", "auto")
    return vouchers_to_evm(met.where((F.col("denom") == base_denom) | F.col("contract").isNotNull()), base_denom=base_denom, evm_denom=evm_denom, denoms=denoms)
