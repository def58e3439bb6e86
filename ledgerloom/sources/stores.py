"""Sources and sinks: key-value exports, genesis documents, transaction files and blocks."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .. import schemas
from ..functions.keys import DATABASES, parse_backend


def read_store(spark: SparkSession, path: str, db: str | None = None, backend: str = "parquet") -> DataFrame:
    """A store export (``db`` prunes the partition), or a database folder ``<db>.db`` of a storage engine.

    LevelDB folders are read by their file format; for RocksDB a reader must be registered under its name.
    """
    kind = parse_backend(backend)
    if kind == "goleveldb":
        from .leveldb import read_leveldb

        return read_leveldb(spark, f"{path}/{db}.db" if db else path)
    if kind != "parquet":
        return spark.read.format(f"ledgerloom_{kind}").option("db", db or "").load(path)
    return spark.read.schema(schemas.STORE if db is None else schemas.KEY_VALUE).parquet(path if db is None else f"{path}/db={db}")


def write_store(rows: DataFrame, path: str) -> None:
    """Export partitioned by database and sorted by key within files, so that row groups prune prefixes."""
    rows.repartitionByRange("db", "key_text").sortWithinPartitions("db", "key_text").write.mode("overwrite").partitionBy("db").option("compression", "zstd").parquet(path)


def open_with_retry(open_store, *, tries: int = 5, first_wait: float = 0.05):
    """What ``open_store()`` gives, tried again after errors of the file system; waits double."""
    import time

    from pyspark.errors import PySparkException

    for attempt in range(tries):
        try:
            return open_store()
        except (OSError, PySparkException):
            if attempt == tries - 1:
                raise
            time.sleep(first_wait * 2**attempt)


def stage_then_publish(rows: DataFrame, path: str) -> str:
    """Write beside the target and rename once complete; a failed write leaves the target as it was."""
    spark = rows.sparkSession
    staged = f"{path}.migrate-temp"
    rows.write.mode("overwrite").parquet(staged)
    jvm = spark._jvm
    source, target = jvm.org.apache.hadoop.fs.Path(staged), jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(target):
        raise FileExistsError(path)
    if not fs.rename(source, target):
        raise OSError(f"cannot rename {staged}")
    return path


# ------------------------------------------------------------------ genesis


def read_genesis(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read.option("multiLine", "true")
    return (reader.schema(schema) if schema is not None else reader).json(path)


def genesis_mappings(genesis: DataFrame) -> DataFrame:
    """(denom, kind, contract) of a genesis document's external and auto contracts."""
    part = lambda kind, column: genesis.select(F.explode(column).alias("m")).select("m.denom", F.lit(kind).alias("kind"), F.unhex(F.regexp_replace("m.contract", "^0x", "")).alias("contract"))
    return part("external", "external_contracts").union(part("auto", "auto_contracts"))


def invalid_mappings(mappings: DataFrame, denoms) -> DataFrame:
    """Mappings that a genesis must not have: an invalid denomination, or no 20-byte address."""
    fine = denoms.is_valid(F.col("denom")) & (F.length("contract") == 20)
    return mappings.where(~F.coalesce(fine, F.lit(False)))


def export_genesis(mappings: DataFrame, params: dict) -> str:
    """Genesis JSON: parameters, and both kinds of mappings by denomination. A chain has as many as governance made."""
    rows = mappings.select("denom", "kind", F.concat(F.lit("0x"), F.lower(F.hex("contract"))).alias("contract")).orderBy("denom").collect()
    of = lambda kind: [{"denom": r["denom"], "contract": r["contract"]} for r in rows if r["kind"] == kind]
    return json.dumps({"params": params, "external_contracts": of("external"), "auto_contracts": of("auto")})


def merge_genesis(base: dict, more: dict) -> dict:
    """Documents merged by key: lists are joined, nested documents merge, anything else is overwritten."""
    out = dict(base)
    for key, value in more.items():
        old = out.get(key)
        if isinstance(old, dict) and isinstance(value, dict):
            out[key] = merge_genesis(old, value)
        elif isinstance(old, list) and isinstance(value, list):
            out[key] = old + value
        else:
            out[key] = value
    return out


def patch_config(base: dict, changes: dict) -> dict:
    """Configuration with changes applied recursively; lists are replaced."""
    out = dict(base)
    for key, value in changes.items():
        out[key] = patch_config(out[key], value) if isinstance(value, dict) and isinstance(out.get(key), dict) else value
    return out


def zero_height(validators: DataFrame, allowed: DataFrame | None = None) -> DataFrame:
    """Export for height zero: heights reset, and validators outside the allow list jailed."""
    reset = validators.withColumn("unbonding_height", F.lit(0).cast("bigint")).withColumn("height", F.lit(0).cast("bigint"))
    if allowed is None:
        return reset
    marks = allowed.select("address").distinct().withColumn("_allowed", F.lit(True))
    return reset.join(marks, "address", "left").withColumn("jailed", F.col("jailed") | F.col("_allowed").isNull()).drop("_allowed")


# ------------------------------------------------------------------ transaction files


def save_txs(txs: DataFrame, path: str) -> None:
    txs.write.mode("overwrite").json(path)


def load_txs(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """Transactions of a file, None where there is no such file."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def broadcast_txs(txs: DataFrame, send, *, tries: int = 6, first_wait: float = 0.1) -> None:
    """Send every row with retries on errors (waits double, up to a minute); a refused one is not sent again."""

    def each(rows) -> None:
        import time

        for row in rows:
            wait = first_wait
            for attempt in range(tries):
                try:
                    send(row.asDict())
                    break
                except OSError:
                    if attempt == tries - 1:
                        raise
                    time.sleep(min(wait, 60))
                    wait *= 2

    txs.foreachPartition(each)


# ------------------------------------------------------------------ blocks


def block_by(blocks: DataFrame, *, number: int | None = None, block_hash: bytes | None = None) -> DataFrame:
    """The block of a hash, else of a number; neither is an error."""
    if block_hash is not None:
        return blocks.where(F.col("hash") == F.lit(block_hash))
    if number is None:
        raise ValueError("a block needs a number or a hash")
    return blocks.where(F.col("height") == number)


class _Heights(InputPartition):
    def __init__(self, low: int, high: int) -> None:
        super().__init__((low, high))
        self.low, self.high = low, high


def _reply(url: str, kind: str, height: int) -> dict:
    """A node's reply about a block: from a folder of replies (any URL that pyarrow opens), or by HTTP."""
    if not url.startswith(("http:", "https:")):
        from pyarrow import fs

        files, folder = fs.FileSystem.from_uri(url)
        with files.open_input_stream(f"{folder.rstrip('/')}/{height}.json") as f:
            return json.loads(f.read())
    from urllib.request import Request, urlopen

    if kind == "eth":
        body = json.dumps({"jsonrpc": "2.0", "id": 1, "method": "eth_getBlockByNumber", "params": [hex(height), False]}).encode()
        request = Request(url, body, {"Content-Type": "application/json"})  # noqa: S310
    else:
        request = Request(f"{url}/block?height={height}")  # noqa: S310
    with urlopen(request) as reply:  # noqa: S310
        return json.loads(reply.read())


class _BlockReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.url, self.low, self.high = options["url"], int(options["from"]), int(options["to"])
        self.size, self.kind = int(options.get("perPartition", "1000")), options.get("kind", "comet")
        if self.kind not in ("comet", "eth"):
            raise ValueError(f"unknown kind of node: {self.kind!r}")

    def partitions(self):
        return [_Heights(a, min(a + self.size - 1, self.high)) for a in range(self.low, self.high + 1, self.size)]

    def read(self, partition):
        from datetime import datetime, timezone

        for height in range(partition.low, partition.high + 1):
            result = _reply(self.url, self.kind, height)["result"]
            if self.kind == "eth":
                time = datetime.fromtimestamp(int(result["timestamp"], 16), timezone.utc).isoformat()
                yield int(result["number"], 16), time, [t if isinstance(t, str) else t["hash"] for t in result["transactions"]]
            else:
                block = result["block"]
                yield height, block["header"]["time"], [str(t) for t in block["data"]["txs"] or []]


class BlockSource(DataSource):
    """Blocks of a node's RPC (or of a folder of its replies), by ranges of heights.

    Options: url, kind (comet, or eth for ``eth_getBlockByNumber``), from, to, perPartition. Spark retries a range that fails.
    """

    @classmethod
    def name(cls) -> str:
        return "ledgerloom_blocks"

    def schema(self) -> str:
        return "height long, time string, txs array<string>"

    def reader(self, schema):
        return _BlockReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(BlockSource)


__all__ = ["DATABASES", "BlockSource", "block_by", "broadcast_txs", "export_genesis", "genesis_mappings", "invalid_mappings", "load_txs", "merge_genesis", "open_with_retry", "patch_config", "read_genesis", "read_store", "register", "save_txs", "stage_then_publish", "write_store", "zero_height"]
