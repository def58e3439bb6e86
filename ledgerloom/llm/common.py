"""Helpers that the training-data operators share: tables, scratch tables, hashing."""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)


#: Bytes of an Arrow batch on its way to a Python worker; a batch is held there some four times over.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Keep the session's Arrow batches to ``BATCH_BYTES``, whatever rows they have; a smaller setting stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, None) or ""
    units = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    value = int(now.rstrip("bB")) if now.rstrip("bB").lstrip("-").isdigit() else int(now[:-1]) * units[now[-1].lower()] if now[:-1].isdigit() else -1
    if not 0 < value <= BATCH_BYTES:
        spark.conf.set(key, f"{BATCH_BYTES}b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def local_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows of the driver as a table. They go by Arrow: a list would start Python workers that then idle."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kind = StructType.fromDDL(schema)
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(kind.names, r)) for r in rows], schema=to_arrow_schema(kind)), kind)


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores before it until no column is called so; Spark's names ignore case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Where the session names none, a folder under the warehouse is used on a local master only; elsewhere that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return f"{warehouse}/_scratch"


class Scratch:
    """Tables of one operator run under the shared folder; ``drop`` frees one that is no longer read.

    Results read these tables, so an operator cannot free all of them. Who has written a result elsewhere can: ``sweep``
    deletes what was kept since a ``mark``.
    """

    kept: list[str] = []  # roots, oldest first

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        small_batches(spark)
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        Scratch.kept.append(self.root)

    @staticmethod
    def mark() -> int:
        return len(Scratch.kept)

    @staticmethod
    def sweep(spark: SparkSession, mark: int) -> None:
        for root in Scratch.kept[mark:]:
            _delete(spark, root)
        del Scratch.kept[mark:]

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back: lineage ends in files that outlive any executor."""
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        _delete(self.spark, f"{self.root}/{name}")


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser over an array of uint64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * MIX_A
        x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


_held: dict[str, list] = {}  # per worker process: what an operator keeps between tasks


def held(owner: str, make) -> object:
    """What ``owner`` keeps in this worker process, made at first. Other operators' caches go: workers are reused."""
    if owner not in _held:
        _held.clear()
        _held[owner] = [make()]
    return _held[owner][0]


def release() -> None:
    """Give back what a task held: idle workers stay for a while, beside those of the next stage."""
    import ctypes
    import gc

    import pyarrow as pa

    _held.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


class Memo(dict):
    """What ``make`` gives for a key, kept in two generations of at most ``LIMIT`` keys.

    When the young one is full it becomes the old one, so frequent keys stay and memory is bounded.
    """

    LIMIT = 100_000

    def __init__(self) -> None:
        super().__init__()
        self.old: dict = {}

    def make(self, key):
        raise NotImplementedError

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.LIMIT:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class WordHashes(Memo):
    """Bytes of a word -> the 8 bytes of its hash."""

    def make(self, key: bytes) -> bytes:
        return hashlib.blake2b(key, digest_size=8).digest()


def blocks_of_sizes(sizes, most: int = 1_000_000):
    """Index ranges that hold about ``most`` of ``sizes`` each, one at least."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        held += size
        if held >= most:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def blocks_of(texts, chars: int = 1_000_000):
    """Index ranges of ``texts`` that hold about ``chars`` characters each, one text at least."""
    return blocks_of_sizes([len(t) if t else 0 for t in texts], chars)
