"""Block statistics, load-test batches and small order-sensitive operators.

Windows over a whole chain look back a bounded number of blocks. So the chain is cut into ranges of heights that many
tasks share: blocks are numbered (counts per range, then places within one), cut by number, and the last rows of
a range are copied into the next one for the window and dropped after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed

WINDOW = 5


def tx_counts(txs: DataFrame, height: str = "height") -> DataFrame:
    return txs.groupBy(height).agg(F.count("*").alias("n_txs"))


RANGE = 100_000


def numbered(blocks: DataFrame, height: str = "height", size: int = RANGE) -> DataFrame:
    """Blocks with ``_n``, their place by height from 0 on, whatever heights are missing.

    Only one row per range of ``size`` heights meets in one task.
    """
    own = F.floor(F.col(height) / size)
    counts = blocks.groupBy(own.alias("_of")).agg(F.count("*").alias("_c"))
    before = F.coalesce(F.sum("_c").over(Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(Window.partitionBy("_own").orderBy(height)) - 1
    met = blocks.withColumn("_own", own).withColumn("_place", place).join(counts.select("_of", before.alias("_before")), F.col("_own") == F.col("_of"))
    return met.withColumn("_n", (F.col("_before") + F.col("_place")).cast("long")).drop("_own", "_place", "_of", "_before")


def _in_ranges(blocks: DataFrame, height: str, back: int, size: int, over) -> DataFrame:
    """``over(rows, ["_range"])`` on ranges of blocks, each with the ``back`` blocks before it."""
    size = max(size, back + 1)
    own = F.floor(F.col("_n") / size)
    copies = F.when(F.col("_n") % size >= size - back, F.array(own, own + 1)).otherwise(F.array(own)) if back else F.array(own)
    dealt = numbered(blocks, height, size).withColumn("_mine", own).withColumn("_range", F.explode(copies))
    return over(dealt, ["_range"]).where("_range = _mine").drop("_range", "_mine", "_n")


def sliding_tps(blocks: DataFrame, *, window: int = WINDOW, height: str = "height", ts: str = "ts", n: str = "n_txs", size: int = RANGE, by: list[str] | None = None) -> DataFrame:
    """Transactions per second over the last ``window`` blocks: those after the first, over the time from first to last.

    Fewer than two blocks, or no time between them, is 0. With ``by``, each of these groups is a chain of its own.
    """

    def over(rows: DataFrame, groups: list[str]) -> DataFrame:
        w = Window.partitionBy(*groups).orderBy(height).rowsBetween(-(window - 1), 0)
        micros = F.unix_micros(F.col(ts)) - F.first(F.unix_micros(F.col(ts))).over(w)
        txs = F.sum(n).over(w) - F.first(n).over(w)
        return rows.withColumn("tps", F.when(micros <= 0, F.lit(0.0)).otherwise(txs * 1_000_000.0 / micros))

    return over(blocks, by) if by else _in_ranges(blocks, height, window - 1, size, over)


def sliding_tps_blocked(blocks: DataFrame, *, size: int = 1_000_000, **options) -> DataFrame:
    """``sliding_tps`` in ranges of ``size`` blocks."""
    return sliding_tps(blocks, size=size, **options)


def top_tps(stats: DataFrame, k: int = 5, height: str = "height") -> DataFrame:
    return stats.orderBy(F.desc("tps"), height).limit(k)


def stats_lines(stats: DataFrame, k: int = 5) -> DataFrame:
    """The report: a line per block, then the best windows."""
    line = F.concat_ws(" ", F.lit("block"), F.col("height").cast("string"), F.col("ts").cast("string"), F.col("n_txs").cast("string"), F.format_number("tps", 2))
    best = top_tps(stats, k).agg(F.sort_array(F.collect_list("tps"), asc=False).alias("best"))
    top = best.select(F.lit(1).alias("part"), F.lit(0).cast("bigint").alias("height"), F.concat(F.lit("top_tps "), F.array_join(F.transform("best", lambda x: F.format_number(x, 2)), ", ")).alias("line"))
    return stats.select(F.lit(0).alias("part"), F.col("height").cast("bigint").alias("height"), line.alias("line")).unionByName(top).orderBy("part", "height").select("line")


def gaps(blocks: DataFrame, height: str = "height", by: list[str] | None = None, size: int = RANGE) -> DataFrame:
    """Each height with its predecessor and whether it is the next one."""

    def over(rows: DataFrame, groups: list[str]) -> DataFrame:
        before = F.lag(height).over(Window.partitionBy(*groups).orderBy(height))
        return rows.withColumn("previous", before).withColumn("consecutive", F.col("previous").isNull() | (F.col(height) == F.col("previous") + 1))

    return over(blocks, by) if by else _in_ranges(blocks, height, 1, size, over)


def idle(blocks: DataFrame, run: int = 20, *, height: str = "height", n: str = "n_txs", by: list[str] | None = None, size: int = RANGE) -> DataFrame:
    """Whether a block ends ``run`` consecutive empty ones; a run that would pass the first block is not idle."""

    def over(rows: DataFrame, groups: list[str]) -> DataFrame:
        w = Window.partitionBy(*groups).orderBy(height).rowsBetween(-(run - 1), 0)
        return rows.withColumn("idle", (F.max(n).over(w) == 0) & (F.count("*").over(w) == run))

    return over(blocks, by) if by else _in_ranges(blocks, height, run - 1, size, over)


def nonces(txs: DataFrame, sender: str, order: list[str], first: Column | int = 0) -> DataFrame:
    """Nonces per sender from the account's next one on."""
    return txs.withColumn("nonce", F.row_number().over(Window.partitionBy(sender).orderBy(*order)) - 1 + first)


def interleave(txs: DataFrame, account: str = "account", nonce: str = "nonce") -> DataFrame:
    """Round robin: all first transactions, then all second ones, by account."""
    return txs.orderBy(nonce, account)


def interleaved_position(txs: DataFrame, account: str = "account", nonce: str = "nonce") -> DataFrame:
    """The place of each transaction in ``interleave``, without one global sort in a task.

    Rows are dealt to tasks by ranges of (nonce, account) and kept so (a checkpoint: the ranges are found by sampling); a
    place is the number of rows in earlier ranges and the place in the own one. One row per range meets in one task.
    """
    dealt = checkpointed(txs.repartitionByRange(nonce, account).sortWithinPartitions(nonce, account).withColumn("_id", F.monotonically_increasing_id()))
    ranges = dealt.withColumn("_part", F.shiftright("_id", 33)).withColumn("_at", F.col("_id").bitwiseAND((1 << 33) - 1))
    sizes = ranges.groupBy("_part").agg(F.count("*").alias("_size"))
    before = F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_part", before.alias("_before"))
    return ranges.join(F.broadcast(offsets), "_part").withColumn("position", (F.col("_before") + F.col("_at")).cast("long")).drop("_part", "_at", "_before", "_id")


def batch_numbers(rows: DataFrame, index: str, size: int) -> DataFrame:
    return rows.withColumn("batch", F.floor(F.col(index) / max(1, size)).cast("long"))


def even_parts(rows: DataFrame, index: str, total: int, parts: int) -> DataFrame:
    """Part number of each index when 0..total is split evenly, the first parts longer by one."""
    size, more = divmod(total, parts)
    edge = more * (size + 1)
    later = (F.lit(more) + F.floor((F.col(index) - edge) / size)) if size else F.lit(more)
    return rows.withColumn("part", F.when(F.col(index) < edge, F.floor(F.col(index) / (size + 1))).otherwise(later).cast("long"))


def batch_fees(txs: DataFrame, by: str, gas: str = "gas", price: str = "gas_price") -> DataFrame:
    """Sum of gas times price, and of gas, per batch; exact."""
    return txs.groupBy(by).agg(F.sum((F.col(gas) * F.col(price)).cast("decimal(38,4)")).alias("fee"), F.sum(gas).alias("gas"))


def all_pairs(peers: DataFrame, key: str = "peer", most: int = 100_000) -> DataFrame:
    """Each peer with the joined names of all others.

    The names are gathered once and a peer's own is left out of its copy: no pairs are made. The result has the square of
    the peers' number in names by its nature, so more than ``most`` peers are an error, not a broadcast without bound.
    """
    if (n := peers.count()) > most:
        raise ValueError(f"{n} peers are above {most}: every peer would list all others")
    every = peers.agg(F.array_sort(F.collect_list(key)).alias("_all"))
    return peers.join(F.broadcast(every), F.lit(True)).select(key, F.array_join(F.filter("_all", lambda x: x != F.col(key)), ",").alias("others"))


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def kept_outputs(files: DataFrame, leaders: list[str], databases: list[str]) -> DataFrame:
    """Files of a run to archive: databases only of the leading nodes, everything else of all."""
    is_db = F.regexp_extract("path", r"/([^/]+)\.db/", 1).isin(*databases)
    return files.where(~is_db | F.col("node").isin(*leaders))


def min_max(rows: DataFrame, column: str, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.min(column).alias("least"), F.max(column).alias("most"), F.count_distinct(column).alias("distinct"))
