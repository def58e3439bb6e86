"""The driver's tables seen as chain data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.receipts import OVER_LIMIT


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def local_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows of the driver as a table; by Arrow, which starts no Python workers."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kind = StructType.fromDDL(schema)
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(kind.names, r)) for r in rows], schema=to_arrow_schema(kind)), kind)


#: (l_orderkey, l_linenumber) is not unique: all columns order the lines, and what still ties is equal.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order is a block, a line a transaction with one message; quantity is its gas."""
    line = table(spark, sf_dir, "lineitem")
    at = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)) - 1
    return line.select(
        F.col("l_orderkey").alias("block"), at.cast("long").alias("tx"), F.lit(0).alias("msg"),
        F.col("l_quantity").cast("long").alias("gas_used"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("code"),
        F.when(F.col("l_discount") >= 0.05, F.lit(OVER_LIMIT)).otherwise(F.lit("")).alias("log"),
        (F.col("l_tax") > 0.06).alias("failed"), (F.col("l_linestatus") == "O").alias("is_evm"),
    )


MESSAGES_SQL = f"""
messages AS (
  SELECT l_orderkey AS block, row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(LINE_ORDER)}) - 1 AS tx,
         CAST(l_quantity AS BIGINT) AS gas_used, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS code,
         l_discount >= 0.05 AS over_limit, l_tax > 0.06 AS failed, l_linestatus = 'O' AS is_evm
  FROM lineitem)"""


def day(column: str) -> Column:
    return F.datediff(F.to_date(column), F.lit("1970-01-01").cast("date")).cast("long")
