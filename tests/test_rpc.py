import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import rpc as R
from ledgerloom.operators.events import LogFilter


@pytest.fixture(scope="module")
def chain(spark):
    blocks = spark.createDataFrame([(h, bytearray([h])) for h in range(3, 8)], "height long, hash binary")
    txs = spark.createDataFrame([(h, i, bytearray([h, i])) for h in range(3, 8) for i in range(h - 3)], "block long, index int, hash binary")
    return blocks, txs


def test_blocks(chain):
    blocks, txs = chain
    assert [R.resolve(blocks, x) for x in ("latest", "earliest", "0x5", 4)] == [7, 3, 5, 4]
    assert R.block_number(blocks).first().height == 7
    assert R.block(blocks, b"\x04").first().height == 4 and R.block(blocks, "earliest").first().height == 3
    assert R.block_transaction_count(txs, blocks).first().n == 4 and R.block_transaction_count(txs, blocks, b"\x03").first().n == 0
    assert R.transaction(txs, b"\x05\x01").first().block == 5 and bytes(R.transaction_in(txs, blocks, 6, 2).first().hash) == b"\x06\x02"
    receipts = txs.select(F.col("block").alias("block_number"), F.col("index").alias("transaction_index"))
    assert [r.transaction_index for r in R.block_receipts(receipts, blocks, "0x7").collect()] == [0, 1, 2, 3]
    for bad in ("now", ""):
        with pytest.raises(ValueError):
            R.resolve(blocks, bad)
    with pytest.raises(ValueError):
        R.resolve(blocks.where("false"))


def test_state(spark, chain):
    blocks, _ = chain
    accounts = spark.createDataFrame([("a", 3, 10, 0), ("a", 5, 7, 1), ("b", 7, 1, 0)], "address string, version long, balance long, nonce long")
    assert [R.balance(accounts, blocks, "a", at).first().balance for at in (2, 4, "latest")] == [0, 10, 7]
    assert R.transaction_count(accounts, blocks, "a").first().nonce == 1 and R.transaction_count(accounts, blocks, "z").first().nonce == 0
    storage = spark.createDataFrame([("a", bytearray(b"s"), 4, bytearray(b"v"))], "address string, slot binary, version long, value binary")
    assert bytes(R.storage_at(storage, blocks, "a", b"s").first().value) == b"v" and bytes(R.storage_at(storage, blocks, "a", b"s", 3).first().value) == bytes(32)


def test_logs_and_pool(spark, chain):
    blocks, _ = chain
    logs = spark.createDataFrame([(h, 0, "a", ["t"]) for h in range(3, 8)], "block long, index int, address string, topics array<string>")
    assert [r.block for r in R.logs(logs, blocks, LogFilter()).collect()] == [7]
    assert [r.block for r in R.logs(logs, blocks, LogFilter(from_block=4, to_block=6, topics=("t",))).collect()] == [4, 5, 6]
    pool = spark.createDataFrame([("a", 0, 0, "x"), ("a", 1, 0, "y"), ("a", 3, 0, "z"), ("b", 5, 4, "w")], "sender string, nonce long, next_nonce long, hash string")
    assert tuple(R.pool_status(pool).first()) == (2, 2)
    assert {r.sender: r.by_nonce for r in R.pool_content(pool).collect()} == {"a": {"0": "x", "1": "y", "3": "z"}, "b": {"5": "w"}}
