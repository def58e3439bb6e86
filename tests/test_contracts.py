"""Edge cases of contract data, upgrades, change sets, retries and ranged windows that the twins do not reach."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.encoding import abi_pack
from ledgerloom.operators import changesets as V
from ledgerloom.operators import contracts as C
from ledgerloom.operators import messages as G
from ledgerloom.operators import stats as S
from ledgerloom.sources.stores import open_with_retry


def test_dynamic_values_are_read_as_packed_and_malformed_ones_are_null(spark):
    rng = random.Random(1)
    rows = []
    for i in range(60):
        text = "".join(rng.choice("abcdé") for _ in range(rng.randrange(70)))
        data = abi_pack(["uint256", "string", "bytes"], [i, text, text.encode() * 2])
        rows.append((i, data, text))
        rows.append((100 + i, data[: rng.randrange(len(data))], None))  # cut off somewhere
    huge = (1 << 255).to_bytes(32, "big")
    rows += [(200, huge * 3, None), (201, b"", None), (202, (32).to_bytes(32, "big") + (64).to_bytes(32, "big") + huge, None)]
    df = spark.createDataFrame([(i, bytearray(d), t) for i, d, t in rows], "i int, d binary, t string")
    got = df.select("i", "t", C.abi_text(F.col("d"), 1).alias("text"), C.abi_bytes(F.col("d"), 2).alias("raw"), C.abi_amount(F.col("d"), 0).cast("string").alias("n")).collect()
    for r in got:
        if r.i < 100:
            assert (r.text, bytes(r.raw).decode(), r.n) == (r.t, r.t * 2, str(r.i))
        elif r.i >= 200:
            assert r.text is None and r.raw is None and r.n is None or r.i == 202 and r.text is None and r.raw is None


def test_a_preinstalled_contract_does_not_replace_code(spark):
    accounts = spark.createDataFrame([(bytearray(b"a"), 3, bytearray(b"x"))], "address binary, nonce long, code binary")
    same, other = (spark.createDataFrame([(bytearray(b"a"), bytearray(c))], "address binary, code binary") for c in (b"x", b"y"))
    assert G.preinstall(accounts, same).first().nonce == 3
    with pytest.raises(Exception, match="there is code at 61"):
        G.preinstall(accounts, other).collect()


def test_store_digests_do_not_depend_on_order_but_on_every_row(spark):
    rows = [("s", bytearray(b"%d" % i), bytearray(b"v%d" % i)) for i in range(50)]
    digest = lambda r: V.store_digest(spark.createDataFrame(r, "store string, key binary, value binary")).first().digest
    assert digest(rows) == digest(rows[::-1]) != digest(rows[1:])
    assert digest(rows) != digest([("s", rows[0][1], rows[1][2]), ("s", rows[1][1], rows[0][2]), *rows[2:]])


def test_opening_is_tried_again():
    tried = []

    def open_store():
        tried.append(1)
        if len(tried) < 3:
            raise OSError("busy")
        return "open"

    assert open_with_retry(open_store, first_wait=0) == "open" and len(tried) == 3
    tried[:] = []
    with pytest.raises(OSError):
        open_with_retry(open_store, tries=2, first_wait=0)


@pytest.mark.parametrize("size", [2, 7, 1000])
def test_windows_over_ranges_equal_windows_over_the_chain(spark, size):
    rng = random.Random(size)
    heights = sorted(rng.sample(range(300), 90))
    n = {h: rng.choice([0, 0, 3]) for h in heights}
    blocks = spark.createDataFrame([(h, n[h], h * 10) for h in heights], "height long, n_txs long, s long").withColumn("ts", F.timestamp_seconds("s"))
    got = {r.height: r._n for r in S.numbered(blocks, size=size).collect()}
    assert got == {h: i for i, h in enumerate(heights)}
    before = {r.height: r.previous for r in S.gaps(blocks, size=size).collect()}
    assert before == dict(zip(heights, [None, *heights]))
    idle = {r.height for r in S.idle(blocks, run=3, size=size).collect() if r.idle}
    assert idle == {h for i, h in enumerate(heights) if i >= 2 and not any(n[x] for x in heights[i - 2 : i + 1])}
    tps = {r.height: r.tps for r in S.sliding_tps(blocks, size=size).collect()}
    for i, h in enumerate(heights):
        part = heights[max(0, i - 4) : i + 1]
        span = (part[-1] - part[0]) * 10
        assert tps[h] == pytest.approx(sum(n[x] for x in part[1:]) / span if span else 0.0)
    assert S.gaps(blocks.where("false"), size=size).count() == 0


def test_interleaved_positions(spark):
    rng = random.Random(3)
    rows = [(a, k) for a in range(20) for k in range(rng.randrange(6))]
    got = {(r.account, r.nonce): r.position for r in S.interleaved_position(spark.createDataFrame(rows, "account long, nonce long")).collect()}
    assert got == {x: i for i, x in enumerate(sorted(rows, key=lambda x: (x[1], x[0])))}


def test_too_many_peers_are_an_error(spark):
    with pytest.raises(ValueError):
        S.all_pairs(spark.range(5).select(F.col("id").cast("string").alias("peer")), most=4)
