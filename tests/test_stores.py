"""Stores: copy, verify, merge and patches over synthetic chains."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import proto as P
from ledgerloom.functions.keys import HeightSpec, parse_heights
from ledgerloom.operators import migrate as M
from ledgerloom.operators import patch as T
from ledgerloom.sources import stores as S

KV = "key binary, key_text string, value binary"


def store(spark, rows):
    return spark.createDataFrame([(bytearray(k), k.decode("latin-1"), bytearray(v)) for k, v in rows], KV)


def blocks(low, high):
    out = []
    for h in range(low, high + 1):
        digest = bytes([h % 256] * 32)
        out += [(f"H:{h}".encode(), bytes.fromhex("0a220a20") + digest + bytes.fromhex("1200")), (f"P:{h}:0".encode(), b"part"), (f"C:{h}".encode(), b"commit"), (f"SC:{h}".encode(), b"seen"), (f"EC:{h}".encode(), b"ext"), (b"BH:" + digest, str(h).encode())]
    return out + [(b"BS:H", str(high).encode())]


def eth_hash(h, i):
    return f"0x{100 * h + i:064d}"


def txs(low, high, per=2):
    out = []
    for h in range(low, high + 1):
        for i in range(per):
            name = f"txhash-{h}-{i}".encode()
            evm = i % 2 == 0
            events = [("ethereum_tx", [("ethereumTxHash", eth_hash(h, i))])] if evm else []
            out += [(f"tx.height/{h}/{h}/{i}".encode(), name), (name, P.encode_tx_result(h, i, b"tx", events))]
            if evm:
                key = f"ethereum_tx.ethereumTxHash/{eth_hash(h, i)}/{h}/{i}"
                out += [(key.encode(), name), ((key + "$es$0").encode(), name)]
    return out


def keys(df):
    return sorted(bytes(r.key) for r in df.collect())


def test_patch_blocks(spark):
    source, target = store(spark, blocks(1, 12)), store(spark, blocks(1, 5))
    patch = T.patch_blocks(source, parse_heights("7"))
    got = keys(patch.rows)
    assert got == sorted([b"H:7", b"P:7:0", b"C:7", b"SC:7", b"EC:7", b"BH:" + bytes([7] * 32)])
    assert patch.processed.first().processed == 5  # the hash index is not counted
    merged = M.merge(target, patch.rows.select(*target.columns), "replace")
    assert b"H:7" in keys(merged) and b"H:6" not in keys(merged) and b"H:70" not in keys(merged)
    assert T.patch_blocks(source, parse_heights("4-7"), target, "skip").processed.first().processed == 10
    assert {r.family for r in patch.rows.collect()} == {"H", "P", "C", "SC", "EC", "BH"}
    with pytest.raises(ValueError):
        T.patch_blocks(source, HeightSpec())


def test_patch_txs(spark):
    source, target = store(spark, txs(1, 10, 12)), store(spark, txs(1, 5, 12))
    patch = T.patch_txs(source, parse_heights("7"))
    got = keys(patch.rows)
    want = [k for k, _ in txs(7, 7, 12)]
    assert got == sorted(want)
    assert patch.total.first().total == 12 and patch.processed.first().processed == len(want)
    assert T.patch_txs(source, parse_heights("5"), target, "skip").processed.first().processed == 0
    assert T.patch_txs(source, parse_heights("5"), target, "skip", skip_checks=True).processed.first().processed == len(want)


def test_event_index_is_a_prefix(spark):
    """A transaction with index 1 also finds events of 10 and 11 under its hash and height."""
    h = "0x" + "a" * 64
    rows = [(b"tx.height/3/3/1", b"t1"), (b"t1", P.encode_tx_result(3, 1, b"", [("ethereum_tx", [("ethereumTxHash", "a" * 64)])]))]
    rows += [(f"ethereum_tx.ethereumTxHash/{h}/{height}/{i}".encode(), b"t1") for height, i in ((3, "1"), (3, "10"), (3, "11$es$0"), (3, "2"), (4, "1"))]
    got = T.patch_txs(store(spark, rows), parse_heights("3")).rows.where("family = 'eth_event'")
    assert sorted(r.key_text.rsplit("/", 2)[1:] for r in got.collect()) == [["3", "1"], ["3", "10"], ["3", "11$es$0"]]


def test_eth_hash_of_first_event(spark):
    cases = [([("ethereum_tx", [("ethereumTxHash", "0x" + "b" * 64)]), ("ethereum_tx", [("ethereumTxHash", "0x" + "c" * 64)])], "0x" + "b" * 64), ([("ethereum_tx", [("x", "y")])], None), ([], None), ([("ethereum_tx", [("ethereumTxHash", "short")])], None)]
    rows = [(i, [{"type": t, "attributes": [{"key": k, "value": v} for k, v in a]} for t, a in events]) for i, (events, _) in enumerate(cases)]
    got = spark.createDataFrame(rows, "i int, events array<struct<type:string,attributes:array<struct<key:string,value:string>>>>").select("i", T.eth_hash_of(F.col("events")).alias("h"))
    assert {r.i: r.h for r in got.collect()} == {i: want for i, (_, want) in enumerate(cases)}


@pytest.mark.parametrize("missing,differing,extra,want", [(0, 0, 0, 0), (1, 0, 0, 1), (0, 1, 0, 1), (0, 0, 1, 2), (1, 0, 1, 3)])
def test_verify_counts(spark, missing, differing, extra, want):
    base = [(f"key-{i:06d}".encode(), b"v") for i in range(30)]
    other = [(k, b"x" if i < differing else v) for i, (k, v) in enumerate(base)][: 30 - missing] + [(b"new", b"v")] * extra
    assert M.verify_counts(store(spark, base), store(spark, other)).first().mismatches == want


def test_patch_then_verify_finds_nothing_missing(spark):
    rng = random.Random(3)
    for _ in range(3):
        source = {f"k{rng.randrange(60)}".encode(): rng.randbytes(3) for _ in range(40)}
        target = {f"k{rng.randrange(60)}".encode(): rng.randbytes(3) for _ in range(40)}
        s, t = store(spark, source.items()), store(spark, target.items())
        for policy, want in (("skip", source | target), ("replace", target | source)):
            merged = M.merge(t, s, policy)
            assert {bytes(r.key): bytes(r.value) for r in merged.collect()} == want
            assert M.verify_counts(s, merged).first().missing == 0
    yes = spark.createDataFrame([(bytearray(b"k1"), True)], "key binary, replace boolean")
    a, b = store(spark, [(b"k1", b"t"), (b"k2", b"t")]), store(spark, [(b"k1", b"s"), (b"k2", b"s"), (b"k3", b"s")])
    assert {bytes(r.key): bytes(r.value) for r in M.merge(a, b, "ask", yes).collect()} == {b"k1": b"s", b"k2": b"t", b"k3": b"s"}
    assert {bytes(r.key): r.exists for r in M.conflicts(b, a).collect()} == {b"k1": True, b"k2": True, b"k3": False}
    with pytest.raises(ValueError):
        M.merge(a, b, "other")


def test_scans_and_includes(spark):
    rows = store(spark, blocks(1, 20))
    assert M.block_scan(rows, parse_heights("9-10")).count() == 10
    assert M.block_scan(rows).count() == 20 * 6 + 1
    assert [bytes(r.key) for r in M.scan(rows, ordered=True).collect()] == sorted(k for k, _ in blocks(1, 20))
    kept = rows.where(M.includes("blockstore", F.col("key_text"), parse_heights("9"))).collect()
    assert len(kept) == 5 + 20 + 1  # keys without a height stay
    assert rows.where(M.includes("state", F.col("key_text"), parse_heights("9"))).count() == rows.count()
    assert M.get(rows, b"BS:H").first().value == b"20" and M.get(rows, b"none").count() == 0


def test_migrate_and_publish(spark, tmp_path):
    dbs = {"state": store(spark, blocks(1, 3)), "tx_index": store(spark, txs(1, 3))}
    got = M.migrate(dbs, str(tmp_path / "out"), source_backend="goleveldb", target_backend="parquet").collect()
    assert all(r.total == r.processed and r.mismatches == 0 for r in got)
    with pytest.raises(ValueError):
        M.migrate(dbs, str(tmp_path / "out"), source_backend="parquet", target_backend="parquet")
    path = S.stage_then_publish(dbs["state"], str(tmp_path / "published"))
    assert spark.read.parquet(path).count() == dbs["state"].count()
    with pytest.raises(FileExistsError):
        S.stage_then_publish(dbs["state"], path)
    S.write_store(dbs["state"].withColumn("db", F.lit("state")), str(tmp_path / "export"))
    assert keys(S.read_store(spark, str(tmp_path / "export"), "state")) == keys(dbs["state"])


def test_store_diff_and_progress(spark):
    a = spark.createDataFrame([("s", bytearray(b"k1"), bytearray(b"1")), ("s", bytearray(b"ik"), bytearray(b"1")), ("t", bytearray(b"k"), bytearray(b"1"))], "store string, key binary, value binary")
    b = a.where("store = 's'").withColumn("value", F.lit(b"2"))
    got = M.store_diff(a, b, {"s": [b"i"]})
    assert sorted((r.store, bytes(r.key)) for r in got.collect()) == [("s", b"k1"), ("t", b"k")]
    rows = spark.createDataFrame([(0, 0), (1, 4)], "p int, t int").select(M.progress(F.col("p"), F.col("t")).alias("x"))
    assert [r.x for r in rows.collect()] == [0.0, 25.0]
