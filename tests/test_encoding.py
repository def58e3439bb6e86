import random

from pyspark.sql import functions as F

from ledgerloom.functions import amounts as A
from ledgerloom.functions import encoding as X
from ledgerloom.functions import proto as P
from ledgerloom.functions.denoms import Denoms, snake
from ledgerloom.plans import codecs


def test_keccak_known_values():
    assert X.keccak256(b"").hex() == "c5d2460186f7233c927e7db2dcc703c0e500b653ca82273b7bfad8045d85a470"
    assert X.keccak256(b"abc").hex() == "4e03657aea45a94fc7d47ba826c8d667c0d1e6e33a64a036ec44f58fa12d6c45"
    assert X.keccak256(b"Transfer(address,address,uint256)").hex() == "ddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"
    assert len({X.keccak256(b"a" * n) for n in range(130, 140)}) == 10


def test_bech32():
    address = bytes(range(20))
    text = X.bech32_encode("acc", address)
    assert X.bech32_decode(text) == ("acc", address) and X.bech32_decode(text.upper()) == ("acc", address)
    assert X.bech32_decode("A12UEL5L") == ("a", b"")
    for bad in (text[:-1] + ("q" if text[-1] != "q" else "p"), text + "b", "", "acc1", text[:5] + text[5:].upper()):
        assert X.bech32_decode(bad) is None


def test_rlp_and_addresses():
    assert X.rlp_encode([b"cat", b"dog"]).hex() == "c88363617483646f67"
    assert X.rlp_encode(0) == b"\x80" and X.rlp_encode(15) == b"\x0f" and X.rlp_encode(1024).hex() == "820400"
    assert X.rlp_encode(b"x" * 56)[:2].hex() == "b838"
    sender = bytes.fromhex("6ac7ea33f8831ea9dcc53393aaa88b25a785dbf0")
    assert X.created_address(sender, 0).hex() == "cd234a471b72ba2f1ccf0a70fcaba648a5eecd8d"
    assert X.checksum_address(bytes.fromhex("5aaeb6053f3e94c9b9a09f33669435e7ef1beaed")) == "0x5aAeb6053F3E94C9b9A09f33669435E7Ef1BeAed"
    assert X.parse_address("0x" + "ab" * 20, "acc", "val") == bytes([0xAB] * 20)
    assert X.parse_address(X.bech32_encode("val", bytes(20)), "acc", "val") == bytes(20)
    assert X.parse_address("elsewhere", "acc", "val") is None


def test_blooms(spark):
    items = [bytes([i] * 20) for i in range(5)]
    bloom = X.bloom_of(items[:3])
    assert all(X.bloom_has(bloom, i) for i in items[:3]) and not X.bloom_has(bloom, items[4])
    rows = spark.createDataFrame([(1, bytearray(X.bloom_of([i]))) for i in items[:3]] + [(2, None)], "k int, b binary")
    got = {r.k: bytes(r.m) for r in rows.groupBy("k").agg(X.bloom_or(F.col("b")).alias("m")).collect()}
    assert got == {1: bloom, 2: bytes(256)}


def test_abi():
    values = [5, bytes([7] * 20), True, "héllo", b"\x01\x02", [1, 2, 3]]
    kinds = ["uint256", "address", "bool", "string", "bytes", "uint256[]"]
    assert X.abi_unpack(kinds, X.abi_pack(kinds, values)) == values
    assert X.abi_word(-1) == b"\xff" * 32


def test_numbers(spark):
    values = [0, 1, 255, 2**53, 2**63 - 1]
    rows = spark.createDataFrame([(v,) for v in values], "v long").select("v", X.bytes_u64(X.u64_bytes(F.col("v"))).alias("again"), X.quantity(F.col("v")).alias("q"), X.from_quantity(X.quantity(F.col("v"))).alias("back"))
    for r in rows.collect():
        assert int(r.again) == r.v == int(r.back) and r.q == hex(r.v)
    big = [0, 1, 16**15, 10**30, 2**120 - 1, 2**120, 2**256 - 1]
    rows = spark.createDataFrame([(str(v), bytearray(v.to_bytes(32, "big"))) for v in big], "t string, b binary").select("t", X.small_uint256(F.col("b")).alias("n"))
    assert {r.t: r.n and int(r.n) if r.n is not None else None for r in rows.collect()} == {str(v): v if v < 2**120 else None for v in big}
    full = spark.createDataFrame([(bytearray(b"\xff" * 8),), (None,)], "b binary").select(X.bytes_u64(F.col("b")).alias("n"))
    assert sorted(int(r.n) for r in full.collect()) == [0, 2**64 - 1]


def test_hex_and_base64(spark):
    rows = spark.createDataFrame([("0xAb01",), ("ab",), ("0xabc",), ("zz",), ("",)], "t string").select("t", X.from_hex_data(F.col("t")).alias("b"))
    assert {r.t: None if r.b is None else bytes(r.b) for r in rows.collect()} == {"0xAb01": b"\xab\x01", "ab": b"\xab", "0xabc": None, "zz": None, "": b""}
    assert X.decoded_base64("aGk=") == "hi" and X.decoded_base64("no base64!") == "no base64!" and X.decoded_base64(None) is None


def test_made_results_hold_any_height(spark):
    heights = [0, 1, 127, 128, 2**21 - 1, 2**21, 8_999_999, 2**35, 2**63 - 1]
    rows = spark.createDataFrame([(h, h // 3, "ab" * 32) for h in heights], "h long, i long, hash string")
    made = codecs.with_tx_result(rows, F.col("h"), F.col("i"), F.col("hash"), F.lit(True), "value").withColumn("r", P.decode_tx_result(F.col("value")))
    assert {(r.h, r.i): (r.r.height, r.r["index"], r.r.events[0].attributes[1].value) for r in made.collect()} == {(h, h // 3): (h, h // 3, "ab" * 32) for h in heights}
    numbers = [*heights, -1, -(2**63)]
    got = spark.createDataFrame([(n,) for n in numbers], "n long").select("n", P.varint_of(F.col("n")).alias("v")).collect()
    assert {r.n: bytes(r.v) for r in got} == {n: P.put_varint(n) for n in numbers}


def test_proto_round_trip(spark):
    events = [("ethereum_tx", [("ethereumTxHash", "0x" + "1" * 64), ("amount", "5")]), ("other", [])]
    data = P.encode_tx_result(12, 3, b"tx", events, code=5, log="bad", gas_used=77)
    got = P.tx_result(data)
    assert (got["height"], got["index"], got["tx"], got["code"], got["log"], got["gas_used"]) == (12, 3, b"tx", 5, "bad", 77)
    assert got["events"][0]["attributes"][0] == {"key": "ethereumTxHash", "value": "0x" + "1" * 64}
    assert P.tx_result(b"\xff\xff") is None
    rows = spark.createDataFrame([(bytearray(data),), (bytearray(b"\xff\xff"),), (None,)], "v binary").select(P.decode_tx_result(F.col("v")).alias("r"))
    assert sorted((r.r.gas_used if r.r else -1) for r in rows.collect()) == [-1, -1, 77]


def test_meta_hash():
    h = bytes([9] * 32)
    assert P.meta_hash(bytes.fromhex("0a220a20") + h + bytes.fromhex("1200")) == h
    assert P.meta_hash(bytes(10)) is None and P.meta_hash(bytes(60)) is None
    assert P.meta_hash(b"\x08\x01" + bytes.fromhex("0a220a20") + h) == h


def test_state_files(spark, tmp_path):
    rng = random.Random(1)
    pairs = [("acc", bool(i % 2), bytes([i]), rng.randbytes(i * 40)) for i in range(9)]
    (tmp_path / "block-1-data").write_bytes(P.encode_state_pairs(pairs))
    got = P.read_state_files(spark.read.format("binaryFile").load(str(tmp_path))).orderBy("position").collect()
    assert [(r.store, r.deleted, bytes(r.key), bytes(r.value)) for r in got] == pairs


def test_amounts(spark):
    rows = spark.createDataFrame([(123 * 10**8,), (5,), (10**10,), (10**10 + 1,)], "a long")
    got = [(int(r.u), int(r.r), int(r.d), None if r.b is None else int(r.b)) for r in rows.select(A.scale_up(F.col("a")).alias("u"), A.remainder(F.col("a")).alias("r"), A.scale_down(F.col("a")).alias("d"), A.burnable(F.col("a")).alias("b")).collect()]
    assert got == [(a * 10**10, a % 10**10, a // 10**10, a - a % 10**10 or None) for a in (123 * 10**8, 5, 10**10, 10**10 + 1)]
    coins = {"10a aa": None, "10aaa,5bbb,2aaa": "12aaa,5bbb", "": "", "7": None, "0aaa": "", "ibc": None}
    rows = spark.createDataFrame([(t,) for t in coins], "t string")
    got = {r.t: r.c for r in rows.select("t", F.array_join(F.transform(A.parse_coins(F.col("t")), lambda c: F.concat(c["amount"].cast("string"), c["denom"])), ",").alias("c")).collect()}
    assert got == coins
    assert A.even_split(10, 3) == [(0, 4), (4, 7), (7, 10)] and A.batches(10, 4) == [(0, 4), (4, 8), (8, 10)] and A.batches(3, 0) == [(0, 1), (1, 2), (2, 3)]


def test_denoms(spark):
    d = Denoms("source")
    cases = {"ibc/" + "A" * 64: (True, False, None), "ibc/" + "A" * 63: (False, False, None), "gravity0x" + "a" * 40: (True, False, "0x" + "a" * 40), "source0x" + "b" * 40: (True, True, "0x" + "b" * 40), "source0x" + "z" * 40: (True, True, None), "aaa": (False, False, None)}
    rows = spark.createDataFrame([(k,) for k in cases], "k string").select("k", d.is_valid(F.col("k")).alias("v"), d.is_source(F.col("k")).alias("s"), d.contract(F.col("k")).alias("c"))
    assert {r.k: (r.v, r.s, r.c) for r in rows.collect()} == cases
    assert snake("PacketSrcChannel") == "packet_src_channel" and snake("ABc") == "a_bc" and snake("") == ""
