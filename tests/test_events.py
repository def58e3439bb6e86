"""Events, logs, filters, sources and streams."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import encoding as X
from ledgerloom.operators import events as E
from ledgerloom.operators.lookups import explode_changes
from ledgerloom.sources import stores as S
from ledgerloom.streaming import streams as T

EVENTS = "id long, type string, attributes array<struct<key:string,value:string>>"


def event(i, kind, *pairs):
    return (i, kind, [{"key": k, "value": v} for k, v in pairs])


def test_attribute_maps_are_last_wins(spark):
    df = spark.createDataFrame([(1, event(1, "t", ("srcPort", "a"), ("srcPort", "b"), ("Other", None))[1:])], "i int, e struct<type:string,attributes:array<struct<key:string,value:string>>>")
    got = df.select(E.attribute_map(F.col("e"), {"src_port_info": "src_port", "other": "missing"}).alias("m")).first().m
    assert got == {"src_port": "b", "src_port_info": "b", "other": None}


def test_first_event_and_by_type(spark):
    rows = [(1, [{"type": "x", "attributes": [{"key": "k", "value": "1"}]}, {"type": "x", "attributes": [{"key": "k", "value": "Mg=="}]}, {"type": "y", "attributes": [{"key": None, "value": "1"}]}])]
    df = spark.createDataFrame(rows, "i int, e array<struct<type:string,attributes:array<struct<key:string,value:string>>>>")
    got = df.select(E.first_event(F.col("e"), "x").alias("a"), E.first_event(F.col("e"), "x", lambda m: m["k"] == "Mg==").alias("b"), E.first_event(F.col("e"), "z").alias("c"), E.events_by_type(F.col("e")).alias("d")).first()
    assert got.a == {"k": "1"} and got.b == {"k": "Mg=="} and got.c is None
    assert got.d == {"x": {"k": "2"}}


ABI = [
    {"type": "event", "name": "Transfer", "inputs": [{"name": "recipient", "type": "address", "indexed": True}, {"name": "sender", "type": "address", "indexed": True}, {"name": "packetSequence", "type": "uint256"}]},
    {"type": "event", "name": "CoinSpent", "inputs": [{"name": "spender", "type": "address", "indexed": True}, {"name": "amount", "type": "tuple[]"}]},
    {"type": "function", "name": "f"},
]


def test_conversion_to_logs(spark):
    a, b = bytes([1] * 20), bytes([2] * 20)
    decoders = {"recipient": E.account, "sender": E.account, "spender": E.account, "packet_sequence": E.unsigned, "amount": E.amount}
    convert = E.Converter(E.descriptors(ABI), decoders)
    rows = [
        event(1, "transfer", ("recipient", X.bech32_encode("acc", a)), ("sender", X.bech32_encode("oth", b)), ("packetSequence", "7")), event(2, "unknown"), event(3, "transfer", ("recipient", "x")),
        event(4, "coin_spent", ("spender", X.bech32_encode("acc", a)), ("amount", "5bbb,3aaa")), event(5, "transfer", ("recipient", "x"), ("sender", "y"), ("packetSequence", "-1")),
    ]
    df = spark.createDataFrame(rows, EVENTS)
    got = {r.id: r for r in convert.rows(df).collect()}
    assert set(got) == {1, 3, 4, 5}
    assert [bytes(t) for t in got[1].topics] == [X.keccak256(b"Transfer(address,address,uint256)"), X.abi_word(a), X.abi_word(b)]
    assert bytes(got[1].data) == X.abi_word(7) and got[1].error is None
    assert "sender not found" in got[3].error and "unsigned" in got[5].error
    assert json.loads(got[4]["values"]) == [[[3, "aaa"], [5, "bbb"]]] and got[4].data is None
    with pytest.raises(Exception, match="ValueError"):
        convert.rows(df, strict=True).collect()
    with pytest.raises(ValueError):
        E.Descriptor("E", [(f"a{i}", "uint256", True) for i in range(4)])


def test_decoders():
    assert E.amount("12", False) == [12] and E.amount("", False) == [[]]
    packet = E.packet_data("acc", "val")
    body = json.dumps({"sender": "s", "receiver": "0x" + "ab" * 20, "amount": "5", "denom": "d"}).encode().hex()
    assert packet(body, True) == ["s", "0x" + "ab" * 20]
    assert packet(body, False) == [(bytes([0xAB] * 20), "s", [(5, "d")])]
    assert E.tokens('[{"amount":"3","denom":{"base":"b","trace":[{"port_id":"p","channel_id":"c"}]}}]', False) == [[(3, ("b", [("p", "c")]))]]
    for f, v in ((E.amount, "x!"), (E.unsigned, str(2**64)), (packet, json.dumps({"receiver": "?"}).encode().hex()), (packet, "zz")):
        with pytest.raises(ValueError):
            f(v, False)
    assert E.account("not bech32", True) == ["not bech32"]


def test_routing(spark):
    t = [bytes([i] * 32) for i in range(3)]
    handlers = E.handler_table(spark, [E.Handler(t[0], "old"), E.Handler(t[0], "send", 3), E.Handler(t[1], "any")])
    logs = spark.createDataFrame([(1, [t[0], t[1], t[2]]), (2, [t[0]]), (3, [t[1]]), (4, [t[2]]), (5, [])], "i int, topics array<binary>")
    got = E.route(logs, handlers)
    assert sorted((r.i, r.handler) for r in got.collect()) == [(1, "send"), (3, "any")]
    out = E.split_outcomes(got, F.col("i") == 1, F.lit(False))
    assert {r.i: r.outcome for r in out.collect()} == {1: "error", 3: "decode_failed"}


def test_log_filters(spark):
    logs = spark.createDataFrame([(b, i, a, t) for b, i, a, t in [(1, 0, "a", ["x", "y"]), (2, 0, "b", ["x"]), (3, 0, "a", ["z", "y"]), (4, 0, "a", [])]], "block int, index int, address string, topics array<string>")
    ids = lambda f: [r.block for r in f.apply(logs).collect()]
    assert ids(E.LogFilter(topics=(["x", "z"], "y"))) == [1, 3]
    assert ids(E.LogFilter(topics=(None, "y"), from_block=2)) == [3]
    assert ids(E.LogFilter(addresses=("b",))) == [2]
    assert [r.block for r in E.LogFilter().apply(logs, latest=4).collect()] == [4]
    with pytest.raises(ValueError):
        E.LogFilter(from_block=0, to_block=10_001).predicate()
    attrs = spark.createDataFrame([({"tm.event": "Tx", "a.n": "7"},), ({"tm.event": "Tx"},)], "attributes map<string,string>")
    assert attrs.where(E.event_query("tm.event = 'Tx' AND a.n > 5")).count() == 1
    for bad in ("tm.event", "a = ", "a LIKE 'x'"):
        with pytest.raises(ValueError):
            E.event_query(bad)


def test_traces(spark):
    hop = "array<struct<port:string,channel:string>>"
    df = spark.createDataFrame([([("transfer", "channel-0"), ("p", "c")],), ([],)], f"t {hop}")
    got = df.select(E.received_trace(F.col("t"), F.lit("transfer"), F.lit("channel-0"), F.lit("transfer"), F.lit("channel-9")).alias("t")).collect()
    assert [[tuple(h) for h in r.t] for r in got] == [[("p", "c")], [("transfer", "channel-9")]]
    names = df.select(E.voucher(F.col("t"), F.lit("base")).alias("v")).collect()
    assert names[0].v.startswith("ibc/") and len(names[0].v) == 68 and names[1].v == "base"


def test_genesis(spark, tmp_path):
    from ledgerloom import schemas
    from ledgerloom.functions.denoms import Denoms

    denom = "source0x" + "a" * 40
    maps = spark.createDataFrame([(denom, "external", bytearray(20)), ("bad", "auto", bytearray(20))], schemas.MAPPING)
    text = S.export_genesis(maps, {"ibc_denom": "x", "max_callback_gas": 5})
    (tmp_path / "g.json").write_text(text)
    genesis = S.read_genesis(spark, str(tmp_path / "g.json"), schemas.GENESIS)
    back = S.genesis_mappings(genesis)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, maps.collect()))
    assert [r.denom for r in S.invalid_mappings(back, Denoms("source")).collect()] == ["bad"]
    assert S.merge_genesis({"a": [1], "b": {"c": 1, "d": [1]}}, {"a": [2], "b": {"c": 2, "d": [3]}, "e": 5}) == {"a": [1, 2], "b": {"c": 2, "d": [1, 3]}, "e": 5}
    assert S.patch_config({"a": {"b": 1, "c": [1]}}, {"a": {"c": [2]}, "d": 3}) == {"a": {"b": 1, "c": [2]}, "d": 3}
    validators = spark.createDataFrame([("a", 9, False), ("b", 9, False)], "address string, height long, jailed boolean")
    assert {r.address: (r.height, r.jailed) for r in S.zero_height(validators, validators.where("address = 'a'")).collect()} == {"a": (0, False), "b": (0, True)}


def test_tx_files_and_sending(spark, tmp_path):
    txs = spark.createDataFrame([(1, "x"), (2, "y")], "nonce int, data string")
    S.save_txs(txs, str(tmp_path / "txs"))
    assert S.load_txs(spark, str(tmp_path / "txs"), "nonce int, data string").count() == 2
    assert S.load_txs(spark, str(tmp_path / "none"), "nonce int") is None
    log = str(tmp_path / "sent")

    def send(row, log=log):
        import os

        if row["nonce"] == 2 and not os.path.exists(log + ".tried"):
            open(log + ".tried", "w").close()
            raise OSError
        with open(log, "a") as f:
            f.write(f"{row['nonce']}\n")

    S.broadcast_txs(txs, send, first_wait=0.01)
    assert sorted(open(log).read().split()) == ["1", "2"]


def test_block_source(spark, tmp_path):
    for h in range(1, 8):
        (tmp_path / f"{h}.json").write_text(json.dumps({"result": {"block": {"header": {"time": "2020-01-01T00:00:00Z"}, "data": {"txs": ["t"] * h}}}}))
    S.register(spark)
    got = spark.read.format("ledgerloom_blocks").option("url", f"file:{tmp_path}").option("from", 1).option("to", 7).option("perPartition", 3).load()
    assert sorted((r.height, len(r.txs)) for r in got.collect()) == [(h, h) for h in range(1, 8)] and got.rdd.getNumPartitions() == 3
    blocks = spark.createDataFrame([(1, bytearray(b"a")), (2, bytearray(b"b"))], "height long, hash binary")
    assert S.block_by(blocks, number=1, block_hash=b"b").first().height == 2 and S.block_by(blocks, number=1).first().height == 1
    with pytest.raises(ValueError):
        S.block_by(blocks)


def test_change_sets_explode(spark):
    wal = spark.createDataFrame([(1, "s", [(False, bytearray(b"k"), bytearray(b"v")), (True, bytearray(b"q"), None)])], "version long, name string, pairs array<struct<delete:boolean,key:binary,value:binary>>")
    assert [(r.store, r.position, r.deleted) for r in explode_changes(wal).orderBy("position").collect()] == [("s", 0, False), ("s", 1, True)]


# ------------------------------------------------------------------ streams


def test_versioned_listener_rejects_gaps(spark, tmp_path):
    batch = lambda *v: spark.createDataFrame([(x,) for x in v], "version long")
    listen = T.VersionedListener(str(tmp_path / "v"))
    listen(batch(1, 2), 0)
    listen(batch(), 1)
    listen(batch(3), 2)
    with pytest.raises(RuntimeError):
        listen(batch(5), 3)
    assert listen.version == 3


def test_subscription_ends_once(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in"))
    stream = T.read_stream(spark, str(tmp_path / "in"), "id long")
    seen = []
    subs = T.Subscriptions()
    which = subs.subscribe(T.follow(stream, T.fan_out([lambda rows, n: seen.append(rows.count()), lambda rows, n: seen.append(-rows.count())]), str(tmp_path / "c")))
    subs.queries[which].processAllAvailable()
    assert subs.unsubscribe(which) and not subs.unsubscribe(which)
    assert sum(x for x in seen if x > 0) == 5 and sum(seen) == 0


def test_packets(spark):
    rows = spark.createDataFrame([("receive", True), ("acknowledgement", True), ("acknowledgement", False), ("timeout", True)], "kind string, success boolean").withColumn("sender", F.lit("s")).withColumn("receiver", F.lit("r"))
    assert sorted((r.kind, r.credited) for r in T.convert_packets(rows).collect()) == [("acknowledgement", "s"), ("receive", "r"), ("timeout", "s")]


def test_a_silent_chain_is_halted(spark, tmp_path):
    """The timer of the idle detector: no block for half a second."""
    import time

    from ledgerloom.streaming import streams as T

    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    T.use_rocksdb(spark)
    path, schema = str(tmp_path / "blocks"), "chain long, height long, n_txs long"
    spark.createDataFrame([(1, 5, 0), (1, 6, 0)], schema).coalesce(1).write.parquet(path)
    found = []
    stream = T.detect_idle(T.read_stream(spark, path, schema), run=2, halt_ms=500)
    query = T.follow(stream, lambda rows, number: found.extend(rows.collect()), str(tmp_path / "checkpoint"), every="200 milliseconds")
    try:
        deadline = time.time() + 60
        while time.time() < deadline and not any(r.halted for r in found):
            time.sleep(0.2)
    finally:
        query.stop()
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)
    assert [(r.height, r.empty_run, r.idle) for r in found if not r.halted] == [(5, 1, False), (6, 2, True)]
    assert [(r.chain, r.height, r.halted) for r in found if r.halted] == [(1, 6, True)]
