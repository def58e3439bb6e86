"""Lookups, ledgers, block lists, statistics and receipts against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.denoms import Denoms
from ledgerloom.operators import blocklist as B
from ledgerloom.operators import ledger as L
from ledgerloom.operators import lookups as K
from ledgerloom.operators import receipts as R
from ledgerloom.operators import stats as S


def test_mappings(spark):
    c = [bytes([i] * 20) for i in range(4)]
    maps, back = spark.createDataFrame([], "denom string, kind string, contract binary"), spark.createDataFrame([], "contract binary, denom string")
    maps, back = K.set_auto(maps, back, "d", c[1])
    maps, back = K.set_external(maps, back, "d", c[2])
    row = K.contract_by_denom(spark.createDataFrame([("d",)], "denom string"), maps).first()
    assert (bytes(row.contract), bytes(row.external), bytes(row.auto)) == (c[2], c[2], c[1])
    assert back.count() == 2  # both reverse rows remain
    for taken in (c[1], c[2]):
        with pytest.raises(ValueError):
            K.set_external(maps, back, "e", taken)
    maps, back = K.set_external(maps, back, "d", c[3])
    assert {bytes(r.contract) for r in back.collect()} == {c[1], c[3]}
    maps, back = K.update_mapping(maps, back, "d", None)
    assert {r.kind for r in maps.collect()} == {"auto"} and back.count() == 1
    with pytest.raises(Exception, match="no contract"):
        K.contract_by_denom(spark.createDataFrame([("x",)], "denom string"), maps).collect()


def test_channel_of_voucher(spark):
    traces = spark.createDataFrame([("AB", [("transfer", "channel-7"), ("p", "q")])], "hash string, trace array<struct<port:string,channel:string>>")
    rows = spark.createDataFrame([("ibc/ab",), ("ibc/CD",), ("ibc/a/b",), ("x",)], "denom string")
    assert {r.denom: r.channel for r in K.channel_of_voucher(rows, traces).collect()} == {"ibc/ab": "channel-7", "ibc/CD": None, "ibc/a/b": None, "x": None}


def test_change_sets_fold_as_a_loop(spark):
    rng = random.Random(2)
    rows, state = [], {}
    for v in range(120):
        k, gone = rng.randrange(15), rng.random() < 0.3
        rows.append((v // 4, v % 4, k, v, gone))
        state.pop(k, None) if gone else state.__setitem__(k, v)
    df = spark.createDataFrame(rows, "version int, position int, key int, value int, deleted boolean")
    got = K.fold_changes(df, ["key"], ["version", "position"])
    assert {r.key: r.value for r in got.collect()} == state
    seen = {}
    for v, _, k, x, _ in rows:
        if v <= 11:
            seen[k] = x
    flat = df.withColumn("version", F.col("version") * 4 + F.col("position"))
    assert {r.key: r.value for r in K.as_of(flat, ["key"], 47).collect()} == seen
    up = K.apply_upgrades(spark.createDataFrame([("a", 1), ("b", 2)], "store string, v int"), [{"name": "c", "rename_from": "a"}, {"name": "b", "delete": True}])
    assert [tuple(r) for r in up.collect()] == [("c", 1)]


def test_permissions(spark):
    rows = spark.createDataFrame([(0,), (1,), (2,), (3,)], "p long").select("p", K.has_permission(F.col("p"), 3).alias("all"), K.has_permission(F.col("p"), 0).alias("none"))
    assert [(r.all, r.none) for r in rows.orderBy("p").collect()] == [(False, True)] * 3 + [(True, True)]


def test_try_commit(spark):
    t = spark.createDataFrame([(1, 5)], "k int, v int")
    spend = lambda n: lambda d: d.withColumn("v", F.col("v") - n)
    bad = lambda d: d.where("v < 0")
    assert K.try_commit(t, spend(9), bad)[0].first().v == 5 and K.try_commit(t, spend(3), bad)[0].first().v == 2


def test_conversions_keep_supply(spark):
    d = Denoms("source")
    source, ibc = "source0x" + "a" * 40, "ibc/" + "B" * 64
    rows = spark.createDataFrame([(1, "u", "base", 123, None), (2, "u", ibc, 7, "c1"), (3, "v", source, 9, "c2"), (4, "v", "junk", 1, "c3"), (5, "v", ibc, 1, None)], "seq long, address string, denom string, amount long, contract string").withColumn("amount", F.col("amount").cast("decimal(38,0)"))
    entries, rejected = L.vouchers_to_evm(rows, base_denom="base", evm_denom="evm", denoms=d)
    got = {(r.address, r.denom): int(r.amount) for r in L.balances(entries).collect()}
    assert got == {("u", "base"): -123, ("module", "base"): 123, ("u", "evm"): 123 * 10**10, ("u", ibc): -7, ("c1", ibc): 7, ("u", "token/c1"): 7, ("v", source): -9, ("c2", "token/c2"): -9, ("v", "token/c2"): 9}
    assert sorted(r.seq for r in rejected.collect()) == [4, 5]
    out, rejected = L.transfer_out(spark.createDataFrame([(1, "u", "evm", 25 * 10**9), (2, "u", "evm", 5), (3, "u", "other", 5)], "seq long, address string, denom string, amount long").withColumn("amount", F.col("amount").cast("decimal(38,0)")), base_denom="base", evm_denom="evm", denoms=d)
    assert {(r.address, r.denom): int(r.amount) for r in L.balances(out).collect()} == {("u", "evm"): -2 * 10**10, ("module", "base"): -2, ("transfer", "base"): 2}
    assert [r.seq for r in rejected.collect()] == [3]


def test_overdrawn(spark):
    ops = [(1, "mint", None, "a", 10), (2, "transfer", "a", "b", 7), (3, "burn", "a", None, 4), (4, "burn", "b", None, 7)]
    rows = operations(spark, ops)
    assert [r.seq for r in L.overdrawn(L.token_ledger(rows)).collect()] == [3]
    assert {(r.address): int(r.amount) for r in L.balances(L.valid_operations(rows)).collect()} == {"a": 3}


def operations(spark, ops):
    return spark.createDataFrame([(s, o, "t", x, y, n) for s, o, x, y, n in ops], "seq long, op string, token string, sender string, receiver string, amount long").withColumn("amount", F.col("amount").cast("decimal(38,0)"))


def applied(ops):
    """What a contract accepts, one operation after another."""
    balance, accepted = {}, {}
    for seq, op, sender, receiver, n in sorted(ops, key=lambda o: o[0]):
        fine = n is not None and n >= 0 and (op == "mint" or (op in ("burn", "transfer") and balance.get(sender, 0) >= n))
        accepted[seq] = fine
        if fine and op != "mint":
            balance[sender] = balance.get(sender, 0) - n
        if fine and op != "burn":
            balance[receiver] = balance.get(receiver, 0) + n
    return accepted


def test_a_refused_operation_changes_nothing(spark):
    ops = [(1, "mint", None, "a", 5), (2, "transfer", "a", "b", 10), (3, "transfer", "a", "b", 3), (4, "transfer", "b", "c", 10)]
    assert {r.seq: r.accepted for r in L.guarded(operations(spark, ops)).collect()} == applied(ops) == {1: True, 2: False, 3: True, 4: False}
    assert {r.address: int(r.amount) for r in L.balances(L.valid_operations(operations(spark, ops))).collect()} == {"a": 2, "b": 3}


def test_guard_equals_a_loop(spark):
    rng = random.Random(4)
    ops = [(i, rng.choice(["mint", "burn", "transfer", "transfer", "transfer"]), rng.choice("abcde"), rng.choice("abcde"), rng.randrange(12)) for i in range(80)]
    ops += [(300, "other", "a", "b", 1), (301, "transfer", "a", "a", 10**6), (302, "mint", None, "a", None), (303, "mint", None, "a", -3)]
    for limit in (10**6, 0):
        assert {r.seq: r.accepted for r in L.guarded(operations(spark, ops), fold_limit=limit, size=16).collect()} == applied(ops)
    assert L.guarded(operations(spark, ops).where("false")).count() == 0


def test_guard_of_operations_that_depend_on_each_other_in_a_row(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(L, "checkpointed", lambda df, keep=L.checkpointed: rounds.append(1) or keep(df))
    ops = [(1, "mint", None, "x0", 10), *[(2 + k, "transfer", f"x{k}", f"x{k + 1}", 10 - k % 2) for k in range(20)]]
    ops += [(30, "transfer", None, "x1", 1), (31, "mint", "x1", None, 4), (32, "transfer", None, "x1", 4), (33, "burn", None, None, 1)]
    assert {r.seq: r.accepted for r in L.guarded(operations(spark, ops), fold_limit=0, size=4).collect()} == applied(ops)
    assert len(rounds) <= 6  # the state, and a round for each halving


@pytest.mark.parametrize("limit", [10**6, 0])
def test_guard_adds_balances_of_38_digits_exactly(spark, limit):
    big = 10**37
    ops = [(1, "mint", None, "a", big + 1), (2, "burn", "a", None, big + 2), (3, "transfer", "a", "b", big), (4, "burn", "a", None, 1), (5, "burn", "b", None, big + 1), (6, "burn", "b", None, big)]
    rows = spark.createDataFrame([(s, o, "t", x, y, str(n)) for s, o, x, y, n in ops], "seq long, op string, token string, sender string, receiver string, amount string").withColumn("amount", F.col("amount").cast("decimal(38,0)"))
    assert {r.seq: r.accepted for r in L.guarded(rows, fold_limit=limit, size=4).collect()} == applied(ops)


def test_proposals(spark):
    names = ["valid1", "invalid", "valid2", "invalid", "valid3"]
    rows = [(1, i, [n], "to", None, None) for i, n in enumerate(names)] + [(2, 0, ["x"], None, ["invalid"], None), (3, 0, ["x"], "y", None, ["z"])]
    txs = spark.createDataFrame(rows, "block int, position int, signers array<string>, `to` string, authorities array<string>, targets array<string>")
    blocked = spark.createDataFrame([("invalid",)], "address string")
    kept = B.filter_proposal(txs, blocked).where("block = 1").orderBy("new_position").collect()
    assert [r.signers[0] for r in kept] == ["valid1", "valid2", "valid3"]
    assert {r.block: r.accepted for r in B.accept_blocks(txs, blocked).collect()} == {1: False, 2: False, 3: True}
    assert B.filter_proposal(txs, blocked.where("false")).count() == len(rows)


def test_block_list_memo(spark):
    def decode(blob):
        if blob == b"bad":
            raise ValueError
        return blob.decode().split(",")

    memo = B.BlockListMemo(spark, decode)
    assert memo.refresh(b"a,b") and memo.active.count() == 2 and not memo.refresh(b"a,b")
    assert not memo.refresh(b"bad") and memo.active.count() == 2 and memo.blob == b"bad" and not memo.refresh(b"bad")
    assert not memo.refresh(b"c", has_identity=False) and memo.refresh(b"") and memo.active.count() == 0


def test_mempool_and_fees(spark):
    rows = spark.createDataFrame([("a", 0, 1), ("a", 1, 9), ("b", 0, 5), ("b", 1, 3)], "sender string, nonce int, priority int")
    assert [(r.sender, r.nonce) for r in B.mempool_order(rows).collect()] == [("b", 0), ("b", 1), ("a", 0), ("a", 1)]
    assert B.mempool_order(rows, 2).count() == 2
    bump = spark.createDataFrame([(15, 16), (15, 17), (9, 9), (10, 10)], "o long, n long").select(B.replaces(F.col("o"), F.col("n"), 10).alias("r"))
    assert [r.r for r in bump.collect()] == [n >= o * 110 // 100 for o, n in ((15, 16), (15, 17), (9, 9), (10, 10))]


def tps_loop(blocks, window=5):
    out = []
    for i in range(len(blocks)):
        part = blocks[max(0, i - window + 1) : i + 1]
        seconds = part[-1][1] - part[0][1]
        out.append(sum(n for _, _, n in part[1:]) / seconds if len(part) > 1 and seconds > 0 else 0)
    return out


def test_tps_equals_a_loop(spark):
    rng = random.Random(4)
    t, blocks = 0, []
    for h in range(90):
        t += rng.choice([0, 1, 2, 7])
        blocks.append((h, t, rng.randrange(50)))
    df = spark.createDataFrame(blocks, "height long, s long, n_txs int").withColumn("ts", F.timestamp_seconds("s"))
    want = [round(x, 9) for x in tps_loop(blocks)]
    assert [round(r.tps, 9) for r in S.sliding_tps(df).orderBy("height").collect()] == want
    assert [round(r.tps, 9) for r in S.sliding_tps_blocked(df, size=7).orderBy("height").collect()] == want
    assert [round(r.tps, 9) for r in S.top_tps(S.sliding_tps(df)).collect()] == sorted(want, reverse=True)[:5]
    assert S.stats_lines(S.sliding_tps(df)).count() == 91


def test_idle_gaps_nonces_interleave(spark):
    rows = spark.createDataFrame([(h, 0 if h in (2, 3, 4, 8) else 1) for h in (1, 2, 3, 4, 5, 7, 8)], "height int, n_txs int")
    assert [r.height for r in S.idle(rows, 3).where("idle").collect()] == [4]
    assert [r.height for r in S.gaps(rows).where("not consecutive").collect()] == [7]
    txs = spark.createDataFrame([(a, i) for a in "abc" for i in range({"a": 3, "b": 1, "c": 2}[a])], "account string, nonce int")
    assert [tuple(r) for r in S.interleave(txs).collect()] == [("a", 0), ("b", 0), ("c", 0), ("a", 1), ("c", 1), ("a", 2)]
    assert [r.position for r in S.interleaved_position(txs).orderBy("nonce", "account").collect()] == list(range(6))
    parts = S.even_parts(spark.range(10).withColumnRenamed("id", "i"), "i", 10, 3).groupBy("part").count().orderBy("part").collect()
    assert [r["count"] for r in parts] == [4, 3, 3]


def receipts_loop(messages):
    out, cumulative, index = [], {}, {}
    for block, tx, msg, gas, code, log, failed, is_evm in sorted(messages):
        if code != 0 and R.OVER_LIMIT not in log:
            continue
        if not is_evm:
            if code == 0:
                cumulative[block] = cumulative.get(block, 0) + gas
            continue
        cumulative[block] = cumulative.get(block, 0) + gas
        out.append((block, tx, msg, index.get(block, 0), cumulative[block], 0 if code or failed else 1))
        index[block] = index.get(block, 0) + 1
    return out


def test_receipts_equal_a_loop(spark):
    rng = random.Random(9)
    rows = [(b, t, m, rng.randrange(1, 100), code, log, rng.random() < 0.2, rng.random() < 0.7) for b in range(6) for t in range(8) for code, log in [rng.choice([(0, ""), (5, "x"), (11, R.OVER_LIMIT + " 5")])] for m in range(rng.randrange(1, 4))]
    df = spark.createDataFrame(rows, "block int, tx int, msg int, gas_used int, code int, log string, failed boolean, is_evm boolean")
    got = [(r.block, r.tx, r.msg, r.tx_index, r.cumulative_gas_used, r.status) for r in R.cumulative_gas(df).orderBy("block", "tx", "msg").collect()]
    assert got == receipts_loop(rows)
    assert R.replay_cumulative_gas(df).count() == len(got)


def test_golden_batch(spark):
    """Three messages of one transaction: indexes 0, 1, 2 and prefix sums."""
    df = spark.createDataFrame([(1, 0, m, g, 0, "", False, True) for m, g in enumerate((564724, 51531, 21000))], "block int, tx int, msg int, gas_used int, code int, log string, failed boolean, is_evm boolean")
    got = R.cumulative_gas(df).orderBy("msg").collect()
    assert [(r.tx_index, r.cumulative_gas_used) for r in got] == [(0, 564724), (1, 616255), (2, 637255)]
    fixed = R.fix_last_receipt(R.replay_cumulative_gas(df), F.lit(True), F.lit(30000)).orderBy("tx_index").collect()
    assert [(r.status, r.gas_used, r.cumulative_gas_used) for r in fixed] == [(1, 564724, 564724), (1, 51531, 616255), (0, 30000, 646255)]


def test_message_pairs_must_match(spark):
    good = spark.createDataFrame([(1, ["a", "b"], [1, 2])], "tx int, msgs array<string>, outcomes array<int>")
    assert [(r.msg, r.message, r.outcome) for r in R.pair_messages(good).collect()] == [(0, "a", 1), (1, "b", 2)]
    bad = spark.createDataFrame([(1, ["a"], [1, 2])], "tx int, msgs array<string>, outcomes array<int>")
    with pytest.raises(Exception, match="differs"):
        R.pair_messages(bad).collect()


def test_validators_and_pairs(spark):
    from ledgerloom.functions.encoding import bech32_encode
    from ledgerloom.operators import checks as C

    good = bech32_encode("acc", bytes(20))
    params = spark.createDataFrame([("ibc_denom", "ibc/" + "A" * 64), ("ibc_denom", "x"), ("ibc_timeout", "5"), ("ibc_timeout", str(2**64)), ("max_callback_gas", "0"), ("enable_auto_deployment", "true"), ("enable_auto_deployment", "yes"), ("admin", ""), ("admin", good), ("admin", "a"), ("other", "1")], "name string, value string")
    assert sorted(map(tuple, C.parameter_errors(params, Denoms("source")).select("name", "value").collect())) == sorted([("ibc_denom", "x"), ("ibc_timeout", str(2**64)), ("max_callback_gas", "0"), ("enable_auto_deployment", "yes"), ("admin", "a"), ("other", "1")])
    rows = spark.createDataFrame([(1, good, [("a", 1), ("b", 2)]), (2, "x", [("a", 1)]), (3, good, []), (4, good, [("b", 1), ("a", 1)]), (5, good, [("a", 0)]), (6, None, None)], "id int, address string, coins array<struct<denom:string,amount:long>>")
    assert {r.id: r.error for r in C.message_errors(rows, "acc").collect()} == {2: "invalid address", 3: "invalid coins", 4: "invalid coins", 5: "invalid coins", 6: "invalid address"}
    pairs = spark.createDataFrame([(bytearray(b"\x01abc"), bytearray(b"\x05")), (bytearray(b"\x03\xff"), bytearray(b"den")), (bytearray(b"\x09"), bytearray(b""))], "key binary, value binary")
    assert sorted((r.kind, r.name, r.shown) for r in C.decode_pairs(pairs).collect()) == [("external_contract", "abc", "0x05"), ("reverse_denom", "0xff", "den"), ("unknown", "0x", "0x")]
    versions = spark.createDataFrame([("a", 1), ("a", 2), ("a", 9), ("b", 3), ("c", 1), ("c", 8), ("c", 10)], "k string, version int")
    kept = sorted(map(tuple, C.prune(versions, 3, ["k"]).collect()))
    assert kept == [(k, v) for k, v in sorted([("a", 2), ("a", 9), ("b", 3), ("c", 1), ("c", 8), ("c", 10)])]
    txs = spark.createDataFrame([(h, i) for h in range(5) for i in range(3)], "height int, index int")
    assert [tuple(r) for r in C.search_txs(txs, F.col("height") > 0, page=2, per_page=2, descending=True).collect()] == [(4, 0), (3, 2)]
