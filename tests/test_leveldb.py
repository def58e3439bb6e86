"""LevelDB files against the public format: known checksums, cut records, block borders, and a store put together by hand."""

import struct

import pyarrow as pa
import pytest

from ledgerloom.functions.proto import put_varint
from ledgerloom.sources import leveldb as L


def unmask(v):
    v = (v - 0xA282EAD8) & 0xFFFFFFFF
    return ((v >> 17) | (v << 15)) & 0xFFFFFFFF


def test_checksums_are_crc32c():
    got = [unmask(v) for v in L.masked_crcs([b"123456789", b"", bytes(32), b"\xff" * 32, b"a"])]
    assert got == [0xE3069283, 0, 0x8A9136AA, 0x62A8AB43, 0xC1D04330]  # published values


def test_records_are_cut_at_block_borders():
    records = [b"a" * 10, b"", b"b" * 40_000, b"c" * (L.LOG_BLOCK - 7), b"d" * 32_000, b"e" * 761, b"f" * 100_000]
    data = L.encode_log(records)
    assert list(L.log_records(data)) == records
    assert list(L.log_records(data[:-1])) == records[:-1]
    assert list(L.log_records(b"")) == [] and list(L.log_records(data + bytes(500))) == records


def test_tables_keep_order_and_prefixes():
    entries = [(b"key-%06d" % i, b"v" * (i % 300), i, i % 7 == 0) for i in range(3000)]
    data, low, high = L.encode_table(entries)
    assert [(k, v or b"", s, d) for k, v, s, d in L.table_entries(data)] == [(k, b"" if d else v, s, d) for k, v, s, d in entries]
    assert low[:-8] == b"key-000000" and high[:-8] == b"key-002999"
    with pytest.raises(ValueError):
        list(L.table_entries(data[:-1]))


def test_a_store_put_together_by_hand(spark, tmp_path):
    """Two tables of one key range, one of them Snappy, one replaced; a live log and an old one."""

    def snappy(data):
        body = data[: data.index(L._encode_block([(b"z" + struct.pack("<Q", 5 << 8 | 1), b"packed")]))]
        block = L._encode_block([(b"z" + struct.pack("<Q", 5 << 8 | 1), b"packed")])
        assert body == b""
        packed = pa.compress(block, codec="snappy", asbytes=True)
        out = bytearray(packed + b"\x01" + bytes(4))
        index = L._encode_block([(b"z" + bytes(8), put_varint(0) + put_varint(len(packed)))])
        at = len(out)
        out += index + b"\0" + bytes(4)
        return bytes(out) + (put_varint(0) + put_varint(0) + put_varint(at) + put_varint(len(index))).ljust(40, b"\0") + struct.pack("<Q", L.MAGIC)

    text = lambda b: put_varint(len(b)) + b
    new = lambda n, level: put_varint(7) + put_varint(level) + put_varint(n) + put_varint(1) + text(b"a" + bytes(8)) + text(b"z" + bytes(8))
    table = lambda entries: L.encode_table(entries)[0]
    (tmp_path / "000005.ldb").write_bytes(table([(b"a", b"old", 1, False), (b"b", b"kept", 2, False), (b"c", b"gone", 3, False)]))
    (tmp_path / "000006.sst").write_bytes(table([(b"a", b"newer", 4, False), (b"c", None, 4, True)]))
    (tmp_path / "000004.ldb").write_bytes(table([(b"dead", b"file", 9, False)]))
    (tmp_path / "000007.ldb").write_bytes(snappy(table([(b"z", b"packed", 5, False)])))
    (tmp_path / "000008.log").write_bytes(L.encode_log([L.encode_batch(6, [(b"b", None), (b"\xff", b"binary"), (b"b", b"back")])]))
    (tmp_path / "000003.log").write_bytes(L.encode_log([L.encode_batch(99, [(b"a", b"from a log that was compacted")])]))
    edits = [put_varint(1) + text(L.COMPARATOR) + new(4, 0) + new(5, 1), put_varint(6) + put_varint(0) + put_varint(4) + new(6, 0) + new(7, 2) + put_varint(2) + put_varint(8) + put_varint(5) + put_varint(1) + text(b"p") + put_varint(9) + put_varint(0)]
    (tmp_path / "MANIFEST-000009").write_bytes(L.encode_log(edits))
    (tmp_path / "CURRENT").write_text("MANIFEST-000009\n")
    got = {bytes(r.key): (bytes(r.value), r.key_text) for r in L.read_leveldb(spark, str(tmp_path)).collect()}
    assert got == {b"a": (b"newer", "a"), b"b": (b"back", "b"), b"z": (b"packed", "z"), b"\xff": (b"binary", None)}


def test_an_empty_store(spark, tmp_path):
    rows = spark.createDataFrame([], "key binary, value binary")
    assert L.write_leveldb(rows, str(tmp_path / "db")) == 0
    assert L.read_leveldb(spark, f"file:{tmp_path}/db").count() == 0
