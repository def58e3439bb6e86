"""LevelDB stores by their public file format: read into a table, and written from one, file by file.

A store is a folder: ``CURRENT`` names a manifest, which lists the live table files and the number of the write-ahead log.
Tables hold sorted entries in blocks (plain or Snappy), logs hold batches that no table has yet. An entry's key ends with its
sequence number and whether it deletes; of a key's entries the highest sequence counts. Every file is read by a task of
its own. Writing sorts by key, and every task writes one table of its range; the driver then publishes the manifest.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.proto import put_varint, varint

# Of the file format.
MAGIC = 0xDB4775248B80FB57
LOG_BLOCK = 32768
FULL, FIRST, MIDDLE, LAST = 1, 2, 3, 4
DELETION, VALUE = 0, 1
COMPARATOR = b"leveldb.BytewiseComparator"
EDIT_COMPARATOR, EDIT_LOG, EDIT_NEXT, EDIT_LAST, EDIT_POINTER, EDIT_DELETED, EDIT_NEW, EDIT_PREVIOUS = 1, 2, 3, 4, 5, 6, 7, 9

ENTRY = "key binary, value binary, seq long, deleted boolean"
BLOCK_BYTES = 4096
RESTART = 16


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a URL or a local path."""
    return fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)


def _bytes(path: str) -> bytes:
    files, at = _open(path)
    with files.open_input_stream(at, compression=None) as f:
        return f.read()


# ------------------------------------------------------------------ reading


def log_records(data: bytes):
    """Records of a log or a manifest, put together from their parts; a record that is cut off at the end is dropped."""
    parts, at = [], 0
    while at + 7 <= len(data):
        left = LOG_BLOCK - at % LOG_BLOCK
        if left < 7:
            at += left
            continue
        size, kind = struct.unpack_from("<HB", data, at + 4)
        if kind == 0 and size == 0:  # preallocated
            at += left
            continue
        if at + 7 + size > len(data):
            return
        part = data[at + 7 : at + 7 + size]
        at += 7 + size
        if kind == FULL:
            yield part
        elif kind == FIRST:
            parts = [part]
        else:
            parts.append(part)
            if kind == LAST:
                yield b"".join(parts)
                parts = []


def batch_entries(record: bytes):
    """(key, value, sequence, deleted) of a write batch."""
    seq, count = struct.unpack_from("<QI", record)
    at = 12
    for i in range(count):
        kind = record[at]
        size, at = varint(record, at + 1)
        key, at, value = record[at : at + size], at + size, None
        if kind == VALUE:
            size, at = varint(record, at)
            value, at = record[at : at + size], at + size
        yield key, value, seq + i, kind == DELETION


def _block(data: bytes, at: int, size: int) -> bytes:
    body, kind = data[at : at + size], data[at + size]
    if kind == 0:
        return body
    if kind != 1:
        raise ValueError(f"compression {kind} of a table block")
    length, _ = varint(body, 0)
    return pa.decompress(body, decompressed_size=length, codec="snappy", asbytes=True)


def block_entries(block: bytes):
    """(key, value) of a block; keys share prefixes with the ones before."""
    end = len(block) - 4 - 4 * struct.unpack_from("<I", block, len(block) - 4)[0]
    at, key = 0, b""
    while at < end:
        shared, at = varint(block, at)
        own, at = varint(block, at)
        size, at = varint(block, at)
        key = key[:shared] + block[at : at + own]
        yield key, block[at + own : at + own + size]
        at += own + size


def table_entries(data: bytes):
    """(key, value, sequence, deleted) of a table file."""
    if len(data) < 48 or struct.unpack_from("<Q", data, len(data) - 8)[0] != MAGIC:
        raise ValueError("no table file")
    footer = data[-48:]
    _, at = varint(footer, 0)
    _, at = varint(footer, at)
    place, at = varint(footer, at)
    size, at = varint(footer, at)
    for _, handle in block_entries(_block(data, place, size)):
        a, at = varint(handle, 0)
        n, _ = varint(handle, at)
        for key, value in block_entries(_block(data, a, n)):
            (tag,) = struct.unpack("<Q", key[-8:])
            yield key[:-8], value if tag & 255 == VALUE else None, tag >> 8, tag & 255 == DELETION


def live_files(folder: str) -> tuple[list[str], list[str]]:
    """(tables, logs) that the manifest of a store calls live."""
    files, at = _open(folder)
    names = {i.base_name for i in files.get_file_info(fs.FileSelector(at))}
    manifest = _bytes(f"{folder}/CURRENT").decode().strip()
    tables, log = set(), 0
    for edit in log_records(_bytes(f"{folder}/{manifest}")):
        i = 0
        while i < len(edit):
            tag, i = varint(edit, i)
            if tag in (EDIT_LOG, EDIT_PREVIOUS, EDIT_NEXT, EDIT_LAST):
                n, i = varint(edit, i)
                log = n if tag == EDIT_LOG else log
            elif tag == EDIT_COMPARATOR:
                n, i = varint(edit, i)
                i += n
            elif tag == EDIT_POINTER:
                _, i = varint(edit, i)
                n, i = varint(edit, i)
                i += n
            elif tag == EDIT_DELETED:
                _, i = varint(edit, i)
                n, i = varint(edit, i)
                tables.discard(n)
            elif tag == EDIT_NEW:
                _, i = varint(edit, i)
                number, i = varint(edit, i)
                _, i = varint(edit, i)
                for _ in range(2):
                    n, i = varint(edit, i)
                    i += n
                tables.add(number)
            else:
                raise ValueError(f"tag {tag} in a manifest")
    found = [next(n for n in (f"{t:06d}.ldb", f"{t:06d}.sst") if n in names) for t in sorted(tables)]
    logs = sorted(n for n in names if n.endswith(".log") and n[:-4].isdigit() and int(n[:-4]) >= log)
    return found, logs


class _File(InputPartition):
    pass


class _Reader(DataSourceReader):
    def __init__(self, options) -> None:
        self.path = options["path"].rstrip("/")

    def partitions(self):
        tables, logs = live_files(self.path)
        return [_File(n) for n in tables + logs] or [_File(None)]

    def read(self, partition):
        name = partition.value
        if name is None:
            return
        data = _bytes(f"{self.path}/{name}")
        if name.endswith(".log"):
            for record in log_records(data):
                yield from batch_entries(record)
        else:
            yield from table_entries(data)


class LevelSource(DataSource):
    """Entries of a LevelDB folder (``load(path)``), as they stand in its files: old versions and deletions too."""

    @classmethod
    def name(cls) -> str:
        return "ledgerloom_goleveldb"

    def schema(self) -> str:
        return ENTRY

    def reader(self, schema):
        return _Reader(self.options)


def read_leveldb(spark: SparkSession, path: str) -> DataFrame:
    """(key, key_text, value) of a store as its owner sees it: the last version of each key, without deleted ones.

    ``key_text`` is the key as text where it is UTF-8, else null.
    """
    spark.dataSource.register(LevelSource)
    entries = spark.read.format(LevelSource.name()).load(path)
    last = entries.groupBy("key").agg(F.max(F.struct("seq", "deleted", "value")).alias("t")).where("not t.deleted")
    return last.select("key", F.try_validate_utf8(F.col("key").cast("string")).alias("key_text"), F.col("t.value").alias("value"))


# ------------------------------------------------------------------ writing


def _crc_table() -> np.ndarray:
    """Of CRC-32C, whose reflected polynomial is 82F63B78."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0x82F63B78), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def masked_crcs(items: list[bytes]) -> list[int]:
    """CRC-32C of each item, masked as the format stores it; all items byte by byte at once."""
    sizes = np.array([len(x) for x in items])
    order = np.argsort(-sizes, kind="stable")
    data = np.zeros((len(items), int(sizes.max()) if len(items) else 0), np.uint8)
    for row, i in enumerate(order):
        data[row, : sizes[i]] = np.frombuffer(items[i], np.uint8)
    crc = np.full(len(items), 0xFFFFFFFF, np.uint32)
    live = np.searchsorted(-sizes[order], -np.arange(data.shape[1]), "left")  # items longer than each place
    for at, n in enumerate(live):
        crc[:n] = _CRC[(crc[:n] ^ data[:n, at]) & 0xFF] ^ (crc[:n] >> np.uint32(8))
    crc = (~crc).astype(np.uint64)
    out = np.empty(len(items), np.uint64)
    out[order] = (((crc >> np.uint64(15)) | (crc << np.uint64(17))) + np.uint64(0xA282EAD8)) & np.uint64(0xFFFFFFFF)
    return out.tolist()


def _encode_block(entries: list[tuple[bytes, bytes]]) -> bytes:
    out, restarts, last = bytearray(), [], b""
    for i, (key, value) in enumerate(entries):
        shared = 0
        if i % RESTART == 0:
            restarts.append(len(out))
        else:
            while shared < min(len(last), len(key)) and last[shared] == key[shared]:
                shared += 1
        out += put_varint(shared) + put_varint(len(key) - shared) + put_varint(len(value)) + key[shared:] + value
        last = key
    restarts = restarts or [0]
    return bytes(out) + struct.pack(f"<{len(restarts) + 1}I", *restarts, len(restarts))


def encode_table(entries: list[tuple[bytes, bytes, int, bool]]) -> tuple[bytes, bytes, bytes]:
    """(file, smallest, largest internal key) of sorted (key, value, sequence, deleted) entries."""
    blocks, keys, now, size = [], [], [], 0
    for key, value, seq, deleted in entries:
        internal = key + struct.pack("<Q", seq << 8 | (DELETION if deleted else VALUE))
        now.append((internal, b"" if deleted else value))
        size += len(internal) + len(value or b"")
        if size >= BLOCK_BYTES:
            blocks.append(_encode_block(now))
            keys.append(now[-1][0])
            now, size = [], 0
    if now:
        blocks.append(_encode_block(now))
        keys.append(now[-1][0])
    out, handles = bytearray(), []

    def put(many: list[bytes]) -> list[bytes]:
        found = []
        for block, crc in zip(many, masked_crcs([b + b"\0" for b in many])):
            found.append(put_varint(len(out)) + put_varint(len(block)))
            out.extend(block + b"\0" + struct.pack("<I", crc))
        return found

    handles = put(blocks)
    (meta,) = put([_encode_block([])])
    (index,) = put([_encode_block(list(zip(keys, handles)))])
    out += (meta + index).ljust(40, b"\0") + struct.pack("<Q", MAGIC)
    first = entries[0]
    return bytes(out), first[0] + struct.pack("<Q", first[2] << 8 | (DELETION if first[3] else VALUE)), keys[-1]


def encode_log(records: list[bytes]) -> bytes:
    """A log file of records, cut at block borders."""
    out = bytearray()
    for record in records:
        first = True
        while first or record:
            left = LOG_BLOCK - len(out) % LOG_BLOCK
            if left < 7:
                out += bytes(left)
                continue
            part, record = record[: left - 7], record[left - 7 :]
            kind = (FULL if first else LAST) if not record else (FIRST if first else MIDDLE)
            (crc,) = masked_crcs([bytes([kind]) + part])
            out += struct.pack("<IHB", crc, len(part), kind) + part
            first = False
    return bytes(out)


def encode_batch(seq: int, entries: list[tuple[bytes, bytes | None]]) -> bytes:
    """A write batch; a None value deletes."""
    out = struct.pack("<QI", seq, len(entries))
    for key, value in entries:
        out += bytes([DELETION if value is None else VALUE]) + put_varint(len(key)) + key + (b"" if value is None else put_varint(len(value)) + value)
    return out


def _put(path: str, data: bytes) -> None:
    files, at = _open(path)
    with files.open_output_stream(at, compression=None) as f:
        f.write(data)


def write_leveldb(rows: DataFrame, folder: str, *, log: list[tuple[bytes, bytes | None]] | None = None) -> int:
    """Write (key, value) rows, unique by key, as a LevelDB folder; returns its entries. ``log`` is written after them.

    Rows are sorted over ranges of keys; each task writes one table and returns its bounds, a row for the manifest.
    """
    files, at = _open(folder)
    files.create_dir(at, recursive=True)

    def write(batches):
        from pyspark import TaskContext

        entries = [(bytes(k), bytes(v), 1, False) for pdf in batches for k, v in zip(pdf["key"], pdf["value"])]
        if entries:
            number = 10 + TaskContext.get().partitionId()
            data, low, high = encode_table(entries)
            _put(f"{folder}/{number:06d}.ldb", data)  # a task that runs again writes the same file
            yield pd.DataFrame({"number": [number], "size": [len(data)], "n": [len(entries)], "low": [low], "high": [high]})

    sorted_rows = rows.select("key", "value").repartitionByRange("key").sortWithinPartitions("key")
    tables = sorted_rows.mapInPandas(write, "number long, size long, n long, low binary, high binary").collect()  # a row per file
    newest = max([10, *(t["number"] for t in tables)]) + 1
    text = lambda b: put_varint(len(b)) + bytes(b)
    edit = put_varint(EDIT_COMPARATOR) + text(COMPARATOR) + put_varint(EDIT_LOG) + put_varint(newest) + put_varint(EDIT_NEXT) + put_varint(newest + 1) + put_varint(EDIT_LAST) + put_varint(1 + len(log or []))
    for t in tables:
        edit += put_varint(EDIT_NEW) + put_varint(1) + put_varint(t["number"]) + put_varint(t["size"]) + text(t["low"]) + text(t["high"])
    _put(f"{folder}/{newest:06d}.log", encode_log([encode_batch(2, log)] if log else []))
    _put(f"{folder}/MANIFEST-000002", encode_log([edit]))
    _put(f"{folder}/CURRENT", b"MANIFEST-000002\n")
    return sum(t["n"] for t in tables)
