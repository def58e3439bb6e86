"""Protobuf wire format without generated classes: transaction results, block metas and change sets."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def varint(data: bytes, at: int) -> tuple[int, int]:
    """(value, next place)."""
    value = shift = 0
    while True:
        b = data[at]
        value |= (b & 127) << shift
        at += 1
        if b < 128:
            return value, at
        shift += 7
        if shift > 63:
            raise ValueError("varint too long")


def put_varint(value: int) -> bytes:
    out = bytearray()
    value %= 1 << 64
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes(out) + bytes([value])


def varint_of(n: Column, groups: int = 10) -> Column:
    """Bytes of a long as a varint, negative ones in ten as the format has it; ``groups`` may be less where values are known to be below 2^(7 * groups)."""
    rest = [F.shiftrightunsigned(n.cast("bigint"), 7 * k) for k in range(groups)]
    parts = []
    for k, r in enumerate(rest):
        byte = r.bitwiseAND(127) if k + 1 == groups else F.when(rest[k + 1] != 0, r.bitwiseAND(127).bitwiseOR(128)).otherwise(r.bitwiseAND(127))
        digits = F.lpad(F.hex(byte), 2, "0")
        parts.append(F.when(r != 0, digits).otherwise("") if k else digits)
    return F.unhex(F.concat(*parts))


def fields(data: bytes) -> list[tuple[int, object]]:
    """(number, value) of each field: int for varints and fixed widths, bytes for the rest."""
    out, at = [], 0
    while at < len(data):
        tag, at = varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(data, at)
        elif kind == 2:
            size, at = varint(data, at)
            if at + size > len(data):
                raise ValueError("field is cut off")
            value, at = data[at : at + size], at + size
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = int.from_bytes(data[at : at + size], "little"), at + size
        else:
            raise ValueError(f"wire type {kind}")
        out.append((tag >> 3, value))
    return out


def message(*pairs: tuple[int, object]) -> bytes:
    """Encode (number, int, bytes or str) fields; zero and empty values are left out, as the format does."""
    out = b""
    for number, value in pairs:
        if isinstance(value, str):
            value = value.encode()
        if not value:
            continue
        out += put_varint(number << 3 | 2) + put_varint(len(value)) + value if isinstance(value, bytes) else put_varint(number << 3) + put_varint(value)
    return out


def _signed(v: int) -> int:
    return v - (1 << 64) if v >= 1 << 63 else v


def tx_result(data: bytes) -> dict | None:
    """height, index, tx and the result's code, data, log, gas_used and events; None where malformed."""
    try:
        out = {"height": 0, "index": 0, "tx": b"", "code": 0, "data": b"", "log": "", "gas_used": 0, "events": []}
        for number, value in fields(data):
            if number == 1:
                out["height"] = _signed(value)
            elif number == 2:
                out["index"] = value
            elif number == 3:
                out["tx"] = value
            elif number == 4:
                for n, v in fields(value):
                    if n == 1:
                        out["code"] = v
                    elif n == 2:
                        out["data"] = v
                    elif n == 3:
                        out["log"] = v.decode("utf-8", "replace")
                    elif n == 6:
                        out["gas_used"] = _signed(v)
                    elif n == 7:
                        out["events"].append(_event(v))
        return out
    except (ValueError, IndexError, TypeError, AttributeError):
        return None


def _event(data: bytes) -> dict:
    out = {"type": "", "attributes": []}
    for number, value in fields(data):
        if number == 1:
            out["type"] = value.decode("utf-8", "replace")
        elif number == 2:
            attr = dict(fields(value))
            out["attributes"].append({"key": attr.get(1, b"").decode("utf-8", "replace"), "value": attr.get(2, b"").decode("utf-8", "replace")})
    return out


def encode_tx_result(height: int, index: int, tx: bytes, events: list[tuple[str, list[tuple[str, str]]]], code: int = 0, log: str = "", gas_used: int = 0) -> bytes:
    """The message that ``tx_result`` reads; for fixtures."""
    made = [message((1, kind), *[(2, message((1, k), (2, v))) for k, v in attrs]) for kind, attrs in events]
    return message((1, height), (2, index), (3, tx), (4, message((1, code), (3, log), (6, gas_used), *[(7, e) for e in made])))


EVENTS = "array<struct<type:string,attributes:array<struct<key:string,value:string>>>>"
TX_RESULT = f"struct<height:bigint,index:bigint,tx:binary,code:bigint,data:binary,log:string,gas_used:bigint,events:{EVENTS}>"


def decode_tx_result(value: Column) -> Column:
    """Struct of a serialised transaction result; null where it is malformed."""

    def decode(s: pd.Series) -> pd.DataFrame:
        names = ["height", "index", "tx", "code", "data", "log", "gas_used", "events"]
        rows = [(None if v is None else tx_result(bytes(v))) or dict.fromkeys(names) for v in s]
        return pd.DataFrame(rows, columns=names).astype({"height": "Int64", "index": "Int64", "code": "Int64", "gas_used": "Int64"})

    out = F.pandas_udf(decode, TX_RESULT)(value)
    return F.when(out.getField("height").isNotNull(), out)


def meta_hash(value: bytes) -> bytes | None:
    """The first block hash in a block meta: field 1 whose field 1 has 20 to 64 bytes."""
    if len(value) < 35:
        return None
    for i in range(len(value) - 34):
        if value[i] == 0x0A and value[i + 2] == 0x0A and i + 2 + value[i + 1] <= len(value):
            size = value[i + 3]
            if 20 <= size <= 64 and i + 4 + size <= len(value):
                return value[i + 4 : i + 4 + size]
    return None


def block_hash(value: Column) -> Column:
    return F.pandas_udf(lambda s: s.map(lambda v: None if v is None else meta_hash(bytes(v))), "binary")(value)


# ------------------------------------------------------------------ state-change files

PAIRS = "path string, position int, store string, deleted boolean, key binary, value binary"


def state_pairs(data: bytes) -> list[tuple[str, bool, bytes, bytes]]:
    """(store, deleted, key, value) of a state-change file: an 8-byte length, then delimited messages."""
    if int.from_bytes(data[:8], "big") + 8 != len(data):
        raise ValueError("incomplete file")
    out, at = [], 8
    while at < len(data):
        size, at = varint(data, at)
        f = dict(fields(data[at : at + size]))
        out.append((f.get(1, b"").decode(), bool(f.get(2, 0)), f.get(3, b""), f.get(4, b"")))
        at += size
    return out


def encode_state_pairs(pairs: list[tuple[str, bool, bytes, bytes]]) -> bytes:
    body = b""
    for store, deleted, key, value in pairs:
        m = message((1, store), (2, int(deleted)), (3, key), (4, value))
        body += put_varint(len(m)) + m
    return len(body).to_bytes(8, "big") + body


def read_state_files(files: DataFrame) -> DataFrame:
    """Pairs of ``binaryFile`` rows, in file order."""

    def decode(batches):
        for pdf in batches:
            rows = [(path, i, *pair) for path, content in zip(pdf["path"], pdf["content"]) for i, pair in enumerate(state_pairs(bytes(content)))]
            yield pd.DataFrame(rows, columns=["path", "position", "store", "deleted", "key", "value"])

    return files.select("path", "content").mapInPandas(decode, PAIRS)
