"""Hashes and encodings that Spark lacks, in Python and numpy with pandas UDFs around them."""

from __future__ import annotations

import base64

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# ------------------------------------------------------------------ Keccak-256

def _constants() -> tuple[list[int], list[tuple[int, int, int]]]:
    """Round constants from the degree-8 shift register, and (x, y, rotation) of the rho and pi steps."""
    rounds, r = [], 1
    for _ in range(24):
        value = 0
        for j in range(7):
            if r & 1:
                value |= 1 << ((1 << j) - 1)
            r = (r << 1) ^ (0x171 if r & 0x80 else 0)
        rounds.append(value)
    steps, x, y = [], 1, 0
    for t in range(24):
        steps.append((x, y, (t + 1) * (t + 2) // 2 % 64))
        x, y = y, (2 * x + 3 * y) % 5
    return rounds, steps


_ROUNDS, _STEPS = _constants()


RATE = 136


def _permute(a: np.ndarray) -> np.ndarray:
    """The permutation on 25 lanes (x + 5 * y) of many states at once: 25 x states."""
    turn = lambda v, n: (v << np.uint64(n)) | (v >> np.uint64(64 - n)) if n else v
    for constant in _ROUNDS:
        c = np.bitwise_xor.reduce(a.reshape(5, 5, -1), axis=0)
        d = np.stack([c[(x - 1) % 5] ^ turn(c[(x + 1) % 5], 1) for x in range(5)])
        a = (a.reshape(5, 5, -1) ^ d).reshape(25, -1)
        b = np.empty_like(a)
        b[0] = a[0]
        for x, y, n in _STEPS:
            b[y + 5 * ((2 * x + 3 * y) % 5)] = turn(a[x + 5 * y], n)
        rows = b.reshape(5, 5, -1)
        a = (rows ^ (~np.roll(rows, -1, axis=1) & np.roll(rows, -2, axis=1))).reshape(25, -1)
        a[0] ^= np.uint64(constant)
    return a


def keccak_many(items: list[bytes]) -> list[bytes]:
    """Keccak-256, with the original padding (not SHA3-256), of each item; items of as many blocks go together."""
    out: list[bytes] = [b""] * len(items)
    groups: dict[int, list[int]] = {}
    for i, item in enumerate(items):
        groups.setdefault(len(item) // RATE + 1, []).append(i)
    for blocks, members in groups.items():
        data = np.zeros((len(members), blocks * RATE), np.uint8)
        for row, i in enumerate(members):
            item = items[i]
            data[row, : len(item)] = np.frombuffer(item, np.uint8)
            data[row, len(item)] = 1
        data[:, -1] |= 0x80
        words = data.view("<u8").T.astype(np.uint64)
        state = np.zeros((25, len(members)), np.uint64)
        for k in range(blocks):
            state[: RATE // 8] ^= words[k * RATE // 8 : (k + 1) * RATE // 8]
            state = _permute(state)
        digests = np.ascontiguousarray(state[:4].T).astype("<u8").tobytes()
        for row, i in enumerate(members):
            out[i] = digests[32 * row : 32 * row + 32]
    return out


def keccak256(data: bytes) -> bytes:
    return keccak_many([bytes(data)])[0]


# ------------------------------------------------------------------ bech32

_CHARS = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"  # fixed value: the bech32 alphabet
_GENERATOR = [0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3]  # fixed values


def _checksum(values: list[int]) -> int:
    c = 1
    for v in values:
        top = c >> 25
        c = (c & 0x1FFFFFF) << 5 ^ v
        for i, g in enumerate(_GENERATOR):
            if top >> i & 1:
                c ^= g
    return c


def _expand(prefix: str) -> list[int]:
    return [ord(x) >> 5 for x in prefix] + [0] + [ord(x) & 31 for x in prefix]


def _regroup(data, have: int, want: int, pad: bool) -> list[int] | None:
    held = bits = 0
    out = []
    for v in data:
        held = held << have | v
        bits += have
        while bits >= want:
            bits -= want
            out.append(held >> bits & (1 << want) - 1)
        held &= (1 << bits) - 1
    if pad:
        if bits:
            out.append(held << (want - bits))
    elif bits >= have or held:
        return None
    return out


def bech32_encode(prefix: str, data: bytes) -> str:
    values = _regroup(data, 8, 5, True)
    check = _checksum(_expand(prefix) + values + [0] * 6) ^ 1
    return prefix + "1" + "".join(_CHARS[v] for v in values + [check >> 5 * (5 - i) & 31 for i in range(6)])


def bech32_decode(text: str) -> tuple[str, bytes] | None:
    """(prefix, bytes), or None for a malformed string."""
    if not text or any(not 33 <= ord(c) <= 126 for c in text) or (text.lower() != text and text.upper() != text):
        return None
    text = text.lower()
    at = text.rfind("1")
    if at < 1 or at + 7 > len(text) or any(c not in _CHARS for c in text[at + 1 :]):
        return None
    values = [_CHARS.index(c) for c in text[at + 1 :]]
    if _checksum(_expand(text[:at]) + values) != 1:
        return None
    data = _regroup(values[:-6], 5, 8, False)
    return None if data is None else (text[:at], bytes(data))


# ------------------------------------------------------------------ RLP and created addresses


def rlp_encode(item) -> bytes:
    """RLP of bytes, non-negative integers and lists of them."""

    def head(size: int, base: int) -> bytes:
        if size < 56:
            return bytes([base + size])
        length = size.to_bytes((size.bit_length() + 7) // 8, "big")
        return bytes([base + 55 + len(length)]) + length

    if isinstance(item, int):
        item = item.to_bytes((item.bit_length() + 7) // 8, "big")
    if isinstance(item, (bytes, bytearray)):
        return bytes(item) if len(item) == 1 and item[0] < 128 else head(len(item), 128) + bytes(item)
    body = b"".join(map(rlp_encode, item))
    return head(len(body), 192) + body


def created_address(sender: bytes, nonce: int) -> bytes:
    """Address of the contract that ``sender`` creates at ``nonce``."""
    return keccak256(rlp_encode([sender, nonce]))[12:]


def checksum_address(address: bytes) -> str:
    """Mixed-case hex display of a 20-byte address."""
    digits = address.hex()
    marks = keccak256(digits.encode()).hex()
    return "0x" + "".join(c.upper() if int(m, 16) >= 8 else c for c, m in zip(digits, marks))


def parse_address(text: str | None, account: str, validator: str) -> bytes | None:
    """Hex first, then bech32 with the validator prefix, then the account prefix; else None."""
    if text is None:
        return None
    digits = text[2:] if text[:2] in ("0x", "0X") else text
    if len(digits) == 40 and all(c in "0123456789abcdefABCDEF" for c in digits):
        return bytes.fromhex(digits)
    for prefix in (validator, account):
        if text.startswith(prefix):
            found = bech32_decode(text)
            return found[1][-20:].rjust(20, b"\0") if found else None
    return None


# ------------------------------------------------------------------ blooms

BLOOM_BYTES = 256


def _bits(digest: bytes) -> list[int]:
    """The three bit numbers of a hashed item: 11 bits of each of the first three byte pairs."""
    return [(digest[i] << 8 | digest[i + 1]) & 2047 for i in (0, 2, 4)]


def bloom_bits(item: bytes) -> list[int]:
    return _bits(keccak256(item))


def _bloom(digests) -> bytes:
    value = 0
    for digest in digests:
        for bit in _bits(digest):
            value |= 1 << bit
    return value.to_bytes(BLOOM_BYTES, "big")


def bloom_of(items) -> bytes:
    return _bloom(keccak_many(list(items)))


def _holds(bloom: bytes, digest: bytes) -> bool:
    value = int.from_bytes(bloom, "big")
    return all(value >> bit & 1 for bit in _bits(digest))


def bloom_has(bloom: bytes, item: bytes) -> bool:
    return _holds(bloom, keccak256(item))


def bloom_union(blooms) -> bytes:
    value = 0
    for b in blooms:
        if b is not None:
            value |= int.from_bytes(b, "big")
    return value.to_bytes(BLOOM_BYTES, "big")


# ------------------------------------------------------------------ ABI words and 256-bit numbers


def abi_word(value) -> bytes:
    """32-byte word of an integer, bool, 20-byte address or up to 32 bytes."""
    if isinstance(value, bool):
        value = int(value)
    if isinstance(value, int):
        return (value % (1 << 256)).to_bytes(32, "big")
    return value.rjust(32, b"\0") if len(value) == 20 else value.ljust(32, b"\0")


def abi_pack(kinds: list[str], values: list) -> bytes:
    """ABI encoding of static words, ``string``, ``bytes`` and arrays of static words (``kind[]``)."""

    def tail(kind: str, v) -> bytes:
        if kind.endswith("[]"):
            return abi_word(len(v)) + b"".join(map(abi_word, v))
        data = v.encode() if isinstance(v, str) else v
        return abi_word(len(data)) + data.ljust(-(-len(data) // 32) * 32, b"\0")

    dynamic = [k in ("string", "bytes") or k.endswith("[]") for k in kinds]
    heads, tails, at = [], [], 32 * len(kinds)
    for kind, is_dynamic, v in zip(kinds, dynamic, values):
        if is_dynamic:
            heads.append(abi_word(at))
            tails.append(tail(kind, v))
            at += len(tails[-1])
        else:
            heads.append(abi_word(v))
    return b"".join(heads + tails)


def abi_unpack(kinds: list[str], data: bytes) -> list:
    """Inverse of ``abi_pack`` for ``uint256``, ``address``, ``bool``, ``string``, ``bytes``, ``uint256[]``."""

    def word(at: int) -> int:
        if at + 32 > len(data):
            raise ValueError("data too short")
        return int.from_bytes(data[at : at + 32], "big")

    out = []
    for i, kind in enumerate(kinds):
        w = word(32 * i)
        if kind in ("string", "bytes"):
            n = word(w)
            if w + 32 + n > len(data):
                raise ValueError("data too short")
            part = data[w + 32 : w + 32 + n]
            out.append(part.decode() if kind == "string" else part)
        elif kind.endswith("[]"):
            out.append([word(w + 32 + 32 * k) for k in range(word(w))])
        elif kind == "address":
            out.append(data[32 * i + 12 : 32 * i + 32])
        else:
            out.append(bool(w) if kind == "bool" else w)
    return out


def topic_word(value, kind: str) -> bytes:
    """Indexed argument: dynamic values are hashed, others are words."""
    if kind in ("string", "bytes"):
        return keccak256(value.encode() if isinstance(value, str) else value)
    return abi_word(value)


# ------------------------------------------------------------------ columns


def _each(f, kind: str):
    return F.pandas_udf(lambda s: s.map(lambda v: None if v is None else f(bytes(v) if isinstance(v, (bytearray, memoryview)) else v)), kind)


def _some(values) -> list[bytes]:
    return [b"" if v is None else bytes(v) for v in values]


def keccak(data: Column) -> Column:
    """Keccak-256 of binaries, a batch at a time."""

    def made(s: pd.Series) -> pd.Series:
        return pd.Series([None if v is None else h for v, h in zip(s, keccak_many(_some(s)))], dtype=object)

    return F.pandas_udf(made, "binary")(data)


def to_bech32(data: Column, prefix: str) -> Column:
    return _each(lambda v: bech32_encode(prefix, v), "string")(data)


def from_bech32(text: Column) -> Column:
    """Bytes of a bech32 string, null if malformed."""
    return _each(lambda v: (bech32_decode(v) or (None, None))[1], "binary")(text)


def address_of(text: Column, account: str, validator: str) -> Column:
    return _each(lambda v: parse_address(v, account, validator), "binary")(text)


def checksummed(address: Column) -> Column:
    """Mixed-case hex display of 20-byte addresses."""

    def made(s: pd.Series) -> pd.Series:
        digits = [v.hex() for v in _some(s)]
        marks = [h.hex() for h in keccak_many([d.encode() for d in digits])]
        shown = ("0x" + "".join(c.upper() if m >= "8" else c for c, m in zip(d, k)) for d, k in zip(digits, marks))
        return pd.Series([None if v is None else x for v, x in zip(s, shown)], dtype=object)

    return F.pandas_udf(made, "string")(address)


def contract_address(sender: Column, nonce: Column) -> Column:
    """Address of the contract that ``sender`` creates at ``nonce``; null where either is."""

    def made(s: pd.Series, n: pd.Series) -> pd.Series:
        known = [a is not None and not pd.isna(b) for a, b in zip(s, n)]
        hashes = keccak_many([rlp_encode([bytes(a), int(b)]) if k else b"" for k, a, b in zip(known, s, n)])
        return pd.Series([h[12:] if k else None for k, h in zip(known, hashes)], dtype=object)

    return F.pandas_udf(made, "binary")(sender, nonce)


def logs_bloom(address: Column, topics: Column) -> Column:
    """Bloom of a log: its address and its topics."""

    def made(a: pd.Series, t: pd.Series) -> pd.Series:
        items = [[bytes(x), *(bytes(y) for y in (ys if ys is not None else []))] for x, ys in zip(a, t)]
        hashes = iter(keccak_many([x for row in items for x in row]))
        return pd.Series([_bloom([next(hashes) for _ in row]) for row in items], dtype=object)

    return F.pandas_udf(made, "binary")(address, topics)


def bloom_contains(bloom: Column, item: Column) -> Column:
    def made(b: pd.Series, i: pd.Series) -> pd.Series:
        return pd.Series([_holds(bytes(x), h) for x, h in zip(b, keccak_many(_some(i)))], dtype=bool)

    return F.pandas_udf(made, "boolean")(bloom, item)


def bloom_or(bloom: Column) -> Column:
    """Aggregate: bitwise or of 256-byte blooms, as 32 native 64-bit lanes put together again.

    ``bit_or`` combines before the shuffle, so no task gathers a group's blooms.
    """
    lanes = [F.conv(F.hex(F.substring(bloom, 8 * i + 1, 8)), 16, -10).cast("bigint") for i in range(BLOOM_BYTES // 8)]
    merged = [F.lpad(F.hex(F.coalesce(F.bit_or(lane), F.lit(0).cast("bigint"))), 16, "0") for lane in lanes]
    return F.unhex(F.concat(*merged))


def u64_bytes(n: Column) -> Column:
    """Big-endian 8 bytes of a non-negative whole number."""
    return F.unhex(F.lpad(F.hex(n.cast("bigint")), 16, "0"))


def bytes_u64(data: Column) -> Column:
    """Whole number of big-endian bytes, as decimal(20,0): 2**64-1 does not fit a bigint. Absent is 0."""
    return F.coalesce(F.conv(F.hex(data), 16, 10).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))


def quantity(n: Column) -> Column:
    """Hex quantity: ``0x`` without leading zeros."""
    return F.concat(F.lit("0x"), F.lower(F.hex(n.cast("bigint"))))


def from_quantity(text: Column) -> Column:
    return F.conv(F.substr(text, F.lit(3)), 16, 10).cast("decimal(20,0)")


def hex_data(data: Column) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.hex(data)))


def from_hex_data(text: Column) -> Column:
    """Bytes of hex with or without ``0x``; null if malformed or of odd length."""
    digits = F.regexp_replace(text, "^0[xX]", "")
    return F.when(digits.rlike("^([0-9a-fA-F]{2})*$"), F.unhex(digits))


def word(data: Column, i: int) -> Column:
    """The ``i``-th 32-byte word."""
    return F.substring(data, 32 * i + 1, 32)


def topic_address(topic: Column) -> Column:
    """The last 20 bytes of a topic."""
    return F.substring(topic, 13, 20)


def small_uint256(data: Column) -> Column:
    """A 32-byte number as decimal(38,0), null where it needs more than 15 bytes."""
    digits = F.hex(data)
    high, low = F.conv(F.substring(digits, 35, 15), 16, 10).cast("decimal(38,0)"), F.conv(F.substring(digits, 50, 15), 16, 10).cast("decimal(38,0)")
    return F.when(F.substring(digits, 1, 34) == "0" * 34, high * F.lit(16**15).cast("decimal(38,0)") + low)


def decoded_base64(text: str | None) -> str | None:
    """Base64 text as UTF-8, or the text itself where it is none."""
    if text is None:
        return None
    try:
        return base64.b64decode(text.encode()).decode()
    except Exception:
        return text


def base64_or_raw(text: Column) -> Column:
    return _each(decoded_base64, "string")(text)
