"""DuckDB expressions for the twins: Keccak-256, bech32 and RLP in plain SQL, written apart from the operators."""

from __future__ import annotations


def _rotations() -> tuple[list[int], list[int]]:
    """For each lane after the rho and pi steps: the lane it comes from, and by how much it was rotated."""
    turns, (x, y) = {(0, 0): 0}, (1, 0)
    for t in range(24):
        turns[x, y] = (t + 1) * (t + 2) // 2 % 64
        x, y = y, (2 * x + 3 * y) % 5
    source, turn = [0] * 25, [0] * 25
    for (x, y), n in turns.items():
        to = y + 5 * ((2 * x + 3 * y) % 5)
        source[to], turn[to] = x + 5 * y, n
    return source, turn


def _round_constants() -> list[int]:
    bits, state = [], 1
    for _ in range(24 * 7):
        bits.append(state & 1)
        state <<= 1
        if state & 256:
            state ^= 0x171
    return [sum(bits[7 * r + j] << (2**j - 1) for j in range(7)) for r in range(24)]


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is computed once."""
    return f"list_transform([{value}], lambda {name}: {body})[1]"


def _turn(v: str, n: str) -> str:
    """A UBIGINT rotated to the left; shifts must not overflow."""
    return f"(CASE WHEN {n} = 0 THEN {v} ELSE (({v} & ((1::UBIGINT << (64 - {n})) - 1)) << {n}) | ({v} >> (64 - {n})) END)"


def keccak(data_hex: str) -> str:
    """Lower-case hex of the Keccak-256 of a lower-case hex expression of at most 135 bytes."""
    source, turn = _rotations()
    u = lambda values: "[" + ", ".join(f"{v}::UBIGINT" for v in values) + "]"
    padded = let("kh", f"({data_hex})", "CASE WHEN length(kh) = 270 THEN kh || '81' ELSE kh || '01' || repeat('0', 268 - length(kh)) || '80' END")
    reverse = lambda h: " || ".join(f"substr({h}, {15 - 2 * i}, 2)" for i in range(8))
    lanes = let("kp", padded, f"list_transform(range(25), lambda kl: CASE WHEN kl < 17 THEN ({let('kw', 'substr(kp, 16 * kl + 1, 16)', f'CAST(concat(chr(48), chr(120), {reverse('kw')}) AS UBIGINT)')}) ELSE 0::UBIGINT END)")
    parity = "list_transform(range(5), lambda kx: xor(xor(xor(ks[kx + 1], ks[kx + 6]), xor(ks[kx + 11], ks[kx + 16])), ks[kx + 21]))"
    mixed = f"list_transform(range(5), lambda kx: xor(kc[(kx + 4) % 5 + 1], {_turn('kc[(kx + 1) % 5 + 1]', '1')}))"
    theta = "list_transform(range(25), lambda ki: xor(ks[ki + 1], kd[ki % 5 + 1]))"
    moved = f"list_transform(range(25), lambda ki: {_turn(f'ka[{source}[ki + 1] + 1]', f'{turn}[ki + 1]')})"
    chi = "list_transform(range(25), lambda ki: xor(xor(kb[ki + 1], (~kb[(ki + 1) % 5 + (ki // 5) * 5 + 1]) & kb[(ki + 2) % 5 + (ki // 5) * 5 + 1]), CASE WHEN ki = 0 THEN kr[1] ELSE 0::UBIGINT END))"
    step = let("kc", parity, let("kd", mixed, let("ka", theta, let("kb", moved, chi))))
    rounds = "[" + ", ".join(u([c]) for c in _round_constants()) + "]"
    state = f"list_reduce(list_concat([{lanes}], {rounds}), lambda ks, kr: {step})"
    out = let("kz", state, "list_transform(range(4), lambda ko: lpad(lower(to_hex(kz[ko + 1])), 16, '0'))")
    return let("kq", out, " || ".join(f"({reverse(f'kq[{i + 1}]')})" for i in range(4)))


def bech32(prefix: str, data_hex: str) -> str:
    """Bech32 text of a lower-case hex expression of 20 bytes."""
    chars = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
    groups = f"list_transform(range(32), lambda bi: (CAST(concat(chr(48), chr(120), substr({data_hex}, 5 * (bi // 4) + 1, 5)) AS BIGINT) >> (15 - 5 * (bi % 4))) & 31)"
    head = [ord(c) >> 5 for c in prefix] + [0] + [ord(c) & 31 for c in prefix]
    top = "(bc >> 25)"
    mask = "xor(xor(xor(" + ", ".join(f"CASE WHEN {top} & {1 << i} <> 0 THEN {g} ELSE 0 END" for i, g in enumerate([0x3B6A57B2, 0x26508E6D])) + "), "
    mask += "xor(" + ", ".join(f"CASE WHEN {top} & {1 << i} <> 0 THEN {g} ELSE 0 END" for i, g in [(2, 0x1EA119FA), (3, 0x3D4233DD)]) + f")), CASE WHEN {top} & 16 <> 0 THEN {0x2A1462B3} ELSE 0 END)"
    check = f"xor(list_reduce(list_concat([1::BIGINT], list_concat({[*head]}::BIGINT[], list_concat(bg, [0, 0, 0, 0, 0, 0]::BIGINT[]))), lambda bc, bv: xor(xor((bc & 33554431) << 5, bv), {mask})), 1)"
    letters = lambda v: f"substr('{chars}', CAST({v} AS INTEGER) + 1, 1)"
    text = let("bk", check, f"array_to_string(list_transform(bg, lambda bx: {letters('bx')}), '') || array_to_string(list_transform(range(6), lambda bj: {letters('(bk >> (5 * (5 - bj))) & 31')}), '')")
    return f"'{prefix}1' || " + let("bg", f"CAST({groups} AS BIGINT[])", text)


def number_hex(n: str, size: int) -> str:
    """``size`` big-endian bytes of a whole number, as lower-case hex."""
    return f"lpad(lower(to_hex({n})), {2 * size}, '0')"


def rlp_nonce(n: str) -> str:
    """RLP of a whole number below 2**32, as hex."""
    return f"(CASE WHEN {n} = 0 THEN '80' WHEN {n} < 128 THEN {number_hex(n, 1)} WHEN {n} < 256 THEN '81' || {number_hex(n, 1)} WHEN {n} < 65536 THEN '82' || {number_hex(n, 2)} WHEN {n} < 16777216 THEN '83' || {number_hex(n, 3)} ELSE '84' || {number_hex(n, 4)} END)"


def created_address(sender_hex: str, nonce: str) -> str:
    """Hex of the address of the contract that a sender of 20 bytes creates."""
    body = let("rn", rlp_nonce(nonce), f"{number_hex('(192 + 21 + length(rn) // 2)', 1)} || '94' || {sender_hex} || rn")
    return f"substr({keccak(body)}, 25, 40)"


def checksum_address(address_hex: str) -> str:
    """Mixed-case display of a hex address of 20 bytes."""
    ascii_hex = let("ca", address_hex, "array_to_string(list_transform(range(40), lambda ci: lower(to_hex(ascii(substr(ca, ci + 1, 1))))), '')")
    marks = keccak(ascii_hex)
    return let("cm", marks, let("cb", address_hex, "'0x' || array_to_string(list_transform(range(40), lambda ci: CASE WHEN substr(cm, ci + 1, 1) >= '8' THEN upper(substr(cb, ci + 1, 1)) ELSE substr(cb, ci + 1, 1) END), '')"))
