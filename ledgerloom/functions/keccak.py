"""Keccak-256 over whole columns: messages of one batch go through the permutation together, lane by lane."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

RATE = 136
U = np.uint64


def _round_constants() -> list[int]:
    """From the linear feedback shift register x^8 + x^6 + x^5 + x^4 + 1: bit 2^j - 1 of round i is output 7i + j."""
    out, state, bits = [], 1, []
    for _ in range(24 * 7):
        bits.append(state & 1)
        state = (state << 1) ^ (0x171 if state & 0x80 else 0)
    for i in range(24):
        out.append(sum(bits[7 * i + j] << ((1 << j) - 1) for j in range(7)))
    return out


def _rotations() -> list[int]:
    out, x, y = [0] * 25, 1, 0
    for t in range(24):
        out[x + 5 * y] = (t + 1) * (t + 2) // 2 % 64
        x, y = y, (2 * x + 3 * y) % 5
    return out


CONSTANTS, ROTATIONS = [U(c) for c in _round_constants()], _rotations()


#: Lanes as an array (25, messages): how far each is turned, and which one goes where.
LEFT = np.array(ROTATIONS, dtype=U)[:, None]
RIGHT = U(64) - LEFT
FROM = np.zeros(25, dtype=np.intp)
for _x in range(5):
    for _y in range(5):
        FROM[_y + 5 * ((2 * _x + 3 * _y) % 5)] = _x + 5 * _y
#: Messages that are permuted at once: a few MB.
WIDE = 2048


def _permute(s: np.ndarray) -> None:
    """The permutation of lanes (25, messages), in place: a few calls a round, whatever the number of messages."""
    n = s.shape[1]
    rows, turned, other = s.reshape(5, 5, n), np.empty_like(s), np.empty_like(s)
    mixed, b, d = other.reshape(5, 5, n), np.empty((5, 7, n), dtype=U), np.empty((5, n), dtype=U)
    for constant in CONSTANTS:
        c = np.bitwise_xor.reduce(rows, axis=0)
        one = (c << U(1)) | (c >> U(63))
        np.bitwise_xor(c[:3], one[2:], out=d[1:4])
        np.bitwise_xor(c[3], one[0], out=d[4])
        np.bitwise_xor(c[4], one[1], out=d[0])
        np.bitwise_xor(rows, d, out=rows)
        np.left_shift(s, LEFT, out=turned)
        np.right_shift(s, RIGHT, out=other)
        np.bitwise_or(turned, other, out=turned)
        b[:, :5] = turned[FROM].reshape(5, 5, n)
        b[:, 5:] = b[:, :2]
        np.invert(b[:, 1:6], out=mixed)
        np.bitwise_and(mixed, b[:, 2:], out=mixed)
        np.bitwise_xor(b[:, :5], mixed, out=rows)
        s[0] ^= constant


#: Messages up to which numbers are quicker than arrays; where each lane goes, which column it is mixed with, and how far it is turned.
FEW, WORD = 2, (1 << 64) - 1
MOVES = [(x + 5 * y, x, y + 5 * ((2 * x + 3 * y) % 5), ROTATIONS[x + 5 * y]) for x in range(5) for y in range(5)]
NEXT = [(i, i // 5 * 5 + (i + 1) % 5, i // 5 * 5 + (i + 2) % 5) for i in range(25)]
PLAIN = [int(c) for c in CONSTANTS]


def _one(message: bytes) -> bytes:
    """The digest of one message, on Python's numbers."""
    fill = RATE - len(message) % RATE
    message += b"\x81" if fill == 1 else b"\x01" + bytes(fill - 2) + b"\x80"
    s = [0] * 25
    for at in range(0, len(message), RATE):
        for k, lane in enumerate(struct.unpack_from("<17Q", message, at)):
            s[k] ^= lane
        for constant in PLAIN:
            c = [s[x] ^ s[x + 5] ^ s[x + 10] ^ s[x + 15] ^ s[x + 20] for x in range(5)]
            d = [c[x - 1] ^ (c[x - 4] << 1 & WORD | c[x - 4] >> 63) for x in range(5)]
            b = s[:]
            for i, x, j, n in MOVES:
                t = s[i] ^ d[x]
                b[j] = t << n & WORD | t >> (64 - n)
            s = [b[i] ^ (~b[j] & b[k]) for i, j, k in NEXT]
            s[0] ^= constant
    return struct.pack("<4Q", *s[:4])


def keccak_many(messages: list[bytes]) -> list[bytes]:
    """The digests of the messages, those of one number of blocks at a time."""
    if len(messages) <= FEW:
        return [_one(m) for m in messages]
    out: list = [b""] * len(messages)
    groups: dict = {}
    for i, m in enumerate(messages):
        groups.setdefault(len(m) // RATE + 1, []).append(i)
    for blocks, rows in groups.items():
        for at in range(0, len(rows), WIDE):
            part = rows[at : at + WIDE]
            padded = bytearray()
            for i in part:
                fill = blocks * RATE - len(messages[i])
                padded += messages[i] + (b"\x81" if fill == 1 else b"\x01" + bytes(fill - 2) + b"\x80")
            words = np.frombuffer(bytes(padded), dtype="<u8").reshape(len(part), blocks, RATE // 8)
            state = np.zeros((25, len(part)), dtype=U)
            for block in range(blocks):
                state[: RATE // 8] ^= words[:, block].T
                _permute(state)
            digests = np.ascontiguousarray(state[:4].T).astype("<u8").tobytes()
            for k, i in enumerate(part):
                out[i] = digests[32 * k : 32 * k + 32]
    return out


def keccak(message: bytes) -> bytes:
    return keccak_many([message])[0]


#: Digests of the empty string, of an empty trie (of the encoding of an empty string), and of an empty list's encoding.
EMPTY_CODE, EMPTY_ROOT, EMPTY_LIST = keccak_many([b"", b"\x80", b"\xc0"])


def keccak256(column: Column) -> Column:
    """Digest of a binary column; null stays null."""

    @F.arrow_udf("binary")
    def digest(values: pa.Array) -> pa.Array:
        given = values.to_pylist()
        some = [v for v in given if v is not None]
        found = iter(keccak_many(some))
        return pa.array([None if v is None else next(found) for v in given], pa.binary())

    return digest(column)
