"""256-bit numbers as 32 big-endian bytes: exact sums by limbs, comparison as bytes, and the layouts of contract storage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.keccak import keccak

LIMBS = 8


def limb(b: Column, k: int) -> Column:
    """The k-th 32 bits from the top, as a number."""
    return F.conv(F.hex(F.substring(b, 4 * k + 1, 4)), 16, 10).cast("long")


def limb_sums(value: Column, when: Column | None = None) -> list[Column]:
    """Partial sums that Spark combines as any: decimals of 32-bit limbs do not overflow below 2^94 rows."""
    return [F.coalesce(F.sum((limb(value, k) if when is None else F.when(when, limb(value, k))).cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias(f"limb{k}") for k in range(LIMBS)]


def carried(limbs: list[Column]) -> Column:
    """Sums of limbs to the 32 bytes of the number that they make; an error if it does not fit."""
    over, parts = F.lit(0).cast("decimal(38,0)"), []
    for limb_ in reversed(limbs):
        now = limb_ + over
        over = F.floor(now / F.lit(1 << 32)).cast("decimal(38,0)")
        parts.append(F.lpad(F.hex((now - over * (1 << 32)).cast("long")), 8, "0"))
    return F.when(over > 0, F.raise_error(F.lit("sum does not fit 256 bits")).cast("binary")).otherwise(F.unhex(F.concat(*reversed(parts))))


def total(rows: DataFrame, value: Column, when: Column | None = None) -> int:
    """The exact sum; an error if it does not fit 256 bits."""
    row = rows.agg(*limb_sums(value, when)).first()
    out = sum(int(row[k]) << (32 * (LIMBS - 1 - k)) for k in range(LIMBS))
    if out >> 256:
        raise OverflowError("sum does not fit 256 bits")
    return out


def mapping_slot(key: bytes, slot: int) -> bytes:
    return keccak(key.rjust(32, b"\x00") + slot.to_bytes(32, "big"))


def nested_slot(outer: bytes, inner: bytes, slot: int) -> bytes:
    return keccak(inner.rjust(32, b"\x00") + mapping_slot(outer, slot))


def string_slots(slot: int, word: bytes) -> list[bytes]:
    """Slots that hold a stored string besides its own: none for a short one. Lengths and padding must be canonical."""
    if word[31] & 1 == 0:
        size = word[31] // 2
        if size > 31 or any(word[size:31]):
            raise ValueError("malformed short string")
        return []
    size = int.from_bytes(word, "big") >> 1
    if not 32 <= size < 1 << 64:
        raise ValueError("malformed long string")
    base = int.from_bytes(keccak(slot.to_bytes(32, "big")), "big")
    return [((base + n) % (1 << 256)).to_bytes(32, "big") for n in range((size - 1) // 32 + 1)]
