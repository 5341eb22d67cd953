"""Codecs as expressions: big-endian numbers, strict hex, addresses, prefixes, paths. All JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ADDRESS = "^0x[0-9a-fA-F]{40}$"


def u64_be(n: Column) -> Column:
    """A number below 2^63 as eight bytes, the highest first."""
    return F.unhex(F.lpad(F.hex(n.cast("long")), 16, "0"))


def u64_from_be(b: Column) -> Column:
    """Eight bytes or fewer to a number; decimal(20,0) holds all of them."""
    return F.conv(F.hex(b), 16, 10).cast("decimal(20,0)")


def hex_text(b: Column) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.hex(b)))


def from_hex(text: Column) -> Column:
    """Strict: 0x and pairs of hex digits; null otherwise."""
    return F.when(text.rlike("^0x([0-9a-fA-F]{2})*$"), F.unhex(F.substring(text, 3, 1 << 30)))


def address(text: Column) -> Column:
    """20 bytes of a 0x address of 42 characters; null otherwise."""
    return F.when(text.rlike(ADDRESS), F.unhex(F.substring(text, 3, 40)))


def pad32(b: Column) -> Column:
    return F.lpad(b, 32, b"\x00")


def nibble(b: Column, at: int = 0) -> Column:
    """The hex digit at a position of a binary key."""
    return F.substring(F.lower(F.hex(b)), at + 1, 1)


def canonical_integer(text: Column, unsigned: bool = False) -> Column:
    """Whether the text is an integer as it would be written: no sign but a minus, no leading noughts."""
    return text.rlike("^(0|[1-9][0-9]*)$" if unsigned else "^(0|-?[1-9][0-9]*)$")


def successor(prefix: bytes) -> bytes | None:
    """The least key above all that begin with prefix; None if there is none."""
    cut = prefix.rstrip(b"\xff")
    return cut[:-1] + bytes([cut[-1] + 1]) if cut else None


def with_prefix(key: Column, prefix: bytes, start: bytes = b"", text: bool = False) -> Column:
    """prefix + start <= key < successor(prefix): a range, so that it reaches the Parquet scan."""
    lit = (lambda b: F.lit(b.decode())) if text else (lambda b: F.lit(bytearray(b)))
    out = key >= lit(prefix + start)
    return out if successor(prefix) is None else out & (key < lit(successor(prefix)))
