import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import codec, rlp, u256
from ledgerloom.functions.keccak import EMPTY_CODE, EMPTY_ROOT, keccak, keccak256, keccak_many
from ledgerloom.plans import trie


def test_keccak_known_answers(spark):
    assert keccak(b"").hex() == "c5d2460186f7233c927e7db2dcc703c0e500b653ca82273b7bfad8045d85a470"
    assert keccak(b"abc").hex() == "4e03657aea45a94fc7d47ba826c8d667c0d1e6e33a64a036ec44f58fa12d6c45"
    assert EMPTY_ROOT.hex() == "56e81f171bcc55a6ff8345e692c0f86e5b48e01b996cadc001622fb5e363b421"
    data = [bytes(range(256))[:n] * k for n, k in ((135, 1), (136, 1), (137, 1), (200, 3), (0, 1))]
    assert keccak_many(data) == [keccak(d) for d in data]
    df = spark.createDataFrame([(bytearray(b"abc"),), (None,)], "b binary").select(keccak256(F.col("b")).alias("h"))
    assert [r.h and bytes(r.h) for r in df.collect()] == [keccak(b"abc"), None]


def test_rlp_round_trip_and_strictness():
    for item in (b"", b"\x01", b"\x80", b"a" * 55, b"a" * 56, [], [b"cat", [b"dog", b""]], [b"x" * 100] * 3):
        assert rlp.decode(rlp.encode(item)) == item
    for bad in (b"", b"\x81\x01", b"\xb8\x01a", b"\x83ab", b"\x01\x01", b"\xc2\x01", b"\xb9\x00\x38" + b"a" * 56):
        with pytest.raises(ValueError):
            rlp.decode(bad)
    a = rlp.Account(7, 1 << 200)
    assert rlp.slim_account(a.slim()) == rlp.full_account(a.full()) == a and len(a.slim()) < len(a.full())
    with pytest.raises(ValueError):
        rlp.slim_account(rlp.encode([1, 1, EMPTY_ROOT, b""]))
    with pytest.raises(ValueError):
        rlp.slim_account(rlp.encode([1, 1, b"", EMPTY_CODE]))
    for bad in (b"\x80", b"\x00", b"\x82\x00\x01", b"\xc0", b""):
        with pytest.raises(ValueError):
            rlp.storage_word(bad)


def test_receipt_forms():
    log = [bytes(20), [bytes(32)], b"x"]
    old = [b"\x01", b"\x05", bytes(32), bytes(20), [log], b"\x05"]
    with_fees = [b"\x01", b"\x05", [log], b"", b"", b"", b"1.5"]
    bloom = rlp.receipt(old).bloom
    with_bloom = [b"\x01", b"\x05", bloom, bytes(32), bytes(20), [log], b"\x05"]
    assert rlp.receipt(old) == rlp.receipt(with_fees) == rlp.receipt(with_bloom)
    for bad in ([b"\x02", *old[1:]], [b"", *old[1:]], old[:5], [*with_bloom[:2], bytes(256), *with_bloom[3:]], [*with_fees[:6], b"one"]):
        with pytest.raises(ValueError):
            rlp.receipt(bad)
    with pytest.raises(ValueError, match="gas falls"):
        rlp.receipts(rlp.encode([[b"\x01", b"\x05", [], b"", b"", b"", b""], [b"\x01", b"\x04", [], b"", b"", b"", b""]]))


def test_trie_known_root_and_split(spark):
    assert trie.root_of({b"do": b"verb", b"dog": b"puppy", b"doge": b"coin", b"horse": b"stallion"}).hex() == "5991bb8c6514148a29db676a14ac506cd2cd5775ace63c30a4fe457715e9ac84"
    draw = random.Random(4)
    owners = {b"one": 1, b"few": 3, b"many": 400, b"pair": 2}
    rows, want = [], {}
    for owner, n in owners.items():
        keys = {keccak(owner + bytes([i % 256, i // 256])) for i in range(n)}
        if owner == b"pair":  # alike but for their last nibble: the root is an extension
            keys = {bytes(31) + b"\x01", bytes(31) + b"\x02"}
        leaves = {k: draw.randbytes(draw.randint(1, 40)) for k in sorted(keys)}
        want[owner] = trie.root_of(leaves)
        rows += [(bytearray(owner), bytearray(k), bytearray(v)) for k, v in leaves.items()]
    df = spark.createDataFrame(rows, "owner binary, key binary, value binary")
    for split, large in ((1, 2), (2, 0), (2, 1000)):
        got = {bytes(r.owner): (bytes(r.root), r.n) for r in trie.trie_roots(df, split, large).collect()}
        assert got == {o: (want[o], n) for o, n in owners.items()}


def test_keccak_one_by_one_and_together():
    draw = random.Random(2)
    messages = [draw.randbytes(n) for n in (0, 1, 31, 32, 134, 135, 136, 137, 271, 272, 273, 1000)]
    assert keccak_many(messages) == [keccak(m) for m in messages]


def slow_root(leaves, depth=0):
    """The reference of a trie's top, as the definition says it: nibble by nibble, nothing shared with the builder."""
    def path(digits, leaf):
        head = [2 * leaf + len(digits) % 2] + ([0] if len(digits) % 2 == 0 else []) + list(digits)
        return bytes(16 * a + b for a, b in zip(head[::2], head[1::2], strict=True))

    def item(rows):
        if len(rows) == 1:
            (k, v), = rows
            return [path(k, True), v]
        same = 0
        while len({k[same] for k, _ in rows}) == 1:
            same += 1
        if same:
            return [path(rows[0][0][:same], False), ref(item([(k[same:], v) for k, v in rows]))]
        return [ref(item(part)) if (part := [(k[1:], v) for k, v in rows if k[0] == n]) else b"" for n in range(16)] + [b""]

    def ref(node):
        blob = rlp.encode(node)
        return node if len(blob) < 32 else keccak(blob)

    return keccak(rlp.encode(item([([d for b in k for d in (b >> 4, b & 15)], v) for k, v in leaves.items()])))


def test_storage_roots_by_value(spark):
    """The query's roots against the slow trie, for every supplier."""
    import hashlib

    from ledgerloom.plans import queries
    from tests.oracle import DATA, tables

    rows = tables().execute("SELECT l_suppkey, l_orderkey, l_linenumber, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) FROM lineitem GROUP BY ALL").fetchall()
    leaves: dict = {}
    digests = keccak_many([hashlib.sha256(f"{r[1]}:{r[2]}".encode()).digest() for r in rows])
    for r, key in zip(rows, digests, strict=True):
        leaves.setdefault(r[0], {})[key] = b"\x88" + r[3].to_bytes(8, "big")
    got = {r.l_suppkey: (r.root, r.slots) for r in queries.storage_trie_roots(spark, DATA).collect()}
    assert got == {k: (slow_root(v).hex(), len(v)) for k, v in leaves.items()}


def test_codecs(spark):
    assert codec.successor(b"ab") == b"ac" and codec.successor(b"a\xff\xff") == b"b" and codec.successor(b"\xff") is None
    df = spark.createDataFrame([("0x" + "aB" * 20,), ("0X" + "ab" * 20,), ("0xabc",), (None,)], "t string")
    assert [r.a and bytes(r.a) for r in df.select(codec.address(F.col("t")).alias("a")).collect()] == [b"\xab" * 20, None, None, None]
    numbers = spark.createDataFrame([("0",), ("-1",), ("01",), ("-0",), ("",)], "t string")
    assert [r.c for r in numbers.select(codec.canonical_integer(F.col("t")).alias("c")).collect()] == [True, True, False, False, False]


def test_u256_sums(spark):
    big = (1 << 255).to_bytes(32, "big")
    df = spark.createDataFrame([(bytearray(big),), (bytearray((3).to_bytes(32, "big")),)], "w binary")
    assert u256.total(df, F.col("w")) == (1 << 255) + 3
    with pytest.raises(OverflowError):
        u256.total(df.union(df), F.col("w"))
    assert u256.string_slots(3, b"Token".ljust(31, b"\0") + bytes([10])) == []
    assert len(u256.string_slots(3, (2 * 65 + 1).to_bytes(32, "big"))) == 3
    for bad in (b"Token".ljust(31, b"x") + bytes([10]), (2 * 31 + 1).to_bytes(32, "big"), bytes(31) + b"\x40"):
        with pytest.raises(ValueError):
            u256.string_slots(3, bad)
