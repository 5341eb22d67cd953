"""Canonical history: block hashes, headers and receipts from a hot inventory and cold files, authenticated and searched for events."""

from __future__ import annotations

import hashlib
from dataclasses import asdict, dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import rlp
from ledgerloom.functions.codec import u64_be
from ledgerloom.functions.keccak import EMPTY_ROOT, keccak
from ledgerloom.operators import merge, order
from ledgerloom.plans import trie
from ledgerloom.plans.staging import staged

TRANSFER, APPROVAL = keccak(b"Transfer(address,address,uint256)"), keccak(b"Approval(address,address,uint256)")
BLOCK = "number long, hash binary, parent binary, state_root binary, header binary, receipts binary, fault string, events array<struct<receipt: int, log: int, topic: binary, source: binary, target: binary, data: binary>>"


@dataclass
class Head:
    number: int
    hash: bytes
    state_root: bytes
    header: bytes


def read_head(get) -> Head:
    """LastBlock, its number, the canonical hash and the header, each checked against the others. get: key to value or None."""
    found = get(b"LastBlock")
    number = get(b"H" + found) if found and len(found) == 32 else None
    if not number or len(number) != 8:
        raise ValueError("head block has no number")
    if get(b"h" + number + b"n") != found:
        raise ValueError("head block is not canonical")
    header = get(b"h" + number + found)
    fields = rlp.decode(header) if header else []
    if len(fields) < 15 or keccak(header) != found or rlp.number(fields[8], 64) != int.from_bytes(number, "big"):
        raise ValueError("head header has another hash or number")
    return Head(int.from_bytes(number, "big"), found, fields[3], header)


def check_head(head: Head) -> None:
    """The header has the head's hash, number and state root."""
    fields = rlp.decode(head.header)
    if not isinstance(fields, list) or len(fields) < 15 or keccak(head.header) != head.hash or rlp.number(fields[8], 64) != head.number or fields[3] != head.state_root:
        raise ValueError("header has another hash, number or state root than the head")


def head_rows(head: Head) -> dict[bytes, bytes]:
    """What a client needs to find a head: its header, its number by hash, its hash by number, and the two marks."""
    check_head(head)
    number = head.number.to_bytes(8, "big")
    return {b"h" + number + head.hash: head.header, b"H" + head.hash: number, b"h" + number + b"n": head.hash, b"LastBlock": head.hash, b"LastHeader": head.hash}


def empty_body(head: Head) -> dict[bytes, bytes]:
    """The body of a block without transactions and uncles."""
    return {b"b" + head.number.to_bytes(8, "big") + head.hash: rlp.encode([[], []])}


def blocks(kv: DataFrame, last: int, cold: dict[str, DataFrame] | None = None) -> DataFrame:
    """number, hash, header, receipts, other_receipts, conflict for 0 to last; what neither copy has is null.

    Three equi-joins on (number, key); differing receipts are both kept, the cold one first: either may be encoded anew.
    """
    n = kv.sparkSession.range(0, last + 1).withColumnRenamed("id", "number")
    cold = cold or {}
    empty = kv.sparkSession.createDataFrame([], "number long, value binary")

    def copies(of: DataFrame, key, name: str) -> DataFrame:
        hot = of.withColumn("k", key).join(kv.withColumnRenamed("key", "k").withColumnRenamed("value", "v"), "k").select("number", F.col("v").alias(name))
        rest = cold.get(name, empty).select("number", F.col("value").alias(name))
        both = merge.coalesce_copies(hot, rest, "number", name)
        if name == "receipts":
            both = both.join(hot.select("number", F.col("receipts").alias("hot")), "number", "left").withColumn("other_receipts", F.when(F.col("conflict"), F.col("hot"))).drop("hot").withColumn("conflict", F.lit(False))
        return of.join(both.withColumnRenamed("conflict", f"{name}_conflict"), "number", "left")

    lit = lambda c: F.lit(bytearray(c))
    num = u64_be(F.col("number"))
    out = copies(n, F.concat(lit(b"h"), num, lit(b"n")), "hash")
    out = copies(out, F.concat(lit(b"h"), num, F.col("hash")), "header")
    out = copies(out, F.concat(lit(b"r"), num, F.col("hash")), "receipts")
    conflict = F.coalesce(F.col("hash_conflict") | F.col("header_conflict"), F.lit(False))
    return out.select("number", "hash", "header", "receipts", "other_receipts", conflict.alias("conflict"))


def commitments(fields: list, found: list) -> None:
    """Receipts against their header: root, presence of transactions, gas, bloom."""
    if trie.list_root([r.consensus() for r in found]) != fields[5]:
        raise ValueError("receipt root differs")
    if (not found) != (fields[4] == EMPTY_ROOT):
        raise ValueError("receipts and transactions do not go together")
    bloom = 0
    for r in found:
        bloom |= int.from_bytes(r.bloom, "big")
    if (found[-1].cumulative_gas if found else 0) != rlp.number(fields[10], 64) or bloom != int.from_bytes(fields[6], "big"):
        raise ValueError("gas or bloom differs")


def events_of(found: list, token: bytes) -> list:
    out = []
    for i, r in enumerate(found):
        for k, log in enumerate(r.logs):
            if log.address != token or not log.topics or log.topics[0] not in (TRANSFER, APPROVAL):
                continue
            if len(log.topics) != 3 or len(log.data) != 32 or any(any(t[:12]) for t in log.topics[1:]):
                raise ValueError("malformed token event")
            out.append({"receipt": i, "log": k, "topic": log.topics[0], "source": log.topics[1][12:], "target": log.topics[2][12:], "data": log.data})
    return out


def _authenticated(token: bytes):
    def run(batches):
        for batch in batches:
            rows = []
            for number, hash_, header, receipts, other, conflict in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                row = [number, hash_, None, None, header, receipts, None, None]
                try:
                    if conflict or hash_ is None or header is None or receipts is None or len(hash_) != 32:
                        raise ValueError("copies differ" if conflict else "record is missing")
                    fields = rlp.decode(header)
                    if len(fields) < 15 or keccak(header) != hash_ or rlp.number(fields[8], 64) != number:
                        raise ValueError("header has another hash or number")
                    row[2], row[3] = fields[0], fields[3]
                    for blob in (other, receipts):
                        if blob is not None:
                            found = rlp.receipts(blob)
                            commitments(fields, found)
                    row[7] = events_of(found, token)
                except (ValueError, TypeError, UnicodeDecodeError) as e:
                    row[6] = str(e) or type(e).__name__
                rows.append(row)
            cols = list(zip(*rows, strict=True)) or [[]] * 8
            event = pa.list_(pa.struct([("receipt", pa.int32()), ("log", pa.int32()), ("topic", pa.binary()), ("source", pa.binary()), ("target", pa.binary()), ("data", pa.binary())]))
            kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.string(), event)
            names = ["number", "hash", "parent", "state_root", "header", "receipts", "fault", "events"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    return run


def authenticate(rows: DataFrame, token: bytes) -> DataFrame:
    """Blocks with what their headers and receipts say; fault is null for a good one. Each block is on its own, but for its parent."""
    return rows.mapInArrow(_authenticated(token), BLOCK)


@dataclass
class Evidence:
    first_block: int
    last_block: int
    blocks: int
    transfers: int
    approvals: int
    history_sha256: str
    events_sha256: str


def _frame(h, *values: bytes) -> None:
    for v in values:
        h.update(len(v).to_bytes(8, "big") + v)


def scan(kv: DataFrame, head: Head, token: bytes, cold: dict[str, DataFrame] | None = None) -> tuple[Evidence, DataFrame]:
    """Evidence of the whole history, and its events (block, receipt, log, topic, source, target, data).

    Faults, gaps and broken links end it. The two digests are folds over all blocks in order, which the driver goes
    through a partition at a time; all else is dealt over the executors.
    """
    done = staged(authenticate(blocks(kv, head.number, cold), token), "history")
    if bad := done.where("fault IS NOT NULL").orderBy("number").first():
        raise ValueError(f"block {bad.number}: {bad.fault}")
    # A parent is the block of the number before: an equi-join, where a window over all blocks would be one task.
    before = done.select((F.col("number") + 1).alias("number"), F.col("hash").alias("own"))
    parent = F.coalesce("own", F.lit(bytearray(32)))
    if bad := done.join(before, "number", "left").where(F.col("parent") != parent).orderBy("number").first():
        raise ValueError(f"block {bad.number}: parent differs")
    span = done.agg(F.min("number").alias("a"), F.max("number").alias("b"), F.count("*").alias("n")).first()
    if (span.a, span.b, span.n) != (0, head.number, head.number + 1):
        raise ValueError("history has gaps")
    events = done.select(F.col("number").alias("block"), F.explode("events").alias("e")).select("block", "e.*")
    history, log, last = hashlib.sha256(), hashlib.sha256(), None
    for r in done.select("number", "hash", "header", "receipts").orderBy("number").toLocalIterator():
        _frame(history, r.number.to_bytes(8, "big"), bytes(r.hash), bytes(r.header), bytes(r.receipts))
        last = bytes(r.header)
    if last != head.header:
        raise ValueError("head header has changed")
    for r in events.orderBy("block", "receipt", "log").toLocalIterator():
        _frame(log, b"".join(n.to_bytes(8, "big") for n in (r.block, r.receipt, r.log)), bytes(r.topic), bytes(r.source), bytes(r.target), bytes(r.data))
    kinds = events.agg(F.count_if(F.col("topic") == F.lit(bytearray(TRANSFER))).alias("t"), F.count_if(F.col("topic") == F.lit(bytearray(APPROVAL))).alias("a")).first()
    return Evidence(0, head.number, span.n, kinds.t, kinds.a, history.hexdigest(), log.hexdigest()), events


def as_report(e: Evidence) -> dict:
    return asdict(e)


def in_order(rows: DataFrame, by: list[str]) -> DataFrame:
    """Whether cumulative gas never falls within a block, for receipts that have been taken apart already."""
    return order.increasing(rows, by, ["receipt"], "cumulative_gas", strict=False)
