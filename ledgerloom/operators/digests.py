"""Digests: of contents, of framed sequences, chained, and as trees. SHA-256 here is the engine's own; Keccak is in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.codec import u64_be


def framed(*values: Column) -> Column:
    """Each value (binary) behind its length as eight bytes."""
    return F.concat(*[x for v in values for x in (u64_be(F.octet_length(v).cast("long")), v)])


def fold_digest(rows: DataFrame, by: list[str], order: list[str], *values: Column) -> DataFrame:
    """by, digest, n: SHA-256 over the framed values of each group in its order. The group's frames come together in one task."""
    item = F.struct(*[F.col(c) for c in order], framed(*values).alias("__frame"))
    whole = F.array_sort(F.collect_list(item))
    text = F.array_join(F.transform(whole, lambda x: F.hex(x["__frame"])), "")
    return rows.groupBy(*by).agg(F.sha2(F.unhex(text), 256).alias("digest"), F.count("*").alias("n"))


def chain_digest(rows: DataFrame, by: list[str], order: list[str], value: Column, seed: str) -> DataFrame:
    """by, digest, n: h = SHA-256(h before, value) over each group in its order, from SHA-256(seed); digests in hex."""
    whole = F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in order], value.alias("__value"))))
    start = F.sha2(F.lit(seed).cast("binary"), 256)
    chain = F.aggregate(whole, start, lambda h, x: F.sha2(F.concat(h, x["__value"]).cast("binary"), 256))
    return rows.groupBy(*by).agg(chain.alias("digest"), F.count("*").alias("n"))


def tree_depth(count: int, group: int = 1024) -> int:
    """How deep a tree must be for its lowest nodes to have about `group` rows; 2 at least."""
    depth = 2
    while count > group * 16**depth:
        depth += 1
    return depth


def tree_digest(rows: DataFrame, key: Column, value: Column, depth: int | None = None) -> DataFrame:
    """digest, n: a 16-ary SHA-256 tree. Leaves hash (key, value); a node hashes its children in order of key.

    The leaves under one node of the lowest level come together in a task. The depth follows from the number of rows, so
    that they stay few however many rows there are; give it where two tables of different sizes are to be compared.
    """
    depth = tree_depth(rows.count()) if depth is None else depth
    level = rows.select(key.alias("k"), F.sha2(F.concat(key.cast("binary"), F.lit(":").cast("binary"), value.cast("binary")), 256).alias("h"), F.lit(1).cast("long").alias("n"))
    level = level.withColumn("path", F.substring(F.sha2(F.col("k").cast("binary"), 256), 1, depth))
    for d in range(depth, -1, -1):
        order = "k" if d == depth else "path"
        node = level.groupBy(F.substring("path", 1, d).alias("node")).agg(
            F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).cast("string").alias("o"), "h"))), lambda x: x["h"]), "").cast("binary"), 256).alias("h"),
            F.sum("n").alias("n"),
        )
        level = node.withColumnRenamed("node", "path")
    return level.select(F.col("h").alias("digest"), "n")


#: Lanes of a multiset's digest, of 16 bits each; a SHA-256 gives 16.
LANES = 256


def multiset_lanes(rows: DataFrame, *values: Column, lanes: int = LANES) -> DataFrame:
    """lane, value: a digest of rows as a multiset, in whatever order: each row's framed values are hashed to `lanes` numbers of 16 bits, which are added up lane by lane, modulo 2^16.

    Sums are made within a task before anything is shuffled, a row of lanes each; sums of parts add up to those of the
    whole, and what is taken away can be subtracted. Rows of a multiset that somebody may choose freely want many lanes.
    """

    def summed(batches):
        from hashlib import sha256

        import numpy as np
        import pyarrow as pa

        total, counters = np.zeros(lanes, dtype=np.uint16), [c.to_bytes(4, "big") for c in range(-(-lanes // 16))]
        for batch in batches:
            for frame in batch.column(0):
                own = sha256(frame.as_py()).digest()
                total += np.frombuffer(b"".join(sha256(own + c).digest() for c in counters), dtype=">u2")[:lanes].astype(np.uint16)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(lanes, dtype=np.int32)), pa.array(total.astype(np.int64))], names=["lane", "value"])

    return rows.select(framed(*values).alias("frame")).mapInArrow(summed, "lane int, value long").groupBy("lane").agg((F.sum("value") % (1 << 16)).alias("value"))


def multiset_digest(rows: DataFrame, *values: Column, lanes: int = LANES) -> bytes:
    """SHA-256 of the lanes in their order; two tables with the same rows, each as often, have the same."""
    from hashlib import sha256

    found = {r.lane: r.value for r in multiset_lanes(rows, *values, lanes=lanes).collect()}
    return sha256(b"".join(found.get(k, 0).to_bytes(2, "big") for k in range(lanes))).digest()


def bloom_masks(hashed: Column, bits: int = 64, count: int = 3) -> Column:
    """A mask of `count` bits that an item sets, taken from its hash in hex; bit_or of the masks is the filter."""
    at = [F.pmod(F.conv(F.substring(hashed, 1 + 4 * k, 4), 16, 10).cast("long"), F.lit(bits - 1)) for k in range(count)]
    one = [F.call_function("shiftleft", F.lit(1).cast("long"), a.cast("int")) for a in at]
    out = one[0]
    for x in one[1:]:
        out = out.bitwiseOR(x)
    return out
