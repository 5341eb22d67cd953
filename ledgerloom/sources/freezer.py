"""Append-only history files: an index of six-byte entries (file number, offset) and data files, snappy-compressed or raw."""

from __future__ import annotations

import os
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Items a partition reads.
STEP = 4096


def _uvarint(data: bytes) -> int:
    value = 0
    for k, b in enumerate(data[:5]):
        value |= (b & 127) << (7 * k)
        if b < 128:
            return value
    raise ValueError("malformed snappy length")


def unsnap(data: bytes) -> bytes:
    """A raw snappy block, which begins with its length when unpacked."""
    return pa.Codec("snappy").decompress(data, _uvarint(data)).to_pybytes() if data else b""


def count_items(path: str, name: str, compressed: bool) -> int:
    index = os.path.join(path, name + (".cidx" if compressed else ".ridx"))
    if os.path.islink(index) or not os.path.isfile(index):
        raise ValueError(f"{index} is no regular file")
    size = os.path.getsize(index)
    with open(index, "rb") as f:
        first = f.read(6)
    if size < 6 or size % 6:
        raise ValueError("malformed index length")
    if int.from_bytes(first[2:], "big"):
        raise ValueError("history has lost its beginning")
    return size // 6 - 1


def read_items(path: str, name: str, compressed: bool, low: int, high: int):
    """(number, blob) of the items low to high - 1."""
    with open(os.path.join(path, name + (".cidx" if compressed else ".ridx")), "rb") as f:
        f.seek(low * 6)
        index = f.read((high - low + 1) * 6)
    entry = lambda k: (int.from_bytes(index[6 * k : 6 * k + 2], "big"), int.from_bytes(index[6 * k + 2 : 6 * k + 6], "big"))
    open_number, data = None, None
    try:
        for k in range(high - low):
            (first, start), (last, end) = entry(k), entry(k + 1)
            if last < first or last > first + 1:
                raise ValueError("file sequence is invalid")
            start = start if first == last else 0
            if end < start:
                raise ValueError("offsets are reversed")
            if open_number != last:
                if data:
                    data.close()
                data = open(os.path.join(path, f"{name}.{last:04d}" + (".cdat" if compressed else ".rdat")), "rb")  # noqa: SIM115
                open_number = last
            data.seek(start)
            blob = data.read(end - start)
            if len(blob) != end - start:
                raise ValueError("data file is cut off")
            yield low + k, unsnap(blob) if compressed else blob
    finally:
        if data:
            data.close()


@dataclass
class Items(InputPartition):
    low: int
    high: int


class FreezerReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.table = options["path"], options["table"]
        self.compressed = options.get("compressed", "false") == "true"

    def partitions(self):
        n = count_items(self.path, self.table, self.compressed)
        return [Items(k, min(k + STEP, n)) for k in range(0, n, STEP)] or [Items(0, 0)]

    def read(self, partition):
        if partition.high > partition.low:
            rows = list(read_items(self.path, self.table, self.compressed, partition.low, partition.high))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["number", "value"])


class FreezerSource(DataSource):
    """spark.read.format("freezer").option("path", folder).option("table", "headers").option("compressed", "true")"""

    @classmethod
    def name(cls):
        return "freezer"

    def schema(self):
        return "number long, value binary"

    def reader(self, schema):
        return FreezerReader(self.options)


def read_freezer(spark: SparkSession, path: str, tables: dict[str, bool]) -> dict[str, DataFrame]:
    """Tables by name (True: compressed). All must have as many items."""
    sizes = {count_items(path, t, c) for t, c in tables.items()}
    if len(sizes) > 1:
        raise ValueError("history tables differ in length")
    spark.dataSource.register(FreezerSource)
    return {t: spark.read.format("freezer").option("path", path).option("table", t).option("compressed", str(c).lower()).load() for t, c in tables.items()}
