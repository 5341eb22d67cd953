"""Log-structured tables of a key-value store, read where they lie: a table or journal a partition, nothing recovered or repaired.

The manifest that CURRENT names is gone through on the driver: it says which tables are live, with their sizes and first
and last keys. Executors read the tables: index, blocks with checksums, entries whose keys share prefixes. An entry has
a sequence number; of those of a key the newest holds, which may be a deletion.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ledgerloom.sources.freezer import unsnap

#: Fixed values of the format: the polynomial of checksums and what is added to them, the end of a table, the order of keys, sizes.
POLYNOMIAL, MASK = 0x82F63B78, 0xA282EAD8
MAGIC, COMPARATOR = bytes.fromhex("57fb808b247547db"), b"leveldb.BytewiseComparator"
FOOTER, TRAILER, LOG_BLOCK, LOG_HEADER = 48, 5, 32768, 7
FULL, FIRST, MIDDLE, LAST = 1, 2, 3, 4
#: Blocks whose checksums are worked out at once; a longer one goes by itself.
TOGETHER, LONG = 256, 1 << 14


def _table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(POLYNOMIAL), out >> 1)
    return out


_CRC = _table()
_CRC_LIST = _CRC.tolist()


def checksums(parts: list[bytes]) -> list[int]:
    """The masked checksums of each: byte by byte over all of them, long ones one after another."""
    out = [0] * len(parts)
    short = [k for k, p in enumerate(parts) if len(p) <= LONG]
    if short:
        sizes = np.array([len(parts[k]) for k in short])
        data = np.zeros((sizes.max(initial=0), len(short)), dtype=np.uint8)
        for c, k in enumerate(short):
            data[: len(parts[k]), c] = np.frombuffer(parts[k], dtype=np.uint8)
        crc = np.full(len(short), 0xFFFFFFFF, dtype=np.uint32)
        for at, row in enumerate(data):
            crc = np.where(at < sizes, _CRC[(crc ^ row) & 255] ^ (crc >> 8), crc)
        for k, c in zip(short, crc.tolist(), strict=True):
            out[k] = c
    for k, p in enumerate(parts):
        if len(p) > LONG:
            crc = 0xFFFFFFFF
            for b in p:
                crc = _CRC_LIST[(crc ^ b) & 255] ^ (crc >> 8)
            out[k] = crc
    plain = [c ^ 0xFFFFFFFF for c in out]
    return [((c >> 15 | c << 17) + MASK) & 0xFFFFFFFF for c in plain]


class Bytes:
    """Numbers and strings taken off the front."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def __bool__(self) -> bool:
        return self.at < len(self.data)

    def take(self, n: int) -> bytes:
        if self.at + n > len(self.data):
            raise ValueError("a record is cut off")
        self.at += n
        return self.data[self.at - n : self.at]

    def number(self) -> int:
        value = shift = 0
        while shift < 70:
            (b,) = self.take(1)
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7
        raise ValueError("a number is too long")

    def text(self) -> bytes:
        return self.take(self.number())


def log_records(data: bytes, name: str):
    """The records of a log file; a bad checksum, or a record that is cut off, is an error."""
    at, whole = 0, None
    while at < len(data):
        room = LOG_BLOCK - at % LOG_BLOCK
        if room < LOG_HEADER:
            at += room
            continue
        head = data[at : at + LOG_HEADER]
        if len(head) < LOG_HEADER:
            raise ValueError(f"{name} is cut off")
        size, kind = int.from_bytes(head[4:6], "little"), head[6]
        part = data[at + LOG_HEADER : at + LOG_HEADER + size]
        if len(part) < size or LOG_HEADER + size > room:
            raise ValueError(f"{name} is cut off")
        if checksums([head[6:7] + part])[0] != int.from_bytes(head[:4], "little"):
            raise ValueError(f"{name} has a bad checksum")
        if kind not in (FULL, FIRST, MIDDLE, LAST) or (kind in (FULL, FIRST)) != (whole is None):
            raise ValueError(f"{name} has records out of turn")
        whole = part if whole is None else whole + part
        if kind in (FULL, LAST):
            yield whole
            whole = None
        at += LOG_HEADER + size
    if whole is not None:
        raise ValueError(f"{name} is cut off")


@dataclass(frozen=True)
class Table(InputPartition):
    path: str
    size: int
    low: bytes
    high: bytes


@dataclass(frozen=True)
class Journal(InputPartition):
    path: str


def _regular(path: str) -> str:
    if os.path.islink(path) or not os.path.isfile(path):
        raise ValueError(f"{path} is no regular file")
    return path


def _read(path: str, most: int | None = None) -> bytes:
    with open(_regular(path), "rb") as f:
        data = f.read() if most is None else f.read(most + 1)
    if most is not None and len(data) > most:
        raise ValueError(f"{path} is too long")
    return data


def manifest_name(current: bytes) -> str:
    """What CURRENT names, which is written in one way only; no other manifest is fallen back to."""
    match = re.fullmatch(rb"(MANIFEST-([0-9]{6,19}))\n", current)
    if not match or f"{int(match[2]):06d}".encode() != match[2]:
        raise ValueError("CURRENT names no manifest")
    return match[1].decode()


def live_files(folder: str) -> list[InputPartition]:
    """The tables that the manifest's edits leave, and the journals of what no table has yet; all must be there, with the sizes that it says."""
    names = os.listdir(folder)
    if pending := [n for n in names if re.fullmatch(r"CURRENT\.-?[0-9]+", n)]:
        raise ValueError(f"{pending[0]}: a manifest is about to be changed")
    name = manifest_name(_read(f"{folder}/CURRENT", 64))
    tables: dict[int, tuple] = {}
    log = before = order = None
    for record in log_records(_read(f"{folder}/{name}"), name):
        edit = Bytes(record)
        while edit:
            tag = edit.number()
            if tag == 1:
                order = edit.text()
            elif tag == 2:
                log = edit.number()
            elif tag in (3, 4):
                edit.number()
            elif tag == 9:
                before = edit.number()
            elif tag == 5:
                edit.number(), edit.text()
            elif tag == 6:
                edit.number()
                if tables.pop(edit.number(), None) is None:
                    raise ValueError("the manifest deletes a table that it has not")
            elif tag == 7:
                edit.number()
                number, size, low, high = edit.number(), edit.number(), edit.text(), edit.text()
                tables[number] = (size, low[:-8], high[:-8])
            else:
                raise ValueError(f"the manifest has an unknown tag {tag}")
    if order != COMPARATOR:
        raise ValueError("keys are in another order")
    out: list[InputPartition] = []
    for number, (size, low, high) in sorted(tables.items()):
        path = next((f"{folder}/{number:06d}.{e}" for e in ("ldb", "sst") if os.path.lexists(f"{folder}/{number:06d}.{e}")), f"{folder}/{number:06d}.ldb")
        if os.path.getsize(_regular(path)) != size:
            raise ValueError(f"{path} has not the size that the manifest says")
        out.append(Table(path, size, low, high))
    journals = sorted(int(n[:-4]) for n in names if re.fullmatch(r"[0-9]{6,}\.log", n))
    return out + [Journal(f"{folder}/{n:06d}.log") for n in journals if n >= (log or 0) or n == before and before]


def _blocks(file, handles: list[tuple[int, int]], name: str) -> list[bytes]:
    raw = []
    for offset, size in handles:
        file.seek(offset)
        raw.append(file.read(size + TRAILER))
        if len(raw[-1]) < size + TRAILER:
            raise ValueError(f"{name} is cut off")
    for block, crc in zip(raw, checksums([b[:-4] for b in raw]), strict=True):
        if crc != int.from_bytes(block[-4:], "little"):
            raise ValueError(f"{name} has a bad checksum")
    out = []
    for block in raw:
        if block[-5] not in (0, 1):
            raise ValueError(f"{name} is packed in an unknown way")
        out.append(unsnap(block[:-5]) if block[-5] else block[:-5])
    return out


def block_entries(block: bytes):
    """(key, value) of a block; keys are what they share with the one before, and the rest."""
    restarts = int.from_bytes(block[-4:], "little")
    end = len(block) - 4 * (restarts + 1)
    if end < 0:
        raise ValueError("a block is cut off")
    data, key = Bytes(block[:end]), b""
    while data:
        shared, rest, size = data.number(), data.number(), data.number()
        if shared > len(key):
            raise ValueError("a key shares more than there is")
        key = key[:shared] + data.take(rest)
        yield key, data.take(size)


def _handle(data: Bytes) -> tuple[int, int]:
    return data.number(), data.number()


def table_entries(table: Table, low: bytes = b"", high: bytes | None = None):
    """(key, seq, live, value) of a table, of keys from low on and below high; only blocks that may have some are read."""
    name = table.path
    with open(_regular(name), "rb") as file:
        file.seek(max(table.size - FOOTER, 0))
        footer = file.read()
        if len(footer) != FOOTER or footer[-8:] != MAGIC:
            raise ValueError(f"{name} is no table")
        data = Bytes(footer)
        _handle(data)
        (index,) = _blocks(file, [_handle(data)], name)
        wanted, before = [], None
        for last, handle in block_entries(index):  # last: no key of the block is greater
            if last[:-8] >= low and (high is None or before is None or before < high):
                wanted.append(_handle(Bytes(handle)))
            before = last[:-8]
        seen = None
        for k in range(0, len(wanted), TOGETHER):
            for block in _blocks(file, wanted[k : k + TOGETHER], name):
                for inner, value in block_entries(block):
                    if len(inner) < 8 or inner[-8] > 1:
                        raise ValueError(f"{name} has a malformed key")
                    key, seq = inner[:-8], int.from_bytes(inner[-7:], "little")
                    if seen is not None and not (key > seen[0] or key == seen[0] and seq < seen[1]):
                        raise ValueError(f"{name} has keys out of order")
                    seen = key, seq
                    if key >= low and (high is None or key < high):
                        yield key, seq, inner[-8] == 1, value


def journal_entries(path: str, low: bytes = b"", high: bytes | None = None):
    for record in log_records(_read(path), path):
        data = Bytes(record)
        seq, count = int.from_bytes(data.take(8), "little"), int.from_bytes(data.take(4), "little")
        for k in range(count):
            (live,) = data.take(1)
            if live > 1:
                raise ValueError(f"{path} has a malformed batch")
            key = data.text()
            value = data.text() if live else b""
            if key >= low and (high is None or key < high):
                yield key, seq + k, live == 1, value
        if data:
            raise ValueError(f"{path} has a malformed batch")


ENTRIES = "key binary, seq long, live boolean, value binary"
ENTRY_TYPE = pa.schema([("key", pa.binary()), ("seq", pa.int64()), ("live", pa.bool_()), ("value", pa.binary())])


class LsmReader(DataSourceReader):
    def __init__(self, options):
        self.folder = options["path"]
        self.low = bytes.fromhex(options.get("low", ""))
        self.high = bytes.fromhex(options["high"]) if "high" in options else None

    def partitions(self):
        """Journals, and the tables that may have keys of the range."""
        return [p for p in live_files(self.folder) if isinstance(p, Journal) or p.high >= self.low and (self.high is None or p.low < self.high)]

    def read(self, partition):
        rows, size = [], 0
        for row in journal_entries(partition.path, self.low, self.high) if isinstance(partition, Journal) else table_entries(partition, self.low, self.high):
            rows.append(row)
            size += len(row[3])
            if len(rows) == 4096 or size > 1 << 24:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), ENTRY_TYPE, strict=True)], schema=ENTRY_TYPE)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), ENTRY_TYPE, strict=True)], schema=ENTRY_TYPE)


class LsmSource(DataSource):
    """spark.read.format("lsm_entries").option("path", folder), with low and high (hex) for a range of keys: every entry of live tables and journals."""

    @classmethod
    def name(cls):
        return "lsm_entries"

    def schema(self):
        return ENTRIES

    def reader(self, schema):
        return LsmReader(self.options)


def read_entries(spark: SparkSession, folder: str, low: bytes = b"", high: bytes | None = None) -> DataFrame:
    """ENTRIES of a store's folder, which all executors must see; deleted and older ones too."""
    spark.dataSource.register(LsmSource)
    options = {"path": folder, "low": low.hex()} | ({} if high is None else {"high": high.hex()})
    return spark.read.format("lsm_entries").options(**options).load()


def newest(entries: DataFrame) -> DataFrame:
    """key, value: of each key the entry with the highest sequence number, unless that is a deletion."""
    last = entries.groupBy("key").agg(F.max_by(F.struct("live", "value"), "seq").alias("x"))
    return last.where("x.live").select("key", F.col("x.value").alias("value"))


def read_lsm(spark: SparkSession, folder: str, low: bytes = b"", high: bytes | None = None) -> DataFrame:
    """key, value of a store in its folder, of keys from low on and below high. The folder is only read; its journals are, too, but nothing is recovered into tables."""
    return newest(read_entries(spark, folder, low, high))
