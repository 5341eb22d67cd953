"""The portable bundle: a framed stream of account, storage and code records, plain or zstd, and its manifest.

A stream is magic, records (type, key, length as eight bytes, payload) and a nought. Its frames can only be found one
after another: a stream is one partition, and many streams are read in parallel.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import uuid
from dataclasses import asdict, dataclass
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from ledgerloom import __version__
from ledgerloom.functions.keccak import EMPTY_CODE, keccak
from ledgerloom.functions.rlp import slim_account

#: Fixed values of the format.
MAGIC = b"L2STATE1"
KEYS = {1: 32, 2: 64, 3: 32}
MOST = {1: 110, 2: 33, 3: 128 << 20}
#: Domain of the record chain; streams of other tools name their own.
DOMAIN = b"ledgerloom-record-chain/v1"
SCHEMA = "seq long, type tinyint, account_hash binary, sub_hash binary, payload binary"


@dataclass
class Evidence:
    accounts: int = 0
    storage_slots: int = 0
    code_references: int = 0
    code_records: int = 0
    records: int = 0
    payload_bytes: int = 0
    size: int = 0
    sha256: str = ""
    chain: str = ""

    def count(self, kind: int, payload: bytes) -> None:
        name = {1: "accounts", 2: "storage_slots", 3: "code_records"}[kind]
        setattr(self, name, getattr(self, name) + 1)
        self.code_references += kind == 1 and slim_account(payload).code_hash != EMPTY_CODE
        self.records += 1
        self.payload_bytes += len(payload)


def first_link(number: int, block_hash: bytes, state_root: bytes, header: bytes, domain: bytes = DOMAIN) -> bytes:
    return keccak(domain + number.to_bytes(8, "big") + block_hash + state_root + keccak(header))


def next_link(link: bytes, kind: int, key: bytes, payload: bytes) -> bytes:
    return keccak(link + bytes([kind]) + key + len(payload).to_bytes(8, "big") + payload)


def _check(kind: int, payload: bytes) -> None:
    if kind not in KEYS:
        raise ValueError(f"unknown record type {kind}")
    if not 0 < len(payload) <= MOST[kind]:
        raise ValueError(f"record type {kind} has a payload of {len(payload)} bytes")


class Digested:
    """A file whose bytes are counted and digested as they pass, so that none is held or read again."""

    def __init__(self, file=None):
        self.file, self.size, self.sha256 = file, 0, hashlib.sha256()

    def _seen(self, data: bytes) -> None:
        self.size += len(data)
        self.sha256.update(data)

    def write(self, data) -> int:
        self._seen(bytes(data))
        if self.file:
            self.file.write(data)
        return len(data)

    def read(self, n: int = -1) -> bytes:
        data = self.file.read(n)
        self._seen(data)
        return data

    def flush(self) -> None:
        if self.file:
            self.file.flush()


def _packer(file):
    import zstandard

    return zstandard.ZstdCompressor(write_checksum=True).stream_writer(file, closefd=False)


def write_stream(path: str, records, link: bytes, compression: str = "none") -> Evidence:
    """Writes (type, account_hash, sub_hash or None, payload) in their order, and says what was written."""
    e = Evidence()
    with open(path, "xb") as raw:
        file = Digested(raw)
        out = _packer(file) if compression == "zstd" else file
        out.write(MAGIC)
        for kind, key, sub, payload in records:
            _check(kind, payload)
            key = bytes(key) + bytes(sub or b"")
            if len(key) != KEYS[kind]:
                raise ValueError(f"record type {kind} has a key of {len(key)} bytes")
            out.write(bytes([kind]) + key + len(payload).to_bytes(8, "big") + payload)
            link = next_link(link, kind, key, payload)
            e.count(kind, payload)
        out.write(b"\x00")
        if out is not file:
            out.close()
        raw.flush()
        os.fsync(raw.fileno())
    e.size, e.sha256, e.chain = file.size, file.sha256.hexdigest(), link.hex()
    return e


#: What a folder of several streams says of them, and how they are named.
STREAMS, STREAM_NAME = "streams.json", "state-{:05d}.records"


@dataclass
class Written(WriterCommitMessage):
    stream: int
    part: str
    evidence: dict


class StreamWriter(DataSourceArrowWriter):
    """Each task writes a stream under the name of its attempt. The commit gives their names to the attempts that count and says what they hold; what others left goes, and all of it on failure."""

    def __init__(self, options):
        self.folder, self.compression, self.link = options["path"], options.get("compression", "none"), bytes.fromhex(options["link"])
        self.run = uuid.uuid4().hex

    def write(self, iterator):
        from pyspark import TaskContext

        task = TaskContext.get()
        number, part = task.partitionId(), f"{self.folder}/.{self.run}-{task.partitionId()}-{task.taskAttemptId()}"
        rows = (row for b in iterator for row in zip(*(b.column(k).to_pylist() for k in ("type", "account_hash", "sub_hash", "payload", "code_hash")), strict=True))
        stream = ((kind, code if kind == 3 else key, sub, payload) for kind, key, sub, payload, code in rows)
        first = next(stream, None)
        if first is None:
            return Written(number, "", {})
        return Written(number, part, asdict(write_stream(part, itertools.chain([first], stream), stream_link(self.link, number), self.compression)))

    def commit(self, messages):
        made = sorted((m for m in messages if m and m.part), key=lambda m: m.stream)
        for m in made:
            os.rename(m.part, f"{self.folder}/{STREAM_NAME.format(m.stream)}")
        self._clear()
        Path(f"{self.folder}/{STREAMS}").write_text(json.dumps([{"stream": m.stream} | m.evidence for m in made]))

    def abort(self, messages):
        self._clear()

    def _clear(self):
        for left in Path(self.folder).glob(f".{self.run}-*"):
            left.unlink()


def stream_link(link: bytes, number: int) -> bytes:
    """Where the record chain of one of several streams begins."""
    return keccak(link + number.to_bytes(8, "big"))


def write_streams(rows: DataFrame, folder: str, link: bytes, compression: str = "none", streams: int | None = None) -> list[tuple[int, Evidence]]:
    """Rows (type, account_hash, sub_hash, payload; code_hash, for code) as several streams, one a range of accounts, to what was written of each, by number.

    For states that one stream, which one task writes, is too long for. Ranges are written at once, by the executors, to
    a folder that all of them see; each has a record chain of its own. code stands behind the account that account_hash
    names, under its own digest. A task that fails, or is repeated, leaves nothing.
    """
    spark = rows.sparkSession
    spark.dataSource.register(RecordSource)
    os.makedirs(folder, exist_ok=True)
    code = F.col("code_hash") if "code_hash" in rows.columns else F.lit(None).cast("binary").alias("code_hash")
    n = streams or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.select("type", "account_hash", "sub_hash", "payload", code).repartitionByRange(n, "account_hash").sortWithinPartitions("account_hash", "type", "sub_hash")
    ranged.write.format("state_records").option("path", folder).option("compression", compression).option("link", link.hex()).mode("append").save()
    return [(e.pop("stream"), Evidence(**e)) for e in json.loads(Path(f"{folder}/{STREAMS}").read_text())]


def verify_streams(spark: SparkSession, folder: str, made: list[tuple[int, Evidence]], link: bytes, compression: str = "none", canonical: bool = False) -> None:
    """Each stream against what is said of it, as verify_stream does; one task a stream."""

    def check(batches):
        for batch in batches:
            out = []
            for number, said in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    verify_stream(f"{folder}/{STREAM_NAME.format(number)}", Evidence(**json.loads(said)), stream_link(link, number), compression, canonical)
                except (ValueError, OSError) as e:
                    out.append(f"stream {number}: {e}")
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["fault"])

    rows = spark.createDataFrame([(number, json.dumps(asdict(e))) for number, e in made], "stream int, said string")
    if bad := rows.repartition(max(len(made), 1), "stream").mapInArrow(check, "fault string").first():
        raise ValueError(bad.fault)


def together(made: list[tuple[int, Evidence]]) -> Evidence:
    """What several streams hold: counts and sizes added up, digests of their digests and of their chains."""
    out = Evidence(**{k: sum(getattr(e, k) for _, e in made) for k, v in asdict(Evidence()).items() if isinstance(v, int)})
    out.sha256 = hashlib.sha256(b"".join(bytes.fromhex(e.sha256) for _, e in made)).hexdigest()
    out.chain = keccak(b"".join(bytes.fromhex(e.chain) for _, e in made)).hex()
    return out


def scan_stream(file, compression: str = "none", seen=None):
    """The records of an open stream with their number; refuses what is cut off, out of bounds, or follows the end. seen: gets all decoded bytes."""
    import zstandard

    source = zstandard.ZstdDecompressor().stream_reader(file, closefd=False) if compression == "zstd" else file

    def take(n: int) -> bytes:
        parts = []
        while n:
            try:
                part = source.read(n)
            except zstandard.ZstdError as e:
                raise ValueError("record stream is packed unsoundly") from e
            if not part:
                raise ValueError("record stream is cut off")
            parts.append(part)
            n -= len(part)
        data = b"".join(parts)
        if seen is not None:
            seen.write(data)
        return data

    if take(len(MAGIC)) != MAGIC:
        raise ValueError("not a record stream")
    seq = 0
    while kind := take(1)[0]:
        if kind not in KEYS:
            raise ValueError(f"unknown record type {kind}")
        key, size = take(KEYS[kind]), int.from_bytes(take(8), "big")
        if not 0 < size <= MOST[kind]:
            raise ValueError(f"record type {kind} has a payload of {size} bytes")
        yield seq, kind, key[:32], key[32:] or None, take(size)
        seq += 1
    if source.read(1) or file.read(1):
        raise ValueError("something follows the end of the record stream")


def verify_stream(path: str, want: Evidence, link: bytes, compression: str = "none", canonical: bool = False) -> None:
    """Counts, file digest and record chain must be those of the manifest, in one pass that holds a record at a time.

    With `canonical`, a packed stream must also be, byte for byte, what this packer makes of the same records.
    """
    e, again = Evidence(), Digested()
    packer = _packer(again) if canonical and compression == "zstd" else None
    with open(path, "rb") as raw:
        file = Digested(raw)
        for _, kind, key, sub, payload in scan_stream(file, compression, packer):
            link = next_link(link, kind, key + (sub or b""), payload)
            e.count(kind, payload)
    e.size, e.sha256, e.chain = file.size, file.sha256.hexdigest(), link.hex()
    if e != want:
        raise ValueError(f"record stream differs from its manifest: {e} and {want}")
    if packer is not None:
        packer.close()
        if (again.size, again.sha256.hexdigest()) != (e.size, e.sha256):
            raise ValueError("record stream is packed in another way")


#: What a manifest says of the source, and of the file.
SOURCE = {"number": int, "block_hash": str, "state_root": str, "header": str, "compression": str, "chain_domain": str}
FILE = {"accounts": int, "storage_slots": int, "code_references": int, "code_records": int, "records": int, "payload_bytes": int, "size": int, "sha256": str, "chain": str}


def write_manifest(path: str, evidence: Evidence | list[tuple[int, Evidence]], **source) -> None:
    """Version 1 is of one stream, version 2 of several."""
    if isinstance(evidence, Evidence):
        of = {"version": 1, "state_file": asdict(evidence)}
    else:
        of = {"version": 2, "state_file": asdict(together(evidence)), "streams": [{"stream": number} | asdict(e) for number, e in evidence]}
    Path(path).write_text(json.dumps({"format": "ledgerloom-bundle", "tool_version": __version__, "source": source} | of, indent=1))


#: Bytes of a manifest, at most: several streams have a few hundred each.
MANIFEST = 64 << 20


def read_manifest(path: str) -> tuple[Evidence, dict]:
    evidence, source, _ = read_manifests(path)
    return evidence, source


def read_manifests(path: str) -> tuple[Evidence, dict, list[tuple[int, Evidence]] | None]:
    """What is said of the whole, of the source, and of each stream; None where there is one only."""
    from ledgerloom.sources.inputs import input_bytes, shaped, strict_json

    data = strict_json(input_bytes(path, MANIFEST).decode())
    streams = data.pop("streams", None) if isinstance(data, dict) else None
    data = shaped(data, {"format": str, "version": int, "tool_version": str, "source": SOURCE, "state_file": FILE})
    if (data["format"], data["version"]) != ("ledgerloom-bundle", 1 if streams is None else 2):
        raise ValueError("manifest is of another format or version")
    e = Evidence(**data["state_file"])
    if e.records != e.accounts + e.storage_slots + e.code_records or not e.code_records <= e.code_references <= e.accounts:
        raise ValueError("counts of the manifest do not go together")
    if streams is None:
        return e, data["source"], None
    if not isinstance(streams, list):
        raise ValueError("streams are no list")
    made = [(x.pop("stream"), Evidence(**x)) for x in (shaped(x, FILE | {"stream": int}) for x in streams)]
    if any(a >= b for (a, _), (b, _) in zip(made, made[1:])) or together(made) != e:
        raise ValueError("streams of the manifest do not go together")
    return e, data["source"], made


@dataclass
class Stream(InputPartition):
    path: str
    before: int = 0


class RecordReader(DataSourceReader):
    def __init__(self, options):
        self.paths = [p for p in options["path"].split(",") if p]
        self.compression = options.get("compression", "none")
        self.before = [int(n) for n in options.get("before", "").split(",") if n] or [0] * len(self.paths)

    def partitions(self):
        return [Stream(p, n) for p, n in zip(self.paths, self.before, strict=True)]

    def read(self, partition):
        rows = []
        schema = pa.schema([("seq", pa.int64()), ("type", pa.int8()), ("account_hash", pa.binary()), ("sub_hash", pa.binary()), ("payload", pa.binary())])
        with open(partition.path, "rb") as file:
            for seq, *row in scan_stream(file, self.compression):
                rows.append((partition.before + seq, *row))
                if len(rows) == 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                    rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


class RecordSource(DataSource):
    """spark.read.format("state_records").option("path", "a,b").option("compression", "zstd"); to write, path is a folder, and link the chain's beginning in hex."""

    @classmethod
    def name(cls):
        return "state_records"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return RecordReader(self.options)

    def writer(self, schema, overwrite):
        return StreamWriter(self.options)


def read_records(spark: SparkSession, paths: list[str], compression: str = "none", before: list[int] | None = None) -> DataFrame:
    """The records of streams, each a partition; before: by how much the numbers of each begin, noughts if not told."""
    spark.dataSource.register(RecordSource)
    options = {"path": ",".join(paths), "compression": compression} | ({"before": ",".join(map(str, before))} if before else {})
    return spark.read.format("state_records").options(**options).load()
