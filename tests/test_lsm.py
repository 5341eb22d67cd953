"""Log-structured tables that this module writes, read back."""

import random

import pyarrow as pa
import pytest

from ledgerloom.sources import lsm

LEVEL, BLOCK = 3, 300


def varint(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def text(b):
    return varint(len(b)) + b


def crc(b):
    return lsm.checksums([b])[0].to_bytes(4, "little")


def log_file(records):
    out = b""
    for r in records:
        first = True
        while True:
            room = lsm.LOG_BLOCK - len(out) % lsm.LOG_BLOCK
            if room < 7:
                out += bytes(room)
                continue
            part, r = r[: room - 7], r[room - 7 :]
            kind = (1 if not r else 2) if first else (4 if not r else 3)
            out += crc(bytes([kind]) + part) + len(part).to_bytes(2, "little") + bytes([kind]) + part
            first = False
            if not r:
                break
    return out


def block(entries, every=4):
    data, restarts, before = b"", [], b""
    for k, (key, value) in enumerate(entries):
        shared = 0
        if k % every:
            while shared < min(len(key), len(before)) and key[shared] == before[shared]:
                shared += 1
        else:
            restarts.append(len(data))
        data += varint(shared) + varint(len(key) - shared) + varint(len(value)) + key[shared:] + value
        before = key
    return data + b"".join(x.to_bytes(4, "little") for x in restarts or [0]) + max(len(restarts), 1).to_bytes(4, "little")


def table(entries, snappy):
    """entries (key, seq, live, value), in order of key, newest first."""
    out, index, waiting = b"", [], []

    def put(raw):
        nonlocal out
        packed = pa.Codec("snappy").compress(raw).to_pybytes() if snappy else raw
        handle = varint(len(out)) + varint(len(packed))
        out += packed + bytes([snappy]) + crc(packed + bytes([snappy]))
        return handle

    inner = [(key + (seq << 8 | live).to_bytes(8, "little"), value) for key, seq, live, value in entries]
    for k, (key, value) in enumerate(inner):
        waiting.append((key, value))
        if sum(len(a) + len(b) for a, b in waiting) > BLOCK or k == len(inner) - 1:
            index.append((key, put(block(waiting))))
            waiting = []
    meta, top = put(block([])), put(block(index, 1))
    return out + (meta + top).ljust(40, b"\0") + lsm.MAGIC, inner[0][0], inner[-1][0]


@pytest.fixture
def store(tmp_path):
    """Three tables, one of which an edit has replaced, and a journal that deletes and writes: the folder, and what it holds."""
    draw = random.Random(6)
    names, seq, now, tables = [b"k%04d" % n for n in range(900)] + [b"z" * 5000], 0, {}, []
    for part in (names[:400], names[300:], names[:50] + names[850:]):
        entries = []
        for key in part:
            for _ in range(draw.choice([1, 1, 2])):
                seq += 1
                live = draw.random() < 0.8
                value = draw.randbytes(draw.choice([0, 5, 40, 20_000 if draw.random() < 0.02 else 3])) if live else b""
                entries.append((key, seq, live, value))
                now[key] = value if live else None
        entries.sort(key=lambda e: (e[0], -e[1]))
        tables.append(entries)
    edits, at = [b"\x01" + text(lsm.COMPARATOR) + b"\x02" + varint(7)], tmp_path / "db"
    at.mkdir()
    for n, entries in enumerate(tables):
        data, low, high = table(entries, n % 2)
        (at / f"{10 + n:06d}.{('ldb', 'sst')[n == 1]}").write_bytes(data)
        edits.append(b"\x07" + varint(LEVEL) + varint(10 + n) + varint(len(data)) + text(low) + text(high) + b"\x04" + varint(seq))
    edits.insert(2, b"\x07" + varint(0) + varint(99) + varint(5) + text(bytes(8)) + text(bytes(8)))
    edits.append(b"\x06" + varint(0) + varint(99) + b"\x02" + varint(20) + b"\x03" + varint(30) + b"\x05" + varint(1) + text(b"x"))
    (at / "MANIFEST-000005").write_bytes(log_file(edits))
    (at / "CURRENT").write_bytes(b"MANIFEST-000005\n")
    batch = (seq + 1).to_bytes(8, "little") + (3).to_bytes(4, "little") + b"\x01" + text(b"k0001") + text(b"new" * 20_000) + b"\x00" + text(b"k0002") + b"\x01" + text(b"only here") + text(b"")
    (at / "000020.log").write_bytes(log_file([batch]))
    (at / "000007.log").write_bytes(b"older than the tables")
    return at, {k: v for k, v in (now | {b"k0001": b"new" * 20_000, b"k0002": None, b"only here": b""}).items() if v is not None}


def test_checksum_is_the_known_one():
    plain = 0xE3069283  # of 123456789
    assert lsm.checksums([b"123456789"])[0] == ((plain >> 15 | plain << 17) + lsm.MASK) & 0xFFFFFFFF
    draw = random.Random(1)
    parts = [draw.randbytes(n) for n in (0, 1, 7, 300, lsm.LONG + 5)]
    assert lsm.checksums(parts) == [lsm.checksums([p])[0] for p in parts]


def test_newest_entries_are_read(spark, store):
    at, want = store
    files = sorted((p.name, p.read_bytes()) for p in at.iterdir())
    got = [(bytes(r.key), bytes(r.value)) for r in lsm.read_lsm(spark, str(at)).collect()]
    assert len(got) == len(dict(got)) and dict(got) == want
    assert files == sorted((p.name, p.read_bytes()) for p in at.iterdir())  # nothing is written


def test_a_range_opens_its_tables_only(spark, store):
    at, want = store
    for low, high, parts in ((b"k0500", b"k0501", 3), (b"k0100", b"k0110", 3), (b"zz", None, 3), (b"a", b"b", 1), (b"", None, 4)):
        assert lsm.read_entries(spark, str(at), low, high).rdd.getNumPartitions() == parts
        got = {bytes(r.key): bytes(r.value) for r in lsm.read_lsm(spark, str(at), low, high).collect()}
        assert got == {k: v for k, v in want.items() if k >= low and (high is None or k < high)}


def test_unsound_stores_are_refused(spark, store):
    at, _ = store
    read = lambda: lsm.read_lsm(spark, str(at)).count()

    def refused(name, data, match):
        path = at / name
        before = path.read_bytes() if path.exists() else None
        path.unlink(missing_ok=True)
        if data is not None:
            path.write_bytes(data)
        with pytest.raises(Exception, match=match):
            read()
        path.unlink(missing_ok=True)
        if before is not None:
            path.write_bytes(before)

    good = (at / "000010.ldb").read_bytes()
    refused("000010.ldb", good[:100] + bytes([good[100] ^ 1]) + good[101:], "checksum")
    refused("000010.ldb", good[:-1], "size")
    refused("000010.ldb", None, "regular")
    refused("000010.ldb", good[:-1] + b"x", "no table")
    refused("MANIFEST-000005", None, "regular")
    manifest = (at / "MANIFEST-000005").read_bytes()
    refused("MANIFEST-000005", manifest[:-3], "cut off")
    refused("MANIFEST-000005", manifest[:20] + b"?" + manifest[21:], "checksum")
    for current in (b"MANIFEST-000005", b"MANIFEST-5\n", b"MANIFEST-0000005\n", b"000010.ldb\n", b"", b"M" * 100):
        refused("CURRENT", current, "CURRENT")
    refused("CURRENT.7", b"MANIFEST-000005\n", "about to be changed")
    journal = (at / "000020.log").read_bytes()
    refused("000020.log", journal[:-1], "cut off")
    read()
    (at / "link").symlink_to(at / "CURRENT")
    (at / "CURRENT").rename(at / "x")
    (at / "CURRENT").symlink_to(at / "x")
    with pytest.raises(Exception, match="regular"):
        read()


def test_verbs_read_a_store_in_place(spark, tmp_path):
    from ledgerloom.__main__ import parser, run
    from tests.fixtures import database, frame

    kv, root = database()
    at = tmp_path / "db"
    at.mkdir()
    data, low, high = table([(k, 1 + n, True, v) for n, (k, v) in enumerate(sorted(kv.items()))], 1)
    (at / "000003.ldb").write_bytes(data)
    (at / "MANIFEST-000002").write_bytes(log_file([b"\x01" + text(lsm.COMPARATOR) + b"\x02" + varint(4) + b"\x07" + varint(2) + varint(3) + varint(len(data)) + text(low) + text(high)]))
    (at / "CURRENT").write_bytes(b"MANIFEST-000002\n")
    frame(spark, kv).write.parquet(str(tmp_path / "kv"))
    go = lambda source: run(spark, parser().parse_args(["prune", "--source", str(tmp_path / source)]))
    store, parquet = go("db"), go("kv")
    assert store["measures"] == parquet["measures"] and store["protected_digest"] == parquet["protected_digest"] and store["source"]["head_before"]["state_root"] == root.hex()
