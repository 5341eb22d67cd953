import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import rlp
from ledgerloom.functions.keccak import keccak
from ledgerloom.plans import convert, history, report, snapshot, trie
from ledgerloom.sources import freezer, inputs, kv as kv_source, records
from tests.fixtures import NEW_CODE, TOKEN, database, frame, holder, trie_rows


@pytest.fixture(scope="module")
def base(spark):
    kv, root = database()
    return frame(spark, kv).cache(), kv, root


@pytest.fixture(scope="module")
def known(base):
    df, _, root = base
    return snapshot.traverse(df, root)


@pytest.fixture
def traversed(known, monkeypatch):
    """For tests of what comes after a traversal: the source is not gone through each time."""
    monkeypatch.setattr(snapshot, "traverse", lambda kv, root: known)


def head_of(kv):
    return history.read_head(kv.get)


def test_bundle_round_trip_and_layouts(spark, base, tmp_path, traversed):
    df, kv, root = base
    head = head_of(kv)
    state = snapshot.traverse(df, root)
    got = state.counts()
    assert (got["accounts"], got["storage_slots"], got["code_references"], got["code_records"]) == (8, 10, 5, 2)
    plain = snapshot.export(df, head, str(tmp_path / "plain"))
    packed = snapshot.export(df, head, str(tmp_path / "packed"), compression="zstd")
    assert plain.chain == packed.chain and plain.records == got["records"] and plain.code_references == 5
    with pytest.raises(FileExistsError):
        snapshot.export(df, head, str(tmp_path / "plain"))
    again, h, _ = snapshot.read_bundle(spark, str(tmp_path / "packed"))
    assert h == head and again.counts() == got
    again.nodes = snapshot.nodes_of(again)
    everything = lambda s, scheme: sorted(map(tuple, snapshot.layout(s, scheme).collect()))
    for scheme in ("hash", "path"):
        assert everything(state, scheme) == everything(again, scheme)
    other = snapshot.export(df, head, str(tmp_path / "other"), domain=b"another chain")
    assert other.chain != plain.chain and snapshot.read_bundle(spark, str(tmp_path / "other"), b"another chain")[1] == head
    with pytest.raises(ValueError, match="domain"):
        snapshot.read_bundle(spark, str(tmp_path / "other"), records.DOMAIN)
    data = bytearray((tmp_path / "plain/state.records").read_bytes())
    data[-3] ^= 1
    (tmp_path / "plain/state.records").write_bytes(data)
    with pytest.raises(ValueError):
        snapshot.read_bundle(spark, str(tmp_path / "plain"))


def rewritten_stream(folder, head, change):
    """The plain bundle in the folder with its records changed, and with counts, digests and chain that fit."""
    path, manifest = folder / "state.records", folder / "manifest.json"
    with open(path, "rb") as file:
        rows = [r[1:] for r in records.scan_stream(file)]
    path.unlink()
    e = records.write_stream(str(path), change(rows), records.first_link(head.number, head.hash, head.state_root, head.header))
    _, source = records.read_manifest(str(manifest))
    records.write_manifest(str(manifest), e, **source)


MISORDERED = {
    "slot (of another account|after its account's code)": lambda rows: moved(rows, slot_of(rows), slot_of(rows) - 1),
    "(code of another account|a second code|first account)": lambda rows: moved(rows, code_of(rows), code_of(rows) - 1),
    "(code of another account|a second code|named first)": lambda rows: moved(rows, code_of(rows), code_of(rows) + 1),
    "slots out of order": lambda rows: moved(rows, slot_of(rows) + 1, slot_of(rows)),
    "accounts out of order": lambda rows: moved(rows, len(rows) - 1, len(rows) - 2) if rows[-1][0] == rows[-2][0] == 1 else rows[:1] + rows,
    "code is missing": lambda rows: rows[: code_of(rows)] + rows[code_of(rows) + 1 :],
    "a second code of an account": lambda rows: rows[: code_of(rows)] + rows[code_of(rows) :][:1] + rows[code_of(rows) :],
    "a record before the first account": lambda rows: [rows[slot_of(rows)]] + rows,
}


def slot_of(rows):
    return next(k for k, r in enumerate(rows) if r[0] == 2)


def code_of(rows):
    return next(k for k, r in enumerate(rows) if r[0] == 3)


def moved(rows, k, to):
    rest = rows[:k] + rows[k + 1 :]
    return rest[:to] + [rows[k]] + rest[to:]


@pytest.mark.parametrize("fault", MISORDERED)
def test_misordered_bundles_are_refused(spark, base, tmp_path, traversed, fault):
    df, kv, _ = base
    snapshot.export(df, head_of(kv), str(tmp_path / "b"))
    snapshot.read_bundle(spark, str(tmp_path / "b"))
    rewritten_stream(tmp_path / "b", head_of(kv), MISORDERED[fault])
    with pytest.raises(ValueError, match=fault):
        snapshot.read_bundle(spark, str(tmp_path / "b"))


def test_code_comes_where_it_is_named_first(spark, base, tmp_path, traversed):
    """The code that three accounts name, behind the second of them."""
    df, kv, _ = base
    snapshot.export(df, head_of(kv), str(tmp_path / "b"))

    def later(rows):
        k = next(k for k, r in enumerate(rows) if r[0] == 3 and sum(rlp.slim_account(x[3]).code_hash == r[1] for x in rows if x[0] == 1) == 3)
        second = [j for j, x in enumerate(rows) if x[0] == 1 and rlp.slim_account(x[3]).code_hash == rows[k][1]][1]
        return rows[:k] + rows[k + 1 : second + 1] + [rows[k]] + rows[second + 1 :]

    rewritten_stream(tmp_path / "b", head_of(kv), later)
    with pytest.raises(ValueError, match="named first"):
        snapshot.read_bundle(spark, str(tmp_path / "b"))


def test_packed_in_another_way_is_refused(base, tmp_path, traversed):
    import zstandard

    df, kv, _ = base
    e = snapshot.export(df, head_of(kv), str(tmp_path / "b"), compression="zstd")
    head = head_of(kv)
    link = records.first_link(head.number, head.hash, head.state_root, head.header)
    path = tmp_path / "b/state.records.zst"
    raw = zstandard.ZstdDecompressor().stream_reader(path.read_bytes()).read()
    path.write_bytes(zstandard.ZstdCompressor(level=19, write_checksum=True).compress(raw + b""))
    e.size, e.sha256 = path.stat().st_size, inputs.file_digest(str(path))
    records.verify_stream(str(path), e, link, "zstd")
    with pytest.raises(ValueError, match="packed in another way"):
        records.verify_stream(str(path), e, link, "zstd", canonical=True)


def test_nodes_are_those_of_one_task(spark):
    """Dealt by nibbles or not, the nodes are those that one builder makes."""
    import random

    draw = random.Random(3)
    rows, want = [], set()
    for n in range(6):
        owner = bytes([n]) * 32
        keys = {draw.randbytes(32) for _ in range((1, 2, 17, 90, 300, 40)[n])}
        if n == 5:
            keys = {b"\x3a" + k[1:] for k in keys}  # all below one branch of the first two levels
        leaves = {k: draw.randbytes(draw.randint(1, 40)) for k in keys}
        top, every = trie.build(sorted((trie.nibbles(k), v) for k, v in leaves.items()))
        want |= {(owner, "".join(f"{x:x}" for x in e.at), e.hash, e.blob) for e in every if len(e.blob) >= 32 or e is top}
        rows += [(bytearray(owner), bytearray(k), bytearray(v)) for k, v in leaves.items()]
    df = spark.createDataFrame(rows, "owner binary, key binary, value binary")
    for large in (1000, 10, 1, 20):
        got = [(bytes(r.owner), r.path, bytes(r.hash), bytes(r.blob)) for r in trie.trie_nodes(df, large).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def target_rows(spark, path):
    return {bytes(r.key): bytes(r.value) for r in spark.read.parquet(f"{path}/database").collect()}


def rewritten(spark, path, rows):
    import shutil

    shutil.rmtree(f"{path}/database")
    frame(spark, rows).coalesce(1).write.parquet(f"{path}/database")


@pytest.mark.parametrize("scheme", ["hash", "path"])
def test_tampered_artifacts_are_refused(spark, base, tmp_path, scheme, known):
    df, kv, _ = base
    head, path = head_of(kv), str(tmp_path / "artifact")
    made = snapshot.migrate(df, head, path, scheme)
    assert made["inventory"]["metadata"]["keys"] == (5 if scheme == "hash" else 9)
    assert snapshot.verify_direct(df, head, path) == made
    good = target_rows(spark, path)
    assert good[b"LastBlock"] == good[b"LastHeader"] == head.hash
    key = next(k for k in good if len(k) >= 32 and k[:1] not in b"hH")
    state = known
    for change in ({b"LastBlock": bytes(32)}, {b"LastHeader": None}, {b"something else": b"x"}, {key: None}, {key: good[key] + b"x"}):
        rewritten(spark, path, {k: v for k, v in (good | change).items() if v is not None})
        with pytest.raises(ValueError):
            snapshot.verify(spark, f"{path}/database", state, head, scheme)
    rewritten(spark, path, good)
    text = (tmp_path / "artifact/verification.json").read_text()
    (tmp_path / "artifact/.verification.json.crc").unlink(missing_ok=True)
    for old, new in (('"accounts": 8', '"accounts": 9'), ('"scheme"', '"schema"'), (head.hash.hex(), "00" * 32), ('"version": 1', '"version": 2')):
        (tmp_path / "artifact/verification.json").write_text(text.replace(old, new))
        with pytest.raises(ValueError):
            snapshot._verified(spark, path, snapshot.read_artifact(spark, path), report.direct(head, scheme, state.counts()), state, head)
    (tmp_path / "artifact/verification.json").write_text(text)
    (tmp_path / "artifact/more").write_text("x")
    with pytest.raises(ValueError, match="no artifact"):
        snapshot.verify_direct(df, head, path)


def test_path_layouts_stand_by_themselves(spark, base, known):
    df, kv, root = base
    rows = [tuple(r) for r in snapshot.layout(known, "path").collect()]
    check = lambda rows: snapshot.verify_paths(spark.createDataFrame(rows, "key binary, value binary, kind string"), root)
    check(rows)
    at = lambda kind: next(k for k, r in enumerate(rows) if r[2] == kind)
    with pytest.raises(ValueError, match="missing"):
        check([r for r in rows if r[:1] != (b"A",)])
    with pytest.raises(ValueError, match="not referred to"):
        check([*rows, (bytearray(b"A" + b"\x0f" * 9), rows[at("account node")][1], "account node")])
    with pytest.raises(ValueError):
        check([(k, v[:-1] + bytes([v[-1] ^ 1]) if n == at("slot") else v, kind) for n, (k, v, kind) in enumerate(rows)])


def test_failure_leaves_nothing(spark, base, tmp_path, traversed):
    """A check that fails after writing, or a folder that appears meanwhile: no output, and nothing beside it."""
    df, kv, root = base

    def fail():
        raise ValueError("the head has moved")

    for k, make in enumerate((lambda to: snapshot.migrate(df, head_of(kv), to, "hash", fail), lambda to: snapshot.prune(df, root, to, confirm=fail), lambda to: snapshot.export(df, head_of(kv), to, confirm=fail))):
        (tmp_path / str(k)).mkdir()
        with pytest.raises(ValueError, match="moved"):
            make(str(tmp_path / str(k) / "out"))
        assert list((tmp_path / str(k)).iterdir()) == []
    (tmp_path / "race").mkdir()
    with pytest.raises(FileExistsError):
        snapshot.migrate(df, head_of(kv), str(tmp_path / "race/out"), "hash", (tmp_path / "race/out").mkdir)
    assert list((tmp_path / "race").iterdir()) == [tmp_path / "race/out"] and not list((tmp_path / "race/out").iterdir())


def test_missing_and_false_nodes_are_refused(spark, base):
    _, kv, root = base
    with pytest.raises(ValueError, match="missing"):
        snapshot.traverse(frame(spark, {k: v for k, v in kv.items() if k != root}), root)
    code = keccak(b"\x60\x01\x00")
    with pytest.raises(ValueError, match="code"):
        snapshot.traverse(frame(spark, {k: v for k, v in kv.items() if k != code}), root)


def test_prune_keeps_what_is_reached(spark, base, tmp_path):
    _, kv, root = base
    old = {keccak(bytes([n % 256, n // 256])): bytes([n % 256, n // 256]) for n in range(300)}
    unknown = {b"\x07" * 32: b"what is this"}
    df = frame(spark, kv | old | unknown)
    dry = snapshot.prune(df, root)
    assert dry["candidates_keys"] == 300 and dry["unknown_keys"] == 1 and dry["protected_keys"] == len(kv) + 1
    assert snapshot.prune(df, root, str(tmp_path / "pruned")) == dry
    left = {bytes(r.key): bytes(r.value) for r in spark.read.parquet(str(tmp_path / "pruned")).collect()}
    assert left == kv | unknown
    assert snapshot.prune(df, root, str(tmp_path / "compact"), compact=True) == dry and dry["state_counts"]["accounts"] == 8
    keys = [bytes(r.key) for f in sorted((tmp_path / "compact").glob("*.parquet")) for r in spark.read.parquet(str(f)).collect()]
    assert keys == sorted(left)  # files hold ranges of keys, in order
    with pytest.raises(ValueError, match="another layout"):
        snapshot.prune(frame(spark, kv | {b"c" + keccak(b"x"): b"x"}), root)


def test_multiset_digests_add_up(spark):
    from ledgerloom.operators import digests

    rows = [(bytearray([k % 7]), bytearray([k % 3])) for k in range(50)]
    df = spark.createDataFrame(rows, "key binary, value binary")
    of = lambda d: {r.lane: r.value for r in digests.multiset_lanes(d, F.col("key"), F.col("value")).collect()}
    whole, a, b = of(df.repartition(5)), of(df.limit(20)), of(spark.createDataFrame(rows[20:], df.schema))
    assert len(whole) == digests.LANES and whole == {k: (a[k] + b[k]) % 65536 for k in a}
    assert of(df.dropDuplicates()) != whole and set(of(df.limit(0)).values()) <= {0}
    swapped = spark.createDataFrame([(bytearray([1, 2]), bytearray([3]))], df.schema), spark.createDataFrame([(bytearray([1]), bytearray([2, 3]))], df.schema)
    assert digests.multiset_digest(swapped[0], F.col("key"), F.col("value")) != digests.multiset_digest(swapped[1], F.col("key"), F.col("value"))


def test_history_and_conversion(spark, base):
    df, kv, root = base
    head = history.read_head(kv.get)
    assert head.number == 1 and head.state_root == root
    evidence, events = history.scan(df, head, TOKEN)
    assert (evidence.blocks, evidence.transfers, evidence.approvals) == (2, 2, 1)
    state = snapshot.traverse(df, root)
    witness = spark.createDataFrame([("address", bytearray(holder(n)), None, None) for n in range(1, 9)], "type string, address binary, owner binary, spender binary")
    none = spark.createDataFrame([], "address binary")
    pieces = convert.pieces(events, none, witness, TOKEN)
    out, new, got = convert.convert(state, TOKEN, *pieces, NEW_CODE)
    assert (got.migrated_native, got.remaining_supply, got.eoa_holders, got.converted_contract_holders, got.retained_contract_holders, got.self_balance) == (209, 99, 3, 2, 1, 77)
    snapshot.check_roots(out, new)
    balances = {bytes(r.account_hash): int.from_bytes(r.balance, "big") for r in out.accounts.collect()}
    assert balances[keccak(holder(5))] == 55 and balances[keccak(TOKEN)] == 99 and balances[keccak(holder(2))] == 0
    listed = spark.createDataFrame([(bytearray(holder(3)),)], "address binary")
    assert convert.convert(state, TOKEN, *pieces, NEW_CODE, listed)[2].retained_contract_holders == 2
    with pytest.raises(ValueError, match="unknown owner"):
        convert.convert(state, TOKEN, none.union(pieces[0].where("false")), pieces[1], pieces[2], NEW_CODE)
    block = rlp.decode(convert.checkpoint(head.header, new))
    assert block[0] == head.hash and block[3] == new and rlp.number(block[8]) == 2


def test_transfer_of_nothing_keeps_no_one(spark):
    kv, root = database(first_amount=0)
    df = frame(spark, kv)
    _, events = history.scan(df, history.read_head(kv.get), TOKEN)
    witness = spark.createDataFrame([("address", bytearray(holder(n)), None, None) for n in range(1, 9)], "type string, address binary, owner binary, spender binary")
    got = convert.convert(snapshot.traverse(df, root), TOKEN, *convert.pieces(events, spark.createDataFrame([], "address binary"), witness, TOKEN), NEW_CODE)[2]
    assert (got.migrated_native, got.remaining_supply, got.retained_contract_holders) == (231, 77, 0)


@pytest.mark.parametrize(("change", "what"), [({"supply": 309}, "do not add up"), ({"extra_slot": True}, "unknown owner")])
def test_conversion_refuses(spark, change, what):
    kv, root = database(**change)
    df = frame(spark, kv)
    _, events = history.scan(df, history.read_head(kv.get), TOKEN)
    witness = spark.createDataFrame([("address", bytearray(holder(n)), None, None) for n in range(1, 9)], "type string, address binary, owner binary, spender binary")
    with pytest.raises(ValueError, match=what):
        convert.convert(snapshot.traverse(df, root), TOKEN, *convert.pieces(events, spark.createDataFrame([], "address binary"), witness, TOKEN), NEW_CODE)


def test_alloc_overlay(spark, base, tmp_path):
    df, _, root = base
    a, slot = "0x" + holder(1).hex(), "0x" + "01" * 32
    (tmp_path / "alloc.json").write_text(json.dumps({a: {"balance": "0x10", "storage": {slot: "0x05"}}, "99" * 20: {"balance": "7", "nonce": "3", "code": "0x6001"}}))
    state, new = convert.overlay_alloc(snapshot.traverse(df, root), inputs.read_alloc(spark, str(tmp_path / "alloc.json")))
    snapshot.check_roots(state, new)
    rows = {bytes(r.account_hash): r for r in state.accounts.collect()}
    assert int.from_bytes(rows[keccak(holder(1))].balance, "big") == 16 and rows[keccak(holder(1))].nonce == 1
    assert bytes(rows[keccak(holder(1))].storage_root) == trie_rows({keccak(b"\x01" * 32): rlp.encode(5)})[0]
    (tmp_path / "zero.json").write_text(json.dumps({a: {"storage": {slot: "0x00"}, "balance": "0"}}))
    back, _ = convert.overlay_alloc(state, inputs.read_alloc(spark, str(tmp_path / "zero.json")))
    assert bytes(back.accounts.where(F.col("account_hash") == F.lit(bytearray(keccak(holder(1))))).first().storage_root) == trie.EMPTY_ROOT


def test_history_from_cold_files(spark, tmp_path):
    import pyarrow as pa

    kv, root = database()
    head = history.read_head(kv.get)
    num = lambda n: n.to_bytes(8, "big")
    tables = {"hashes": [kv[b"h" + num(n) + b"n"] for n in (0, 1)]}
    tables["headers"] = [kv[b"h" + num(n) + tables["hashes"][n]] for n in (0, 1)]
    tables["receipts"] = [kv[b"r" + num(n) + tables["hashes"][n]] for n in (0, 1)]
    for name, items in tables.items():
        packed = name != "hashes"
        index, file, offset = bytes(6), 0, 0
        for n, item in enumerate(items):
            blob = pa.Codec("snappy").compress(item, asbytes=True) if packed else item
            if n == 1 and name == "headers":  # the second file
                file, offset = 1, 0
            with open(tmp_path / f"{name}.{file:04d}.{'cdat' if packed else 'rdat'}", "ab") as f:
                f.write(blob)
            offset += len(blob)
            index += file.to_bytes(2, "big") + offset.to_bytes(4, "big")
        (tmp_path / f"{name}.{'cidx' if packed else 'ridx'}").write_bytes(index)
    cold = freezer.read_freezer(spark, str(tmp_path), {"hashes": False, "headers": True, "receipts": True})
    named = {"hash": cold["hashes"], "header": cold["headers"], "receipts": cold["receipts"]}
    state_only = {k: v for k, v in kv.items() if len(k) == 32}
    both, _ = history.scan(frame(spark, kv), head, TOKEN, named)
    alone, _ = history.scan(frame(spark, state_only), head, TOKEN, named)
    hot, _ = history.scan(frame(spark, kv), head, TOKEN)
    assert both == alone == hot
    lost = {k: v for k, v in kv.items() if k[:1] != b"r"}
    with pytest.raises(ValueError, match="missing"):
        history.scan(frame(spark, lost), head, TOKEN)
    forged = dict(kv) | {b"r" + num(1) + tables["hashes"][1]: b"\xc0"}
    with pytest.raises(ValueError, match="block 1"):
        history.scan(frame(spark, forged), head, TOKEN)


def test_inputs_are_strict(spark, tmp_path):
    lines = ['{"type":"address","address":"0x' + "aB" * 20 + '"}', '{"type":"allowance","owner":"0x' + "11" * 20 + '","spender":"0x' + "22" * 20 + '"}', '{"type":"address","address":"0x12"}', '{"type":"address","address":"0x' + "11" * 20 + '","x":1}', '{"type":"address","type":"address"}', "nonsense"]
    (tmp_path / "w.jsonl").write_text("\n".join(lines))
    faults = [r.fault for r in inputs.read_witness(spark, str(tmp_path / "w.jsonl")).collect()]
    assert faults == [None, None, "malformed address", "fields of another type", "a field occurs twice", "no JSON object"]
    for bad in ('{"a":1,"A":2}', '{"a":null}', '{"a":NaN}', '{"a":1}x'):
        with pytest.raises(ValueError):
            inputs.strict_json(bad)
    (tmp_path / "list").write_text(f"0x{'ab' * 20}\n0x{'AB' * 20}\n0x{TOKEN.hex()}\n0x12\n0x{'cd' * 20}")
    faults = {r.fault for r in inputs.read_retention(spark, str(tmp_path / "list"), "0x" + TOKEN.hex()).collect()}
    assert faults == {None, "address occurs twice", "the token contract cannot be listed", "malformed address"}
    (tmp_path / "link").symlink_to(tmp_path / "list")
    with pytest.raises(ValueError):
        inputs.input_bytes(str(tmp_path / "link"))
    with pytest.raises(ValueError):
        inputs.outside(str(tmp_path / "list" / "x"), str(tmp_path / "list"))


def test_record_bounds(tmp_path):
    key = bytes(32)
    for bad in ((1, key, None, b""), (1, key, None, bytes(111)), (2, key, None, b"\x01"), (4, key, None, b"\x01")):
        with pytest.raises(ValueError):
            records.write_stream(str(tmp_path / f"{bad[0]}{len(bad[3])}"), [bad], key)


def test_kv_reads(spark, base):
    df, kv, root = base
    assert kv_source.get(df, b"LastBlock") == kv[b"LastBlock"] and kv_source.get(df, b"nothing") is None
    assert [bytes(r.key) for r in kv_source.scan(df, b"h").collect()] == sorted(k for k in kv if k[:1] == b"h")


def verb(spark, *args):
    from ledgerloom.__main__ import parser, run

    return run(spark, parser().parse_args([str(x) for x in args]))


def test_verbs(spark, base, tmp_path):
    df, _, root = base
    df.write.parquet(str(tmp_path / "kv"))
    go = lambda *args: verb(spark, *args)
    assert go("export", "--source", tmp_path / "kv", "--out", tmp_path / "bundle", "--compression", "zstd")["accounts"] == 8
    direct = go("migrate", "--source", tmp_path / "kv", "--out", tmp_path / "direct", "--scheme", "path")
    portable = go("import", "--bundle", tmp_path / "bundle", "--out", tmp_path / "portable", "--scheme", "path")
    assert portable["verification"]["inventory"] == direct["verification"]["inventory"] and target_rows(spark, tmp_path / "portable") == target_rows(spark, tmp_path / "direct")
    assert go("verify", "--bundle", tmp_path / "bundle", "--target", tmp_path / "portable") == portable
    assert go("verify", "--source", tmp_path / "kv", "--target", tmp_path / "direct") == direct
    with pytest.raises(ValueError, match="portable"):
        go("verify", "--bundle", tmp_path / "bundle", "--target", tmp_path / "direct")
    found = go("prune", "--source", tmp_path / "kv", "--report", tmp_path / "report.json", "--genesis-root", root.hex())
    assert found["dry_run"] and not found["compacted"] and found["genesis_root"] == root.hex() and len(found["protected_digest"]) == 64
    assert found["measures"]["candidates_keys"] == 0 and json.loads((tmp_path / "report.json").read_text()) == found
    with pytest.raises(ValueError):
        go("export", "--source", tmp_path / "kv", "--out", tmp_path / "kv" / "inside")
    with pytest.raises(SystemExit):
        go("migrate", "--source", "", "--out", tmp_path / "x")


def audit_of(head, code_hash):
    state = {"root": "0x" + head.state_root.hex(), "ovmCodeHash": "0x" + code_hash.hex(), "balanceSlots": 7, "balancesWei": "308", "supplyWei": "308", "differenceWei": "0"}
    one = "0x" + "11" * 32
    totals = dict.fromkeys(("balanceDeltaWei", "supplyDeltaWei", "discrepancyDeltaWei", "gasShortfallWei", "legacySelfdestructWei", "unexplainedDeltaWei"), "0")
    identity = {"version": 1, "genesis": one, "configHash": one, "witnessHash": one, "to": head.number, "toHash": "0x" + head.hash.hex(), "deSeqBlock": 0, "seqValidHeight": 0, "firstSequencer": "0x" + "00" * 20}
    return {
        "version": 1, "identity": identity, "clientVersion": "test", "from": 1, "verifiedBlocks": head.number, "genesisState": dict(state), "targetState": dict(state), "totals": totals,
        "executionVerified": True, "accountingReconciled": True, "intervalCausesFullyExplained": True, "unexplainedEvents": 0, "genesisDifferenceExplained": True,
    }


def test_conversion_verb_and_its_replay(spark, base, tmp_path):
    df, kv, _ = base
    df.write.parquet(str(tmp_path / "kv"))
    head = head_of(kv)
    (tmp_path / "witness").write_text("\n".join(json.dumps({"type": "address", "address": "0x" + holder(n).hex()}) for n in range(1, 9)))
    (tmp_path / "code").write_text("0x" + NEW_CODE.hex())
    (tmp_path / "alloc").write_text(json.dumps({"0x" + holder(1).hex(): {"nonce": "9"}}))
    (tmp_path / "audit").write_text(json.dumps(audit_of(head, keccak(b"\x60\x00\x00"))))
    given = ["--source", tmp_path / "kv", "--token", TOKEN.hex(), "--witness", tmp_path / "witness", "--code", tmp_path / "code", "--alloc", tmp_path / "alloc", "--audit", tmp_path / "audit"]
    made = verb(spark, "convert", *given, "--out", tmp_path / "out", "--scheme", "path")
    said = made["verification"]
    assert said["balances"]["migrated_native"] == "209" and said["audit"] == {"balance_sum": "308", "supply_difference": "0"} and said["checkpoint"]["head_before"]["number"] == 2
    assert verb(spark, "verify", *given, "--target", tmp_path / "out") == made
    rows = target_rows(spark, tmp_path / "out")
    point = bytes.fromhex(said["checkpoint"]["head_before"]["hash"])
    assert rows[b"LastBlock"] == point and rows[b"b" + (2).to_bytes(8, "big") + point] == b"\xc2\xc0\xc0"
    with pytest.raises(ValueError, match="inputs are"):
        verb(spark, "verify", *given[:-2], "--target", tmp_path / "out")
    (tmp_path / "alloc").write_text(json.dumps({"0x" + holder(1).hex(): {"nonce": "8"}}))
    with pytest.raises(ValueError, match="does not fit"):
        verb(spark, "verify", *given, "--target", tmp_path / "out")


def test_audits_are_strict(base, tmp_path):
    _, kv, _ = base
    good = audit_of(head_of(kv), bytes([1]) * 32)
    read = lambda data: (tmp_path / "a").write_text(json.dumps(data)) and inputs.read_audit(str(tmp_path / "a"))
    assert read(good) == good and read(good | {"matchesPreviousDiagnosis": True})
    nested = lambda name, **x: good | {name: good[name] | x}
    for bad in (
        good | {"more": 1}, {k: v for k, v in good.items() if k != "totals"}, nested("identity", more=1), nested("identity", to=True), nested("identity", toHash="0x12"), nested("identity", to=-1),
        nested("totals", gasShortfallWei="1"), nested("totals", balanceDeltaWei="1"), nested("targetState", balancesWei="0308"), nested("targetState", balancesWei="309"), good | {"from": 2},
        good | {"executionVerified": False}, good | {"unexplainedEvents": 1}, good | {"clientVersion": ""}, nested("identity", configHash="0x" + "00" * 32), good | {"identity": 5},
    ):
        with pytest.raises(ValueError):
            read(bad)


def test_addresses_are_exact(spark):
    import ipaddress
    import itertools

    parts = ["", "1", "ffff", "0", "12345", "g", "1.2.3.4", "1.2.3.256", "01.2.3.4"]
    texts = {":".join(x) for n in range(1, 6) for x in itertools.product(parts, repeat=n) if n < 5 or x.count("") in (1, 2)}
    texts |= {":".join(["a"] * n) for n in range(1, 10)} | {"::", ":::", "1::2::3", "1:2:3:4:5:6:7::", "1:2:3:4:5:6:7:8::", "::1%eth0", "::1%", "1.2.3.4%x", "fe80::1%a%b", "1:2:3:4:5:6:1.2.3.4", "::ffff:1.2.3.4", "1.2.3", "1.2.3.4.5", " ::1", "::1\n"}

    def valid(text):
        try:
            ipaddress.ip_address(text.split("%", 1)[0] if "%" in text and ":" in text and text.split("%", 1)[1] else text)
        except ValueError:
            return False
        return True

    df = spark.createDataFrame([(t, valid(t)) for t in texts], "t string, want boolean")
    assert df.where(snapshot.is_address(F.col("t")) != F.col("want")).collect() == []


def test_phases_are_told(spark, caplog):
    import logging
    import time

    from ledgerloom.plans.progress import Progress

    progress = Progress(spark, "test", every=0.05)
    with caplog.at_level(logging.INFO, "ledgerloom"), progress.phase("one") as say:
        say["records"] = spark.range(1000).count()
        time.sleep(0.2)
    with pytest.raises(ValueError), progress.phase("two"):
        raise ValueError
    assert [(p["phase"], p["ok"]) for p in progress.phases] == [("one", True), ("two", False)] and progress.phases[0]["per_second"] > 0
    assert any("goes on" in r.getMessage() for r in caplog.records)


def test_scratch_is_removed(spark, tmp_path):
    from ledgerloom.plans import staging

    with pytest.raises(ValueError), staging.scratch(spark):
        paths = [df.inputFiles()[0].rsplit("/", 1)[0] for df in (staging.staged(spark.range(5), "x"), staging.staged_by(spark.range(5), "y", "id"))]
        assert all(staging.exists(spark, p) for p in paths) and staging._NAMED
        name = staging._NAMED[paths[1]] if paths[1] in staging._NAMED else list(staging._NAMED.values())[-1]
        assert spark.catalog.tableExists(name)
        raise ValueError
    assert not any(staging.exists(spark, p) for p in paths) and not spark.catalog.tableExists(name)


def test_foreign_keys(spark):
    code = b"\x60\x01"
    keys = {b"cht-1": 1, b"c" + keccak(code): 1, b"c" + bytes(32): 0, b"A\x01\x0f": 1, b"A\x10": 0, b"O" + bytes(32) + b"\x0e": 1, b"SnapshotRoot": 1, b"\0\1pb:" + bytes(32): 1, b"\0\1nb:10.0.0.1": 1, b"\0\1nb:10.0.0.256": 0, b"\0\1nb:::1": 1, b"\0\2nb:::1": 0, b"LastBlock": 0}
    df = spark.createDataFrame([(bytearray(k), bytearray(keccak(code)), v) for k, v in keys.items()], "key binary, content binary, want int")
    got = df.where(snapshot.foreign_key(F.col("key"), F.col("content")).cast("int") != F.col("want")).collect()
    assert got == []


def test_audit_acceptance():
    from ledgerloom.plans import audit

    data = {"identity": {"to": 5, "toHash": "0xa"}, "targetState": {"root": "0xb", "ovmCodeHash": "0xc", "balanceSlots": 7, "balancesWei": "308", "supplyWei": "300", "differenceWei": "8"}}
    audit.match_head(data, 5, "0xa", "0xb")
    audit.match_head(data, 6, "0xother", "0xother")
    audit.match_accounting(data, audit.Accounting(5, "0xc", 7, 308, 300))
    audit.match_accounting(data, audit.Accounting(9, "0xc", 9, 1008, 1000))
    for bad in (audit.Accounting(5, "0xc", 8, 308, 300), audit.Accounting(9, "0xd", 7, 308, 300), audit.Accounting(9, "0xc", 7, 308, 301), audit.Accounting(4, "0xc", 7, 308, 300)):
        with pytest.raises(ValueError):
            audit.match_accounting(data, bad)
    with pytest.raises(ValueError):
        audit.match_head(data, 5, "0xa", "0xother")
