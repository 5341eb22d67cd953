"""Verbs on a snapshot: traverse, export, import, verify, prune. Each recomputes what it asserts before it publishes."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import rlp
from ledgerloom.functions.keccak import EMPTY_CODE, EMPTY_ROOT, keccak256, keccak_many
from ledgerloom.operators import counts, digests, merge, order, stream
from ledgerloom.plans import history, report, trie
from ledgerloom.plans.staging import appearing, names_in, staged, tasks_for
from ledgerloom.sources import inputs, records

#: Prefixes of the path layout: nodes of the accounts' trie, of storage tries, flat accounts, flat slots; and of code in both layouts.
ACCOUNT_NODE, STORAGE_NODE, FLAT_ACCOUNT, FLAT_SLOT, CODE = b"A", b"O", b"a", b"o", b"c"


def _bin(b: bytes):
    return F.lit(bytearray(b))


def _accounts(batches):
    for batch in batches:
        rows = []
        for key, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a = rlp.full_account(blob)
            rows.append((key, a.nonce, a.balance.to_bytes(32, "big"), a.storage_root, a.code_hash, a.slim(), len(blob)))
        cols = list(zip(*rows, strict=True)) or [[]] * 7
        kinds = (pa.binary(), pa.decimal128(20, 0), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64())
        names = ["account_hash", "nonce", "balance", "storage_root", "code_hash", "slim", "full_bytes"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)


ACCOUNT = "account_hash binary, nonce decimal(20,0), balance binary, storage_root binary, code_hash binary, slim binary, full_bytes long"


def _slots_checked(batches):
    for batch in batches:
        for value in batch.column(2).to_pylist():
            rlp.storage_word(value)
        yield batch


@dataclass
class State:
    accounts: DataFrame
    slots: DataFrame
    code: DataFrame
    nodes: DataFrame

    def counts(self) -> dict:
        none = F.lit(0).cast("long")
        rows = self.accounts.select(F.lit("accounts").alias("of"), F.col("full_bytes").alias("b"), (F.col("code_hash") != _bin(EMPTY_CODE)).cast("long").alias("refs"))
        rows = rows.unionByName(self.slots.select(F.lit("storage_slots").alias("of"), F.octet_length("value").cast("long").alias("b"), none.alias("refs")))
        rows = rows.unionByName(self.code.select(F.lit("code_records").alias("of"), F.octet_length("code").cast("long").alias("b"), none.alias("refs")))
        got = {r.of: r for r in rows.groupBy("of").agg(F.count("*").alias("n"), F.sum("b").alias("b"), F.sum("refs").alias("refs")).collect()}
        n = {k: got[k].n if k in got else 0 for k in ("accounts", "storage_slots", "code_records")}
        refs, size = sum(r.refs for r in got.values()), sum(r.b for r in got.values())
        return n | {"code_references": refs, "records": sum(n.values()), "payload_bytes": size}


def _wanted(batches):
    """(owner, path, hash, kind, value) to its parts: a node's as trie.EXPANDED says, slots checked; code as it is, 'false' if its digest is another."""
    for batch in batches:
        nodes = batch.filter(pc.equal(batch.column(3), "node")).select([0, 1, 2, 4])
        for part in trie._expanded([nodes]):
            for owner, value, kind in zip(part.column(0).to_pylist(), part.column(3).to_pylist(), part.column(4).to_pylist(), strict=True):
                if kind == "leaf" and owner:
                    rlp.storage_word(value)
            yield part
        code = batch.filter(pc.not_equal(batch.column(3), "node"))
        values = code.column(4).to_pylist()
        kinds = ["code" if d == h else "false" for d, h in zip(keccak_many(values), code.column(2).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([*code.columns[:3], code.column(4), pa.array(kinds, pa.string())], names=["owner", "path", "hash", "value", "kind"])


def traverse(kv: DataFrame, root: bytes) -> State:
    """Accounts, slots, code and nodes below a state root, all checked: digests, encodings, and roots built anew.

    Code is looked up behind its prefix first, then bare. Every fault is an error before anything is returned. The
    inventory is read twice: for the links between nodes, by which accounts, their tries and their code are reached, and
    for the values of what was reached.
    """
    spark, table = kv.sparkSession, trie.links(kv)
    own = trie.reach(table, spark.createDataFrame([(bytearray(), "", bytearray(root))] if root != EMPTY_ROOT else [], "owner binary, path string, hash binary"))
    holders = staged(own.select("path", F.explode("accounts").alias("a")).select(F.unhex(F.concat("path", "a.below")).alias("owner"), "a.root", "a.code"), "holders")
    tries = trie.reach(table, trie.top_of(holders))
    reached = own.unionByName(tries).select("owner", "path", "hash", "sound")
    trie.refuse_missing(reached)
    code = holders.where(F.col("code") != _bin(EMPTY_CODE)).select("code").distinct()
    names = F.array(F.struct(F.lit("prefixed").alias("path"), F.concat(_bin(CODE), "code").alias("at")), F.struct(F.lit("bare").alias("path"), F.col("code").alias("at")))
    codes = code.select(F.col("code").alias("hash"), F.explode(names).alias("x")).select(_bin(b"").alias("owner"), "x.path", "hash", F.lit("code").alias("kind"), "x.at")
    wanted = reached.select("owner", "path", "hash", F.lit("node").alias("kind"), F.col("hash").alias("at")).unionByName(codes)
    tasks = tasks_for(spark, reached.count())
    found = wanted.join(kv.select("key", "value"), F.col("at") == F.col("key")).select("owner", "path", "hash", "kind", "value").repartition(tasks, "hash")
    every = staged(found.mapInArrow(_wanted, trie.EXPANDED), "trie-values")
    accounts = staged(every.where("kind = 'leaf' AND octet_length(owner) = 0").select(F.unhex("path").alias("key"), "value").mapInArrow(_accounts, ACCOUNT), "accounts")
    slots = every.where("kind = 'leaf' AND octet_length(owner) > 0").select("owner", F.unhex("path").alias("key"), "value")
    nodes = every.where("kind = 'node'").select("owner", "path", "hash", F.col("value").alias("blob"))
    kinds = every.where("path IN ('prefixed', 'bare')").groupBy("hash").agg(F.max_by(F.struct("value", "kind"), "path").alias("x")).select("hash", "x.*")
    have = staged(code.join(kinds, F.col("code") == F.col("hash"), "left").select(F.col("code").alias("code_hash"), F.col("value").alias("code"), F.coalesce(F.col("kind") == "code", F.lit(False)).alias("ok")), "code")
    if bad := have.where("NOT ok").first():
        raise ValueError(f"code {bytes(bad.code_hash).hex()} is missing or has another digest")
    state = State(accounts, slots, have.drop("ok"), nodes)
    check_roots(state, root)
    return state


def check_roots(state: State, root: bytes) -> None:
    """Builds all roots from the leaves and compares them with those that the accounts and the head name."""
    encoded = state.accounts.select(_bin(b"").alias("owner"), F.col("account_hash").alias("key"), "slim").mapInArrow(_full, "owner binary, key binary, value binary")
    built = trie.trie_roots(state.slots.select("owner", "key", "value").unionByName(encoded)).select(F.col("owner").alias("o"), F.col("root").alias("r"))
    top = state.accounts.sparkSession.createDataFrame([(bytearray(), bytearray(root))], "account_hash binary, storage_root binary")
    want = state.accounts.select("account_hash", "storage_root").unionByName(top).where(F.col("storage_root") != _bin(EMPTY_ROOT))
    off = want.join(built, F.col("account_hash") == F.col("o"), "full_outer").where("account_hash IS NULL OR o IS NULL OR r != storage_root").first()
    if off:
        owner = bytes(off.account_hash if off.account_hash is not None else off.o)
        raise ValueError(f"storage root of {owner.hex()} differs from its slots" if owner else "state root differs from its accounts")


def _full(batches):
    for batch in batches:
        full = [rlp.slim_account(b).full() for b in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(full, pa.binary())], names=["owner", "key", "value"])


def record_stream(state: State) -> DataFrame:
    """seq order: an account, its slots by key, and its code where that is referenced first. account_hash, kind, sub_hash, payload, code_hash."""
    none = F.lit(None).cast("binary")
    a = state.accounts.select("account_hash", F.lit(1).alias("kind"), none.alias("sub_hash"), F.col("slim").alias("payload"), none.alias("code_hash"))
    s = state.slots.select(F.col("owner").alias("account_hash"), F.lit(2).alias("kind"), F.col("key").alias("sub_hash"), F.col("value").alias("payload"), none.alias("code_hash"))
    first = order.first_references(state.accounts.where(F.col("code_hash") != _bin(EMPTY_CODE)).select("account_hash", "code_hash"), "code_hash", ["account_hash"])
    c = first.join(state.code, "code_hash").select("account_hash", F.lit(3).alias("kind"), none.alias("sub_hash"), F.col("code").alias("payload"), "code_hash")
    return a.unionByName(s).unionByName(c)


def export(kv: DataFrame, head: history.Head, folder: str, compression: str = "none", domain: bytes = records.DOMAIN, confirm: Callable | None = None, streams: int = 0) -> records.Evidence:
    """Writes a bundle (manifest.json and the record stream), reads it again and checks it, then publishes the folder.

    A stream is one file with a chained digest, so that the driver writes it, a partition of the sorted records at a
    time. streams: as many streams instead, each a range of accounts, which executors write and verify at once; the
    folder must be a mount of all. confirm() is called last of all, and ends it if the source has changed.
    """
    history.check_head(head)
    state = traverse(kv, head.state_root)
    rows = record_stream(state)
    link = records.first_link(head.number, head.hash, head.state_root, head.header, domain)
    source = {"number": head.number, "block_hash": head.hash.hex(), "state_root": head.state_root.hex(), "header": head.header.hex(), "compression": compression, "chain_domain": domain.hex()}
    found = []

    def write(part: str) -> None:
        if streams:
            made = records.write_streams(rows.withColumnRenamed("kind", "type"), part, link, compression, streams)
            os.unlink(f"{part}/{records.STREAMS}")  # the manifest says it
            found.append(records.together(made))
        else:
            ordered = rows.orderBy("account_hash", "kind", "sub_hash").toLocalIterator(prefetchPartitions=True)
            stream = ((r.kind, bytes(r.code_hash if r.kind == 3 else r.account_hash), bytes(r.sub_hash) if r.kind == 2 else None, bytes(r.payload)) for r in ordered)
            made = records.write_stream(f"{part}/{_stream_name(compression)}", stream, link, compression)
            found.append(made)
        want = state.counts()
        if any(want[k] != getattr(found[0], k) for k in ("accounts", "storage_slots", "code_references", "code_records", "records")):
            raise ValueError("the stream has other counts than the state")
        records.write_manifest(f"{part}/manifest.json", made, **source)
        evidence, _, several = records.read_manifests(f"{part}/manifest.json")
        if streams:
            records.verify_streams(kv.sparkSession, part, several, link, compression, canonical=True)
        else:
            records.verify_stream(f"{part}/{_stream_name(compression)}", evidence, link, compression, canonical=True)
        if confirm:
            confirm()

    inputs.publish(folder, write)
    return found[0]


def _stream_name(compression: str) -> str:
    return "state.records" + (".zst" if compression == "zstd" else "")


def read_bundle(spark: SparkSession, folder: str, domain: bytes | None = None) -> tuple[State, history.Head, dict]:
    """A bundle's state, head and manifest; its order, references, roots and header checked. Nodes are not part of a bundle.

    domain: that of the record chain, where the manifest's is not to be believed. Several streams are verified and read
    by as many tasks, and are in order as if they were one.
    """
    evidence, source, several = records.read_manifests(f"{folder}/manifest.json")
    names = [records.STREAM_NAME.format(number) for number, _ in several] if several is not None else [_stream_name(source["compression"])]
    inputs.exact_layout(folder, {"manifest.json": "file"} | dict.fromkeys(names, "file"))
    head = history.Head(source["number"], *(bytes.fromhex(source[k]) for k in ("block_hash", "state_root", "header")))
    history.check_head(head)
    root, named = head.state_root, bytes.fromhex(source["chain_domain"])
    if domain is not None and named != domain:
        raise ValueError("the record chain is of another domain")
    link = records.first_link(head.number, head.hash, root, head.header, named)
    if several is not None:
        records.verify_streams(spark, folder, several, link, source["compression"], canonical=True)
        before = [sum(e.records for _, e in several[:k]) for k in range(len(several))]
    else:
        records.verify_stream(f"{folder}/{names[0]}", evidence, link, source["compression"], canonical=True)
        before = [0]
    rows = staged(records.read_records(spark, [f"{folder}/{name}" for name in names], source["compression"], before), "records")
    accounts, slots, code = read_state(rows)
    state = State(accounts.drop("seq"), slots.drop("seq"), code.drop("seq"), spark.createDataFrame([], "owner binary, path string, hash binary, blob binary"))
    check_roots(state, root)
    return state, head, {"evidence": evidence, "manifest_sha256": inputs.file_digest(f"{folder}/manifest.json")}


def read_state(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Accounts, slots and code, each with its seq, of records (seq, type, account_hash, sub_hash, payload); an error where one stands that may not.

    What follows what is checked by ranges of the stream. Code has its digest, and comes where it is named first: behind
    the slots of the first account that names it, and there only.
    """
    a = rows.where("type = 1").select(F.col("account_hash").alias("key"), F.col("payload"), "seq")
    accounts = staged(a.mapInArrow(_slim, ACCOUNT + ", seq long"), "accounts")
    slots = rows.where("type = 2").select(F.col("account_hash").alias("owner"), F.col("sub_hash").alias("key"), F.col("payload").alias("value"), "seq")
    code = rows.where("type = 3").select(F.col("account_hash").alias("code_hash"), F.col("payload").alias("code"), "seq")
    own = accounts.select("seq", F.lit(1).alias("type"), "account_hash", F.lit(None).cast("binary").alias("sub_hash"), F.col("code_hash").alias("code"))
    rest = rows.where("type != 1").select("seq", "type", "account_hash", "sub_hash", F.lit(None).cast("binary").alias("code"))
    first = accounts.where(F.col("code_hash") != _bin(EMPTY_CODE)).groupBy("code_hash").agg(F.min(F.struct("seq", "account_hash")).alias("by"))
    sizes = slots.groupBy(F.col("owner").alias("account_hash")).agg(F.count("*").alias("n"))
    due = first.select("code_hash", "by.*").join(sizes, "account_hash", "left").select("code_hash", (F.col("seq") + F.coalesce("n", F.lit(0)) + 1).alias("due"))
    there = code.select("code_hash", F.col("seq").alias("at"), (keccak256(F.col("code")) != F.col("code_hash")).alias("false"))
    place = F.when(F.col("false"), "code has another digest").when(F.col("due").isNull(), "code that no account names").when(F.col("at").isNull(), "code is missing").when(F.col("at") != F.col("due"), "code is not where it is named first")
    faults = stream.first_fault(own.unionByName(rest)).select("fault").unionByName(due.join(there, "code_hash", "full_outer").select(place.alias("fault")).where("fault IS NOT NULL"))
    if bad := faults.first():
        raise ValueError(bad.fault)
    return accounts, slots, code


def _slim(batches):
    for batch in batches:
        rows = []
        for key, blob, seq in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            a = rlp.slim_account(blob)
            rows.append((key, a.nonce, a.balance.to_bytes(32, "big"), a.storage_root, a.code_hash, blob, len(a.full()), seq))
        cols = list(zip(*rows, strict=True)) or [[]] * 8
        kinds = (pa.binary(), pa.decimal128(20, 0), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["account_hash", "nonce", "balance", "storage_root", "code_hash", "slim", "full_bytes", "seq"])


#: What says that a state by path is complete: its root, a finished snapshot, no state history, a finished download.
def completion_marks(root: bytes) -> dict[bytes, bytes]:
    return {b"SnapshotRoot": root, b"SnapshotGenerator": rlp.encode([b"", b"\x01", b"", b"", b"", b""]), b"LastStateID": bytes(8), b"SnapSyncStatus": b"\x02"}


SCHEMES = ("hash", "path")


def metadata(scheme: str, head: history.Head, *more: dict[bytes, bytes]) -> dict[bytes, bytes]:
    """The rows besides the state's that a target has: the head's, those of a path layout, and more; none may be named twice."""
    out: dict = {}
    for rows in (history.head_rows(head), completion_marks(head.state_root) if scheme == "path" else {}, *more):
        if set(out) & set(rows):
            raise ValueError("metadata names a key twice")
        out |= rows
    return out


def layout(state: State, scheme: str) -> DataFrame:
    """key, value, kind of the state in the hash layout (nodes and code by digest) or the path layout (nodes by path, flat leaves)."""
    code = state.code.select(F.concat(_bin(CODE), "code_hash").alias("key"), F.col("code").alias("value"), F.lit("code").alias("kind"))
    if scheme == "hash":
        return state.nodes.dropDuplicates(["hash"]).select(F.col("hash").alias("key"), F.col("blob").alias("value"), F.lit("node").alias("kind")).unionByName(code)
    if scheme != "path":
        raise ValueError(f"unknown layout {scheme!r}")
    path = F.transform(F.sequence(F.lit(1), F.length("path")), lambda i: F.concat(F.lit("0"), F.substring("path", i, 1)))
    path = F.when(F.length("path") > 0, F.unhex(F.array_join(path, ""))).otherwise(_bin(b""))
    own = F.octet_length("owner") == 0
    nodes = state.nodes.select(F.when(own, F.concat(_bin(ACCOUNT_NODE), path)).otherwise(F.concat(_bin(STORAGE_NODE), "owner", path)).alias("key"), F.col("blob").alias("value"), F.when(own, "account node").otherwise("storage node").alias("kind"))
    accounts = state.accounts.select(F.concat(_bin(FLAT_ACCOUNT), "account_hash").alias("key"), F.col("slim").alias("value"), F.lit("account").alias("kind"))
    slots = state.slots.select(F.concat(_bin(FLAT_SLOT), "owner", "key").alias("key"), "value", F.lit("slot").alias("kind"))
    return nodes.unionByName(accounts).unionByName(slots).unionByName(code)


def entry_kind(scheme: str, key: Column, value: Column, known: list[bytes]) -> Column:
    """What a target's entry is by its key; null for what has no place in the layout. Empty code is none."""
    digits, size = F.hex(key), F.octet_length(key)
    kind = F.when(key.isin([bytearray(k) for k in known]), "metadata").when((size == 33) & key.startswith(_bin(CODE)) & (F.octet_length(value) > 0), "code")
    if scheme == "hash":
        return kind.when(size == 32, "node")
    return (
        kind.when((size == 33) & key.startswith(_bin(FLAT_ACCOUNT)), "account").when((size == 65) & key.startswith(_bin(FLAT_SLOT)), "slot")
        .when(digits.rlike("^41(0[0-9A-F]){0,64}$"), "account node").when(digits.rlike("^4F[0-9A-F]{64}(0[0-9A-F]){0,64}$"), "storage node")
    )


def nodes_of(state: State) -> DataFrame:
    """All nodes of the state's tries, built from its leaves; for a state that has none yet. Large tries are dealt by nibbles."""
    full = state.accounts.select(_bin(b"").alias("owner"), F.col("account_hash").alias("key"), "slim").mapInArrow(_full, "owner binary, key binary, value binary")
    return staged(trie.trie_nodes(full.unionByName(state.slots.select("owner", "key", "value"))), "nodes")


def verify_paths(found: DataFrame, root: bytes) -> None:
    """A path layout (key, value, kind) by itself: every node is referred to by the one above, and the flat rows are the tries' leaves."""
    digits = F.lower(F.hex("key"))
    path = lambda begin: F.regexp_replace(F.substring(digits, begin, 1 << 20), "0(.)", "$1")
    own = F.col("kind") == "account node"
    nodes = found.where("kind IN ('account node', 'storage node')").select(F.when(own, _bin(b"")).otherwise(F.substring("key", 2, 32)).alias("owner"), F.when(own, path(3)).otherwise(path(67)).alias("path"), F.col("value").alias("blob"))
    flat = found.where("kind = 'account'").select(F.substring("key", 2, 32).alias("key"), "value")
    accounts = staged(flat.select("key", "value", F.lit(0).cast("long")).mapInArrow(_slim, ACCOUNT + ", seq long"), "flat-accounts")
    top = found.sparkSession.createDataFrame([(bytearray(), bytearray(root))], "owner binary, root binary")
    leaves, faults = trie.linked_by_path(nodes, accounts.select(F.col("account_hash").alias("owner"), F.col("storage_root").alias("root")).unionByName(top))
    if bad := faults.first():
        raise ValueError(f"node at {bytes(bad.owner).hex()}:{bad.path} {'has ' if bad.fault == 'another digest' else 'is '}{bad.fault}")
    full = flat.select(_bin(b"").alias("owner"), "key", "value").mapInArrow(_full, "owner binary, key binary, value binary")
    want = full.unionByName(found.where("kind = 'slot'").select(F.substring("key", 2, 32).alias("owner"), F.substring("key", 34, 32).alias("key"), "value"))
    if bad := merge.inventory_difference(leaves, want).first():
        raise ValueError(f"flat row {bytes(bad.owner).hex()}:{bytes(bad.key).hex()} differs from the tries' leaves")


def verify(spark: SparkSession, target: str, state: State, head: history.Head, scheme: str, *more: dict[bytes, bytes]) -> dict:
    """What lies in the target is what the state and its metadata make, no more and no less, key by key; then counts by kind.

    The state being verified, a target that is equal to it needs no traversal of its own; verify_alone takes one without a state.
    """
    expected = metadata(scheme, head, *more)
    found = spark.read.schema("key binary, value binary").parquet(target)
    found = found.withColumn("kind", entry_kind(scheme, F.col("key"), F.col("value"), list(expected)))
    want = spark.createDataFrame([(bytearray(k), bytearray(v)) for k, v in expected.items()], "key binary, value binary")
    rest = found.where("kind != 'metadata'")
    strange = found.where("kind IS NULL").select(F.lit("is of no kind").alias("fault"), "key")
    marks = merge.expected_once(found, want, "key", "value").where("fault IS NOT NULL").select("fault", "key")
    off = merge.inventory_difference(rest.select("key", "value", "kind"), layout(state, scheme).select("key", "value", "kind")).select(F.concat(F.lit("differs: "), F.col("side").cast("string")).alias("fault"), "key")
    if bad := strange.unionByName(marks).unionByName(off).first():
        raise ValueError(f"target's key {bytes(bad.key).hex()} {bad.fault}")
    rows = counts.inventory(found, F.col("kind"), (F.octet_length("key") + F.octet_length("value")).cast("long")).collect()
    return {r["kind"]: {"keys": r["keys"], "bytes": r["bytes"]} for r in rows}


def verify_alone(rows: DataFrame, root: bytes, scheme: str) -> None:
    """A target's rows (key, value, kind), metadata left out, by themselves: traversed from the root, or linked by path."""
    if scheme == "hash":
        traverse(rows.select("key", "value"), root)
    else:
        verify_paths(rows, root)


#: What an artifact's folder holds.
DATABASE, REPORT = "database", "verification.json"


def write_artifact(state: State, head: history.Head, target: str, scheme: str, said: dict, confirm: Callable | None = None, *more: dict[bytes, bytes]) -> dict:
    """Writes layout, metadata and report beside the target, reads and verifies them, and lets the folder appear as a whole; what fails leaves nothing.

    confirm() is called after all checks: it ends it if the source or an input has changed.
    """
    spark = state.accounts.sparkSession
    extra = spark.createDataFrame([(bytearray(k), bytearray(v)) for k, v in metadata(scheme, head, *more).items()], "key binary, value binary")
    with appearing(spark, target) as part:
        layout(state, scheme).select("key", "value").unionByName(extra).write.parquet(f"{part}/{DATABASE}")
        said = said | {"inventory": verify(spark, f"{part}/{DATABASE}", state, head, scheme, *more)}
        report.write(spark, f"{part}/{REPORT}", said)
        if report.read(spark, f"{part}/{REPORT}") != said:
            raise ValueError("report differs after reading")
        if confirm:
            confirm()
    return said


def read_artifact(spark: SparkSession, target: str, kind: str | None = None) -> dict:
    """The report of an artifact, whose folder has nothing besides it and the database."""
    if names_in(spark, target) - {f".{REPORT}.crc"} != {DATABASE, REPORT}:
        raise ValueError(f"{target} is no artifact")
    found = report.read(spark, f"{target}/{REPORT}")
    if kind and found["format"] != kind:
        raise ValueError(f"artifact is {found['format']}, not {kind}")
    return found


def import_bundle(spark: SparkSession, bundle: str, target: str, scheme: str, domain: bytes | None = None) -> dict:
    """An artifact of a bundle."""
    state, head, of = read_bundle(spark, bundle, domain)
    state.nodes = nodes_of(state)
    return write_artifact(state, head, target, scheme, report.portable(head, scheme, state.counts(), of), lambda: _same(read_head_of_bundle(bundle), of["manifest_sha256"]))


def read_head_of_bundle(bundle: str) -> str:
    return inputs.file_digest(f"{bundle}/manifest.json")


def _same(now, before) -> None:
    if now != before:
        raise ValueError("the source has changed")


def migrate(kv: DataFrame, head: history.Head, target: str, scheme: str, confirm: Callable | None = None) -> dict:
    """An artifact of the head's state, without a bundle."""
    state = traverse(kv, head.state_root)
    return write_artifact(state, head, target, scheme, report.direct(head, scheme, state.counts()), confirm)


def verify_bundle(spark: SparkSession, bundle: str, target: str, domain: bytes | None = None) -> dict:
    """An artifact against the bundle that it was made of."""
    stored = read_artifact(spark, target, report.PORTABLE)
    state, head, of = read_bundle(spark, bundle, domain)
    state.nodes = nodes_of(state)
    return _verified(spark, target, stored, report.portable(head, stored["scheme"], state.counts(), of), state, head)


def verify_direct(kv: DataFrame, head: history.Head, target: str, confirm: Callable | None = None) -> dict:
    """An artifact against the source that it was made of, which is traversed anew."""
    stored = read_artifact(kv.sparkSession, target, report.DIRECT)
    state = traverse(kv, head.state_root)
    if confirm:
        confirm()
    return _verified(kv.sparkSession, target, stored, report.direct(head, stored["scheme"], state.counts()), state, head)


def _verified(spark: SparkSession, target: str, stored: dict, expected: dict, state: State, head: history.Head, *more: dict[bytes, bytes]) -> dict:
    """Report, database and report once more: all must be what is expected, and the report must not have changed meanwhile."""
    expected = expected | {"inventory": stored["inventory"]}
    if not report.same(stored, expected):
        raise ValueError("the artifact's report does not fit the source")
    if verify(spark, f"{target}/{DATABASE}", state, head, stored["scheme"], *more) != stored["inventory"]:
        raise ValueError("the artifact's inventory has other counts than its report")
    rows = spark.read.schema("key binary, value binary").parquet(f"{target}/{DATABASE}")
    known = list(metadata(stored["scheme"], head, *more))
    rows = rows.withColumn("kind", entry_kind(stored["scheme"], F.col("key"), F.col("value"), known)).where("kind != 'metadata'")
    verify_alone(rows, head.state_root, stored["scheme"])
    if read_artifact(spark, target) != stored:
        raise ValueError("the report has changed meanwhile")
    return stored


#: Prefixes of a light client's service records, and the key of a snapshot's root.
SERVICE = ("cumulativeTime:", "_globalCostFactor", "chtIndexV2-", "bltIndex-", "cht-", "blt-", "chtRootV2-", "bltRoot-")
SNAPSHOT_ROOT = "SnapshotRoot"


def is_address(text: Column) -> Column:
    """Whether a text is an IP address: four numbers, or up to eight groups of hex of which one run of noughts may be left out, the last two as four numbers, with a zone."""
    quad = "(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
    four = rf"{quad}([.]{quad}){{3}}"
    groups = F.regexp_replace(F.regexp_replace(text, r"(?s)%.+\z", ""), rf"(?<=:){four}\z", "0:0")
    one = "[0-9a-fA-F]{1,4}"
    short = groups.rlike(rf"\A({one}(:{one})*)?::({one}(:{one})*)?\z") & (F.regexp_count(groups, F.lit("[0-9a-fA-F]+")) <= 7)
    return text.rlike(rf"\A{four}\z") | groups.rlike(rf"\A({one}:){{7}}{one}\z") | short


def foreign_key(key: Column, content: Column) -> Column:
    """Whether a key is of a layout or service that pruning does not know: light clients' records, prefixed code, trie nodes by path.

    All by length, prefix and hex form, so that a scan of the inventory stays in the JVM.
    """
    size, digits = F.octet_length(key), F.hex(key)
    out = (key == F.lit(bytearray(SNAPSHOT_ROOT.encode()))) | ((size == 33) & key.startswith(_bin(CODE)) & (F.substring(key, 2, 32) == content))
    for prefix in SERVICE:
        out = out | key.startswith(_bin(prefix.encode()))
    balance = digits.rlike("^000[01]") & (size > 5)
    rest = F.substring(key, 6, 1 << 20).cast("string")
    address = is_address(rest) | rest.rlike("^[0-9a-fA-F]{64}$")
    out = out | (balance & (F.substring(key, 3, 3) == _bin(b"pb:")) & (size == 37)) | (balance & (F.substring(key, 3, 3) == _bin(b"nb:")) & address)
    by_path = digits.rlike("^41(0[0-9A-F]){0,63}$") | digits.rlike("^4F[0-9A-F]{64}(0[0-9A-F]){0,63}$")
    return out | by_path


def prune(kv: DataFrame, root: bytes, target: str | None = None, genesis_root: bytes | None = None, confirm: Callable | None = None, compact: bool = False) -> dict:
    """Marks what the head's state reaches (and the genesis root's node), sweeps other rows that their own digest keys.

    A dry run without a target. With one, what stays is written to a new folder, verified there (the state is traversed
    again, and the protected rows have the same multiset digest), and only then appears; compact: sorted by key, in
    files of ranges that reads by prefix can skip. Keys of foreign layouts are refused before anything is written. Says
    keys and bytes by role, the state's counts, and the digest of what stays.
    """
    state = traverse(kv, root)
    keep = state.nodes.select(F.col("hash").alias("key"), F.col("blob").alias("value")).unionByName(state.code.select("code_hash", "code").toDF("key", "value"))
    if genesis_root is not None:
        genesis = kv.where(F.col("key") == _bin(genesis_root))
        if genesis.where(keccak256(F.col("value")) == F.col("key")).isEmpty():
            raise ValueError("the genesis root's node is missing or has another digest")
        keep = keep.unionByName(genesis)
    keep = keep.dropDuplicates(["key"])
    rows = staged(merge.ordered_diff(kv.withColumn("content", keccak256(F.col("value"))), keep, "key", "value", F.octet_length("key") == 32, F.col("content") == F.col("key")), "prune-roles")
    foreign = rows.where(~F.col("role").isin("delete", "retain") & foreign_key(F.col("key"), F.col("content"))).select("key", F.lit("is of another layout").alias("fault"))
    if bad := foreign.unionByName(rows.where(F.col("role").isin("missing", "conflict")).select("key", F.concat(F.lit("is to be kept: "), F.col("role")).alias("fault"))).first():
        raise ValueError(f"key {bytes(bad.key).hex()} {bad.fault}")
    totals = counts.role_totals(rows, (F.octet_length("key") + F.octet_length("value")).cast("long")).first().asDict()
    left = rows.where("role != 'delete'").select("key", "value")
    digest = digests.multiset_digest(left, F.col("key"), F.col("value"))
    if target is not None:
        with appearing(kv.sparkSession, target) as part:
            (left.repartitionByRange("key").sortWithinPartitions("key") if compact else left).write.parquet(part)
            after = kv.sparkSession.read.schema("key binary, value binary").parquet(part)
            traverse(after, root)
            if digests.multiset_digest(after, F.col("key"), F.col("value")) != digest:
                raise ValueError("protected rows have changed")
            if confirm:
                confirm()
    return totals | {"state_counts": state.counts(), "protected_digest": digest.hex()}
