"""Conversion of a token's balances into native ones: every slot has one owner, every unit one place."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import rlp, u256
from ledgerloom.functions.codec import pad32
from ledgerloom.functions.keccak import EMPTY_CODE, EMPTY_ROOT, keccak, keccak256
from ledgerloom.operators import counts, merge
from ledgerloom.plans import history, patching, trie
from ledgerloom.plans.snapshot import ACCOUNT, State, _accounts, _bin
from ledgerloom.plans.staging import staged


@dataclass
class Balances:
    original_supply: int
    migrated_native: int
    remaining_supply: int
    eoa_holders: int
    converted_contract_holders: int
    retained_contract_holders: int
    self_balance: int


def pieces(events: DataFrame, preimages: DataFrame, witness: DataFrame, token: bytes, extra: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(addresses, allowances, senders): the union of what preimages, history, witnesses and lists name.

    A transfer of nothing names its ends, but does not make its source a sender.
    """
    approval = F.col("topic") == F.lit(bytearray(history.APPROVAL))
    allow = events.where(approval).select(F.col("source").alias("owner"), F.col("target").alias("spender")).union(witness.where("type = 'allowance'").select("owner", "spender")).distinct()
    every = [events.select("source"), events.select("target"), preimages.select("address"), witness.where("type = 'address'").select("address"), allow.select("owner"), allow.select("spender")]
    out = events.sparkSession.createDataFrame([(bytearray(token),)], "address binary")
    for part in every + ([extra.select("address")] if extra is not None else []):
        out = out.union(part)
    senders = events.where((F.col("topic") == F.lit(bytearray(history.TRANSFER))) & (F.col("data") != F.lit(bytearray(32)))).select(F.col("source").alias("address")).distinct()
    return out.distinct(), allow, senders


def preimages(kv: DataFrame, prefix: bytes = b"secure-key-") -> DataFrame:
    """Addresses among the preimages; a key that is not its value's digest is an error."""
    rows = kv.where(F.col("key").startswith(_bin(prefix)) & (F.octet_length("key") == len(prefix) + 32))
    rows = staged(rows.withColumn("ok", keccak256(F.col("value")) == F.substring("key", len(prefix) + 1, 32)), "preimages")
    if bad := rows.where("NOT ok").first():
        raise ValueError(f"preimage {bytes(bad.key).hex()} has another digest")
    return rows.where(F.octet_length("value") == 20).select(F.col("value").alias("address"))


def metadata_slots(word_of) -> list[bytes]:
    """Digests of the slots 2 to 6 and of those that the strings at 3 and 4 go on in. word_of: slot to its 32 bytes."""
    out = []
    for n in range(7):
        slot = n.to_bytes(32, "big")
        if n < 2:
            if any(word_of(keccak(slot))):
                raise ValueError("slot of a mapping's base is not empty")
            continue
        out.append(keccak(slot))
        if n in (3, 4):
            out += [keccak(s) for s in u256.string_slots(n, word_of(keccak(slot)))]
    return out


def _words(batches):
    for batch in batches:
        words = [rlp.storage_word(v).to_bytes(32, "big") for v in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.binary())], names=["key", "word"])


def _patched(batches):
    for batch in batches:
        rows = []
        for key, nonce, balance, root, code in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
            rows.append((key, rlp.Account(int(nonce), int.from_bytes(balance, "big"), root, code).full()))
        cols = list(zip(*rows, strict=True)) or [[], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.binary())], names=["key", "value"])


def accounts_patched(state: State, patches: DataFrame) -> State:
    """Accounts with the fields that patches (account_hash, nonce, balance, storage_root, code_hash) set; new ones begin empty."""
    fields = ["nonce", "balance", "storage_root", "code_hash"]
    out = merge.patch_fields(state.accounts, patches, "account_hash", fields, {"nonce": 0, "balance": bytearray(32), "storage_root": bytearray(EMPTY_ROOT), "code_hash": bytearray(EMPTY_CODE)})
    full = out.select("account_hash", *fields).mapInArrow(_patched, "key binary, value binary")
    return State(staged(full.mapInArrow(_accounts, ACCOUNT), "accounts"), state.slots, state.code, state.nodes)


def patched_slots(state: State, slots: DataFrame) -> DataFrame:
    """The changes of the state's storage tries under slots (owner, key, value; null deletes)."""
    return staged(patching.changes(state.nodes, slots), "storage-changes")


def follow_nodes(state: State, out: State, storage: DataFrame, touched: DataFrame) -> bytes:
    """Gives `out` the nodes of `state` after the changes of storage tries and those of the accounts touched (account_hash), and says its root."""
    accounts = out.accounts.join(touched.select("account_hash"), "account_hash", "left_semi").select("account_hash", "nonce", "balance", "storage_root", "code_hash")
    full = accounts.mapInArrow(_patched, "key binary, value binary").select(_bin(b"").alias("owner"), "key", "value")
    changed = storage.unionByName(staged(patching.changes(state.nodes, full), "account-changes"))
    out.nodes = staged(patching.patched_nodes(state.nodes, changed), "patched-state")
    row = out.nodes.where("octet_length(owner) = 0 AND path = ''").first()
    return bytes(row.hash) if row else EMPTY_ROOT


def state_root(state: State) -> bytes:
    full = state.accounts.select("account_hash", "nonce", "balance", "storage_root", "code_hash").mapInArrow(_patched, "key binary, value binary")
    row = trie.trie_roots(full.withColumn("owner", _bin(b""))).first()
    return bytes(row.root) if row else EMPTY_ROOT


def convert(state: State, token: bytes, addresses: DataFrame, allowances: DataFrame, senders: DataFrame, new_code: bytes, retained: DataFrame | None = None) -> tuple[State, bytes, Balances]:
    """The state after conversion, its root, and where all balances went.

    Holders without code convert; contracts that have sent, or are listed, keep their token balance; the token's own
    stays. A slot that no relation or more than one owns, a native balance before conversion, or a sum that is not the
    supply ends it.
    """
    spark = state.accounts.sparkSession
    own = keccak(token)
    account = state.accounts.where(F.col("account_hash") == _bin(own)).first()
    if account is None or bytes(account.code_hash) == EMPTY_CODE:
        raise ValueError("token contract is missing or has no code")
    if retained is not None:
        listed = retained.withColumn("account_hash", keccak256(F.col("address"))).join(state.accounts, "account_hash", "left")
        if bad := listed.where(F.col("code_hash").isNull() | (F.col("code_hash") == _bin(EMPTY_CODE))).first():
            raise ValueError(f"listed address {bytes(bad.address).hex()} is no contract")
    slots = staged(state.slots.where(F.col("owner") == _bin(own)).select("key", "value").mapInArrow(_words, "key binary, word binary"), "token-slots")

    def word_of(key: bytes) -> bytes:
        row = slots.where(F.col("key") == _bin(key)).first()
        return bytes(row.word) if row else bytes(32)

    supply = int.from_bytes(word_of(keccak((2).to_bytes(32, "big"))), "big")
    zero, one = _bin(bytes(32)), _bin((1).to_bytes(32, "big"))
    b = addresses.select("address", keccak256(keccak256(F.concat(pad32(F.col("address")), zero))).alias("key"))
    inner = keccak256(F.concat(pad32(F.col("owner")), one))
    a = allowances.select("owner", "spender", inner.alias("inner")).select(keccak256(keccak256(F.concat(pad32(F.col("spender")), F.col("inner")))).alias("key"))
    k = spark.createDataFrame([(bytearray(x),) for x in metadata_slots(word_of)], "key binary")
    b = staged(b, "balance-slots")
    owned = staged(merge.owners(slots, "key", balance=b, allowance=staged(a, "allowance-slots"), metadata=k), "slot-owners")
    if bad := owned.where("owner IN ('unknown', 'ambiguous')").first():
        raise ValueError(f"slot {bytes(bad.key).hex()} has an {bad.owner} owner")
    held = owned.where("owner = 'balance'").join(b, "key").withColumn("account_hash", keccak256(F.col("address")))
    held = held.join(state.accounts.select("account_hash", "nonce", "balance", "storage_root", "code_hash"), "account_hash", "left")
    sent = senders if retained is None else senders.union(retained.select("address")).distinct()
    sent = sent.select("address", F.lit(True).alias("sent"))
    held = held.join(sent, "address", "left")
    empty = F.col("word") == zero
    is_own = F.col("address") == _bin(token)
    contract = F.coalesce(F.col("code_hash") != _bin(EMPTY_CODE), F.lit(False))
    cls = counts.classified(held.withColumn("nothing", empty.cast("int") - 1), "nothing", is_own, contract, F.coalesce("sent", F.lit(False))).drop("nothing")
    cls = staged(cls, "classes")
    if bad := cls.where(~F.col("class").isin("zero", "self") & (F.coalesce("balance", zero) != zero)).first():
        raise ValueError(f"{bytes(bad.address).hex()} has a native balance before conversion")
    of = lambda *names: u256.total(cls, F.col("word"), F.col("class").isin(*names))
    n = {r["class"]: r["count"] for r in cls.groupBy("class").count().collect()}
    got = Balances(supply, of("eoa", "converted"), of("self", "retained"), n.get("eoa", 0), n.get("converted", 0), n.get("retained", 0), of("self"))
    if u256.total(cls, F.col("word")) != supply or got.migrated_native + got.remaining_supply != supply:
        raise ValueError("balances do not add up to the supply")
    gone = cls.where(F.col("class").isin("eoa", "converted")).select("key", "account_hash", "word")
    rest = state.slots.where(F.col("owner") == _bin(own)).join(gone.select("key"), "key", "left_anti").select("owner", "key", "value")
    other = state.slots.where(F.col("owner") != _bin(own)).select("owner", "key", "value")
    changed = patched_slots(state, gone.select(_bin(own).alias("owner"), "key", F.lit(None).cast("binary").alias("value")).unionByName(spark.createDataFrame([], "owner binary, key binary, value binary")))
    root = bytes(account.storage_root) if gone.isEmpty() else bytes(patching.patched_roots(changed, gone.select(_bin(own).alias("owner"))).first().root)
    none = F.lit(None)
    patch = gone.select("account_hash", none.cast("decimal(20,0)").alias("nonce"), F.col("word").alias("balance"), none.cast("binary").alias("storage_root"), none.cast("binary").alias("code_hash"))
    mine = spark.createDataFrame([(bytearray(own), None, bytearray(got.remaining_supply.to_bytes(32, "big")), bytearray(root), bytearray(keccak(new_code)))], patch.schema)
    code = state.code.select("code_hash", "code").unionByName(spark.createDataFrame([(bytearray(keccak(new_code)), bytearray(new_code))], "code_hash binary, code binary")).dropDuplicates(["code_hash"])
    fields = staged(patch.unionByName(mine), "converted-accounts")
    out = accounts_patched(State(state.accounts, other.unionByName(rest), code, state.nodes), fields)
    out.code = code.join(out.accounts, "code_hash", "left_semi")
    return out, follow_nodes(state, out, changed, fields), got


def checkpoint(header: bytes, root: bytes, extra: bytes = b"") -> bytes:
    """The header of an empty block after `header`, a second later, with another state root; extra names the tool that made it."""
    f = rlp.decode(header)
    parent, number, time = keccak(header), rlp.number(f[8], 64) + 1, rlp.number(f[11], 64) + 1
    if number >> 64 or time >> 64:
        raise OverflowError("number or time does not fit 64 bits")
    empty_list = keccak(b"\xc0")
    return rlp.encode([parent, empty_list, f[2], root, EMPTY_ROOT, EMPTY_ROOT, bytes(256), f[7], number, f[9], b"", time, extra, bytes(32), bytes(8)])


def overlay_alloc(state: State, alloc: DataFrame) -> tuple[State, bytes]:
    """State and root after the balances, nonces, code and storage of alloc (sources.inputs.read_alloc) are laid over it.

    A word of nought deletes its slot; what a patch does not name stays.
    """
    a = staged(alloc.withColumn("account_hash", keccak256(F.col("address"))).withColumn("code_hash", keccak256(F.col("code"))), "alloc")
    words = a.select(F.col("account_hash").alias("owner"), F.explode("storage").alias("s")).select("owner", keccak256(F.col("s.slot")).alias("key"), F.col("s.word").alias("word"))
    patch = words.mapInArrow(_encoded, "owner binary, key binary, value binary, gone boolean")
    both = F.concat("owner", "key")
    slots = merge.overlay(state.slots.withColumn("id", both), patch.withColumn("id", both), "id", "value", F.col("gone"))
    slots = staged(slots.select(F.substring("id", 1, 32).alias("owner"), F.substring("id", 33, 32).alias("key"), "value"), "slots")
    changed = patched_slots(state, patch.select("owner", "key", F.when(~F.col("gone"), F.col("value")).alias("value")))
    roots = patching.patched_roots(changed, words).select(F.col("owner").alias("account_hash"), F.col("root").alias("storage_root"))
    fields = a.join(roots, "account_hash", "left").select("account_hash", "nonce", "balance", "storage_root", "code_hash")
    code = state.code.select("code_hash", "code").unionByName(a.where(F.octet_length("code") > 0).select("code_hash", "code")).dropDuplicates(["code_hash"])
    out = accounts_patched(State(state.accounts, slots, code, state.nodes), fields)
    out.code = code.join(out.accounts, "code_hash", "left_semi")
    return out, follow_nodes(state, out, changed, fields)


def _encoded(batches):
    for batch in batches:
        numbers = [int.from_bytes(w, "big") for w in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([rlp.encode(n) for n in numbers], pa.binary()), pa.array([n == 0 for n in numbers])], names=["owner", "key", "value", "gone"])
