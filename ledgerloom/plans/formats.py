"""Queries that go through the byte formats: records, accounts, tries, artifacts, operators' files. Their SQL says the same from the tables.

suppliers stand for accounts, their lines by number for storage, nations for code.
"""

from __future__ import annotations

import json
import os
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import codec, rlp, u256
from ledgerloom.functions.keccak import EMPTY_CODE, EMPTY_LIST, EMPTY_ROOT, keccak, keccak256
from ledgerloom.operators import merge, order
from ledgerloom.plans import convert, history, patching, snapshot, sql, trie
from ledgerloom.plans.queries import cents, query, read
from ledgerloom.plans.staging import by_slices, scratch, shared_dir, staged, tasks_for
from ledgerloom.sources import freezer, inputs, records

def own_folder(spark, name: str) -> str:
    """A new path in the shared folder, for the formats that are read as plain files: the folder must be a mount."""
    base = shared_dir(spark).removeprefix("file://").removeprefix("file:")
    if "://" in base:
        raise ValueError(f"bundles, history and operators' files are plain files, which {base} has not")
    at = f"{base}/{name}-{uuid.uuid4().hex}"
    os.makedirs(at)
    return at


def encoded(n):
    """A number from 128 to below 2^63, encoded."""
    digits = F.hex(n)
    digits = F.when(F.length(digits) % 2 == 1, F.concat(F.lit("0"), digits)).otherwise(digits)
    return F.unhex(F.concat(F.hex((F.length(digits) / 2 + 128).cast("long")), digits))


def state_of(spark, sf_dir) -> snapshot.State:
    lines = read(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_linenumber").agg(F.sum(cents(F.col("l_extendedprice"))).alias("amount"))
    slots = staged(lines.select(keccak256(codec.u64_be(F.col("l_suppkey"))).alias("owner"), keccak256(codec.u64_be(F.col("l_linenumber"))).alias("key"), encoded(F.col("amount")).alias("value")), "format-slots")
    code = read(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").cast("binary").alias("code")).withColumn("code_hash", keccak256(F.col("code")))
    s = read(spark, sf_dir, "supplier").select(keccak256(codec.u64_be(F.col("s_suppkey"))).alias("account_hash"), F.col("s_suppkey").cast("decimal(20,0)").alias("nonce"), codec.pad32(codec.u64_be(F.abs(cents(F.col("s_acctbal"))))).alias("balance"), "s_nationkey")
    roots = trie.trie_roots(slots).select(F.col("owner").alias("account_hash"), F.col("root").alias("storage_root"))
    fields = s.join(code.withColumnRenamed("n_nationkey", "s_nationkey"), "s_nationkey").join(roots, "account_hash", "left")
    fields = fields.select("account_hash", "nonce", "balance", F.coalesce("storage_root", F.lit(bytearray(EMPTY_ROOT))).alias("storage_root"), "code_hash")
    accounts = staged(fields.mapInArrow(convert._patched, "key binary, value binary").mapInArrow(snapshot._accounts, snapshot.ACCOUNT), "format-accounts")
    state = snapshot.State(accounts, slots, code.join(accounts, "code_hash", "left_semi").select("code_hash", "code"), None)
    state.nodes = snapshot.nodes_of(state)
    return state


def source_of(spark, sf_dir) -> tuple[snapshot.State, DataFrame, history.Head]:
    """The state, its inventory in the hash layout with a head of number 1, and the head."""
    state = state_of(spark, sf_dir)
    root = convert.state_root(state)
    header = rlp.encode([bytes(32), EMPTY_LIST, bytes(20), root, EMPTY_ROOT, EMPTY_ROOT, bytes(256), 1, 1, 1 << 24, 0, 1, b"", bytes(32), bytes(8)])
    head = history.Head(1, keccak(header), root, header)
    marks = spark.createDataFrame([(bytearray(k), bytearray(v)) for k, v in history.head_rows(head).items()], "key binary, value binary")
    return state, staged(snapshot.layout(state, "hash").select("key", "value").unionByName(marks), "format-kv"), head


#: Rows of an inventory for which an export has a stream.
STREAMED = 1 << 14


def streams_of(spark, kv: DataFrame) -> int:
    """As many streams as keep each about as long, whatever the state: a stream is a chain, which one task follows."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), kv.count() // STREAMED + 1)


COUNTS = """SELECT (SELECT count(*) FROM supplier) AS accounts, (SELECT count(*) FROM (SELECT DISTINCT l_suppkey, l_linenumber FROM lineitem)) AS storage_slots,
  (SELECT count(*) FROM supplier) AS code_references, (SELECT count(DISTINCT s_nationkey) FROM supplier) AS code_records"""


@query(f"WITH c AS ({COUNTS}) SELECT *, accounts + storage_slots + code_records AS records FROM c")
def bundle_counts(spark, sf_dir):
    """The state exported as a packed bundle of several streams, read again and checked: order, references, digests, chain, roots, header."""
    _, kv, head = source_of(spark, sf_dir)
    at = own_folder(spark, "bundle")
    snapshot.export(kv, head, f"{at}/bundle", "zstd", streams=streams_of(spark, kv))
    state, again, _ = snapshot.read_bundle(spark, f"{at}/bundle")
    found = state.counts() | {"records": sum(state.counts()[k] for k in ("accounts", "storage_slots", "code_records"))}
    names = ("accounts", "storage_slots", "code_references", "code_records", "records")
    return spark.createDataFrame([tuple(found[k] for k in names)], ", ".join(f"{k} long" for k in names)).where(F.lit(again == head))


_OWNER, _SLOT = (sql.keccak(f"lpad(lower(to_base({x}, 16)), 16, '0')") for x in ("l_suppkey", "l_linenumber"))
_HOLDER, _CODE = sql.keccak("lpad(lower(to_base(s_suppkey, 16)), 16, '0')"), sql.keccak("lower(hex(encode(n_name)))")


@query(f"""WITH RECURSIVE lines AS (SELECT l_suppkey, l_linenumber, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS amount FROM lineitem GROUP BY ALL),
leaves AS (SELECT {_OWNER} AS owner, {_SLOT} AS key, {sql.rlp_text(sql.digits_of("amount"))} AS value FROM lines),{sql.trie_roots("leaves")},
code AS (SELECT n_nationkey, lower(hex(encode(n_name))) AS payload, {_CODE} AS hash FROM nation),
holders AS (SELECT {_HOLDER} AS owner, s_suppkey, abs(CAST(round(s_acctbal * 100) AS BIGINT)) AS balance, hash FROM supplier JOIN code ON n_nationkey = s_nationkey)
SELECT 1 AS type, owner AS key, '' AS sub, {sql.rlp_list(sql.rlp_text(sql.digits_of("s_suppkey")), sql.rlp_text(sql.digits_of("balance")), sql.rlp_text("coalesce(root, '')"), sql.rlp_text("hash"))} AS payload FROM holders LEFT JOIN roots USING (owner)
UNION ALL SELECT 2, owner, key, value FROM leaves
UNION ALL SELECT 3, hash, '', payload FROM code WHERE hash IN (SELECT hash FROM holders)""")
def bundle_records(spark, sf_dir):
    """The state exported as a packed bundle of several streams, verified and read again: every record by its value."""
    _, kv, head = source_of(spark, sf_dir)
    at = own_folder(spark, "bundle")
    snapshot.export(kv, head, f"{at}/bundle", "zstd", streams=streams_of(spark, kv))
    state, _, _ = snapshot.read_bundle(spark, f"{at}/bundle")
    rows = state.accounts.select(F.lit(1).alias("type"), F.col("account_hash").alias("key"), F.lit(None).cast("binary").alias("sub"), F.col("slim").alias("payload"))
    rows = rows.unionByName(state.slots.select(F.lit(2).alias("type"), F.col("owner").alias("key"), F.col("key").alias("sub"), F.col("value").alias("payload")))
    rows = rows.unionByName(state.code.select(F.lit(3).alias("type"), F.col("code_hash").alias("key"), F.lit(None).cast("binary").alias("sub"), F.col("code").alias("payload")))
    text = lambda c: F.coalesce(F.lower(F.hex(c)), F.lit("")).alias(c)
    return rows.select("type", text("key"), text("sub"), text("payload"))


@query(f"WITH c AS ({COUNTS}) SELECT 'code' AS kind, code_records AS keys FROM c UNION ALL SELECT 'metadata', 5")
def artifact_inventory(spark, sf_dir):
    """An artifact in the hash layout, written, verified and published, then verified against its source once more; nodes, which SQL does not count, left out."""
    _, kv, head = source_of(spark, sf_dir)
    target = f"{own_folder(spark, 'artifact')}/out"
    made = snapshot.migrate(kv, head, target, "hash")
    found = snapshot.verify_direct(kv, head, target)["inventory"]
    return spark.createDataFrame([(k, found[k]["keys"]) for k in ("code", "metadata")], "kind string, keys long").where(F.lit(found == made["inventory"]))


@query(f"""WITH c AS ({COUNTS}) SELECT 'account' AS kind, accounts AS keys, 33 * accounts AS key_bytes FROM c UNION ALL SELECT 'slot', storage_slots, 65 * storage_slots FROM c UNION ALL SELECT 'code', code_records, 33 * code_records FROM c UNION ALL SELECT 'metadata', 9, 157""")
def path_entries(spark, sf_dir):
    """The path layout: its entries told by their keys, its nodes linked by path, flat rows held against the tries' leaves."""
    state, _, head = source_of(spark, sf_dir)
    marks = snapshot.metadata("path", head)
    rows = snapshot.layout(state, "path").select("key", "value").unionByName(spark.createDataFrame([(bytearray(k), bytearray(v)) for k, v in marks.items()], "key binary, value binary"))
    rows = staged(rows.withColumn("kind", snapshot.entry_kind("path", F.col("key"), F.col("value"), list(marks))), "format-path")
    snapshot.verify_paths(rows.where("kind != 'metadata'"), head.state_root)
    return rows.where("kind IS NULL OR kind NOT LIKE '%node'").groupBy("kind").agg(F.count("*").alias("keys"), F.sum(F.octet_length("key")).cast("long").alias("key_bytes"))


@query("SELECT count(*) AS candidates_keys, CAST(sum(length(t)) + 32 * count(*) AS BIGINT) AS candidates_bytes, (SELECT count(*) FROM region) AS unknown_keys FROM (SELECT DISTINCT 'old ' || p_partkey AS t FROM part)")
def prune_sweep(spark, sf_dir):
    """Obsolete rows that their digests key are swept, rows of 32 bytes that nothing explains are counted, the state stays."""
    _, kv, head = source_of(spark, sf_dir)
    old = read(spark, sf_dir, "part").select(F.concat(F.lit("old "), F.col("p_partkey").cast("string")).cast("binary").alias("value")).distinct().select(keccak256(F.col("value")).alias("key"), "value")
    odd = read(spark, sf_dir, "region").select(F.unhex(F.sha2(F.col("r_name").cast("binary"), 256)).alias("key"), F.col("r_name").cast("binary").alias("value"))
    plain = kv.withColumn("key", F.when(F.octet_length("key") == 33, F.when(F.col("key").startswith(F.lit(bytearray(b"c"))), F.substring("key", 2, 32)).otherwise(F.col("key"))).otherwise(F.col("key")))
    target = f"{own_folder(spark, 'pruned')}/out"
    found = snapshot.prune(plain.unionByName(old).unionByName(odd), head.state_root, target)
    left = spark.read.parquet(target).count()
    names = ("candidates_keys", "candidates_bytes", "unknown_keys")
    return spark.createDataFrame([tuple(found[k] for k in names)], ", ".join(f"{k} long" for k in names)).where(F.lit(left == found["protected_keys"]))


@query("""WITH s AS (SELECT l_suppkey, l_partkey, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS amount FROM lineitem GROUP BY ALL)
SELECT l_suppkey, count(*) AS slots, CAST(sum(amount) AS BIGINT) AS amount FROM s GROUP BY l_suppkey""")
def trie_scan(spark, sf_dir):
    """Every supplier's storage trie, built by nibbles and scanned again from its root: leaves decoded and summed."""

    def scanned(part, _):
        lines = part.groupBy("l_suppkey", "l_partkey").agg(F.sum("amount").alias("amount"))
        with scratch(spark):
            leaves = staged(lines.select(codec.u64_be(F.col("l_suppkey")).alias("owner"), keccak256(codec.u64_be(F.col("l_partkey"))).alias("key"), encoded(F.col("amount")).alias("value")), "trie-scan")
            nodes = trie.trie_nodes(leaves, large=256)
            kv = staged(nodes.select(F.col("hash").alias("key"), F.col("blob").alias("value")).dropDuplicates(["key"]), "trie-scan-kv", keep=True)
            roots = staged(nodes.where("path = ''").select("owner", F.col("hash").alias("root")), "trie-scan-roots", keep=True)
        found, _ = trie.scan(kv, roots)
        value = codec.u64_from_be(F.substring("value", 2, 32)).cast("long")
        return found.groupBy(codec.u64_from_be(F.col("owner")).cast("long").alias("l_suppkey")).agg(F.count("*").alias("slots"), F.sum(value).alias("amount"))

    lines = read(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", cents(F.col("l_extendedprice")).alias("amount"))
    return by_slices(lines, "l_suppkey", "trie-scanned", scanned)


_PATCH_KEY = sql.keccak("sha256(l_orderkey || ':' || l_linenumber)")
_FRESH_KEY = sql.keccak("sha256('new:' || s_suppkey)")
_NINE = lambda n: f"'88' || lpad(lower(to_base({n}, 16)), 16, '0')"


@query(f"""WITH RECURSIVE lines AS (SELECT l_suppkey, l_orderkey, l_linenumber, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS amount FROM lineitem GROUP BY ALL),
leaves AS (SELECT l_suppkey AS owner, {_PATCH_KEY} AS key, {_NINE("CASE WHEN l_orderkey % 10 = 1 THEN amount + 1 ELSE amount END")} AS value FROM lines WHERE l_orderkey % 10 <> 0 AND l_suppkey % 4 <> 3
  UNION ALL SELECT s_suppkey, {_FRESH_KEY}, {_NINE("s_suppkey + 1")} FROM supplier),{sql.trie_roots("leaves")}
SELECT owner AS l_suppkey, root FROM roots""")
def patched_trie_roots(spark, sf_dir):
    """Suppliers' storage tries, built once and then patched: lines of some orders deleted, of others changed, of some suppliers all deleted, and a slot more for each. Only nodes on the paths are read."""
    key = lambda text: keccak256(F.unhex(F.sha2(text.cast("binary"), 256)))
    nine = lambda n: F.concat(F.unhex(F.lit("88")), codec.u64_be(n))

    def patched(part, mine):
        lines = part.groupBy("l_suppkey", "l_orderkey", "l_linenumber").agg(F.sum("amount").alias("amount"))
        own = key(F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")))
        base = staged(lines.select(codec.u64_be(F.col("l_suppkey")).alias("owner"), own.alias("key"), "l_suppkey", "l_orderkey", "amount"), "patch-base")
        nodes = trie.trie_nodes(base.select("owner", "key", nine(F.col("amount")).alias("value")), large=4096)
        gone = (F.col("l_orderkey") % 10 == 0) | (F.col("l_suppkey") % 4 == 3)
        patch = base.where(gone | (F.col("l_orderkey") % 10 == 1)).select("owner", "key", F.when(~gone, nine(F.col("amount") + 1)).alias("value"))
        fresh = mine(read(spark, sf_dir, "supplier"), "s_suppkey").select(codec.u64_be(F.col("s_suppkey")).alias("owner"), key(F.concat(F.lit("new:"), F.col("s_suppkey").cast("string"))).alias("key"), nine(F.col("s_suppkey") + 1).alias("value"))
        patch = staged(patch.unionByName(fresh), "patch-rows")  # read more than once, and its keys are digests
        return patching.patched_roots(patching.changes(nodes, patch), patch)

    lines = read(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", cents(F.col("l_extendedprice")).alias("amount"))
    roots = by_slices(lines, "l_suppkey", "patched-roots", patched)
    return roots.select(codec.u64_from_be(F.col("owner")).cast("long").alias("l_suppkey"), F.lower(F.hex("root")).alias("root"))


ACCOUNT_SQL = f"""WITH a AS (SELECT c_custkey, abs(CAST(round(c_acctbal * 100) AS BIGINT)) AS balance,
  CASE WHEN c_custkey % 3 = 0 THEN sha256(CAST(c_custkey AS VARCHAR)) ELSE '' END AS root, CASE WHEN c_custkey % 4 = 1 THEN sha256(c_name) ELSE '' END AS code FROM customer),
b AS (SELECT c_custkey, balance, root, code, {sql.rlp_text(sql.digits_of("c_custkey"))} AS n, {sql.rlp_text(sql.digits_of("balance"))} AS m FROM a)
SELECT c_custkey, c_custkey AS nonce, balance, root <> '' AS has_storage, code <> '' AS has_code, {sql.rlp_list("n", "m", sql.rlp_text("root"), sql.rlp_text("code"))} AS slim,
  {sql.rlp_list("n", "m", sql.rlp_text(f"CASE WHEN root = '' THEN '{EMPTY_ROOT.hex()}' ELSE root END"), sql.rlp_text(f"CASE WHEN code = '' THEN '{EMPTY_CODE.hex()}' ELSE code END"))} AS full FROM b"""


@query(ACCOUNT_SQL)
def account_codec(spark, sf_dir):
    """Accounts in the slim and the full form; the fields are those that each form decodes to."""
    c = F.col("c_custkey").cast("string").cast("binary")
    rows = read(spark, sf_dir, "customer").select("c_custkey", F.abs(cents(F.col("c_acctbal"))).alias("balance"), F.when(F.col("c_custkey") % 3 == 0, F.unhex(F.sha2(c, 256))).alias("root"), F.when(F.col("c_custkey") % 4 == 1, F.unhex(F.sha2(F.col("c_name").cast("binary"), 256))).alias("code"))

    def through(batches):
        for b in batches:
            out = []
            for key, balance, root, code in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                a = rlp.Account(key, balance, root or EMPTY_ROOT, code or EMPTY_CODE)
                x, y = rlp.slim_account(a.slim()), rlp.full_account(a.full())
                if x != y:
                    raise ValueError("forms of an account differ")
                out.append({"c_custkey": key, "nonce": x.nonce, "balance": x.balance, "has_storage": x.storage_root != EMPTY_ROOT, "has_code": x.code_hash != EMPTY_CODE, "slim": a.slim().hex(), "full": a.full().hex()})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("c_custkey", pa.int64()), ("nonce", pa.int64()), ("balance", pa.int64()), ("has_storage", pa.bool_()), ("has_code", pa.bool_()), ("slim", pa.string()), ("full", pa.string())]))

    return rows.mapInArrow(through, "c_custkey long, nonce long, balance long, has_storage boolean, has_code boolean, slim string, full string")


@query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN CAST(round(o_totalprice * 100) AS BIGINT) WHEN 4 THEN o_orderkey % 127 + 1 END AS value FROM orders""")
def storage_values(spark, sf_dir):
    """Slots' values: numbers in the shortest form are read, lists, noughts and numbers with leading noughts are refused."""
    rows = read(spark, sf_dir, "orders").select("o_orderkey", cents(F.col("o_totalprice")).alias("amount"))

    def through(batches):
        for b in batches:
            out = []
            for key, amount in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                raw = (rlp.encode(amount), rlp.encode(b"\0" + amount.to_bytes(8, "big").lstrip(b"\0")), rlp.encode([amount]), rlp.encode(0), bytes([key % 127 + 1]))[key % 5]
                try:
                    out.append(rlp.storage_word(raw))
                except ValueError:
                    out.append(None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.int64())], names=["o_orderkey", "value"])

    return rows.mapInArrow(through, "o_orderkey long, value long")


@query(f"""SELECT s_suppkey, 1 AS type, {sql.rlp_list(sql.rlp_text(sql.digits_of("s_suppkey")), sql.rlp_text(sql.digits_of("abs(CAST(round(s_acctbal * 100) AS BIGINT))")), "'80'", "'80'")} AS payload FROM supplier
UNION ALL SELECT l_suppkey, 2, {sql.rlp_text(sql.digits_of("amount"))} FROM (SELECT l_suppkey, l_linenumber, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS amount FROM lineitem GROUP BY ALL)""")
def record_streams(spark, sf_dir):
    """Accounts and slots written as framed streams, packed, several at once; read again with all checks."""
    number = F.col("s_suppkey")
    key = F.unhex(F.sha2(number.cast("string").cast("binary"), 256))

    def slim(batches):
        for b in batches:
            out = [rlp.Account(n, m).slim() for n, m in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["account_hash", "payload"])

    a = read(spark, sf_dir, "supplier").select(key.alias("account_hash"), number, F.abs(cents(F.col("s_acctbal"))).alias("m")).mapInArrow(slim, "account_hash binary, payload binary")
    s = read(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey"), "l_linenumber").agg(F.sum(cents(F.col("l_extendedprice"))).alias("amount"))
    s = s.select(F.lit(2).alias("type"), key.alias("account_hash"), F.unhex(F.sha2(F.col("l_linenumber").cast("string").cast("binary"), 256)).alias("sub_hash"), encoded(F.col("amount")).alias("payload"))
    rows = a.select(F.lit(1).alias("type"), "account_hash", F.lit(None).cast("binary").alias("sub_hash"), "payload").unionByName(s)
    link = records.first_link(1, bytes(32), bytes(32), b"")
    at = own_folder(spark, "streams")
    made = records.write_streams(rows, at, link, "zstd")
    records.verify_streams(spark, at, made, link, "zstd", canonical=True)
    found = records.read_records(spark, [f"{at}/{records.STREAM_NAME.format(number)}" for number, _ in made], "zstd")
    names = read(spark, sf_dir, "supplier").select("s_suppkey", key.alias("account_hash"))
    return found.join(names, "account_hash").select("s_suppkey", F.col("type").cast("int").alias("type"), F.lower(F.hex("payload")).alias("payload"))


@query("""SELECT event_id, CASE WHEN event_id % 7 = 3 AND event_id % 2 = 1 THEN 'failed receipt contains logs' END AS fault, CASE WHEN NOT (event_id % 7 = 3 AND event_id % 2 = 1) THEN event_id % 2 END AS logs,
  CASE WHEN NOT (event_id % 7 = 3 AND event_id % 2 = 1) THEN 21000 + event_id END AS gas, CASE WHEN NOT (event_id % 7 = 3 AND event_id % 2 = 1) THEN event_id % 2 * 3 END AS topics FROM events""")
def receipt_forms(spark, sf_dir):
    """Receipts in the three stored forms, logs of three and of eight fields; blooms are made and compared, failed ones with logs refused."""
    rows = read(spark, sf_dir, "events").select("event_id")

    def through(batches):
        for b in batches:
            out = []
            for n in b.column(0).to_pylist():
                status, topics = (b"" if n % 7 == 3 else b"\x01"), [bytes([k + 1]) * 32 for k in range(3)]
                log = [b"\x07" * 20, topics, b"data"] + ([b"\x01", bytes(32), b"", bytes(32), b""] if n % 4 == 1 else [])
                logs, gas = [log] * (n % 2), 21000 + n
                bloom = rlp.bloom_of([b"\x07" * 20, *topics] if logs else [])
                if n % 3 == 0:
                    item = [status, gas, logs, b"", b"", b"", b"1.5"]
                elif n % 3 == 1:
                    item = [status, gas, bytes(32), bytes(20), logs, gas]
                else:
                    item = [status, gas, bloom, bytes(32), bytes(20), logs, gas]
                try:
                    r = rlp.receipt(rlp.decode(rlp.encode(item)))
                    again = rlp.receipts(rlp.encode([item]))[0]
                    if again != r or r.bloom != bloom:
                        raise ValueError("receipt differs")
                    out.append((n, None, len(r.logs), r.cumulative_gas, sum(len(x.topics) for x in r.logs)))
                except ValueError as e:
                    out.append((n, str(e), None, None, None))
            cols = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["event_id", "fault", "logs", "gas", "topics"])

    return rows.mapInArrow(through, "event_id long, fault string, logs long, gas long, topics long")


def _pad(number: str) -> str:
    return f"lpad(lower(to_base({number}, 16)), 64, '0')"


_BALANCE = sql.keccak(f"{_pad('c_custkey')} || repeat('0', 64)")
_ALLOWANCE = sql.keccak(f"{_pad('c_nationkey')} || {sql.keccak(_pad('c_custkey') + chr(32) + chr(124) * 2 + chr(32) + _pad('1'))}")


@query(f"WITH s AS (SELECT c_custkey, {_BALANCE} AS balance_slot, {_ALLOWANCE} AS allowance_slot FROM customer) SELECT *, {sql.keccak('balance_slot')} AS balance_key FROM s")
def mapping_slots(spark, sf_dir):
    """Where a token contract keeps a holder's balance and its allowance to another, and the key of the first in the storage trie."""
    word = lambda n: codec.pad32(codec.u64_be(n))
    owner, spender = word(F.col("c_custkey")), word(F.col("c_nationkey"))
    rows = read(spark, sf_dir, "customer").select("c_custkey", keccak256(F.concat(owner, F.lit(bytearray(32)))).alias("b"), keccak256(F.concat(spender, keccak256(F.concat(owner, word(F.lit(1)))))).alias("a"))
    return rows.select("c_custkey", F.lower(F.hex("b")).alias("balance_slot"), F.lower(F.hex("a")).alias("allowance_slot"), F.lower(F.hex(keccak256(F.col("b")))).alias("balance_key"))


@query("SELECT lpad(lower(to_base(c_custkey, 16)), 40, '0') AS address FROM customer")
def preimage_rows(spark, sf_dir):
    """Addresses among the preimages of an inventory: each key is checked, values of another length are no addresses."""
    rows = read(spark, sf_dir, "customer").select(F.lpad(codec.u64_be(F.col("c_custkey")), 20, b"\x00").alias("value"))
    rows = rows.unionByName(read(spark, sf_dir, "supplier").select(codec.pad32(codec.u64_be(F.col("s_suppkey"))).alias("value")))
    kv = rows.select(F.concat(F.lit(bytearray(b"secure-key-")), keccak256(F.col("value"))).alias("key"), "value").unionByName(read(spark, sf_dir, "region").select(F.col("r_name").cast("binary").alias("key"), F.lit(bytearray(20)).alias("value")))
    return convert.preimages(kv).select(F.lower(F.hex("address")).alias("address"))


@query("""WITH k AS (SELECT CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 'malformed address' WHEN 3 THEN 'fields of another type' WHEN 4 THEN 'a field occurs twice' WHEN 5 THEN 'no JSON object' ELSE 'line is too long' END AS fault,
  CASE c_custkey % 7 WHEN 1 THEN 'allowance' WHEN 5 THEN NULL ELSE 'address' END AS type FROM customer) SELECT type, fault, count(*) AS lines FROM k GROUP BY ALL""")
def witness_lines(spark, sf_dir):
    """Ownership witnesses as JSON lines, good ones and those of each fault, written and read again."""
    hexa = F.concat(F.lit("0x"), F.lower(F.lpad(F.hex("c_custkey"), 40, "0")))
    line = lambda text: F.format_string(text, hexa)
    kinds = ['{"type":"address","address":"%s"}', '{"type":"allowance","owner":"%1$s","spender":"%1$s"}', '{"type":"address","address":"%s0"}', '{"type":"address","address":"%s","more":1}', '{"type":"address","address":"%1$s","address":"%1$s"}', "no JSON %s"]
    out = F.concat(F.lit('{"type":"address","address":"'), hexa, F.lit('"'), F.repeat(F.lit(" "), 5000), F.lit("}"))
    for k, text in enumerate(kinds):
        out = F.when(F.col("c_custkey") % 7 == k, line(text)).otherwise(out)
    at = f"{shared_dir(spark)}/witness-{uuid.uuid4().hex}"
    read(spark, sf_dir, "customer").select(out.alias("value")).write.text(at)
    return inputs.read_witness(spark, at).groupBy("type", "fault").agg(F.count("*").alias("lines"))


@query("""WITH l AS (SELECT lower(printf('0x%040x', user_id)) AS t FROM events WHERE event_type = 'click' UNION ALL SELECT '0x12' FROM region UNION ALL SELECT printf('0x%040x', 3)),
g AS (SELECT t, count(*) AS lines FROM l GROUP BY t) SELECT substr(t, 3) AS address, lines, CASE WHEN length(t) <> 42 THEN 'malformed address' WHEN lines > 1 THEN 'address occurs twice' WHEN t = printf('0x%040x', 3) THEN 'the token contract cannot be listed' END AS fault FROM g""")
def retention_lines(spark, sf_dir):
    """A list of addresses, one a line in either case: doubled, malformed and forbidden ones."""
    address = lambda n: F.format_string("0x%040x", n)
    clicks = read(spark, sf_dir, "events").where("event_type = 'click'").select(F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("0x"), F.upper(F.substring(address(F.col("user_id")), 3, 40)))).otherwise(address(F.col("user_id"))).alias("value"))
    rows = clicks.unionByName(read(spark, sf_dir, "region").select(F.lit("0x12").alias("value"))).unionByName(spark.range(3, 4).select(address(F.col("id")).alias("value")))
    at = f"{shared_dir(spark)}/retention-{uuid.uuid4().hex}"
    rows.write.text(at)
    found = inputs.read_retention(spark, at, f"0x{3:040x}")
    return found.select(F.coalesce(F.lower(F.hex("address")), F.lit("12")).alias("address"), "lines", "fault")


@query("""SELECT lpad(lower(to_base(n_nationkey, 16)), 40, '0') AS address, CASE WHEN n_nationkey % 3 <> 0 THEN n_nationkey * 1000003 END AS balance, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey END AS nonce,
  CASE WHEN n_nationkey % 5 = 1 THEN lower(hex(encode(n_name))) END AS code, CASE WHEN n_nationkey % 4 = 0 THEN 1 ELSE 0 END AS slots FROM nation""")
def alloc_fields(spark, sf_dir):
    """An overlay file by address: balances in decimal and hex, nonces, code and storage, each set or not."""
    data = {}
    for r in read(spark, sf_dir, "nation").collect():  # an operator's file is small
        n = r.n_nationkey
        fields = {"balance": str(n * 1000003) if n % 2 else hex(n * 1000003)} if n % 3 else {}
        fields |= ({"nonce": hex(n)} if n % 2 == 0 else {}) | ({"code": "0x" + r.n_name.encode().hex()} if n % 5 == 1 else {}) | ({"storage": {"0x01": hex(n + 256).replace("0x", "0x0")}} if n % 4 == 0 else {})
        data[("0x" if n % 2 else "") + f"{n:040x}"] = fields
    path = f"{own_folder(spark, 'alloc')}/alloc.json"
    with open(path, "w") as f:
        json.dump(data, f)
    found = inputs.read_alloc(spark, path)
    value = codec.u64_from_be(F.substring("balance", 17, 16)).cast("long")
    return found.select(F.lower(F.hex("address")).alias("address"), value.alias("balance"), F.col("nonce").cast("long").alias("nonce"), F.lower(F.hex("code")).alias("code"), F.size("storage").alias("slots"))


@query("""SELECT c_custkey, c_custkey % 8 IN (0, 1, 2, 4, 6) AS is_foreign FROM customer""")
def foreign_keys(spark, sf_dir):
    """Keys of layouts and services that pruning does not know: prefixed code, light clients' balances by address, nodes by path."""
    n = F.col("c_custkey")
    content = F.unhex(F.sha2(n.cast("string").cast("binary"), 256))
    ip = F.concat_ws(".", *[(n % k).cast("string") for k in (256, 200, 100, 50)])
    b = lambda text: F.lit(bytearray(text))
    keys = [
        F.concat(b(b"cht-"), codec.u64_be(n)), F.concat(b(b"c"), content), F.concat(b(b"\0\1nb:"), ip.cast("binary")), F.concat(b(b"\0\1nb:"), F.concat(ip, F.lit(".1")).cast("binary")),
        F.concat(b(b"\0\0nb:"), F.concat(F.lit("fe80::"), F.lower(F.hex(n % 65536)), F.lit("%eth0")).cast("binary")), F.concat(b(b"c"), F.substring(content, 2, 31), b(b"\0")), F.concat(b(b"A"), F.unhex(F.concat(F.lit("0"), F.hex(n % 16)))), F.concat(b(b"A"), F.unhex(F.concat(F.lit("1"), F.hex(n % 16)))),
    ]
    key = keys[7]
    for k in range(7):
        key = F.when(n % 8 == k, keys[k]).otherwise(key)
    rows = read(spark, sf_dir, "customer").select("c_custkey", key.alias("key"), content.alias("content"))
    return rows.select("c_custkey", snapshot.foreign_key(F.col("key"), F.col("content")).alias("is_foreign"))


@query("SELECT doc_id, CASE WHEN coalesce(n_chars, 0) < 32 THEN 0 ELSE (n_chars - 1) // 32 + 1 END AS slots FROM documents")
def string_layouts(spark, sf_dir):
    """How many slots a contract needs for a string of a document's length, besides its own."""
    rows = read(spark, sf_dir, "documents").select("doc_id", F.coalesce("n_chars", F.lit(0)).cast("long").alias("n"))

    def through(batches):
        for b in batches:
            out = [len(u256.string_slots(3, (b"x" * n).ljust(31, b"\0") + bytes([2 * n]) if n < 32 else (2 * n + 1).to_bytes(32, "big"))) for n in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.int64())], names=["doc_id", "slots"])

    return rows.mapInArrow(through, "doc_id long, slots long")


@query("""WITH s AS (SELECT c_mktsegment, sum(abs(CAST(round(c_acctbal * 100) AS HUGEINT)) * 1000000007) AS hi, sum(CAST(c_custkey AS HUGEINT) * 4294967291) AS lo, count(*) AS n FROM customer GROUP BY 1)
SELECT c_mktsegment, n, lpad(lower(to_base(CAST(hi AS BIGINT), 16)), 32, '0') || lpad(lower(to_base(CAST(lo AS BIGINT), 16)), 32, '0') AS total FROM s""")
def u256_sums(spark, sf_dir):
    """Exact sums of 256-bit numbers by segment, from sums of their limbs with the carries brought over."""
    wide = lambda n: F.lpad(codec.u64_be(n), 16, b"\x00")
    word = F.concat(wide(F.abs(cents(F.col("c_acctbal"))) * 1000000007), wide(F.col("c_custkey") * 4294967291))
    rows = read(spark, sf_dir, "customer").select("c_mktsegment", word.alias("w"))
    sums = rows.groupBy("c_mktsegment").agg(F.count("*").alias("n"), *u256.limb_sums(F.col("w")))
    return sums.select("c_mktsegment", "n", F.lower(F.hex(u256.carried([F.col(f"limb{k}") for k in range(u256.LIMBS)]))).alias("total"))


@query("""WITH e AS (SELECT DISTINCT s_nationkey AS key FROM supplier UNION SELECT n_nationkey FROM nation UNION SELECT 1000 + r_regionkey FROM region),
w AS (SELECT key, (SELECT min(s_name) FROM supplier WHERE s_nationkey = key) AS value FROM e),
f AS (SELECT w.key, count(s_name) AS found, count(*) FILTER (s_name = w.value) AS same FROM w LEFT JOIN supplier ON s_nationkey = w.key GROUP BY w.key)
SELECT key, found, CASE WHEN found = 0 THEN 'missing' WHEN found > 1 THEN 'twice' WHEN same = 0 THEN 'another value' END AS fault FROM f""")
def expected_rows(spark, sf_dir):
    """Few expected rows against an inventory: each must be there exactly once, with its value."""
    s = read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("key"), F.col("s_name").alias("value"))
    keys = s.select("key").unionByName(read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"))).unionByName(read(spark, sf_dir, "region").select((F.col("r_regionkey") + 1000).alias("key"))).distinct()
    want = keys.join(s.groupBy("key").agg(F.min("value").alias("value")), "key", "left")
    return merge.expected_once(s, want, "key", "value")


@query("SELECT o_custkey AS key FROM orders INTERSECT SELECT user_id FROM events INTERSECT SELECT s_suppkey FROM supplier")
def common_keys(spark, sf_dir):
    of = lambda t, c: read(spark, sf_dir, t).select(F.col(c).cast("long").alias("key"))
    return merge.common(merge.common(of("orders", "o_custkey"), of("events", "user_id")), of("supplier", "s_suppkey"))


@query("""WITH p AS (SELECT event_id, value, lag(value) OVER (ORDER BY event_id) AS before FROM events) SELECT value, before FROM p WHERE value <= before""")
def falling_values(spark, sf_dir):
    """Neighbours in the order of a stream of which the later is not above the earlier, compared by ranges."""
    return order.not_increasing(read(spark, sf_dir, "events"), "event_id", "value", span=512)


@query("""WITH r AS (SELECT user_id, event_id, count(*) OVER w AS records, CAST(sum(length(props)) OVER w AS BIGINT) AS bytes, count(*) OVER (PARTITION BY user_id) AS every, date_diff('second', first_value(ts) OVER w, ts) AS seconds FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
SELECT user_id, event_id, records, bytes, 100.0::DOUBLE * records / every AS percent, CASE WHEN seconds > 0 THEN records::DOUBLE / seconds END AS rate FROM r""")
def progress_rates(spark, sf_dir):
    """Records and bytes so far, how much of all that is, and how many a second, for each user's events in order."""
    w = Window.partitionBy("user_id")
    e = read(spark, sf_dir, "events").withColumns({"every": F.count("*").over(w), "second": F.date_trunc("second", F.col("ts").cast("timestamp")).cast("long")})
    e = e.withColumn("seconds", F.col("second") - F.first("second").over(w.orderBy("ts", "event_id")))
    out = order.rates(e, ["user_id"], ["ts", "event_id"], "seconds", F.col("every"), records=F.lit(1), bytes=F.length("props"))
    return out.select("user_id", "event_id", "records", "bytes", "percent", "rate")


@query("SELECT row_number() OVER (ORDER BY n_nationkey) - 1 AS number, n_name AS name, n_name || repeat(' ', 200) AS packed FROM nation")
def freezer_items(spark, sf_dir):
    """Append-only history files, raw and packed, over two data files; read by ordinal."""
    names = [r.n_name.encode() for r in read(spark, sf_dir, "nation").orderBy("n_nationkey").collect()]  # a file of the reader's, 25 items
    at = own_folder(spark, "cold")
    for name, packed in (("hashes", False), ("headers", True)):
        index, file, offset = bytes(6), 0, 0
        for n, item in enumerate(names):
            blob = pa.Codec("snappy").compress(item + b" " * 200, asbytes=True) if packed else item
            if n == 11:
                file, offset = 1, 0
            with open(f"{at}/{name}.{file:04d}.{'c' if packed else 'r'}dat", "ab") as f:
                f.write(blob)
            offset += len(blob)
            index += file.to_bytes(2, "big") + offset.to_bytes(4, "big")
        with open(f"{at}/{name}.{'c' if packed else 'r'}idx", "wb") as f:
            f.write(index)
    cold = freezer.read_freezer(spark, at, {"hashes": False, "headers": True})
    text = lambda t, c: cold[t].select("number", F.col("value").cast("string").alias(c))
    return text("hashes", "name").join(text("headers", "packed"), "number")


@query("""WITH h AS (SELECT s_suppkey, greatest(abs(CAST(round(s_acctbal * 100) AS BIGINT)), 1) AS amount, s_nationkey % 3 = 0 AS contract, s_suppkey IN (SELECT n_nationkey FROM nation WHERE n_nationkey > 0) AS sent FROM supplier)
SELECT CAST(sum(amount) AS BIGINT) AS original_supply, CAST(coalesce(sum(amount) FILTER (NOT (contract AND sent)), 0) AS BIGINT) AS migrated_native, CAST(coalesce(sum(amount) FILTER (contract AND sent), 0) AS BIGINT) AS remaining_supply,
  count(*) FILTER (NOT contract) AS eoa_holders, count(*) FILTER (contract AND NOT sent) AS converted_contract_holders, count(*) FILTER (contract AND sent) AS retained_contract_holders, (SELECT count(*) FROM nation WHERE n_nationkey > 0) AS transfers, 2 AS checkpoint FROM h""")
def conversion_replay(spark, sf_dir):
    """A token's balances converted into native ones, from state, history and witnesses to a published artifact, and verified by doing it again.

    Suppliers hold the token, those of every third nation as contracts; a supplier of a nation's number has sent some.
    """
    from ledgerloom.plans import conversion

    token, code, new_code = b"\xde\xad" * 10, b"\x60\x00", b"\x60\x80\x60\x40"
    word = lambda n: codec.pad32(codec.u64_be(n))
    held = read(spark, sf_dir, "supplier").select("s_suppkey", F.greatest(F.abs(cents(F.col("s_acctbal"))), F.lit(1)).alias("amount"), (F.col("s_nationkey") % 3 == 0).alias("contract"))
    supply, n = held.agg(F.sum("amount"), F.count("*")).first()
    held = held.repartition(tasks_for(spark, n))
    bits = lambda b: F.lit(bytearray(b))
    short = lambda n: F.when(n < 128, F.substring(codec.u64_be(n), 8, 1)).otherwise(encoded(n))
    fixed = spark.createDataFrame([(bytearray(keccak((2).to_bytes(32, "big"))), bytearray(rlp.encode(supply))), (bytearray(keccak((3).to_bytes(32, "big"))), bytearray(rlp.encode(b"Token".ljust(31, b"\0") + bytes([10]))))], "key binary, value binary")
    slots = held.select(keccak256(keccak256(F.concat(word(F.col("s_suppkey")), bits(bytes(32))))).alias("key"), short(F.col("amount")).alias("value")).unionByName(fixed)
    slots = staged(slots.select(bits(keccak(token)).alias("owner"), "key", "value"), "token-slots")
    slot_nodes = trie.trie_nodes(slots)
    root = slot_nodes.where("path = ''").first().hash
    own = spark.createDataFrame([(bytearray(keccak(token)), bytearray(rlp.Account(1, 0, bytes(root), keccak(code)).full()))], "key binary, value binary")
    plain, with_code = (bits(rlp.Account(7, 0, EMPTY_ROOT, h).full()) for h in (EMPTY_CODE, keccak(code)))
    address = F.lpad(codec.u64_be(F.col("s_suppkey")), 20, b"\x00")
    accounts = held.select(keccak256(address).alias("key"), F.when(F.col("contract"), with_code).otherwise(plain).alias("value")).unionByName(own)
    nodes = staged(trie.trie_nodes(staged(accounts.select(bits(b"").alias("owner"), "key", "value"), "token-accounts")).unionByName(slot_nodes), "token-nodes")
    state_root = bytes(nodes.where((F.octet_length("owner") == 0) & (F.col("path") == "")).first().hash)
    # two blocks: nothing, and a receipt with a transfer from every nation's number
    of = lambda n: n.to_bytes(32, "big")
    logs = [[token, [history.TRANSFER, of(r.n_nationkey), of(1)], of(5)] for r in read(spark, sf_dir, "nation").where("n_nationkey > 0").orderBy("n_nationkey").collect()]
    receipt = rlp.receipt([b"\x01", (21000).to_bytes(2, "big"), logs, b"", b"", b"", b""])
    make = lambda parent, number, txs, receipts, bloom, gas: rlp.encode([parent, EMPTY_LIST, bytes(20), state_root, txs, receipts, bloom, 1, number, 1 << 24, gas, number + 1, b"", bytes(32), bytes(8)])
    genesis = make(bytes(32), 0, EMPTY_ROOT, EMPTY_ROOT, bytes(256), 0)
    last = make(keccak(genesis), 1, keccak(b"transactions"), trie.list_root([receipt.consensus()]), receipt.bloom, 21000)
    marks = {b"LastBlock": keccak(last), keccak(code): code}
    for n, blob, stored in ((0, genesis, b"\xc0"), (1, last, rlp.encode([[b"\x01", 21000, logs, b"", b"", b"", b""]]))):
        number, hash_ = n.to_bytes(8, "big"), keccak(blob)
        marks |= {b"h" + number + b"n": hash_, b"h" + number + hash_: blob, b"r" + number + hash_: stored, b"H" + hash_: number}
    rows = spark.createDataFrame([(bytearray(k), bytearray(v)) for k, v in marks.items()], "key binary, value binary")
    kv = staged(nodes.select(F.col("hash").alias("key"), F.col("blob").alias("value")).dropDuplicates(["key"]).unionByName(rows), "token-kv")
    at = own_folder(spark, "conversion")
    with open(f"{at}/witness", "w") as f:  # an operator's file
        f.writelines(json.dumps({"type": "address", "address": f"0x{r.s_suppkey:040x}"}) + "\n" for r in held.select("s_suppkey").toLocalIterator())
    with open(f"{at}/code", "w") as f:
        f.write("0x" + new_code.hex())
    head, options = history.Head(1, keccak(last), state_root, last), conversion.Options(token, f"{at}/witness", f"{at}/code")
    made = conversion.migrate(kv, head, options, f"{at}/out", "hash")
    again = conversion.verify(kv, head, options, f"{at}/out")
    names = ("original_supply", "migrated_native", "remaining_supply", "eoa_holders", "converted_contract_holders", "retained_contract_holders")
    out = [int(made["balances"][k]) for k in names] + [made["history"]["transfers"], made["checkpoint"]["head_before"]["number"]]
    return spark.createDataFrame([tuple(out)], ", ".join(f"{k} long" for k in (*names, "transfers", "checkpoint"))).where(F.lit(made == again))
