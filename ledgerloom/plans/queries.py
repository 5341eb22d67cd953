"""The operators on the driver's tables, each beside the same in SQL.

orders stand for accounts, lineitem for storage slots, part for code, events for history, documents for a
content-addressed inventory. Money is counted in cents, as whole numbers, so that sums do not depend on their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions import codec
from ledgerloom.operators import counts, digests, merge, order
from ledgerloom.plans import sql

#: Rows that a task of a check of references sorts, about.
SORTED = 1 << 20

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(money: Column) -> Column:
    return F.round(money * 100).cast("long")


def digest(c: Column) -> Column:
    return F.sha2(c.cast("string").cast("binary"), 256)


def accounts_of(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders with the least part of their lines as code; lines; parts."""
    slots = read(spark, sf_dir, "lineitem")
    code = slots.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_partkey").alias("code_ref"))
    return read(spark, sf_dir, "orders").join(code, "o_orderkey", "left"), slots, read(spark, sf_dir, "part")


def payloads() -> dict[str, Column]:
    return {
        "accounts": F.octet_length("o_orderpriority").cast("long"),
        "slots": F.octet_length(F.concat("l_returnflag", "l_linestatus")).cast("long"),
        "code": F.octet_length("p_name").cast("long"),
    }


COUNT_SQL = """
WITH a AS (SELECT o_orderkey, o_orderpriority, (SELECT min(l_partkey) FROM lineitem WHERE l_orderkey = o_orderkey) AS code_ref FROM orders),
e AS (SELECT substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 1) AS nibble, 1 AS accounts, 0 AS slots, CASE WHEN code_ref IS NULL THEN 0 ELSE 1 END AS refs, 0 AS code, strlen(o_orderpriority) AS b FROM a
      UNION ALL SELECT substr(sha256(CAST(l_orderkey AS VARCHAR)), 1, 1), 0, 1, 0, 0, strlen(l_returnflag || l_linestatus) FROM lineitem
      UNION ALL SELECT substr(sha256(CAST(p_partkey AS VARCHAR)), 1, 1), 0, 0, 0, 1, strlen(p_name) FROM part WHERE p_partkey IN (SELECT code_ref FROM a))
SELECT {by} CAST(sum(accounts) AS BIGINT) AS accounts, CAST(sum(slots) AS BIGINT) AS storage_slots, CAST(sum(refs) AS BIGINT) AS code_references, CAST(sum(code) AS BIGINT) AS code_records,
       CAST(sum(accounts + slots + code) AS BIGINT) AS records, CAST(sum(b) AS BIGINT) AS payload_bytes FROM e {group}
"""


@query(COUNT_SQL.format(by="", group=""))
def state_counts(spark, sf_dir):
    return counts.state_counts(*accounts_of(spark, sf_dir), payloads(), "code_ref", "p_partkey")


@query(COUNT_SQL.format(by="nibble,", group="GROUP BY nibble"))
def partitioned_counts_by_nibble(spark, sf_dir):
    a, s, c = accounts_of(spark, sf_dir)
    at = lambda df, key: df.withColumn("nibble", F.substring(digest(F.col(key)), 1, 1))
    return counts.state_counts(at(a, "o_orderkey"), at(s, "l_orderkey"), at(c, "p_partkey"), payloads(), "code_ref", "p_partkey", ["nibble"])


@query(f"""WITH c AS ({COUNT_SQL.format(by="", group="")})
SELECT records = accounts + storage_slots + code_records AS records_add_up, code_records <= code_references AS code_is_referenced,
       code_references <= accounts AS references_have_accounts, payload_bytes >= records AS payloads_are_not_empty FROM c""")
def count_relationships(spark, sf_dir):
    return counts.count_checks(state_counts(spark, sf_dir))


@query("SELECT p_partkey, p_name FROM part WHERE p_name >= 'red' AND p_name < 'ree'")
def prefix_scan(spark, sf_dir):
    return read(spark, sf_dir, "part").where(codec.with_prefix(F.col("p_name"), b"red", text=True)).select("p_partkey", "p_name")


@query("SELECT p_partkey, p_name FROM part WHERE p_name >= 'small r' AND p_name < 'smalm' ORDER BY p_name, p_partkey")
def ordered_prefix_scan_from(spark, sf_dir):
    return read(spark, sf_dir, "part").where(codec.with_prefix(F.col("p_name"), b"small", b" r", text=True)).select("p_partkey", "p_name").orderBy("p_name", "p_partkey")


@query("""SELECT o_orderkey, c_name, n_name, r_name FROM orders JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders)""")
def point_lookup_chain(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    head = o.agg(F.max_by(F.struct("o_orderkey", "o_custkey"), "o_orderkey").alias("h")).select("h.*")
    return (
        head.join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("o_orderkey", "c_name", "n_name", "r_name")
    )


@query("""SELECT c_custkey, CAST(count(o_orderkey) AS BIGINT) AS nonce, CAST(coalesce(sum(CAST(round(o_totalprice * 100) AS BIGINT)), 0) AS BIGINT) AS balance
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""")
def empty_account_default(spark, sf_dir):
    spent = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("nonce"), F.sum(cents(F.col("o_totalprice"))).alias("balance"))
    zero = F.lit(0).cast("long")
    return read(spark, sf_dir, "customer").select("c_custkey").join(spent, "c_custkey", "left").select("c_custkey", F.coalesce("nonce", zero).alias("nonce"), F.coalesce("balance", zero).alias("balance"))


@query("""SELECT o_orderkey, CAST(count(l_orderkey) AS BIGINT) AS slots, CAST(coalesce(sum(l_quantity), 0) AS BIGINT) AS quantity, count(l_orderkey) > 0 AS has_storage
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def parent_child_rollup(spark, sf_dir):
    s = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("slots"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"))
    zero = F.lit(0).cast("long")
    out = read(spark, sf_dir, "orders").select("o_orderkey").join(s, "o_orderkey", "left")
    return out.select("o_orderkey", F.coalesce("slots", zero).alias("slots"), F.coalesce("quantity", zero).alias("quantity"), F.col("slots").isNotNull().alias("has_storage"))


@query("""SELECT 'slot without account' AS fault, l_orderkey AS key FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'account without slots', o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def orphan_check(spark, sf_dir):
    o, s = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key")), read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), s.count() // SORTED + 1)  # a task sorts as many rows, whatever the tables
    o, s = o.repartition(n, "key"), s.repartition(n, "key")
    return s.join(o, "key", "left_anti").select(F.lit("slot without account").alias("fault"), "key").unionByName(o.join(s, "key", "left_anti").select(F.lit("account without slots").alias("fault"), "key"))


@query("SELECT l_partkey AS code, min(l_orderkey) AS first_account FROM lineitem GROUP BY l_partkey")
def code_first_reference(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("code"), F.col("l_orderkey").alias("first_account"))
    return order.first_references(rows, "code", ["first_account"])


@query("SELECT CAST(count(DISTINCT l_partkey) AS BIGINT) AS code_records, CAST(count(l_partkey) AS BIGINT) AS code_references FROM lineitem")
def exact_distinct_codes(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").agg(F.count_distinct("l_partkey").alias("code_records"), F.count("l_partkey").alias("code_references"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(p.p_name, s.s_name) AS code FROM lineitem
LEFT JOIN (SELECT * FROM part WHERE p_brand = 'Brand#2') p ON p_partkey = l_partkey LEFT JOIN supplier s ON s_suppkey = l_suppkey""")
def code_fallback_lookup(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    own = read(spark, sf_dir, "part").where("p_brand = 'Brand#2'")
    supplier = read(spark, sf_dir, "supplier").withColumn("l_suppkey", F.col("s_suppkey"))
    first = merge.lookup(rows, "l_partkey", (own, "p_partkey", "p_name"), name="a")
    return merge.lookup(first, "l_suppkey", (supplier.select("s_suppkey", "s_name"), "s_suppkey", "s_name"), name="b").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.coalesce("a", "b").alias("code"))


def _inventory(spark, sf_dir) -> DataFrame:
    """Documents as key and value: two in three are keyed by their content, of which some do not match; the rest by name."""
    d = read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("value"), "source")
    content = F.sha2(F.col("value").cast("binary"), 256)
    key = F.when(F.col("source").isin("src0", "src1"), F.concat(F.lit("meta-"), F.col("doc_id").cast("string"))).when(F.col("source") == "src2", digest(F.col("doc_id"))).otherwise(content)
    return d.select(key.alias("key"), "value", content.alias("content"), "doc_id").dropDuplicates(["key"]).select("key", "value", "content")


INVENTORY_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS value, source, sha256(coalesce(text, '')) AS content FROM documents),
s AS (SELECT DISTINCT CASE WHEN source IN ('src0', 'src1') THEN 'meta-' || doc_id WHEN source = 'src2' THEN sha256(CAST(doc_id AS VARCHAR)) ELSE content END AS key, value, content FROM d),
k AS (SELECT DISTINCT sha256(coalesce(text, '')) AS key FROM documents WHERE lang = 'en' AND source NOT IN ('src0', 'src1', 'src2')),
r AS (SELECT s.*, CASE WHEN k.key IS NOT NULL THEN 'retain' WHEN starts_with(s.key, 'meta-') THEN 'protect' WHEN content = s.key THEN 'delete' ELSE 'unknown' END AS role FROM s LEFT JOIN k USING (key))
"""


def _roles(spark, sf_dir) -> DataFrame:
    source = _inventory(spark, sf_dir)
    d = read(spark, sf_dir, "documents").where("lang = 'en' AND source NOT IN ('src0', 'src1', 'src2')")
    keep = d.select(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("key"), F.coalesce("text", F.lit("")).alias("value")).dropDuplicates(["key"])
    return merge.ordered_diff(source, keep, "key", "value", ~F.col("key").startswith("meta-"), F.col("content") == F.col("key"))


def pair_bytes() -> Column:
    return (F.octet_length("key") + F.octet_length("value")).cast("long")


@query(INVENTORY_SQL + "SELECT role, count(*) AS keys, CAST(sum(strlen(key) + strlen(value)) AS BIGINT) AS bytes FROM r GROUP BY role")
def ordered_diff_roles(spark, sf_dir):
    return _roles(spark, sf_dir).groupBy("role").agg(F.count("*").alias("keys"), F.sum(pair_bytes()).alias("bytes"))


@query(INVENTORY_SQL + ", z AS (SELECT role, strlen(key) + strlen(value) AS n FROM r) SELECT " + ", ".join(f"count(*) FILTER ({c}) AS {n}_keys, CAST(coalesce(sum(n) FILTER ({c}), 0) AS BIGINT) AS {n}_bytes" for n, c in (("keep", "role = 'retain'"), ("protected", "role <> 'delete'"), ("candidates", "role = 'delete'"), ("unknown", "role = 'unknown'"))) + " FROM z")
def prune_role_totals(spark, sf_dir):
    return counts.role_totals(_roles(spark, sf_dir), pair_bytes())


@query(INVENTORY_SQL + "SELECT key, sha256(value) AS value_digest FROM r WHERE role <> 'delete'")
def prune_retained(spark, sf_dir):
    return _roles(spark, sf_dir).where("role != 'delete'").select("key", F.sha2(F.col("value").cast("binary"), 256).alias("value_digest"))


@query(INVENTORY_SQL + "SELECT key FROM r WHERE role = 'delete'")
def prune_candidates(spark, sf_dir):
    return _roles(spark, sf_dir).where("role = 'delete'").select("key")


@query(INVENTORY_SQL + "SELECT (SELECT count(*) FROM k WHERE key NOT IN (SELECT key FROM s)) AS missing, CAST(0 AS BIGINT) AS conflicting")
def keep_subset_check(spark, sf_dir):
    return _roles(spark, sf_dir).agg(F.count_if(F.col("role") == "missing").alias("missing"), F.count_if(F.col("role") == "conflict").alias("conflicting"))


@query("""WITH a AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT c_custkey AS k, count(*) AS n FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1)
SELECT count(*) AS differences FROM ((SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT ALL SELECT * FROM a))""")
def inventory_equality(spark, sf_dir):
    o, c = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    a = o.groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n"))
    b = c.join(o, c["c_custkey"] == o["o_custkey"]).groupBy(F.col("c_custkey").alias("k")).agg(F.count("*").alias("n"))
    return merge.inventory_difference(a, b).agg(F.count("*").alias("differences"))


@query("""WITH p AS (SELECT o_custkey AS k, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT coalesce(c_custkey, k) AS key, CASE WHEN k IS NOT NULL THEN v ELSE CAST(round(c_acctbal * 100) AS BIGINT) END AS value
FROM customer FULL JOIN p ON c_custkey = k WHERE k IS NULL OR v > 50000000""")
def patch_overlay(spark, sf_dir):
    base = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), cents(F.col("c_acctbal")).alias("value"))
    patch = read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("key")).agg(F.sum(cents(F.col("o_totalprice"))).alias("value"))
    return merge.overlay(base, patch, "key", "value", F.col("value") <= 50000000)


@query("""WITH p AS (SELECT o_custkey AS k, count(*) AS nonce, max(CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(round(o_totalprice * 100) AS BIGINT) END) AS balance FROM orders GROUP BY 1)
SELECT coalesce(c_custkey, k) AS key, coalesce(nonce, 0) AS nonce, coalesce(balance, CAST(round(c_acctbal * 100) AS BIGINT), 0) AS balance FROM customer FULL JOIN p ON c_custkey = k""")
def alloc_field_patch(spark, sf_dir):
    base = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.lit(0).cast("long").alias("nonce"), cents(F.col("c_acctbal")).alias("balance"))
    patch = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.count("*").alias("nonce"), F.max(F.when(F.col("o_orderpriority") == "1-URGENT", cents(F.col("o_totalprice")))).alias("balance"))
    return merge.patch_fields(base, patch, "key", ["nonce", "balance"], {"nonce": 0, "balance": 0})


@query("""WITH b AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'signup' AND value > 60), a AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND value > 180), k AS (SELECT DISTINCT conv_id AS user_id FROM conversations WHERE turn = 0 AND length(text) > 200),
c AS (SELECT user_id, (user_id IN (FROM b))::INT AS b, (user_id IN (FROM a))::INT AS a, (user_id IN (FROM k))::INT AS k FROM events)
SELECT CASE WHEN a + b + k = 0 THEN 'unknown' WHEN a + b + k > 1 THEN 'ambiguous' WHEN b = 1 THEN 'balance' WHEN a = 1 THEN 'allowance' ELSE 'metadata' END AS owner, count(*) AS slots, count(DISTINCT user_id) AS keys FROM c GROUP BY 1""")
def exactly_one_owner(spark, sf_dir):
    e, t = read(spark, sf_dir, "events"), read(spark, sf_dir, "conversations")
    out = merge.owners(
        e.select("user_id"), "user_id", balance=e.where("event_type = 'signup' AND value > 60"), allowance=e.where("event_type = 'purchase' AND value > 180"),
        metadata=t.where("turn = 0 AND length(text) > 200").select(F.col("conv_id").alias("user_id")),
    )
    return out.groupBy("owner").agg(F.count("*").alias("slots"), F.count_distinct("user_id").alias("keys"))


def _classes(spark, sf_dir) -> DataFrame:
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("address"), "c_mktsegment", cents(F.col("c_acctbal")).alias("amount"))
    c = c.withColumn("amount", F.when(F.col("amount") < 100000, 0).otherwise(F.col("amount")).cast("long"))
    sent = read(spark, sf_dir, "orders").where("o_orderstatus = 'O' AND o_totalprice > 0").select(F.col("o_custkey").alias("address")).distinct().withColumn("sent", F.lit(True))
    out = c.join(sent, "address", "left").withColumn("sent", F.coalesce("sent", F.lit(False)))
    return counts.classified(out, "amount", F.col("address") == 7, F.col("c_mktsegment").isin("MACHINERY", "BUILDING"), F.col("sent"))


CLASS_SQL = """
WITH c AS (SELECT c_custkey AS address, c_mktsegment IN ('MACHINERY', 'BUILDING') AS contract, CASE WHEN round(c_acctbal * 100) < 100000 THEN 0 ELSE CAST(round(c_acctbal * 100) AS BIGINT) END AS amount,
             c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 0) AS sent FROM customer),
b AS (SELECT *, CASE WHEN amount = 0 THEN 'zero' WHEN address = 7 THEN 'self' WHEN contract AND sent THEN 'retained' WHEN contract THEN 'converted' ELSE 'eoa' END AS class FROM c)
"""


@query(CLASS_SQL + "SELECT class, count(*) AS holders, CAST(sum(amount) AS BIGINT) AS amount FROM b GROUP BY class")
def balance_classification(spark, sf_dir):
    return _classes(spark, sf_dir).groupBy("class").agg(F.count("*").alias("holders"), F.sum("amount").alias("amount"))


@query(CLASS_SQL + """, t AS (SELECT CAST(sum(amount) AS BIGINT) AS total, CAST(coalesce(sum(amount) FILTER (class IN ('eoa', 'converted')), 0) AS BIGINT) AS migrated, CAST(coalesce(sum(amount) FILTER (class IN ('self', 'retained')), 0) AS BIGINT) AS remaining,
  CAST(coalesce(sum(amount) FILTER (class = 'self'), 0) AS BIGINT) AS self_balance, count(*) FILTER (class = 'eoa') AS eoas, count(*) FILTER (class = 'converted') AS converted_contracts, count(*) FILTER (class = 'retained') AS retained_contracts FROM b)
, s AS (SELECT CAST(sum(CASE WHEN round(c_acctbal * 100) < 100000 THEN 0 ELSE CAST(round(c_acctbal * 100) AS BIGINT) END) AS BIGINT) AS supply FROM customer)
SELECT t.*, supply, total - migrated = remaining AND total = supply AS conserved FROM t, s""")
def balance_conservation(spark, sf_dir):
    # the supply on record: summed by nation from the accounts, before anything is joined or classified
    money = cents(F.col("c_acctbal"))
    by_nation = read(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.sum(F.when(money < 100000, 0).otherwise(money)).alias("held"))
    supply = by_nation.agg(F.coalesce(F.sum("held"), F.lit(0))).scalar()
    out = counts.conservation(_classes(spark, sf_dir), "amount", F.lit(0)).withColumn("supply", supply.cast("decimal(38,0)"))
    out = out.withColumn("conserved", (F.col("total") - F.col("migrated") == F.col("remaining")) & (F.col("total") == F.col("supply")))
    return out.withColumns({c: F.col(c).cast("long") for c in ("total", "migrated", "remaining", "self_balance", "supply")})


@query("""WITH l AS (SELECT user_id AS address FROM events WHERE event_type = 'click' AND value > 120)
SELECT address, count(*) AS lines, count(*) = 1 AS is_unique, max(c_custkey) IS NOT NULL AS is_account, coalesce(bool_or(c_mktsegment IN ('MACHINERY', 'BUILDING')), false) AS is_contract FROM l LEFT JOIN customer ON c_custkey = address GROUP BY address""")
def retain_list_validation(spark, sf_dir):
    lines = read(spark, sf_dir, "events").where("event_type = 'click' AND value > 120").groupBy(F.col("user_id").alias("address")).agg(F.count("*").alias("lines"))
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("address"), F.lit(True).alias("there"), F.col("c_mktsegment").isin("MACHINERY", "BUILDING").alias("contract"))
    no = F.lit(False)
    return lines.join(c, "address", "left").select("address", "lines", (F.col("lines") == 1).alias("is_unique"), F.coalesce("there", no).alias("is_account"), F.coalesce("contract", no).alias("is_contract"))


@query("SELECT user_id AS address FROM events UNION SELECT o_custkey FROM orders UNION SELECT conv_id FROM conversations UNION SELECT 7")
def evidence_union(spark, sf_dir):
    parts = [read(spark, sf_dir, t).select(F.col(c).alias("address")) for t, c in (("events", "user_id"), ("orders", "o_custkey"), ("conversations", "conv_id"))]
    return parts[0].union(parts[1]).union(parts[2]).union(spark.range(7, 8).toDF("address")).distinct()


@query("""WITH h AS (SELECT event_id, event_type FROM events WHERE event_id >= 400), c AS (SELECT event_id, CASE WHEN value > 200 THEN upper(event_type) ELSE event_type END AS event_type FROM events WHERE event_id < 700)
SELECT coalesce(h.event_id, c.event_id) AS event_id, coalesce(c.event_type, h.event_type) AS event_type, coalesce(c.event_type <> h.event_type, false) AS conflict FROM h FULL JOIN c ON h.event_id = c.event_id""")
def hot_cold_merge(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    hot = e.where("event_id >= 400").select("event_id", "event_type")
    cold = e.where("event_id < 700").select("event_id", F.when(F.col("value") > 200, F.upper("event_type")).otherwise(F.col("event_type")).alias("event_type"))
    return merge.coalesce_copies(hot, cold, "event_id", "event_type")


def _chain(spark, sf_dir) -> DataFrame:
    """Each user's events as blocks: hash of own content; parent is the hash of the event before, wrong where the value is above 300."""
    e = read(spark, sf_dir, "events").select("user_id", "event_id", "ts", "value", digest(F.concat_ws(":", F.col("event_id").cast("string"), "event_type")).alias("hash"))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    before = F.coalesce(F.lag("hash").over(w), F.lit("0" * 64))
    return e.withColumn("parent", F.when(F.col("value") > 300, F.reverse(before)).otherwise(before))


CHAIN_SQL = f"""
WITH e AS (SELECT user_id, event_id, ts, value, sha256(event_id || ':' || event_type) AS hash FROM events),
p AS (SELECT *, coalesce(lag(hash) OVER (PARTITION BY user_id ORDER BY ts, event_id), '{"0" * 64}') AS before FROM e),
b AS (SELECT *, CASE WHEN value > 300 THEN reverse(before) ELSE before END AS parent FROM p)
"""


@query(CHAIN_SQL + "SELECT event_id, parent = before AS ok FROM b")
def parent_link_chain(spark, sf_dir):
    return order.linked(_chain(spark, sf_dir), ["user_id"], ["ts", "event_id"], "hash", "parent", F.lit("0" * 64)).select("event_id", "ok")


@query("""SELECT conv_id, min(turn) AS first, max(turn) AS last, count(*) AS n, count(DISTINCT turn) AS "distinct", min(turn) = 0 AND max(turn) - min(turn) + 1 = count(*) AND count(*) = count(DISTINCT turn) AS ok FROM conversations GROUP BY conv_id""")
def contiguity(spark, sf_dir):
    return order.contiguous(read(spark, sf_dir, "conversations"), ["conv_id"], "turn")


@query("""WITH e AS (SELECT user_id, event_id, ts, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS gas FROM events),
g AS (SELECT event_id, gas >= coalesce(lag(gas) OVER (PARTITION BY user_id ORDER BY ts, event_id), gas) AS ok FROM e) SELECT count(*) AS receipts, count(*) FILTER (NOT ok) AS decreasing FROM g""")
def monotone_gas(spark, sf_dir):
    e = order.running(read(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], gas=cents(F.col("value")))
    return order.increasing(e, ["user_id"], ["ts", "event_id"], "gas", strict=False).agg(F.count("*").alias("receipts"), F.count_if(~F.col("ok")).alias("decreasing"))


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, lag(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS before FROM lineitem)
SELECT count(*) AS slots, count(*) FILTER (before IS NOT NULL AND l_partkey <= before) AS out_of_order FROM l""")
def strictly_increasing_keys(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    out = order.increasing(rows, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], "l_partkey")
    return out.agg(F.count("*").alias("slots"), F.count_if(~F.col("ok")).alias("out_of_order"))


@query("""SELECT event_id, count(*) OVER w AS records, CAST(sum(strlen(props)) OVER w AS BIGINT) AS bytes, CAST(count(*) OVER w * 100 // count(*) OVER (PARTITION BY user_id) AS BIGINT) AS percent
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def running_progress(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("total", F.count("*").over(Window.partitionBy("user_id")))
    out = order.running(e, ["user_id"], ["ts", "event_id"], records=F.lit(1).cast("long"), bytes=F.octet_length("props").cast("long"))
    return out.select("event_id", "records", "bytes", F.floor(F.col("records") * 100 / F.col("total")).cast("long").alias("percent"))


@query("""SELECT event_type, count(*) AS events, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS amount, count(*) FILTER (value > 50) AS positive, min(event_id) AS first, max(event_id) AS last
FROM events WHERE event_type IN ('purchase', 'signup') GROUP BY event_type""")
def event_filter_decode(spark, sf_dir):
    e = read(spark, sf_dir, "events").where(F.col("event_type").isin("purchase", "signup"))
    amount = F.get_json_object("props", "$.k").cast("long")
    return e.groupBy("event_type").agg(F.count("*").alias("events"), F.sum(amount).alias("amount"), F.count_if(F.col("value") > 50).alias("positive"), F.min("event_id").alias("first"), F.max("event_id").alias("last"))


@query("""SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS position FROM events WHERE event_type = 'error' ORDER BY user_id, position""")
def ordered_coordinate_log(spark, sf_dir):
    e = read(spark, sf_dir, "events").where("event_type = 'error'")
    position = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("long")
    return e.select("user_id", "event_id", position.alias("position")).orderBy("user_id", "position")


@query("SELECT doc_id, sha256(coalesce(text, '')) AS digest FROM documents")
def content_hash(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("digest"))


@query("""WITH e AS (SELECT user_id, ts, event_id, upper(lpad(printf('%x', event_id), 16, '0')) AS c, upper(hex(event_type)) AS t FROM events)
SELECT user_id, sha256(unhex(string_agg('0000000000000008' || c || lpad(printf('%x', CAST(length(t) / 2 AS BIGINT)), 16, '0') || t, '' ORDER BY ts, event_id))) AS digest, count(*) AS n FROM e GROUP BY user_id""")
def framed_fold_digest(spark, sf_dir):
    return digests.fold_digest(read(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], codec.u64_be(F.col("event_id")), F.col("event_type").cast("binary"))


@query("""WITH RECURSIVE o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS r, role || coalesce(text, '') AS v FROM conversations),
c(conv_id, r, h) AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT), sha256('chain/v1') FROM conversations UNION ALL SELECT o.conv_id, o.r, sha256(c.h || o.v) FROM c JOIN o ON o.conv_id = c.conv_id AND o.r = c.r + 1)
SELECT conv_id, max_by(h, r) AS digest, max(r) AS n FROM c GROUP BY conv_id""")
def chained_digest(spark, sf_dir):
    return digests.chain_digest(read(spark, sf_dir, "conversations"), ["conv_id"], ["turn", "role", "text"], F.concat("role", F.coalesce("text", F.lit(""))), "chain/v1")


@query("""WITH l AS (SELECT CAST(o_orderkey AS VARCHAR) AS k, substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 2) AS p, sha256(o_orderkey || ':' || o_orderpriority) AS h FROM orders),
a AS (SELECT p, sha256(string_agg(h, '' ORDER BY k, h)) AS h, count(*) AS n FROM l GROUP BY p),
b AS (SELECT substr(p, 1, 1) AS p, sha256(string_agg(h, '' ORDER BY p)) AS h, sum(n) AS n FROM a GROUP BY 1)
SELECT sha256(string_agg(h, '' ORDER BY p)) AS digest, CAST(sum(n) AS BIGINT) AS n FROM b""")
def merkle_root_nibble(spark, sf_dir):
    return digests.tree_digest(read(spark, sf_dir, "orders"), F.col("o_orderkey").cast("string"), F.col("o_orderpriority"), depth=2)


@query("""WITH m AS (SELECT user_id, md5(event_type || ':' || CAST(event_id AS VARCHAR)) AS h FROM events)
SELECT user_id, bit_or((CAST(1 AS BIGINT) << (CAST('0x' || substr(h, 1, 4) AS INT) % 63)) | (CAST(1 AS BIGINT) << (CAST('0x' || substr(h, 5, 4) AS INT) % 63)) | (CAST(1 AS BIGINT) << (CAST('0x' || substr(h, 9, 4) AS INT) % 63))) AS bloom, count(*) AS items FROM m GROUP BY user_id""")
def bloom_or(spark, sf_dir):
    item = F.md5(F.concat_ws(":", "event_type", F.col("event_id").cast("string")).cast("binary"))
    return read(spark, sf_dir, "events").groupBy("user_id").agg(F.bit_or(digests.bloom_masks(item)).alias("bloom"), F.count("*").alias("items"))


@query("""WITH k AS (SELECT event_id, json_keys(props) AS names FROM events)
SELECT event_id, CAST(len(names) AS INTEGER) AS fields, len(list_distinct(names)) = len(names) AS no_duplicates, len(list_filter(names, lambda x: x <> 'k')) = 0 AS no_unknown, list_contains(names, 'k') AS complete FROM k""")
def strict_json_audit(spark, sf_dir):
    names = F.json_object_keys("props")
    e = read(spark, sf_dir, "events").select("event_id", names.alias("names"))
    return e.select("event_id", F.size("names").alias("fields"), (F.size(F.array_distinct("names")) == F.size("names")).alias("no_duplicates"), (F.size(F.array_except("names", F.array(F.lit("k")))) == 0).alias("no_unknown"), F.array_contains("names", "k").alias("complete"))


@query("""SELECT p_partkey, '0x' || lower(hex(p_name)) AS encoded, p_name AS decoded, lpad(lower(hex(p_partkey)), 16, '0') AS key_hex, p_partkey AS number FROM part""")
def hex_and_u64_codec(spark, sf_dir):
    text, key = codec.hex_text(F.col("p_name").cast("binary")), codec.u64_be(F.col("p_partkey"))
    return read(spark, sf_dir, "part").select("p_partkey", text.alias("encoded"), codec.from_hex(text).cast("string").alias("decoded"), F.lower(F.hex(key)).alias("key_hex"), codec.u64_from_be(key).cast("long").alias("number"))


@query("""WITH a AS (SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN '0x' || substr(sha256(p_name), 1, 40) WHEN 'PROMO' THEN '0X' || substr(sha256(p_name), 1, 40) WHEN 'SMALL' THEN '0x' || upper(substr(sha256(p_name), 1, 40)) WHEN 'LARGE' THEN '0x' || substr(sha256(p_name), 1, 39) ELSE p_name END AS t FROM part)
SELECT p_partkey, regexp_full_match(t, '0x[0-9a-fA-F]{40}') AS valid, CASE WHEN regexp_full_match(t, '0x[0-9a-fA-F]{40}') THEN lower(substr(t, 3)) END AS address FROM a""")
def address_parse(spark, sf_dir):
    h = F.sha2(F.col("p_name").cast("binary"), 256)
    text = (
        F.when(F.col("p_type") == "ECONOMY", F.concat(F.lit("0x"), F.substring(h, 1, 40))).when(F.col("p_type") == "PROMO", F.concat(F.lit("0X"), F.substring(h, 1, 40)))
        .when(F.col("p_type") == "SMALL", F.concat(F.lit("0x"), F.upper(F.substring(h, 1, 40)))).when(F.col("p_type") == "LARGE", F.concat(F.lit("0x"), F.substring(h, 1, 39))).otherwise(F.col("p_name"))
    )
    a = read(spark, sf_dir, "part").select("p_partkey", codec.address(text).alias("a"))
    return a.select("p_partkey", F.col("a").isNotNull().alias("valid"), F.lower(F.hex("a")).alias("address"))


@query(INVENTORY_SQL + """SELECT CASE WHEN starts_with(key, 'meta-') THEN 'metadata' WHEN key = content THEN 'node' WHEN length(key) = 64 THEN 'code' ELSE 'foreign' END AS kind, count(*) AS keys, CAST(sum(strlen(value)) AS BIGINT) AS bytes FROM s GROUP BY 1""")
def inventory_by_kind(spark, sf_dir):
    kind = F.when(F.col("key").startswith("meta-"), "metadata").when(F.col("key") == F.col("content"), "node").when(F.length("key") == 64, "code").otherwise("foreign")
    return counts.inventory(_inventory(spark, sf_dir), kind, F.octet_length("value").cast("long"))


@query("""SELECT CASE WHEN l_orderkey % 2 = 0 THEN 'hash' ELSE 'path' END AS layout, count(DISTINCT CASE WHEN l_orderkey % 2 = 0 THEN sha256(CAST(l_partkey AS VARCHAR)) ELSE '4f' || lpad(lower(hex(l_orderkey)), 16, '0') || lpad(lower(hex(l_partkey)), 16, '0') END) AS keys, count(*) AS rows FROM lineitem GROUP BY 1""")
def layout_keys(spark, sf_dir):
    path = F.concat(F.lit(bytearray(b"O")), codec.u64_be(F.col("l_orderkey")), codec.u64_be(F.col("l_partkey")))
    by_hash = F.col("l_orderkey") % 2 == 0
    key = F.when(by_hash, digest(F.col("l_partkey"))).otherwise(F.lower(F.hex(path)))
    return read(spark, sf_dir, "lineitem").groupBy(F.when(by_hash, "hash").otherwise("path").alias("layout")).agg(F.count_distinct(key).alias("keys"), F.count("*").alias("rows"))


@query("""SELECT l_suppkey, count(*) AS slots, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS amount FROM lineitem GROUP BY l_suppkey""")
def skew_probe(spark, sf_dir):
    rows = order.split_families(read(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_extendedprice"), "l_suppkey", "l_partkey", limit=512)
    part = rows.groupBy("l_suppkey", "part").agg(F.count("*").alias("slots"), F.sum(cents(F.col("l_extendedprice"))).alias("amount"))
    return part.groupBy("l_suppkey").agg(F.sum("slots").alias("slots"), F.sum("amount").alias("amount"))


@query("""WITH g AS (SELECT CAST(coalesce(sum(CAST(round(o_totalprice * 100) AS BIGINT)), 0) AS BIGINT) AS balances, count(*) AS slots FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'),
t AS (SELECT CAST(coalesce(sum(CAST(round(o_totalprice * 100) AS BIGINT)), 0) AS BIGINT) AS balances, count(*) AS slots FROM orders),
d AS (SELECT CAST(coalesce(sum(CAST(round(o_totalprice * 100) AS BIGINT)), 0) AS BIGINT) AS added FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01')
SELECT g.balances AS genesis_balances, t.balances AS target_balances, d.added AS added, t.balances - g.balances - d.added AS difference, g.slots AS genesis_slots, t.slots AS target_slots FROM g, t, d""")
def audit_reconciliation(spark, sf_dir):
    early = F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")
    money = cents(F.col("o_totalprice"))
    total = lambda cond: F.coalesce(F.sum(F.when(cond, money)), F.lit(0)).cast("long")
    out = read(spark, sf_dir, "orders").agg(total(early).alias("genesis_balances"), total(F.lit(True)).alias("target_balances"), total(~early).alias("added"), F.count_if(early).alias("genesis_slots"), F.count("*").alias("target_slots"))
    return out.withColumn("difference", F.col("target_balances") - F.col("genesis_balances") - F.col("added"))


@query("SELECT c_custkey FROM customer WHERE c_mktsegment IN ('MACHINERY', 'BUILDING') AND c_custkey IN (SELECT user_id FROM events WHERE event_type = 'click')")
def contracts_in_retain_list(spark, sf_dir):
    listed = read(spark, sf_dir, "events").where("event_type = 'click'").select(F.col("user_id").alias("c_custkey")).distinct()
    return read(spark, sf_dir, "customer").where(F.col("c_mktsegment").isin("MACHINERY", "BUILDING")).join(listed, "c_custkey", "left_semi").select("c_custkey")


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS r FROM lineitem),
p AS (SELECT l_orderkey, r, CASE WHEN l_linenumber <= 2 THEN l_partkey END AS code FROM l)
SELECT l_orderkey, r AS seq, coalesce(max(CASE WHEN code IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY l_orderkey ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) = 1 AS code_provided FROM p""")
def code_already_provided(spark, sf_dir):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    rows = read(spark, sf_dir, "lineitem")
    has = F.max(F.when(F.col("l_linenumber") <= 2, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)) == 1
    return rows.select("l_orderkey", F.row_number().over(w).cast("long").alias("seq"), has.alias("code_provided"))


@query(f"SELECT p_partkey, {sql.keccak('lower(hex(encode(p_name)))')} AS digest FROM part")
def keccak_digests(spark, sf_dir):
    """Keccak-256; the SQL permutes the state lane by lane."""
    from ledgerloom.functions.keccak import keccak256

    return read(spark, sf_dir, "part").select("p_partkey", F.lower(F.hex(keccak256(F.col("p_name").cast("binary")))).alias("digest"))


_FRAME = " || ".join(f"lpad(lower(to_base(strlen({c}), 16)), 16, '0') || lower(hex(encode({c})))" for c in ("CAST(o_custkey % 7 AS VARCHAR)", "o_orderpriority"))


@query(f"""WITH d AS (SELECT sha256(unhex({_FRAME})) AS d FROM orders),
e AS (SELECT c, sha256(unhex(d || lpad(to_base(c, 16), 8, '0'))) AS h FROM (SELECT d, unnest(range(0, 4)) AS c FROM d)),
l AS (SELECT CAST(16 * c + k AS INTEGER) AS lane, CAST('0x' || substr(h, 4 * k + 1, 4) AS BIGINT) AS v FROM (SELECT c, h, unnest(range(0, 16)) AS k FROM e))
SELECT lane, CAST(sum(v) % 65536 AS BIGINT) AS value FROM l GROUP BY lane""")
def multiset_lanes(spark, sf_dir):
    """The digest of a table as a multiset, in 64 lanes: rows come in any order, and some of them several times."""
    rows = read(spark, sf_dir, "orders")
    return digests.multiset_lanes(rows, (F.col("o_custkey") % 7).cast("string").cast("binary"), F.col("o_orderpriority").cast("binary"), lanes=64)


_LINE_KEY = sql.keccak("sha256(l_orderkey || ':' || l_linenumber)")


@query(f"""WITH RECURSIVE lines AS (SELECT l_suppkey, l_orderkey, l_linenumber, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS amount FROM lineitem GROUP BY ALL),
leaves AS (SELECT l_suppkey AS owner, {_LINE_KEY} AS key, '88' || lpad(lower(to_base(amount, 16)), 16, '0') AS value FROM lines),{sql.trie_roots("leaves")}
SELECT owner AS l_suppkey, root, n AS slots FROM roots""")
def storage_trie_roots(spark, sf_dir):
    """A Merkle Patricia root for each supplier: keys are digests of its lines, values their encoded amounts."""
    from ledgerloom.functions.keccak import keccak256
    from ledgerloom.plans.trie import trie_roots

    rows = read(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_orderkey", "l_linenumber").agg(F.sum(cents(F.col("l_extendedprice"))).alias("amount"))
    key = F.unhex(F.sha2(F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).cast("binary"), 256))
    value = F.concat(F.unhex(F.lit("88")), codec.u64_be(F.col("amount")))
    roots = trie_roots(rows.select(codec.u64_be(F.col("l_suppkey")).alias("owner"), keccak256(key).alias("key"), value.alias("value")))
    return roots.select(codec.u64_from_be(F.col("owner")).cast("long").alias("l_suppkey"), F.lower(F.hex("root")).alias("root"), F.col("n").alias("slots"))


from ledgerloom.plans import formats  # noqa: E402, F401  registers the queries that go through the byte formats
