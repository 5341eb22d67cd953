"""Count vectors of a snapshot, inventories by kind, conservation of balances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COUNTS = ("accounts", "storage_slots", "code_references", "code_records", "records", "payload_bytes")


def state_counts(accounts: DataFrame, slots: DataFrame, code: DataFrame, payloads: dict[str, Column], code_ref: str, code_key: str, by: list[str] | None = None) -> DataFrame:
    """One row of COUNTS (or one for each of `by`, columns of all three): each relation is summed on its own, and the sums added.

    payloads: the bytes of a row of 'accounts', 'slots' and 'code'. A code counts once, where it is referenced.
    """
    by = by or []
    zero = F.lit(0).cast("long")
    a = accounts.select(*by, F.lit(1).alias("accounts"), zero.alias("storage_slots"), F.col(code_ref).isNotNull().cast("long").alias("code_references"), zero.alias("code_records"), payloads["accounts"].alias("payload_bytes"))
    s = slots.select(*by, zero.alias("accounts"), F.lit(1).alias("storage_slots"), zero.alias("code_references"), zero.alias("code_records"), payloads["slots"].alias("payload_bytes"))
    used = accounts.select(F.col(code_ref).alias(code_key)).where(F.col(code_key).isNotNull()).distinct()
    c = code.join(used, code_key, "left_semi").select(*by, zero.alias("accounts"), zero.alias("storage_slots"), zero.alias("code_references"), F.lit(1).alias("code_records"), payloads["code"].alias("payload_bytes"))
    every = a.unionByName(s).unionByName(c)
    out = every.groupBy(*by).agg(*[F.coalesce(F.sum(n), zero).cast("long").alias(n) for n in COUNTS if n != "records"])
    return out.withColumn("records", F.col("accounts") + F.col("storage_slots") + F.col("code_records")).select(*by, *COUNTS)


def count_checks(counts: DataFrame) -> DataFrame:
    """The relationships that a count vector must have, one boolean each."""
    return counts.select(
        (F.col("records") == F.col("accounts") + F.col("storage_slots") + F.col("code_records")).alias("records_add_up"),
        (F.col("code_records") <= F.col("code_references")).alias("code_is_referenced"),
        (F.col("code_references") <= F.col("accounts")).alias("references_have_accounts"),
        (F.col("payload_bytes") >= F.col("records")).alias("payloads_are_not_empty"),
    )


def inventory(rows: DataFrame, kind: Column, size: Column) -> DataFrame:
    """kind, keys, bytes."""
    return rows.groupBy(kind.alias("kind")).agg(F.count("*").alias("keys"), F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("bytes"))


def role_totals(rows: DataFrame, size: Column) -> DataFrame:
    """One row: keys and bytes of what is kept, protected, deleted and unknown; protected holds kept and unknown rows too."""
    role = F.col("role")
    parts = {"keep": role == "retain", "protected": role != "delete", "candidates": role == "delete", "unknown": role == "unknown"}
    return rows.agg(*[x for name, cond in parts.items() for x in (F.count_if(cond).alias(f"{name}_keys"), F.coalesce(F.sum(F.when(cond, size)), F.lit(0)).cast("long").alias(f"{name}_bytes"))])


def classified(balances: DataFrame, amount: str, own: Column, contract: Column, retained: Column) -> DataFrame:
    """balances with class: zero, self, retained, converted or eoa. Holders without code convert whatever they have sent."""
    cls = F.when(F.col(amount) == 0, "zero").when(own, "self").when(contract & retained, "retained").when(contract, "converted").otherwise("eoa")
    return balances.withColumn("class", cls)


def conservation(classes: DataFrame, amount: str, supply: Column) -> DataFrame:
    """One row: total, migrated, remaining, own, counts by class, and whether nothing was gained or lost against supply."""
    of = lambda *names: F.coalesce(F.sum(F.when(F.col("class").isin(*names), F.col(amount))), F.lit(0)).cast("decimal(38,0)")
    out = classes.agg(
        F.coalesce(F.sum(amount), F.lit(0)).cast("decimal(38,0)").alias("total"), of("eoa", "converted").alias("migrated"), of("self", "retained").alias("remaining"), of("self").alias("self_balance"),
        F.count_if(F.col("class") == "eoa").alias("eoas"), F.count_if(F.col("class") == "converted").alias("converted_contracts"), F.count_if(F.col("class") == "retained").alias("retained_contracts"),
        F.coalesce(F.first(supply), F.lit(0)).cast("decimal(38,0)").alias("supply"),
    )
    return out.withColumn("conserved", (F.col("total") - F.col("migrated") == F.col("remaining")) & (F.col("total") == F.col("supply")))
