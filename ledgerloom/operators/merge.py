"""Merges of keyed relations: difference with roles, overlay with tombstones, field patches, fallbacks, ownership."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RETAIN, DELETE, UNKNOWN, PROTECT, MISSING, CONFLICT = "retain", "delete", "unknown", "protect", "missing", "conflict"


def ordered_diff(source: DataFrame, keep: DataFrame, key: str, value: str, addressed: Column, content: Column | None = None) -> DataFrame:
    """source full outer join keep on key, each row with its role.

    Equal on both sides: retain; different values: conflict; only kept: missing; only in the source: delete if the key
    is content-addressed and `content` (the key that the value should have) says so, unknown if it should but does not,
    protect otherwise. conflict and missing rows are for a check to refuse. One shuffle a side, on the key.
    """
    k = keep.select(F.col(key).alias("__k"), F.col(value).alias("__v"))
    joined = source.join(k, source[key] == F.col("__k"), "full_outer")
    content = F.lit(True) if content is None else content
    role = (
        F.when(source[key].isNull(), MISSING)
        .when(F.col("__k").isNotNull(), F.when(source[value].eqNullSafe(F.col("__v")), RETAIN).otherwise(CONFLICT))
        .when(addressed, F.when(content, DELETE).otherwise(UNKNOWN)).otherwise(PROTECT)
    )
    return joined.withColumn("role", role).withColumn(key, F.coalesce(source[key], F.col("__k"))).drop("__k", "__v")


def overlay(base: DataFrame, patch: DataFrame, key: str, value: str, tombstone: Column) -> DataFrame:
    """base full outer join patch: the patch's value wins; rows whose patch is a tombstone go."""
    p = patch.select(F.col(key).alias("__k"), F.col(value).alias("__v"), tombstone.alias("__t"))
    out = base.select(key, value).join(p, F.col(key) == F.col("__k"), "full_outer").where(~F.coalesce("__t", F.lit(False)))
    return out.select(F.coalesce(key, "__k").alias(key), F.when(F.col("__k").isNotNull(), F.col("__v")).otherwise(F.col(value)).alias(value))


def patch_fields(base: DataFrame, patch: DataFrame, key: str, fields: list[str], defaults: dict | None = None) -> DataFrame:
    """Each field from the patch where it has one, else from the base, else its default; keys of either side stay."""
    defaults = defaults or {}
    p = patch.select(F.col(key).alias("__k"), *[F.col(f).alias(f"__{f}") for f in fields])
    out = base.select(key, *fields).join(p, F.col(key) == F.col("__k"), "full_outer")
    return out.select(F.coalesce(key, "__k").alias(key), *[F.coalesce(f"__{f}", f, F.lit(defaults.get(f))).alias(f) for f in fields])


def coalesce_copies(hot: DataFrame, cold: DataFrame, key: str, value: str) -> DataFrame:
    """Two copies of a history: key, value (the cold one first), conflict (both are there and differ)."""
    h, c = hot.select(key, F.col(value).alias("__h")), cold.select(F.col(key).alias("__k"), F.col(value).alias("__c"))
    out = h.join(c, F.col(key) == F.col("__k"), "full_outer")
    return out.select(F.coalesce(key, "__k").alias(key), F.coalesce("__c", "__h").alias(value), F.coalesce(F.col("__c") != F.col("__h"), F.lit(False)).alias("conflict"))


def lookup(rows: DataFrame, key: str, *layouts: tuple[DataFrame, str, str], name: str = "found") -> DataFrame:
    """rows with the first value found for key in the layouts (relation, its key, its value), null if none has it."""
    out = rows
    for n, (relation, k, v) in enumerate(layouts):
        side = relation.select(F.col(k).alias(f"__k{n}"), F.col(v).alias(f"__v{n}"))
        out = out.join(side, F.col(key) == F.col(f"__k{n}"), "left")
    return out.withColumn(name, F.coalesce(*[F.col(f"__v{n}") for n in range(len(layouts))])).drop(*[f"__{c}{n}" for n in range(len(layouts)) for c in "kv"])


def owners(slots: DataFrame, key: str, **evidence: DataFrame) -> DataFrame:
    """slots with owner: the one relation of evidence that has the key; 'unknown' for none, 'ambiguous' for several."""
    out = slots
    for name, relation in evidence.items():
        side = relation.select(F.col(key).alias(f"__{name}")).distinct()
        out = out.join(side, F.col(key) == F.col(f"__{name}"), "left")
    count = reduce(lambda a, b: a + b, [F.col(f"__{n}").isNotNull().cast("int") for n in evidence])
    first = F.coalesce(*[F.when(F.col(f"__{n}").isNotNull(), n) for n in evidence])
    return out.withColumn("owner", F.when(count == 1, first).when(count == 0, "unknown").otherwise("ambiguous")).drop(*[f"__{n}" for n in evidence])


def inventory_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one side has more often than the other, with side 'left' or 'right'; empty if the multisets are equal."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def expected_once(rows: DataFrame, expected: DataFrame, key: str, value: str) -> DataFrame:
    """key, found, fault of each of the few expected (key, value): it must be among the rows exactly once, and with its value.

    Only rows with an expected key leave the scan: the expected ones are sent to it.
    """
    want = expected.select(F.col(key).alias("__k"), F.col(value).alias("__v"))
    met = rows.join(F.broadcast(want), rows[key] == F.col("__k")).groupBy("__k").agg(F.count("*").alias("found"), F.count_if(F.col(value).eqNullSafe(F.col("__v"))).alias("__same"))
    out = want.join(met, "__k", "left").withColumn("found", F.coalesce("found", F.lit(0)))
    fault = F.when(F.col("found") == 0, "missing").when(F.col("found") > 1, "twice").when(F.col("__same") == 0, "another value")
    return out.select(F.col("__k").alias(key), "found", fault.alias("fault"))


def common(a: DataFrame, b: DataFrame) -> DataFrame:
    """The distinct rows that both have."""
    return a.intersect(b)
