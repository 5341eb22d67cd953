"""Key-value inventories: logical dumps, Parquet, point and range reads."""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.codec import with_prefix
from ledgerloom.sources import lsm

SCHEMA = "key binary, value binary"


def is_store(path: str) -> bool:
    """Whether a folder is that of a store of log-structured tables."""
    return os.path.lexists(f"{path}/CURRENT")


def read_kv(spark: SparkSession, path: str) -> DataFrame:
    """Parquet of (key, value), or a store of log-structured tables. Reading never changes it."""
    return lsm.read_lsm(spark, path) if is_store(path) else spark.read.schema(SCHEMA).parquet(path)


def point_reader(spark: SparkSession, path: str):
    """A function of a key to its value; of a store only the tables and blocks that may have it are read."""
    if is_store(path):
        return lambda key: get(lsm.read_lsm(spark, path, key, key + b"\0"), key)
    return lambda key: get(read_kv(spark, path), key)


def read_logical(spark: SparkSession, path: str) -> DataFrame:
    """A small JSON object of 0x hex keys and values; doubled keys are refused."""

    def unique(pairs):
        if len({k for k, _ in pairs}) != len(pairs):
            raise ValueError("a key occurs twice")
        return dict(pairs)

    data = json.loads(Path(path).read_text(), object_pairs_hook=unique)
    return spark.createDataFrame([(bytearray.fromhex(k[2:]), bytearray.fromhex(v[2:])) for k, v in data.items()], SCHEMA)


def get(kv: DataFrame, key: bytes) -> bytes | None:
    """One value; None if the key is absent (an empty value is b"")."""
    rows = kv.where(F.col("key") == F.lit(bytearray(key))).take(2)
    if len(rows) > 1:
        raise ValueError("a key occurs twice")
    return bytes(rows[0]["value"]) if rows else None


def scan(kv: DataFrame, prefix: bytes = b"", start: bytes = b"", ordered: bool = True) -> DataFrame:
    """Keys that begin with prefix, from prefix + start on; a range that reaches the Parquet scan's statistics."""
    out = kv.where(with_prefix(F.col("key"), prefix, start)) if prefix or start else kv
    return out.orderBy("key") if ordered else out
