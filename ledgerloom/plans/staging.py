"""Intermediate tables in the folder that driver and executors share, and folders that appear at once or not at all."""

from __future__ import annotations

import contextlib
import ctypes
import errno
import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Paths of the tables staged within the scopes that are open, the innermost last; and names of those in the catalogue, by path.
_SCOPES: list[list[str]] = []
_NAMED: dict[str, str] = {}
#: Rows that a task of Python work takes at least.
ROWS = 1 << 11
#: Rows of a table that by_slices goes through together.
SLICED = 1 << 22
#: Whether what a query has shuffled goes when it ends, instead of when the driver's memory is next cleared.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Of Linux's renameat2: the target must not exist; the folder that relative paths start from.
NOREPLACE, HERE = 1, -100


def shared_dir(spark: SparkSession) -> str:
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="ledgerloom-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def tasks_for(spark: SparkSession, rows: int) -> int:
    """How many tasks to deal rows over by whose number, not bytes, the work goes; a partition number that is given is not made smaller by adaptive execution."""
    return max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // ROWS))


def staged(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """df written as Parquet and read again: cuts lineage, and survives lost executors. keep: it stays when the scope that is open ends, as part of the one around it."""
    path = _new_path(df.sparkSession, name, keep)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_by(df: DataFrame, name: str, key: str) -> DataFrame:
    """The same as a table that is bucketed and sorted by a key: joins on the key shuffle their other side only."""
    spark = df.sparkSession
    path = _new_path(spark, name)
    buckets, table = int(spark.conf.get("spark.sql.shuffle.partitions")), path.rpartition("/")[2].replace("-", "_")
    _NAMED[path] = table
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return spark.table(table)


def _new_path(spark: SparkSession, name: str, keep: bool = False) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if len(_SCOPES) > keep:
        _SCOPES[-1 - keep].append(path)
    return path


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Tables staged within are removed at its end, whatever ended it; DataFrames that rest on them must not leave it."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            if table := _NAMED.pop(path, None):
                spark.sql(f"DROP TABLE IF EXISTS {table}")
            remove(spark, path)


@contextlib.contextmanager
def shuffles_go(spark: SparkSession):
    """What a query within has shuffled goes when it ends."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def by_slices(table: DataFrame, key: str, name: str, of: Callable[[DataFrame, Callable], DataFrame]) -> DataFrame:
    """The rows of of(slice, own) for all slices of table's keys, one after another, so that disk and tasks are those of one slice, however large the table.

    A key's rows are in one slice; own(df, key) gives the rows of another table whose keys are that slice's, also those
    that table lacks. A slice has about SLICED rows, or those of its largest key. Its results are written before the next begins, and what it
    staged and shuffled goes. The table is read once to be counted and once to be dealt.
    """
    spark, out = table.sparkSession, _new_path(table.sparkSession, name)
    number = table.count() // SLICED + 1
    slice_of = lambda c: F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(number)).cast("int")
    with scratch(spark), shuffles_go(spark):
        if number > 1:
            dealt = _new_path(spark, f"{name}-dealt")
            rows = table.withColumn("slice", slice_of(key))
            rows.write.option("compression", "zstd").partitionBy("slice").parquet(dealt)
            table = spark.read.schema(rows.schema).parquet(dealt)
        for k in range(number):
            with scratch(spark):
                part = table.where(F.col("slice") == k).drop("slice") if number > 1 else table
                done = of(part, lambda df, c, k=k: df.where(slice_of(c) == k))
                done.write.mode("append").option("compression", "zstd").parquet(out)
                schema = done.schema
    return spark.read.schema(schema).parquet(out)


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _hadoop(spark, path)
    return fs.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    at, fs = _hadoop(spark, path)
    fs.delete(at, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new small file; one that exists is not replaced."""
    at, fs = _hadoop(spark, path)
    out = fs.create(at, False)
    try:
        out.write(bytearray(text.encode()))
        out.hsync()
    finally:
        out.close()


def read_text(spark: SparkSession, path: str, most: int = 1 << 20) -> str:
    """A file of at most so many bytes."""
    at, fs = _hadoop(spark, path)
    if fs.getFileStatus(at).getLen() > most:
        raise ValueError(f"{path} has over {most} bytes")
    data = fs.open(at)
    try:
        return bytes(data.readAllBytes()).decode()
    finally:
        data.close()


def names_in(spark: SparkSession, path: str) -> set[str]:
    at, fs = _hadoop(spark, path)
    return {s.getPath().getName() for s in fs.listStatus(at)}


def rename_new(source: str, target: str) -> None:
    """Renames a local folder to one that does not exist; one that appears meanwhile is left alone, even if it is empty."""
    libc = ctypes.CDLL(None, use_errno=True)
    call = getattr(libc, "renameat2", None)
    if call is not None:
        if call(HERE, os.fsencode(source), HERE, os.fsencode(target), NOREPLACE) == 0:
            return
        code = ctypes.get_errno()
        if code in (errno.EEXIST, errno.ENOTEMPTY):
            raise FileExistsError(target)
        if code not in (errno.ENOSYS, errno.EINVAL):
            raise OSError(code, os.strerror(code), target)
    os.mkdir(target)  # fails if it is there; from then on it is ours to replace
    os.rename(source, target)


@contextlib.contextmanager
def appearing(spark: SparkSession, target: str):
    """Gives a path beside the target to write to; at the end without an error it becomes the target in one rename, which replaces nothing. Otherwise it goes."""
    if exists(spark, target):
        raise FileExistsError(target)
    parent, _, name = target.rstrip("/").rpartition("/")
    part = f"{parent}/{name}.partial-{uuid.uuid4().hex}"
    try:
        yield part
        at, fs = _hadoop(spark, part)
        if fs.getScheme() == "file":
            rename_new(*(_hadoop(spark, p)[0].toUri().getPath() for p in (part, target)))
        else:
            jvm = spark.sparkContext._jvm
            to, _ = _hadoop(spark, target)
            none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(at, to, none)
    except BaseException:
        remove(spark, part)
        raise
