"""What the operators of this subpackage share: reading, staging, names, and joins on keys that may be hot."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; only where that is unset, as in tests, one of our own."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        at = known.get() if known.isDefined() else None
    if not at:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="ledgerloom-")
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


#: Paths of the tables staged within the scopes that are open, the innermost last.
_SCOPES: list[list[str]] = []


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet to the shared folder and read again: cuts lineage, and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def unstaged(df: DataFrame) -> None:
    """Removes the table of staged(), of which nothing more is read."""
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        remove(df.sparkSession, path)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Tables staged within are removed at its end, whatever ended it: what rests on them must have been written by then."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            remove(spark, path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have, so that extra columns of any name do no harm."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name


def text_of(df: DataFrame) -> Column:
    return F.coalesce(df["text"], F.lit(""))


def text_digest(df: DataFrame) -> Column:
    """A digest that stands for a row's text; a null one is empty."""
    return F.sha2(text_of(df).cast("binary"), 256)


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def let(value: Column, use) -> Column:
    """use(value), where value is worked out once: within a lambda an expression from outside would be once a call."""
    return F.element_at(F.transform(F.array(value), use), 1)


#: Elements of a block of a running total.
RUN_BLOCK = 64


def before(values: Column, kind: str = "int", step=lambda a, b: a + b, levels: int = 2) -> Column:
    """For each element of an array what `step` makes of all before it, from nought on: running sums, or running maxima.

    By blocks of RUN_BLOCK, whose own totals are summed up in the same way: time is linear, where an array that grows by
    an element is copied each time.
    """
    zero, none = F.lit(0).cast(kind), F.expr(f"cast(array() as array<{kind}>)")

    def plain(a: Column) -> Column:
        return F.aggregate(a, F.struct(zero.alias("at"), none.alias("out")), lambda acc, x: F.struct(step(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    def go(a: Column, level: int) -> Column:
        if not level:
            return plain(a)
        blocks = F.transform(F.sequence(F.lit(0), F.size(a) - 1, F.lit(RUN_BLOCK)), lambda i: F.slice(a, i + 1, RUN_BLOCK))

        def joined(parts: Column) -> Column:
            totals = F.transform(parts, lambda b: F.aggregate(b, zero, step))
            return let(let(totals, lambda t: go(t, level - 1)), lambda from_: F.flatten(F.transform(parts, lambda b, i: F.transform(plain(b), lambda x: step(x, F.element_at(from_, i + 1))))))

        return F.when(F.size(a) <= RUN_BLOCK, plain(a)).otherwise(let(blocks, joined))

    return let(values, lambda a: go(a, levels))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Whole texts go to Python in Arrow batches of so many rows at most, so that a batch of long ones fits into memory."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def shuffles_go(spark: SparkSession) -> None:
    """From now on what a query has shuffled goes when it ends, instead of when the driver's memory is next cleared; the setting stays."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def summed_before(df: DataFrame, order: list, **sums: Column) -> DataFrame:
    """df with the sums, by name, over all rows that come before in an order of unique rows.

    Rows are sorted into ranges, a task each; what lies before a range is summed over the ranges' totals, one row each.
    """
    part = fresh(df, "range")
    rows = staged(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "ranges")
    totals = rows.groupBy(part).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    ahead = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col(part).alias("__of"), *[F.coalesce(F.sum(n).over(ahead), F.lit(0)).alias(f"__{n}") for n in sums])
    within = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = rows.withColumns({n: F.coalesce(F.sum(c).over(within), F.lit(0)) for n, c in sums.items()}).join(F.broadcast(totals), F.col(part) == F.col("__of"))
    return out.withColumns({n: F.col(n) + F.col(f"__{n}") for n in sums}).select(*df.columns, *sums)


#: A key is heavy when it holds over one row in so many; there are fewer heavy keys than that, whatever the input.
HEAVY_SHARE = 4096


def join_weighted(rows: DataFrame, keyed: DataFrame, key: str, weight: str) -> DataFrame:
    """rows left join keyed on key, where keyed has one row a key and in `weight` how many of rows have it.

    Heavy keys (at most HEAVY_SHARE of them, by pigeonhole) are broadcast, so that their rows stay where they are;
    the others are joined by a shuffle in which no key has more than 1/HEAVY_SHARE of the rows.
    """
    total = keyed.agg(F.sum(weight)).first()[0] or 0
    limit = max(total // HEAVY_SHARE, 1000)
    heavy = F.col(weight) > limit
    hot = keyed.where(heavy).drop(weight)
    cold = keyed.where(~heavy).drop(weight)
    if not hot.take(1):
        return rows.join(cold, key, "left")
    ids = F.broadcast(hot.select(key))
    return rows.join(F.broadcast(hot), key).unionByName(rows.join(ids, key, "left_anti").join(cold, key, "left"))
