"""Checks that a reader would make in one ordered pass, as windows: order, contiguity, links, first references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _over(by: list[str], order: list) -> Window:
    return Window.partitionBy(*by).orderBy(*order)


def increasing(rows: DataFrame, by: list[str], order: list, value: str, strict: bool = True) -> DataFrame:
    """rows with ok: whether value is above (strict) or not below that of the row before."""
    before = F.lag(value).over(_over(by, order))
    ok = F.col(value) > before if strict else F.col(value) >= before
    return rows.withColumn("ok", before.isNull() | ok)


def not_increasing(rows: DataFrame, number: str, value: str, span: int = 1 << 16) -> DataFrame:
    """Pairs (value, before) of rows next to each other by `number` whose value is not above the one before; empty if all rise.

    Rows are compared within ranges of `span` numbers, and the ranges' ends apart: those are one row a range.
    """
    part = rows.select(F.floor(F.col(number) / span).alias("__range"), F.col(number).alias("__n"), F.col(value).alias("__v"))
    inner = part.select("__v", F.lag("__v").over(_over(["__range"], ["__n"])).alias("__before"))
    ends = part.groupBy("__range").agg(F.min_by("__v", "__n").alias("__v"), F.max_by("__v", "__n").alias("__last"))
    outer = ends.select("__v", F.lag("__last").over(_over([], ["__range"])).alias("__before"))
    return inner.unionByName(outer).where("__v <= __before").select(F.col("__v").alias("value"), F.col("__before").alias("before"))


def rates(rows: DataFrame, by: list[str], order: list, seconds: str, total: Column, **measures: Column) -> DataFrame:
    """rows with running totals, the share of `total` that the first measure has reached, in percent, and its rate a second."""
    first = next(iter(measures))
    out = running(rows, by, order, **measures)
    return out.withColumn("percent", F.try_divide(100.0 * F.col(first), total)).withColumn("rate", F.try_divide(F.col(first).cast("double"), F.col(seconds)))


def contiguous(rows: DataFrame, by: list[str], number: str, start: int = 0) -> DataFrame:
    """by, first, last, rows, ok: whether the numbers go from `start` on without a gap or a repetition."""
    out = rows.groupBy(*by).agg(F.min(number).alias("first"), F.max(number).alias("last"), F.count("*").alias("n"), F.count_distinct(number).alias("distinct"))
    return out.withColumn("ok", (F.col("first") == start) & (F.col("last") - F.col("first") + 1 == F.col("n")) & (F.col("n") == F.col("distinct")))


def linked(rows: DataFrame, by: list[str], order: list, own: str, parent: str, genesis: Column) -> DataFrame:
    """rows with ok: whether parent is `own` of the row before, and `genesis` at the first."""
    return rows.withColumn("ok", F.col(parent).eqNullSafe(F.coalesce(F.lag(own).over(_over(by, order)), genesis)))


def first_references(rows: DataFrame, target: str, order: list) -> DataFrame:
    """The row in which each target is referenced first. The least of a struct combines before the shuffle, a rank would not."""
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    least = F.min(F.struct(*[k.alias(f"k{n}") for n, k in enumerate(keys)], F.struct(*[F.col(c) for c in rows.columns]).alias("row")))
    return rows.where(F.col(target).isNotNull()).groupBy(target).agg(least.alias("__least")).select("__least.row.*")


def running(rows: DataFrame, by: list[str], order: list, **measures: Column) -> DataFrame:
    """rows with running totals of the measures."""
    w = _over(by, order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumns({name: F.sum(m).over(w) for name, m in measures.items()})


def split_families(children: DataFrame, parent: str, child: str, limit: int, parts: int = 16) -> DataFrame:
    """children with part: 0, or for parents of more than `limit` children one of `parts` by hash of the child.

    Counts are combined before the shuffle; only the large parents are joined back, and there are at most
    rows / limit of them.
    """
    large = children.groupBy(parent).count().where(F.col("count") > limit).select(F.col(parent).alias("__large"))
    part = F.when(F.col("__large").isNotNull(), F.pmod(F.crc32(F.col(child).cast("string").cast("binary")), F.lit(parts))).otherwise(0)
    return children.join(large, F.col(parent) == F.col("__large"), "left").withColumn("part", part.cast("int")).drop("__large")
