"""Mixing sources to target weights by hash-threshold histograms.

Each source gets a budget of words. Sums of words by (source, leading hash bits) find the bucket in which the budget
ends; only that bucket is refined by the next bits, and then by whole hash values. A document belongs to the mix if its
hash lies below its source's threshold: no sort of the documents, and the thresholds of growing budgets are nested.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import staged, summed_before, table, word_count

#: Weights of the sources by code point, repeating.
WEIGHTS = (5, 2, 1)
#: A document is taken so many times at most.
MOST = 3
#: Bits of hash a histogram level, of HASH_BITS in all.
LEVEL_BITS, HASH_BITS = 12, 60


def source_key(source: Column) -> Column:
    """Sorts as the sources by code point, null last, and is never null."""
    return F.when(source.isNull(), "1").otherwise(F.concat(F.lit("0"), source))


def hash_of(doc_id: Column, text: Column) -> Column:
    """60 bits of the MD5 of the document's id, of its text where there is no id."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), text, F.lit(""))), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """(skey, source_size) to (skey, source_size, target): shares by weight, none above `most` times its size.

    Sources may be as many as documents: they are ranked, and summed up, by ranges. Sorted by size over weight, those
    that stop come first. If those before one have stopped, the others share
    the rest at rate_k; rate_k rises while sources stop and falls after, so that the largest is the one that holds.
    """
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int")).cast("long")
    ranked = summed_before(sizes.select("skey", "source_size"), [F.col("skey")], rank=F.lit(1)).withColumn("w", w)
    order = [F.col("source_size") / F.col("w"), F.col("skey")]
    rows = staged(summed_before(ranked.select("skey", "source_size", "w"), order, stopped=F.col("source_size"), gone=F.col("w")), "mix-sources")
    size, weight = rows.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("w"), F.lit(0))).first()
    rate = (F.lit(size) - F.col("stopped") * most).cast("double") / (F.lit(weight) - F.col("gone"))
    top = rows.agg(F.max(rate)).first()[0]
    return rows.select("skey", "source_size", F.least((F.col("source_size") * most).cast("double"), F.lit(top).cast("double") * F.col("w")).alias("target"))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of every row of docs (doc_id, text, source).

    A source's documents are all taken floor(target / source_size) times; once more those whose hash lies below the
    threshold at which the next document would exceed the rest of the budget. Documents of one hash (rows that repeat
    an id) are taken alike. Null or empty texts have size 0; a null source is a source of its own, the last; an empty
    table gives an empty result; columns other than the three are ignored.
    """
    low, mid = HASH_BITS - LEVEL_BITS, HASH_BITS - 2 * LEVEL_BITS
    rows = staged(
        docs.select(
            "doc_id", "source", source_key(docs["source"]).alias("skey"),
            word_count(F.coalesce(docs["text"], F.lit(""))).alias("size"), hash_of(docs["doc_id"], docs["text"]).alias("h"),
        ).withColumn("b1", F.shiftright("h", low)),
        "mix-sizes",
    )
    first = rows.groupBy("skey", "b1").agg(F.sum("size").alias("n"))
    targets = source_targets(first.groupBy("skey").agg(F.sum("n").alias("source_size")), weights, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    # (source, bucket): a hot source is dealt over its buckets from here on
    level = first.join(targets, "skey").withColumn("whole", whole.cast("long")).withColumn("left", F.col("target") - F.col("whole") * F.col("source_size"))

    def boundary(hist: DataFrame, bucket: str, start: Column | None = None) -> DataFrame:
        """The bucket in which a source's sum passes what is left, and the sum before it."""
        up = F.sum("n").over(Window.partitionBy("skey").orderBy(bucket)) + (0 if start is None else start)
        return hist.withColumn("up", up).where((F.col("up") > F.col("left")) & (F.col("up") - F.col("n") <= F.col("left"))).withColumn("start", F.col("up") - F.col("n")).select("skey", bucket, "left", "start")

    edge = rows.where("size > 0").join(boundary(level, "b1"), ["skey", "b1"])
    edge = edge.withColumn("b2", F.shiftright("h", mid).bitwiseAND(2**LEVEL_BITS - 1))
    second = edge.groupBy("skey", "b2").agg(F.sum("size").alias("n"), F.first("left").alias("left"), F.first("start").alias("start"))
    last = edge.drop("left", "start").join(boundary(second, "b2", F.col("start")), ["skey", "b2"])
    exact = last.groupBy("skey", "h").agg(F.sum("size").alias("n"), F.first("left").alias("left"), F.first("start").alias("start"))
    cut = boundary(exact, "h", F.col("start")).select("skey", F.col("h").alias("cut"))
    by_bucket = level.join(cut, "skey", "left").select("skey", "b1", "source_size", "target", "whole", "cut")
    taken = F.col("size") * (F.col("whole") + F.when(F.col("h") < F.col("cut"), 1).otherwise(0))
    return rows.join(by_bucket, ["skey", "b1"]).select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def op7_mixing(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS skey,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (SELECT skey, CAST(sum(size) AS BIGINT) AS source_size,
             CASE (row_number() OVER (ORDER BY skey) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
      FROM d GROUP BY skey),
r AS (SELECT *, CAST(sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER b, 0) AS DOUBLE)
                / CAST(sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS DOUBLE) AS rate
      FROM s WINDOW b AS (ORDER BY CAST(source_size AS DOUBLE) / w, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT skey, source_size, least(CAST(3 * source_size AS DOUBLE), max(rate) OVER () * w) AS target FROM r),
c AS (SELECT d.*, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS whole,
             sum(size) OVER (PARTITION BY skey ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS up
      FROM d JOIN t USING (skey))
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN up <= target - whole * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM c
"""


def stage(spark, docs, sf_dir):
    """The last stage of the pipeline: one row a document that is left, with how many of its words the mix takes."""
    return mix(docs).select("doc_id", "source", "size", "source_size", "target", "taken")
