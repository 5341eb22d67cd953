"""A training corpus from raw documents: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import decontaminate, mixing, quality_fm, secret_scan, simhash_dedup
from ledgerloom.llm.common import remove, scratch, shared_dir, table

#: Each takes (spark, docs, sf_dir); all but the last return the columns of documents.
STAGES = [
    ("quality classifier", quality_fm.stage),
    ("SimHash near-dedup", simhash_dedup.stage),
    ("benchmark decontamination", decontaminate.stage),
    ("secret scans", secret_scan.stage),
    ("mixing sources to target weights", mixing.stage),
]

#: The classifier is trained, which SQL cannot express; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents: doc_id, source, size, source_size, target, taken of what is left.

    What a stage has staged, and what the one before it has written, is removed when it has written its own.
    """
    docs, at = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{at}/{k}")
        docs = spark.read.parquet(f"{at}/{k}")
        if k:
            remove(spark, f"{at}/{k - 1}")
    return docs
