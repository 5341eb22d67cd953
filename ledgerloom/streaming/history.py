"""History as a stream: windowed event counts with late rows dropped, and the parent check carried from batch to batch."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout


def read_blocks(spark: SparkSession, path: str, schema: str, files: int = 64) -> DataFrame:
    """Parquet files of blocks as they are added, so many a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def event_counts(events: DataFrame, time: str, kind: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """window, kind, events; a window closes when the newest row is `late` past its end."""
    return events.withWatermark(time, late).groupBy(F.window(time, window), kind).agg(F.count("*").alias("events"))


def chain_faults(blocks: DataFrame, genesis: str = "0" * 64) -> DataFrame:
    """Faults (chain, number, fault) of blocks (chain, number, hash, parent as hex), each chain growing in order.

    State is a chain's next number and last hash. Blocks of one micro-batch may come in any order; a gap, a repeated
    number or a parent that is not the block before is a fault, after which the chain goes on from that block.
    """

    def check(key, parts, state):
        number, last = state.get if state.exists else (0, genesis)
        rows = pd.concat(list(parts)).sort_values(["number", "hash"])
        out = []
        for r in rows.itertuples(index=False):
            if r.number != number:
                out.append((key[0], r.number, f"expected number {number}"))
            elif r.parent != last:
                out.append((key[0], r.number, "parent differs"))
            number, last = max(number, r.number + 1), r.hash
        state.update((int(number), last))
        yield pd.DataFrame(out, columns=["chain", "number", "fault"]).astype({"chain": "int64", "number": "int64", "fault": "object"})

    return blocks.select("chain", "number", "hash", "parent").groupBy("chain").applyInPandasWithState(check, "chain long, number long, fault string", "next long, last string", "append", GroupStateTimeout.NoTimeout)
