import datetime

from ledgerloom.streaming import history


def test_event_counts_and_chain(spark, tmp_path):
    at = lambda m: datetime.datetime(2024, 1, 1, 0, 0) + datetime.timedelta(minutes=m)
    rows = [(1, n, f"h{n}", f"h{n - 1}" if n else "0" * 64, at(30 * n), "a") for n in range(6)]
    rows += [(2, 0, "x0", "0" * 64, at(0), "b"), (2, 1, "x1", "wrong", at(1), "b"), (2, 3, "x3", "x1", at(2), "b")]
    schema = "chain long, number long, hash string, parent string, time timestamp, kind string"
    for part in (rows[:3] + rows[6:8], rows[3:6] + rows[8:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "blocks"))
    stream = history.read_blocks(spark, str(tmp_path / "blocks"), schema, files=1)
    for name, df, mode in (("faults", history.chain_faults(stream), "append"), ("counts", history.event_counts(stream, "time", "kind"), "complete")):
        df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start().awaitTermination(120)
    assert sorted((r.chain, r.number) for r in spark.table("faults").collect()) == [(2, 1), (2, 3)]
    assert sorted((r.kind, r.events) for r in spark.table("counts").collect()) == [("a", 2), ("a", 2), ("a", 2), ("b", 3)]
