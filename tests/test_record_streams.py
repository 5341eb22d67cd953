"""Bundles of several streams: written and verified by tasks, committed as a whole."""

import json

import pytest

from ledgerloom.functions.keccak import keccak
from ledgerloom.plans import history, snapshot
from ledgerloom.sources import records
from tests.fixtures import database, frame
from tests.oracle import same


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    kv, _ = database()
    at = tmp_path_factory.mktemp("bundles")
    head, df = history.read_head(kv.get), frame(spark, kv)
    one = snapshot.export(df, head, str(at / "one"), "zstd")
    many = snapshot.export(df, head, str(at / "many"), "zstd", streams=3)
    return at, head, one, many


def rows_of(spark, folder):
    state, _, _ = snapshot.read_bundle(spark, str(folder))
    return [sorted(map(repr, df.collect())) for df in (state.accounts, state.slots, state.code)]


def test_several_streams_hold_what_one_does(spark, made):
    at, head, one, many = made
    streams = json.loads((at / "many/manifest.json").read_text())["streams"]
    assert len(streams) > 1 and sorted(p.name for p in (at / "many").iterdir()) == ["manifest.json", *(records.STREAM_NAME.format(s["stream"]) for s in streams)]
    assert [getattr(one, k) for k in ("accounts", "storage_slots", "code_records", "records", "payload_bytes")] == [getattr(many, k) for k in ("accounts", "storage_slots", "code_records", "records", "payload_bytes")]
    assert rows_of(spark, at / "one") == rows_of(spark, at / "many")


def test_changed_streams_are_refused(spark, made):
    at, *_ = made
    folder = at / "many"
    streams = sorted(p for p in folder.iterdir() if p.name != "manifest.json")
    a, b = (p.read_bytes() for p in streams[:2])
    for one, two in ((b, a), (a[:-1], b), (a, b[:20] + bytes([b[20] ^ 1]) + b[21:])):
        streams[0].write_bytes(one)
        streams[1].write_bytes(two)
        with pytest.raises(ValueError, match="stream"):
            snapshot.read_bundle(spark, str(folder))
    streams[0].write_bytes(a)
    streams[1].write_bytes(b)
    text = (folder / "manifest.json").read_text()
    data = json.loads(text)
    for change in ({"streams": data["streams"][1:]}, {"streams": data["streams"][::-1]}, {"streams": 1}, {"version": 1}, {"streams": [s | {"records": s["records"] + 1} for s in data["streams"]]}):
        (folder / "manifest.json").write_text(json.dumps(data | change))
        with pytest.raises(ValueError):
            snapshot.read_bundle(spark, str(folder))
    (folder / "manifest.json").write_text(text)
    snapshot.read_bundle(spark, str(folder))


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    rows = [(2, bytearray(keccak(bytes([k]))), bytearray(32), bytearray(5 if k != 77 else 500)) for k in range(100)]
    df = spark.createDataFrame(rows, "type int, account_hash binary, sub_hash binary, payload binary")
    with pytest.raises(Exception, match="payload of 500 bytes"):
        records.write_streams(df, str(tmp_path / "out"), bytes(32), streams=4)
    assert list((tmp_path / "out").iterdir()) == []


def test_verb(spark, made, tmp_path):
    from ledgerloom.__main__ import parser, run

    kv, _ = database()
    frame(spark, kv).write.parquet(str(tmp_path / "kv"))
    found = run(spark, parser().parse_args(["export", "--source", str(tmp_path / "kv"), "--out", str(tmp_path / "b"), "--streams", "2"]))
    assert found["accounts"] == 8 and (tmp_path / "b" / records.STREAM_NAME.format(0)).exists()
    done = run(spark, parser().parse_args(["import", "--bundle", str(tmp_path / "b"), "--out", str(tmp_path / "a"), "--scheme", "path"]))
    assert done["verification"]["counts"]["accounts"] == 8


def test_query_on_more_rows(spark):
    from ledgerloom.plans.queries import ORACLES, QUERIES

    same(spark, QUERIES["bundle_records"], ORACLES["bundle_records"], "/root/testdata/sf0.01")
