"""What keeps tasks as large as they are when tables grow."""

import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import formats, patching, queries, staging, trie
from ledgerloom.plans.staging import ROWS
from tests.oracle import DATA


def test_orphan_check_deals_by_rows(spark, monkeypatch):
    monkeypatch.setattr(queries, "SORTED", 1000)
    rows = queries.read(spark, DATA, "lineitem").count()
    plan = queries.orphan_check(spark, DATA)._jdf.queryExecution().toString()
    assert f"{rows // 1000 + 1}" in plan and "REPARTITION_BY_NUM" in plan


def test_one_large_owner_is_no_task(spark, monkeypatch):
    """A trie that is most of the leaves, and patches that are most of a trie, go to several tasks, and come out as from one."""
    draw = random.Random(7)
    leaves = {draw.randbytes(32): draw.randbytes(9) for _ in range(ROWS * 3)}
    df = spark.createDataFrame([(bytearray(b"o"), bytearray(k), bytearray(v)) for k, v in leaves.items()], "owner binary, key binary, value binary").cache()
    splits, risen = [], trie.risen
    for module in (trie, patching):
        monkeypatch.setattr(module, "risen", lambda level, split, nodes: splits.append(split) or risen(level, split, nodes))
    nodes = trie.trie_nodes(df).cache()
    assert bytes(nodes.where("path = ''").first().hash) == trie.root_of(leaves)
    stay = dict(list(leaves.items())[:5])
    gone = df.where(~df.key.isin([bytearray(k) for k in stay])).selectExpr("owner", "key", "CAST(NULL AS BINARY) AS value")
    after = patching.patched_nodes(nodes, patching.changes(nodes, gone))
    assert bytes(after.where("path = ''").first().hash) == trie.root_of(stay)
    assert {(r.path, bytes(r.blob)) for r in after.collect()} == {(r.path, bytes(r.blob)) for r in trie.trie_nodes(df.join(gone, "key", "left_anti").select("owner", "key", "value")).collect()}
    assert splits == [1, 1, 0]


def test_many_subtrees_at_once():
    """Equal to the builder of one; hashes are those of the blobs."""
    draw = random.Random(3)
    groups, values, want = [], [], []
    for size in (1, 2, 3, 17, 200, 1):
        pool = [bytes(32), *(draw.randbytes(32) for _ in range(3))]
        keys = sorted({(draw.choice(pool)[: draw.randrange(32)] + draw.randbytes(32))[:32] for _ in range(size)} | {bytes(31) + b"\x01", bytes(31) + b"\x02"})
        own = [draw.randbytes(draw.choice((1, 9, 70))) for _ in keys]
        top, every = trie.build([(trie.nibbles(k), v) for k, v in zip(keys, own, strict=True)])
        want.append((top.hash, top.blob, sorted(("".join(f"{d:x}" for d in x.at), x.hash, x.blob) for x in every if x is not top and len(x.blob) >= 32)))
        groups.append((0, keys))
        values += own
    assert [(h, blob, sorted(below)) for h, blob, below in trie.subtrees(groups, values)] == want


def test_plain_nodes_are_read_as_any(monkeypatch):
    draw = random.Random(5)
    keys = sorted(draw.randbytes(32) for _ in range(60))
    (_, blob, below), = trie.subtrees([(0, keys)], [draw.randbytes(draw.choice((1, 9, 70))) for _ in keys])
    blobs = [blob, *(b for *_, b in below)]
    got = [trie.parts_of(b) for b in blobs]
    assert any(trie._plain_branch(b) for b in blobs) and any(trie._plain_leaf(b) for b in blobs)
    monkeypatch.setattr(trie, "_plain_branch", lambda b: None)
    monkeypatch.setattr(trie, "_plain_leaf", lambda b: None)
    assert got == [trie.parts_of(b) for b in blobs]


def test_streams_follow_the_state(spark, monkeypatch):
    monkeypatch.setattr(formats, "STREAMED", 10)
    assert formats.streams_of(spark, spark.range(1000)) == 101 and formats.streams_of(spark, spark.range(5)) == 4


@pytest.mark.parametrize("name", ["patched_trie_roots", "trie_scan"])
def test_tries_are_gone_through_by_slices(spark, monkeypatch, tmp_path, name):
    """Each owner's trie is built once; when a slice begins, what those before it staged is gone; the rows are those of one slice."""
    built, there, nodes_of = [], [], trie.trie_nodes

    def nodes(leaves, **options):
        built.append({bytes(r.owner) for r in leaves.select("owner").distinct().collect()})
        there.append(sorted(d.rsplit("-", 1)[0] for d in os.listdir(tmp_path)))
        assert spark.conf.get(staging.CLEANUP) == "true"
        return nodes_of(leaves, **options)

    lines = queries.read(spark, DATA, "lineitem")
    owners = lines.select("l_suppkey").distinct().count()
    whole = sorted(map(tuple, queries.QUERIES[name](spark, DATA).collect()))
    monkeypatch.setattr(trie, "trie_nodes", nodes)
    monkeypatch.setattr(staging, "SLICED", lines.count() // 3)
    monkeypatch.setattr(staging, "shared_dir", lambda _: f"file://{tmp_path}")
    assert sorted(map(tuple, queries.QUERIES[name](spark, DATA).collect())) == whole
    assert len(built) == 4 and sum(map(len, built)) == len(set().union(*built)) == owners and max(map(len, built)) < owners
    assert there[1] == there[2] == there[3] and len(there[1]) == len(there[0]) + 1
    assert len(os.listdir(tmp_path)) == 1


def test_slices_have_all_rows(spark, monkeypatch):
    """Also rows without a key, keys that only the other table has, and slices without rows."""
    monkeypatch.setattr(staging, "SLICED", 2)
    table = spark.createDataFrame([(k % 3 if k % 4 else None, k) for k in range(20)], "k int, v long")
    other = spark.createDataFrame([(k,) for k in range(7)], "k long")
    both = lambda part, own: part.select("k", "v").unionByName(own(other, "k").selectExpr("int(k) AS k", "-k AS v"))
    got = staging.by_slices(table, "k", "halves", both)
    want = [tuple(r) for r in table.collect()] + [(k, -k) for k in range(7)]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    seen = []
    staging.by_slices(table, "k", "seen", lambda part, own: seen.append(({r.k for r in part.collect()}, {r.k for r in own(other, "k").collect()})) or part)
    assert len(seen) == 11 and all(not mine & {k for j, (a, b) in enumerate(seen) if j != i for k in a | b} for i, (mine, _) in enumerate(seen))
    assert sorted(k for _, b in seen for k in b) == list(range(7))
