"""Periodic runs against all pairs of places, with a good hash and with a bad one, and on odd tables."""

import random
from hashlib import sha256

import numpy as np
import pytest

from ledgerloom.llm import periodic_runs
from tests.llm.test_llm import SCHEMA, WORD, documents, nothing
from tests.oracle import same


def brute(words):
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(24, 3 * q):
                found.setdefault((start, i - start + q), q)
            i += 1
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def repetitive(draw):
    kinds, n = draw.choice([1, 2, 3, 5, 30]), draw.randint(0, 150)
    words = [draw.randrange(kinds) for _ in range(n)]
    for _ in range(draw.randint(0, 4) if n else 0):
        a, p = draw.randrange(n), draw.randint(1, 20)
        for k in range(a + p, draw.randint(a, n)):
            words[k] = words[k - p]
    return words


@pytest.mark.parametrize("modulus", [periodic_runs.MODULUS, 5])
def test_runs_equal_all_pairs(monkeypatch, modulus):
    monkeypatch.setattr(periodic_runs, "MODULUS", modulus)  # by 5, nearly every hash is wrong
    draw = random.Random(3)
    for _ in range(1500):
        words = repetitive(draw)
        assert periodic_runs.runs_of(np.array(words, dtype=np.int64)) == brute(words)


def test_long_repetitions_take_about_linear_time():
    a, b = [0], [0, 1]
    while len(b) < 60_000:
        a, b = b, b + a
    assert periodic_runs.runs_of(np.zeros(100_000, dtype=np.int64)) == [(0, 100_000, 1)]
    assert periodic_runs.runs_of(np.array([*range(2000)] * 40)) == [(0, 80_000, 2000)]
    assert len(periodic_runs.runs_of(np.array(b))) > 1000


def test_rows(spark, tmp_path):
    words = lambda n, p: " ".join(f"w{k % p}" for k in range(n))
    rows = [*documents(spark).collect(), *[(k, f"a\tb\n{words(n, p)}  end", None, None, None, None, None, None, None, None, None, None) for k, n, p in ((20, 24, 8), (20, 24, 9), (21, 23, 1), (None, 40, 3), (23, 40_000, 7000))]]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.doc_id is None, r.doc_id or 0, [tuple(x) for x in r.runs], bytes(r.collapsed)) for r in periodic_runs.periodic_runs(df).collect())
    want = []
    for r in df.collect():
        ws = WORD.findall(r.text or "")
        found = [(2, 24, 8)] if (r.doc_id, len(ws)) == (20, 27) and ws[10] == "w0" else [(2, 40, 3)] if r.doc_id is None and len(ws) == 43 else [(2, 40_000, 7000)] if r.doc_id == 23 else []
        gone = {k for s, length, p in found for k in range(s + p, s + length)}
        want.append((r.doc_id is None, r.doc_id or 0, found, " ".join(w for k, w in enumerate(ws) if k not in gone).encode()))
    assert got == sorted(want)
    assert periodic_runs.periodic_runs(nothing(spark)).count() == 0
    df.write.parquet(str(tmp_path / "full/documents.parquet"))
    nothing(spark).write.parquet(str(tmp_path / "none/documents.parquet"))
    found = periodic_runs.op12_periodic_runs(spark, str(tmp_path / "full")).collect()
    empty = sha256(b"").hexdigest()
    assert len(found) == len(rows) and [(r.n_runs, r.start, r.runs_sha256, r.collapsed_sha256) for r in found if r.doc_id == 3] == [(0, None, empty, empty)]
    assert periodic_runs.op12_periodic_runs(spark, str(tmp_path / "none")).count() == 0


def test_ties_go_to_the_smallest_start(spark, tmp_path):
    rows = [(k, " ".join(f"{x}{w}" for x in "ab" for w in (0, 1, 2) * 10), "en", "s") for k in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    same(spark, periodic_runs.op12_periodic_runs, periodic_runs.ORACLE, str(tmp_path))
