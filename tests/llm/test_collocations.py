"""Collocations against counts of all phrases, with and without heavy words, on odd languages and characters."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import collocations
from tests.llm.test_llm import SCHEMA, documents, nothing
from tests.oracle import same

SMALL = "doc_id long, text string, lang string, source string"


def brute(rows, longest, least, top, within):
    counts, sizes = Counter(), Counter()
    for lang, text in rows:
        lang, low = "und" if lang is None else lang, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            counts.update((lang, *words[i : i + k]) for i in range(len(words)) for k in range(1, longest + 1) if i + k <= len(words))
    many = {p: a for p, a in counts.items() if len(p) > 2 and a >= least}
    inside = Counter()
    for p, a in many.items():
        for size in range(2, len(p) - 1):
            for at in range(1, len(p) - size + 1):
                key = (p[0], *p[at : at + size])
                inside[key] = max(inside[key], a)
    found = {}
    for p, a in many.items():
        if 100 * inside[p] >= within * a:
            continue
        score, k = min((1000000 * a * a // (counts[p[: k + 1]] * counts[(p[0], *p[k + 1 :])]), k) for k in range(1, len(p) - 1))
        found.setdefault(p[0], []).append((-score, -a, " ".join(p[1:]).encode(), counts[p[: k + 1]], counts[(p[0], *p[k + 1 :])]))
    return sorted((lang, rank, text.decode(), -a, left, right, sizes[lang], -score) for lang, of in found.items() for rank, (score, a, text, left, right) in enumerate(sorted(of)[:top], 1))


def odd(n):
    draw = random.Random(n)
    names = ["a", "b", "the", "the\x01", "Bé", "é", "x\x00y", "\\t", "\U0001f600", "Z"]
    gaps = [" ", " ", " ", "\t", "  ", ". ", "\n", ",", "\x0b"]
    text = lambda: "".join(draw.choice(names[: draw.choice([2, 5, 10])]) + draw.choice(gaps) for _ in range(draw.randint(0, 80)))
    return [(draw.choice([None, "en", "en\ta", "en\\ta", "und", ""]), draw.choice([None, "", text(), text(), text()])) for _ in range(150)]


@pytest.mark.parametrize(("longest", "heavy", "chunk"), [(3, 1024, 1 << 19), (3, 20, 100), (3, 4, 1000), (2, 20, 100), (5, 20, 300)])
def test_equals_counts_of_all_phrases(spark, monkeypatch, longest, heavy, chunk):
    monkeypatch.setattr(collocations, "HEAVY", heavy)
    monkeypatch.setattr(collocations, "CHUNK", chunk)
    rows = odd(longest)
    df = spark.createDataFrame([(1, t, lang, None) for lang, t in rows], SMALL).repartition(3)
    got = sorted(tuple(r) for r in collocations.collocations(df, longest, 10, 30, 50).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    want = brute(rows, longest, 10, 30, 50)
    assert got == want and len(want) > 20


def test_sql_on_odd_rows(spark, tmp_path):
    df = spark.createDataFrame([(k, None if t is None else t.replace("\x00", "0"), lang, "s") for k, (lang, t) in enumerate(odd(7))], SMALL)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    same(spark, collocations.op11_collocations, collocations.ORACLE, str(tmp_path))


def test_odd_tables(spark):
    once = sorted(tuple(r) for r in collocations.collocations(documents(spark), least=2).collect())
    want = brute([(r.lang, r.text) for r in documents(spark).collect()], 3, 2, 2000, 50)
    names = collocations.collocations(documents(spark), least=2).columns
    assert sorted(tuple(dict(zip(names, r, strict=True))[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in once) == want
    assert collocations.collocations(nothing(spark)).count() == 0
    assert collocations.collocations(spark.createDataFrame([(1, "a b") + (None,) * 10], SCHEMA)).count() == 0


def test_products_pass_64_bits(spark, monkeypatch):
    """As if each word were met ten billion times."""
    times = 10_000_000_000
    kept = collocations.phrase_counts

    def scaled(*a):
        sizes, counts = kept(*a)
        return sizes.withColumn("n", sizes["n"] * times), counts.withColumn("n", counts["n"] * times)

    rows = odd(3)
    df = spark.createDataFrame([(1, t, lang, None) for lang, t in rows], SMALL)
    monkeypatch.setattr(collocations, "phrase_counts", scaled)
    got = sorted((r.lang, r.rank, r.phrase, r.a, r.score) for r in collocations.collocations(df).collect())
    assert got == sorted((lang, rank, phrase, a * times, score) for lang, rank, phrase, a, _, _, _, score in brute(rows, 3, 10, 2000, 50))


def test_short_batches_are_counted_together():
    words = sorted((f"w{i:06d}" for i in range(64_000)), reverse=True)
    rows = pa.table({"head": pa.array([f"en\t{w}\t".encode() for w in words]), "tail": pa.array([b""] * len(words)), "n": pa.array([10] * len(words))})
    out = list(collocations._counted(3, 10)(iter(rows.to_batches(max_chunksize=1000))))
    assert len(out) <= 3 and sum(b.num_rows for b in out) == len(words)
    got = {p: n for b in out for p, n in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)}
    assert got == {f"en\t{w}".encode(): 10 for w in words}


def test_suffixes_end_before_rare_words():
    """By hash, so that a word is kept that shares its number with a frequent one; what starts with a rare word is left out."""
    often = np.zeros(collocations.BUCKETS // 64, dtype=np.int64)
    for b in collocations._buckets([b"a", b"b"]).tolist():
        often[b >> 6] |= np.uint64(1 << (b & 63)).astype(np.int64)
    batch = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([b"a b once a b a. b"])], names=["lang", "text"])
    out = pa.Table.from_batches(collocations._suffixes(3, set(), often)([batch])).to_pylist()
    got = {r["head"] + r["tail"]: r["n"] for r in out}
    assert got == {b"en\ta\tb\t": 1, b"en\tb\t": 2, b"en\ta\tb\ta\t": 1, b"en\tb\ta\t": 1, b"en\ta\t": 1}
