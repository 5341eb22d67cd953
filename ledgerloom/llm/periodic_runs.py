"""Periodic runs of words: stretches that repeat with a period, found by Lyndon roots.

Every run of words holds its period as a Lyndon word that is the longest one at its place, under the order of words or
under the reverse of it. So a stack of Lyndon words, scanned from right to left under both orders, gives two periods a
place, and these are all that there are to try. Words at two places are compared first one by one, then by a rolling hash
of all that follows and a binary search for how far they agree; what the hash says is held against the words themselves,
so that no result rests on a hash. No suffix array is made; time is about linear in the words.
"""

from __future__ import annotations

import zlib
from fractions import Fraction
from hashlib import sha256
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import small_batches, table

#: A run has so many words, and so many times its period, at least.
LEAST, TIMES = 24, 3
#: Words that are compared one by one before the hash is asked.
DIRECT = 8
#: Fixed value: the modulus of the rolling hash; its base.
MODULUS, BASE = (1 << 61) - 1, 0x1D2B3C4D5E6F7081 % ((1 << 61) - 1)


class Extensions:
    """How far words agree from two places on, to the right and to the left."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.words, self.n = codes, codes.tolist(), len(codes)
        self.known: dict[int, tuple[int, int]] = {}  # by distance, a place from which on so many words have been found to agree
        self._sums: list[int] = []

    def _hash(self, at: int, size: int) -> int:
        if not self._sums:
            self._sums = list(accumulate(self.words, lambda s, c: (s * BASE + c + 1) % MODULUS, initial=0))
            self._powers = list(accumulate(range(self.n), lambda p, _: p * BASE % MODULUS, initial=1))
        return (self._sums[at + size] - self._sums[at] * self._powers[size]) % MODULUS

    def _search(self, low: int, high: int, agree) -> int:
        """The largest size up to `high` that agrees; `low` does, and steps from it double before the search halves them."""
        step = DIRECT
        while low < high and agree(min(low + step, high)):
            low, step = min(low + step, high), 2 * step
        high = min(low + step, high)
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if agree(middle) else (low, middle - 1)
        return low

    def _alike(self, i: int, j: int, size: int) -> bool:
        return bool(np.array_equal(self.codes[i : i + size], self.codes[j : j + size]))

    def right(self, i: int, j: int) -> int:
        """Words from i on that are those from j on; i < j."""
        words, n = self.words, self.n
        at, of = self.known.get(j - i, (-1, -1))
        if at <= i <= at + of:
            return at + of - i
        near = i < at <= i + DIRECT
        size, most = 0, at - i if near else min(DIRECT, n - j)
        while size < most and words[i + size] == words[j + size]:
            size += 1
        if near and size == most:
            size += of
        elif not near and size == DIRECT:
            size = self._search(DIRECT, n - j, lambda k: self._hash(i, k) == self._hash(j, k))
            ahead = at - i if i < at <= i + size else size  # from the known place on, all is known
            if not self._alike(i, j, ahead):
                size = int(np.flatnonzero(self.codes[i : i + ahead] != self.codes[j : j + ahead])[0])
            elif ahead < size or i + size == at:
                size = at - i + of
            elif j + size < n and words[i + size] == words[j + size]:  # the hash stopped it too soon
                off = np.flatnonzero(self.codes[i + size : n - j + i] != self.codes[j + size :])
                size = size + int(off[0]) if len(off) else n - j
        if size >= DIRECT:
            self.known[j - i] = i, size
        return size

    def around(self, i: int, period: int) -> tuple[int, int]:
        """Start and length of the stretch about i, i + period whose words are `period` apart the same ones; i is such a place."""
        right = self.right(i, i + period)
        left = self._search(0, i, lambda k: self._hash(i - k, k) == self._hash(i + period - k, k))
        start = i - left
        whole = self._alike(start, start + period, left) and (start == 0 or self.words[start - 1] != self.words[start - 1 + period])
        if not whole:  # the hash was wrong
            off = np.flatnonzero(self.codes[:i] != self.codes[period : i + period])
            start = int(off[-1]) + 1 if len(off) else 0
        return start, i - start + right + period


def lyndon_ends(words: list[int], less) -> list[int]:
    """For each place the end of the longest Lyndon word that begins there; less(i, j) compares what follows equal words.

    words: with a last one that is less than all. The stack holds where the Lyndon words begin that what is to the right
    falls into; one more word joins with them as long as what it begins is less.
    """
    n = len(words) - 1
    ends, stack = [0] * n, [n]
    for i in range(n - 1, -1, -1):
        word, j = words[i], stack[-1]
        while (other := words[j]) > word or other == word and less(i, j):
            stack.pop()
            j = stack[-1]
        ends[i] = j
        stack.append(i)
    return ends


def runs_of(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of words, given by their codes; by start, then period."""
    n = len(codes)
    if n < LEAST:
        return []
    ext, found = Extensions(codes), set()
    for order in (ext.words, (codes.max() - codes).tolist()):

        def less(i, j, order=order):
            size = ext.right(i, j)
            return j + size < n and order[i + size] < order[j + size]

        at, period = np.arange(n), np.array(lyndon_ends([*order, -1], less)) - np.arange(n)
        # the leftmost root of a run is followed by itself, and so by this many words at least that are a period apart the same
        most = at + np.maximum(LEAST - 2 * period, period)
        at = np.flatnonzero(most + period < n)
        for k in range(LEAST // TIMES + 1):
            at = at[codes[at + k] == codes[at + k + period[at]]]
        far = 0, 0
        for p, i in sorted(zip(period[at].tolist(), at.tolist(), strict=True)):
            if p == far[0] and i + 2 * p <= far[1]:
                continue  # within the run just found
            start, length = ext.around(i, p)
            far = p, start + length
            if length >= max(LEAST, TIMES * p):
                found.add((start, length, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Of n words, whether each stays: those of a run after its first period go."""
    change = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def _codes(words: list) -> np.ndarray:
    of: dict = {}
    return np.fromiter((of.setdefault(w, len(of)) for w in words), dtype=np.int64, count=len(words))


def _found(batches):
    """(doc_id, text, planted) to the texts' runs and what is left of them (RUNS)."""
    for batch in batches:
        out = []
        for doc, text, planted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
            words = (text.as_py() or b"").split()
            if planted:
                words = repeated(words, doc)
            runs = runs_of(_codes(words))
            if runs:
                words = [w for w, stays in zip(words, kept_words(len(words), runs).tolist(), strict=True) if stays]
            out.append((doc, [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs], b" ".join(words)))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (f.type for f in RUNS_TYPE), strict=True)] if out else [pa.array([], f.type) for f in RUNS_TYPE], schema=RUNS_TYPE)


RUNS = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"
RUNS_TYPE = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.binary())])


def repeated(words: list, doc_id: int | None) -> list:
    """The words as the query takes them: of one document in ten, what follows a certain word repeats with a period. Without an id, as they are."""
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def periodic_runs(docs: DataFrame, planted: bool = False) -> DataFrame:
    """doc_id, runs (start, length, period; by start, then period) and collapsed text of every row of docs (doc_id, text).

    A run is a stretch of LEAST words or more, and of TIMES times its smallest period or more, that cannot be made longer.
    Of a run only the first period stays in the collapsed text, the words of which are joined by single spaces; it is
    given as bytes. A null text is empty: no run, nothing left. Rows of one id, or without an id, stay rows of their own.
    planted: with the repetitions that the query puts in.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("binary").alias("text"), F.lit(planted).alias("planted"))
    return rows.mapInArrow(_found, RUNS)


def _digests(batches):
    """RUNS to the query's columns."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            runs = [(r["start"], r["length"], r["period"]) for r in row["runs"]]
            best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
            shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
            lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
            out.append((row["doc_id"], len(runs), *shown, sha256(lines.encode()).hexdigest(), sha256(row["collapsed"]).hexdigest()))
        columns = list(zip(*out, strict=True)) if out else [[]] * 8
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k > 5 else pa.int64()) for k, c in enumerate(columns)], names=[c.split()[0] for c in DIGESTS.split(", ")])


DIGESTS = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def op12_periodic_runs(spark, sf_dir):
    return periodic_runs(table(spark, sf_dir, "documents"), planted=True).mapInArrow(_digests, DIGESTS)


#: All pairs of places with the same word, by their distance; stretches of them; of stretches alike the least distance.
ORACLE = f"""
WITH c AS (SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
h AS (SELECT *, len(words) AS n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
        lambda a, b: list_reduce(list_prepend(xor(a, b), range(0, 8)), lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)), 4294967295) AS h FROM c),
g AS (SELECT *, h // 10 AS g, CASE WHEN n > 0 THEN (h // 10) % n END AS a FROM h),
t AS (SELECT doc, doc_id, n, words, CASE WHEN h % 10 = 0 AND n > 0 THEN a END AS a, 1 + (n - a) // (3 + g % 8) AS p FROM g),
w AS (SELECT doc, n, i, CASE WHEN i >= a THEN words[a + (i - a) % p + 1] ELSE words[i + 1] END AS word FROM (SELECT *, unnest(range(0, n)) AS i FROM t)),
e AS (SELECT x.doc, x.i, y.i - x.i AS q FROM w x JOIN w y ON x.doc = y.doc AND x.word = y.word AND y.i > x.i AND {TIMES} * (y.i - x.i) <= x.n),
s AS (SELECT doc, q, i, i - row_number() OVER (PARTITION BY doc, q ORDER BY i) AS stretch FROM e),
m AS (SELECT doc, q, min(i) AS start, count(*) + q AS length FROM s GROUP BY doc, q, stretch HAVING count(*) + q >= greatest({LEAST}, {TIMES} * q)),
r AS (SELECT doc, start, length, min(q) AS period FROM m GROUP BY ALL),
b AS (SELECT doc, count(*) AS n_runs, sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)) AS runs_sha256 FROM r GROUP BY doc),
f AS (SELECT doc, start, length, period FROM r x WHERE NOT EXISTS (SELECT 1 FROM r y WHERE y.doc = x.doc AND
        (y.length * x.period > x.length * y.period OR y.length * x.period = x.length * y.period AND (y.start < x.start OR y.start = x.start AND y.period < x.period)))),
k AS (SELECT doc, string_agg(word, ' ' ORDER BY i) AS left_over FROM w WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.doc = w.doc AND i >= start + period AND i < start + length) GROUP BY doc)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli, coalesce(runs_sha256, sha256('')) AS runs_sha256, sha256(coalesce(left_over, '')) AS collapsed_sha256
FROM t LEFT JOIN b USING (doc) LEFT JOIN f USING (doc) LEFT JOIN k USING (doc)
"""
