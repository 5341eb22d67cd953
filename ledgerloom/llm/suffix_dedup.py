"""Repeated passages by a sparse suffix array.

Of a text's suffixes only those at minimisers are retained: in every SPAN consecutive word positions, the leftmost with
the least hash of its next GRAM words. Each passage of LEAST words belongs to the suffix retained in its first SPAN
positions, which has PREFIX of the passage's words still to come; texts that share the passage retain the same one.
Suffixes are sorted by those PREFIX words, then by all words that their passages reach, then by document: a range of the
order is a task, whatever repeats in it. Neighbours are compared, also across the ends of ranges, and a suffix none of
whose neighbours of the same words is another document's is dropped. Matches are then extended left and right: as far as
all passages of the suffix reach, which settles the inside of whatever is shared; and at the ends of matches passage by
passage, which are sorted and compared in the same way.

Words are compared by two hashes of 64 bits: of the PREFIX words and of the reach, or two of a passage.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from ledgerloom.llm.common import small_batches, staged, table

#: Words of the shortest passage; words a minimiser's hash covers; positions of which one is retained.
LEAST, GRAM, SPAN = 51, 8, 32
#: Words of the passage that follow a retained suffix's start, at least.
PREFIX = LEAST - SPAN + 1
CHUNK = 1 << 19
REMEMBERED = 1 << 19
ODD, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Codes(dict):
    """Word (bytes) to its hash."""

    def __missing__(self, word: bytes) -> int:
        code = xxh64_intdigest(word)
        if len(self) < REMEMBERED:
            self[word] = code
        return code


def coded(text: bytes, codes: Codes) -> np.ndarray:
    words = text.split()
    return np.fromiter(map(codes.__getitem__, words), dtype=np.uint64, count=len(words))


def hashed(codes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each `length` consecutive codes, from those of powers of two of them; empty if there are fewer."""
    out, have, power, size = None, 0, codes, 1
    while True:
        if length & size:
            n = len(codes) - have - size + 1
            if n <= 0:
                return codes[:0]
            part = power[have : have + n]
            out = part if out is None else _both(out[:n], part)
            have += size
        if have == length:
            return out
        if len(power) <= size:
            return codes[:0]
        power, size = _both(power[:-size], power[size:]), size * 2


def _both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * ODD + b
    x ^= x >> np.uint64(32)
    x *= MIX
    x ^= x >> np.uint64(29)
    return x


def minimisers(codes: np.ndarray) -> np.ndarray:
    """For each start of SPAN positions, the leftmost position of the least hash of GRAM words."""
    value = hashed(codes, GRAM)
    place = np.arange(len(value), dtype=np.int32)
    size = 1
    while size < SPAN:
        step = min(size, SPAN - size)
        if len(value) <= step:
            return place[:0]
        later = value[step:] < value[:-step]
        place = np.where(later, place[step:], place[:-step])
        value = np.minimum(value[step:], value[:-step])
        size += step
    return place


def intervals(codes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A hash of codes[low:high] for each pair of ends: differences of sums of codes by powers, brought to one power."""
    n = len(codes) + 1
    up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, ODD)]))
    down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, np.uint64(pow(int(ODD), -1, 1 << 64)))]))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(codes * up[:-1])])
    return _both((sums[high] - sums[low]) * down[low], (high - low).astype(np.uint64))


def _suffixes(batches):
    """(owner, doc_id, text) to (owner, doc_id, prefix, reach, start, n): the retained suffixes; n passages of LEAST words belong to one, from start on.

    prefix hashes the suffix's first PREFIX words; reach all words of its passages, and where in them the suffix begins.
    """
    codes = Codes()
    for batch in batches:
        at, texts = 0, batch.column(2)
        while at < len(texts):
            parts, first, size = [], at, 0
            while at < len(texts) and (size < CHUNK or at == first):
                parts.append(coded(texts[at].as_py() or b"", codes))
                size += len(parts[-1])
                at += 1
            flat = np.concatenate(parts)
            lengths = np.array([len(p) for p in parts])
            if len(flat) < LEAST:
                continue
            ends = np.cumsum(lengths)
            start = np.flatnonzero(np.arange(len(flat) - LEAST + 1) + LEAST <= np.repeat(ends, lengths)[: len(flat) - LEAST + 1])  # passages that lie in one text
            if not len(start):
                continue
            place = minimisers(flat)[start].astype(np.int64)
            new = np.concatenate([[True], (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)])
            begin = np.flatnonzero(new)
            low, pos, n = start[begin], place[begin], np.diff(np.append(begin, len(start)))
            row = np.searchsorted(ends, low, "right")
            reach = _both(intervals(flat, low, low + n + LEAST - 1), (pos - low).astype(np.uint64))
            of = pa.array(first + row)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(of), batch.column(1).take(of), pa.array(hashed(flat, PREFIX)[pos].view(np.int64)), pa.array(reach.view(np.int64)), pa.array((low - (ends - lengths)[row]).astype(np.int32)), pa.array(n.astype(np.int32))],
                schema=pa.schema([("owner", pa.int64()), ("doc_id", pa.int64()), ("prefix", pa.int64()), ("reach", pa.int64()), ("start", pa.int32()), ("n", pa.int32())]),
            )


def _passages(batches):
    """(owner, doc_id, text, places: start and n) to (owner, doc_id, prefix, reach, start, n): LEAST words from each of those starts, by two hashes."""
    codes = Codes()
    for batch in batches:
        for owner, doc, text, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist(), strict=True):
            words = coded(text.as_py() or b"", codes)
            one, two = hashed(words, LEAST), hashed(_both(words, words), LEAST)
            start = np.unique(np.concatenate([np.arange(p["start"], p["start"] + p["n"]) for p in places]))
            start = start[start < len(one)]
            for k in range(0, len(start), CHUNK):
                some = start[k : k + CHUNK]
                same = lambda x, n=len(some): pa.array([x], pa.int64()).take(pa.array(np.zeros(n, np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [same(owner), same(doc), pa.array(one[some].view(np.int64)), pa.array(two[some].view(np.int64)), pa.array(some.astype(np.int32)), pa.array(np.ones(len(some), np.int32))],
                    names=["owner", "doc_id", "prefix", "reach", "start", "n"],
                )


ROW = "owner long, doc_id long, prefix long, reach long, start int, n int"
MET = ", shared boolean, edge boolean, other long, open boolean, met boolean, lone boolean, ahead boolean"


def _neighbours(batches):
    """A range of rows in order (ROW) to those of them that may have a neighbour of another owner, and what the range shows of it (MET).

    Of rows alike in prefix and reach: shared, whether owners differ; edge, whether the row is the first owner's or the
    last's; other, the id of the first owner, or for its rows of the last; open, whether they may go on in the range
    before or after. Of rows alike in prefix: met, whether owners differ; lone, whether rows alike in reach too have one
    owner; ahead, whether they may go on.
    """
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    rows = pa.Table.from_batches(batches).combine_chunks()
    owner, prefix, reach = (rows.column(c).to_numpy() for c in ("owner", "prefix", "reach"))

    def runs(*columns):
        new = np.ones(len(owner), dtype=bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        begin, label = np.flatnonzero(new), np.cumsum(new) - 1
        return begin, np.append(begin[1:], len(owner)) - 1, label, (label == 0) | (label == label[-1])

    low, high, label, open_ = runs(prefix, reach)
    first, last = low[label], high[label]
    shared = owner[first] != owner[last]  # owners of rows alike lie together
    own = owner == owner[first]
    begin, _, label, ahead = runs(prefix)
    met = (np.minimum.reduceat(owner, begin) != np.maximum.reduceat(owner, begin))[label]
    lone = np.logical_or.reduceat(~shared & ~open_, begin)[label]
    keep = pa.array(met | ahead)
    other = rows.column("doc_id").combine_chunks().take(pa.array(np.where(own, last, first)))
    found = [("shared", shared), ("edge", own | (owner == owner[last])), ("other", other), ("open", open_), ("met", met), ("lone", lone), ("ahead", ahead)]
    for name, column in found:
        rows = rows.append_column(name, column if isinstance(column, pa.Array) else pa.array(column))
    yield from rows.filter(keep).combine_chunks().to_batches(max_chunksize=1 << 16)


def compared(rows: DataFrame, name: str) -> DataFrame:
    """rows (ROW) that are alike in prefix with a row of another owner, with shared, edge, other and lone as of all rows.

    They are sorted into ranges, of which as many are to be as fit into a task's memory each (spark.sql.shuffle.partitions),
    and compared with their neighbours in them. What is alike across the ends of ranges, at
    most two prefixes and two reaches a range, is summed up, sent to all tasks, and settles the rows there.
    """
    order = [F.col("prefix"), F.col("reach"), F.col("doc_id").asc_nulls_last(), F.col("owner"), F.col("start")]
    rows = staged(rows, f"{name}-all")  # else the ranges' ends are found by working all rows out once more
    ranges = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_neighbours, ROW + MET), name)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "owner")
    across = ranges.where("open").groupBy("prefix", "reach").agg(F.min(place).alias("least"), F.max(place).alias("most"))
    out = ranges.join(F.broadcast(across), ["prefix", "reach"], "left")
    spread, own, ends = F.col("least").isNotNull(), F.col("owner") == F.col("least.owner"), F.col("owner") == F.col("most.owner")
    settled = lambda was, new: F.when(spread, new).otherwise(F.col(was)).alias(was)
    kept = ["owner", "doc_id", "prefix", "reach", "start", "n"]
    out = out.select(*kept, "met", "lone", "ahead", settled("shared", F.col("least.owner") != F.col("most.owner")), settled("edge", own | ends), settled("other", F.when(own, F.col("most.doc_id")).otherwise(F.col("least.doc_id"))))
    ahead = out.where("ahead").groupBy("prefix").agg((F.min("owner") != F.max("owner")).alias("met_all"), F.max(F.col("lone") | ~F.col("shared")).alias("lone_all"))
    out = out.join(F.broadcast(ahead), "prefix", "left").withColumn("lone", F.coalesce("lone_all", "lone")).where(F.coalesce("met_all", "met"))
    return out.select(*kept, "shared", "edge", "other", "lone")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, start_word, n_words, other_id: the passages of LEAST words or more that another document (doc_id, text) has too.

    Words are what white space parts, as they are written. Passages of a document are as long as each LEAST words of
    them repeat; other_id is the smallest that was met of the ids with which parts of it are shared, null where those
    have none. A document is an id and a text: rows that agree in both are one (so that a row that is repeated is no
    repetition), other texts of the same id are others, and so are those without an id. Null texts are empty.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("binary").alias("text")).select(F.xxhash64("doc_id", "text").alias("owner"), "doc_id", "text")
    kept = staged(compared(texts.mapInArrow(_suffixes, ROW), "suffixes"), "kept-suffixes")
    within = kept.where("shared").select("owner", "doc_id", "start", "n", "other")
    # ends of matches: reaches of one document, and, for them to be compared with, two documents of each other reach of the prefix, of which one is another's
    ends = kept.where(~F.col("shared") | (F.col("lone") & F.col("edge")))
    places = ends.groupBy("owner").agg(F.collect_list(F.struct("start", "n")).alias("places"))
    passages = texts.join(places, "owner").select("owner", "doc_id", "text", "places").mapInArrow(_passages, ROW)
    single = compared(passages, "passages").where("shared").select("owner", "doc_id", "start", "n", "other")
    every = within.unionByName(single)
    by_start = Window.partitionBy("owner").orderBy("start", "n")
    reached = F.max(F.col("start") + F.col("n")).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    island = every.withColumn("new", F.when(F.col("start") <= reached, 0).otherwise(1)).withColumn("island", F.sum("new").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    out = island.groupBy("owner", "island").agg(F.min("doc_id").alias("doc_id"), F.min("start").alias("start_word"), F.max(F.col("start") + F.col("n")).alias("end"), F.min("other").alias("other_id"))
    return out.select("doc_id", "start_word", (F.col("end") - F.col("start_word") + (LEAST - 1)).cast("int").alias("n_words"), "other_id")


def op8_suffix_dedup(spark, sf_dir):
    """Where the passages are; with which of several others a passage was met (other_id) is the operator's to say."""
    return repeated_passages(table(spark, sf_dir, "documents")).select("doc_id", "start_word", "n_words")


#: All passages of LEAST words, those that two documents have, and the runs of their starts.
ORACLE = f"""
WITH d AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM d),
p AS (SELECT doc, doc_id, unnest(list_transform(range(1, len(words) - {LEAST - 2}), lambda k: {{'k': k, 'h': md5(array_to_string(words[k:k + {LEAST - 1}], ' '))}})) AS x FROM w),
s AS (SELECT x.h AS h FROM p GROUP BY x.h HAVING count(DISTINCT doc) > 1),
q AS (SELECT doc, doc_id, x.k AS k, x.k - row_number() OVER (PARTITION BY doc ORDER BY x.k) AS run FROM p SEMI JOIN s ON p.x.h = s.h)
SELECT doc_id, CAST(min(k) - 1 AS INTEGER) AS start_word, CAST(max(k) - min(k) + {LEAST} AS INTEGER) AS n_words FROM q GROUP BY doc, doc_id, run
"""
