"""Benchmark decontamination: CGK embedding and bit-sampling LSH over item-sized windows, then exact edit distance.

A text and an item are sequences of normalised words. An occurrence within `tau` edits leaves a run of RUN words of the
item as they are (pigeonhole; fewer for short items), so that windows of the item's size are laid at the diagonals of
such runs and nowhere else. Window and item walk through the same random CGK embeddings, which turn edits into few
differing positions; they are a candidate if all positions that some table samples are equal. Candidates are verified
by their exact edit distance to any part of the text around the window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from ledgerloom.llm.common import small_batches, table, text_digest

#: Words that may be inserted, deleted or replaced, as a share of the item's.
EDITS = 0.2
#: Longest run that is looked up; embeddings, tables of each, positions that a table samples.
RUN, WALKS, TABLES, SAMPLED = 3, 8, 4, 2
#: Words of the items that are searched for in one pass over the documents, unless one item has more.
BLOCK = 1 << 21
#: Words, windows, and positions of their embeddings, that are worked on at once.
CHUNK, WINDOWS, CELLS = 1 << 20, 1 << 12, 1 << 22
REMEMBERED = 1 << 19
MARKS = rb"""!"#$%&'()*+,-./:;<=>?@[\]^_`{|}~"""
ODD = np.uint64(0x9E3779B97F4A7C15)


class Codes(dict):
    """Word (bytes, lower case) to the hash of what is left without ASCII marks at its ends; never 0."""

    def __missing__(self, word: bytes) -> int:
        code = xxh64_intdigest(word.strip(MARKS) or word) or 1
        if len(self) < REMEMBERED:
            self[word] = code
        return code


def coded(text: bytes, codes: Codes) -> np.ndarray:
    words = text.split()
    return np.fromiter(map(codes.__getitem__, words), dtype=np.uint64, count=len(words))


def runs(codes: np.ndarray, g: int) -> np.ndarray:
    """A hash of each g consecutive codes."""
    n = len(codes) - g + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(g if n > 0 else 0):
        out = (out ^ codes[k : k + n]) * ODD
        out ^= out >> np.uint64(29)
    return out


def run_length(m: int, tau: int) -> int:
    """Of m words with tau edits, one of the tau + 1 stretches between edits has so many words."""
    return min(RUN, -(-(m - tau) // (tau + 1)))


class Index:
    """Items (id, text) made ready for search."""

    def __init__(self, items: list, edits: float = EDITS, seed: int = 11):
        codes = Codes()
        kept = [(i, c) for i, t in items if t is not None and len(c := coded(t.lower().encode(), codes))]
        self.ids = np.array([i for i, _ in kept], dtype=np.int64)
        self.words = [c for _, c in kept]
        self.m = np.array([len(c) for c in self.words], dtype=np.int64)
        self.tau = np.floor(self.m * edits + 1e-9).astype(np.int64)
        draw = np.random.default_rng(seed)
        self.steps = 3 * int(self.m.max(initial=1))
        self.turns = draw.integers(1, 2**63, (WALKS, self.steps), dtype=np.uint64)
        self.spots = draw.random((WALKS, TABLES * SAMPLED))
        self.seeds = {}
        for g in sorted({run_length(int(m), int(t)) for m, t in zip(self.m, self.tau, strict=True)}):
            of = [k for k, (m, t) in enumerate(zip(self.m, self.tau, strict=True)) if run_length(int(m), int(t)) == g]
            hashes = [runs(self.words[k], g) for k in of]
            key = np.concatenate(hashes)
            item = np.repeat(np.array(of, dtype=np.int64), [len(h) for h in hashes])
            offset = np.concatenate([np.arange(len(h)) for h in hashes])
            order = np.argsort(key, kind="stable")
            key, item, offset = key[order], item[order], offset[order]
            sieve = np.zeros(1 << 20, dtype=bool)
            sieve[(key >> np.uint64(44)).astype(np.int64)] = True
            self.seeds[g] = (key, item, offset, sieve)
        self.sampled = np.zeros((WALKS, TABLES * SAMPLED, len(kept)), dtype=np.uint64)
        for of in self.parts(np.arange(len(kept))):
            rows = np.zeros((len(of), int(self.m[of].max()) + 1), dtype=np.uint64)
            for k, i in enumerate(of):
                rows[k, : self.m[i]] = self.words[i]
            self.sampled[:, :, of] = self.embed(rows, self.m[of])

    def parts(self, items: np.ndarray):
        """Places of the items by length, so many together that neither their number nor their embeddings are many: a long item is embedded with few others, and none is padded to it."""
        order = np.argsort(self.m[items], kind="stable")
        while len(order):
            size = min(len(order), WINDOWS)
            while size > 1 and size * 3 * WALKS * int(self.m[items[order[size - 1]]]) > CELLS:
                size = (size + 1) // 2
            yield order[:size]
            order = order[size:]

    def embed(self, rows: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Sampled positions of the CGK embeddings: (walk, sample, row). rows: codes, 0 from m on.

        At each step the current word is put out, and the walk moves on or stays as a bit of (step, word) says.
        """
        count, last = len(rows), rows.shape[1] - 1
        every, steps = np.arange(count), 3 * int(m.max())
        at = np.zeros((WALKS, count), dtype=np.int64)
        shown = np.zeros((steps, WALKS, count), dtype=np.uint64)
        end = np.minimum(m, last)
        for t in range(steps):
            now = shown[t] = rows[every, at]
            at += (((now ^ self.turns[:, t, None]) * ODD) >> np.uint64(63)).astype(np.int64)
            np.minimum(at, end, out=at)
        place = (self.spots[:, :, None] * 3 * m).astype(np.int64)  # (walk, sample, row)
        return shown[place, np.arange(WALKS)[:, None, None], every]

    def windows(self, flat: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Texts, items and starts (which may lie before the text) of the windows at the runs that text and items share.

        An edit spoils g of an item's m - g + 1 runs, so that an occurrence has the others within m + tau words: runs
        that have not so many around them are left out.
        """
        found = [np.zeros((3, 0), dtype=np.int64)]
        for g, (key, item, offset, sieve) in self.seeds.items():
            h = runs(flat, g)
            at = np.flatnonzero(sieve[(h >> np.uint64(44)).astype(np.int64)])
            low, high = np.searchsorted(key, h[at], "left"), np.searchsorted(key, h[at], "right")
            n = high - low
            where = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            place, item, offset = np.repeat(at, n), item[where], offset[where]
            line = item * (len(flat) + 4 * self.steps) + place  # the items' hits one after another, far apart
            order = np.argsort(line, kind="stable")
            line, place, item, offset = line[order], place[order], item[order], offset[order]
            m, tau = self.m[item], self.tau[item]
            first = np.searchsorted(line, line, "left")
            after = np.searchsorted(line, line + m + tau, "right")
            enough = np.flatnonzero(after - first >= np.maximum(m - g + 1 - g * tau, 1))
            cover = np.zeros(len(line) + 1, dtype=np.int64)
            np.add.at(cover, first[enough], 1)
            np.add.at(cover, after[enough], -1)
            kept = np.cumsum(cover[:-1]) > 0
            text = np.searchsorted(ends, place[kept], "right")
            found.append(np.unique(np.stack([text, item[kept], place[kept] - offset[kept]]), axis=1))
        return tuple(np.concatenate(found, axis=1))

    def candidates(self, flat: np.ndarray, begin: np.ndarray, end: np.ndarray, items: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Which windows agree with their item in all positions of some table. begin, end: of each window's text."""
        keep = np.zeros(len(items), dtype=bool)
        for of in self.parts(items):
            m = self.m[items[of]]
            at = starts[of][:, None] + np.arange(int(m.max()) + 1)
            inside = (at >= begin[of][:, None]) & (at < end[of][:, None]) & (np.arange(at.shape[1]) < m[:, None])
            rows = np.where(inside, flat[np.clip(at, 0, len(flat) - 1)], np.uint64(0))
            same = self.embed(rows, m) == self.sampled[:, :, items[of]]
            keep[of] = same.reshape(WALKS, TABLES, SAMPLED, -1).all(axis=2).any(axis=(0, 1))
        return keep

    def distance(self, item: int, text: np.ndarray) -> int:
        """Least number of edits from the item to any part of the text (bit-parallel, over the item's words)."""
        words = self.words[item]
        m = len(words)
        where: dict = {}
        for k, w in enumerate(words.tolist()):
            where[w] = where.get(w, 0) | 1 << k
        full, top = (1 << m) - 1, 1 << (m - 1)
        up, down, now = full, 0, m
        best = m
        for w in text.tolist():
            eq = where.get(w, 0)
            xv = eq | down
            xh = (((eq & up) + up) ^ up) | eq
            ph, mh = down | ~(xh | up) & full, up & xh
            now += 1 if ph & top else -1 if mh & top else 0
            ph, mh = ph << 1 & full, mh << 1 & full
            up, down = mh | ~(xv | ph) & full, ph & xv
            best = min(best, now)
        return best

    def search(self, texts: list):
        """(row, item id, start word, edits) for each text and item that occurs in it; the best place, the first of equals."""
        codes = Codes()
        at = 0
        while at < len(texts) and len(self.ids):
            parts, first, size = [], at, 0
            while at < len(texts) and (size < CHUNK or at == first):
                parts.append(coded(texts[at] or b"", codes))
                size += len(parts[-1]) + RUN
                at += 1
            gap = np.zeros(RUN, dtype=np.uint64)
            flat = np.concatenate([x for p in parts for x in (p, gap)])
            ends = np.cumsum([len(p) + RUN for p in parts])
            begins = ends - np.array([len(p) + RUN for p in parts])
            text, items, starts = self.windows(flat, ends)
            if not len(items):
                continue
            begin, end = begins[text], ends[text] - RUN
            hits: dict = {}
            for k in np.flatnonzero(self.candidates(flat, begin, end, items, starts)):
                i, s, tau = int(items[k]), int(starts[k]), int(self.tau[items[k]])
                have = hits.get((int(text[k]), i))
                if have and have[0] == 0:
                    continue
                low, high = max(begin[k], s - tau), min(end[k], s + int(self.m[i]) + tau)
                edits = self.distance(i, flat[low:high])
                if edits <= tau and (not have or (edits, s - int(begin[k])) < have):
                    hits[int(text[k]), i] = (edits, s - int(begin[k]))
            for (t, i), (edits, s) in sorted(hits.items()):
                yield first + t, int(self.ids[i]), max(s, 0), edits


def _searching(index: Index, kind):
    def found(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = list(index.search(batch.column(1).to_pylist()))
            cols = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[r] for r in cols[0]], kind), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int32())],
                names=["doc_id", "item_id", "start_word", "edits"],
            )

    return found


def contaminated(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS, block: int = BLOCK, digests: bool = False) -> DataFrame:
    """doc_id, item_id, start_word, edits: every document (doc_id, text) in which an item (item_id, text) occurs.

    The driver holds items of `block` words at a time, or one that is longer; a larger benchmark takes a pass over the
    documents for each block. Null and empty texts and items match nothing; repeated items give a row each, and so do repeated documents. With
    `digests`, doc_id is instead the digest of the document's text.
    """
    small_batches(docs.sparkSession)
    key = text_digest(docs) if digests else docs["doc_id"].cast("long")
    texts = docs.select(key.alias("doc_id"), F.lower(docs["text"]).cast("binary").alias("text"))
    schema = f"doc_id {'string' if digests else 'long'}, item_id long, start_word int, edits int"
    out, waiting, held = None, [], 0

    def search():
        part = texts.mapInArrow(_searching(Index(waiting, edits), pa.string() if digests else pa.int64()), schema)
        return part if out is None else out.unionByName(part)

    for row in benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").toLocalIterator():
        size = len((row["text"] or "").split())
        if waiting and held + size > block:
            out, waiting, held = search(), [], 0
        waiting.append((row["item_id"], row["text"]))
        held += size
    return search() if waiting or out is None else out


def op9_decontaminate(spark, sf_dir):
    """Which items occur in which documents, and with how many edits; at which word (start_word) is the operator's to say."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id", "item_id", "edits")


def _oracle() -> str:
    """The edit distance of each item to any part of each text, column by column, for pairs that share as many runs of words as an occurrence must."""
    marks = MARKS.decode().replace("'", "''")
    words = f"list_transform(regexp_extract_all(lower(coalesce(text, '')), '[^\\x20\\x09-\\x0D]+'), lambda w: CASE WHEN trim(w, '{marks}') = '' THEN w ELSE trim(w, '{marks}') END)"
    runs = lambda of: f"list_transform(range(1, len({of}) - g + 2), lambda z: array_to_string({of}[z:z + g - 1], ' '))"
    # s: the least distance so far, then the distances of the item's beginnings to a part that ends before the word t
    column = "list_reduce(list_prepend([0], list_transform(range(1, m + 1), lambda i: [i])), lambda a, x: list_append(a, least(a[-1] + 1, s[x[1] + 2] + 1, s[x[1] + 1] + CASE WHEN item[x[1]] = text[t[1]] THEN 0 ELSE 1 END)))"
    step = f"list_transform([{column}], lambda n: list_prepend(least(s[1], n[-1]), n))[1]"
    edits = f"list_reduce(list_prepend(list_prepend(m, range(0, m + 1)), list_transform(range(1, len(text) + 1), lambda j: [j])), lambda s, t: {step})[1]"
    return f"""
WITH i AS (SELECT item_id, {words} AS item FROM benchmark),
j AS (SELECT item_id, item, len(item) AS m, CAST(floor(len(item) * {EDITS} + 1e-9) AS BIGINT) AS tau FROM i WHERE len(item) > 0),
h AS (SELECT *, least({RUN}, CAST(ceil((m - tau) / (tau + 1.0)) AS BIGINT)) AS g FROM j),
k AS (SELECT *, CASE WHEN len(list_distinct({runs("item")})) = m - g + 1 THEN greatest(m - g + 1 - g * tau, 1) ELSE 1 END AS least_runs FROM h),
d AS (SELECT doc_id, {words} AS text FROM documents),
a AS (SELECT item_id, g, unnest({runs("item")}) AS run FROM k),
b AS (SELECT doc_id, g, unnest({runs("text")}) AS run FROM d, (SELECT DISTINCT g FROM k)),
c AS (SELECT b.doc_id, a.item_id, count(DISTINCT a.run) AS n FROM b JOIN a USING (g, run) GROUP BY ALL),
e AS (SELECT c.doc_id, c.item_id, tau, {edits} AS edits FROM c JOIN k USING (item_id) JOIN d USING (doc_id) WHERE c.n >= least_runs)
SELECT doc_id, item_id, CAST(edits AS INTEGER) AS edits FROM e WHERE edits <= tau
"""


ORACLE = _oracle()


def stage(spark, docs, sf_dir):
    """Documents in which an item of the benchmark occurs go: by text, so that others without an id, or of the same id, stay."""
    bad = contaminated(docs, table(spark, sf_dir, "benchmark"), digests=True).select(F.col("doc_id").alias("bad_text")).distinct()
    return docs.join(bad, text_digest(docs) == bad["bad_text"], "left_anti")
