"""Phrase collocations by suffix-sigma.

Each word of a piece of text begins a suffix, cut off after the longest phrase's words. Suffixes are shuffled by language
and first word and sorted in reverse lexicographic order, so that all that begin alike lie together, longer ones first: a
stack of the phrases that are open then counts all prefixes, that is all phrases of all lengths, in one pass. A phrase is
closed, and known, when the order leaves it. What phrases are made of is joined to them afterwards.

Before the shuffle equal suffixes of a chunk are added up, and a chunk comes out in order, which makes sorting a merge.
Words that begin over 1/HEAVY of all suffixes go by their second word too, and such pairs by all words; their own counts
are added up over the parts.

No phrase occurs more often than a word of it. So a suffix ends before a word that is too rare, and one that begins with
such a word is left out; words are counted by hash before, so that none is taken for rarer than it is.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import small_batches, staged, summed_before, table

#: Words of the longest phrase; occurrences of a phrase, at least; of a language so many are returned; percent of its occurrences within a longer one, from which on a phrase is dropped.
LONGEST, LEAST, TOP, WITHIN = 3, 10, 2000, 50
#: Suffixes that are added up before the shuffle.
CHUNK = 1 << 19
#: Suffixes that are counted at once: Arrow batches are short, for the sake of whole texts.
TOGETHER = 1 << 15
#: Numbers that words are hashed to, a bit each in every task; a task adds up so many of their counts.
BUCKETS, COUNTED = 1 << 26, 1 << 22
#: Fewer words, and fewer pairs, than this are heavy, whatever the input.
HEAVY = 1024
#: A-Z lower-cased; what parts pieces becomes a full stop, which no word can have then; the other space a blank.
TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"." * 9 + b" ")


def _escaped(lang: str) -> bytes:
    return lang.replace("\\", "\\\\").replace("\t", "\\t").encode()


class _Numbers(dict):
    """Words to numbers, as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return self[word]


def _chunks(batches, longest: int, ordered: bool = True):
    """(lang, text) to chunks: languages, words (the first of either is for none), and of each suffix the numbers of its language and of its words, 0 where it has no more. Numbers go by the words' order if asked for."""
    tokens, owners, sizes, size = [], [], [], 0

    def chunk():
        names = [b"", *sorted(set(owners))]
        number = _Numbers({b".": 0})
        codes = np.fromiter(map(number.__getitem__, tokens), dtype=np.int64, count=len(tokens))
        words = list(number)[1:]
        if ordered:
            place = sorted(range(len(words)), key=words.__getitem__)
            rank = np.zeros(len(number), dtype=np.int64)
            rank[np.array(place, dtype=np.int64) + 1] = np.arange(1, len(number))
            codes, words = rank[codes], [words[k] for k in place]
        lang = np.repeat(np.array([names.index(o) for o in owners] if len(names) < 50 else list(map({o: k for k, o in enumerate(names)}.get, owners))), [whole for _, whole in sizes])
        own = np.repeat(np.tile([True, False], len(sizes)), [k for n, whole in sizes for k in (n, whole - n)])
        columns = [codes]
        for _ in range(longest - 1):
            columns.append(np.where(columns[-1] > 0, np.append(columns[-1][1:], 0), 0))
        start = own & (codes > 0)
        return names, [b"", *words], lang[start], [c[start] for c in columns]

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            words = (text.as_py() or b"").translate(TABLE).replace(b".", b" . ").split()
            for at in range(0, len(words), CHUNK):  # the next words belong to what begins before them
                part = words[at : at + CHUNK + longest - 1]
                tokens += part
                tokens.append(b".")
                owners.append(_escaped(lang))
                sizes.append((min(CHUNK, len(part)), len(part) + 1))
                size += len(part)
                if size >= CHUNK:
                    yield chunk()
                    tokens, owners, sizes, size = [], [], [], 0
    if tokens:
        yield chunk()


def _packed(first: np.ndarray, bound: int, columns: list[np.ndarray], base: int) -> np.ndarray:
    """One number for each row, in the order of its columns."""
    key = first
    for c in columns:
        if bound * base >= 1 << 63:
            key = np.unique(key, return_inverse=True)[1]
            bound = len(key)
        key, bound = key * base + c, bound * base
    return key


def _distinct(first: np.ndarray, bound: int, columns: list[np.ndarray], base: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows in the order of their columns, and how often each occurs."""
    key = _packed(first, bound, columns, base)
    if bound * base ** len(columns) < 1 << 63:  # then a number says what it was packed from
        key, n = np.unique(key, return_counts=True)
        out = []
        for _ in columns:
            key, c = np.divmod(key, base)
            out.append(c)
        return [key, *out[::-1]], n
    _, at, n = np.unique(key, return_index=True, return_counts=True)
    return [first[at], *(c[at] for c in columns)], n


def _buckets(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, words), dtype=np.int64, count=len(words)) & (BUCKETS - 1)


def _table(phrases, words, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(phrases, pa.binary()), pa.array(words, pa.int32()), pa.array(n, pa.int64())], names=["phrase", "words", "n"])


def _hashed(waiting: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """(buckets, counts) to (bucket of 4 bytes, -1, n), one a bucket."""
    of, at = np.unique(np.concatenate([b for b, _ in waiting]), return_inverse=True)
    n = np.bincount(at, weights=np.concatenate([n for _, n in waiting])).astype(np.int64)
    keys = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4), len(of), [None, pa.py_buffer(of.astype(">u4").tobytes())])
    return _table(keys.cast(pa.binary()), np.full(len(of), -1), n)


def _frequent(longest: int):
    """(lang, text) to (phrase, words, n): of each chunk the words of each language (words: 0), and of its words and pairs those that may be heavy; and all words by hash (words: -1)."""

    def run(batches):
        waiting, size = [], 0
        for names, words, lang, columns in _chunks(batches, longest, ordered=False):
            waiting.append((_buckets(words[1:]), np.bincount(columns[0], minlength=len(words))[1:]))
            size += len(words)
            if size >= COUNTED:
                yield _hashed(waiting)
                waiting, size = [], 0
            out = [(names[k], 0, n) for k, n in enumerate(np.bincount(lang).tolist()) if n]
            for depth in range(1, min(3, longest)):
                if depth == 1:  # what is rare in all languages is rare in each
                    often = (np.bincount(columns[0], minlength=len(words)) * 2 * HEAVY > len(lang))[columns[0]]
                else:
                    often = np.isin(_packed(lang, len(names), columns[:1], len(words)), _packed(found[0], len(names), found[1:2], len(words))) & (columns[1] > 0)
                found, n = _distinct(lang[often], len(names), [c[often] for c in columns[:depth]], len(words))
                heavy = n * 2 * HEAVY > len(lang)
                found, n = [c[heavy] for c in found], n[heavy]
                out += [(b"\t".join([names[k], *[words[c] for c in of]]), depth, i) for k, *of, i in zip(*(c.tolist() for c in found), n.tolist(), strict=True)]
            yield _table(*(zip(*out, strict=True) if out else ((), (), ())))
        if waiting:
            yield _hashed(waiting)

    return run


def _suffixes(longest: int, heavy: set[bytes], often: np.ndarray):
    """(lang, text) to (head, tail, n): a suffix's words, each followed by a tab, after its language; the head is what it is shuffled by. often: a bit for each bucket, of words that may occur often enough."""

    def run(batches):
        for names, words, lang, columns in _chunks(batches, longest):
            bucket = _buckets(words)
            there = (often[bucket >> 6] >> (bucket & 63) & 1).astype(bool)
            there[0] = False
            own = there[columns[0]]
            lang, columns = lang[own], [c[own] for c in columns]
            for k in range(1, longest):
                columns[k] = np.where((columns[k - 1] > 0) & there[columns[k]], columns[k], 0)
            (lang, *columns), n = _distinct(lang, len(names), columns, len(words))
            lang, columns, n = lang[::-1], [c[::-1] for c in columns], n[::-1]
            number = {w: k for k, w in enumerate(words)}
            known = [[names.index(parts[0]), *[number[w] for w in parts[1:]]] for h in heavy if (parts := h.split(b"\t"))[0] in names and all(w in number for w in parts[1:])]
            depth = np.ones(len(lang), dtype=np.int64)
            for size in (1, 2):
                of = np.array([k for k in known if len(k) == size + 1], dtype=np.int64).reshape(-1, size + 1)
                if len(of):
                    key = _packed(lang, len(names), columns[:size], len(words))
                    depth[np.isin(key, _packed(of[:, 0], len(names), list(of[:, 1:].T), len(words)))] = size + 1
            depth = np.minimum(depth, longest)
            spelled = pa.array([b"", *[w + b"\t" for w in words[1:]], b"\t"], pa.binary())
            lead = pa.array([x + b"\t" for x in names], pa.binary()).take(pa.array(lang))
            mark = len(words)  # no word where the head wants one
            heads = [np.where(depth > k, np.where(c > 0, c, mark), 0) if k else c for k, c in enumerate(columns)]
            tails = [np.where(depth > k, 0, c) for k, c in enumerate(columns)]
            join = lambda *x: pc.binary_join_element_wise(*x, b"")
            yield pa.RecordBatch.from_arrays([join(lead, *[spelled.take(pa.array(c)) for c in heads]), join(*[spelled.take(pa.array(c)) for c in tails]), pa.array(n)], names=["head", "tail", "n"])

    return run


def _together(batches):
    """Batches joined to such of TOGETHER rows or more, but for the last."""
    waiting, size = [], 0
    for batch in batches:
        if batch.num_rows:
            waiting.append(batch)
            size += batch.num_rows
        if size >= TOGETHER:
            yield pa.concat_batches(waiting)
            waiting, size = [], 0
    if waiting:
        yield pa.concat_batches(waiting)


def _counted(longest: int, least: int):
    """(head, tail, n) in reverse order to (phrase, words, n): each phrase that occurs often enough, or of which other tasks have more."""

    def run(batches):
        stack: list = [None] * longest  # by number of words: the phrase that is open, its count, and whether to tell it

        for batch in _together(batches):
            head, tail, n = batch.column(0), batch.column(1), batch.column(2).to_numpy()
            parts = pc.split_pattern(pc.binary_join_element_wise(head, tail, b""), b"\t")
            low = parts.offsets.to_numpy()
            flat = pa.concat_arrays([parts.values, pa.array([b""], parts.values.type)])
            column = lambda k: flat.take(pa.array(np.where(low[:-1] + k < low[1:], low[:-1] + k, len(flat) - 1)))  # noqa: E731,B023
            differ = lambda c: pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)
            deep = pc.count_substring(head, b"\t").to_numpy() - 1
            words = [column(0)]
            new = differ(words[0])
            closed = []
            for size in range(1, longest + 1):
                words.append(column(size))
                new = new | differ(words[-1])
                start = np.concatenate([[0], np.flatnonzero(new) + 1])
                total = np.add.reduceat(n, start)
                spelled = lambda at, words=words: pc.binary_join_element_wise(*[w.take(pa.array(at)) for w in words], b"\t").to_pylist()
                first, last = spelled(start[[0, -1]])
                if stack[size - 1]:
                    if stack[size - 1][0] == first:
                        total[0] += stack[size - 1][1]
                    elif stack[size - 1][2] or stack[size - 1][1] >= least:
                        closed.append((stack[size - 1][0], size, stack[size - 1][1]))
                there = pc.binary_length(words[-1]).to_numpy()[start] > 0
                part = deep[start] > size  # other tasks have suffixes that begin so, too
                stack[size - 1] = (last, int(total[-1]), bool(part[-1])) if there[-1] else None
                tell = np.flatnonzero(there[:-1] & (part[:-1] | (total[:-1] >= least)))
                closed += zip(spelled(start[tell]), [size] * len(tell), total[tell].tolist(), strict=True)
            if closed:
                yield _table(*zip(*closed, strict=True))
        if rest := [(s[0], k, s[1]) for k, s in enumerate(stack, 1) if s and (s[2] or s[1] >= least)]:
            yield _table(*zip(*rest, strict=True))

    return run


COUNTS = "phrase binary, words int, n long"


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, n): words of each language; (phrase, words, n): occurrences of each phrase of up to `longest` words that has `least` or more, led by the language and a tab, words parted by tabs."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"), docs["text"].cast("binary").alias("text"))
    seen = texts.mapInArrow(_frequent(longest), COUNTS).groupBy("phrase", "words").agg(F.sum("n").alias("n"))
    seen = staged(seen.where((F.col("words") >= 0) | (F.col("n") >= least)), "phrase-heavy")
    total = seen.where("words = 0").agg(F.sum("n")).first()[0] or 0
    heavy = {bytes(r.phrase) for r in seen.where((F.col("words") > 0) & (F.col("n") * HEAVY > total)).collect()}  # fewer than HEAVY of each length
    bucket = F.conv(F.hex("phrase"), 16, 10).cast("long")
    bits = seen.where("words = -1").groupBy((bucket / 64).cast("long").alias("at")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (bucket % 64).cast("int"))).alias("bits")).toArrow()
    often = np.zeros(BUCKETS // 64, dtype=np.int64)  # 8 MB, whatever the input
    often[bits["at"].to_numpy()] = bits["bits"].to_numpy()
    suffixes = texts.mapInArrow(_suffixes(longest, heavy, often), "head binary, tail binary, n long")
    ordered = suffixes.repartition("head").sortWithinPartitions(F.desc("head"), F.desc("tail"))
    found = ordered.mapInArrow(_counted(longest, least), COUNTS).groupBy("phrase", "words").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return seen.where("words = 0").select(F.col("phrase").cast("string").alias("lang"), "n"), staged(found.withColumn("phrase", F.col("phrase").cast("string")), "phrase-counts")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, within: int = WITHIN) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: of each language the `top` phrases of 2 to `longest` words by score, then a, then phrase.

    Texts are lower-cased (A-Z), parted into pieces at .,;:!? and line ends and into words at spaces and tabs; phrases lie
    within a piece. a is a phrase's occurrences, `least` or more; cut into two, its parts have l and r; its score,
    1000000*a*a/(l*r), is that of the cut where it is least, of the first such. Phrases are left out that occur to `within`
    percent or more in one longer phrase. n is all words of the language. A null language is und, a null text empty; each
    row counts, those of one id or of one text too. Counts may go to 10**16, products being exact to 38 digits.
    """
    sizes, counts = phrase_counts(docs, longest, least)
    words = F.split("phrase", "\t")
    many = counts.where("words > 1").select("phrase", "words", F.col("n").alias("a"), words.alias("parts"))
    run = lambda at, size: F.concat_ws("\t", F.element_at("parts", 1), F.slice("parts", at + 2, size))
    cut = many.select("phrase", "a", "words", "parts", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cut = cut.select("phrase", "a", "k", run(F.lit(0), F.col("k")).alias("left"), run(F.col("k"), F.col("words") - F.col("k")).alias("right"))
    cut = cut.join(counts.select(F.col("phrase").alias("left"), F.col("n").alias("l")), "left").join(counts.select(F.col("phrase").alias("right"), F.col("n").alias("r")), "right")
    score = F.expr("(cast(a as decimal(19, 0)) * cast(a as decimal(19, 0)) * 1000000) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")
    lowest = cut.groupBy("phrase").agg(F.min(F.struct(score.alias("score"), "k", "a", "l", "r")).alias("of")).select("phrase", "of.*")
    inner = many.where("words > 2").select("a", "parts", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size"), "words").select("a", "parts", "size", F.explode(F.sequence(F.lit(0), F.col("words") - F.col("size"))).alias("at"))
    longer = inner.groupBy(run(F.col("at"), F.col("size")).alias("phrase")).agg(F.max("a").alias("longer"))
    left = lowest.join(longer, "phrase", "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * within))
    named = left.select(words[0].alias("lang"), F.concat_ws(" ", F.slice(words, 2, longest)).alias("phrase"), "a", "l", "r", "score")
    order = [F.col("lang"), F.desc("score"), F.desc("a"), F.col("phrase")]
    placed = staged(summed_before(named, order, place=F.lit(1).cast("long")), "phrase-places")
    first = placed.groupBy("lang").agg(F.min("place").alias("first"))
    ranked = placed.join(first, "lang").withColumn("rank", F.col("place") - F.col("first") + 1).where(F.col("rank") <= top)
    plain = F.replace(F.replace(F.replace("lang", F.lit("\\\\"), F.lit("\t\t")), F.lit("\\t"), F.lit("\t")), F.lit("\t\t"), F.lit("\\"))  # as it was before it was written with marks
    return ranked.join(sizes, "lang").select(plain.alias("lang"), "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
q AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
p AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM q),
f AS MATERIALIZED (SELECT lang, phrase, size, count(*) AS f FROM (
        {" UNION ALL ".join(f"SELECT lang, {k} AS size, unnest(list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i:i + {k - 1}], ' '))) AS phrase FROM p" for k in range(1, LONGEST + 1))}) GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT lang, phrase, size, f, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= {LEAST}),
u AS (SELECT lang, phrase, f AS a, k, array_to_string(w[:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
k AS (SELECT u.lang, u.phrase, a, x.f AS l, y.f AS r, k, CAST(1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f) AS BIGINT) AS score
      FROM u JOIN f x ON x.lang = u.lang AND x.phrase = u.x JOIN f y ON y.lang = u.lang AND y.phrase = u.y),
b AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (SELECT lang, array_to_string(w[z:z + size - 1], ' ') AS phrase, max(f) AS longer FROM (
        SELECT lang, w, f, size, unnest(range(1, len(w) - size + 2)) AS z FROM (SELECT lang, w, f, unnest(range(2, size)) AS size FROM c)) GROUP BY ALL),
s AS (SELECT lang, phrase, a, l, r, score FROM b LEFT JOIN i USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < {WITHIN} * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM s JOIN n USING (lang) QUALIFY rank <= {TOP}
"""
