"""SimHash near-duplicates by multi-index hashing.

Two fingerprints at 4 differing bits or fewer agree in one of their two halves up to 2 bits. Both emit the values at 1
bit or fewer from each half, so that such two meet in a table bucket, where complete distances are verified. Equal
fingerprints are one entry. A bucket gives a spanning forest of its links, never all pairs. Half values that over CROWD
fingerprints have are counted beforehand: the fingerprints of all buckets that such a value goes to emit instead all
values at 2 bits or fewer from the whole fingerprint: two at 4 or fewer share such a value, all that share one are
linked, and at most 2081 can share one. So no bucket has more than 33 * CROWD fingerprints.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import fresh, join_weighted, small_batches, staged, table, text_digest
from ledgerloom.llm.components import connected

SHINGLE, SEED, RADIUS = 4, 42, 4
#: Fingerprints that have the same half, from which on their buckets are searched by whole fingerprints.
CROWD = 512
#: Shingles whose bits are counted at once.
CHUNK = 1 << 17


def _fingerprints(batches):
    """(doc_id, text as bytes, others) to (doc_id, fp, others)."""
    import numpy as np
    import pyarrow as pa
    from xxhash import xxh64_intdigest

    def hashes(text: bytes | None):
        words = (text or b"").lower().split()  # of bytes: A-Z only, and the six ASCII spaces
        if len(words) < SHINGLE:
            return [xxh64_intdigest(b" ".join(words), SEED)] if words else []
        line = b" ".join(words)
        at = list(accumulate(map(len, words), lambda a, n: a + n + 1, initial=0))
        return [xxh64_intdigest(line[a : b - 1], SEED) for a, b in zip(at, at[SHINGLE:])]

    def bits(flat):
        return np.unpackbits(flat.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")

    def majority(ones, totals):
        return np.packbits(ones * 2 > totals[:, None], axis=1, bitorder="little").view(np.int64).ravel()

    for batch in batches:
        fps = np.zeros(batch.num_rows, dtype=np.int64)
        rows, lengths, waiting, pending = [], [], [], 0

        def count():
            if rows:
                flat = np.array(waiting, dtype=np.uint64)
                starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
                fps[rows] = majority(np.add.reduceat(bits(flat), starts, axis=0, dtype=np.int64), np.array(lengths))

        for i, text in enumerate(batch.column(1)):
            found = hashes(text.as_py())
            if len(found) > CHUNK:  # a very long text, piece by piece
                ones = sum(bits(np.array(found[k : k + CHUNK], dtype=np.uint64)).sum(axis=0, dtype=np.int64) for k in range(0, len(found), CHUNK))
                fps[i] = majority(ones[None, :], np.array([len(found)]))[0]
            elif found:
                rows.append(i)
                lengths.append(len(found))
                waiting += found
                if len(waiting) > CHUNK:
                    count()
                    rows, lengths, waiting = [], [], []
        count()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps), *batch.columns[2:]], names=["doc_id", "fp", *batch.schema.names[2:]])


def fingerprints(docs: DataFrame, digest: bool = False) -> DataFrame:
    """doc_id, fp (64 bits as a signed long) of every row, and its text's digest if asked for; a null text is empty, and an empty one has fingerprint zero."""
    small_batches(docs.sparkSession)
    more = [text_digest(docs).alias("digest")] if digest else []
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("binary").alias("text"), *more).mapInArrow(_fingerprints, "doc_id long, fp long" + ", digest string" * digest)


def _forests(batches):
    """Buckets (array of fingerprints) to links (u, v) that span what is linked within each."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        us, vs = [], []
        for fps in batch.column(0):
            rest = np.unique(np.array(fps.values.to_numpy(zero_copy_only=False), dtype=np.int64)).view(np.uint64)
            while len(rest):
                queue, rest = [rest[0]], rest[1:]
                while queue and len(rest):
                    at = queue.pop()
                    near = np.bitwise_count(rest ^ at) <= RADIUS
                    if near.any():
                        queue += list(rest[near])
                        us += [np.full(near.sum(), at).view(np.int64)]
                        vs += [rest[near].view(np.int64)]
                        rest = rest[~near]
        cat = lambda x: pa.array(np.concatenate(x) if x else np.array([], dtype=np.int64))
        yield pa.RecordBatch.from_arrays([cat(us), cat(vs)], names=["u", "v"])


def _flips(value, bits: int):
    """The value, and the value with each of its low bits flipped."""
    return F.transform(F.sequence(F.lit(0), F.lit(bits)), lambda i: F.when(i == bits, value).otherwise(value.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))))


def links(fps: DataFrame, crowd: int = CROWD) -> DataFrame:
    """distinct fps (fp) to links (u, v) among them that connect all that are at RADIUS bits or fewer."""
    fp = F.col("fp")
    halves = F.array(F.struct(F.lit(0).alias("half"), fp.bitwiseAND(0xFFFFFFFF).alias("value")), F.struct(F.lit(1).alias("half"), F.shiftrightunsigned(fp, 32).alias("value")))
    own = fps.select("fp", F.explode(halves).alias("x")).select("fp", "x.half", "x.value")
    ball = F.explode(_flips(F.col("value"), 32)).alias("value")
    entries = own.select("fp", "half", ball)
    popular = staged(own.groupBy("half", "value").agg(F.count("*").alias("n")).where(F.col("n") > crowd), "simhash-popular")  # counted before the shuffle
    full = staged(popular.select("half", ball).distinct(), "simhash-full")  # the buckets that popular values go to
    rest = entries.join(full, ["half", "value"], "left_anti")
    met = rest.withColumn("n", F.count("*").over(Window.partitionBy("half", "value"))).where("n > 1")  # one shuffle for this and what follows
    found = met.groupBy("half", "value").agg(F.collect_list("fp").alias("fps")).select("fps").mapInArrow(_forests, "u long, v long")
    many = staged(entries.join(full, ["half", "value"], "left_semi").select("fp").distinct(), "simhash-crowd")
    one = _flips(fp, 64)
    pairs = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(62)), lambda i: F.transform(F.sequence(i + 1, F.lit(63)), lambda j: fp.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)).bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), j)))))
    balls = many.select("fp", F.explode(F.concat(one, pairs)).alias("z"))
    stars = balls.withColumn("least", F.min("fp").over(Window.partitionBy("z"))).where("fp != least").select(F.col("least").alias("u"), F.col("fp").alias("v")).distinct()
    return found.unionByName(stars)


def near_duplicates(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """doc_id, fp, component_id of every row of docs (doc_id, text); component_id is the smallest doc_id that links reach.

    Rows of one id, and repeated rows, stay; null ids never are a component's id unless it has no other.
    """
    rows = staged(fingerprints(docs), "simhash-rows")
    return join_weighted(rows, _labels(rows, crowd), "fp", "n").select("doc_id", "fp", "component_id")


def _labels(rows: DataFrame, crowd: int = CROWD) -> DataFrame:
    """fp, component_id, root (the component's least fingerprint), n (rows) of every fingerprint of rows (doc_id, fp)."""
    every = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "simhash-fps")
    roots = connected(links(every.select("fp"), crowd)).withColumnRenamed("node", "fp")
    linked = staged(every.join(roots, "fp"), "simhash-linked")
    least = staged(linked.groupBy("root").agg(F.min("least").alias("reached"), F.count("*").alias("fps")), "simhash-least")
    reached = join_weighted(linked.select("fp", "root"), least, "root", "fps").select("fp", "root", "reached")
    return staged(every.join(reached, "fp", "left").select("fp", F.coalesce("reached", "least").alias("component_id"), F.coalesce("root", "fp").alias("root"), "n"), "simhash-labels")


def op5_simhash_dedup(spark, sf_dir):
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _oracle() -> str:
    """XXH64 lane by lane, bits by sums, and links among all fingerprints."""
    p1, p2, p3, p4, p5 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261  # fixed values of the hash
    whole = 1 << 64
    times = lambda a, b: f"CAST((CAST({a} AS UHUGEINT) * CAST({b} AS UHUGEINT)) % CAST('{whole}' AS UHUGEINT) AS UBIGINT)"
    plus = lambda a, b: f"CAST((CAST({a} AS UHUGEINT) + CAST({b} AS UHUGEINT)) % CAST('{whole}' AS UHUGEINT) AS UBIGINT)"
    let = lambda value, name, use: f"list_transform([{value}], lambda {name}: {use})[1]"
    turn = lambda x, n: let(x, "r", f"((r & {(whole - 1) >> n}::UBIGINT) << {n}::UBIGINT) | (r >> {64 - n}::UBIGINT)")
    step = lambda acc, lane: times(turn(plus(acc, times(lane, p2)), 31), p1)
    lane = lambda at, size: "('0x' || " + " || ".join(f"substr(x, {at} + {k}, 2)" for k in range(2 * size - 1, 0, -2)) + ")::UBIGINT"
    stripes = f"list_transform(range(0, n // 32), lambda i: [{', '.join(lane(f'64 * i + {16 * k}', 8) for k in range(4))}])"
    first = [(SEED + p1 + p2) % whole, (SEED + p2) % whole, SEED, (SEED - p1) % whole]
    lanes = f"list_reduce(list_prepend([{', '.join(f'{v}::UBIGINT' for v in first)}], {stripes}), lambda v, t: [{', '.join(step(f'v[{k}]', f't[{k}]') for k in (1, 2, 3, 4))}])"
    joined = plus(plus(plus(turn("v[1]", 1), turn("v[2]", 7)), turn("v[3]", 12)), turn("v[4]", 18))
    for k in (1, 2, 3, 4):
        joined = plus(times(f"xor({joined}, {step('0', f'v[{k}]')})", p1), p4)
    eights = f"list_transform(range(0, (n % 32) // 8), lambda i: {lane('64 * (n // 32) + 16 * i', 8)})"
    fours = f"list_transform(range(0, (n % 8) // 4), lambda i: {lane('16 * (n // 8)', 4)})"
    ones = f"list_transform(range(0, n % 4), lambda i: {lane('8 * (n // 4) + 2 * i', 1)})"
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < {SHINGLE} THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - {SHINGLE - 2}), lambda i: array_to_string(words[i:i + {SHINGLE - 1}], ' ')) END) AS shingle FROM w),
b AS (SELECT shingle, lower(hex(encode(shingle))) AS x FROM (SELECT DISTINCT shingle FROM s)),
c AS (SELECT shingle, x, length(x) // 2 AS n FROM b),
d AS (SELECT *, CASE WHEN n >= 32 THEN {let(lanes, "v", joined)} ELSE {(SEED + p5) % whole}::UBIGINT END AS h FROM c),
e AS (SELECT shingle, x, n, list_reduce(list_prepend({plus('h', 'n')}, {eights}), lambda a, k: {plus(times(turn(f"xor(a, {step('0', 'k')})", 27), p1), p4)}) AS h FROM d),
f AS (SELECT shingle, x, n, list_reduce(list_prepend(h, {fours}), lambda a, k: {plus(times(turn(f"xor(a, {times('k', p1)})", 23), p2), p3)}) AS h FROM e),
g AS (SELECT shingle, list_reduce(list_prepend(h, {ones}), lambda a, k: {times(turn(f"xor(a, {times('k', p5)})", 11), p1)}) AS h FROM f),
i AS (SELECT shingle, {times("xor(h, h >> 33)", p2)} AS h FROM g),
j AS (SELECT shingle, {times("xor(h, h >> 29)", p3)} AS h FROM i),
k AS (SELECT shingle, xor(h, h >> 32) AS h FROM j),
m AS (SELECT doc_id, {" + ".join(f"CASE WHEN 2 * sum(CAST((h >> {z}) & 1 AS BIGINT)) > count(*) THEN {1 << z}::UBIGINT ELSE 0 END" for z in range(64))} AS fp FROM s JOIN k USING (shingle) GROUP BY doc_id),
o AS (SELECT doc_id, CAST(coalesce(fp, 0) AS UBIGINT) AS fp FROM documents LEFT JOIN m USING (doc_id)),
q AS (SELECT fp, min(doc_id) AS least FROM o GROUP BY fp),
l AS (SELECT a.fp AS u, z.fp AS v FROM q a JOIN q z ON bit_count(xor(a.fp, z.fp)) <= {RADIUS} AND a.fp <> z.fp),
r(fp, met) AS (SELECT fp, fp FROM q UNION SELECT r.fp, l.v FROM r JOIN l ON r.met = l.u),
t AS (SELECT r.fp, min(q.least) AS component_id FROM r JOIN q ON q.fp = r.met GROUP BY r.fp)
SELECT doc_id, printf('%016x', fp) AS fingerprint, component_id FROM o JOIN t USING (fp)
"""


ORACLE = _oracle()


def stage(spark, docs, sf_dir):
    """One document of each component stays: that of the smallest id, null if it has no other, and of its rows the one whose text sorts first, then the one whose columns' digest does.

    A row that comes first is found before rows are shuffled, so that a component of any number of rows is no hot group.
    Components are told apart by their fingerprints and rows by id and text, so that unlinked texts without an id, or of one id, all stay.
    """
    rows = staged(fingerprints(docs, digest=True), "simhash-rows")
    labelled = join_weighted(rows, _labels(rows), "fp", "n").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    digest, group = fresh(docs, "digest"), fresh(docs, "component")
    keep = labelled.select(F.col("doc_id").alias("kept_id"), F.col("digest").alias("kept_digest"), F.col("root").alias(group)).distinct()
    found = docs.withColumn(digest, text_digest(docs))
    kept = found.join(keep, found["doc_id"].eqNullSafe(keep["kept_id"]) & (found[digest] == keep["kept_digest"])).select(*[found[c] for c in docs.columns], keep[group])
    others = F.sha2(F.to_json(F.struct(*docs.columns)).cast("binary"), 256)  # columns of any type, those that have no order too
    place = F.struct(F.col("text").isNotNull(), F.coalesce("text", F.lit("")), others)
    return kept.groupBy(group).agg(F.min_by(F.struct(*docs.columns), place).alias(digest)).select(f"`{digest}`.*")
