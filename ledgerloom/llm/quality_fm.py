"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata (the length on record) of a text.

y = b + sum_j w_j x_j + 1/2 sum_f [ (sum_j v_jf x_j)^2 - sum_j v_jf^2 x_j^2 ]: the pairwise interactions of all features
in time linear in those a text has. Fitted by AdaGrad on a bounded sample of labelled rows; scored in place, row by row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import fresh, small_batches, table

#: Buckets of words; bins of each statistic; rank of the interactions.
WORDS, BINS, RANK = 1 << 13, 16, 8
#: Labelled rows that the model is fitted on, at most: those whose id has the smallest hash.
SAMPLE = 4096
ROUNDS, STEP, DECAY = 6, 0.1, 1e-4
#: A document is kept from this score on.
KEEP = 0.3
#: Every so many documents by crc32 of the id are held out.
FOLDS = 5
#: Value of a statistic's feature; words together have length one.
STRENGTH = 0.5
STATISTICS = 12
#: Words whose bucket a worker remembers.
REMEMBERED = 1 << 18


@dataclass
class Model:
    b: float
    w: np.ndarray
    v: np.ndarray

    def margin(self, j: np.ndarray, x: np.ndarray) -> float:
        v = self.v[j]
        s = x @ v
        return float(self.b + x @ self.w[j] + 0.5 * (s @ s - (x * x) @ (v * v).sum(axis=1)))


class _Buckets(dict):
    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        at = xxh64_intdigest(word, 0) % WORDS
        if len(self) < REMEMBERED:
            self[word] = at
        return at


def features(text: bytes, buckets: dict, n_chars: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values: words by bucket, then one bin of each statistic, the last of the metadata: the length on record. An empty text has statistics only."""
    words = text.split()
    n = len(words)
    chars = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    size = max(len(text), 1)
    found, counts, again = np.zeros(0, dtype=np.int64), np.zeros(0), 0
    if n:
        codes = np.fromiter(map(buckets.__getitem__, words), dtype=np.int64, count=n)
        again = (codes[1:] == codes[:-1]).sum()
        counts = np.bincount(codes, minlength=WORDS)
        found = np.flatnonzero(counts)
        counts = counts[found].astype(np.float64)
    lines = chars[10] + 1
    letters = chars[65:91].sum() + chars[97:123].sum() + chars[128:].sum()
    marks = size - letters - chars[48:58].sum() - chars[32] - chars[10] - chars[44] - chars[46]
    per = max(n, 1)
    share = lambda x, scale: min(BINS - 1, int(x * scale))
    stats = (
        min(BINS - 1, n.bit_length()), share(marks / size, 60), share(chars[65:91].sum() / max(letters, 1), 20), share(chars[48:58].sum() / size, 40),
        share(size / per, 1), share(len(found) / per, 15), share(counts.max() / per if n else 0, 15), min(BINS - 1, int(per / lines).bit_length()),
        share(chars[124] / per, 15), min(BINS - 1, int(lines).bit_length()), share(again / per, 30),
        BINS - 1 if n_chars is None else min(BINS - 2, max(0, n_chars).bit_length()),
    )
    j = np.concatenate([found, WORDS + BINS * np.arange(STATISTICS) + np.array(stats, dtype=np.int64)])
    norm = np.sqrt((counts * counts).sum()) if n else 1.0
    return j, np.concatenate([counts / norm, np.full(STATISTICS, STRENGTH)])


def _recorded(docs: DataFrame) -> Column:
    """The length that docs has on record, null where it has no such column."""
    return docs["n_chars"].cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")


def _examples(batches):
    buckets = _Buckets()
    for batch in batches:
        rows = [features(t.as_py() or b"", buckets, n.as_py()) for t, n in zip(batch.column(1), batch.column(3), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([r[0] for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.list_(pa.float32()))], names=["doc_id", "label", "j", "x"])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rounds: int = ROUNDS, seed: int = 7) -> Model:
    """Fits on documents (doc_id, text) with a label (doc_id, quality 0 or 1), those held out excepted.

    At most `sample` labelled ids, and as many of their rows, are used, so that what the driver gathers is bounded (by
    sample * WORDS numbers) whatever the tables' sizes. Rows without an id or a label are left out; of labels that
    contradict each other the smaller holds. Without any row every score is one half.
    """
    small_batches(docs.sparkSession)
    chosen = labels.select("doc_id", F.col("quality").cast("int").alias("label")).where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = chosen.groupBy("doc_id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"), _recorded(docs).alias("n_chars")).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label", "n_chars")
    rows = texts.mapInArrow(_examples, "doc_id long, label int, j array<int>, x array<float>").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("j", "x")).limit(sample).toArrow()
    size = WORDS + BINS * STATISTICS
    draw = np.random.default_rng(seed)
    m = Model(0.0, np.zeros(size), draw.normal(0, 0.05, (size, RANK)))
    y = rows.column("label").to_numpy()
    js = [np.asarray(a.values) for a in rows.column("j")]
    xs = [np.asarray(a.values, dtype=np.float64) for a in rows.column("x")]
    gb, gw, gv = 1.0, np.ones(size), np.ones((size, RANK))
    for _ in range(rounds):
        for i in draw.permutation(len(y)):
            j, x = js[i], xs[i]
            off = 1.0 / (1.0 + np.exp(-np.clip(m.margin(j, x), -30, 30))) - y[i]
            v = m.v[j]
            dw = off * x + DECAY * m.w[j]
            dv = off * (x[:, None] * (x @ v) - v * (x * x)[:, None]) + DECAY * v
            gb += off * off
            gw[j] += dw * dw
            gv[j] += dv * dv
            m.b -= STEP * off / np.sqrt(gb)
            m.w[j] -= STEP * dw / np.sqrt(gw[j])
            m.v[j] -= STEP * dv / np.sqrt(gv[j])
    return m


def scorer(model: Model):
    """A function of columns: the probability that a text, of a length on record, is of label 1; a null text is empty."""

    @F.arrow_udf("double")
    def score(texts: pa.Array, lengths: pa.Array) -> pa.Array:
        buckets = _Buckets()
        margins = [model.margin(*features(t.as_py() or b"", buckets, n.as_py())) for t, n in zip(texts, lengths, strict=True)]
        return pa.array(1.0 / (1.0 + np.exp(-np.clip(np.array(margins), -700, 700))), pa.float64())

    return lambda text, length: score(text.cast("binary"), length)


def scored(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """docs (text, and n_chars if there is one) with a column of scores more; every row stays."""
    small_batches(docs.sparkSession)
    return docs.withColumn(name, scorer(model)(F.coalesce(docs["text"], F.lit("")), _recorded(docs)))


def op4_quality_fm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    out = scored(docs.select("doc_id", "text", "n_chars"), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score").withColumn("predicted", (F.col("score") >= KEEP).cast("int"))


def stage(spark, docs, sf_dir):
    """Documents of a score under KEEP go."""
    name = fresh(docs, "score")
    return scored(docs, fit(docs, table(spark, sf_dir, "labels")), name).where(F.col(name) >= KEEP).drop(name)
