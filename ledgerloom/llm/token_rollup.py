"""Token counts as delta-maintained rollups: additive totals by source, language and tokenizer version.

A batch is a table of signed rows: +1 for what comes, -1 for what goes, both for a revised count. It is summed by key
(the totals are additive, so that this combines before the shuffle) and committed once as a small table under its
batch id; a batch that is committed again is left alone if its sums agree and refused if they differ. The totals are
the sum of the committed batches. A batch without Spark's _SUCCESS mark never counts and is written anew, so that a
commit can be repeated after any failure.

A compaction writes the totals, and the ids that they cover with a mark of each batch's sums, to a folder of its own;
one file that is created last makes it hold, and from then on the batches that it covers are only remembered. It may
break off anywhere and be repeated: nothing counts twice before, between or after its steps.
"""

from __future__ import annotations

import re
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import WORD, shared_dir, staged, table

KEYS = ("source", "lang", "version")
DELTA = "source string, lang string, version string, docs long, tokens long"
COVERS = "batch string, mark string"
#: Tokenizer versions that are one regular expression: words, and pieces as byte-pair tokenizers cut text beforehand.
VERSIONS = {"words-1": WORD, "pieces-1": r"\p{L}+|[0-9]{1,3}|[^\p{L}0-9\x20\x09-\x0D]+"}


def regex_counter(version: str):
    return lambda text: F.regexp_count(text, F.lit(VERSIONS[version])).cast("long")


def bpe_counter(path: str, pattern: str = r"\p{L}+|\p{N}{1,3}|[^\p{L}\p{N}\s]+|\s+"):
    """Counts by a public byte-pair vocabulary (a tiktoken file at `path`), whole texts in Arrow batches."""

    @F.pandas_udf("long")
    def count(batches: pd.Series) -> pd.Series:
        import tiktoken
        from tiktoken.load import load_tiktoken_bpe

        coder = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=load_tiktoken_bpe(path), special_tokens={})
        return batches.map(lambda t: len(coder.encode_ordinary(t)))

    return count


def counted(docs: DataFrame, counters: dict, text: Column | None = None) -> DataFrame:
    """doc_id, source, lang, version, tokens: a row for each document and version. A null text has no tokens."""
    text = F.coalesce(docs["text"] if text is None else text, F.lit(""))
    pairs = F.array(*[F.struct(F.lit(v).alias("version"), F.coalesce(f(text), F.lit(0).cast("long")).alias("tokens")) for v, f in counters.items()])
    return docs.select("doc_id", "source", "lang", F.explode(pairs).alias("x")).select("doc_id", "source", "lang", "x.version", "x.tokens")


def inserted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("sign", F.lit(1))


def deleted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("sign", F.lit(-1))


def revised(old: DataFrame, new: DataFrame) -> DataFrame:
    """The old rows go and the new ones come; where nothing has changed the two cancel in the sum."""
    return deleted(old).unionByName(inserted(new))


def _mark(sums: DataFrame) -> str:
    """Stands for a table of sums, whatever the order of its rows."""
    key = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("null"))
    row = F.xxhash64(*[key(c) for c in KEYS], "docs", "tokens")
    x = sums.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(row), F.lit(0)).alias("x"), F.sum("docs").alias("d"), F.sum("tokens").alias("t")).first()
    return f"{x.n}:{x.x}:{x.d}:{x.t}"


class TokenRollup:
    """Totals in `path`, a folder that driver and executors share. Batches are committed, and compacted, by one driver at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, batch: str) -> str:
        if not re.fullmatch(r"[\w.-]+", batch):
            raise ValueError(f"a batch id is made of letters, digits, '_', '.' and '-': {batch!r}")
        return f"{self.path}/batch={batch}"

    def _there(self, at: str) -> bool:
        return self._fs.exists(self._path(at))

    def _names(self, kind: str, done: str) -> list[str]:
        if not self._there(self.path):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.path))]
        return sorted(n.removeprefix(f"{kind}=") for n in names if n.startswith(f"{kind}=") and self._there(f"{self.path}/{n}/{done}"))

    def _holding(self) -> str | None:
        """The folder of the compaction that holds: the last that was ended."""
        found = self._names("compact", "_DONE")
        return f"{self.path}/compact={found[-1]}" if found else None

    def _covered(self) -> dict[str, str]:
        """The ids that the compaction covers, and their marks: a short string a batch."""
        at = self._holding()
        return {r.batch: r.mark for r in self.spark.read.schema(COVERS).parquet(f"{at}/covers").collect()} if at else {}

    def commit(self, batch: str, signed: DataFrame) -> bool:
        """Sums signed rows (source, lang, version, tokens, sign) and commits them once. False: it had been committed, compacted or not.

        Rows whose tokens or sign are null count nothing; null sources and languages are keys of their own.
        """
        at = self._at(batch)
        sums = signed.groupBy(*KEYS).agg(F.coalesce(F.sum("sign"), F.lit(0)).cast("long").alias("docs"), F.coalesce(F.sum(F.col("sign") * F.col("tokens")), F.lit(0)).cast("long").alias("tokens")).where("docs != 0 OR tokens != 0")
        had = self._covered().get(batch)
        if had is None and self._there(f"{at}/_SUCCESS"):
            had = _mark(self.spark.read.schema(DELTA).parquet(at))
        if had is not None:
            if _mark(sums) != had:
                raise ValueError(f"batch {batch} was committed with other sums")
            return False
        sums.write.mode("overwrite").parquet(at)
        return True

    def _open(self) -> list[str]:
        """Committed batches that no compaction covers."""
        covered = self._covered()
        return [b for b in self._names("batch", "_SUCCESS") if b not in covered]

    def batches(self) -> list[str]:
        """All ids that have been committed."""
        return sorted({*self._covered(), *self._names("batch", "_SUCCESS")})

    def totals(self) -> DataFrame:
        """source, lang, version, docs, tokens over the committed batches; keys whose totals are nought are gone."""
        at = self._holding()
        paths = ([f"{at}/sums"] if at else []) + [self._at(b) for b in self._open()]
        every = self.spark.read.schema(DELTA).parquet(*paths) if paths else self.spark.createDataFrame([], DELTA)
        return every.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs != 0 OR tokens != 0")

    def compact(self) -> None:
        """One table in place of all batches; the ids stay known. What it replaces is removed after it holds, by this run or the next."""
        covered, open_ = self._covered(), self._open()
        if open_:
            covered |= {b: _mark(self.spark.read.schema(DELTA).parquet(self._at(b))) for b in open_}
            number = int(self._names("compact", "_DONE")[-1]) + 1 if self._holding() else 1
            new = f"{self.path}/compact={number:010d}"
            self.totals().write.mode("overwrite").parquet(f"{new}/sums")
            self.spark.createDataFrame(sorted(covered.items()), COVERS).write.mode("overwrite").parquet(f"{new}/covers")
            self._fs.create(self._path(f"{new}/_DONE"), False).close()
        keep = self._holding()
        old = [f"{self.path}/compact={n}" for n in self._names("compact", "_DONE")] + [self._at(b) for b in self._names("batch", "_SUCCESS") if b in covered]
        for at in old:
            if at != keep:
                self._fs.delete(self._path(at), True)


def op1_token_counts(spark, sf_dir):
    """Loads all documents; then deletes repeated texts and revises the others' counts, numbers masked; then replays that batch, before a compaction and after.

    Of rows with one text that of the smallest id stays, an id being smaller than none; of equal ids that of the smallest
    source, then language. All is told by rows: texts without an id, and other texts of an id, stay.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    counters = {v: regex_counter(v) for v in VERSIONS}
    text = F.coalesce("text", F.lit(""))
    masked = F.regexp_replace(text, "[0-9]+", "0")
    counts = staged(  # the state that later batches are signed against: one small row a document
        docs.select("doc_id", "source", "lang", F.sha2(text, 256).alias("digest"), *[f(t).alias(f"{v}{k}") for v, f in counters.items() for k, t in (("", text), ("/masked", masked))]),
        "token-counts",
    )

    def rows(of: DataFrame, kind: str) -> DataFrame:
        return of.select("source", "lang", F.explode(F.array(*[F.struct(F.lit(v).alias("version"), F.col(f"`{v}{kind}`").alias("tokens")) for v in counters])).alias("x")).select("source", "lang", "x.*")

    order = [x for c in ("doc_id", "source", "lang") for x in (F.col(c).isNull(), F.col(c))]
    least = F.min(F.struct(*[x.alias(f"o{k}") for k, x in enumerate(order)], F.struct("source", "lang", *[f"`{v}/masked`" for v in counters]).alias("row")))
    stay = counts.groupBy("digest").agg(least.alias("least")).select("least.row.*")  # combined before the shuffle, however often a text repeats
    rollup = TokenRollup(spark, f"{shared_dir(spark)}/token-rollup-{uuid.uuid4().hex}")
    rollup.commit("1-load", inserted(rows(counts, "")))
    second = staged(revised(rows(counts, ""), rows(stay, "/masked")), "token-batch")
    rollup.commit("2-revise", second)
    rollup.commit("2-revise", second)
    rollup.compact()
    rollup.commit("2-revise", second)
    return rollup.totals()


ORACLE = r"""
WITH d AS (SELECT source, lang, regexp_replace(coalesce(text, ''), '[0-9]+', '0', 'g') AS t,
             row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id NULLS LAST, source NULLS LAST, lang NULLS LAST) AS place FROM documents),
s AS (SELECT * FROM d WHERE place = 1),
c AS (SELECT source, lang, 'words-1' AS version, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS n FROM s
      UNION ALL SELECT source, lang, 'pieces-1', len(regexp_extract_all(t, '\p{L}+|[0-9]{1,3}|[^\p{L}0-9\x20\x09-\x0D]+')) FROM s)
SELECT source, lang, version, count(*) AS docs, CAST(sum(n) AS BIGINT) AS tokens FROM c GROUP BY ALL
"""
