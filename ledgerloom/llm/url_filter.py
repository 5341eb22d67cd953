"""URL filters with built-in functions only: host and path rules, else logistic regression on hashed character n-grams.

The model is fitted by stochastic gradient steps, in one expression over a small labelled table of URLs, and comes back
as one row of DIMS + 1 weights. Scoring a page is a sum over its n-grams' weights: no join, no shuffle.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import table

#: Verdict, host, path. The longest rule that fits holds.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Length of an n-gram, number of buckets, rounds over the labelled table, step, threshold of the verdict.
GRAM, DIMS, ROUNDS, STEP, THRESHOLD = 3, 2048, 12, 3.0, 0.5
#: The labelled table is made of these: stems of unwanted hosts, what goes with a stem, and wanted hosts: common nouns, by how common they are.
UNWANTED = "casino poker bets slots jackpot pills viagra pharma adult porn escort cams spam popup ads track loans replica warez keygen".split()
WITH = "online daily best house free group live farm shop world win club".split()
WANTED = (
    "people history way art world information map family government health system computer meat year thanks music person reading method data food understanding theory law bird "
    "literature problem software control knowledge power ability economics love internet television science library nature fact product idea temperature investment area society "
    "activity story industry media thing oven community definition safety quality development language management player variety video week security country exam movie organization "
    "equipment physics analysis policy series thought basis friend direction strategy technology army camera freedom paper environment child instance month truth marketing university "
    "writing article department difference goal news audience fishing growth income marriage user combination failure meaning medicine philosophy teacher communication night chemistry disease disk energy nation road role soup advertising location success addition"
).split()
FRONTS, ENDINGS = ("", "www.", "m.", "blog."), "example.com/en/12 example.net/fr/345 example.org/de/678/ example.com/es/9012.html".split()


def unwanted(held_out: bool = False) -> list[str]:
    """Names of a stem and a word that goes with it: a quarter of all, or the others, which the model never sees."""
    pairs = [(i, j) for i in range(len(UNWANTED)) for j in range(len(WITH)) if ((i + 3 * j) % 4 == 0) != held_out]
    return [(f"{UNWANTED[i]}-{WITH[j]}", f"{WITH[j]}-{UNWANTED[i]}", f"{WITH[j]}{UNWANTED[i]}")[(i + j) % 3] for i, j in pairs]


def wanted(nouns: list) -> list[str]:
    """A third of the nouns as they are, the others with one of the words that go with unwanted stems too."""
    return [(noun, f"{noun}-{WITH[k % len(WITH)]}", f"{WITH[k % len(WITH)]}{noun}")[k % 3] for k, noun in enumerate(nouns)]


def url_of(name: str, k: int) -> str:
    return f"https://{FRONTS[(k // 4 + k) % 4]}{name}.{ENDINGS[k % 4]}"


def _examples():
    """One unwanted host, then two wanted ones, and so on; fronts and endings go round alike for both."""
    good = wanted(WANTED)
    for i, bad in enumerate(unwanted()):
        for label, name in ((1, bad), (0, good[2 * i]), (0, good[2 * i + 1])):
            yield label, url_of(name, i)


def labelled(spark: SparkSession) -> DataFrame:
    """id, url, label (1: unwanted) of the small table that the model is fitted on."""
    rows = [(n, url, label) for n, (label, url) in enumerate(_examples())]
    return spark.createDataFrame(rows, "id int, url string, label int")


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def buckets(host: Column, path: Column) -> Column:
    """The distinct buckets of the n-grams of ^host$path$, sorted."""
    s = F.concat(F.lit("^"), host, F.lit("$"), path, F.lit("$"))
    # from each of GRAM starts on, one after another: linear, where a substring is counted off from the beginning
    grams = F.concat(*[F.regexp_extract_all(F.substring(s, k + 1, (1 << 31) - 1), F.lit(f"(?s).{{{GRAM}}}"), F.lit(0)) for k in range(GRAM)])
    number = lambda g: F.conv(F.substring(F.md5(g), 1, 6), 16, 10).cast("int") % DIMS + 1
    return F.array_sort(F.array_distinct(F.transform(F.array_distinct(grams), number)))


def probability(weights: Column, found: Column) -> Column:
    """The last weight is the bias; features are scaled to length one."""
    total = F.aggregate(found, F.lit(0.0), lambda acc, j: acc + F.element_at(weights, j))
    return 1.0 / (1.0 + F.exp(-(F.element_at(weights, DIMS + 1) + total / F.sqrt(F.size(found).cast("double")))))


def fitted(examples: DataFrame, rounds: int = ROUNDS, step: float = STEP) -> DataFrame:
    """One row: weights array<double> of DIMS + 1, from examples (id, url, label), gone through in order of id `rounds` times."""
    x = examples.select("id", "label", buckets(host_of(F.col("url")), path_of(F.col("url"))).alias("f"))
    every = x.groupBy().agg(F.array_sort(F.collect_list(F.struct("id", "label", "f"))).alias("rows"))
    passes = F.flatten(F.array_repeat(F.col("rows"), rounds))

    def update(w: Column, r: Column) -> Column:
        miss = F.array(r["label"].cast("double") - probability(w, r["f"]))  # an array of one, so that it is computed once
        scaled = F.transform(miss, lambda m: F.struct((m * step).alias("b"), (m * step / F.sqrt(F.size(r["f"]).cast("double"))).alias("x")))
        return F.aggregate(scaled, w, lambda acc, m: F.transform(acc, lambda v, j: F.when(j == DIMS, v + m["b"] * 0.1).when(F.array_contains(r["f"], j + 1), v + m["x"]).otherwise(v)))

    return every.select(F.aggregate(passes, F.array_repeat(F.lit(0.0), DIMS + 1), update).alias("weights"))


def rule_verdict(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest rule that fits (null if none), and its verdict."""
    rule = verdict = F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1:])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def judge(pages: DataFrame, weights: list[float], rules: tuple = RULES, threshold: float = THRESHOLD) -> DataFrame:
    """pages (page_id, url) to page_id, host, path, rule, verdict, score.

    A null url, or one without ://, has an empty host and path and is judged by the model on those. Repeated rows stay;
    other columns are left out.
    """
    cut = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    score = probability(F.from_json(F.lit(json.dumps(weights)), "array<double>"), F.col("found"))  # one constant, where thousands would be planned one by one
    rule, verdict = rule_verdict(F.col("host"), F.col("path"), rules)
    out = cut.withColumn("found", buckets(F.col("host"), F.col("path"))).withColumn("score", score).drop("found")
    return out.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("score") >= threshold, "block").otherwise("allow")).alias("verdict"), "score")


def op10_url_filter(spark, sf_dir):
    weights = fitted(labelled(spark)).first()["weights"]  # DIMS + 1 numbers
    return judge(table(spark, sf_dir, "pages"), weights).select("page_id", "host", "path", "rule", "verdict")


def _oracle() -> str:
    rows = [f"({n}, '{url}', {label})" for n, (label, url) in enumerate(_examples())]
    n = len(rows)
    cut = r"""translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
              regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path"""
    grams = f"""list_sort(list_distinct(list_transform(range(1, greatest(length('^' || host || '$' || path || '$') - {GRAM} + 1, 1) + 1),
              lambda i: CAST('0x' || substr(md5(substr('^' || host || '$' || path || '$', i, {GRAM})), 1, 6) AS INT) % {DIMS} + 1)))"""
    prob = lambda w, f: f"(1.0 / (1.0 + exp(-({w}[{DIMS + 1}] + list_sum(list_transform({f}, lambda j: {w}[j])) / sqrt(CAST(len({f}) AS DOUBLE))))))"
    ranked = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [(f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))", h + p, v) for v, h, p in ranked]
    return f"""
WITH RECURSIVE t(id, url, label) AS (VALUES {", ".join(rows)}),
x AS (SELECT id, label, {grams} AS f FROM (SELECT id, label, {cut} FROM t)),
fit(n, w) AS (
  SELECT 0, list_transform(range(0, {DIMS + 1}), lambda i: CAST(0 AS DOUBLE))
  UNION ALL
  SELECT n + 1, list_transform(w, lambda v, j: CASE WHEN j = {DIMS + 1} THEN v + miss * {STEP} * 0.1 WHEN list_contains(f, j) THEN v + miss * {STEP} / sqrt(CAST(len(f) AS DOUBLE)) ELSE v END)
  FROM (SELECT n, w, f, label - {prob("w", "f")} AS miss FROM fit JOIN x ON x.id = n % {n}) WHERE n < {n * ROUNDS}),
m AS (SELECT w FROM fit WHERE n = {n * ROUNDS}),
p AS (SELECT page_id, host, path, {grams} AS f FROM (SELECT page_id, {cut} FROM pages)),
r AS (SELECT page_id, host, path, {prob("w", "f")} AS score,
        CASE {" ".join(f"WHEN {c} THEN '{r}'" for c, r, _ in fits)} END AS rule, CASE {" ".join(f"WHEN {c} THEN '{v}'" for c, _, v in fits)} END AS v FROM p, m)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN score >= {THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict FROM r
"""


ORACLE = _oracle()
