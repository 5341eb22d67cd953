"""Secret scans with built-in functions only: fixed patterns, and sliding-window Shannon entropy over candidate strings.

A text is split at the matches of a pattern; the lengths of the pieces and matches give each match's position, counted
in code points. Everything is an expression over one row: no shuffle, no Python.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import before, fresh, let, table

#: Kind, pattern, group whose length counts, least length.
ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (
    ("assign", ASSIGN, 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),  # a run of fewer than 16 holds no later match either
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: A candidate is a run of these, of WINDOW or more, with a letter and a digit.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
WINDOW = 20
#: Character class, pattern of a candidate in it, least entropy of some window, in bits a character.
CLASSES = (("entropy_hex", r"^([0-9a-f]+|[0-9A-F]+)$", 2.9), ("entropy_base64", r"", 3.8))
#: What looks like a path, lower-cased, and its pieces that are candidates.
PATH, PIECE = r"/[a-z_-]+/[a-z_-]+/", r"[A-Za-z0-9+_-]{20,}"
#: Placeholders, lower-cased: they are no part of a secret, and what is left and right of one is judged by itself.
PLACEHOLDERS = ("example", "sample", "placeholder", "dummy", "changeme", "your_", "your-", "xxxx", "0000000000", "1234567890")
#: Candidates that are no secrets, lower-cased: UUIDs, and the digests of the empty string.
ALLOWED = (
    r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"^(d41d8cd98f00b204e9800998ecf8427e|da39a3ee5e6b4b0d3255bfef95601890afd80709|e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855)$",
)
KINDS = [k for k, *_ in BASE] + [k for k, *_ in CLASSES]
MASK = "<SECRET>"


def micro(count: int) -> int:
    """count * log2(count) in millionths: whole numbers, so that sums do not depend on their order."""
    return round(count * math.log2(count) * 1e6) if count else 0


def located(text: Column, pattern: str) -> Column:
    """array<struct<s, e, m>>: the matches of the pattern with start and end (exclusive), in time linear in the text and in the matches."""
    matches = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    pieces = F.split(text, pattern, -1)  # one more than matches; the last is cut off
    sizes = F.zip_with(pieces, matches, lambda p, m: F.struct(F.length(p).alias("p"), F.length(m).alias("n"), m.alias("m")))

    def placed(rows: Column) -> Column:
        starts = before(F.transform(rows, lambda x: x["p"] + x["n"]))
        return F.zip_with(rows, starts, lambda x, at: F.struct((at + x["p"]).alias("s"), (at + x["p"] + x["n"]).alias("e"), x["m"].alias("m")))

    return let(F.filter(sizes, lambda x: x["m"].isNotNull()), placed)


def spans_of(found: Column, kind: str) -> Column:
    return F.transform(found, lambda x: F.struct(x["s"].alias("s"), F.lit(KINDS.index(kind)).alias("rank"), x["e"].alias("e"), F.lit(kind).alias("kind")))


#: A character's count takes so many bits of a word of counts, and a word has so many counts.
COUNT_BITS, COUNTS = 5, 12


def window_entropy(word: Column, window: int = WINDOW) -> Column:
    """The largest sum, over windows of so many characters, of window*log2(window) - sum(count*log2(count)), in millionths.

    Counts are kept by character, packed into a few words, and changed by the character that enters and the one that
    leaves: a step costs neither a window nor the alphabet. Windows have fewer than 2 ** COUNT_BITS characters.
    """
    words = -(-len(ALPHABET) // COUNTS)
    zero = F.lit(0).cast("long")
    terms = [F.lit(micro(c)).cast("long") for c in range(window + 2)]
    f = lambda c: F.element_at(F.array(*terms), c + 1)
    codes = F.transform(F.split(word, ""), lambda ch: F.instr(F.lit(ALPHABET), ch) - 1)
    start = F.struct(*[zero.alias(f"n{k}") for k in range(words)], zero.alias("sum"), F.lit(-1).cast("long").alias("best"))
    at = lambda c: ((c % COUNTS) * COUNT_BITS).cast("int")
    word_of = lambda c: F.floor(c / COUNTS).cast("int")

    def count(acc: Column, c: Column) -> Column:
        held = acc["n0"]
        for k in range(1, words):
            held = F.when(word_of(c) == k, acc[f"n{k}"]).otherwise(held)
        return F.call_function("shiftright", held, at(c)).bitwiseAND((1 << COUNT_BITS) - 1).cast("int")

    def bump(c: Column, k: int) -> Column:
        return F.when(word_of(c) == k, F.call_function("shiftleft", F.lit(1).cast("long"), at(c))).otherwise(zero)

    def slide(chars: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            into = F.element_at(chars, i)
            out = F.when(i > window, F.element_at(chars, F.greatest(i - window, F.lit(1)))).otherwise(F.lit(-1))
            pair = F.struct(into.alias("into"), out.alias("out"))

            def changed(x: Column) -> Column:
                a, b = x["into"], x["out"]
                n_in, n_out = count(acc, a), count(acc, F.greatest(b, F.lit(0)))
                change = F.when(a == b, zero).otherwise(f(n_in + 1) - f(n_in) + F.when(b >= 0, f(n_out - 1) - f(n_out)).otherwise(zero))
                total = acc["sum"] + change
                best = F.when(i >= window, F.greatest(acc["best"], F.lit(micro(window)).cast("long") - total)).otherwise(acc["best"])
                held = [(acc[f"n{k}"] + bump(a, k) - F.when(b >= 0, bump(b, k)).otherwise(zero)).alias(f"n{k}") for k in range(words)]
                return F.struct(*held, total.alias("sum"), best.alias("best"))

            return let(pair, changed)

        return F.aggregate(F.sequence(F.lit(1), F.size(chars)), start, step, lambda acc: acc["best"])

    return let(codes, slide)


def allowed(word: Column) -> Column:
    low = F.lower(word)
    out = low.rlike(ALLOWED[0])
    for pattern in ALLOWED[1:]:
        out = out | low.rlike(pattern)
    return out


def blanked(low: Column) -> Column:
    """Placeholders replaced by as many blanks."""
    for word in PLACEHOLDERS:
        low = F.replace(low, F.lit(word), F.lit(" " * len(word)))
    return low


def candidates(text: Column) -> Column:
    """The runs of CANDIDATE; of one that looks like a path, its pieces between slashes that are as long: a path hides no secret in it. Nor does a placeholder: what it leaves is cut out in the same way."""

    def within(x: Column, shown: Column, pattern: str) -> Column:
        return F.transform(located(shown, pattern), lambda y: F.struct((x["s"] + y["s"]).alias("s"), (x["s"] + y["e"]).alias("e"), F.substring(x["m"], y["s"] + 1, y["e"] - y["s"]).alias("m")))

    def pieces(x: Column) -> Column:
        return F.when(F.lower(x["m"]).rlike(PATH), within(x, x["m"], PIECE)).otherwise(F.array(x))

    def parts(x: Column) -> Column:
        return F.when(F.lower(x["m"]).rlike("|".join(PLACEHOLDERS)), within(x, blanked(F.lower(x["m"])), CANDIDATE)).otherwise(F.array(x))

    return F.flatten(F.transform(F.flatten(F.transform(located(text, CANDIDATE), pieces)), parts))


def entropy_spans(text: Column) -> Column:
    words = F.filter(candidates(text), lambda x: x["m"].rlike("[0-9]") & x["m"].rlike("[A-Za-z]") & ~allowed(x["m"]))
    hexa = CLASSES[0][1]
    rank = F.lit(KINDS.index("entropy_hex")), F.lit(KINDS.index("entropy_base64"))
    least = [F.lit(round(bits * WINDOW * 1e6)).cast("long") for *_, bits in CLASSES]
    kinds = [math.ceil(2**bits) for *_, bits in CLASSES]  # of characters: fewer cannot reach that entropy
    many = F.filter(words, lambda x: F.size(F.array_distinct(F.split(x["m"], ""))) >= F.when(x["m"].rlike(hexa), kinds[0]).otherwise(kinds[1]))
    high = F.filter(many, lambda x: window_entropy(x["m"]) >= F.when(x["m"].rlike(hexa), least[0]).otherwise(least[1]))
    return F.transform(high, lambda x: F.struct(x["s"].alias("s"), F.when(x["m"].rlike(hexa), rank[0]).otherwise(rank[1]).alias("rank"), x["e"].alias("e"), F.when(x["m"].rlike(hexa), F.lit("entropy_hex")).otherwise(F.lit("entropy_base64")).alias("kind")))


def with_spans(docs: DataFrame, base: str, spans: str) -> DataFrame:
    """docs with two columns more: array<struct<s, rank, e, kind>> of the fixed patterns, and of those and the entropy windows.

    Sorted by start, then kind; positions in code points, end exclusive. A null or empty text has empty arrays.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    none = F.expr("cast(array() as array<struct<s: int, rank: int, e: int, kind: string>>)")
    found = []
    for kind, pattern, group, least in BASE:
        hits = located(text, pattern)
        if group:
            values = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(group + 1))
            hits = F.transform(F.filter(F.zip_with(hits, values, lambda x, v: F.struct(x.alias("x"), v.alias("v"))), lambda p: F.length(p["v"]) >= least), lambda p: p["x"])
        found.append(F.when(text.rlike(pattern), spans_of(hits, kind)).otherwise(none))
    more = F.when(text.rlike(CANDIDATE), entropy_spans(text)).otherwise(none)
    extra = fresh(docs, "entropy")
    out = docs.withColumn(base, F.array_sort(F.concat(*found))).withColumn(extra, more)
    return out.withColumn(spans, F.array_sort(F.concat(base, extra))).drop(extra)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


#: Code points of a page, from which parts of a text are cut: a part costs its own length and a page's, wherever it lies.
PAGE = 1024


def masked(text: Column, spans: Column) -> Column:
    """The text with each span, overlapping ones as one, replaced by MASK. spans: sorted by start."""

    def cut(pages: Column, low: Column, high: Column) -> Column:
        first = F.floor(low / PAGE).cast("int")
        part = F.array_join(F.slice(pages, first + 1, F.greatest(F.ceil(high / PAGE).cast("int") - first, F.lit(0))), "")
        return F.substring(part, low - first * PAGE + 1, high - low)

    def parts(x: Column) -> Column:
        pages, rows, size = x["pages"], x["rows"], x["size"]
        done = before(F.transform(rows, lambda r: r["e"]), step=lambda a, b: F.greatest(a, b))  # how far what comes before a span reaches
        pieces = F.zip_with(rows, done, lambda r, at: F.when(r["s"] >= at, F.concat(cut(pages, at, r["s"]), F.lit(MASK))).otherwise(""))
        return F.concat(F.array_join(pieces, ""), cut(pages, F.array_max(F.transform(rows, lambda r: r["e"])), size))

    pages = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PAGE}}}"), F.lit(0))
    return let(F.struct(pages.alias("pages"), spans.alias("rows"), F.length(text).alias("size")), parts)


def redact(docs: DataFrame) -> DataFrame:
    """docs with each span of its texts, overlapping ones as one, replaced by MASK; n_chars, where there is one, follows. Null texts stay null."""
    base, spans = fresh(docs, "base_spans"), fresh(docs, "all_spans")
    found = with_spans(docs, base, spans)
    text = F.col("text")
    out = found.withColumn("text", F.when(F.size(spans) > 0, masked(text, F.col(spans))).otherwise(text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def scan(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) to doc_id, base and spans, one row each; other columns are left out."""
    return with_spans(docs.select("doc_id", "text"), "base", "spans").select("doc_id", "base", "spans")


def op3_secret_scan(spark, sf_dir):
    out = scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def stage(spark, docs, sf_dir):
    """Every document stays; what looks like a secret is masked in its text."""
    return redact(docs)


def _oracle() -> str:
    quote = lambda s: s.replace("'", "''")
    parts = []
    for i, (kind, pattern, group, least) in enumerate(BASE):
        value = f"regexp_extract_all(text, '{quote(pattern)}', {group})"
        parts.append(f"SELECT doc_id, {i} AS rank, '{kind}' AS kind, regexp_extract_all(text, '{quote(pattern)}') AS m, {value} AS v, string_split_regex(text, '{quote(pattern)}') AS p, {least} AS least FROM d")
    parts.append(f"SELECT doc_id, 9, 'candidate', regexp_extract_all(text, '{CANDIDATE}'), regexp_extract_all(text, '{CANDIDATE}'), string_split_regex(text, '{CANDIDATE}'), 0 FROM d")
    f = "[" + ", ".join(str(micro(c)) for c in range(WINDOW + 1)) + "]"
    allow = " OR ".join(f"regexp_matches(lower(m), '{p}')" for p in ALLOWED)
    is_hex = f"regexp_matches(m, '{CLASSES[0][1]}')"
    least = [round(bits * WINDOW * 1e6) for *_, bits in CLASSES]
    blank = "lower(m)"
    for x in PLACEHOLDERS:
        blank = f"replace({blank}, '{x}', '{' ' * len(x)}')"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
f AS ({" UNION ALL ".join(parts)}),
u AS (SELECT doc_id, rank, kind, least, unnest(m) AS m, unnest(v) AS v, unnest(list_transform(range(1, len(m) + 1), lambda i:
        CAST(list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT))) AS s
      FROM f WHERE len(m) > 0),
b AS (SELECT doc_id, rank, kind, s, s + length(m) AS e FROM u WHERE rank < 9 AND length(v) >= least),
w AS (SELECT doc_id, m, s FROM u WHERE rank = 9 AND NOT regexp_matches(lower(m), '{PATH}')
      UNION ALL SELECT doc_id, m, base_at + piece_at FROM (
        SELECT doc_id, s AS base_at, unnest(regexp_extract_all(m, '{PIECE}')) AS m, unnest(list_transform(range(1, len(regexp_extract_all(m, '{PIECE}')) + 1), lambda i:
          CAST(list_sum(list_transform(string_split_regex(m, '{PIECE}')[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(regexp_extract_all(m, '{PIECE}')[1:i - 1], lambda x: length(x))), 0) AS BIGINT))) AS piece_at
        FROM u WHERE rank = 9 AND regexp_matches(lower(m), '{PATH}'))),
v AS (SELECT doc_id, m, s FROM w WHERE NOT regexp_matches(lower(m), '{"|".join(PLACEHOLDERS)}')
      UNION ALL SELECT doc_id, substr(m, piece_at + 1, length(piece)), s + piece_at FROM (
        SELECT doc_id, m, s, unnest(regexp_extract_all(b, '{CANDIDATE}')) AS piece, unnest(list_transform(range(1, len(regexp_extract_all(b, '{CANDIDATE}')) + 1), lambda i:
          CAST(list_sum(list_transform(string_split_regex(b, '{CANDIDATE}')[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(regexp_extract_all(b, '{CANDIDATE}')[1:i - 1], lambda x: length(x))), 0) AS BIGINT))) AS piece_at
        FROM (SELECT *, {blank} AS b FROM w WHERE regexp_matches(lower(m), '{"|".join(PLACEHOLDERS)}')))),
c AS (SELECT * FROM v WHERE regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]') AND NOT ({allow})),
h AS (SELECT doc_id, s, m, max({micro(WINDOW)} - bits) AS best FROM (
        SELECT doc_id, s, m, i, sum(({f})[n + 1]) AS bits FROM (
          SELECT doc_id, s, m, i, ch, count(*) AS n FROM (
            SELECT doc_id, s, m, i, unnest(string_split(substr(m, i, {WINDOW}), '')) AS ch FROM (
              SELECT doc_id, s, m, unnest(range(1, length(m) - {WINDOW} + 2)) AS i FROM c))
          GROUP BY ALL) GROUP BY ALL) GROUP BY ALL),
a AS (SELECT * FROM b UNION ALL
      SELECT doc_id, CASE WHEN {is_hex} THEN 3 ELSE 4 END, CASE WHEN {is_hex} THEN '{KINDS[3]}' ELSE '{KINDS[4]}' END, s, s + length(m)
      FROM h WHERE best >= CASE WHEN {is_hex} THEN {least[0]} ELSE {least[1]} END),
g AS (SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
             coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e) FILTER (rank < 3), '') AS base,
             string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e) AS spans FROM a GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""


ORACLE = _oracle()
