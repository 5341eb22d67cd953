"""Quality rules, lines first: each line is judged by itself, lines that fail are removed, and a text that loses too much is rejected.

A line with a word fails by one rule, the first of these that holds: boilerplate (a short line with one of a list of
phrases), navigation (few words between many separators), punctuation (no mark at its end, or more signs than words can
carry). Rules over whole texts (too few words, too many of them in passages that repeat) come before.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.collocations import _packed
from ledgerloom.llm.common import fresh, small_batches, table

#: Fixed values of the rules over whole texts: words of a window; words of a text, at least; percent of them in windows that repeat, at most; what counts as a symbol.
WINDOW, FEWEST, REPEATED, SYMBOLS = 5, 10, 20, "#*$%&|<>"
#: Percent of a text's words that its failing lines may hold.
LOSS = 30
#: Phrases, lower-cased, of lines of so many words at most that are boilerplate.
BOILERPLATE_WORDS = 25
BOILERPLATE = (
    "all rights reserved", "licensed under", "terms of use", "terms of service", "terms and conditions", "privacy policy", "cookie policy", "use cookies",
    "click here", "read more", "subscribe to", "sign up for", "sign in", "log in", "follow us", "share this", "share on", "enable javascript",
    "powered by", "copyright (c)", "copyright ©", "back to top", "skip to content", "lorem ipsum",
)
#: What parts the items of a menu; as many separators at least, and so many words an item at most.
SEPARATOR, SEPARATORS, ITEM_WORDS = "[|>»›•·→]", 2, 4
#: How a sentence ends: a mark, and what may close after it.
ENDING = "[.!?:;…。！？][\"')\\]”’»]*[\\x20\\x09-\\x0D]*$"
#: Signs that may come on a word in four (symbols), or in two (exclamation and question marks).
SYMBOL_WORDS, SHOUT_WORDS = 4, 2

RULES = ("boilerplate", "navigation", "punctuation")
_SPACE, _LATER = b" \t\n\x0b\x0c\r", bytes(range(0x80, 0xC0))
_BOILERPLATE, _SEPARATOR, _ENDING = (re.compile(p) for p in ("|".join(map(re.escape, BOILERPLATE)), SEPARATOR, ENDING))


def failing(line: str, n_words: int) -> str | None:
    """The rule by which a line with words fails, if it does."""
    low = line.encode().lower().decode() if line.isascii() else line.translate(_LOWER)
    if n_words <= BOILERPLATE_WORDS and _BOILERPLATE.search(low):
        return "boilerplate"
    n = len(_SEPARATOR.findall(line))
    if n >= SEPARATORS and n_words <= ITEM_WORDS * (n + 1):
        return "navigation"
    if not _ENDING.search(line[-80:]) and not _ENDING.search(line):
        return "punctuation"
    if SYMBOL_WORDS * sum(map(line.count, SYMBOLS)) > n_words or SHOUT_WORDS * (line.count("!") + line.count("?")) > max(n_words, SHOUT_WORDS * 3):
        return "punctuation"
    return None


_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def repeat_words(words: list) -> int:
    """Words in windows of WINDOW words that are found twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number: dict = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    key = _packed(codes[:n], len(number), [codes[k : k + n] for k in range(1, WINDOW)], len(number))
    _, of, times = np.unique(key, return_inverse=True, return_counts=True)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    start = np.flatnonzero(times[of] > 1)
    np.add.at(change, start, 1)
    np.add.at(change, start + WINDOW, -1)
    return int((np.cumsum(change[:-1]) > 0).sum())


FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *(f"n_{r}" for r in RULES), "lost_words")
JUDGED = "struct<" + ", ".join(f"{f}: long" for f in FIELDS) + ", cleaned: string>"
_TYPE = pa.struct([*((f, pa.int64()) for f in FIELDS), ("cleaned", pa.string())])


def judge(text: str) -> tuple:
    """FIELDS of a text, and the text without the lines that fail."""
    raw = text.encode()
    words = raw.split()
    fails, lost, kept, seen = Counter(), 0, [], Counter()
    for line in text.split("\n"):
        n = len(line.encode().split())
        rule = failing(line, n) if n else None
        if n:
            seen[line] += 1
        if rule:
            fails[rule] += 1
            lost += n
        else:
            kept.append(line)
    again = sum(seen.values()) - len(seen)
    n_symbols = len(raw) - len(raw.translate(None, SYMBOLS.encode()))
    return len(words), len(raw.translate(None, _SPACE + _LATER)), n_symbols, again, repeat_words(words), *(fails[r] for r in RULES), lost, "\n".join(kept)


def _judged(text: Column) -> Column:
    @F.arrow_udf(JUDGED)
    def run(texts: pa.Array) -> pa.Array:
        columns = list(zip(*(judge(t.as_py() or "") for t in texts), strict=True)) or [[]] * len(_TYPE)
        return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _TYPE, strict=True)], fields=list(_TYPE))

    return run(text)


def judged(docs: DataFrame, name: str) -> DataFrame:
    """docs (text) with a struct of FIELDS and the cleaned text more; a null text is an empty one, and every row stays."""
    small_batches(docs.sparkSession)
    return docs.withColumn(name, _judged(docs["text"].cast("string")))


def base_failed(of: Column) -> Column:
    return (of["n_words"] < FEWEST) | (of["n_repeat_words"] * 100 > of["n_words"] * REPEATED)


def kept(of: Column) -> Column:
    """Neither the rules over whole texts reject it, nor do failing lines hold over LOSS percent of its words."""
    return ~base_failed(of) & (of["lost_words"] * 100 <= of["n_words"] * LOSS)


def clean(docs: DataFrame) -> DataFrame:
    """The rows of docs (text) that are kept, failing lines removed; n_chars, where there is one, follows. Lines without a word stay as they are."""
    name = fresh(docs, "judged")
    out = judged(docs, name).where(kept(F.col(name)))
    changed = F.col(name)["lost_words"] > 0
    columns = {"text": F.when(changed, F.col(name)["cleaned"]).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(changed, F.length(F.col(name)["cleaned"]).cast("long")).otherwise(F.col("n_chars"))
    return out.withColumns(columns).select(*docs.columns)


def op13_line_rules(spark, sf_dir):
    out = judged(table(spark, sf_dir, "documents").select("doc_id", "text"), "of").select("doc_id", "of")
    of = F.col("of")
    return out.select("doc_id", *[of[f].alias(f) for f in FIELDS], base_failed(of).alias("base_failed"), kept(of).alias("kept"))


def _oracle() -> str:
    quote = lambda s: s.replace("'", "''")
    word, count = r"[^\x20\x09-\x0D]+", lambda pattern, of: f"len(regexp_extract_all({of}, '{pattern}'))"
    boiler = " OR ".join(f"contains(low, '{p}')" for p in BOILERPLATE)
    return f"""
WITH d AS (SELECT row_number() OVER () AS doc, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc, doc_id, text, regexp_extract_all(text, '{word}') AS w FROM d),
l AS (SELECT doc, unnest(string_split(text, chr(10))) AS line FROM d),
m AS (SELECT doc, line, translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low, {count(word, 'line')} AS n, {count(SEPARATOR, 'line')} AS parts FROM l WHERE regexp_matches(line, '{word}')),
r AS (SELECT doc, line, n, CASE WHEN n <= {BOILERPLATE_WORDS} AND ({boiler}) THEN 'boilerplate' WHEN parts >= {SEPARATORS} AND n <= {ITEM_WORDS} * (parts + 1) THEN 'navigation'
        WHEN NOT regexp_matches(line, '{quote(ENDING)}') OR {SYMBOL_WORDS} * {count(f"[{SYMBOLS}]", "line")} > n OR {SHOUT_WORDS} * {count("[!?]", "line")} > greatest(n, {SHOUT_WORDS * 3}) THEN 'punctuation' END AS rule FROM m),
s AS (SELECT doc, count(*) - count(DISTINCT line) AS again, {", ".join(f"count(*) FILTER (rule = '{x}') AS n_{x}" for x in RULES)}, CAST(coalesce(sum(n) FILTER (rule IS NOT NULL), 0) AS BIGINT) AS lost FROM r GROUP BY doc),
g AS (SELECT doc, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS x FROM (SELECT doc, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM w)),
q AS (SELECT doc, count(DISTINCT i + k) AS repeats FROM (SELECT doc, i, count(*) OVER (PARTITION BY doc, x) AS times FROM g), (SELECT unnest(range(0, {WINDOW})) AS k) WHERE times > 1 GROUP BY doc),
o AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars, CAST({count(f"[{SYMBOLS}]", "text")} AS BIGINT) AS n_symbols,
        coalesce(again, 0) AS n_dup_lines, coalesce(repeats, 0) AS n_repeat_words, {", ".join(f"coalesce(n_{x}, 0) AS n_{x}" for x in RULES)}, coalesce(lost, 0) AS lost_words FROM w LEFT JOIN s USING (doc) LEFT JOIN q USING (doc))
SELECT *, n_words < {FEWEST} OR 100 * n_repeat_words > {REPEATED} * n_words AS base_failed,
       NOT (n_words < {FEWEST} OR 100 * n_repeat_words > {REPEATED} * n_words) AND 100 * lost_words <= {LOSS} * n_words AS kept FROM o
"""


ORACLE = _oracle()
