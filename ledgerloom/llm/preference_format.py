"""Preference formatting with built-in functions only: one prompt for the common turns, two masked completions.

A pair has the turns of a chosen and a rejected conversation. Their longest common prefix of turns is rendered once as
the prompt; what is left of each is rendered as a completion, with the character spans that are trained on (the
assistant's) beside it. Arrays within one row: a pair needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import before, table

#: How a turn is rendered: head, role, middle, text, tail. What is trained on is the text and the tail.
HEAD, MIDDLE, TAIL = "<|", "|>\n", "<|end|>\n"
TRAINED = "assistant"
TURNS = "array<struct<role: string, text: string>>"


def common_prefix(a: Column, b: Column) -> Column:
    """How many turns two arrays begin with alike; nulls equal nulls."""
    n = F.least(F.size(a), F.size(b))
    same = F.zip_with(a, b, lambda x, y: (x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"])))
    differs = F.array_position(F.slice(same, 1, n), F.lit(False))
    return F.when(differs > 0, differs.cast("int") - 1).otherwise(n)


def _role(t: Column) -> Column:
    return F.coalesce(t["role"], F.lit(""))


def _text(t: Column) -> Column:
    return F.coalesce(t["text"], F.lit(""))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(HEAD), _role(t), F.lit(MIDDLE), _text(t), F.lit(TAIL))), "")


def trained_spans(turns: Column) -> Column:
    """start:end of what is trained on, in code points of rendered(turns), comma-joined."""
    sizes = F.transform(turns, lambda t: len(HEAD) + F.length(_role(t)) + len(MIDDLE) + F.length(_text(t)) + len(TAIL))
    spans = F.zip_with(turns, before(sizes), lambda t, at: F.struct((_role(t) == TRAINED).alias("own"), (at + len(HEAD) + F.length(_role(t)) + len(MIDDLE)).alias("s"), F.length(_text(t)).alias("n")))
    return F.array_join(F.transform(F.filter(spans, lambda x: x["own"]), lambda x: F.concat(x["s"].cast("string"), F.lit(":"), (x["s"] + x["n"] + len(TAIL)).cast("string"))), ",")


def format_preferences(pairs: DataFrame) -> DataFrame:
    """pairs (conv_id, chosen, rejected: arrays of struct<role, text>) to prompt, completions and spans, one row each.

    A null array counts as an empty one; null roles and texts render as nothing but differ from empty ones; equal
    conversations give empty completions. Other columns are left out, repeated rows stay.
    """
    rest = lambda c: F.slice(c, F.col("prompt_turns") + 1, F.greatest(F.size(c), F.lit(1)))
    empty = F.expr(f"cast(array() as {TURNS})")
    base = pairs.select("conv_id", F.coalesce("chosen", empty).alias("chosen"), F.coalesce("rejected", empty).alias("rejected"))
    cut = base.withColumn("prompt_turns", common_prefix(F.col("chosen"), F.col("rejected")))
    cut = cut.select("conv_id", "prompt_turns", F.slice("chosen", F.lit(1), F.col("prompt_turns")).alias("p"), rest(F.col("chosen")).alias("c"), rest(F.col("rejected")).alias("r"))
    return cut.select(
        "conv_id", "prompt_turns", rendered(F.col("p")).alias("prompt"),
        rendered(F.col("c")).alias("chosen"), trained_spans(F.col("c")).alias("chosen_spans"),
        rendered(F.col("r")).alias("rejected"), trained_spans(F.col("r")).alias("rejected_spans"),
    )


def conversations_of(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) to conv_id and its turns in order; ties by role and text; a row is one turn.

    Nothing says which rows without a conv_id belong together: each is a conversation of one turn.
    """
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    of = lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))
    rows = turns.select("conv_id", "turn", "role", "text")
    known = rows.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.transform(ordered, of).alias("turns"))
    return known.unionByName(rows.where("conv_id IS NULL").select("conv_id", F.array(F.struct("role", "text")).alias("turns")))


def preference_pairs(turns: DataFrame) -> DataFrame:
    """Each conversation as chosen, and as rejected the same with its last assistant turn answered by the next conversation's.

    The next is that of conv_id + 1 (the largest number has none, and the smallest is no one's); where it has no assistant
    turn, or is missing, the answer is empty, as it is for conversations without an id. A conversation without an assistant turn is rejected as it is.
    """
    every = conversations_of(turns)
    answers = every.select(F.try_subtract(F.col("conv_id").cast("long"), F.lit(1).cast("long")).alias("conv_id"), F.element_at(F.concat(F.array(F.lit(None).cast("string")), F.transform(F.filter("turns", lambda t: t["role"] == TRAINED), lambda t: t["text"])), -1).alias("answer"))
    last = F.size("turns") - F.array_position(F.reverse(F.transform("turns", lambda t: F.coalesce(t["role"] == TRAINED, F.lit(False)))), True).cast("int")
    has = F.exists("turns", lambda t: F.coalesce(t["role"] == TRAINED, F.lit(False)))
    swapped = F.transform("turns", lambda t, i: F.struct(t["role"].alias("role"), F.when(has & (i == last), F.coalesce("answer", F.lit(""))).otherwise(t["text"]).alias("text")))
    return every.join(answers, "conv_id", "left").select("conv_id", F.col("turns").alias("chosen"), swapped.alias("rejected"))


def op6_preference_format(spark, sf_dir):
    return format_preferences(preference_pairs(table(spark, sf_dir, "conversations")))


ORACLE = """
WITH g AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn, role, text) AS turns FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
      UNION ALL SELECT conv_id, [{'role': role, 'text': text}] FROM conversations WHERE conv_id IS NULL),
e AS (SELECT row_number() OVER () AS row, conv_id, turns FROM g),
l AS (SELECT row, conv_id, turns, coalesce(list_max(list_transform(range(1, len(turns) + 1), lambda i: CASE WHEN turns[i].role = 'assistant' THEN i ELSE 0 END)), 0) AS at FROM e),
s AS (SELECT l.row, l.conv_id, l.turns AS chosen,
        list_transform(l.turns, lambda t, i: CASE WHEN i = l.at THEN {'role': t.role, 'text': coalesce(n.turns[nullif(n.at, 0)].text, '')} ELSE t END) AS rejected
      FROM l LEFT JOIN l n ON n.conv_id = l.conv_id::HUGEINT + 1),
p AS (SELECT *, coalesce(list_min(list_filter(range(1, len(chosen) + 1), lambda i: chosen[i] IS DISTINCT FROM rejected[i])) - 1, len(chosen)) AS k FROM s),
c AS (SELECT row, conv_id, k, unnest([0, 1, 2]) AS part, unnest([chosen[1:k], chosen[k + 1:], rejected[k + 1:]]) AS turns FROM p),
r AS (SELECT row, conv_id, k, part, turns, list_transform(turns, lambda t: '<|' || coalesce(t.role, '') || '|>' || chr(10) || coalesce(t.text, '') || '<|end|>' || chr(10)) AS shown FROM c),
f AS (SELECT row, conv_id, k, part, coalesce(array_to_string(shown, ''), '') AS shown,
        coalesce(array_to_string(list_transform(list_filter(range(1, len(turns) + 1), lambda i: turns[i].role = 'assistant'), lambda i:
          CAST(coalesce(list_sum(list_transform(shown[1:i - 1], lambda x: length(x))), 0) + 2 + 9 + 3 AS BIGINT) || ':' ||
          CAST(list_sum(list_transform(shown[1:i], lambda x: length(x))) AS BIGINT)), ','), '') AS spans FROM r)
SELECT any_value(conv_id) AS conv_id, CAST(any_value(k) AS INTEGER) AS prompt_turns, max(shown) FILTER (part = 0) AS prompt,
       max(shown) FILTER (part = 1) AS chosen, max(spans) FILTER (part = 1) AS chosen_spans,
       max(shown) FILTER (part = 2) AS rejected, max(spans) FILTER (part = 2) AS rejected_spans
FROM f GROUP BY row
"""
