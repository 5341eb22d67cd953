"""Quality rules by line: cases, a plain model of the counts, and odd tables."""

import random

import pytest

from ledgerloom.llm import line_rules
from tests.llm.test_llm import SCHEMA, WORD, documents, nothing, words
from tests.oracle import same, tables

CASES = [
    ("It is a sentence.", None), ("He said “no.” ", None), ("Ist es so?", None), ("wait…", None), ("ends with a word", "punctuation"), ("Home | About | Contact | Help.", "navigation"),
    ("one » two › three", "navigation"), ("a long line with many words that only happens to hold a | and a | as signs.", None), ("All Rights Reserved.", "boilerplate"),
    ("We updated our PRIVACY POLICY.", "boilerplate"), (" ".join(["word"] * 25) + " privacy policy.", None), ("th$$$ of%%% it***.", "punctuation"), ("Costs $5 for one of them, or 10% more for two of these.", None),
    ("NOW!! BUY!! IT!! ALL!!", "punctuation"), ("Stop! No! Why?", None), ("Äll rights reserved.", None), ("no mark (but this one.)", None), ("." + " " * 300, None),
]


@pytest.mark.parametrize(("line", "rule"), CASES)
def test_lines(line, rule):
    assert line_rules.failing(line, len(WORD.findall(line))) == rule


def plain(text):
    ws, lines = WORD.findall(text or ""), [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(ws[i : i + 5]) for i in range(len(ws) - 4)]
    again = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    return len(ws), sum(map(len, ws)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again)


def test_counts_equal_a_plain_model():
    draw = random.Random(4)
    for _ in range(300):
        text = "".join(draw.choice(["a", "b", "éé", "c#", "<x>", " "][: draw.randint(1, 6)]) + draw.choice([" ", " ", "\n", "\t", "\r\n", ".\x0b"]) for _ in range(draw.randint(0, 120)))
        assert line_rules.judge(text)[:5] == plain(text)
    assert line_rules.repeat_words([f"w{k}" for k in range(50_000)] * 2) == 100_000  # more words than one number can pack


def test_sql_and_cleaning_on_odd_rows(spark, tmp_path):
    texts = [*(c for c, _ in CASES), "\n".join(c for c, _ in CASES), words(40, 1) + ".\nHome | About | Help\n" + words(40, 2) + ".", "\n\n \n", "x" * 200_000, words(9, 1) + ".", words(10, 1) + ".", "a b c d e f. " * 9]
    df = spark.createDataFrame([*documents(spark).collect(), *[(100 + k, t, None, None, len(t), None, None, None, None, None, None, None) for k, t in enumerate(texts)]], SCHEMA)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    same(spark, line_rules.op13_line_rules, line_rules.ORACLE, str(tmp_path))
    got = {r.doc_id: r for r in line_rules.clean(df).collect()}
    assert list(got[120 - 1].asDict()) == df.columns
    assert got[119].text == words(40, 1) + ".\n" + words(40, 2) + "." and got[119].n_chars == len(got[119].text)
    assert not {3, 4, 8, 122, 124} & set(got) and got[123].text == words(10, 1) + "."
    assert line_rules.clean(nothing(spark)).count() == 0 and line_rules.clean(df.select("text")).count() == len(got)


def test_clean_documents_stay_and_junk_goes(spark):
    """Of labelled documents of ten words or more."""
    out = {r.doc_id: r for r in line_rules.op13_line_rules(spark, "/root/testdata/sf0.01").collect()}
    labels = [(out[d], quality) for d, quality in tables("/root/testdata/sf0.01").execute("SELECT doc_id, quality FROM labels").fetchall() if out[d].n_words >= 10]
    share = lambda q: sum(r.kept for r, quality in labels if quality == q) / sum(quality == q for _, quality in labels)
    assert share(1) > 0.97 and share(0) < 0.35
