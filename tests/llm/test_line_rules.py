"""Line-first cleaning against plain Python, and its rules on given lines."""

import re
from collections import Counter

import duckdb
import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import sf, table  # noqa: F401

from dimflow.llm import line_rules, oracles
from dimflow.llm.queries import op12_line_rules

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(covered), len(words) < 10 or 100 * len(covered) > 20 * len(words))


TEXTS = [
    None, "", " \n\t\r ", "word", "a b c d e", "a b c d e a b c d e", "a a a a a a a", "a a a a a", "x\ny\nx\n\n\nx ",
    "é à #1 $ü z   😀 <b>|&", "one two three four five. " * 3, "a\x0bb\x0cc\x1cd\x00e", "line\r\nline\r\nline\n",
    " ".join(f"w{i}" for i in range(30_000)), "same words again and again " * 8_000, "no\nspace\n" * 20,
]


def test_counts_equal_plain_python(table):  # noqa: F811
    df = line_rules.clean(table(list(enumerate(TEXTS))))
    got = {r[0]: tuple(r[1:]) for r in df.select("doc_id", *COUNTS).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t.#|é", max_size=60), min_size=1, max_size=40))
def test_counts_equal_plain_python_on_any_text(spark, texts):
    df = line_rules.clean(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {r[0]: tuple(r[1:]) for r in df.select("doc_id", *COUNTS).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


GOOD = "This line says something in a whole sentence, and then it ends."


@pytest.mark.parametrize(
    "line, rule",
    [
        (GOOD, None),
        ("Is 3 < 4? Yes! That is so, and 50% of all are (more or less) agreed.", None),
        ("A heading without an end", None),
        ("He said: “Stop.”", None),
        ("wow!!! so### very$$$ loud&&&", "punctuation"),
        ("Home | News | Sport | Weather | About us", "navigation"),
        ("Home > Shop > Shoes", "navigation"),
        ("Next page", "navigation"),
        ("Done.", None),
        ("   ", None),
        ("Please enable JavaScript to see this page.", "boilerplate"),
        ("© 2020 Some Firm. All rights reserved.", "boilerplate"),
        ("All rights reserved" + " in a long line of prose" * 10, None),
    ],
)
def test_rules_of_lines(spark, line, rule):
    row = spark.createDataFrame([(line,)], "line string").select(line_rules.line_verdict(F.col("line")).alias("v")).first()
    assert row.v.rule == rule


def test_failing_lines_go_and_poor_documents_too(table):  # noqa: F811
    rows = [
        (1, "\n".join([GOOD, "Home | News | Sport", "", GOOD.replace("This", "That"), "Sign in"])),
        (2, "\n".join([GOOD] + ["Home | News | Sport | Contact | Search"] * 1 + ["Log in to read more about this and that"] * 1)),
        (3, None),
        (3, GOOD),
        (4, "\n".join(f"{GOOD[:-1]} {i} {i + 1} {i + 2} {i + 3} {i + 4}." for i in range(0, 50, 5))),
    ]
    out = line_rules.clean(table(rows))
    assert "score" in out.columns and out.columns.count("kept") == 1
    got = rows_of(out, "doc_id", "clean_text", "navigation_lines", "boilerplate_lines", "lost_words", "kept")
    assert (1, f"{GOOD}\n\n{GOOD.replace('This', 'That')}", 1, 1, 7, False) not in got
    by_id = {r[0]: r for r in got if r[1]}
    assert by_id[1][1] == f"{GOOD}\n\n{GOOD.replace('This', 'That')}" and by_id[1][2:4] == (2, 0)
    assert by_id[2][5] is False and by_id[2][4] > 0
    assert (3, None, 0, 0, 0, False) in got and by_id[3][5] is True
    assert by_id[4][5] is False  # repeats too much
    assert line_rules.clean(table([])).count() == 0


def test_one_pass_without_python(table):  # noqa: F811
    plan = plan_of(line_rules.clean(table([(1, "x")])))
    assert not re.search("Exchange|EvalPython|InPandas|InArrow|Window", plan)


def test_equals_sql(spark, sf):  # noqa: F811
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    result = duck.execute(oracles.ORACLES["op12_line_rules"])
    names = [c[0] for c in result.description]
    df = op12_line_rules(spark, sf)
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df, *names) == sorted(result.fetchall(), key=repr)


def test_clean_labelled_documents_are_kept(spark, sf):  # noqa: F811
    good = spark.read.parquet(f"{sf.replace('0.001', '0.1')}/labels.parquet").filter("quality = 1")
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.1')}/documents.parquet")
    judged = line_rules.clean(docs.join(good, "doc_id")).filter("not base_failed")
    assert judged.filter("not kept").count() <= 0.001 * judged.count()
