"""Line-first cleaning: lines are judged one by one, the failing ones go, and a document that loses too
much of its text goes with them.

A line with a word fails by the first of these rules that fits:

- ``punctuation``: marks (`MARKS`) for more than half of its words, and at least three of them;
- ``navigation``: at least two separators standing alone (`SEPARATORS`), for a quarter of its words or more; or fewer
  than three words without the end of a sentence;
- ``boilerplate``: a phrase of site furniture (`PHRASES`), in a line of up to 40 words.

Lines without a word stay, so paragraphs do. A document fails if it has few words, if too many of its words
lie in repeated windows of five, or if its failing lines hold too many of its words.

All is done in one pass over a row, in expressions: no shuffle, and a hot source costs no more than others.
Windows are compared by 64-bit hashes; only texts with an equal pair are sorted.

Defined cases: a null text has no words and stays null; empty texts and texts without words fail for few
words; repeated rows and equal ids are rows of their own; an empty table gives no rows. Texts are read
whole. The columns of the input stay; one whose name is among the new ones is replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What counts as white space, as a symbol, and the windows and limits of the base rules.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # per cent of words

MARKS = "#*$%&<>!?{}[]=+^~"
SEPARATORS = ("|", ">", "<", "»", "«", "·", "•", "/", "-", "–", "—", "::", ">>", "→", "←")
SENTENCE_END = ".!?…:;。！？"
CLOSING = "\"')]”’»"
PHRASES = (
    "all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service", "enable javascript",
    "javascript is disabled", "click here", "read more", "sign in", "sign up", "log in", "skip to content",
    "back to top", "share this", "share on", "subscribe to our", "follow us", "add to cart", "lorem ipsum",
)
BOILERPLATE_WORDS = 40
#: Per cent of a document's words that failing lines may hold.
MOST_LOST = 40


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _without(text: Column, letters: str) -> Column:
    return F.translate(text, letters, "")


def words_of(text: Column) -> Column:
    """What stands between white space."""
    plain = F.translate(text, SPACES[1:], " " * (len(SPACES) - 1))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """The number of words in windows that are found twice or more, from an array of words."""

    def in_windows(hashes: Column) -> Column:
        last = F.size(hashes) - WINDOW
        starts = F.sequence(F.lit(0), last)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))

    def covered(starts: Column) -> Column:
        """Words in windows at some starts, which are in order."""
        step = F.transform(
            starts, lambda at, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - at, F.lit(WINDOW)))
        )
        return F.aggregate(step, F.lit(0), lambda total, n: total + n)

    def of_equal(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def found(sorted_: Column) -> Column:
            twice = F.filter(
                sorted_,
                lambda w, k: F.get(sorted_, k - 1)["h"].eqNullSafe(w["h"]) | F.get(sorted_, k + 1)["h"].eqNullSafe(w["h"]),
            )
            return _let(F.sort_array(F.transform(twice, lambda w: w["i"])), covered)

        return _let(placed, found)

    def counted(hashes: Column) -> Column:
        return F.when(F.size(hashes) <= WINDOW, F.lit(0)).otherwise(
            _let(
                in_windows(hashes),
                lambda ws: F.when(F.size(F.array_distinct(ws)) == F.size(ws), F.lit(0)).otherwise(of_equal(ws)),
            )
        )

    return _let(F.transform(words, lambda w: F.xxhash64(w)), counted)


def line_verdict(line: Column) -> Column:
    """(line, n_words, rule) of a line; the rule is null where none fits."""

    def judged(words: Column) -> Column:
        n = F.size(words)
        marks = F.length(line) - F.length(_without(line, MARKS))
        separators = F.size(F.filter(words, lambda w: w.isin(*SEPARATORS)))
        ended = F.rtrim(F.translate(line, SPACES + CLOSING, " " * len(SPACES)))
        closed = F.substring(ended, -1, 1).isin(*SENTENCE_END)
        rule = (
            F.when(n == 0, None)
            .when((marks >= 3) & (2 * marks > n), "punctuation")
            .when((separators >= 2) & (4 * separators >= n), "navigation")
            .when((n < 3) & ~closed, "navigation")
            .when((n <= BOILERPLATE_WORDS) & F.lower(line).rlike("|".join(PHRASES)), "boilerplate")
        )
        return F.struct(line.alias("line"), n.alias("n"), rule.alias("rule"))

    return _let(words_of(line), judged)


def clean(docs: DataFrame, text_col: str = "text", most_lost: int = MOST_LOST) -> DataFrame:
    """The documents with their counts, the number of lines that each rule removed, the text that is left
    (``clean_text``), the words lost and the verdicts ``base_failed`` and ``kept``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))

    def in_lines(words: Column) -> Column:
        lines = F.transform(F.split(text, "\n"), line_verdict)
        return _let(lines, lambda verdicts: F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            repeated_words(words).cast("bigint").alias("n_repeat_words"),
            F.filter(verdicts, lambda v: v["n"] > 0).alias("worded"),
            verdicts.alias("lines"),
        ))

    def number(rule: str) -> Column:
        return F.size(F.filter("_seen.worded", lambda v: F.coalesce(v["rule"] == rule, F.lit(False)))).cast("bigint")

    spread = F.transform("_seen.worded", lambda v: v["line"])
    lost = F.aggregate(
        "_seen.worded", F.lit(0).cast("bigint"), lambda sum_, v: sum_ + F.when(v["rule"].isNotNull(), v["n"]).otherwise(0)
    )
    left = F.transform(F.filter("_seen.lines", lambda v: v["rule"].isNull()), lambda v: v["line"])
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "punctuation_lines",
             "navigation_lines", "boilerplate_lines", "lost_words", "clean_text", "base_failed", "kept"]
    seen = docs.withColumn("_seen", _let(words_of(text), in_lines)).select(
        *[c for c in docs.columns if c not in names],
        F.col("_seen.n_words").alias("n_words"),
        F.length(_without(text, SPACES)).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(_without(text, SYMBOLS))).cast("bigint").alias("n_symbols"),
        (F.size("_seen.worded") - F.size(F.array_distinct(spread))).cast("bigint").alias("n_dup_lines"),
        F.col("_seen.n_repeat_words").alias("n_repeat_words"),
        *[number(rule).alias(f"{rule}_lines") for rule in ("punctuation", "navigation", "boilerplate")],
        lost.alias("lost_words"),
        F.when(F.col(text_col).isNotNull(), F.array_join(left, "\n")).alias("clean_text"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return seen.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (100 * F.col("lost_words") <= most_lost * F.col("n_words"))
    )
