"""URL filter: site rules, and a ratio of character models where no rule fits.

Two Markov models of variable order are learnt from accepted and from rejected URLs. The
probability of a character after its two predecessors is smoothed with the one after its
predecessor, that with its own frequency, and that with the uniform one (Witten-Bell: a
context counts as much as it has been seen, against its number of different followers).
A URL's score is the mean over its characters of log(accepted / rejected). Four fifths of
the labelled URLs, by a hash, give the counts; the rest calibrate the score at which
verdicts err least (all of them, where a part has no URLs of either kind).

Characters are reduced to 49 symbols, each digit one of its own, so a model has 49**3 = 117,649
rows whatever the input: it is small enough to broadcast, and counts are summed before they are
shuffled. `learn` can also be given the 40 symbols in which all digits are one.
Log ratios are whole millionths, so sums do not depend on the order of rows.

Defined cases: a null URL, or one without `://`, has an empty host and path, fits no rule and
is judged by the characters it has (none: score 0). If either kind of labelled URL is missing,
everything without a rule is allowed. Repeated rows are judged each for itself. Extra
columns are ignored.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimflow.sources.staging import stage

# Symbols of a model: letters, one for digits, punctuation, start, end and all others.
LETTERS = string.ascii_lowercase
DIGIT, START, END, OTHER = "0", "^", "$", "~"
MARKS = "./-_?=#:%&"
SYMBOLS = LETTERS + DIGIT + MARKS + START + END + OTHER
#: Those that `judge` takes: the ten digits apart.
ALL_DIGITS = LETTERS + string.digits + MARKS + START + END + OTHER
SCALE = 1_000_000
#: Calibration looks at thresholds in steps of this many millionths, up to LIMIT steps.
STEP, LIMIT = 5_000, 2_000


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def site_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first `://` up to `/`, `?`, `#` or the end; then up to `?` or `#`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    lower = F.translate(host, string.ascii_uppercase, string.ascii_lowercase)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def longest_rule(rules: list[Rule]) -> Column:
    """The name and verdict of the longest rule that fits `host` and `path`, else null."""
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))
    chain = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in reversed(ordered):
        fits = (F.col("host") == r.host) | F.endswith(F.col("host"), F.lit("." + r.host))
        fits = fits & F.startswith(F.col("path"), F.lit(r.path))
        chosen = F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))
        chain = F.when(fits, chosen).otherwise(chain)
    return chain


def symbols(url: Column, alphabet: str = SYMBOLS) -> Column:
    """The URL as symbols of the alphabet, with two starts and an end."""
    lower = F.translate(F.coalesce(url, F.lit("")), string.ascii_uppercase, LETTERS)
    known = F.regexp_replace(lower, "[^a-z0-9./_?=#:%&-]", OTHER)
    if alphabet == SYMBOLS:
        known = F.regexp_replace(known, "[0-9]", DIGIT)
    return F.concat(F.lit(START * 2), known, F.lit(END))


def trigrams(urls: DataFrame, *keep: str) -> DataFrame:
    """One row per character with its two predecessors, beside the columns to keep."""
    text = F.col("_symbols")
    places = F.sequence(F.lit(1), F.length(text) - 2)
    return urls.select(*keep, F.explode(F.transform(places, lambda i: F.substr(text, i, F.lit(3)))).alias("gram"))


def learn(labelled: DataFrame, alphabet: str = SYMBOLS) -> DataFrame:
    """From rows (_symbols, accepted boolean): (gram, ratio) for every possible trigram of the alphabet,
    the log of its last character's probability as accepted over rejected, in millionths."""
    spark = labelled.sparkSession
    counted = (
        trigrams(labelled, "accepted").groupBy("accepted", "gram").agg(F.count(F.lit(1)).alias("n"))
    )
    counted = stage(counted)  # at most 2 x 49**3 rows
    one = spark.createDataFrame([(s,) for s in alphabet], "s string")
    chars = F.array(*[F.lit(s) for s in alphabet])
    # Every trigram of the alphabet, a table of fixed size.
    every = (
        one.withColumnRenamed("s", "a")
        .withColumn("b", F.explode(chars))
        .withColumn("c", F.explode(chars))
        .withColumn("accepted", F.explode(F.array(F.lit(True), F.lit(False))))
    )
    cut = counted.select(
        "accepted", "n",
        F.substr("gram", F.lit(1), F.lit(1)).alias("a"),
        F.substr("gram", F.lit(2), F.lit(1)).alias("b"),
        F.substr("gram", F.lit(3), F.lit(1)).alias("c"),
    )

    def seen(order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
        context = ["accepted", *order]
        pairs = cut.groupBy(*context, "c").agg(F.sum("n").alias(name))
        totals = pairs.groupBy(*context).agg(
            F.sum(name).alias(name + "_total"), F.count(F.lit(1)).alias(name + "_kinds")
        )
        return pairs, totals

    out, p = every, F.lit(1.0 / len(alphabet))
    for name, order in (("n1", []), ("n2", ["b"]), ("n3", ["a", "b"])):
        pairs, totals = seen(order, name)
        out = out.join(F.broadcast(pairs), ["accepted", *order, "c"], "left")
        out = out.join(F.broadcast(totals), ["accepted", *order], "left")
        n, total, types = (F.coalesce(F.col(name + x), F.lit(0)) for x in ("", "_total", "_kinds"))
        p = F.when(total > 0, (n + types * p) / (total + types)).otherwise(p)
    ratio = F.sum(F.when(F.col("accepted"), F.log("p")).otherwise(-F.log("p")))
    return (
        out.select("accepted", F.concat("a", "b", "c").alias("gram"), p.alias("p"))
        .groupBy("gram")
        .agg(F.round(ratio * SCALE).cast("bigint").alias("ratio"))
    )


def score(urls: DataFrame, model: DataFrame, *keep: str) -> DataFrame:
    """The kept columns and `score`, the mean ratio in whole millionths, one row per row of
    ``urls`` (with a unique column `row`). The rows of a URL are summed where they are."""
    return (
        trigrams(urls, "row", *keep)
        .join(F.broadcast(model), "gram")  # 49**3 rows
        .groupBy("row", *keep)
        .agg(F.floor(F.sum("ratio") / F.count(F.lit(1))).alias("score"))
    )


def calibrate(scored: DataFrame) -> int:
    """The least threshold with the fewest wrong verdicts on rows (accepted, score), in the middle of
    the scores that make no difference."""
    step = F.greatest(F.least(F.floor(F.col("score") / STEP), F.lit(LIMIT)), F.lit(-LIMIT))
    bins = scored.groupBy(step.alias("step")).agg(
        F.count_if("accepted").alias("good"), F.count_if(~F.col("accepted")).alias("bad")
    )
    # At most 2 * LIMIT + 1 rows. Below the threshold good ones are lost, above it bad ones kept.
    below = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    above = Window.orderBy("step").rowsBetween(0, Window.unboundedFollowing)
    wrong = F.coalesce(F.sum("good").over(below), F.lit(0)) + F.sum("bad").over(above)
    least = F.coalesce(F.lag("step").over(Window.orderBy("step")) + 1, "step")
    best = bins.select("step", wrong.alias("wrong"), least.alias("least")).orderBy("wrong", "step").first()
    return STEP * (best["least"] + best["step"]) // 2 if best else -(2**62)


def judge(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score (log ratio per character,
    also where a rule decides) and threshold. See the module for special cases."""
    url = F.col(url_col)
    host, path = site_parts(url)
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("page_id"),
        host.alias("host"),
        path.alias("path"),
        symbols(url, ALL_DIGITS).alias("_symbols"),
    ).withColumn("_rule", longest_rule(rules))
    rows = stage(rows.select("*", "_rule.rule", F.col("_rule.verdict").alias("given")).drop("_rule"))
    labelled = rows.filter("given is not null").select(
        "row", "_symbols", (F.col("given") == "allow").alias("accepted"), (F.crc32("_symbols") % 5 == 0).alias("held")
    )
    counts = {tuple(r[:2]): r[2] for r in labelled.groupBy("held", "accepted").count().collect()}  # four at most
    both = {held: (held, True) in counts and (held, False) in counts for held in (True, False)}
    model = stage(learn(labelled.filter(~F.col("held")) if both[False] else labelled, ALL_DIGITS))
    if {accepted for _, accepted in counts} == {True, False}:
        # Held-out URLs calibrate, or all of them where either kind is not held out.
        threshold = calibrate(score(labelled.filter("held") if both[True] else labelled, model, "accepted"))
    else:
        threshold = -(2**62)
    scored = score(rows, model, "page_id", "host", "path", "rule", "given")
    guess = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return scored.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("given", guess).alias("verdict"),
        (F.col("score") / SCALE).alias("score"),
    )
