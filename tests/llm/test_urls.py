import math
from collections import Counter

from conftest import rows_of
from llm_fixtures import rng, table  # noqa: F401

from dimflow.llm import urls
from dimflow.llm.queries import URL_RULES

SCHEMA = "page_id long, url string"


def parts(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:cut], rest[cut:]
    end = min([path.find(c) for c in "?#" if c in path], default=len(path))
    return "".join(c.lower() if c.isascii() else c for c in host), path[:end]


def rule_of(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def test_sites_and_rules(spark, table):
    rows = [
        (1, "https://A.Example.ORG/es/1?q"), (2, "http://example.org/en/12"), (3, "http://xexample.org/es/1"),
        (4, "x://org/"), (5, "x://org"), (6, "http://sub.com/fr/9#/x"), (7, "http://com/de/"), (8, "no scheme"),
        (9, None), (10, ""), (11, "a://b://c/d"), (12, "http://h?x=://y/"), (13, "http://É.COM/de/"),
    ]
    found = {r.page_id: r for r in urls.judge(table(rows, SCHEMA), URL_RULES).collect()}
    for page, url in rows:
        host, path = parts(url)
        rule = rule_of(host, path)
        assert (found[page].host, found[page].path) == (host, path)
        assert found[page].rule == (rule.name if rule else None)
        assert found[page].verdict == rule.verdict if rule else found[page].verdict in ("allow", "block")


def smoothed(grams):
    """P(c | a b) by Witten-Bell, from the trigrams of one kind."""
    def level(order):
        pairs = Counter((g[2 - order : 2], g[2]) for g in grams)
        total, kinds = Counter(), Counter()
        for (context, _), n in pairs.items():
            total[context] += n
            kinds[context] += 1
        return pairs, total, kinds

    levels = [level(k) for k in (0, 1, 2)]

    def p(gram):
        out = 1 / len(urls.SYMBOLS)
        for k, (pairs, total, kinds) in enumerate(levels):
            context = gram[2 - k : 2]
            if total[context]:
                out = (pairs[context, gram[2]] + kinds[context] * out) / (total[context] + kinds[context])
        return out

    return p


def test_model_equals_brute_force(spark):
    good, bad = ["http://a.b/c1", "http://a.b/cc2"], ["https://spam-x.y/9", "https://spam.z/98"]
    rows = [(u, True) for u in good] + [(u, False) for u in bad]
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(rows, "url string, accepted boolean")
    frame = frame.select("accepted", urls.symbols(F.col("url")).alias("_symbols"))
    grams = {True: [], False: []}
    for row in frame.collect():
        s = row["_symbols"]
        grams[row["accepted"]] += [s[i : i + 3] for i in range(len(s) - 2)]
    model = {r.gram: r.ratio for r in urls.learn(frame).collect()}
    assert len(model) == len(urls.SYMBOLS) ** 3 == 40**3
    p, q = smoothed(grams[True]), smoothed(grams[False])
    for gram in [*grams[True], *grams[False], "abc", "^^z", "0~$"]:
        assert abs(model[gram] - math.log(p(gram) / q(gram)) * urls.SCALE) < 1


def test_the_method_learns_from_the_rules(spark, table, rng):
    rows = []
    for i in range(300):
        kind = rng.choice(["org/en", "com/de"])
        word = rng.choice(["news", "wiki"]) if kind == "org/en" else rng.choice(["casino", "bets"])
        rows.append((i, f"http://{word}{rng.randrange(9)}.example.{kind}/{i + 200}"))
    rows += [(1000, "http://wiki2.site.net/x"), (1001, "http://casino3.site.net/x")]
    found = dict(rows_of(urls.judge(table(rows, SCHEMA), URL_RULES), "page_id", "verdict"))
    assert (found[1000], found[1001]) == ("allow", "block")


def test_digits_are_told_apart(spark, table):
    rows = [(100 * d + i, f"http://example.org/en/{d}{i:02}") for d in range(1, 10) for i in range(40)]
    rows += [(5000 + d, f"http://example.net/en/{d}77") for d in range(1, 10)]  # no rule
    found = {r.page_id: r for r in urls.judge(table(rows, SCHEMA), URL_RULES).collect()}
    assert found[5001].rule is None and found[5001].verdict == "block"
    assert found[5001].score < min(found[5000 + d].score for d in range(2, 10))
    assert max(found[100 + i].score for i in range(40)) < min(found[200 + i].score for i in range(40))
    assert len(urls.ALL_DIGITS) == len(set(urls.ALL_DIGITS)) == 49


def test_repeated_missing_classes_and_empty(spark, table):
    rows = [(1, "http://x.net/a"), (1, "http://x.net/a"), (2, "http://x.org/a"), (None, "http://é.net/" + "a" * 20_000)]
    out = urls.judge(table(rows, SCHEMA), URL_RULES)
    assert [r[1] for r in rows_of(out, "page_id", "verdict")] == ["allow"] * 4  # nothing is rejected
    assert urls.judge(table([], SCHEMA), URL_RULES).count() == 0


def test_native(spark, table):
    plan = urls.judge(table([(1, "a://b/")], SCHEMA), URL_RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
