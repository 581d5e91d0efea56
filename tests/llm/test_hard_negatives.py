"""Hard negatives against brute force, and the bounds that the filter relies on."""

import random

import duckdb
import numpy as np
import pytest
from conftest import rows_of
from llm_fixtures import sf, table  # noqa: F401
from pyspark.sql import functions as F

from dimflow.llm import hard_negatives as hn
from dimflow.llm import oracles
from dimflow.llm.queries import op13_hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, is_anchor, positives=5, per_window=10):
    good = [
        (i, [int(np.floor(256 * x)) for x in v], label) for i, v, label in rows
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for k, (anchor, a, label) in enumerate(good):
        if not is_anchor(anchor):
            continue
        scored = [(-sum(x * y for x, y in zip(a, v)), i, other) for j, (i, v, other) in enumerate(good) if j != k and len(v) == len(a)]
        mine = sorted((s, i) for s, i, other in scored if other == label)[:positives]
        rest = sorted((s, i) for s, i, other in scored if other != label)
        for ps, p in mine:
            fits = [(s, i) for s, i in rest if 30 * -ps <= 100 * -s <= 90 * -ps][:per_window]
            out += [(anchor, p, r, i, -ps, -s) for r, (s, i) in enumerate(fits, 1)]
    return sorted(out, key=repr)


def found(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return rows_of(df)


def vectors(rng, n, dim, spread=1.0, centres=4):
    middle = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(centres)]
    return [[m + spread * rng.gauss(0, 1) for m in middle[rng.randrange(centres)]] for _ in range(n)]


@pytest.mark.parametrize("spread, scale", [(1.0, 1.0), (0.1, 1.0), (1.0, 0.004), (0.5, 40_000.0)])
def test_equals_brute_force(table, spread, scale):  # noqa: F811
    """Also with many ties (small components) and with scores that doubles do not hold."""
    rng = random.Random(3)
    rows = [(i, [scale * x for x in v], rng.randrange(3)) for i, v in enumerate(vectors(rng, 300, 6, spread))]
    rows += [(i + 300, rows[7][1], rng.randrange(3)) for i in range(60)]  # one hot vector
    got = found(hn.mine(table(rows, SCHEMA), F.col("vec_id") % 10 == 0))
    assert got == brute(rows, lambda i: i % 10 == 0) and got


def test_blocks_of_anchors(table):  # noqa: F811
    rng = random.Random(4)
    rows = [(i, v, rng.randrange(3)) for i, v in enumerate(vectors(rng, 120, 5))]
    assert found(hn.mine(table(rows, SCHEMA), F.col("vec_id") % 4 == 0, block=7)) == brute(rows, lambda i: i % 4 == 0)


def test_defined_cases(table):  # noqa: F811
    rng = random.Random(5)
    rows = [(i, v, rng.randrange(2)) for i, v in enumerate(vectors(rng, 40, 3))]
    rows += [(50, None, 1), (51, [], 1), (52, [1.0, None, 1.0], 1), (53, [1.0, float("nan"), 1.0], 0), (54, [float("inf")] * 3, 0),
             (55, [1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0], 1), (56, [0.0, 0.0, 0.0], 1), (57, [1.0, 2.0], 1), (58, [2.0, 2.0], 1),
             (59, [1.5, 1.0], 0)]
    rows += rows[:6]
    everyone = F.col("vec_id") >= 0
    assert found(hn.mine(table(rows, SCHEMA), everyone)) == brute(rows, lambda i: True)
    huge = [*rows, (60, [1e30, 1.0, 1.0], 1), (61, [1e7, 1.0, 1.0], 0)]
    assert found(hn.mine(table(huge, SCHEMA), everyone)) == brute(rows, lambda i: True)
    assert hn.mine(table([], SCHEMA), everyone).count() == 0
    assert hn.mine(table(rows, SCHEMA), F.lit(False)).count() == 0


def test_bounds_hold_every_score():
    rng = np.random.default_rng(1)
    a = np.floor(256 * rng.normal(size=(200, 8)))
    a[:20] = a[20:40] * 3  # parallel vectors: cosines of 1, where rounding hurts
    norms = np.sqrt((a**2).sum(1))
    angles = hn.angles_to(a, norms, hn.directions(a[::9] / norms[::9, None]))
    least, most = hn.score_bounds(angles, norms, angles, norms)
    scores = hn.exact_scores(a, norms, a, norms)
    assert (least <= scores).all() and (scores <= most).all()


def test_angles_spare_scores_where_vectors_are_structured(monkeypatch):
    """Of tight clusters most pairs are never scored."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    a = np.floor(256 * (centres[rng.integers(0, 12, 2000)] + 0.03 * rng.normal(size=(2000, 16))))
    norms = np.sqrt((a**2).sum(1))
    angles = hn.angles_to(a, norms, hn.directions(a / norms[:, None]))
    least, most = hn.score_bounds(angles, norms, angles, norms)
    best = (a @ a.T)[:50].max(1)[:, None]
    assert ((most[:50] >= 0.3 * best) & (least[:50] <= 0.9 * best)).mean() < 0.5


def test_the_whole_table_equals_sql(spark, sf):  # noqa: F811
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    result = duck.execute(oracles.ORACLES["op13_hard_negatives"])
    names = [c[0] for c in result.description]
    got = rows_of(op13_hard_negatives(spark, sf), *names)
    assert got == sorted(result.fetchall(), key=repr) and got
