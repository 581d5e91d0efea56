import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import table  # noqa: F401

from dimflow.llm import ann

SCHEMA = "vec_id long, embedding array<float>"


def exact(rows, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(float)
    out = {}
    for i in range(len(rows)):
        if ids[i] % 20 == 0:
            score = (x * x[i]).sum(axis=1)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[i]][:k]
            out[int(ids[i])] = [(int(ids[j]), score[j]) for j in order]
    return out


def search(table, rows, k=20):
    found = ann.nearest(table(rows, SCHEMA), F.col("vec_id") % 20 == 0, k=k)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    out = {}
    for r in found.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


@pytest.mark.parametrize("dims", [64, 12])
def test_recall(spark, table, dims, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_BYTES", 40 * 8 * dims)  # several blocks of queries
    monkeypatch.setattr(ann, "ROWS", 150)
    monkeypatch.setattr(ann, "QUERIES", 30)
    rng = np.random.default_rng(dims)
    centres = rng.normal(size=(10, dims))
    rows = [(i, (centres[i % 10] + rng.normal(size=dims)).tolist()) for i in range(2000)]
    true, found = exact(rows, 20), search(table, rows)
    assert set(found) == set(true)
    hits = [len({v for v, _ in found[q]} & {v for v, _ in true[q]}) / 20 for q in true]
    assert np.mean(hits) >= 0.9
    x = dict(rows)
    for q, near in found.items():
        assert len(near) == 20
        for v, score in near:
            exactly = float(np.float32(x[q]).astype(float) @ np.float32(x[v]).astype(float))
            assert score == pytest.approx(exactly, abs=1e-9)


def test_every_code_within_the_radius_is_found():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 256, (700, ann.BITS // 8), np.uint8)
    for n, near in enumerate(range(0, 700, 7)):  # at 0 to 99 bits from row 3
        bits = np.unpackbits(codes[3])
        bits[rng.permutation(ann.BITS)[:n]] ^= 1
        codes[near] = np.packbits(bits)
    index = ann.Index(codes)
    asked = codes[[0, 3, 7, 699]]
    for radius in (0, 3, 40, 63, 64, 90, 200, 256, ann.BITS):
        for code, rows in zip(asked, index.within(asked, radius)):
            near = np.flatnonzero(np.unpackbits(codes ^ code, axis=1).sum(axis=1) <= radius)
            assert rows.tolist() == near.tolist()


def test_probing_prunes_where_vectors_cluster():
    """Tight clusters of vectors of one length: the indexes give few rows beside those of the query's cluster."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 64))
    x = np.repeat(centres, 50, axis=0) + 0.02 * rng.normal(size=(2000, 64))
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    coder = ann.fit(x, 1.0, 20)
    asked = coder.codes(x[::100], True)
    index = ann.Index(coder.codes(x, False))
    probed = np.unpackbits(index.probe(asked, coder.radius), axis=1, count=2000)
    assert coder.radius < 100 and probed.mean() < 0.2
    score = x[::100] @ x.T
    score[np.arange(20), np.arange(0, 2000, 100)] = -np.inf
    true = np.argsort(-score, axis=1)[:, :20]
    assert np.take_along_axis(probed, true, axis=1).mean() >= 0.9


def test_a_vector_with_many_copies(spark, table):
    """Two thirds of the rows are one vector; the others' neighbours are found all the same."""
    rng = np.random.default_rng(4)
    rows = [(i, [1.0] * 16 if i % 3 else rng.normal(size=16).tolist()) for i in range(900)]
    true, found = exact(rows, 20), search(table, rows)
    hits = [len({v for v, _ in found[q]} & {v for v, _ in true[q]}) / 20 for q in true]
    assert set(found) == set(true) and np.mean(hits) >= 0.95
    for q in true:
        if q % 3:
            assert [v for v, _ in found[q]] == [v for v, _ in true[q]]


def test_ids_of_text_and_other_columns(spark, table):
    """Ids need no numbers; columns named as those inside do not matter."""
    rows = [(f"k{i:03}", [float(i % 7), float(i % 5) + 1], i, "x", 0.5) for i in range(60)]
    given = spark.createDataFrame(rows, "id string, v array<float>, row long, vec string, score double")
    found = ann.nearest(given, F.col("vec_id").endswith("0"), "id", "v", k=3)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    for i in range(0, 60, 10):
        q = rows[i]
        order = sorted((r for r in rows if r[0] != q[0]), key=lambda r: (-(r[1][0] * q[1][0] + r[1][1] * q[1][1]), r[0]))
        assert got[q[0]] == [r[0] for r in order[:3]]


def test_norms_and_ties(spark, table):
    """Inner products, not angles; equal scores go to the least id."""
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [9.0, 9.0]), (3, [0.5, 0.1]), (4, [0.5, -0.1]), (5, [-1.0, 0.0])]
    assert [v for v, _ in search(table, rows)[0]] == [2, 1, 3, 4, 5]


def test_what_takes_no_part(spark, table):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, None), (40, [0.0, 0.0]), (60, [nan, 1.0]), (80, [1.0, None]), (100, [inf, 1.0]),
            (120, []), (140, [1.0, 2.0, 3.0]), (None, [1.0, 2.0]), (1, [3.0, 4.0]), (1, [3.0, 4.0]), (0, [1.0, 2.0])]
    found = ann.nearest(table(rows, SCHEMA), F.col("vec_id") % 20 == 0).collect()
    # Two rows of query 0, each with both rows of vector 1.
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == [
        (0, 1, 1, 11.0), (0, 1, 1, 11.0), (0, 2, 1, 11.0), (0, 2, 1, 11.0),
    ]
    assert search(table, []) == {} and search(table, [(1, [1.0])]) == {} and search(table, [(0, [1.0])]) == {}


def test_many_equal_vectors(spark, table):
    rows = [(i, [1.0, 1.0] if i % 3 else [1.0, -0.5]) for i in range(300)]
    true, found = exact(rows, 20), search(table, rows)
    assert {q: [v for v, _ in n] for q, n in found.items()} == {q: [v for v, _ in n] for q, n in true.items()}
