"""Fixtures that the tests of this folder import."""

import os
import random

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("no test data")
    return SF


@pytest.fixture(scope="session")
def table(spark):
    """Documents (doc_id, text) with columns of clashing names beside them."""

    def build(rows, schema="doc_id long, text string"):
        names = {part.split()[0] for part in schema.split(", ")}
        extra = [c for c in ("row", "key", "fp", "node", "size", "shard", "score", "group", "_id", "_text") if c not in names]
        filled = [(*row, *("x" for _ in extra)) for row in rows]
        return spark.createDataFrame(filled, ", ".join([schema, *(f"{c} string" for c in extra)]))

    return build


def words(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


@pytest.fixture()
def rng():
    return random.Random(5)
