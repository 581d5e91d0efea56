import zlib

from conftest import rows_of
from llm_fixtures import rng, table  # noqa: F401

from dimflow.llm import sharding


def smallest_capacity(sizes, shards):
    """By trying every capacity from the largest group on."""
    capacity = max([0, *sizes])
    while True:
        used, free = 1, capacity
        for size in sizes:
            if size > free:
                used, free = used + 1, capacity
            free -= size
        if used <= shards:
            return capacity
        capacity += 1


def check(rows, out, shards):
    size = lambda t: len((t or "").encode()) + 1
    text_of = {}
    found = out.collect()
    assert out.columns[:7] == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in found) == sorted(
        (str(d), size(t), zlib.crc32((t or "").encode())) for d, t in rows
    )
    assert {(r.law, r.grown_shard) for r in found} <= {("bytes", None)}
    for s in range(shards):
        own = [r for r in found if r.shard == s]
        assert sorted(r.slot for r in own) == list(range(len(own)))
    # Texts stay whole, and shards are runs of the groups in the order of their first ids.
    groups = {}
    for d, t in rows:
        groups.setdefault(t, []).append(d)
    for r in found:
        text_of.setdefault(r.doc_id, r)
    placed = {}
    for t, ids in groups.items():
        homes = {r.shard for r in found if r.doc_id in ids and r.text_crc32 == zlib.crc32((t or "").encode())
                 and r.size == size(t)}
        placed[t] = homes
    first = lambda t: min((d for d in groups[t] if d is not None), default=-1)
    order = sorted(groups, key=first)
    runs = [min(placed[t]) for t in order]
    assert runs == sorted(runs) and all(len(h) == 1 for h in placed.values())
    used = [sum(r.size for r in found if r.shard == s) for s in range(shards)]
    assert max(used) == smallest_capacity([size(t) * len(groups[t]) for t in order], shards)


def test_equals_brute_force(spark, table, rng):
    rows = [(i, "é" * rng.randrange(60) + str(i % 50)) for i in range(300)]
    check(rows, sharding.shard(table(rows), shards=8), 8)


def test_a_third_of_the_rows_is_one_group(spark, table, rng):
    rows = [(i, "copy" if i % 3 == 0 else "x" * rng.randrange(30) + str(i)) for i in range(400)]
    check(rows, sharding.shard(table(rows), shards=5), 5)


def test_nulls_empty_long_and_repeated(spark, table):
    rows = [(1, None), (2, ""), (2, ""), (3, "z" * 50_000), (None, "n"), (4, None), (4, "t"), (4, "t")]
    out = sharding.shard(table(rows), shards=3)
    assert out.count() == len(rows)
    by = {(r.doc_id, r.size) for r in out.collect()}
    assert (1, 1) in by and (3, 50_001) in by and (None, 2) in by
    shards = {r.shard for r in out.filter("size = 1 AND doc_id IN (1, 4)").collect()}
    assert len(shards) == 1  # null texts are one group


def test_few_groups_and_none(spark, table):
    assert rows_of(sharding.shard(table([(1, "a")]), shards=8), "shard", "slot") == [(0, 0)]
    assert sharding.shard(table([]), shards=8).count() == 0


def test_native(spark, table):
    plan = sharding.shard(table([(1, "a"), (2, "b")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
