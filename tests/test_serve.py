import datetime as dt
import random

import pytest
from conftest import plan_of, rows_of

from dimflow.operators import serve
from dimflow.schemas import OPEN_END, DimSpec

DAY = dt.date(2024, 1, 1)
SPEC = DimSpec("dim_k", keys=("k",), tracked=("v",), order_by=())


def day(n):
    return DAY + dt.timedelta(days=n)


def versions_of(spark, rows):
    return spark.createDataFrame(rows, "k string, v string, valid_from date, valid_to date")


WAYS = [{}, {"timeline": True}, {"binned": True}, {"binned": True, "crowded": 1}]


@pytest.mark.parametrize("way", WAYS)
def test_as_of_edges(spark, way):
    versions = versions_of(
        spark,
        [
            ("a", "one", day(0), day(5)),
            ("a", "skipped", day(5), day(5)),
            ("a", "two", day(5), day(7)),
            ("a", "three", day(9), OPEN_END),
            ("b", "b", day(3), OPEN_END),
            (None, "nobody", day(0), OPEN_END),
        ],
    )
    asked = [("a", -1, None), ("a", 0, "one"), ("a", 4, "one"), ("a", 5, "two"), ("a", 7, None),
             ("a", 8, None), ("a", 9, "three"), ("a", 9, "three"), ("b", 2, None), ("b", 4000, "b"),
             ("c", 5, None), (None, 5, None)]
    facts = spark.createDataFrame(
        [(i, k, day(n)) for i, (k, n, _) in enumerate(asked)] + [(99, "a", None)],
        "i int, k string, on_day date",
    )
    joined = serve.as_of_join(facts, versions, ["k"], "on_day", **way)
    assert joined.columns == ["i", "k", "on_day", "dim_v", "dim_valid_from", "dim_valid_to"]
    found = {r.i: r.dim_v for r in joined.collect()}
    assert found == {**{i: v for i, (_, _, v) in enumerate(asked)}, 99: None}


def test_all_ways_agree_with_brute_force_under_a_hot_key(spark):
    rng = random.Random(7)
    versions, facts = [], []
    for key in ["hot", *(f"k{i}" for i in range(30))]:
        cuts = sorted(rng.sample(range(400), 60 if key == "hot" else rng.randint(1, 5)))
        for i, start in enumerate(cuts):
            last = i + 1 == len(cuts)
            versions.append((key, f"{key}-{i}", day(start), OPEN_END if last else day(cuts[i + 1])))
    for i in range(3000):
        key = "hot" if i % 3 == 0 else f"k{rng.randint(0, 40)}"
        facts.append((i, key, day(rng.randint(-10, 420))))
    expected = sorted(
        (i, next((v for k, v, s, e in versions if k == key and s <= d < e), None)) for i, key, d in facts
    )
    frame = spark.createDataFrame(facts, "i int, k string, d date")
    for way in WAYS:
        joined = serve.as_of_join(frame, versions_of(spark, versions), ["k"], "d", **way)
        assert sorted(tuple(r) for r in joined.select("i", "dim_v").collect()) == expected


@pytest.mark.parametrize("way", WAYS)
def test_overlapping_versions_have_one_answer(spark, way):
    versions = versions_of(
        spark,
        [("a", "first", day(0), OPEN_END), ("a", "later", day(5), day(8)), ("b", "x", day(0), day(9)),
         ("b", "y", day(0), day(9)), ("b", "y", day(0), day(9))],
    )
    asked = [("a", 4, "first"), ("a", 5, "later"), ("a", 7, "later"), ("a", 8, None), ("b", 3, "y")]
    facts = spark.createDataFrame([(i, k, day(n)) for i, (k, n, _) in enumerate(asked)], "i int, k string, d date")
    joined = serve.as_of_join(facts, versions, ["k"], "d", **way)
    assert rows_of(joined, "i", "dim_v") == [(i, v) for i, (_, _, v) in enumerate(asked)]


@pytest.mark.parametrize("way", WAYS)
def test_a_timestamp_counts_as_its_date(spark, way):
    versions = versions_of(spark, [("a", "one", day(0), day(1)), ("a", "two", day(1), OPEN_END)])
    times = [dt.datetime(2024, 1, 1, 23, 59), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 0, 0, 1)]
    facts = spark.createDataFrame([("a", t) for t in times], "k string, at timestamp")
    joined = serve.as_of_join(facts, versions, ["k"], "at", **way)
    assert rows_of(joined, "at", "dim_v") == list(zip(times, ["one", "two", "two"]))


def test_a_hot_key_with_distinct_times_is_split(spark):
    """Half a table with one key and a time of its own for each row: the join splits it."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        facts = spark.range(0, 200_000, 1, 8).selectExpr(
            "IF(id % 2 = 0, 'hot', concat('k', id)) AS k", "timestamp_seconds(1704067200 + id) AS at"
        )
        versions = versions_of(spark, [("hot", f"v{n}", day(n), day(n + 1)) for n in range(3)])
        joined = serve.as_of_join(facts, versions, ["k"], "at")
        assert joined.filter("dim_v IS NOT NULL").count() == 100_000
        joined.write.format("noop").mode("overwrite").save()
        counted = joined.groupBy("dim_v").count()
        counted.collect()
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
        walked = serve.as_of_join(facts, versions, ["k"], "at", timeline=True)
        assert rows_of(walked.groupBy("dim_v").count()) == rows_of(counted)
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_the_versions_are_sorted_once_and_joined_without_counting(spark):
    facts = spark.createDataFrame([("a", day(1))], "k string, d date")
    versions = versions_of(spark, [("a", "one", day(0), day(2)), ("a", "two", day(2), OPEN_END)])
    plan = plan_of(serve.as_of_join(facts, versions, ["k"], "d"))
    assert "Window" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_version_views(spark):
    dim = spark.createDataFrame(
        [("a", "one", 1, day(0), day(1), False), ("a", "two", 2, day(1), OPEN_END, True)],
        "k string, v string, surrogate_key bigint, effective_start_date date,"
        " effective_end_date date, is_current boolean",
    )
    assert rows_of(serve.current_rows(dim), "v") == [("two",)]
    type2 = serve.type2_versions(dim, SPEC)
    assert type2.columns == ["k", "v", "surrogate_key", "valid_from", "valid_to"]
    current = spark.createDataFrame([("a", "two", day(1))], "k string, v string, record_effective_date date")
    history = spark.createDataFrame(
        [("a", "one", day(0), day(1))],
        "k string, v string, record_effective_date date, record_end_date date",
    )
    type4 = serve.type4_versions(current, history, SPEC)
    assert rows_of(type4) == rows_of(type2.drop("surrogate_key"))


def test_composite_keys(spark):
    versions = spark.createDataFrame(
        [("a", 1, "a1", day(0), OPEN_END), ("a", 2, "a2", day(5), OPEN_END), ("b", 1, "b1", day(0), day(3))],
        "k string, n int, v string, valid_from date, valid_to date",
    )
    facts = spark.createDataFrame(
        [("a", 1, day(1)), ("a", 2, day(1)), ("a", 2, day(5)), ("b", 1, day(3)), ("b", None, day(1))],
        "k string, n int, d date",
    )
    for way in WAYS:
        joined = serve.as_of_join(facts, versions, ["k", "n"], "d", **way)
        assert rows_of(joined, "k", "n", "d", "dim_v") == [
            ("a", 1, day(1), "a1"), ("a", 2, day(1), None), ("a", 2, day(5), "a2"),
            ("b", 1, day(3), None), ("b", None, day(1), None),
        ]


def test_bins_bound_what_a_fact_meets(spark):
    """A key with 3000 versions of a day, one with 200 versions over 30 years, and one with 3."""
    rows = [("daily", f"d{n}", day(n), day(n + 1)) for n in range(3000)]
    rows += [("rare", f"r{n}", day(55 * n), OPEN_END if n == 199 else day(55 * n + 55)) for n in range(200)]
    rows += [("few", f"f{n}", day(n), OPEN_END if n == 2 else day(n + 1)) for n in range(3)]
    asked = [(k, day(n)) for k in ("daily", "rare", "few", "none") for n in range(-3, 3003, 7)]
    facts = spark.createDataFrame(asked, "k string, day date")
    versions = versions_of(spark, rows).withColumnsRenamed({"valid_from": "dim_valid_from", "valid_to": "dim_valid_to"})
    binned, cut = serve.with_bins(facts, versions, ["k"], "day", "dim_")
    assert binned.columns == ["k", "day", "dim_bin_"] and cut.count() <= 2 * len(rows)
    met = binned.join(cut, ["k", "dim_bin_"]).groupBy("k", "day").count()
    assert met.agg({"count": "max"}).first()[0] <= serve.CROWDED
    per_task = binned.groupBy("k", "dim_bin_").count().filter("k = 'daily'")
    assert per_task.count() > 90  # the hot key is spread over its bins
