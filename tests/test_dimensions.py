"""Slices, change detection, surrogate keys and both kinds of merge."""

import datetime as dt
import random

import pytest
from conftest import plan_of, rows_of
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from dimflow.functions.compare import any_differs, digestible, row_digest
from dimflow.operators import changes
from dimflow.operators.changes import classify, digest_of, with_digest, without_digests
from dimflow.operators.slices import latest_per_key
from dimflow.operators.surrogate import number_densely, place_in_order
from dimflow.operators.type2 import TYPE2_COLUMNS, apply_type2, last_key, merge_type2
from dimflow.operators.type4 import merge_type4
from dimflow.schemas import DIM_CUSTOMER, OPEN_END, DimSpec
from dimflow.sources.staging import stage

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)
NAN = float("nan")
PAIR = DimSpec("dim_pair", keys=("a", "b"), tracked=("x", "y"), order_by=())
PAIR_SCHEMA = "a string, b int, x string, y double"


# Slices


def test_latest_row_wins_and_null_keys_are_left_out(loans):
    noon = dt.datetime(2024, 1, 1, 12)
    rows = loans(
        {"customer_id": "C1", "customer_name": "old", "last_updated": noon},
        {"customer_id": "C1", "customer_name": "new", "last_updated": noon + dt.timedelta(seconds=1)},
        {"customer_id": "C1", "customer_name": "undated", "last_updated": None},
        {"customer_id": "C2", "customer_name": "a", "loan_id": "L1", "last_updated": noon},
        {"customer_id": "C2", "customer_name": "b", "loan_id": "L2", "last_updated": noon},
        {"customer_id": "C3", "customer_name": None, "annual_income": 2.0, "last_updated": noon},
        {"customer_id": "C3", "customer_name": None, "annual_income": 1.0, "last_updated": noon},
        {"customer_id": "C4", "customer_name": "only", "last_updated": None},
        {"customer_id": None, "customer_name": "nobody"},
    )
    latest = latest_per_key(rows, DIM_CUSTOMER)
    assert latest.columns == list(DIM_CUSTOMER.columns)
    assert rows_of(latest, "customer_id", "customer_name") == [
        ("C1", "new"), ("C2", "b"), ("C3", None), ("C4", "only"),
    ]
    assert latest.filter("customer_id = 'C3'").first().annual_income == 2.0


def test_a_hot_key_is_combined_before_the_shuffle(spark, loans):
    rows = loans({}).drop("customer_id").crossJoin(spark.range(0, 9000, 1, 6)).withColumn(
        "customer_id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    ).withColumn("customer_name", F.col("id").cast("string"))
    rows = rows.withColumn("loan_id", F.lpad(F.col("id").cast("string"), 6, "0"))
    latest = latest_per_key(rows, DIM_CUSTOMER)
    assert latest.count() == 6001
    assert latest.filter("customer_id = 'hot'").first().customer_name == "8997"
    assert "partial_max" in plan_of(latest)


# Change detection


@pytest.mark.parametrize(
    ("new", "was", "differs"),
    [
        (1.0, 1.0, False), (1.0, 2.0, True), (None, 1.0, True), (1.0, None, True),
        (None, None, False), (NAN, NAN, False), (NAN, 1.0, True), (NAN, None, True),
        (0.0, -0.0, False),
    ],
)
def test_null_safe_difference(spark, new, was, differs):
    df = spark.createDataFrame([(new, was)], "new double, was double")
    assert df.select(any_differs([("new", "was")])).first()[0] is differs


def test_classify_with_composite_keys(spark):
    updates = spark.createDataFrame(
        [("k", 1, "x", 1.0), ("k", 2, "x", None), ("k", 3, None, 1.0), ("z", 1, "x", 1.0)], PAIR_SCHEMA
    )
    current = spark.createDataFrame(
        [("k", 1, "x", 1.0), ("k", 2, "x", 2.0), ("k", 3, None, 1.0), ("absent", 1, "x", 1.0)],
        PAIR_SCHEMA,
    )
    found = classify(updates, current, PAIR)
    assert rows_of(found, "a", "b", "_action", "_was_y") == [
        ("absent", 1, "absent", 1.0),
        ("k", 1, "same", 1.0), ("k", 2, "changed", 2.0), ("k", 3, "same", 1.0), ("z", 1, "new", None),
    ]


def test_each_side_of_a_merge_is_shuffled_once(spark):
    columns = ("string(id) AS a", "1 AS b", "'x' AS x", "0D AS y", "date'2023-01-01' AS record_effective_date")
    current = stage(spark.range(1000).selectExpr(*columns))
    updates = stage(pairs(spark, ("1", 1, "z", 0.0)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = classify(updates, current, PAIR)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2 and plan.count("FileScan") == 2
        # All else reads the staged comparison: nothing of a merge scans or shuffles a side again.
        merge = merge_type4(updates, current, PAIR, D1)
        for part in (merge.delta, merge.archived, merge.kept, merge.inserted):
            plan = part._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and plan.count("FileScan") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_column_that_the_current_rows_lack_counts_as_null(spark):
    current = pairs(spark, ("a", 1, "x", 1.0), ("b", 1, "x", 1.0)).drop("y")
    updates = pairs(spark, ("a", 1, "x", 2.0), ("b", 1, "x", None))
    found = classify(updates, current, PAIR)
    assert rows_of(found, "a", "_action", "_was_y") == [("a", "changed", None), ("b", "same", None)]


# Surrogate keys


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_dense_numbers_equal_a_global_window(spark, adaptive):
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        rows = spark.range(0, 20000, 1, 7).select(
            F.concat(F.lit("K"), (F.col("id") * 7919 % 20011).cast("string")).alias("k"),
            (F.col("id") % 3 == 0).alias("later"),
        )
        start = spark.createDataFrame([(41,)], "n bigint")
        numbered = number_densely(place_in_order(rows, ["later", "k"]), start)
        expected = F.row_number().over(Window.orderBy("later", "k")) + 41
        compared = numbered.withColumn("expected", expected)
        assert compared.count() == 20000
        assert compared.filter(F.col("expected") != F.col("surrogate_key")).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_only_partition_sizes_reach_one_task(spark):
    rows = spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("wide"))
    start = spark.createDataFrame([(0,)], "n bigint")
    logical = number_densely(place_in_order(rows, ["k"]), start)
    plan = logical._jdf.queryExecution().executedPlan().toString()
    single = plan[plan.index("Exchange SinglePartition"):]
    assert "wide" not in single and "count(1)" in single


def test_numbering_nothing(spark):
    rows = spark.range(0).select(F.col("id").cast("string").alias("k"))
    start = spark.createDataFrame([(5,)], "n bigint")
    assert number_densely(place_in_order(rows, ["k"]), start).count() == 0


# Type 2


def pairs(spark, *rows):
    return spark.createDataFrame(list(rows), PAIR_SCHEMA)


def test_type2_life_of_a_dimension(spark):
    first = apply_type2(pairs(spark, ("b", 1, "x", 1.0), ("a", 2, "x", 1.0), ("a", 1, "x", 1.0)), None, PAIR, D1)
    assert first.columns == [*PAIR.columns, *TYPE2_COLUMNS]
    assert rows_of(first) == [
        ("a", 1, "x", 1.0, 1, D1, OPEN_END, True),
        ("a", 2, "x", 1.0, 2, D1, OPEN_END, True),
        ("b", 1, "x", 1.0, 3, D1, OPEN_END, True),
    ]
    # One key unchanged, one changed, one absent, two new ones that sort first.
    batch = pairs(spark, ("a", 1, "x", 1.0), ("b", 1, "x", None), ("Z", 1, "n", 0.0), ("A", 1, "n", 0.0))
    second = stage(apply_type2(batch, stage(first), PAIR, D2))
    assert second.schema == first.schema
    assert rows_of(second) == [
        ("A", 1, "n", 0.0, 5, D2, OPEN_END, True),
        ("Z", 1, "n", 0.0, 6, D2, OPEN_END, True),
        ("a", 1, "x", 1.0, 1, D1, OPEN_END, True),
        ("a", 2, "x", 1.0, 2, D1, OPEN_END, True),
        ("b", 1, "x", 1.0, 3, D1, D2, False),
        ("b", 1, "x", None, 4, D2, OPEN_END, True),
    ]
    assert rows_of(apply_type2(batch, second, PAIR, D3)) == rows_of(second)
    again = merge_type2(batch, second.filter("is_current"), PAIR, D3)
    assert again.inserted.isEmpty() and again.expired.isEmpty()


def test_type2_second_change_on_a_day_leaves_an_empty_version(spark):
    dim = None
    for value in ("one", "two", "three"):
        dim = stage(apply_type2(pairs(spark, ("a", 1, value, 0.0)), dim, PAIR, D1))
    assert rows_of(dim, "surrogate_key", "x", "effective_start_date", "effective_end_date") == [
        (1, "one", D1, D1), (2, "two", D1, D1), (3, "three", D1, OPEN_END),
    ]


def test_type2_key_that_returns_to_an_old_value_gets_a_new_version(spark):
    dim = None
    for value, day in (("on", D1), ("off", D2), ("on", D3)):
        dim = stage(apply_type2(pairs(spark, ("a", 1, value, 0.0)), dim, PAIR, day))
    assert rows_of(dim, "surrogate_key", "x", "is_current") == [
        (1, "on", False), (2, "off", False), (3, "on", True),
    ]


# Type 4


def test_type4_life_of_a_dimension(spark):
    first = merge_type4(pairs(spark, ("a", 1, "x", 1.0), ("b", 1, "x", 1.0), ("c", 1, "x", 1.0)), None, PAIR, D1)
    assert first.archived.isEmpty()
    current = stage(first.current)
    second = merge_type4(pairs(spark, ("a", 1, "x", 1.0), ("b", 1, None, 1.0), ("d", 1, "n", 0.0)), current, PAIR, D2)
    assert rows_of(second.current) == [
        ("a", 1, "x", 1.0, D1), ("b", 1, None, 1.0, D2), ("c", 1, "x", 1.0, D1), ("d", 1, "n", 0.0, D2),
    ]
    assert second.archived.columns == [
        *PAIR.columns, "record_effective_date", "record_end_date", "archived_at",
    ]
    assert rows_of(second.archived.drop("archived_at")) == [("b", 1, "x", 1.0, D1, D2)]
    assert second.archived.filter("archived_at IS NULL").isEmpty()


def test_two_slices_in_order_equal_one_run(spark, loans):
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows = loans(
        *[
            {
                "customer_id": f"C{rng.randint(1, 12)}",
                "loan_id": f"L{i}",
                "employment_status": rng.choice(["Employed", "Retired", None]),
                "last_updated": start + dt.timedelta(hours=rng.randint(0, 50)),
            }
            for i in range(80)
        ]
    )
    cut = F.lit(start + dt.timedelta(hours=25))
    whole = merge_type4(latest_per_key(rows, DIM_CUSTOMER), None, DIM_CUSTOMER, D1).current
    current = None
    for part in (rows.filter(F.col("last_updated") <= cut), rows.filter(F.col("last_updated") > cut)):
        current = stage(merge_type4(latest_per_key(part, DIM_CUSTOMER), current, DIM_CUSTOMER, D1).current)
    assert rows_of(current, *DIM_CUSTOMER.columns) == rows_of(whole, *DIM_CUSTOMER.columns)


# Properties

values = st.tuples(st.sampled_from(["p", "q", None]), st.sampled_from([0.0, 1.0, NAN, None]))
batch = st.dictionaries(st.tuples(st.sampled_from("abc"), st.integers(1, 3)), values, min_size=1)


def same(one, other):
    return repr(one) == repr(other)


def texts(rows):
    """Rows as sorted text, in which NaN equals NaN."""
    return sorted(map(repr, rows))


@settings(
    max_examples=4,
    deadline=None,
    phases=[Phase.generate],
    suppress_health_check=[HealthCheck.too_slow],
)
@given(st.lists(batch, min_size=2, max_size=3))
def test_merges_equal_a_replay_by_hand(spark, batches):
    """Both layouts hold exactly the versions that a dict of current values goes through."""
    live, versions, next_key, dim, current, archived = {}, [], 1, None, None, []
    for day, rows in enumerate(batches):
        date = D1 + dt.timedelta(days=day)
        changed = sorted(k for k in rows if k in live and not same(live[k][0], rows[k]))
        new = sorted(k for k in rows if k not in live)
        for key in changed:
            value, since, number = live[key]
            versions.append((*key, *value, number, since, date, False))
        for key in changed + new:
            live[key] = (rows[key], date, next_key)
            next_key += 1
        updates = pairs(spark, *[(*key, *value) for key, value in rows.items()])
        dim = stage(apply_type2(updates, dim, PAIR, date))
        merge = merge_type4(updates, current, PAIR, date)
        archived += rows_of(merge.archived.drop("archived_at"))
        current = stage(merge.current)
    open_versions = [(*k, *v, number, since, OPEN_END, True) for k, (v, since, number) in live.items()]
    assert texts(rows_of(dim)) == texts(versions + open_versions)
    assert texts(rows_of(current)) == texts((*v[:4], v[5]) for v in open_versions)
    assert texts(archived) == texts((*v[:4], v[5], v[6]) for v in versions)
    # The largest key is always a current one, which lets merges leave history unread.
    assert rows_of(last_key(dim)) == rows_of(last_key(dim.filter("is_current")))


# Digests


def test_digests_agree_with_the_comparison(spark):
    """Over all pairs of rows of special values, moved ones and types."""
    values = [
        (None, None, None, None), ("", None, None, None), (None, NAN, None, None), ("x", 0.0, 1, D1), ("x", -0.0, 1, D1),
        ("x", None, 1, D1), (None, 1.0, 1, D1), ("1", None, None, None), (None, 1.0, None, None), (None, None, 1, None),
        ("x", 0.0, 0, D1), ("x", 0.0, None, D1), ("x", 0.0, 1, D2), ("x,", 0.0, 1, D1), ("0:x", 0.0, 1, D1),
    ]
    names = ["s", "x", "n", "d"]
    rows = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], "i int, s string, x double, n int, d date")
    rows = rows.withColumn("digest", row_digest(names))
    pairs = rows.join(rows.select(*[F.col(c).alias(f"_{c}") for c in rows.columns]), F.col("i") <= F.col("_i"))
    both = pairs.select(any_differs((c, f"_{c}") for c in names).alias("differs"), (F.col("digest") != F.col("_digest")).alias("told"))
    assert rows_of(both.distinct()) == [(False, False), (True, True)]
    assert both.filter("not differs").count() == len(values) + 1


def test_what_has_no_digest(spark):
    schema = spark.createDataFrame([], "a int, s string, d decimal(9,2), l array<int>, c string collate utf8_lcase").schema
    assert [digestible([f.dataType]) for f in schema] == [True, True, True, False, False]
    nested = DimSpec("dim", keys=("k",), tracked=("l",), order_by=())
    rows = spark.createDataFrame([(1, [1]), (2, [1])], "k int, l array<int>")
    assert digest_of(with_digest(rows, nested)) is None
    later = with_digest(spark.createDataFrame([(1, [1, None]), (2, [1])], "k int, l array<int>"), nested)
    assert merge_type4(later, merge_type4(rows, None, nested, D1).current, nested, D2).archived.count() == 1


@pytest.mark.parametrize("seed", range(2))
def test_merges_by_digest_equal_merges_by_attributes(spark, seed):
    rng = random.Random(seed)

    def batch():
        return pairs(spark, *[
            (a, b, rng.choice(["", "x", None]), rng.choice([0.0, -0.0, NAN, None])) for a in "pqr" for b in range(8) if rng.random() < 0.7
        ])

    def shown(df):  # NaN does not equal itself
        return list(map(repr, rows_of(df)))

    plain = digested = plain4 = digested4 = None
    for date in (D1, D2, D3):
        rows = stage(batch())
        one, two = merge_type2(rows, plain, PAIR, date), merge_type2(with_digest(rows, PAIR), digested, PAIR, date)
        assert shown(two.expired) == shown(one.expired) and two.expired.columns == one.expired.columns
        plain, digested = stage(one.current), stage(two.current)
        assert digest_of(digested) and shown(without_digests(digested)) == shown(plain)
        one, two = merge_type4(rows, plain4, PAIR, date), merge_type4(with_digest(rows, PAIR), digested4, PAIR, date)
        assert shown(two.archived.drop("archived_at")) == shown(one.archived.drop("archived_at"))
        plain4, digested4 = stage(one.current), stage(two.current)
        assert shown(without_digests(digested4)) == shown(plain4)


def test_comparing_reads_keys_and_digests_only(spark, monkeypatch):
    current = stage(with_digest(pairs(spark, ("a", 1, "x", 1.0), ("b", 1, "x", 1.0)), PAIR))
    staged = []
    monkeypatch.setattr(changes, "stage", lambda df: staged.append(df) or stage(df))
    updates = with_digest(pairs(spark, ("a", 1, "x", 1.0), ("b", 1, "y", 1.0), ("c", 1, "x", 1.0)), PAIR)
    compared = changes.compare(updates, current, PAIR)
    digest = digest_of(current)
    assert f"ReadSchema: struct<a:string,b:int,{digest}:binary>" in plan_of(staged[0])
    assert rows_of(compared.apply, "a", changes.ACTION) == [("b", "changed"), ("c", "new")]
    assert rows_of(compared.changed, "a") == [("b",)] and rows_of(compared.kept, "a") == [("a",)]


def test_many_changed_keys_meet_the_current_rows_once(spark, monkeypatch):
    current = stage(with_digest(pairs(spark, ("a", 1, "x", 1.0), ("b", 1, "x", 1.0), ("d", 1, None, None)), PAIR))
    updates = stage(with_digest(pairs(spark, ("a", 1, "x", 1.0), ("b", 1, "y", 1.0), ("c", 1, "x", 1.0)), PAIR))
    few = changes.compare(updates, current, PAIR)
    monkeypatch.setattr(changes, "FEW_KEYS", 0)
    many = changes.compare(updates, current, PAIR)
    for one, other in zip(few, many):
        assert rows_of(one) == rows_of(other) and one.columns == other.columns
    assert "Join" not in plan_of(many.changed) + plan_of(many.kept)


def test_a_first_load_is_not_compared(spark, monkeypatch):
    staged = []
    monkeypatch.setattr(changes, "stage", lambda df: staged.append(df) or stage(df))
    updates = stage(with_digest(pairs(spark, ("a", 1, "x", 1.0), ("b", 1, "x", None)), PAIR))
    for rows in (updates, without_digests(updates)):
        merge = merge_type4(rows, None, PAIR, D1)
        assert rows_of(merge.current, "a", "y") == [("a", 1.0), ("b", None)] and merge.archived.isEmpty()
        assert digest_of(merge.current) == digest_of(rows)
    assert staged == []
