"""Late batches: spliced versions against a plain replay in the order of dates."""

import datetime as dt
import itertools
import random
import re

import pytest
from conftest import LOAN, plan_of, rows_of

from dimflow.operators import splice as splicing
from dimflow.operators.splice import observations, splice
from dimflow.plans import jobs
from dimflow.schemas import DIM_CUSTOMER, LOAN_COLUMNS, OPEN_END, DimSpec

SPEC = DimSpec("dim_pair", keys=("a", "b"), tracked=("x", "y"), order_by=("at",))
SEEN = "a string, b int, x string, y double, at int, batch date, ingestion_timestamp timestamp"
OLD = "a string, b int, x string, y double, surrogate_key long, valid_from date, valid_to date"


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def time_of(n):
    return dt.datetime(2025, 1, 1) + dt.timedelta(minutes=n)


def replay(shown):
    """(start, end, values) of one key from (date, arrival, values)."""
    starts, last = [], None
    for date, _, values in sorted(shown, key=lambda s: s[:2]):
        if last is None or repr(values) != repr(last[0]):
            starts.append((date, values))
            last = (values,)
    ends = [s for s, _ in starts[1:]] + [OPEN_END]
    return [(start, end, values) for (start, values), end in zip(starts, ends)]


@pytest.mark.parametrize("seed", range(3))
def test_equals_replay(spark, seed):
    """Values come back, are null or NaN, repeat, and share days; the late batch touches half of the keys."""
    rng = random.Random(seed)
    values = [("p", 1.0), ("q", None), (None, float("nan")), (None, None)]
    late, arrival = day(4), 100
    seen, old, want = [], [], []
    for k in range(40):
        key = (f"k{k % 7}", k)
        shown = [(day(rng.choice([0, 2, 4, 4, 6, 8])), n, rng.choice(values)) for n in range(rng.randrange(0, 7))]
        for n, (start, end, v) in enumerate(replay(shown)):
            old.append((*key, *v, 1000 * k + n, start, end))
        if k % 2:
            shown.append((late, arrival, rng.choice(values)))
            want += [(*key, *v, start, end, end == OPEN_END) for start, end, v in replay(shown) if end > late or start >= late]
            # A version that ends on the day of the batch is the one that was in force before.
            want += [(*key, *v, start, end, False) for start, end, v in replay(shown) if start < late and end == late]
        seen += [(*key, *v, 0, date, time_of(n)) for date, n, v in shown]
    table = spark.createDataFrame(seen, SEEN)
    touched = table.filter(f"ingestion_timestamp = timestamp'{time_of(arrival)}'").select("a", "b")
    made = splice(touched, spark.createDataFrame(old, OLD), observations(table, SPEC, late), SPEC, late, ("surrogate_key",))
    got = rows_of(made.versions, "a", "b", "x", "y", "valid_from", "valid_to", "_open")
    assert list(map(repr, got)) == sorted(map(repr, want))
    kept = [r for r in made.versions.collect() if r.surrogate_key is not None]
    known = {r[4]: r for r in old}
    for r in kept:
        assert repr(tuple(known[r.surrogate_key][:4])) == repr((r.a, r.b, r.x, r.y)) and known[r.surrogate_key][5] == r.valid_from
    assert len({r.surrogate_key for r in kept}) == len(kept)


@pytest.mark.parametrize("seed", range(2))
def test_many_keys_equal_replay(spark, monkeypatch, seed):
    """Keys that are too many to broadcast, as those of a late batch that is larger than what came before."""
    monkeypatch.setattr(splicing, "FEW_KEYS", 0)
    test_equals_replay(spark, seed)


def test_rows_are_shuffled_once_by_key(spark, monkeypatch):
    """Beside the shuffle of observations by batch and key: versions and observations in one, and the keys themselves."""
    plans = []
    monkeypatch.setattr(splicing, "FEW_KEYS", 0)
    monkeypatch.setattr(splicing, "stage", lambda df: plans.append(plan_of(df)) or df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = spark.createDataFrame([("k", 1, "p", 1.0, 0, day(2), time_of(0))], SEEN)
        old = spark.createDataFrame([("k", 1, "p", 1.0, 7, day(2), OPEN_END)], OLD)
        splice(table.select("a", "b"), old, observations(table, SPEC, day(1)), SPEC, day(1), ("surrogate_key",))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    (plan,) = plans
    shuffles = [line for line in plan.splitlines() if re.match(r"\(\d+\) Exchange", line)]
    assert len(shuffles) == 3


def csv_file(path, *rows):
    with open(path, "w") as file:
        file.write(",".join(LOAN_COLUMNS) + "\n")
        for row in rows:
            row = {**LOAN, **row}
            file.write(",".join("" if row[c] is None else str(row[c]) for c in LOAN_COLUMNS) + "\n")
    return path


BATCHES = {
    0: [{"customer_id": "C1", "customer_name": "A"}, {"customer_id": "C2", "customer_name": "Z"}],
    1: [{"customer_id": "C1", "customer_name": "B"}, {"customer_id": "C3", "customer_name": "New"}],
    2: [{"customer_id": "C1", "customer_name": "A"}, {"customer_id": "C3", "customer_name": "New"}],
}


def run(spark, folder, order, scd_type, name):
    base = folder(name)
    for n in order:
        path = csv_file(folder(f"{name}-{n}.csv"), *BATCHES[n])
        jobs.run_batch(spark, path, base, day(n), scd_type, specs=[DIM_CUSTOMER])
    return base


@pytest.mark.parametrize("order", [(0, 2, 1), (2, 1, 0)])
def test_every_order_of_arrival_gives_the_same_versions(spark, folder, order):
    """The third batch shows of C1 what the first did: after it no version is written, but it counts."""
    names = ["customer_id", "customer_name", "effective_start_date", "effective_end_date", "is_current"]
    base = run(spark, folder, order, 2, "type2")
    dim = jobs.read_type2(spark, f"{base}/type2", DIM_CUSTOMER)
    assert rows_of(dim, *names) == [
        ("C1", "A", day(0), day(1), False), ("C1", "A", day(2), OPEN_END, True), ("C1", "B", day(1), day(2), False),
        ("C2", "Z", day(0), OPEN_END, True), ("C3", "New", day(1), OPEN_END, True),
    ]
    keys = [r.surrogate_key for r in dim.collect()]
    assert len(set(keys)) == len(keys)
    assert rows_of(jobs.read_type2_current(spark, f"{base}/type2", DIM_CUSTOMER), *names) == rows_of(dim.filter("is_current"), *names)


def test_late_batches_of_type4(spark, folder):
    base = run(spark, folder, (0, 2, 1), 4, "type4")
    current, history = jobs.read_type4(spark, f"{base}/type4", DIM_CUSTOMER)
    names = ["customer_id", "customer_name", "record_effective_date"]
    assert rows_of(current, *names) == [("C1", "A", day(2)), ("C2", "Z", day(0)), ("C3", "New", day(1))]
    assert rows_of(history, *names, "record_end_date") == [("C1", "A", day(0), day(1)), ("C1", "B", day(1), day(2))]


def test_surrogate_keys_of_versions_that_stay(spark, folder):
    base = run(spark, folder, (0, 2), 2, "stay")
    before = dict(rows_of(jobs.read_type2(spark, f"{base}/type2", DIM_CUSTOMER), "customer_id", "surrogate_key"))
    jobs.run_batch(spark, csv_file(folder("late.csv"), *BATCHES[1]), base, day(1), 2, specs=[DIM_CUSTOMER])
    dim = jobs.read_type2(spark, f"{base}/type2", DIM_CUSTOMER)
    first = dict(rows_of(dim.filter(f"effective_start_date = date'{day(0)}'"), "customer_id", "surrogate_key"))
    assert first == {k: before[k] for k in ("C1", "C2")}
    assert min(r.surrogate_key for r in dim.filter(f"effective_start_date = date'{day(1)}'").collect()) > max(before.values())


def test_a_late_batch_without_what_came_after_is_refused(spark, loans, folder):
    for merge, name in itertools.product((jobs.scd2, jobs.scd4), ("x",)):
        path = folder(f"{name}-{merge.__name__}")
        merge(spark, loans({}), path, day(5), [DIM_CUSTOMER])
        with pytest.raises(ValueError, match="lies before"):
            merge(spark, loans({"customer_name": "other"}), path, day(3), [DIM_CUSTOMER])
