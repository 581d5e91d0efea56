"""Hard negatives by angular triangle filtering.

For an anchor and each of its positives (the rows of its label that score highest), the rows of other
labels whose score lies in a window of the positive's score, highest first. Scores are inner products of
vectors of whole numbers, so they are exact and ties are real.

Angles. Each row stores its angles to REFERENCES directions, chosen from a bounded sample (`SAMPLE` rows; results do
not depend on it). The angle between two vectors is at least the difference and at most the sum of their angles to
any direction; over all directions this gives an interval of the cosine, and times the norms an interval
of the score, widened by more than rounding can cost. A pair is scored only if its interval meets a window that
is still open: for positives one from the least of the best so far up, for negatives one from the least
of those found so far up to the window's end.

Anchors are taken in blocks of BLOCK, numbered over the whole table; a block, whose size is bounded, is
broadcast, and all rows stream past it, so rows are never shuffled or copied. Each task keeps the best of
what it has seen, at most `per_window` rows per anchor and window, and Spark ranks what the tasks have found. The work grows
with anchors times rows, as the search is defined; the angles cut it only as far as the vectors are
structured (see the README for figures).

Defined cases: rows with a null id, label or vector, an empty vector, or a null or non-finite component take no part,
nor do those whose vector of whole numbers is 2**31 long or longer (their scores would pass 64 bits). Vectors
of different lengths do not meet. A zero vector takes part. Repeated rows are rows of their own: one may be
the other's positive. Ties go to the smaller id, then to any of the equal rows. A positive with a score of 0
has the window 0 to 0, one with a negative score none. An empty table gives no rows. Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimflow.operators.surrogate import number_densely, place_in_order
from dimflow.sources.staging import stage

SAMPLE = 2_000
REFERENCES = 12
#: Anchors that are broadcast at a time, and the pairs of anchors and rows that are compared at a time.
BLOCK = 4_096
SLICE = 256
STEP = 1_024
SCALE = 256
#: Angles are wrong by less than this, also where the arc cosine is steep.
SLACK = 1e-6
_EXACT = 2.0**53
_LONGEST = 2.0**31

ROWS = "uid bigint, vec_id bigint, label int, anchor boolean, vector array<int>, norm double, angles array<double>"
FOUND = "anchor bigint, slot int, score bigint, uid bigint, vec_id bigint"


def directions(units: np.ndarray, count: int = REFERENCES) -> np.ndarray:
    """Directions that lie far apart: the first, then each time the one farthest from all chosen."""
    if not len(units):
        return units
    chosen = [units[0]]
    nearest = units @ units[0]
    while len(chosen) < min(count, len(units)):
        chosen.append(units[int(np.argmin(nearest))])
        nearest = np.maximum(nearest, units @ chosen[-1])
    return np.stack(chosen)


def angles_to(vectors: np.ndarray, norms: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angles to the references. That of a zero vector does not matter: its bounds are multiplied by 0."""
    units = vectors / np.where(norms > 0, norms, 1)[:, None]
    return np.arccos(np.clip(units @ references.T, -1, 1))


def score_bounds(angles_a: np.ndarray, norms_a: np.ndarray, angles_b: np.ndarray, norms_b: np.ndarray):
    """(least, greatest) possible score of every pair."""
    low = np.zeros((len(norms_a), len(norms_b)))
    high = np.full_like(low, np.pi)
    for k in range(angles_a.shape[1]):
        a, b = angles_a[:, k, None], angles_b[None, :, k]
        np.maximum(low, np.abs(a - b), out=low)
        both = a + b
        np.minimum(high, both, out=high)
        np.minimum(high, 2 * np.pi - both, out=high)
    size = norms_a[:, None] * norms_b[None, :]
    margin = 1 + 1e-9 * size
    return (
        np.cos(np.minimum(high + SLACK, np.pi)) * size - margin,
        np.cos(np.maximum(low - SLACK, 0)) * size + margin,
    )


def exact_scores(a: np.ndarray, norms_a: np.ndarray, b: np.ndarray, norms_b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers: in doubles while no sum can pass 2**53, else in 64-bit integers."""
    if not len(a) or not len(b) or norms_a.max() * norms_b.max() < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _lists(column: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, values) of a column of lists."""
    return np.diff(column.offsets.to_numpy()), column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)


def _by_length(lengths: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, places of their values) of each length."""
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield int(length), rows, starts[rows][:, None] + np.arange(length)


def _prepared(references: dict[int, np.ndarray]) -> Callable:
    """Rows with a vector of whole numbers, its norm and its angles; rows that take no part are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(4)
            lengths, values = _lists(vectors, np.float64)
            parts = []
            for length, rows, at in _by_length(lengths):
                if length == 0:
                    continue
                # Nulls have become NaN.
                whole = np.floor(SCALE * values[at])
                finite = np.isfinite(values[at]).all(1)
                norms = np.sqrt((np.where(finite[:, None], whole, 0) ** 2).sum(1))
                good = finite & (norms < _LONGEST)
                rows, whole, norms = rows[good], whole[good], norms[good]
                known = references.get(length, np.zeros((0, length)))
                angles = angles_to(whole, norms, known)
                flat = pa.array(whole.astype(np.int32).ravel())
                made = [batch.column(k).take(pa.array(rows)) for k in range(4)]
                made.append(pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * length), flat))
                made.append(pa.array(norms))
                steps = np.arange(len(rows) + 1, dtype=np.int32) * len(known)
                made.append(pa.ListArray.from_arrays(pa.array(steps), pa.array(angles.ravel())))
                parts.append(pa.RecordBatch.from_arrays(made, names=["uid", "vec_id", "label", "anchor", "vector", "norm", "angles"]))
            yield from parts

    return run


class _Best:
    """The ``keep`` best (score, vec_id, uid) of every anchor and slot."""

    def __init__(self, anchors: int, slots: int, keep: int):
        self.keep, self.slots = keep, slots
        self.full_from = np.full((anchors, slots), np.iinfo(np.int64).min)
        self.rows = np.zeros((0, 5), np.int64)  # anchor, slot, score, uid, vec_id

    def add(self, rows: np.ndarray) -> None:
        if not len(rows):
            return
        every = np.concatenate([self.rows, rows])
        every = every[np.lexsort((every[:, 3], every[:, 4], -every[:, 2], every[:, 1], every[:, 0]))]
        group = every[:, 0] * self.slots + every[:, 1]
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        place = np.arange(len(every)) - np.repeat(first, np.diff(np.append(first, len(every))))
        self.rows = every[place < self.keep]
        last = every[place == self.keep - 1]
        self.full_from[last[:, 0], last[:, 1]] = last[:, 2]


def _search(anchors: dict, same_label: bool, keep: int, low: np.ndarray, high: np.ndarray) -> Callable:
    """The best rows for each anchor and slot whose score is from ``low`` to ``high`` (anchors x slots)."""
    slots = low.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(anchors["uid"]), slots, keep)

        def compare(of: np.ndarray, them: dict) -> None:
            """Anchors ``of`` (numbers) with rows."""
            # ``low`` is over ``high`` for slots that are not open.
            mine = anchors["label"][of][:, None] == them["label"][None, :]
            wanted = mine & (anchors["uid"][of][:, None] != them["uid"][None, :]) if same_label else ~mine
            if not wanted.any():
                return
            vector, angles = anchors["vectors"][len(them["vectors"][0])]
            place = anchors["place"][of]
            least, most = score_bounds(angles[place], anchors["norm"][of], them["angles"], them["norm"])
            floor = np.maximum(low[of], best.full_from[of])
            meets = np.zeros_like(wanted)
            for k in range(slots):
                open_ = floor[:, k] <= high[of, k]
                meets |= open_[:, None] & (most >= floor[:, k, None]) & (least <= high[of, k, None])
            wanted &= meets
            some, columns = np.flatnonzero(wanted.any(1)), np.flatnonzero(wanted.any(0))
            if not len(some):
                return
            scores = exact_scores(vector[place[some]], anchors["norm"][of][some], them["vectors"][columns], them["norm"][columns])
            wanted, uid, vec_id = wanted[np.ix_(some, columns)], them["uid"][columns], them["vec_id"][columns]
            for k in range(slots):
                floors, tops = floor[some, k, None], high[of[some], k, None]
                at, row = np.nonzero(wanted & (scores >= floors) & (scores <= tops))
                best.add(np.stack([of[some][at], np.full(len(at), k), scores[at, row], uid[row], vec_id[row]], 1))

        for batch in batches:
            uid, vec_id, label = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            norm = batch.column(4).to_numpy(zero_copy_only=False)
            lengths, values = _lists(batch.column(3), np.int32)
            _, angles = _lists(batch.column(5), np.float64)
            widths, _ = _lists(batch.column(5), np.float64)
            angle_starts = np.cumsum(widths) - widths
            for length, rows, at in _by_length(lengths):
                ours = anchors["of_length"].get(length)
                if ours is None:
                    continue
                width = int(widths[rows[0]])
                for begin in range(0, len(rows), STEP):
                    part = rows[begin : begin + STEP]
                    them = {
                        "uid": uid[part], "vec_id": vec_id[part], "label": label[part], "norm": norm[part],
                        "vectors": values[at[begin : begin + STEP]],
                        "angles": angles[angle_starts[part][:, None] + np.arange(width)],
                    }
                    for i in range(0, len(ours), SLICE):
                        compare(ours[i : i + SLICE], them)
        rows = best.rows
        columns = [pa.array(anchors["uid"][rows[:, 0]]), pa.array(rows[:, 1].astype(np.int32)), pa.array(rows[:, 2]),
                   pa.array(rows[:, 3]), pa.array(rows[:, 4])]
        yield pa.RecordBatch.from_arrays(columns, names=["anchor", "slot", "score", "uid", "vec_id"])

    return run


def _block_of(rows: DataFrame) -> dict:
    """A block of anchors as arrays: at most BLOCK rows."""
    got = rows.toArrow()
    lengths, values = _lists(got["vector"].combine_chunks(), np.int32)
    widths, angles = _lists(got["angles"].combine_chunks(), np.float64)
    angle_starts = np.cumsum(widths) - widths
    out = {name: got[name].to_numpy() for name in ("uid", "vec_id", "label", "norm")}
    out |= {"vectors": {}, "of_length": {}, "place": np.zeros(len(lengths), np.int64)}
    for length, of, at in _by_length(lengths):
        out["vectors"][length] = (values[at], angles[angle_starts[of][:, None] + np.arange(widths[of[0]])])
        out["of_length"][length] = of
        out["place"][of] = np.arange(len(of))
    return out


def _best(found: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` best of what the tasks have found, ranked from 1."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id", "uid")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def mine(
    rows: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    label: Column | None = None,
    positives: int = 5,
    per_window: int = 10,
    window: tuple[int, int] = (30, 90),
    block: int = BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where ``anchor``.

    ``label`` replaces the label column; ``window`` is in per cent of the positive's score.
    """
    spark = rows.sparkSession
    label = F.col(label_col) if label is None else label
    given = rows.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(id_col).cast("bigint").alias("vec_id"),
        label.cast("int").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.transform(F.col(vector_col), lambda x: F.coalesce(x.cast("double"), F.lit(float("nan")))).alias("vector"),
    ).filter("vec_id is not null and label is not null and vector is not null")
    sample = given.orderBy(F.xxhash64("vec_id"), "uid").limit(SAMPLE).select("vector")
    by_length: dict[int, list] = {}
    for vector in sample.toArrow()["vector"].to_pylist():
        whole = np.floor(SCALE * np.asarray(vector, np.float64))
        size = np.sqrt((whole**2).sum())
        if len(vector) and np.isfinite(size) and 0 < size < _LONGEST:
            by_length.setdefault(len(vector), []).append(whole / size)
    references = {length: directions(np.stack(units)) for length, units in by_length.items()}
    table = stage(given.mapInArrow(_prepared(references), ROWS))

    none = spark.range(1).select(F.lit(0).cast("bigint").alias("n"))
    placed = place_in_order(table.filter("anchor").drop("anchor"), ["vec_id", "uid"])
    anchors = stage(number_densely(placed, none, "at"))
    total = anchors.count()
    scanned = table.select("uid", "vec_id", "label", "vector", "norm", "angles")
    results = []
    for start in range(0, total, block):
        inside = F.col("at").between(start + 1, start + block)
        arrays = _block_of(anchors.filter(inside).drop("at").orderBy("vec_id", "uid"))
        count = len(arrays["uid"])
        least = np.full((count, 1), np.iinfo(np.int64).min + 1)
        search = _search(arrays, True, positives, least, np.full((count, 1), np.iinfo(np.int64).max))
        best = stage(_best(scanned.mapInArrow(search, FOUND), positives))
        low, high = np.full((count, positives), 1), np.full((count, positives), 0)
        order = np.argsort(arrays["uid"])
        for one in best.select("anchor", "rank", "score").collect():  # a block's positives
            at = order[np.searchsorted(arrays["uid"], one.anchor, sorter=order)]
            low[at, one["rank"] - 1] = -(-window[0] * one.score // 100)
            high[at, one["rank"] - 1] = window[1] * one.score // 100
        search = _search(arrays, False, per_window, low, high)
        negative = _best(scanned.mapInArrow(search, FOUND), per_window)
        positive = best.select("anchor", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"),
                               F.col("score").alias("positive_score"))
        names = anchors.filter(inside).select(F.col("uid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
        joined = negative.join(positive, ["anchor", "slot"]).join(names, "anchor")
        results.append(
            stage(
                joined.select(
                    "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score"),
                )
            )
        )
    if not results:
        return spark.createDataFrame(
            [], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
        )
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out
