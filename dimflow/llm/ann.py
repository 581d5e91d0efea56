"""Approximate nearest neighbours by multi-index hashing.

Vectors get binary codes: centred, turned by learnt rotations (principal axes, then iterative
quantisation, from as many random starts as the bits need), one bit per axis for its sign. For a largest
inner product, vectors are first given one more component that makes all norms equal; queries have 0 there.

A code is split into substrings, and each substring has an index of its own. By the pigeonhole principle a
code within Hamming radius r of another differs from it in some substring j by at most t_j bits, for any t_j whose
sum is r - substrings + 1; where t_j is -1, substring j is not probed. Probing all values within t_j in
each index finds every code within r. Those are ranked by exact inner products in double precision.

The rotations and the radius are fitted on the FIT_ROWS vectors with the least hash of their id: the radius
is the distance within which FIT_SHARE of the true neighbours lie, counted over distinct vectors, so that a vector with many
copies does not narrow it. Every vector is indexed.

Queries are taken in blocks of at most BLOCK_BYTES, numbered over the whole table. A block is broadcast, and all rows stream
past it: each batch of rows is indexed and probed, and only a task's best for each query are shuffled, never vectors. The few
queries that find fewer than ``k`` rows in all ask again with a wider radius, until they have enough or all.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor
do rows without id or with another length than most. Equal scores are ordered by id. Repeated
rows are candidates each; a query row's own id is never its neighbour. An empty table gives
no rows. Columns other than the two named do not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimflow.operators.surrogate import number_densely, place_in_order
from dimflow.sources.staging import stage

FIT_ROWS = 8_000
FIT_QUERIES = 400
FIT_SHARE = 0.98
BITS, WIDTH = 512, 8
SUBSTRINGS = BITS // WIDTH
#: Vectors of the queries that are broadcast at a time, and queries and rows that are probed at a time.
BLOCK_BYTES = 8_000_000
QUERIES, ROWS = 256, 16_384


@dataclass
class Coder:
    norm: float
    centre: np.ndarray
    rotation: np.ndarray
    radius: int = BITS

    def codes(self, x: np.ndarray, query: bool) -> np.ndarray:
        """One row of BITS / 8 bytes for each vector."""
        rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.norm**2 - (x * x).sum(axis=1), 0))
        z = (np.column_stack([x, rest]) - self.centre) @ self.rotation
        return np.packbits(z > 0, axis=1, bitorder="little")


def words(codes: np.ndarray) -> np.ndarray:
    """Codes as words of 64 bits, the first words of all codes before the second ones."""
    return np.ascontiguousarray(np.moveaxis(np.ascontiguousarray(codes).view(np.uint64), -1, 0))


def apart(some: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Bits by which codes, given as words, differ from others."""
    return np.bitwise_count(some ^ other).sum(axis=0, dtype=np.int16)


def fit(x: np.ndarray, norm: float, k: int, seed: int = 3) -> Coder:
    """The rotations for a sample of vectors, and the radius in which their ``k`` nearest are."""
    rng = np.random.default_rng(seed)
    rest = np.sqrt(np.maximum(norm**2 - (x * x).sum(axis=1), 0))
    whole = np.column_stack([x, rest])
    centre = whole.mean(axis=0)
    y = whole - centre
    _, axes = np.linalg.eigh(y.T @ y)
    axes = axes[:, ::-1][:, :BITS]
    v = y @ axes
    turns = []
    while sum(t.shape[1] for t in turns) < BITS:  # short vectors: several rotations
        r, _ = np.linalg.qr(rng.normal(size=(axes.shape[1], axes.shape[1])))
        for _ in range(30):
            u, _, w = np.linalg.svd(np.where(v @ r > 0, 1.0, -1.0).T @ v)
            r = (u @ w).T
        turns.append(axes @ r)
    coder = Coder(norm, centre, np.column_stack(turns)[:, :BITS])
    _, first = np.unique(x, axis=0, return_index=True)
    x = x[np.sort(first)]
    chosen = x[:FIT_QUERIES]
    score = chosen @ x.T
    score[np.arange(len(chosen)), np.arange(len(chosen))] = -np.inf
    near = np.argsort(-score, axis=1)[:, : min(k, len(x) - 1)]
    bits = apart(words(coder.codes(x, False))[:, near], words(coder.codes(chosen, True))[:, :, None])
    if bits.size:
        coder.radius = int(np.quantile(bits, FIT_SHARE, method="higher"))
    return coder


class Index:
    """The substring indexes of a batch: for each substring and value, the rows as a bitset."""

    def __init__(self, codes: np.ndarray):
        self.words, self.n = words(codes), len(codes)
        values = np.arange(1 << WIDTH)[:, None]
        self.buckets = [np.packbits(values == part, axis=1) for part in codes.T]
        self.balls: dict[tuple[int, int], np.ndarray] = {}

    def _ball(self, substring: int, within: int) -> np.ndarray:
        """For each value of a substring, the rows that are within so many bits of it."""
        if within == 0:
            return self.buckets[substring]
        if (substring, within) not in self.balls:
            nearer = self._ball(substring, within - 1)
            ball = nearer.copy()
            for bit in range(WIDTH):
                ball |= nearer[np.arange(1 << WIDTH) ^ (1 << bit)]
            self.balls[substring, within] = ball
        return self.balls[substring, within]

    def probe(self, codes: np.ndarray, radius: int) -> np.ndarray:
        """For each code, as a bitset, the rows that any of the substring indexes gives for the radius."""
        found = np.zeros((len(codes), -(-self.n // 8)), np.uint8)
        each, over = divmod(min(radius, BITS) + 1, SUBSTRINGS)
        for j in range(SUBSTRINGS):
            allowed = each - 1 + (j < over)
            if allowed >= 0:
                found |= self._ball(j, min(allowed, WIDTH))[codes[:, j]]
        return found

    def within(self, codes: np.ndarray, radius: int) -> Iterator[np.ndarray]:
        """For each code all rows whose code is within the radius, in order."""
        for code, found in zip(words(codes).T, self.probe(codes, radius)):
            rows = np.flatnonzero(np.unpackbits(found, count=self.n))
            yield rows[apart(np.take(self.words, rows, axis=1), code[:, None]) <= radius]


@dataclass
class Queries:
    """A block of queries: at most BLOCK_BYTES of vectors."""

    row: np.ndarray
    vec_id: np.ndarray
    vec: np.ndarray
    codes: np.ndarray

    def take(self, at: np.ndarray) -> Queries:
        return Queries(self.row[at], self.vec_id[at], self.vec[at], self.codes[at])


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def search_batches(queries: Queries, coder: Coder, radius: int, k: int) -> Callable:
    """For mapInArrow over (vec_id, vec): each query's ``k`` best of the rows of a task."""
    width = queries.vec.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # query: scores, ids, both in order
        id_type = pa.int64()
        for batch in batches:
            id_type = batch.column(0).type
            for start in range(0, len(batch), ROWS):
                part = batch.slice(start, ROWS)
                ids, x = part.column(0).to_numpy(zero_copy_only=False), _matrix(part.column(1), width)
                index = Index(coder.codes(x, False))
                for first in range(0, len(queries.row), QUERIES):
                    codes = queries.codes[first : first + QUERIES]
                    for at, rows in enumerate(index.within(codes, radius), first):
                        rows = rows[ids[rows] != queries.vec_id[at]]
                        score, their = (x[rows] * queries.vec[at]).sum(axis=1), ids[rows]
                        if at in best:
                            kept, kept_ids = best[at]
                            if len(kept) == k:
                                hopeful = score >= kept[-1]
                                score, their = score[hopeful], their[hopeful]
                            score, their = np.concatenate([kept, score]), np.concatenate([kept_ids, their])
                        if len(score):
                            order = np.argsort(their, kind="stable")
                            order = order[np.argsort(-score[order], kind="stable")][:k]
                            best[at] = score[order], their[order]
        if best:
            counts = [len(score) for score, _ in best.values()]
            asked = np.repeat(list(best), counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(queries.row[asked]),
                    pa.array(queries.vec_id[asked], id_type),
                    pa.array(np.concatenate([their for _, their in best.values()]), id_type),
                    pa.array(np.concatenate([score for score, _ in best.values()])),
                ],
                names=["row", "query_id", "vec_id", "score"],
            )

    return run


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(row, vec_id, vec) of the vectors that take part."""
    vec = F.col(vec_col).cast("array<double>")
    finite = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    nonzero = F.exists(vec, lambda v: v != 0)
    good = vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & finite & nonzero)
    good = stage(good.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("vec_id"), vec.alias("vec")))
    sizes = good.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), F.desc("size"))
    most = sizes.first()
    return good.filter(F.size("vec") == (most["size"] if most else 0))


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding",
            k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``is_query`` (of `vec_id`) holds, its ``k``
    nearest, by largest inner product."""
    good = usable(vectors, id_col, vec_col)
    spark = good.sparkSession
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, v: s + v * v))
    rows, asked, longest = good.agg(F.count(F.lit(1)), F.count_if(is_query), F.max(norm)).first()
    id_type = good.schema["vec_id"].dataType.simpleString()
    if rows == 0 or asked == 0:
        return spark.createDataFrame([], f"query_id {id_type}, rank int, vec_id {id_type}, score double")
    # At most FIT_ROWS rows.
    sample = good.orderBy(F.xxhash64("vec_id"), "vec_id", "row").limit(FIT_ROWS).select("vec").toArrow()
    x = np.array(sample["vec"].to_pylist(), float)
    coder = fit(x, longest, k)
    scanned = good.select("vec_id", "vec")

    def search(queries: Queries, radius: int) -> DataFrame:
        """(row, query_id, vec_id, score, rank): each query's best of all rows."""
        each = scanned.mapInArrow(
            search_batches(queries, coder, radius, k), f"row long, query_id {id_type}, vec_id {id_type}, score double"
        )
        order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
        return stage(each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k))

    none = spark.range(1).select(F.lit(0).cast("bigint").alias("n"))
    placed = place_in_order(good.filter(is_query), ["vec_id", "row"])
    numbered = stage(number_densely(placed, none, "at"))
    block = max(1, BLOCK_BYTES // (8 * x.shape[1]))
    results = []
    for start in range(0, asked, block):
        # At most BLOCK_BYTES of vectors.
        got = numbered.filter(F.col("at").between(start + 1, start + block)).select("row", "vec_id", "vec").toArrow()
        vec = np.array(got["vec"].to_pylist(), float)
        queries = Queries(got["row"].to_numpy(), got["vec_id"].to_numpy(), vec, coder.codes(vec, True))
        radius = coder.radius if rows - 1 > k else BITS
        found = search(queries, radius)
        while radius < BITS:
            full = found.filter(F.col("rank") == min(k, rows - 1)).select("row").toArrow()["row"].to_numpy()
            queries = queries.take(np.flatnonzero(~np.isin(queries.row, full)))
            if not len(queries.row):
                break
            radius = min(BITS, radius + BITS // 4)
            again = search(queries, radius)
            found = found.join(again.select("row").distinct(), "row", "left_anti").unionByName(again)
        results.append(found.select("query_id", "rank", "vec_id", "score"))
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out
