"""Contiguous shards of least possible size over ordered groups that stay whole.

Groups of equal texts are put in the order of their smallest id. A capacity is feasible
if shards filled greedily in that order, each up to the capacity, are not more than
wanted. The smallest feasible capacity is found by binary search and the shards are cut
there: no contiguous partition has a smaller largest shard.

Only sums travel: the prefix sums of the groups are a written table sorted by position,
and one step of the greedy check is a lookup ("the last group end up to here") that the
table's statistics prune to a few row groups. A pass checks several midpoints at once,
so it does several levels of the binary search.

Defined cases: a null text has no bytes, counts as size 1, has the checksum of no bytes and is a
group of its own, apart from the empty text. A null id sorts first. Repeated rows are
rows of their own in one group. A group larger than the even share has a shard to
itself; the shards after the last group stay empty. An empty table gives no rows.
Columns of the input other than the two named do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimflow.operators.surrogate import number_densely, place_in_order
from dimflow.sources.staging import stage

#: Midpoints that one pass of the search checks: 2**5 - 1 are five levels.
MIDPOINTS = 31
_POSITION_BITS = 33


def measure(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, size, text_crc32, group): what the rest needs of each row."""
    text = F.col(text_col)
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        F.unhex(F.coalesce(F.sha2(text, 256), F.lit("00"))).alias("group"),
    )


def group_ends(rows: DataFrame) -> DataFrame:
    """One row per group, in order: group, first, bytes, and the sums of bytes and rows
    up to and with it."""
    groups = rows.groupBy("group").agg(
        F.min("doc_id").alias("first"),
        F.sum("size").alias("bytes"),
        F.count(F.lit(1)).alias("rows"),
    )
    placed = place_in_order(groups, [F.col("first").asc_nulls_first(), F.col("group")])
    placed = placed.withColumn("part", F.shiftright("_spot", _POSITION_BITS))
    # One row per partition is gathered, nothing else.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("part")
        .agg(F.sum("bytes").alias("b"), F.sum("rows").alias("r"))
        .select(
            "part",
            F.coalesce(F.sum("b").over(before), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("r").over(before), F.lit(0)).alias("rows_before"),
        )
    )
    up_to = Window.partitionBy("part").orderBy("_spot").rowsBetween(Window.unboundedPreceding, 0)
    ends = placed.join(F.broadcast(starts), "part").select(
        "group",
        "first",
        "bytes",
        (F.col("bytes_before") + F.sum("bytes").over(up_to)).alias("bytes_end"),
        (F.col("rows_before") + F.sum("rows").over(up_to)).alias("rows_end"),
    )
    return stage(ends)


class Search:
    """Looks up cuts in the table of group ends. Holds the totals and the cuts found."""

    def __init__(self, ends: DataFrame, shards: int):
        self.ends, self.shards = ends, shards
        row = ends.agg(F.max("bytes_end"), F.max("bytes")).first()
        self.total, self.largest = row[0] or 0, row[1] or 0
        self.cuts: dict[int, list[int]] = {}

    def fill(self, capacities: list[int]) -> None:
        """For each capacity, the ends of all shards but the last, filled greedily."""
        cuts: dict[int, list[int]] = {c: [] for c in capacities}
        at = dict.fromkeys(capacities, 0)
        for _ in range(self.shards - 1):
            going = [c for c in capacities if at[c] < self.total]
            if not going:
                break
            bounds = {c: at[c] + c for c in going}
            end = F.col("bytes_end")
            # A group end lies within the largest group's size below any bound.
            near = [end.between(b - self.largest, b) for b in bounds.values()]
            found = (
                self.ends.filter(_any(near))
                .agg(*[F.max(F.when(end <= b, end)).alias(f"c{c}") for c, b in bounds.items()])
                .first()
            )
            for c in going:
                at[c] = found[f"c{c}"]
                cuts[c].append(at[c])
        self.cuts.update(cuts)

    def feasible(self, capacity: int) -> bool:
        cuts = self.cuts[capacity]
        return self.total - (cuts[-1] if cuts else 0) <= capacity

    def smallest(self) -> list[int]:
        """The cuts of the smallest feasible capacity."""
        even = -(-self.total // self.shards)
        low, high = max(self.largest, even), even + self.largest  # high always suffices
        while low < high:
            step = max(1, -(-(high - low) // (MIDPOINTS + 1)))
            middles = list(range(low, high, step))[: MIDPOINTS + 1]
            self.fill(middles)
            good = [c for c in middles if self.feasible(c)]
            high = min(good, default=high)
            low = max([c for c in middles if c < high], default=low - 1) + 1
        if high not in self.cuts:
            self.fill([high])
        return [c for c in self.cuts[high] if c < self.total]


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for condition in conditions[1:]:
        out = out | condition
    return out


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 8) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Shards are numbered from 0, slots within a shard without gaps from 0, in the order of
    groups and of ids in a group. See the module for how special cases are treated.
    """
    rows = stage(measure(docs, id_col, text_col))
    ends = group_ends(rows)
    cuts = Search(ends, shards).smallest()
    end = F.col("bytes_end")
    number = F.lit(0)
    for cut in cuts:
        number = number + F.when(end > cut, 1).otherwise(0)
    starts = [0]
    if cuts:
        at = ends.filter(end.isin(cuts)).agg(
            *[F.max(F.when(end == c, F.col("rows_end"))).alias(f"r{c}") for c in cuts]
        )
        starts += list(at.first())
    start = F.element_at(F.array(*[F.lit(s).cast("bigint") for s in starts]), F.col("shard") + 1)
    # Group ends are one row per text, the rows of a large group are split by the join.
    joined = rows.join(
        ends.select("group", "first", number.cast("int").alias("shard")), "group"
    )
    placed = place_in_order(
        joined,
        [F.col("first").asc_nulls_first(), F.col("group"), F.col("doc_id").asc_nulls_first()],
    )
    none = docs.sparkSession.range(1).select(F.lit(-1))
    return number_densely(placed, none, "place").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("place") - start).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
