"""Near copies by SimHash, found in BK-trees.

A text's fingerprint has 64 bits; a bit is 1 if it is set in over half the hashes of the
text's shingles. Fingerprints are dealt out to shards, and a shard's fingerprints form a
BK-tree: a node's children are keyed by their Hamming distance to it, and a search for all
within a radius follows only the edges that differ from the query's distance by no more
than the radius. A shard's tree is sent to the task that has its queries. A broadcast
of all trees would grow with the data.

Shards. For exact search within radius r, 64 bits are cut into more blocks than r: two
fingerprints within r agree on all but r blocks, so each choice of agreeing blocks is a table of
shards (r = 3, four blocks: four tables with keys of 16 bits; five: ten tables with keys of 25 or 26 bits). The number of
blocks follows the number of fingerprints, so that a shard's tree has some hundred nodes at most on average; any number
finds the same.

A shard of more than LIMIT members is cut into blocks, and each pair of blocks is a task of
its own: a tree of one, queried by the other. No link is lost and no task grows. Tasks join
what they have linked and write one row per member, not pairs; components of these rows
are found by Spark.

Defined cases: a null text is an empty one; texts without words have fingerprint 0 and link like
any other. Texts with fewer words than a shingle are one shingle. Repeated rows are rows
of their own in one component. A null id counts after all others and gives a null
component only where no member has an id. An empty table gives no rows. Texts are read whole.
Columns other than the two named do not matter.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.llm.components import components
from dimflow.sources.staging import stage, stage_alone

#: Members of a shard that one tree holds, on average, before it is cut into blocks.
LIMIT = 256
#: Pairs of query and node that a search has open at once.
OPEN_PAIRS = 1 << 20
SEED = 42


def shingle_hashes(text: str | None, words: int, step: int = 1 << 18) -> Iterator[np.ndarray]:
    """XXH64 of the shingles of ``words`` words, in parts. No words: nothing."""
    found = (text or "").encode("utf-8", "replace").lower().split()
    if not found:
        return
    joined = b" ".join(found)
    ends = list(itertools.accumulate(len(w) + 1 for w in found))
    n = max(1, len(found) - words + 1)
    starts, stops = [0, *ends[: n - 1]], [e - 1 for e in ends[min(words, len(found)) - 1 :]]
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, step):
        part = [digest(joined[s:e], SEED) for s, e in zip(starts[at : at + step], stops[at : at + step])]
        yield np.array(part, np.uint64)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprint_of(counts: np.ndarray, total: int) -> np.int64:
    return np.packbits(counts * 2 > total, bitorder="little").view(np.int64)[0]


def fingerprint(text: str | None, words: int = 3) -> int:
    """The signed 64-bit fingerprint of a text."""
    counts, total = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, words):
        counts += bit_counts(hashes)
        total += len(hashes)
    return int(fingerprint_of(counts, total))


def with_fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(doc_id, fp) of every row."""

    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t if isinstance(t, str) else None, words) for t in texts], dtype="int64")

    return docs.select(F.col(id_col).alias("doc_id"), prints(F.col(text_col)).alias("fp"))


def hex16(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# Shards


def block_keys(fp: Column, radius: int, blocks: int) -> Column:
    """An array with the key of each shard that may hold neighbours within the radius."""
    edges = [64 * k // blocks for k in range(blocks + 1)]
    keys = []
    for table, agree in enumerate(itertools.combinations(range(blocks), blocks - radius)):
        key = F.lit(table).cast("bigint")
        for k in agree:
            width = edges[k + 1] - edges[k]
            part = F.shiftrightunsigned(fp, edges[k]).bitwiseAND(F.lit((1 << width) - 1))
            key = F.shiftleft(key, width).bitwiseOR(part)
        keys.append(key)
    return F.array(*keys)


def deal(members: DataFrame, node: str, limit: int) -> DataFrame:
    """Rows (key, node, ...) of shards with two members or more, with the pair of blocks
    (lo, hi) that each copy of a row is for and the row's own `block`."""
    counts = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    block = F.pmod(F.xxhash64(F.col(node), F.lit(1)), F.col("blocks")).cast("int")
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    return (
        members.join(stage(counts), "key")
        .withColumn("blocks", F.ceil(F.col("n") / limit).cast("int"))
        .withColumn("block", block)
        .withColumn("other", F.explode(others))
        .withColumn("lo", F.least("block", "other"))
        .withColumn("hi", F.greatest("block", "other"))
        .drop("n", "blocks", "other")
    )


# BK-trees, all of a chunk's shards at once


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


def build_trees(fps: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of BK-trees. ``root``: the root of each point's tree, which is its own for a root; -1: in no tree.

    Returns the edges' keys (parent * 128 + distance), sorted, and their children. Equal
    fingerprints are children at distance 0.
    """
    rest = np.flatnonzero((root >= 0) & (root != np.arange(len(fps))))
    parent, keys, children = root[rest], [], []
    while len(rest):
        key = parent * 128 + distance(fps[rest], fps[parent])
        edge, first, which = np.unique(key, return_index=True, return_inverse=True)
        child = rest[first]
        keys.append(edge)
        children.append(child)
        down = child[which]
        below = down != rest
        rest, parent = rest[below], down[below]
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    key, child = np.concatenate(keys), np.concatenate(children)
    order = np.argsort(key, kind="stable")
    return key[order], child[order]


def search(fps, query, root, tree, radius) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, point) within the radius: each query searches the tree of ``root``."""
    key, child = tree
    while len(query):
        d = distance(fps[query], fps[root])
        hit = d <= radius
        yield query[hit], root[hit]
        low = np.searchsorted(key, root * 128 + np.maximum(d - radius, 0))
        high = np.searchsorted(key, root * 128 + d + radius, "right")
        n = high - low
        at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        query, root = np.repeat(query, n), child[at]


def merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join in ``root`` (each point's least member of its class) the classes of a and b."""
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up


def link_chunk(chunk: pd.DataFrame, radius: int) -> np.ndarray:
    """The class (least row) of each row of a chunk of whole shards, sorted by shard."""
    fps = chunk["fp"].to_numpy(np.int64).view(np.uint64)
    n = len(fps)
    shard = np.zeros(n, np.int64)
    for c in ("key", "lo", "hi"):
        v = chunk[c].to_numpy()
        shard[1:] |= v[1:] != v[:-1]
    shard = np.cumsum(shard)
    block, lo, hi = (chunk[c].to_numpy() for c in ("block", "lo", "hi"))
    in_tree, asks = block == lo, block == hi
    rows = np.arange(n)
    tree_rows = np.flatnonzero(in_tree)
    roots = np.full(shard[-1] + 1, -1, np.int64)
    roots[shard[tree_rows][::-1]] = tree_rows[::-1]  # the first row of each shard's tree
    root = np.where(in_tree, roots[shard], -1)
    tree = build_trees(fps, root)
    sizes = np.bincount(shard[tree_rows], minlength=len(roots))
    asking = rows[asks & (roots[shard] >= 0)]
    classes = np.arange(n)
    # Slices of queries whose trees have OPEN_PAIRS nodes at most, or one query.
    cost = np.cumsum(sizes[shard[asking]]) // OPEN_PAIRS
    for part in np.split(asking, np.flatnonzero(np.diff(cost)) + 1):
        for q, p in search(fps, part, roots[shard[part]], tree, radius):
            other = q != p
            merge(classes, q[other], p[other])
    return classes


def whole_shards(batches: Iterator[pa.RecordBatch], least: int = 50_000) -> Iterator[pd.DataFrame]:
    """Chunks of sorted batches that end where a shard ends."""
    held, rows = [], 0
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        rows += len(batch)
        if rows < least:
            continue
        table = pa.Table.from_batches(held)
        ids = [table.column(c).to_numpy() for c in ("key", "lo", "hi")]
        same = np.logical_and.reduce([v == v[-1] for v in ids])
        cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield table.slice(0, cut).to_pandas()
        held = table.slice(cut).combine_chunks().to_batches()
        rows = sum(map(len, held))
    if held:
        yield pa.Table.from_batches(held).to_pandas()


def links(dealt: DataFrame, node: str, radius: int) -> DataFrame:
    """Links (a, b) that join, in each shard, what is within the radius: one per member at most."""
    sorted_shards = dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", node)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in whole_shards(batches):
            classes = link_chunk(chunk, radius)
            names = chunk[node].to_numpy(np.int64)
            linked = np.flatnonzero(classes != np.arange(len(classes)))
            yield pa.RecordBatch.from_arrays([pa.array(names[linked]), pa.array(names[classes[linked]])], ["a", "b"])

    return sorted_shards.mapInArrow(find, "a long, b long").filter("a != b").distinct()


# Exact search within a radius


def blocks_for(fingerprints: int, radius: int, limit: int = LIMIT) -> int:
    """The least number of blocks whose shards hold up to ``limit`` of so many fingerprints on average."""
    blocks = radius + 1
    while blocks < 16 and fingerprints > limit << (64 * (blocks - radius) // blocks):
        blocks += 1
    return blocks


def groups(rows: DataFrame, radius: int, blocks: int | None = None, limit: int = LIMIT) -> DataFrame:
    """(fp, root, component_id) of the fingerprints of ``rows`` (doc_id, fp): the least fingerprint and the least
    doc_id of its component."""
    prints = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    blocks = blocks or blocks_for(prints.count(), radius, limit)
    members = prints.select(F.explode(block_keys(F.col("fp"), radius, blocks)).alias("key"), "fp")
    found = components(links(deal(members, "fp", limit), "fp", radius))
    found = stage(prints.join(found, prints["fp"] == found["node"]).select("fp", "root", "first"))
    least = stage(found.groupBy("root").agg(F.min("first").alias("least")))
    linked = found.join(least, "root").select("fp", "root", "least")
    return prints.join(linked, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("least", "first").alias("component_id")
    )


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
               radius: int = 3, blocks: int | None = None, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id (the least doc_id reachable by
    fingerprints that differ in at most ``radius`` bits)."""
    rows = stage(with_fingerprints(docs, id_col, text_col, words))
    # One row per fingerprint; a fingerprint's many documents are split by the join.
    of_print = stage(groups(rows, radius, blocks, limit).select("fp", "component_id"))
    return rows.join(of_print, "fp").select("doc_id", hex16("fp").alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                    radius: int = 3) -> DataFrame:
    """``docs`` with one row of each component: the one with the least id (of several with that id, one).

    Texts are read once for the fingerprints and once for the result, and not written: rows are known by
    their ids. Only rows whose id is null or repeated are written with numbers of their own.
    """
    spark = docs.sparkSession
    id_, row = (_unused(name, docs) for name in ("_id", "_row"))
    found = stage_alone(spark, lambda: _with_groups(docs, id_col, text_col, words, radius))
    often = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 or doc_id is null")
    often = stage(often.select(F.col("doc_id").alias(id_)))
    once = found.filter("doc_id = component_id").select(F.col("doc_id").alias(id_)).join(often, id_, "left_anti")
    kept = docs.join(once, F.col(id_col) == F.col(id_), "left_semi")
    if often.isEmpty():
        return kept
    unclear = docs.join(often, F.col(id_col).eqNullSafe(F.col(id_)), "left_semi")
    unclear = stage(unclear.withColumn(row, F.monotonically_increasing_id()))
    prints = with_fingerprints(unclear, row, text_col, words).select(F.col("doc_id").alias(row), "fp")
    of_print = found.select("fp", "root", "component_id").distinct()
    named = prints.join(unclear.select(row, F.col(id_col).alias(id_)), row).join(of_print, "fp")
    first = named.filter(F.col(id_).eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min(row).alias(row))
    return kept.unionByName(unclear.join(stage(first.select(row)), row, "left_semi").drop(row))


def _unused(name: str, df: DataFrame) -> str:
    """A column name that a table does not have."""
    while name in df.columns:
        name += "_"
    return name


def _with_groups(docs: DataFrame, id_col: str, text_col: str, words: int, radius: int) -> DataFrame:
    rows = stage(with_fingerprints(docs, id_col, text_col, words))
    return rows.join(stage(groups(rows, radius)), "fp").select("doc_id", "fp", "root", "component_id")
