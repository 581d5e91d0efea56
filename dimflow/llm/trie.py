"""The prefix trie of conversations, as burst tries.

A conversation is a sequence of turns; a node of the trie is a distinct sequence of first turns, and its
members are the conversations that begin with it. Conversations that are equal throughout are one
sequence with a number of copies, so a hot conversation is one row after a map-side combine.

Containers. A container holds the rest (suffixes) of all sequences that share the turns up to its head,
in rows, one per turn. All start in the container of the root. A container with more than one sequence and
more turns than CAPACITY bursts by its next turn id: where its sequences first part, each next turn
gets a container of its own. The shared turns before that are a chain of nodes, the head, of any
length at once; so the rounds follow the branchings, not the turns. What is left is small, and one task sorts
the suffixes of a container and sweeps them into nodes: a turn that the suffix before does not share is a
new node. A container with one sequence is never burst or swept: it is a chain like a head. Chains of any
length are summed by blocks of turns. Leaves and tokens of containers are added to the heads above in the
reverse order of the rounds.

Turns have ids: the MD5 of role and text. What is sorted and shuffled are ids, not texts.

The ids of the conversations that end at a node are hashed in order. They are sorted over the whole
table and joined to pieces of at most PIECE ids each before one task hashes the pieces of a node as a stream.

Defined cases: turns are ordered by turn, null first, then by role, then by id; repeated rows are turns of
their own. A null role or text is empty. Rows with a null conversation belong to none. `%` keeps the
sign of a negative id. Only an empty table has no root. Texts count whole. Columns other than the
four named do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimflow.operators.surrogate import number_densely, place_in_order
from dimflow.sources.staging import stage

#: Turns of a container that one task sorts.
CAPACITY = 50_000
#: Ids that are joined to one piece before hashing, as a power of two.
PIECE_BITS = 12
#: Turns of a chain that one group sums.
CHAIN_BLOCK = 4096

NODE = """conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint,
 saved_tokens bigint, ended_by bigint"""


def conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """(conv, pos, tid, bytes): turns in order, numbered from 1 in each conversation.

    Numbered over the whole sorted table, so that a conversation of any length is spread over tasks."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv"),
        F.col(turn_col).alias("turn"),
        role.alias("role"),
        F.unhex(F.md5(F.concat_ws(":", F.length(role), F.concat(role, text)))).alias("tid"),
        F.octet_length(text).cast("bigint").alias("bytes"),
        F.monotonically_increasing_id().alias("_any"),
    )
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("tid"), F.col("_any")]
    placed = place_in_order(rows, order).select("conv", "tid", "bytes", "_spot")
    none = rows.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("n"))
    numbered = stage(number_densely(placed, none, "at"))
    firsts = numbered.groupBy("conv").agg(F.min("at").alias("first"))
    joined = numbered.join(firsts, "conv")
    return joined.select("conv", (F.col("at") - F.col("first") + 1).alias("pos"), "tid", "bytes")


def rebuilt(convs: DataFrame, group: int = 5, spread: int = 9) -> DataFrame:
    """Conversations whose first turns are those of the first conversation of their group.

    Conversation c takes the first h turns of c - c % ``group``, h = crc32(c) % ``spread``, and goes on with its
    own turns after its first h. Adds the textless turn 0 that all share."""
    convs = stage(convs)
    sizes = convs.groupBy("conv").agg(F.count(F.lit(1)).alias("size"))
    base = F.col("conv") - F.col("conv") % group
    own = sizes.select("conv", "size", base.alias("base"), (F.crc32(F.col("conv").cast("string")) % spread).alias("h"))
    bases = sizes.select(F.col("conv").alias("base"), F.col("size").alias("base_size"))
    given = F.least("h", F.coalesce("base_size", F.lit(0)))
    plan = stage(own.join(bases, "base", "left").select("conv", "base", "h", given.alias("given")))
    heads = convs.filter(F.col("pos") < spread).withColumnRenamed("conv", "base")
    taken = plan.filter("given > 0").join(heads, "base").filter("pos <= given")
    kept = convs.join(plan, "conv").filter("pos > h").withColumn("pos", F.col("given") + F.col("pos") - F.col("h"))
    root = plan.select("conv", F.lit(0).cast("bigint").alias("pos"), F.unhex(F.lit("")).alias("tid"),
                       F.lit(0).cast("bigint").alias("bytes"))
    columns = ["conv", "pos", "tid", "bytes"]
    return taken.select(columns).unionByName(kept.select(columns)).unionByName(root)


def _hash_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(seq, n, last, ends) of pieces that come sorted; memory for one piece."""
    key, seq, count, digest, rows = None, None, 0, None, []

    def full():
        columns = zip(*rows) if rows else ((), (), (), ())
        types = (("seq", pa.int64()), ("n", pa.int64()), ("last", pa.int64()), ("ends", pa.string()))
        made = [pa.array(list(c), t) for c, (_, t) in zip(columns, types)]
        return pa.RecordBatch.from_arrays(made, names=[name for name, _ in types])

    for batch in batches:
        for x, y, last, least, n, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if (x, y, last) != key:
                if key is not None:
                    rows.append((seq, count, key[2], digest.hexdigest()))
                key, seq, count, digest = (x, y, last), least, 0, hashlib.sha256()
            digest.update((("," if count else "") + ids).encode())
            count += n
        if len(rows) >= 10_000:
            yield full()
            rows.clear()
    if key is not None:
        rows.append((seq, count, key[2], digest.hexdigest()))
    yield full()


def sequences(rows: DataFrame) -> DataFrame:
    """(seq, n, last, ends): distinct sequences, known by their least conversation, with the number of
    their copies, the place of their last turn and the SHA-256 of their conversations."""
    mixed = [F.bit_xor(F.xxhash64(F.lit(seed), "pos", "tid")).alias(name) for seed, name in ((1, "x"), (2, "y"))]
    whole = rows.groupBy("conv").agg(*mixed, F.max("pos").alias("last"))
    placed = place_in_order(whole, ["x", "y", "last", "conv"])
    pieces = placed.groupBy("x", "y", "last", F.shiftright("_spot", PIECE_BITS).alias("piece")).agg(
        F.min("conv").alias("least"),
        F.count(F.lit(1)).alias("n"),
        F.array_join(F.sort_array(F.collect_list("conv")), ",").alias("ids"),
    )
    inputs = pieces.repartition("x", "y", "last").sortWithinPartitions("x", "y", "last", "piece")
    inputs = inputs.select("x", "y", "last", "least", "n", "ids")
    return inputs.mapInArrow(_hash_in_order, "seq bigint, n bigint, last bigint, ends string")


def _nodes_of(first: int, parent_conv: int | None, suffixes: list[tuple]) -> list[tuple]:
    """The nodes of a container: suffixes are (joined ids, bytes of each turn, seq, n), of 16 bytes an id,
    but for the root's, which is empty and stands for a turn of its own."""
    conv, depth, above, copies, children, leaves, saved, size, ended = ([] for _ in range(9))
    before, path = b"", []
    width, lead = 16, 1 if first == 0 else 0
    for ids, sizes, seq, n in sorted(suffixes):
        shared = 0
        if path:
            most = min(len(ids), len(before))
            while shared < most and ids[shared : shared + width] == before[shared : shared + width]:
                shared += width
            shared = shared // width + lead
        del path[shared:]
        for k in range(shared, len(sizes)):
            above.append(path[-1] if path else -1)
            path.append(len(conv))
            conv.append(seq), depth.append(first + k), size.append(sizes[k])
            copies.append(0), children.append(0), leaves.append(0), saved.append(0), ended.append(None)
        at = path[-1]
        copies[at] += n
        ended[at] = seq
        conv[at] = min(conv[at], seq)
        before = ids
    for at in range(len(conv) - 1, -1, -1):
        leaves[at] = leaves[at] or 1
        saved[at] += (copies[at] - 1) * size[at]
        up = above[at]
        if up >= 0:
            copies[up] += copies[at]
            children[up] += 1
            leaves[up] += leaves[at]
            saved[up] += saved[at]
            conv[up] = min(conv[up], conv[at])
    parents = [parent_conv if up < 0 else conv[up] for up in above]
    return list(zip(conv, depth, parents, copies, children, leaves, saved, ended))


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of containers, whose turns come sorted; memory for one container."""
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ended_by"]
    made: list[tuple] = []
    container, parent, suffixes, ids, sizes, seq, n = None, None, [], [], [], None, 0

    def close_suffix():
        if seq is not None:
            suffixes.append((b"".join(ids), list(sizes), seq, n))
        ids.clear(), sizes.clear()

    def full():
        columns = list(zip(*made)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=names)

    for batch in batches:
        for first, top, of, at, tid, size, copies in zip(*(c.to_pylist() for c in batch.columns)):
            if (first, top) != container or at != seq:
                close_suffix()
                if (first, top) != container:
                    if container is not None:
                        made += _nodes_of(container[0], parent, suffixes)
                        suffixes.clear()
                    container, parent = (first, top), of
                seq, n = at, copies
            ids.append(tid), sizes.append(size)
        if len(made) >= 20_000:
            yield full()
            made.clear()
    close_suffix()
    if container is not None:
        made += _nodes_of(container[0], parent, suffixes)
    yield full()


def _chain_nodes(chains: DataFrame, rows: DataFrame) -> DataFrame:
    """The nodes of chains: (top, first, to, parent_conv, n, kids, leaves, below, ended_by), where ``below``
    is saved under the chain's end. Sums run within blocks of turns and over the blocks."""
    block = F.floor(F.col("pos") / CHAIN_BLOCK).alias("_block")
    turns = rows.select(F.col("seq").alias("top"), "pos", "bytes").join(chains, "top").filter("pos between first and to")
    turns = stage(turns.select("top", "first", "to", "parent_conv", "n", "kids", "leaves", "below", "ended_by", "pos", "bytes", block))
    later = Window.partitionBy("top", "first").orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = turns.groupBy("top", "first", "_block").agg(F.sum("bytes").alias("_sum"))
    after = blocks.select("top", "first", "_block", F.coalesce(F.sum("_sum").over(later), F.lit(0)).alias("_after"))
    here = Window.partitionBy("top", "first", "_block").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, 0)
    summed = turns.withColumn("_here", F.sum("bytes").over(here)).join(after, ["top", "first", "_block"])
    end = F.col("pos") == F.col("to")
    return summed.select(
        F.col("top").alias("conv_id"),
        F.col("pos").alias("depth"),
        F.when(F.col("pos") == F.col("first"), F.col("parent_conv")).otherwise(F.col("top")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(end, F.col("kids")).otherwise(F.lit(1)).cast("bigint").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("below") + (F.col("n") - 1) * (F.col("_here") + F.col("_after"))).alias("saved_tokens"),
        F.when(end, F.col("ended_by")).alias("ended_by"),
    )


def trie(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """All nodes of the trie of (conv, pos, tid, bytes), pos from 0 in each conversation."""
    rows = stage(rows)
    seqs = stage(sequences(rows))
    rows = stage(rows.join(seqs.select(F.col("seq").alias("conv"), "n", "last"), "conv").withColumnRenamed("conv", "seq"))
    # A container is known by the depth of its first turn and its least sequence.
    at = ["first", "top"]
    whole = seqs.agg(F.min("seq"), F.count(F.lit(1)), F.sum(F.col("last") + 1)).first()

    def same(value: int | None):
        return F.lit(value).cast("bigint")

    # Staged, so that the first join has keys and not constants.
    members = stage(
        seqs.select(
            "seq", "n", "last", same(0).alias("first"), same(whole[0]).alias("top"), same(None).alias("parent_conv"),
            same(None).alias("above_first"), same(None).alias("above_top"), same(whole[1]).alias("seqs"),
            same(whole[2]).alias("turns"),
        )
    )
    settled, heads = [], []
    while True:
        large = (F.col("seqs") > 1) & (F.col("turns") > capacity)
        settled.append(members.filter(~large))
        burst = members.filter(large)
        if burst.isEmpty():
            break
        inside = rows.join(burst.drop("n", "last"), "seq").filter("pos >= first")
        apart = (
            inside.groupBy(*at, "seqs", "pos", "tid")
            .count()
            .groupBy(*at, "seqs", "pos")
            .agg(F.count(F.lit(1)).alias("_kinds"), F.sum("count").alias("_going"))
            .filter("_kinds > 1 or _going < seqs")
            .groupBy(*at)
            .agg(F.min("pos").alias("part"))
        )
        parted = stage(burst.join(stage(apart), at))
        head = parted.groupBy(*at, "parent_conv", "above_first", "above_top", "part").agg(
            F.sum("n").alias("n"),
            F.max(F.when(F.col("last") == F.col("part") - 1, F.col("seq"))).alias("ended_by"),
        )
        heads.append(stage(head))
        nexts = rows.select("seq", "pos", "tid").join(parted.drop("seqs", "turns"), "seq").filter("pos = part")
        nexts = stage(nexts)
        boxes = nexts.groupBy(*at, "tid").agg(
            F.min("seq").alias("_top"), F.count(F.lit(1)).alias("seqs"), F.sum(F.col("last") - F.col("part") + 1).alias("turns")
        )
        members = stage(
            nexts.join(boxes, [*at, "tid"]).select(
                "seq", "n", "last", F.col("part").alias("first"), F.col("_top").alias("top"),
                F.col("top").alias("parent_conv"), F.col("first").alias("above_first"), F.col("top").alias("above_top"),
                "seqs", "turns",
            )
        )
    return _assemble(rows, seqs, settled, heads)


def _assemble(rows: DataFrame, seqs: DataFrame, settled: list[DataFrame], heads: list[DataFrame]) -> DataFrame:
    at = ["first", "top"]
    small = settled[0]
    for more in settled[1:]:
        small = small.unionByName(more)
    small = stage(small)
    many = small.filter("seqs > 1").select("seq", *at, "parent_conv")
    turns = rows.join(many, "seq").filter("pos >= first")
    turns = turns.select("first", "top", "parent_conv", "seq", "pos", "tid", "bytes", "n")
    turns = turns.repartition("first", "top").sortWithinPartitions("first", "top", "seq", "pos")
    swept = stage(turns.select("first", "top", "parent_conv", "seq", "tid", "bytes", "n").mapInArrow(_sweep, NODE))
    single = small.filter("seqs = 1").select(
        "top", "first", F.col("last").alias("to"), "parent_conv", "n", F.lit(0).cast("bigint").alias("kids"),
        F.lit(1).cast("bigint").alias("leaves"), F.lit(0).cast("bigint").alias("below"), F.col("seq").alias("ended_by"),
    )
    chains = stage(_chain_nodes(single, rows))
    boxes = small.select(*at, "above_first", "above_top").distinct()
    tops = swept.unionByName(chains).select(
        F.col("depth").alias("first"), F.col("conv_id").alias("top"), F.col("n_leaves").alias("leaves"),
        F.col("saved_tokens").alias("saved"),
    )
    made = stage(boxes.join(tops, at))
    nodes = [swept, chains]
    for head in reversed(heads):
        below = made.groupBy(F.col("above_first").alias("first"), F.col("above_top").alias("top")).agg(
            F.count(F.lit(1)).alias("kids"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("below")
        )
        ended = head.join(below, at).select(
            "top", "first", (F.col("part") - 1).alias("to"), "parent_conv", "n", "kids", "leaves", "below", "ended_by",
        )
        chain = stage(_chain_nodes(ended, rows))
        nodes.append(chain)
        totals = head.select(*at, "above_first", "above_top").join(
            chain.select(F.col("depth").alias("first"), F.col("conv_id").alias("top"), F.col("n_leaves").alias("leaves"),
                         F.col("saved_tokens").alias("saved")), at)
        made = stage(made.unionByName(totals))
    every = nodes[0]
    for more in nodes[1:]:
        every = every.unionByName(more)
    ends = seqs.select(F.col("seq").alias("ended_by"), "ends")
    nobody = hashlib.sha256(b"").hexdigest()
    joined = every.join(ends, "ended_by", "left").drop("ended_by")
    return joined.withColumn("ends_sha256", F.coalesce("ends", F.lit(nobody))).drop("ends")


def prefix_trie(turns: DataFrame, capacity: int = CAPACITY, **columns: str) -> DataFrame:
    """The trie of the rebuilt conversations: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256)."""
    return trie(rebuilt(conversations(turns, **columns)), capacity)
