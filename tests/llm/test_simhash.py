import itertools
import re

import numpy as np
import xxhash
from conftest import rows_of
from llm_fixtures import rng, table  # noqa: F401

from dimflow.llm import simhash
from dimflow.llm.components import components


def by_hand(text, n):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reach(nodes, linked):
    root = {n: n for n in nodes}
    for _ in nodes:
        for a, b in linked:
            root[a] = root[b] = min(root[a], root[b])
    return root


def test_fingerprints(rng):
    texts = [None, "", " \n\t", "One", "one TWO", "a b c d", "É é\xa0x y\x0bz\x1cq", "w " * 3000]
    texts += [" ".join(rng.choice("abcdef") for _ in range(rng.randrange(40))) for _ in range(40)]
    for text in texts:
        for n in (3, 5):
            assert simhash.fingerprint(text, n) % 2**64 == by_hand(text, n)


def test_hash_is_the_same_in_spark(spark):
    from pyspark.sql import functions as F

    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] % 2**64 == xxhash.xxh64_intdigest("a b c", 42)


def test_trees_find_all_within_the_radius(spark, rng):
    base = [rng.getrandbits(64) for _ in range(60)]
    fps = {b ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(5))) for b in base for _ in range(8)}
    fps = np.array(sorted(fps), np.uint64)
    root = np.zeros(len(fps), np.int64)
    tree = simhash.build_trees(fps, root)
    assert len(tree[0]) == len(fps) - 1
    found = set()
    for q, p in simhash.search(fps, np.arange(len(fps)), root, tree, 3):
        found |= set(zip(q.tolist(), p.tolist()))
    near = {(a, b) for a in range(len(fps)) for b in range(len(fps)) if (int(fps[a]) ^ int(fps[b])).bit_count() <= 3}
    assert found == near


def test_components_equal_brute_force_over_split_shards(spark, rng, monkeypatch):
    """Fingerprints in chains and clusters, some shards larger than a tree may be."""
    fps = {rng.getrandbits(64) for _ in range(50)}
    for _ in range(6):
        at = rng.getrandbits(64)
        for _ in range(40):
            fps.add(at)
            at ^= sum(1 << k for k in rng.sample(range(64), rng.randrange(1, 4)))
    hub = rng.getrandbits(64)
    fps |= {hub ^ 1 << k for k in range(64)} | {hub}
    fps = sorted(fps)
    texts = [(i, str(f)) for i, f in enumerate(fps)] + [(1000 + i, str(f)) for i, f in enumerate(fps[::3])]

    def prints(docs, id_col, text_col, words):
        from pyspark.sql import functions as F

        value = F.col(text_col).cast("decimal(20,0)")
        half, whole = (F.lit(str(n)).cast("decimal(20,0)") for n in (2**63, 2**64))
        signed = F.when(value >= half, value - whole).otherwise(value).cast("long")
        return docs.select(F.col(id_col).alias("doc_id"), signed.alias("fp"))

    monkeypatch.setattr(simhash, "with_fingerprints", prints)
    linked = [(a, b) for a, b in itertools.combinations(fps, 2) if (a ^ b).bit_count() <= 3]
    root = reach(fps, linked)
    first = {}
    for doc, f in texts:
        first[root[int(f)]] = min(first.get(root[int(f)], doc), doc)
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    expected = sorted((d, f"{int(f):016x}", first[root[int(f)]]) for d, f in texts)
    for limit in (4, 1000):
        found = simhash.duplicates(frame, limit=limit).select("doc_id", "fingerprint", "component_id")
        assert sorted(map(tuple, found.collect())) == expected


def test_nulls_empty_ties_repeated_and_long(spark, table):
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [(5, None), (3, ""), (4, "  "), (7, "one two three"), (7, "one two three"), (None, "one  TWO three"),
            (9, long), (8, long.upper())]
    found = rows_of(simhash.duplicates(table(rows)), "doc_id", "component_id")
    assert sorted(found, key=str) == [(3, 3), (4, 3), (5, 3), (7, 7), (7, 7), (8, 8), (9, 8), (None, 7)]
    assert simhash.duplicates(table([])).count() == 0


def kept_by_hand(rows):
    """The (id, text) that stay, where ids are not repeated."""
    prints = [by_hand(text, 3) for _, text in rows]
    linked = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if (prints[i] ^ prints[j]).bit_count() <= 3]
    root = reach(range(len(rows)), linked)
    best = {}
    for i, (doc, _) in enumerate(rows):
        known = doc is not None
        best[root[i]] = min(best.get(root[i], (not known, doc or 0, i)), (not known, doc or 0, i))
    return sorted(rows[i][0] if known else None for _, _, i in best.values() for known in [rows[i][0] is not None])


def test_one_row_of_each_group_stays(spark, table, rng):
    rows = []
    for i in range(12):
        text = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([200, 2000]))]
        for changes in (0, 0, 1, 1, 30):
            copy = list(text)
            for k in rng.sample(range(len(copy)), changes):
                copy[k] = "other"
            rows.append((len(rows), " ".join(copy)))
    rng.shuffle(rows)
    kept = simhash.representatives(table(rows))
    assert sorted(r.doc_id for r in kept.collect()) == kept_by_hand(rows)
    assert len(rows) > kept.count() >= 12 and "score" in kept.columns


def test_a_large_group_of_long_near_copies(spark, table, rng):
    """300 copies of a text of 2000 words with a word changed each: links grow with the members, not with pairs."""
    text = [f"w{rng.randrange(10**6)}" for _ in range(2000)]
    rows = []
    for i in range(300):
        copy = list(text)
        copy[rng.randrange(2000)] = f"n{i}"
        rows.append((i, " ".join(copy)))
    df = table(rows)
    fps = simhash.with_fingerprints(df, "doc_id", "text", 3).select("fp").distinct()
    members = fps.select(simhash.F.explode(simhash.block_keys(simhash.F.col("fp"), 3, 4)).alias("key"), "fp")
    found = simhash.links(simhash.deal(members, "fp", 16), "fp", 3)
    assert found.count() <= simhash.deal(members, "fp", 16).count()
    assert sorted(r.doc_id for r in simhash.representatives(df).collect()) == kept_by_hand(rows)


def test_representatives_of_nulls_empty_and_repeated(spark, table):
    rows = [(4, None), (2, ""), (None, "x y"), (3, "X  y"), (3, "X  y"), (9, "alone here"), (None, "no other"),
            (None, "no  other"), (7, "one id"), (7, "two texts"), (8, "one id")]
    found = rows_of(simhash.representatives(table(rows)), "doc_id", "text")
    assert [(d, " ".join(t.split()).lower()) for d, t in found] == [
        (2, ""), (3, "x y"), (7, "one id"), (7, "two texts"), (9, "alone here"), (None, "no other"),
    ]
    assert simhash.representatives(table([])).count() == 0


def test_any_number_of_blocks_finds_the_same(spark, table, rng):
    assert [simhash.blocks_for(n, 3) for n in (0, 16 << 20, (16 << 20) + 1, 10**11)] == [4, 4, 5, 6]
    rows = [(i, " ".join(rng.choice("abc") for _ in range(30))) for i in range(200)]
    df = table(rows)
    results = [rows_of(simhash.duplicates(df, blocks=blocks)) for blocks in (4, 5, 6, None)]
    assert all(r == results[0] for r in results)


def test_components(spark, rng):
    nodes = list(range(200))
    linked = [(i, i + 1) for i in range(0, 90) if i != 40] + [(100, k) for k in range(101, 160)]
    linked += [(rng.randrange(160, 200), rng.randrange(160, 200)) for _ in range(30)]
    rng.shuffle(linked)
    root = reach(nodes, linked)
    frame = spark.createDataFrame(linked, "a long, b long")
    found = dict(rows_of(components(frame), "node", "root"))
    assert found == {n: root[n] for pair in linked for n in pair if pair[0] != pair[1] or n in found}
    assert components(frame.limit(0)).count() == 0
