import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

from llm_fixtures import rng, table  # noqa: F401

from dimflow.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def test_ids_are_the_tokenizers(tokenizer, rng):
    odd = ["I'm here's don't THE'RE'S x' 's", "a\tb\x0bc\x1cd\x85e\xa0f", "İstanbul ΣΑΣ ſ K", "é ́x Å", "12²½ ÀÉ ß ÿ µ ª",
           "<|endoftext|>a <|ENDOFTEXT|>", "“q” — 漢字 😀", "", " \n\n ", "a\r\nb　d", "x" * 5000, "­soft­"]
    letters = list("aB'sT. ,<|é É\t\n1²%") + ["́", "İ", "Σ", "\xa0", "\x1f"]
    odd += ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(1500)]
    words = packing.WordIds(PATH)
    assert words.pattern is not None
    for text, found in zip(odd, words(odd)):
        assert np.frombuffer(found, "<u4").tolist() == ids_of(tokenizer, text)[:-1], repr(text)
    words.pattern = None  # as with a tokenizer of another kind
    assert words(odd[:5]) == packing.WordIds(PATH)(odd[:5])


def test_the_small_pattern_is_the_tokenizers():
    whole = regex.compile(packing.PATTERN)
    latin = "".join(map(chr, range(256))).lower()
    for text in (latin, *latin, *(a + b for a in latin for b in latin)):
        if packing._is_plain(text):
            assert packing.SMALL_PATTERN.findall(text) == whole.findall(text)


def test_forgetting_changes_nothing(tokenizer, monkeypatch):
    texts = [f"one two word{i} three, word{i % 7}!" for i in range(200)]
    whole = packing.WordIds(PATH)(texts)
    monkeypatch.setattr(packing, "REMEMBERED", 5)
    assert packing.WordIds(PATH)(texts) == whole


def check(tokenizer, rows, found, length):
    by_doc = {}
    for r in found:
        by_doc.setdefault((r.doc_id, r.copy), []).append(r)
    for (doc, _), own in by_doc.items():
        ids = ids_of(tokenizer, dict(rows)[doc])
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // length)))
        for r in own:
            part = ids[r.start : r.start + r.length]
            assert r.start == r.piece * length and len(part) == r.length <= length
            assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
        assert sum(r.length for r in own) == len(ids)
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in sequences.values():
        at = 0
        for offset, size in sorted(spans):
            assert offset == at
            at += size
        assert at <= length
    return len(sequences)


@pytest.mark.parametrize("rows_per_task", [10, 1000])
def test_round_trip_and_few_sequences(spark, table, tokenizer, rng, rows_per_task):
    from pyspark.sql import functions as F

    rows = [(i, " ".join(rng.choice(["river", "stone", "zq"]) for _ in range(rng.randrange(300)))) for i in range(150)]
    rows += [(500, None), (501, ""), (502, "stone " * 3000)]
    cut = packing.pieces(table(rows).repartition(4), PATH, length=256)
    found = packing.pack(cut, 256, open_sequences=8, rows_per_task=rows_per_task)
    found = found.withColumn("copy", F.lit(0)).collect()
    assert {r.doc_id for r in found} == {i for i, _ in rows}
    used = check(tokenizer, rows, found, 256)
    least = sum(r.length for r in found) / 256
    assert used <= 1.1 * least + 2


def test_best_fit_equals_brute_force(rng):
    for most in (1, 3, 50):
        fit, open_, closed, expected = packing.BestFit(20, most), [], [], []
        for row in range(400):
            length = rng.randrange(1, 21)
            if done := fit.add(row, length):
                closed.append(done)
            # By hand: the fullest that has room, of equal ones the last to get there.
            fits = [s for s in open_ if s["free"] >= length]
            best = min(fits, key=lambda s: (s["free"], -s["at"]), default=None)
            if best is None and len(open_) == most:
                fullest = min(open_, key=lambda s: (s["free"], -s["at"]))
                open_.remove(fullest)
                expected.append(fullest["rows"])
            full_before = len(expected) > len(closed) - bool(done)
            if best is None:
                best = {"free": 20, "rows": [], "at": row}
                open_.append(best)
            best["free"] -= length
            best["rows"].append(row)
            best["at"] = row
            if best["free"] == 0 and not full_before:
                open_.remove(best)
                expected.append(best["rows"])
        assert closed == expected
        assert sorted(map(tuple, fit.rest())) == sorted(tuple(s["rows"]) for s in open_)
        assert fit.count == len(open_) <= most


@pytest.mark.parametrize("rows", [20_000, 150_000])
def test_both_sizes_go_one_way_with_little_waste(spark, rows):
    """One task, and four tasks and then one: pieces arrive in turn, and few sequences are open."""
    from pyspark.sql import functions as F

    length = F.when(F.col("id") % 40 == 0, 4096).otherwise(1 + F.pmod(F.xxhash64("id"), F.lit(900)))
    cut = spark.range(0, rows, 1, 4).select("id", F.lit(0).alias("piece"), length.cast("long").alias("length"))
    found = packing.pack(cut)
    used = found.select("sequence_id").distinct().count()
    total = found.agg(F.sum("length")).first()[0]
    assert found.count() == rows and used <= 1.02 * total / 4096
    full = found.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert full.filter("n != end or n > 4096").isEmpty()


def test_repeated_null_ids_and_nothing(spark, table):
    rows = [(1, "same text"), (1, "same text"), (None, "no id"), (None, None)]
    found = packing.pack_documents(table(rows), PATH)
    assert sorted((r.doc_id is None, r.length) for r in found.collect()) == [(False, 3), (False, 3), (True, 1), (True, 3)]
    assert found.select("sequence_id").distinct().count() == 1
    assert packing.pack_documents(table([]), PATH).count() == 0
