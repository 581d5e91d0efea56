"""Benchmark questions in documents, also with other numbers and names.

Texts become templates: numbers, names (capitalised words) and units are replaced by typed
placeholders, other words are taken in small letters without surrounding marks. Windows of
WINDOW template tokens of the questions and of the documents are joined by hash; a question with
fewer tokens is one window. A window counts only if half its tokens are words.

With ``whole``, windows in which names are kept as their lower-cased words are cut as well, of questions and
documents alike, and either form covers a question's window: so a copy in other case is found. A
question's window of too few words counts if a document has it with the same values; the share is then the greater of
that of the windows with words and that of all windows. And occurrences of a question whose shifts follow each
other within its length are added up, the greatest first and each that is consistent with those before: so
inserted or deleted words do not hide a question.

Windows of a document that match a question at the same shift are one occurrence. In an occurrence
the slots must be consistent: one value of the question always stands for one value in the document. A
document is contaminated by a question if a consistent occurrence covers at least SHARE of the
question's windows.

Before anything is shuffled, document windows are tested against a Bloom filter of the questions'
windows. It has a fixed number of bits; if the benchmark outgrows it, more windows are
shuffled, and the join still decides.

Defined cases: null and empty texts and questions have no windows. A question with no window
that counts (nearly all placeholders) is found only with ``whole``, and then only with its own values. Repeated rows of documents are each found;
repeated questions give one result per id and document. Texts of any length are read whole. Columns other than
those named do not matter.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimflow.sources.staging import stage

WINDOW = 10
SHARE = 0.25
#: Bits of the Bloom filter, and how many a window sets.
FILTER_BITS, FILTER_SETS = 1 << 23, 2
#: A task that remembers more words than this forgets them.
REMEMBERED = 200_000

# Words for numbers, and units of measure.
NUMBER_WORDS = frozenset("""zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen
fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred
thousand million billion half dozen""".split())
UNITS = frozenset("""mm cm m km in ft yd mi mg g kg lb lbs oz ml l s sec min h hr hrs ms w kw kwh v hz mph kmh usd eur gbp
millimeter millimeters centimeter centimeters meter meters metre metres kilometer kilometers inch inches foot feet
yard yards mile miles gram grams kilogram kilograms pound pounds ounce ounces liter liters litre litres gallon
gallons second seconds minute minutes hour hours day days week weeks month months year years dollar dollars cent
cents euro euros percent degree degrees celsius fahrenheit watt watts volt volts""".split())
NOT_PLAIN = NUMBER_WORDS | UNITS
NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(?:st|nd|rd|th)?%?")
MARKS = string.punctuation + "“”‘’«»…–—¿¡"
OUTER_MARKS = MARKS.translate(str.maketrans("", "", "$+-%"))  # those that no number begins or ends with
WORD, NUM, NAME, UNIT, NONE = range(5)
#: Forms of a window: names as placeholders, or as words, or all with their values.
TEMPLATE, FOLDED, EXACT = range(3)
FORMS = 3

#: The hash of each kind of placeholder.
PLACEHOLDERS = {kind: xxhash.xxh64_intdigest(f"<{kind}>", 2) for kind in (NUM, NAME, UNIT)}


def template_tokens(word: str) -> list[tuple[int, str]]:
    """The template tokens of a word, as (kind, value): none, one, or a number and its unit."""
    bare = word.strip(MARKS)
    if not bare:
        return []
    low = bare.lower()
    if not bare.isalpha() and (number := NUMBER.match(outer := word.strip(OUTER_MARKS))):
        value, unit = number[0].rstrip(".,:/"), outer[number.end() :].lower()
        if not unit:
            return [(NUM, value)]
        if unit in UNITS:
            return [(NUM, value), (UNIT, unit)]
    if low in NUMBER_WORDS:
        return [(NUM, low)]
    if low in UNITS:
        return [(UNIT, low)]
    if len(bare) > 1 and bare[0].isupper() and bare[1:].islower():
        return [(NAME, low)]
    return [(WORD, low)]


class Vocabulary(dict):
    """Numbers of words, in the order in which they were first asked for; `new` has those not analysed yet."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        at = self[word] = len(self)
        self.new.append(word)
        return at


class Templates:
    """Template tokens of many texts at once. Words are analysed once and remembered."""

    def __init__(self):
        self.forget()

    def forget(self) -> None:
        self.known = Vocabulary()
        #: Each word's first token and how many it has.
        self.first, self.count = np.empty(0, np.int64), np.empty(0, np.int64)
        #: Of each token.
        self.values: list[str] = []
        self.kinds = np.empty(0, np.int8)
        self.hashes = np.empty((FORMS, 0), np.uint64)

    def learn(self) -> None:
        """Analyse the words that are new."""
        new, self.known.new = self.known.new, []
        if not new:
            return
        # Most words are plain ones, in small letters but for marks around them: what they are is seen without a search.
        digest, begin = xxhash.xxh64_intdigest, len(self.values)
        values = [word.strip(MARKS) for word in new]
        kinds = np.full(len(new), WORD, np.int8)
        others = [k for k, v in enumerate(values) if not (v.isalpha() and v.islower()) or v in NOT_PLAIN]
        kinds[others] = NONE
        plain = np.array([digest(v, 1) for v in values], np.uint64)
        first, count = np.arange(begin, begin + len(new)), np.ones(len(new), np.int64)
        more: list[tuple[int, str]] = []
        for k in others:
            tokens = template_tokens(new[k])
            count[k] = len(tokens)
            if len(tokens) == 1:
                kinds[k], values[k] = tokens[0]
                plain[k] = digest(values[k], 1)
            elif tokens:
                first[k] = begin + len(new) + len(more)
                more += tokens
        kinds = np.concatenate([kinds, np.array([kind for kind, _ in more], np.int8)])
        values += [value for _, value in more]
        plain = np.concatenate([plain, np.array([digest(value, 1) for _, value in more], np.uint64)])
        hashes = np.stack([plain] * FORMS)
        for k in np.flatnonzero((kinds != WORD) & (kinds != NONE)).tolist():
            kind = int(kinds[k])
            hashes[TEMPLATE, k] = PLACEHOLDERS[kind]
            if kind != NAME:
                hashes[FOLDED, k] = PLACEHOLDERS[kind]
                hashes[EXACT, k] = digest(values[k].lower(), 3)
        self.first, self.count = np.concatenate([self.first, first]), np.concatenate([self.count, count])
        self.values += values
        self.kinds = np.concatenate([self.kinds, kinds])
        self.hashes = np.concatenate([self.hashes, hashes], axis=1)

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all texts, as places in `kinds`, `hashes` and `values`, and each token's text."""
        if len(self.known) > REMEMBERED:
            self.forget()
        ids, owner = [], []
        for text in texts:
            words = (text or "").split()
            owner.append(len(words))
            ids.append(np.fromiter(map(self.known.__getitem__, words), np.int64, len(words)))
        self.learn()
        ids, owner = np.concatenate(ids), np.repeat(np.arange(len(texts)), owner)
        first, count = self.first[ids], self.count[ids]
        if (count != 1).any():
            within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            return np.repeat(first, count) + within, np.repeat(owner, count)
        return first, owner


BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


class Powers:
    """Powers of BASE and of its inverse modulo 2**64, made once for as many tokens as there have been."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            self.up, self.down = (
                np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base, np.uint64)]))
                for base in (BASE, BASE_INVERSE)
            )
        return self.up, self.down


class WindowHashes:
    """Hashes of windows of tokens: a polynomial modulo 2**64, from sums that are made once for all lengths."""

    def __init__(self, hashes: np.ndarray, powers: Powers):
        n = len(hashes)
        up, self.down = powers(n + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[:n], dtype=np.uint64)])

    def at(self, starts: np.ndarray, length: int) -> np.ndarray:
        """The hash of the window of ``length`` tokens at each start."""
        found = (self.sums[starts + length] - self.sums[starts]) * self.down[starts]
        return found ^ np.uint64((length * BASE) & (2**64 - 1))


def filter_places(window: np.ndarray, k: int) -> np.ndarray:
    """Where the k-th of a window's bits is in the Bloom filter."""
    return (window >> np.uint64(20 * k)) & np.uint64(FILTER_BITS - 1)


def windows(texts: DataFrame, key: str, text: str, length: int, shorts: list[int] | None,
            bloom=None, whole: bool = False) -> DataFrame:
    """(key, pos, window, size, slots, form): the windows that count, and pass the filter if there is one.

    ``shorts``: further lengths of windows. None: a text of fewer tokens than ``length`` is one window.
    ``whole``: windows with names also in the form that keeps them as words, and those of too few words
    with their values.
    """
    key_type = texts.schema[key].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates, powers = Templates(), Powers()
        bits = None if bloom is None else np.frombuffer(bloom.value, np.uint8)
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.slice(start, 256)
                token, owner = templates(part.column("text").to_pylist())
                kind = templates.kinds[token]
                first = np.searchsorted(owner, np.arange(len(part)))
                sizes = np.bincount(owner, minlength=len(part))
                words = np.concatenate([[0], np.cumsum(kind == WORD)])
                names = np.concatenate([[0], np.cumsum(kind == NAME)])
                sums: dict[int, WindowHashes] = {}
                rows: list[tuple] = []
                for n in [length, *(range(1, length) if shorts is None else shorts)]:
                    if n > len(kind):
                        continue
                    at = np.arange(len(kind) - n + 1)
                    inside = owner[at] == owner[at + n - 1]
                    if shorts is None and n < length:
                        inside &= sizes[owner[at]] == n
                    plain, named = words[n:] - words[:-n], names[n:] - names[:-n]
                    counts = 2 * plain >= n
                    forms = [(TEMPLATE, counts, kind != WORD)]
                    if whole:
                        # Of a question's windows those that count; a document's names may be words of the question.
                        folded = (named > 0) & (counts if shorts is None else 2 * (plain + named) >= n)
                        forms.append((FOLDED, folded, (kind == NUM) | (kind == UNIT)))
                        # Without numbers and units, a document has this as another form.
                        exact = ~counts if shorts is None else plain + named < n
                        forms.append((EXACT, exact, np.zeros(len(kind), bool)))
                    for form, good, slot in forms:
                        starts = np.flatnonzero(good & inside)
                        if not len(starts):
                            continue
                        if form not in sums:
                            sums[form] = WindowHashes(templates.hashes[form][token], powers)
                        window = sums[form].at(starts, n)
                        if bits is not None:
                            for k in range(FILTER_SETS):
                                place = filter_places(window, k)
                                hit = (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1) == 1
                                starts, window = starts[hit], window[hit]
                        for k, w in zip(starts.tolist(), window.view(np.int64).tolist()):
                            slots = [templates.values[v] for v in token[k : k + n][slot[k : k + n]]]
                            rows.append((int(owner[k]), k - int(first[owner[k]]), w, n, slots, form))
                of, pos, found, size, slots, form = zip(*rows) if rows else ((),) * 6
                yield pa.RecordBatch.from_arrays(
                    [part.column("key").take(pa.array(of, pa.int64())), pa.array(pos, pa.int64()), pa.array(found, pa.int64()),
                     pa.array(size, pa.int32()), pa.array(slots, pa.list_(pa.string())), pa.array(form, pa.int32())],
                    ["key", "pos", "window", "size", "slots", "form"],
                )

    chosen = texts.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return chosen.mapInArrow(cut, f"key {key_type}, pos long, window long, size int, slots array<string>, form int")


def bloom_filter(found: DataFrame):
    """A broadcast filter of the windows. Spark sets the bits; at most FILTER_BITS / 64 rows come back."""
    # As `filter_places` has them.
    places = F.array(*[
        F.shiftrightunsigned("window", 20 * k).bitwiseAND(F.lit(FILTER_BITS - 1)) for k in range(FILTER_SETS)
    ])
    words = (
        found.select(F.explode(places).alias("place"))
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(place & 63 as int)))").alias("bits"))
        .collect()
    )
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    for row in words:
        bits[row["word"]] = row["bits"]
    return found.sparkSession.sparkContext.broadcast(bits.tobytes())


def consistent(pairs: Column) -> Column:
    """Whether one value of the question always stands for one value in the document."""
    return F.size(F.array_distinct(F.transform(pairs, lambda p: p["wanted"]))) == F.size(pairs)


def covered_share(covered: Column, words: Column, windows: Column, worded: Column) -> Column:
    """The share of a question's windows covered: of all, or of those with words, whichever is more."""
    return F.greatest(
        F.size(covered) / windows, F.when(worded > 0, F.size(words) / F.greatest(worded, F.lit(1))).otherwise(0.0)
    )


def added_up(found: DataFrame) -> DataFrame:
    """Occurrences whose shifts follow each other within the question's length as one: the greatest, and
    in turn each other that is consistent with those before."""
    group = ["key", "item", "windows", "worded"]
    in_order = Window.partitionBy(*group).orderBy("shift", "form")  # occurrences of one question in one document
    gap = F.col("shift") - F.lag("shift").over(in_order)
    far = F.coalesce(gap >= F.col("windows") + F.col("size") - 1, F.lit(True))
    parts = ["covered", "words", "pairs", "start", "stop"]
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("share")).alias("less"), "shift", "form", *parts)))

    def add(sum_: Column, one: Column) -> Column:
        pairs = F.array_union(sum_["pairs"], one["pairs"])
        both = F.struct(
            F.array_union(sum_["covered"], one["covered"]).alias("covered"),
            F.array_union(sum_["words"], one["words"]).alias("words"),
            pairs.alias("pairs"),
            F.least(sum_["start"], one["start"]).alias("start"),
            F.greatest(sum_["stop"], one["stop"]).alias("stop"),
        )
        more = F.size(F.array_except(one["covered"], sum_["covered"])) > 0
        return F.when(more & consistent(pairs), both).otherwise(sum_)

    one = F.col("ones")
    first = F.struct(*[one[0][c].alias(c) for c in parts])
    return (
        found.withColumn("near", F.sum(far.cast("int")).over(in_order))
        .groupBy(*group, "near")
        .agg(ordered.alias("ones"))
        .select(*group, F.aggregate(F.slice(one, 2, F.greatest(F.size(one) - 1, F.lit(0))), first, add).alias("sum"))
        .select(*group, "sum.*")
        .withColumn("share", covered_share(F.col("covered"), F.col("words"), F.col("windows"), F.col("worded")))
    )


def occurrences(docs: DataFrame, questions: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                item_col: str = "item_id", item_text: str = "text", length: int = WINDOW,
                share: float = SHARE, whole: bool = False) -> DataFrame:
    """One row per contaminated document and question: row (numbers the rows of ``docs``), doc_id, item_id,
    share (of the question's windows covered by its best occurrence), exact (no slot differs),
    start and stop (template tokens of the document). ``whole``: see the module."""
    keyed = questions.select(
        F.struct(F.monotonically_increasing_id().alias("n"), F.col(item_col).alias("id")).alias("key"),
        F.col(item_text).alias("text"),
    )
    asked = stage(windows(stage(keyed), "key", "text", length, None, whole=whole))
    sizes = [r[0] for r in asked.select("size").distinct().collect()]  # at most `length` numbers
    totals = asked.groupBy("key").agg(
        F.count_distinct("pos").alias("windows"),
        F.count_distinct(F.when(F.col("form") != EXACT, F.col("pos"))).alias("worded"),
    )
    asked = stage(
        asked.withColumn("words", F.col("form") != EXACT)
        .drop("form")
        .join(totals, "key")
        .withColumnsRenamed({"key": "item", "pos": "item_pos", "slots": "wanted"})
    )
    rows = docs.select(
        F.struct(F.monotonically_increasing_id().alias("n"), F.col(id_col).alias("id")).alias("key"),
        F.col(text_col).alias("text"),
    )
    found = stage(windows(rows, "key", "text", length, [n for n in sizes if n < length], bloom_filter(asked), whole))
    # Frequent windows are many rows of documents; the join splits them.
    matched = found.join(asked, ["window", "size"]).select(
        "key", "item", "windows", "worded", "form", "pos", "size",
        (F.col("pos") - F.col("item_pos")).alias("shift"),
        "item_pos", "words",
        F.arrays_zip("wanted", "slots").alias("pairs"),
    )
    # Each form is an occurrence of its own: one that is inconsistent does not take another with it.
    per_occurrence = matched.groupBy("key", "item", "windows", "worded", "shift", "form").agg(
        F.collect_set("item_pos").alias("covered"),
        F.collect_set(F.when(F.col("words"), F.col("item_pos"))).alias("words"),
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
        F.min("pos").alias("start"),
        F.max(F.col("pos") + F.col("size")).alias("stop"),
        F.max("size").alias("size"),
    )
    per_occurrence = per_occurrence.withColumn(
        "share", covered_share(F.col("covered"), F.col("words"), F.col("windows"), F.col("worded"))
    ).filter(consistent(F.col("pairs")))
    if whole:
        per_occurrence = added_up(per_occurrence)
    consistent_ones = per_occurrence.select(
        "key", "item", "start", "stop", "share",
        F.forall("pairs", lambda p: p["wanted"] == p["slots"]).alias("exact"),
    )
    best = (
        consistent_ones.filter(F.col("share") >= share)
        .groupBy(F.col("key.n").alias("row"), F.col("key.id").alias("doc_id"), F.col("item.id").alias("item_id"))
        .agg(F.max(F.struct("share", "exact", (-F.col("start")).alias("start"), "stop")).alias("best"))
    )
    return best.select(
        "row", "doc_id", "item_id", F.round("best.share", 6).alias("share"), "best.exact",
        (-F.col("best.start")).alias("start"), "best.stop",
    )


def clean(docs: DataFrame, questions: DataFrame, id_col: str = "doc_id", **more) -> DataFrame:
    """``docs`` without the contaminated rows."""
    numbered = stage(docs.withColumn("_place", F.monotonically_increasing_id()))
    found = occurrences(numbered, questions, "_place", **more).select(F.col("doc_id").alias("_place")).distinct()
    return numbered.join(stage(found), "_place", "left_anti").drop("_place")
