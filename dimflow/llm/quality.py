"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of about a thousand bytes. Every passage is encoded:
counts of character classes, of hashed pairs of neighbouring classes and a few figures
about words go through a dense layer. A gated attention (tanh times sigmoid) gives each
passage a weight, and the weighted mean of the encodings is scored by a logistic
layer. Encoder, attention and classifier are learnt together from document labels alone.

Training takes labelled documents in the order of the hash of their id, TRAIN_DOCS at most, up to the one with which
their texts come to TRAIN_BYTES: that bound on rows is the only sample, and every passage of them counts. Scoring reads all
passages of all documents, in slices of SLICE bytes, so memory does not depend on a text's
length. Attention is a sum over passages, so slices add up.

Defined cases: null and empty texts are one passage without characters and get the score that
this has. A null id is never learnt from. Repeated labels of an id are averaged; a null label is none. If
no or only one kind of label is there, every score is the share of label 1 (none: 0.5).
Repeated rows are scored each for itself. Columns other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRAIN_DOCS = 4000
TRAIN_BYTES = 1 << 25
PASSAGE_BYTES = 1000
SLICE = 1 << 19
#: Classes of bytes: 33 for marks and blanks, small, capital, digit, beyond ASCII, control.
CLASSES, PAIRS, FIGURES = 38, 160, 6
WIDTH = CLASSES + PAIRS + FIGURES
HIDDEN, GATE = 32, 16


#: Odd multipliers by place in a word, for hashes of words.
_POWERS = np.uint64(0x9E3779B97F4A7C15) ** np.arange(1, 65, dtype=np.uint64)


def _byte_classes() -> np.ndarray:
    table = np.full(256, 37, np.int64)
    marks = [9, 10, 32] + [b for b in range(33, 127) if not chr(b).isalnum()]
    for k, b in enumerate(marks):
        table[b] = min(k, 32)
    for b in range(256):
        if b >= 128:
            table[b] = 33
        elif chr(b).isdigit():
            table[b] = 34
        elif chr(b).isupper():
            table[b] = 35
        elif chr(b).islower():
            table[b] = 36
    return table


def encode(data: np.ndarray, passage: np.ndarray, passages: int) -> np.ndarray:
    """Features of each passage: ``data`` are bytes, ``passage`` the passage of each."""
    classes = _byte_classes()[data]
    size = np.maximum(np.bincount(passage, minlength=passages), 1)[:, None]
    single = np.bincount(passage * CLASSES + classes, minlength=passages * CLASSES)
    single = single.reshape(passages, CLASSES) / size
    out = np.zeros((passages, WIDTH))
    out[:, :CLASSES] = np.sqrt(single)
    if len(data) < 2:
        return out
    pair = (classes[:-1] * 41 + classes[1:] * 7 + (classes[:-1] == classes[1:]) * 89) % PAIRS
    inside = passage[:-1] == passage[1:]
    double = np.bincount(passage[:-1][inside] * PAIRS + pair[inside], minlength=passages * PAIRS)
    out[:, CLASSES : CLASSES + PAIRS] = np.sqrt(double.reshape(passages, PAIRS) / size)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    start = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1] | ~inside)))
    if len(start) == 0:
        return out
    of = passage[start]
    words = np.maximum(np.bincount(of, minlength=passages), 1)
    place = _places(len(data), start)
    power = _POWERS[place & 63]
    mixed = np.where(blank, np.uint64(0), (data.astype(np.uint64) + np.uint64(1)) * power)
    hashes = np.add.reduceat(mixed, start)
    kinds = np.unique(np.stack([of.astype(np.uint64), hashes]), axis=1)[0].astype(np.int64)
    kinds = np.bincount(kinds, minlength=passages)
    solid = np.bincount(passage[~blank], minlength=passages)
    capital = np.bincount(of[classes[start] == 35], minlength=passages)
    lines = np.bincount(passage[data == 10], minlength=passages)
    figures = (solid / words / 10, kinds / words, capital / words, lines / words,
               np.log1p(words) / 5, np.log1p(size[:, 0]) / 7)
    out[:, CLASSES + PAIRS :] = np.stack(figures, axis=1)
    return out


def _places(n: int, start: np.ndarray) -> np.ndarray:
    """Distance of each byte from the word start before it."""
    at = np.zeros(n, np.int64)
    at[start] = np.diff(np.concatenate(([0], start)))
    return np.arange(n) - np.cumsum(at)


def bags(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, document of each row) for slices of the texts. A long document comes in several."""
    parts: list[tuple[int, bytes, int]] = []  # document, bytes, passages
    held = 0
    for k, text in enumerate(texts):
        whole = (text or "").encode("utf-8", "replace")
        for at in range(0, max(len(whole), 1), SLICE):
            piece = whole[at : at + SLICE]
            parts.append((k, piece, max(1, round(len(piece) / PASSAGE_BYTES))))
            held += len(piece)
            if held >= SLICE:
                yield _encoded(parts)
                parts, held = [], 0
    if parts:
        yield _encoded(parts)


def _encoded(parts: list[tuple[int, bytes, int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.array([n for _, _, n in parts])
    first = np.cumsum(counts) - counts
    sizes = np.array([len(b) for _, b, _ in parts])
    data = np.frombuffer(b"".join(b for _, b, _ in parts), np.uint8)
    at = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    passage = np.repeat(first, sizes) + at * np.repeat(counts, sizes) // np.repeat(np.maximum(sizes, 1), sizes)
    docs = np.repeat(np.array([k for k, _, _ in parts]), counts)
    return encode(data, passage, int(counts.sum())), docs


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class Model:
    """The weights, and the passes forward and back."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.w = {
            "E": rng.normal(0, WIDTH**-0.5, (WIDTH, HIDDEN)),
            "e": np.zeros(HIDDEN),
            "V": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
            "U": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
            "a": rng.normal(0, GATE**-0.5, GATE),
            "c": rng.normal(0, HIDDEN**-0.5, HIDDEN),
            "d": np.zeros(1),
        }
        self.mean, self.scale = np.zeros(WIDTH), np.ones(WIDTH)
        self.constant: float | None = None

    def encodings(self, x: np.ndarray):
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ self.w["E"] + self.w["e"])
        v, u = np.tanh(h @ self.w["V"]), _sigmoid(h @ self.w["U"])
        # The gate is bounded, so its exponential needs no shift.
        return x, h, v, u, np.exp(np.clip((v * u) @ self.w["a"], -30, 30))

    def fit(self, x: np.ndarray, bag: np.ndarray, y: np.ndarray, epochs: int = 40) -> None:
        """x: passages, sorted by ``bag`` 0, 1, ...; y: the label of each bag."""
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        rng, step = np.random.default_rng(1), 0
        first = np.searchsorted(bag, np.arange(len(y) + 1))
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        s = {k: np.zeros_like(v) for k, v in self.w.items()}
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for chosen in np.array_split(order, max(1, len(y) // 64)):
                rows = np.concatenate([np.arange(first[b], first[b + 1]) for b in chosen])
                of = np.repeat(np.arange(len(chosen)), np.diff(first)[chosen])
                step += 1
                for k, g in self._gradients(x[rows], of, y[chosen]).items():
                    g = g + 1e-4 * self.w[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.999 * s[k] + 0.001 * g * g
                    rate = 3e-3 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                    self.w[k] = self.w[k] - rate * m[k] / (np.sqrt(s[k]) + 1e-8)

    def _gradients(self, x: np.ndarray, of: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        n, w = len(y), self.w
        x, h, v, u, e = self.encodings(x)
        weight = e / np.bincount(of, e, n)[of]
        z = np.zeros((n, HIDDEN))
        np.add.at(z, of, weight[:, None] * h)
        wrong = (_sigmoid(z @ w["c"] + w["d"][0]) - y) / n
        back_z = wrong[:, None] * w["c"]
        back_weight = (back_z[of] * h).sum(axis=1)
        back_gate = weight * (back_weight - np.bincount(of, weight * back_weight, n)[of])
        back_v = back_gate[:, None] * w["a"] * u * (1 - v * v)
        back_u = back_gate[:, None] * w["a"] * v * u * (1 - u)
        back_h = weight[:, None] * back_z[of] + back_v @ w["V"].T + back_u @ w["U"].T
        back_x = back_h * (1 - h * h)
        return {
            "E": x.T @ back_x, "e": back_x.sum(axis=0), "V": h.T @ back_v, "U": h.T @ back_u,
            "a": (v * u).T @ back_gate, "c": z.T @ wrong, "d": np.array([wrong.sum()]),
        }

    def score(self, texts: list[str | None]) -> np.ndarray:
        """The score of each text, from all its passages."""
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        z, total = np.zeros((len(texts), HIDDEN)), np.zeros(len(texts))
        for x, docs in bags(texts):
            _, h, _, _, e = self.encodings(x)
            np.add.at(z, docs, e[:, None] * h)
            total += np.bincount(docs, e, len(texts))
        return _sigmoid((z / total[:, None]) @ self.w["c"] + self.w["d"][0])


def held_out(id_col: Column) -> Column:
    """True for rows never learnt from: one in five by the checksum of the id, and null ids."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", train_docs: int = TRAIN_DOCS, train_bytes: int = TRAIN_BYTES) -> Model:
    """A model of the label from at most ``train_docs`` labelled documents, of ``train_bytes`` or one text more."""
    key = F.col(id_col)
    chosen = (
        labels.select(key.alias("_id"), F.col(label_col).alias("_label"))
        .filter(~held_out(F.col("_id")) & F.col("_label").isNotNull())
        .groupBy("_id")
        .agg(F.avg("_label").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(train_docs)
    )
    # At most train_docs rows, so a broadcast; one text per id where ids repeat.
    bag = (
        docs.select(key.alias("_id"), F.col(text_col).alias("_text"))
        .join(F.broadcast(chosen), "_id")
        .groupBy("_id")
        .agg(F.min("_text").alias("_text"), F.first("_label").alias("_label"))
    )
    # At most train_docs rows here too.
    earlier = Window.orderBy(F.xxhash64("_id"), "_id").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.octet_length("_text")).over(earlier), F.lit(0))
    bag = bag.withColumn("_before", before).filter(F.col("_before") < train_bytes).drop("_before")
    bag = bag.repartition(F.xxhash64("_id"))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: dict[int, list[np.ndarray]] = {}
            for x, of in bags(batch["_text"].tolist()):
                for k in np.unique(of):
                    found.setdefault(int(k), []).append(x[of == k])
            rows = {}
            for k, parts in found.items():
                rows[k] = np.concatenate(parts).astype(np.float32).tobytes()
            yield pd.DataFrame(
                {"id": batch["_id"].astype(str), "label": batch["_label"], "x": [rows[k] for k in range(len(batch))]}
            )

    sample = bag.mapInPandas(features, "id string, label double, x binary").toPandas()
    sample = sample.sort_values("id", kind="stable")
    model = Model()
    y = (sample["label"].to_numpy(dtype=float) >= 0.5).astype(float)
    if len(y) == 0 or y.min() == y.max():
        model.constant = float(y.mean()) if len(y) else 0.5
        return model
    parts = [np.frombuffer(b, np.float32).reshape(-1, WIDTH) for b in sample["x"]]
    bag_of = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    model.fit(np.concatenate(parts).astype(float), bag_of, y)
    return model


def scorer(model: Model) -> Callable[[Column], Column]:
    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(model.score([t if isinstance(t, str) else None for t in batch]))

    return score


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = 0.3) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    key = F.col(id_col)
    return docs.select(
        key.alias("doc_id"), held_out(key).alias("held_out"), scorer(model)(F.col(text_col)).alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
