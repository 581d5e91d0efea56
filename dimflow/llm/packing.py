"""Packing of tokenised documents into sequences: bounded-space online best-fit.

A document's ids are cut into pieces of at most the sequence length; only longer ones
are cut. Pieces arrive one by one and go to the open sequence that they fill best. A
bitset has one bit for each free space that some open sequence has, so the best one is the
lowest bit from the piece's length on. There is a fixed number of open sequences: if a
piece fits none and all are open, the fullest is closed first.

Spark deals the pieces (id, length and checksum, no tokens) out to tasks, where they arrive in an order by
hash. A task writes what it has closed; the pieces of its still open sequences are
packed again, in a quarter as many tasks, until one task remains. All tasks work alike at every size of the input, and hold
the pieces of their open sequences only.

Defined cases: a null text is an empty one, whose only id is the end id. Repeated rows are
packed each for itself. A null id stays null. An empty table gives no rows. Texts of any
length are tokenised whole. Columns other than the two named are not read.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.sources.staging import stage

OPEN_SEQUENCES = 256
ROWS_PER_TASK = 50_000
#: Parts of words whose ids a tokenising task remembers before it forgets them all.
REMEMBERED = 200_000
PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long"


class WordIds:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    For tokenizers that lower case, cut by a pattern that never goes across white space, and map
    bytes to characters before their merges, a text's ids are those of its parts, one after the other.
    Parts are remembered, and a new one goes to the tokenizer's model directly. Words with special tokens,
    control characters or characters beyond Latin-1 go through the whole tokenizer, and so does all
    text of other tokenizers.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as file:
            self.pattern = _part_pattern(json.load(file))
        self.parts: dict[str, bytes] = {}

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        out = []
        for text in texts:
            out.append(self._ids(text or ""))
            if len(self.parts) > REMEMBERED:
                self.parts = {}
        return out

    def _ids(self, text: str) -> bytes:
        if self.pattern is None:
            return self._whole(text)
        if _is_plain(text):
            return self._plain(text)
        words = text.replace("\n", " ").split(" ")
        return b"".join([self._plain(w) if _is_plain(w) else self._whole(w) for w in words if w])

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        known = self.parts
        parts = self.pattern.findall(text.lower())  # composed already, as Latin-1 is
        for part in parts:
            if part not in known:
                known[part] = self._part(part)
        return b"".join(map(known.__getitem__, parts))

    def _part(self, part: str) -> bytes:
        mapped = part if part.isascii() else part.encode().decode("latin-1").translate(BYTE_CHARACTERS)
        found = [t.id for t in self.model.tokenize(mapped)]
        return struct.pack(f"<{len(found)}I", *found)


#: What is not the same to all patterns: control characters, and the beginning of special tokens.
ODD = re.compile("[\x00-\x08\x0e-\x1f\x7f-\x9f]|<\\|")


def _is_plain(text: str) -> bool:
    if not text.isascii():
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
    return not ODD.search(text)


def _byte_characters() -> dict[int, str]:
    """The public byte-level mapping: printable bytes stand for themselves, others for characters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(256 + k) for k, b in enumerate(rest)}


BYTE_CHARACTERS = _byte_characters()


# Fixed value: the pattern of the public tokenizer files that `WordIds` knows.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTERS, _NUMBERS = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾"
#: The same over small Latin-1 characters, without the tables of all others.
SMALL_PATTERN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+")


def _part_pattern(spec: dict) -> re.Pattern | None:
    """The pattern by which a tokenizer file cuts texts, if it works as `WordIds` needs it; else None."""
    normal = [(n["type"], n.get("content")) for n in (spec["normalizer"] or {}).get("normalizers", [])]
    before = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    if normal != [("NFC", None), ("Replace", " "), ("Lowercase", None)] or len(before) != 2:
        return None
    split, level = before
    plain = split["type"] == "Split" and split["behavior"] == "Removed" and split["invert"]
    plain = plain and split["pattern"] == {"Regex": PATTERN}
    if not plain or level["type"] != "ByteLevel" or level["add_prefix_space"] or level["use_regex"]:
        return None
    return SMALL_PATTERN


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
           length: int = 4096, end_id: int = 1) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32. ``tokenizer``: a file of
    the tokenizers library, at the same path on every executor."""
    size, end = 4 * length, np.array([end_id], "<u4").tobytes()
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = WordIds(tokenizer)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                row, rest = [], []
                for k, ids in enumerate(ids_of(part.column("text").to_pylist())):
                    whole = ids + end
                    for n, start in enumerate(range(0, len(whole), size)):
                        piece = whole[start : start + size]
                        row.append(k)
                        rest.append((n, start // 4, len(piece) // 4, zlib.crc32(piece)))
                columns = [pa.array(c, t) for c, t in
                           zip(zip(*rest), (pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row)), *columns],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return chosen.mapInArrow(cut, PIECES.format(id=chosen.schema["doc_id"].dataType.simpleString()))


class BestFit:
    """Open sequences by free space. Give it a row and its length; closed sequences come out."""

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.free = 0  # bit f: some open sequence has f ids free
        self.open: list[list[list]] = [[] for _ in range(size + 1)]
        self.count = 0

    def add(self, row: int, length: int) -> list | None:
        """Place a row. Returns a sequence that this has closed, if any: rows in order."""
        above = self.free >> length
        closed = None
        if above:
            at = length + (above & -above).bit_length() - 1
            sequence = self._take(at)
        else:
            if self.count == self.most:
                closed = self._take((self.free & -self.free).bit_length() - 1)
            sequence, at = [], self.size
        sequence.append(row)
        left = at - length
        if left == 0 and closed is None:
            return sequence
        self.open[left].append(sequence)
        self.free |= 1 << left
        self.count += 1
        return closed

    def _take(self, free: int) -> list:
        sequence = self.open[free].pop()
        if not self.open[free]:
            self.free &= ~(1 << free)
        self.count -= 1
        return sequence

    def rest(self) -> list[list]:
        return [s for same in self.open for s in same]


def _pack_level(rows: DataFrame, level: int, tasks: int, length: int, open_sequences: int) -> DataFrame:
    last = tasks == 1
    dealt = rows.coalesce(1) if last else rows.repartition(tasks, "spot")
    dealt = dealt.sortWithinPartitions(F.xxhash64("spot"), "spot")
    schema = "spot long, length long, sequence_id long, offset long"

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fit = BestFit(length, open_sequences)
        number = (level << 58) + (TaskContext.get().partitionId() << 36)
        done: list[tuple] = []

        def write(sequence: list) -> None:
            nonlocal number
            at = 0
            for spot, size in sequence:
                done.append((spot, size, number, at))
                at += size
            number += 1

        for batch in batches:
            for row in zip(batch["spot"].tolist(), batch["length"].tolist()):
                if closed := fit.add(row, row[1]):
                    write(closed)
            yield pd.DataFrame(done, columns=["spot", "length", "sequence_id", "offset"])
            done = []
        for sequence in fit.rest():
            if last:
                write(sequence)
            else:
                done += [(spot, size, None, None) for spot, size in sequence]
        yield pd.DataFrame(done, columns=["spot", "length", "sequence_id", "offset"]).astype(
            {"sequence_id": "Int64", "offset": "Int64"}
        )

    return stage(dealt.mapInPandas(pack, schema))


def pack(cut: DataFrame, length: int = 4096, open_sequences: int = OPEN_SEQUENCES,
         rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``cut`` (rows of `pieces`) with sequence_id and offset."""
    cut = stage(cut.withColumn("spot", F.monotonically_increasing_id()))
    count = cut.count()
    left, placed = cut.select("spot", "length"), None
    tasks, level = max(1, -(-count // rows_per_task)), 0
    while True:
        packed = _pack_level(left, level, tasks, length, open_sequences)
        closed = packed.filter("sequence_id is not null").drop("length")
        placed = closed if placed is None else placed.unionByName(closed)
        if tasks == 1:
            break
        left = packed.filter("sequence_id is null").select("spot", "length")
        tasks, level = max(1, min(-(-left.count() // rows_per_task), tasks // 4)), level + 1
    return cut.join(placed, "spot").drop("spot")


def pack_documents(docs: DataFrame, tokenizer: str, length: int = 4096, **more) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(pieces(docs, tokenizer, length=length), length, **more)
