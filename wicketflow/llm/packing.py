"""Packing token sequences: bounded-space online best fit."""

from __future__ import annotations

import json
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wicketflow.llm.common import slices
from wicketflow.session import stage

LENGTH = 4096
EOS = 2
#: Windows that a task keeps open.
OPEN = 16
#: Partitions of which one task merges the leftovers, so at most so many times OPEN windows.
MERGED = 64
#: Chunks of text whose ids a Python worker remembers; half of them, which have not been met for
#: longest, go when it is full.
REMEMBERED = 600_000
#: ASCII marks, which end a word; the apostrophe does not, as it can begin a word's ending.
MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'")
SEQUENCES_PER_PARTITION = 1 << 28

PIECES = ("{key} {kind}, start long, length long, ids binary, doc_tokens long,"
          " sequence_id long, offset long")


class ChunkTokenizer:
    """Ids of a text from the ids of its chunks between ASCII spaces.

    For a tokenizer file that drops white space, keeps runs of letters apart from all else and
    marks the end of each word, so that no id spans two chunks; other files are refused. A chunk
    of Latin letters with marks at its end is cut once more before the marks, and its letters are
    looked up in lower case, as the tokenizer lower-cases: such a word needs the merges alone.
    Each distinct stem is learned once, as long as it is remembered.

    What is remembered has two generations. A chunk of the older one that is met again moves to
    the younger one; when that is full it becomes the older one, and what was not met goes.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            _check(json.load(file))
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.coded = [struct.pack("<I", i) for i in range(self.tokenizer.get_vocab_size())]
        self.known: dict[bytes, bytes] = {}
        self.aged: dict[bytes, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        chunks = [t.encode().split() for t in texts]
        new = self._unknown(set().union(*chunks))
        if new:
            self._learn(new)
        get = self.known.__getitem__
        made = [b"".join(map(get, c)) for c in chunks]
        if len(self.known) > REMEMBERED // 2:
            self.aged, self.known = self.known, {}
        return made

    def _unknown(self, wanted: set[bytes]) -> set[bytes]:
        """Those in neither generation; those in the older one alone move to the younger one."""
        new = wanted.difference(self.known)
        again = new.intersection(self.aged)
        self.known.update((c, self.aged.pop(c)) for c in again)
        return new - again

    def _learn(self, chunks: set[bytes]) -> None:
        known, stems, rest = self.known, {}, set()
        for c in chunks:
            word = c.rstrip(MARKS).lower()
            if word.isalpha():
                stems[c] = word
            elif not word.isascii() and _latin(text := word.decode()):
                stems[c] = text.lower().encode()
            else:
                rest.add(c)
        known.update((w, self._word(w)) for w in self._unknown(set(stems.values())))
        rest |= self._unknown({c[len(word):] for c, word in stems.items()})
        whole = list(rest)
        encoded = self.tokenizer.encode_batch_fast([c.decode() for c in whole],
                                                   add_special_tokens=False)
        for c, e in zip(whole, encoded, strict=True):
            known[c] = np.array(e.ids, "<u4").tobytes()
        for c, word in stems.items():
            known[c] = known[word] + known[c[len(word):]]

    def _word(self, word: bytes) -> bytes:
        letters = (word.decode() if word.isascii()
                   else word.decode("latin-1").translate(self.letters))
        return b"".join([self.coded[t.id] for t in self.model.tokenize(letters)])


def _byte_letters() -> dict[int, int]:
    """How byte-level vocabularies write the bytes that print nothing: 256 and on, in order."""
    silent = [b for b in range(256) if not (33 <= b < 127 or 161 <= b < 173 or b > 173)]
    return {b: 256 + place for place, b in enumerate(silent)}


def _latin(text: str) -> bool:
    """Letters alone, of those that lower-case and compose one by one."""
    return text.isalpha() and max(text) < "\u0130"


def _check(told: dict) -> None:
    """Stop on a file whose ids could span white space or the border of letters and marks."""
    cuts = (told["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
    first = cuts[0]
    letters = (first.get("pattern") or {}).get("Regex", "")
    if not (first.get("type") == "Split" and first.get("invert")
            and first.get("behavior") == "Removed" and "[\\p{L}]+" in letters
            and "[^\\s\\p{L}\\p{N}]+" in letters
            and len(cuts) == 2 and cuts[1].get("type") == "ByteLevel"
            and not cuts[1].get("add_prefix_space") and not cuts[1].get("use_regex")
            and told["model"].get("end_of_word_suffix")
            and any(n["type"] == "Lowercase" for n in
                    (told["normalizer"] or {}).get("normalizers", ()))):
        raise ValueError("not a lower-casing word tokenizer that drops white space")


_TOKENIZERS: dict[str, ChunkTokenizer] = {}


def tokenizer(path: str) -> ChunkTokenizer:
    """The worker's tokenizer, which later tasks of the same worker use again."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = ChunkTokenizer(path)
    return _TOKENIZERS[path]


@dataclass
class Window:
    filled: int = 0
    pieces: list[tuple] = field(default_factory=list)

    def add(self, piece: tuple, size: int) -> None:
        self.pieces.append((piece, self.filled))
        self.filled += size


class Packer:
    """Best fit into at most `limit` open windows of `length` ids.

    A piece goes where it leaves the least room. If it fits nowhere and all windows are
    open, the fullest window is topped up with the piece's head and emitted, and the rest of
    the piece is placed anew; so an emitted window has no padding.
    """

    def __init__(self, length: int, limit: int) -> None:
        self.length, self.limit = length, limit
        self.windows: list[Window] = []

    def place(self, piece: tuple, start: int, ids: bytes) -> Iterator[Window]:
        """`piece` stands for the document; a stored piece is (piece, start, ids)."""
        size = len(ids) // 4
        at = 0
        while size - at >= self.length:
            full = Window()
            full.add((piece, start + at, ids[4 * at:4 * (at + self.length)]), self.length)
            at += self.length
            yield full
        while at < size:
            need = size - at
            fitting = [w for w in self.windows if w.filled + need <= self.length]
            if fitting:
                best = max(fitting, key=lambda w: w.filled)
                best.add((piece, start + at, ids[4 * at:]), need)
                at = size
            elif len(self.windows) < self.limit:
                self.windows.append(Window())
                continue
            else:
                best = max(self.windows, key=lambda w: w.filled)
                take = self.length - best.filled
                best.add((piece, start + at, ids[4 * at:4 * (at + take)]), take)
                at += take
            if best.filled == self.length:
                self.windows.remove(best)
                yield best


def pack(df: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text",
         length: int = LENGTH, open_windows: int = OPEN, eos: int = EOS) -> DataFrame:
    """One row for each piece of a document: key, start, length, ids, doc_tokens, sequence_id,
    offset. `ids` holds little-endian unsigned 32-bit ids.

    A document is the ids of its text and `eos`; a null or empty text is `eos` alone. Each
    task packs its partition as it streams by, with `open_windows` open windows. What is left
    in them at the end is merged over `MERGED` partitions at a time, again with cuts, so that
    each such group ends with one window; that one is cut at the powers of two it is made
    of, which need no padding. Pieces are written to the shared folder once, since emitted
    and left-over pieces are both needed; sequence ids are fixed there, whatever a lost
    executor runs again. Keys may be null or repeated: each row is packed as a document of
    its own, but pieces of equal keys cannot be told apart. An empty table gives no rows;
    other columns are not read.
    """
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["key"]
    names = [x.split()[0] for x in PIECES.format(key="key", kind=kind).split(",")]
    key_type: list[pa.DataType] = []

    def batch(windows: list[tuple[int | None, Window]]) -> pa.RecordBatch:
        flat = [(doc[0], start, len(ids) // 4, ids, doc[1], number, offset)
                for number, w in windows for (doc, start, ids), offset in w.pieces]
        columns = list(zip(*flat, strict=True)) or [()] * 7
        kinds = [key_type[0], pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(),
                 pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = tokenizer(tokenizer_path), Packer(length, open_windows)
        end = np.array([eos], "<u4").tobytes()
        number = TaskContext.get().partitionId() * SEQUENCES_PER_PARTITION
        for whole in batches:
            key_type[:] = [whole.schema.field("key").type]
            for part in slices(whole, "text", 2 << 20):
                done = []
                keys = part.column("key").to_pylist()
                texts = [t or "" for t in part.column("text").to_pylist()]
                for k, ids in zip(keys, encoder.encode(texts), strict=True):
                    ids += end
                    for window in packer.place((k, len(ids) // 4), 0, ids):
                        done.append((number, window))
                        number += 1
                if done:
                    yield batch(done)
        if packer.windows:
            yield batch([(None, w) for w in packer.windows])

    made = stage(rows.mapInArrow(first, PIECES.format(key="key", kind=kind)).withColumn(
        "origin", F.spark_partition_id()), "pieces")

    def merge(group: tuple, table: pa.Table) -> pa.Table:
        key_type[:] = [table.schema.field("key").type]
        packer, done = Packer(length, 1), []
        number = ((1 << 34) + group[0].as_py()) * SEQUENCES_PER_PARTITION
        order = pc.sort_indices(table, [("length", "descending"), ("origin", "ascending"),
                                        ("key", "ascending"), ("start", "ascending")])
        for row in table.take(order).to_pylist():
            for window in packer.place((row["key"], row["doc_tokens"]), row["start"], row["ids"]):
                done.append((number, window))
                number += 1
        for last in packer.windows:
            for part in powers_of_two(last):
                done.append((number, part))
                number += 1
        return pa.Table.from_batches([batch(done)])

    left = (made.where(F.col("sequence_id").isNull())
            .withColumn("merged", F.floor(F.col("origin") / MERGED).cast("long")))
    merged = left.groupBy("merged").applyInArrow(merge, PIECES.format(key="key", kind=kind))
    return (made.where(F.col("sequence_id").isNotNull()).drop("origin").unionByName(merged)
            .withColumnRenamed("key", key))


def powers_of_two(window: Window) -> list[Window]:
    """The window cut into windows whose lengths are the powers of two in its own length."""
    parts, rest = [], list(window.pieces)[::-1]
    for bit in range(window.filled.bit_length() - 1, -1, -1):
        room = window.filled & (1 << bit)
        if not room:
            continue
        part = Window()
        while part.filled < room:
            (doc, start, ids), _ = rest.pop()
            take = min(len(ids) // 4, room - part.filled)
            part.add((doc, start, ids[:4 * take]), take)
            if take < len(ids) // 4:
                rest.append(((doc, start + take, ids[4 * take:]), 0))
        parts.append(part)
    return parts
