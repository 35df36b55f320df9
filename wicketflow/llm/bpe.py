"""Byte-level BPE by backtracking over longest matches, and decoding by an offset table."""

from __future__ import annotations

import json
import math
import re
import struct
from collections.abc import Callable
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wicketflow.llm.common import append_columns

#: Bytes of remembered pieces and their ids that a Python worker keeps; then the older ones go.
REMEMBERED_BYTES = 64 << 20
#: What an entry of a dictionary holds beside its bytes, about.
ENTRY_BYTES = 150
#: Characters of a text that are cut into pieces at a time.
PART = 1 << 20
#: Remembered answers about pairs of tokens.
PAIRS = 300_000

#: Between pieces: before a space behind something else.
_CUT = re.compile(r"(?<=\S)(?= )")
#: Fixed: how byte-level BPE splits a text into the pieces that it merges.
_PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: The same for ASCII texts; the standard module counts four separators more as white space.
_ASCII_PIECES = re.compile(
    r" ?[A-Za-z]+|'s|'t|'re|'ve|'m|'ll|'d| ?[0-9]+| ?[^ \t-\rA-Za-z0-9]+"
    r"|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+")


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte.

    Printable bytes of Latin-1 stand for themselves, the others for letters from U+0100 on.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


_LETTERS = dict(enumerate(byte_letters()))


class Merges:
    """Tokens numbered in the order in which merges make them, bytes first.

    Two tokens may stand side by side in an encoding if, when the merges that make them are
    undone from the latest on, no merge across their border comes before the one undone. Of
    equal merges the left one comes first.
    """

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]) -> None:
        self.texts = byte_letters()
        self.number = {t: n for n, t in enumerate(self.texts)}
        self.left, self.right = list(range(256)), list(range(256))
        self.made: dict[tuple[int, int], int] = {}
        for a, b in merges:
            if a + b in self.number:
                raise ValueError(f"two merges make the token {a + b!r}")
            pair = (self.number[a], self.number[b])
            self.made[pair] = self.number[a + b] = len(self.texts)
            self.left.append(pair[0])
            self.right.append(pair[1])
            self.texts.append(a + b)
        self.ids = [vocabulary[t] for t in self.texts]
        self.sizes = [len(t) for t in self.texts]
        self.matcher = ahocorasick.Automaton()
        for n, t in enumerate(self.texts):
            self.matcher.add_word(t[::-1], n)
        self.matcher.make_automaton()
        self._shorter: dict[int, int] = {}
        self._compatible: dict[tuple[int, int], bool] = {}

    def shorter(self, token: int) -> int:
        """The longest token that `token` begins with, itself left out; -1 for none."""
        if token not in self._shorter:
            text = self.texts[token]
            self._shorter[token] = next(
                (self.number[text[:k]] for k in range(len(text) - 1, 0, -1)
                 if text[:k] in self.number), -1)
        return self._shorter[token]

    def _undo(self, a: int, b: int) -> bool:
        before: float = math.inf
        while self.made.get((a, b), math.inf) >= before or (a, b) not in self.made:
            if max(a, b) < 256:
                return True
            if a > b:
                before, a = a, self.right[a]
            else:
                before, b = b + 1, self.left[b]
        return False

    def longest(self, text: str) -> dict[int, int]:
        """The longest token that starts at each place, counted back from the end.

        The automaton reads the text from its end; of the tokens that end where it stands it
        names the longest first, which therefore comes last into the dictionary.
        """
        return dict(list(self.matcher.iter(text[::-1]))[::-1])

    def encode(self, text: str) -> list[int]:
        """Token numbers of a piece of text in byte letters, in time linear in its length.

        The longest token goes first; one that cannot stand beside the last gives way to the
        next shorter one, and where none is left the last token is taken back. A place that
        failed once is never reached again.
        """
        if not text:
            return []
        longest, size, compatible = self.longest(text), self.sizes, self._compatible
        if len(compatible) > PAIRS:
            compatible.clear()
        stop, failed = len(text), set()
        out = [longest[stop - 1]]
        at = size[out[0]]
        while at < stop:
            last, token = out[-1], longest[stop - 1 - at]
            while token >= 0:
                end = at + size[token]
                if end not in failed:
                    pair = (last, token)
                    fits = compatible.get(pair)
                    if fits is None:
                        fits = compatible[pair] = self._undo(last, token)
                    if fits:
                        break
                token = self.shorter(token)
            if token >= 0:
                out.append(token)
                at = end
            else:
                at = self._back(out, at, failed)
        return out

    def _back(self, out: list[int], at: int, failed: set[int]) -> int:
        """Put a shorter token in place of the last ones; where the encoding then stands."""
        while True:
            failed.add(at)
            token = out.pop()
            at -= self.sizes[token]
            while (token := self.shorter(token)) >= 0:
                end = at + self.sizes[token]
                if end not in failed and (not out or self._undo(out[-1], token)):
                    out.append(token)
                    return end


class Encoder:
    """Ids of whole texts, as the tokenizers library gives them for the same file.

    A text is cut at its special tokens, then into pieces as the file's pre-tokenizer does,
    and each distinct piece is encoded by `Merges`. Pieces are remembered up to a number of
    bytes.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        told = _plain_file(path)
        model = told["model"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = Merges(model["vocab"], pairs)
        self.coded = [struct.pack("<I", i) for i in self.merges.ids]
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        special = sorted((t["content"] for t in told["added_tokens"]), key=len, reverse=True)
        self.special = {t["content"]: _bytes([t["id"]]) for t in told["added_tokens"]}
        self.marks = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.known: dict[str, bytes] = {}
        self.held = 0

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if self.marks is None or not self.marks.search(text):
            return self._plain(text)
        return b"".join([self.special.get(p) or self._plain(p)
                         for p in self.marks.split(text) if p])

    def _plain(self, text: str) -> bytes:
        out, start = [], 0
        while start < len(text):
            cut = _CUT.search(text, start + PART) if len(text) - start > PART else None
            stop = cut.start() if cut else len(text)
            out.append(self._part(text[start:stop]))
            start = stop
        return out[0] if len(out) == 1 else b"".join(out)

    def _part(self, text: str) -> bytes:
        # Up to here all versions of Unicode agree on letters, numbers and spaces.
        if text.isascii():
            pieces = _ASCII_PIECES.findall(text)
        elif max(text) < "\u0530":
            pieces = _PIECES.findall(text)
        else:
            pieces = [text[a:b] for _, (a, b) in self.split(text)]
        new = set(pieces).difference(self.known)
        if new:
            self._learn(new)
        made = b"".join(map(self.known.__getitem__, pieces))
        if self.held > REMEMBERED_BYTES:
            self._forget()
        return made

    def _learn(self, pieces: set[str]) -> None:
        known, coded, whole = self.known, self.coded, self.merges.number
        number, space = self.merges.encode, _LETTERS[ord(" ")]
        for piece in pieces:
            word = piece[1:] if piece[0] == " " else piece
            if word.isascii() and word.isalnum():
                # Such letters stand for themselves.
                letters = word if word is piece else space + word
            else:
                letters = piece.encode().decode("latin-1").translate(_LETTERS)
            token = whole.get(letters)
            known[piece] = ids = (b"".join([coded[t] for t in number(letters)]) if token is None
                                  else coded[token])
            self.held += len(piece) + len(ids) + ENTRY_BYTES

    def _forget(self) -> None:
        """Drop the oldest entries until half of the bytes are left."""
        known = self.known
        for piece in list(islice(known, len(known))):
            if self.held <= REMEMBERED_BYTES // 2:
                break
            self.held -= len(piece) + len(known.pop(piece)) + ENTRY_BYTES


class Decoder:
    """The bytes of all ids in one array, and where those of each id begin."""

    def __init__(self, path: str) -> None:
        told = _plain_file(path)
        self.offsets, self.blob = _offset_table(told["model"]["vocab"], told["added_tokens"])

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids, gathered by the offset table."""
        starts = self.offsets[ids]
        sizes = self.offsets[ids + 1] - starts
        ends = np.cumsum(sizes)
        shift = np.repeat(starts - (ends - sizes), sizes)
        return self.blob[shift + np.arange(len(shift))]


def _bytes(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def _plain_file(path: str) -> dict:
    """What the file says; stops on one that asks for more than merges over bytes."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    model, cut = told["model"], told["pre_tokenizer"] or {}
    plain = (model["type"] == "BPE" and not told["normalizer"]
             and not any(model.get(k) for k in (
                 "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                 "byte_fallback", "ignore_merges"))
             and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
             and not cut.get("add_prefix_space")
             and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]
                         for t in told["added_tokens"]))
    if not plain:
        raise ValueError("not a plain byte-level BPE file")
    return told


def _offset_table(vocabulary: dict[str, int], added: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Where the bytes of each id begin in one array of bytes, and that array."""
    byte = {letter: b for b, letter in enumerate(byte_letters())}
    named = {**vocabulary, **{t["content"]: t["id"] for t in added}}
    parts = [b""] * (max(named.values()) + 1)
    for text, number in named.items():
        parts[number] = (bytes(byte[c] for c in text) if all(c in byte for c in text)
                         else text.encode())
    offsets = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    return offsets, np.frombuffer(b"".join(parts), np.uint8)


_KNOWN: dict[tuple[type, str], Encoder | Decoder] = {}


def of_worker(kind: type, path: str) -> Encoder | Decoder:
    """The worker's encoder or decoder, which later tasks of the same worker use again."""
    if (kind, path) not in _KNOWN:
        _KNOWN[kind, path] = kind(path)
    return _KNOWN[kind, path]


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """`df` with the column `ids`: little-endian unsigned 32-bit ids of the whole text.

    The ids are those of the tokenizers library for the file `path`, without special tokens
    added; special tokens written in a text are single ids. Null and empty texts have no ids
    (an empty value). Each row stands for itself, so repeated rows, ties and nulls in other
    columns change nothing; a column named as `ids` is replaced; an empty table gives no rows.
    A long text is cut into pieces a part at a time.
    """
    def make() -> Callable[[list], list]:
        one = of_worker(Encoder, path).encode
        return lambda texts: [[one(t) if t else b"" for t in texts]]

    return append_columns(df.drop(ids), text, make, [T.StructField(ids, T.BinaryType())])


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """`df` with the column `text`: what the ids stand for, special tokens included.

    Bytes that are no UTF-8 become replacement characters. Null and empty ids give an empty
    text; an id outside the vocabulary, or bytes that are not whole ids, stop the job. A
    column named as `text` is replaced; an empty table gives no rows.
    """
    def make() -> Callable[[list], list]:
        one = of_worker(Decoder, path).decode

        def decoded(values: list) -> list:
            sizes = [len(v) if v else 0 for v in values]
            if any(n % 4 for n in sizes):
                raise ValueError("ids are not whole 32-bit numbers")
            numbers = np.frombuffer(b"".join(v for v in values if v), "<u4").astype(np.int64)
            out, at = [], 0
            for n in sizes:
                out.append(one(numbers[at:at + n // 4]).tobytes())
                at += n // 4
            return [_texts(out)]

        return decoded

    return append_columns(df.drop(text), ids, make, [T.StructField(text, T.StringType())])


def _texts(values: list[bytes]) -> pa.Array:
    try:
        return pa.array(values, pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([v.decode("utf-8", "replace") for v in values], pa.string())
