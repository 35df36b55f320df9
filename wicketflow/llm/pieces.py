"""SentencePiece ids: sampled segmentations that can be repeated, and lossless decoding."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from wicketflow.llm.common import slices

MARK = "▁"
#: Edges and states of the lattices that a worker remembers (12 and 4 bytes); all go when full.
EDGES = 4 << 20
STATES = 2 << 20
#: Chunks that a worker remembers.
CHUNKS = 200_000
#: Characters whose lattices are made at once.
GROUP = 1 << 16
#: Text bytes that are sampled at once, and ids that are decoded at once.
SLICE = 1 << 20
DECODED = 1 << 18


class Pieces:
    """The pieces of a model file, by their text with spaces for marks.

    A BPE model ranks its pieces instead of giving probabilities; a piece of rank r weighs
    (r + 2) ** -`alpha`. A character that is no piece is one edge of its UTF-8 bytes; so is
    the mark itself if a text holds it, which keeps decoding lossless.
    """

    def __init__(self, path: str, alpha: float) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.raw: list[bytes | None] = [None] * size
        self.bytes = [0] * 256
        self.ids: dict[str, int] = {}
        self.weight: dict[str, float] = {}
        rank = 0
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.raw[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                text = piece.replace(MARK, " ")
                if " " in text.lstrip(" "):
                    raise ValueError(f"piece {piece!r} has a mark behind other characters")
                self.raw[i] = text.encode()
                self.ids[text] = i
                self.weight[text] = float(rank + 2) ** -alpha
                rank += 1
        self.size = size
        self.longest = max(map(len, self.ids))
        self.rare = float(rank + 2) ** (-2 * alpha)


class Lattices:
    """Forward-filtered lattices of chunks, laid out for sampling many chunks at once.

    A state is an end position in a chunk. The edges into it lie side by side with their
    cumulative probabilities, which come from the forward weights of where they start; an
    edge that starts at the chunk's begin has no state before it.
    """

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self._trie()
        self.clear()

    def _trie(self) -> None:
        """Steps of the pieces' trie as sorted keys node << 21 | character."""
        steps: dict[int, int] = {}
        codes, weights = [-1], [0.0]
        for text, code in self.pieces.ids.items():
            node = 0
            for c in text:
                node = steps.setdefault(node << 21 | ord(c), len(codes))
                if node == len(codes):
                    codes.append(-1)
                    weights.append(0.0)
            codes[node], weights[node] = code, self.pieces.weight[text]
        self.keys = np.array(sorted(steps), np.int64)
        self.child = np.array([steps[k] for k in self.keys.tolist()], np.int64)
        self.node_code, self.node_weight = np.array(codes, np.int32), np.array(weights)

    def clear(self) -> None:
        self.last: dict[str, int] = {}
        self.states = self.edges = 0
        self.first = np.zeros(STATES + 1, np.int32)
        self.cumulative = np.empty(EDGES, np.float32)
        self.before = np.empty(EDGES, np.int32)
        self.piece = np.empty(EDGES, np.int32)
        self.fallback: list[list[int]] = []
        self.fallback_of: dict[int, int] = {}

    def _spelled(self, chars: np.ndarray) -> np.ndarray:
        """Codes past the piece ids for characters that are spelled in bytes."""
        distinct, back = np.unique(chars, return_inverse=True)
        for c in distinct.tolist():
            if c not in self.fallback_of:
                self.fallback_of[c] = self.pieces.size + len(self.fallback)
                self.fallback.append([self.pieces.bytes[b] for b in chr(c).encode()])
        return np.array([self.fallback_of[c] for c in distinct.tolist()], np.int32)[back]

    def _edges(self, chars: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """start, end (its last position), code and weight of all edges in the chunks."""
        found, known = [], np.zeros(len(chars), bool)
        start, node = np.arange(len(chars), dtype=np.int32), np.zeros(len(chars), np.int64)
        for size in range(self.pieces.longest):
            inside = start + size < ends[start]
            start, node = start[inside], node[inside]
            key = node << 21 | chars[start + size]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            start, node = start[hit], self.child[at[hit]]
            code = self.node_code[node]
            full = code >= 0
            if size == 0:
                known[start[full]] = True
            found.append((start[full], start[full] + size, code[full],
                          self.node_weight[node[full]]))
        rare = np.flatnonzero(~known).astype(np.int32)
        found.append((rare, rare, self._spelled(chars[rare]),
                      np.full(len(rare), self.pieces.rare)))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def learn(self, chunks: list[str]) -> None:
        """Lattices of new chunks, made a group of them at a time."""
        group, held = [], 0
        for chunk in chunks:
            if held and held + len(chunk) > GROUP:
                self._learn(group)
                group, held = [], 0
            group.append(chunk)
            held += len(chunk)
        if group:
            self._learn(group)

    def _learn(self, chunks: list[str]) -> None:
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        close = np.cumsum(sizes)
        chars = np.frombuffer("".join(chunks).encode("utf-32-le"), "<u4").astype(np.int64)
        begin = np.repeat(close - sizes, sizes)
        start, end, code, weight = self._edges(chars, np.repeat(close, sizes))
        level = end - begin[end]
        by = np.argsort(level * len(chars) + end, kind="stable")
        start, end, code, weight, level = (x[by] for x in (start, end, code, weight, level))
        forward = np.ones(len(chars) + 1)  # at position i: the weight of reaching its end
        share = np.empty(len(end))
        bounds = np.searchsorted(level, np.arange(int(level[-1]) + 2))
        for depth, (i, j) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            made = weight[i:j].copy()
            inner = start[i:j] > begin[end[i:j]]
            made[inner] *= forward[start[i:j][inner] - 1]
            cut = np.flatnonzero(np.concatenate(([True], end[i + 1:j] != end[i:j - 1])))
            total = np.add.reduceat(made, cut)
            states = end[i:j][cut]
            forward[states] = total
            runs = np.diff(np.concatenate((cut, [j - i])))
            made /= np.repeat(total, runs)
            summed = np.cumsum(made)
            share[i:j] = summed - np.repeat(summed[cut] - made[cut], runs)
            share[i + cut + runs - 1] = 1.0
            if depth % 16 == 15:  # only ratios within the reach of a piece matter
                window = states[:, None] - np.arange(min(self.pieces.longest, depth + 1))
                forward[window] /= total[:, None]
        by = np.argsort(end, kind="stable")
        into = np.bincount(end, minlength=len(chars))
        start, end = start[by], end[by]
        came = np.where(start > begin[end], self.states + start - 1, -1)
        states, edges = slice(self.states, self.states + len(chars)), slice(
            self.edges, self.edges + len(by))
        self._reserve(states.stop, edges.stop)
        self.first[states.start + 1:states.stop + 1] = edges.start + np.cumsum(into)
        self.cumulative[edges] = share[by]
        self.before[edges] = came
        self.piece[edges] = code[by]
        self.last.update(zip(chunks, (states.start + close - 1).tolist(), strict=True))
        self.states, self.edges = states.stop, edges.stop

    def _reserve(self, states: int, edges: int) -> None:
        """More room than usual, for a slice whose texts need it."""
        if states >= len(self.first):
            self.first = np.concatenate((self.first, np.zeros(states, np.int32)))
        if edges > len(self.piece):
            more = np.empty(edges, np.int32)
            self.cumulative = np.concatenate((self.cumulative, more.astype(np.float32)))
            self.before = np.concatenate((self.before, more))
            self.piece = np.concatenate((self.piece, more))

    def _full(self, chars: int, chunks: int) -> bool:
        """Whether so many new ones may not fit; a character ends a few pieces."""
        return (self.states + chars > STATES or self.edges + 4 * chars > EDGES
                or len(self.last) + chunks > CHUNKS)

    def sample(self, chunks: list[str], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward-sampled edge codes of all chunks in a row, and their number per chunk."""
        new = set(chunks).difference(self.last)
        if self._full(sum(map(len, new)), len(new)):
            self.clear()
            new = set(chunks)
        self.learn(sorted(new))
        n = len(chunks)
        state = np.fromiter(map(self.last.__getitem__, chunks), np.int64, n)
        who = np.arange(n)
        count = np.zeros(n, np.int64)
        steps, step = [], 0
        while len(who):
            at, drawn = self.first[state], uniform(seeds[who], step)
            behind = np.flatnonzero(self.cumulative[at] <= drawn)
            while len(behind):
                at[behind] += 1
                behind = behind[self.cumulative[at[behind]] <= drawn[behind]]
            steps.append((who, self.piece[at]))
            count[who] += 1
            state = self.before[at].astype(np.int64)
            going = state >= 0
            who, state = who[going], state[going]
            step += 1
        ends = np.cumsum(count)
        codes = np.empty(int(count.sum()), np.int32)
        for i, (who, made) in enumerate(steps):
            codes[ends[who] - 1 - i] = made
        return codes, count


def uniform(seeds: np.ndarray, step: int) -> np.ndarray:
    """Numbers in [0, 1) that depend on seed and step alone (a mixed counter)."""
    x = seeds + np.uint64((step + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(12)).astype(np.float64) * 2.0 ** -52


#: No piece has a space behind another character, and line feeds are single bytes.
CHUNK = re.compile(r"\n| *[^ \n]+| +")


def encode_rows(keys: list, texts: list[str | None], lattices: Lattices,
                seed: int) -> pa.ListArray:
    """Ids of each text; null for a null text."""
    chunks: list[str] = []
    held = np.zeros(len(texts), np.int64)
    row_seeds = np.zeros(len(texts), np.uint64)
    for i, (key, text) in enumerate(zip(keys, texts, strict=True)):
        row_seeds[i] = xxh64_intdigest(repr(key), seed)
        if text:
            own = CHUNK.findall(" " + text)
            chunks.extend(own)
            held[i] = len(own)
    first = np.cumsum(held) - held
    place = (np.arange(len(chunks)) - np.repeat(first, held)).astype(np.uint64)
    with np.errstate(over="ignore"):
        seeds = np.repeat(row_seeds, held) + place * np.uint64(0xD1B54A32D192ED03)
        codes, count = lattices.sample(chunks, seeds)
    offsets = np.concatenate(([0], np.cumsum(count)))[np.concatenate((first, [len(chunks)]))]
    odd = np.flatnonzero(codes >= lattices.pieces.size)
    if len(odd):
        spelled = [lattices.fallback[c - lattices.pieces.size] for c in codes[odd].tolist()]
        sizes = np.ones(len(codes), np.int64)
        sizes[odd] = [len(s) for s in spelled]
        starts = np.cumsum(sizes) - sizes
        longer = np.empty(int(sizes.sum()), np.int32)
        plain = codes < lattices.pieces.size
        longer[starts[plain]] = codes[plain]
        spread = np.repeat(starts[odd], sizes[odd])
        within = np.arange(len(spread)) - np.repeat(np.cumsum(sizes[odd]) - sizes[odd], sizes[odd])
        longer[spread + within] = np.concatenate(spelled)
        offsets = np.concatenate((starts, [len(longer)]))[offsets]
        codes = longer
    missing = np.array([t is None for t in texts] + [False])
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32), mask=missing),
                                    pa.array(codes))


class Spelling:
    """The bytes of all pieces in a row, for decoding many ids at once."""

    def __init__(self, pieces: Pieces) -> None:
        self.raw = pieces.raw
        self.size = np.array([-1 if r is None else len(r) for r in self.raw], np.int64)
        self.start = np.cumsum(np.maximum(self.size, 0)) - np.maximum(self.size, 0)
        self.blob = np.frombuffer(b"".join(r or b"" for r in self.raw), np.uint8)

    def decode(self, rows: pa.ListArray) -> pa.Array:
        """The text of each list of ids; null for null, unknown ids and broken UTF-8."""
        offsets = np.asarray(rows.offsets, np.int64)
        ids = np.asarray(rows.values)[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        if rows.values.null_count or len(ids) and (
                ids.min() < 0 or ids.max() >= len(self.size) or self.size[ids].min() < 0):
            return self._one_by_one(rows)
        size = self.size[ids]
        ends = np.cumsum(size)
        at = np.repeat(self.start[ids] - (ends - size), size) + np.arange(int(size.sum()))
        data = self.blob[at]
        bounds = np.concatenate(([0], ends))[offsets]
        full = bounds[1:] > bounds[:-1]  # these begin with the mark that encoding put first
        keep = np.ones(len(data), bool)
        keep[bounds[:-1][full]] = False
        sizes = np.diff(bounds) - full
        whole = data[keep].tobytes()
        places = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        try:
            whole.decode()
        except UnicodeDecodeError:
            return self._one_by_one(rows)
        known = None
        if rows.null_count:
            bits = np.packbits(np.asarray(rows.is_valid()), bitorder="little")
            known = pa.py_buffer(bits.tobytes())
        return pa.StringArray.from_buffers(
            len(rows), pa.py_buffer(places.tobytes()), pa.py_buffer(whole), known)

    def _one_by_one(self, rows: pa.ListArray) -> pa.Array:
        made = []
        for ids in rows.to_pylist():
            try:
                if ids is not None and any(i < 0 for i in ids):
                    raise IndexError
                made.append(None if ids is None
                            else b"".join(self.raw[i] for i in ids)[1:].decode())
            except (IndexError, TypeError, UnicodeDecodeError):
                made.append(None)
        return pa.array(made, pa.string())


_KNOWN: dict[tuple[str, float], Lattices] = {}
_SPELLINGS: dict[str, Spelling] = {}


def lattices_of(model: str, alpha: float) -> Lattices:
    """The worker's lattices, which later tasks of the same worker use again."""
    if (model, alpha) not in _KNOWN:
        _KNOWN[model, alpha] = Lattices(Pieces(model, alpha))
    return _KNOWN[model, alpha]


def encode(df: DataFrame, model: str, key: str = "doc_id", text: str = "text", seed: int = 0,
           alpha: float = 1.0) -> DataFrame:
    """(key, text, ids): a sampled segmentation of each whole text.

    Forward filtering gives each end position in the lattice of pieces the total weight of
    the ways to reach it; backward sampling draws a piece from each position in proportion.
    Random numbers depend on `seed`, the row's key, and the place in the text alone, so any
    run and any partitioning gives the same ids, and equal rows get equal ids. No piece
    crosses the start of a run of spaces, so the lattice is the product of its chunks'
    lattices, and a chunk that comes again is not filtered again. A larger `alpha` favours
    common and longer pieces. Null keys are one key; a null text has null ids, an empty one
    none. Other columns are not read. An empty table gives an empty one.
    """
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["key"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = lattices_of(model, alpha)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                ids = encode_rows(part.column("key").to_pylist(),
                                  part.column("text").to_pylist(), lattices, seed)
                yield pa.RecordBatch.from_arrays([*part.columns, ids],
                                                 names=["key", "text", "ids"])

    return (rows.mapInArrow(run, f"key {kind}, text string, ids array<int>")
            .withColumnsRenamed({"key": key, "text": text} if key != text else {}))


def _decodable(batch: pa.RecordBatch, ids: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about DECODED ids each, one row at least."""
    ends = np.asarray(batch.column(ids).offsets, np.int64)
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(ends, ends[start] + DECODED, side="right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def decode(df: DataFrame, model: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """`df` with the text of its ids; null where ids are null, unknown or no UTF-8."""
    if out in df.columns:
        raise ValueError(f"there is a column called {out}")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model not in _SPELLINGS:
            _SPELLINGS[model] = Spelling(Pieces(model, 1.0))
        spelling = _SPELLINGS[model]
        for batch in batches:
            for part in _decodable(batch, ids):
                texts = spelling.decode(part.column(ids))
                yield pa.RecordBatch.from_arrays([*part.columns, texts],
                                                 names=[*part.schema.names, out])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.StringType())]))
