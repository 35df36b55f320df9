"""Vector code compression: product codes by dual-tree Lloyd rounds in whole numbers."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wicketflow.llm.common import arrow_type
from wicketflow.session import stage

PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Whole numbers are floor(SCALE * x), held within +-LIMIT.
SCALE = 4096
LIMIT = 2.0 ** 50
#: Vectors of a block, which has a tree for each part; fewer where they are long.
BLOCK = 2048
#: Components of a block at most (a single vector may be longer).
BLOCK_VALUES = 1 << 18
#: Rows in a leaf of a tree at most.
LEAF = 16
#: Whole numbers up to this are exact in double precision.
EXACT = 2.0 ** 53
LARGEST = (1 << 63) - 1


def part_cuts(length: int, parts: int = PARTS) -> list[int]:
    """Where the parts of a vector begin and end; as equal as `length` allows."""
    return [length * p // parts for p in range(parts + 1)]


def node_cuts(rows: int, leaf: int = LEAF) -> list[np.ndarray]:
    """For each level of a tree, where its nodes begin and end among the ordered rows."""
    levels = [np.array([0, rows])]
    while np.diff(levels[-1]).max() > leaf:
        old = levels[-1]
        new = np.empty(2 * len(old) - 1, old.dtype)
        new[::2], new[1::2] = old, (old[:-1] + old[1:]) // 2
        levels.append(new)
    return levels


def ordered(values: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Rows in the order of a tree: nodes are halved at the median of their widest component."""
    order = np.arange(len(values))
    for cuts in node_cuts(len(values), leaf)[:-1] if values.shape[1] else []:
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            held = values[order[a:b]]
            widest = int(np.argmax(held.max(0) - held.min(0)))
            order[a:b] = order[a:b][np.argsort(held[:, widest], kind="stable")]
    return order


def combined(how: np.ufunc, values: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """`how` over the rows of each node, level by level from the root."""
    return np.concatenate([how.reduceat(values, cuts[:-1], axis=0) for cuts in levels])


@dataclass
class Node:
    """Entries of a codebook within a box; a node without children has one entry."""

    entries: np.ndarray
    low: np.ndarray
    high: np.ndarray
    children: tuple = ()


def entry_tree(book: np.ndarray, entries: np.ndarray | None = None) -> Node:
    entries = np.arange(len(book)) if entries is None else entries
    held = book[entries]
    node = Node(entries, held.min(0), held.max(0))
    if len(entries) > 1:
        if book.shape[1]:
            widest = int(np.argmax(node.high - node.low))
            entries = entries[np.argsort(held[:, widest], kind="stable")]
        half = len(entries) // 2
        node.children = (entry_tree(book, entries[:half]), entry_tree(book, entries[half:]))
    return node


def _least(low: np.ndarray, high: np.ndarray, box: Node) -> np.ndarray:
    """The least squared distance of a point of each box to a point of the node's."""
    gap = np.maximum(np.maximum(low - box.high, box.low - high), 0)
    return (gap * gap).sum(1)


def _greatest(low: np.ndarray, high: np.ndarray, box: Node) -> np.ndarray:
    reach = np.maximum(high - box.low, box.high - low)
    return (reach * reach).sum(1)


def candidates(low: np.ndarray, high: np.ndarray, root: Node,
               allowed: np.ndarray) -> np.ndarray:
    """Which of the allowed entries may be nearest to some point of each box.

    The entries' tree is walked from its root, a level at a time, with the boxes that still
    need a node. Some entry of a node is as near as the greatest distance between box and node,
    so a pair whose least distance is above the least such bound is pruned. Equal distances
    stay, since ties go to the lower index.
    """
    keep = np.zeros_like(allowed)
    bound = _greatest(low, high, root)
    level = [(root, np.arange(len(low)))]
    while level:
        held = []
        for node, rows in level:
            rows = rows[allowed[rows][:, node.entries].any(1)]
            bound[rows] = np.minimum(bound[rows], _greatest(low[rows], high[rows], node))
            held.append((node, rows))
        level = []
        for node, rows in held:
            rows = rows[_least(low[rows], high[rows], node) <= bound[rows]]
            if node.children:
                level += [(child, rows) for child in node.children]
            else:
                keep[rows, node.entries[0]] = True
    return keep & allowed


def distances(values: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of each row to each entry, exact for the numbers of `_numbers`."""
    return ((values * values).sum(1)[:, None] - 2 * (values @ book.T)
            + (book * book).sum(1)[None, :])


@dataclass
class Tree:
    """A part's rows in tree order, with the boxes and sums of all nodes."""

    levels: list[np.ndarray]
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sums: np.ndarray

    def assign(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nearest entry of each row; each entry's count and sum.

        From the root down: a node with one candidate left is assigned whole, with its cached
        sum; a leaf with more is decided by exact distances of its rows.
        """
        chosen = np.zeros(len(self.rows), np.int64)
        counts = np.zeros(len(book), np.int64)
        sums = np.zeros_like(book)
        root, first = entry_tree(book), 0
        nodes, allowed = np.array([0]), np.ones((1, len(book)), bool)
        for depth, cuts in enumerate(self.levels):
            at = first + nodes
            allowed = candidates(self.low[at], self.high[at], root, allowed)
            sole = allowed.sum(1) == 1
            for node, entry in zip(nodes[sole], allowed[sole].argmax(1), strict=True):
                chosen[cuts[node]:cuts[node + 1]] = entry
                counts[entry] += cuts[node + 1] - cuts[node]
                sums[entry] += self.sums[first + node]
            nodes, allowed = nodes[~sole], allowed[~sole]
            if not len(nodes):
                break
            if depth + 1 < len(self.levels):
                first += len(cuts) - 1
                nodes = np.concatenate([2 * nodes, 2 * nodes + 1])
                allowed = np.concatenate([allowed, allowed])
            else:
                self._decide(book, cuts, nodes, allowed, chosen, counts, sums)
        return chosen, counts, sums

    def _decide(self, book, cuts, nodes, allowed, chosen, counts, sums) -> None:
        sizes = cuts[nodes + 1] - cuts[nodes]
        within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        rows = np.repeat(cuts[nodes], sizes) + within
        far = distances(self.rows[rows], book)
        far = np.where(np.repeat(allowed, sizes, axis=0), far, far.max() + 1)
        chosen[rows] = picked = far.argmin(1)
        counts += np.bincount(picked, minlength=len(book))
        np.add.at(sums, picked, self.rows[rows])


def _numbers(values: np.ndarray, rows: int, width: int, largest: float) -> np.ndarray:
    """Whole numbers as doubles if distances and sums stay exact in them, else as integers."""
    if max(8 * width * largest * largest, rows * largest) < EXACT:
        return values.astype(np.float64)
    return values.astype(np.int64).astype(object)


class Block:
    """A stored block: the trees of all parts, read with codebooks of the same length."""

    def __init__(self, row: dict, books: list[np.ndarray]) -> None:
        length, self.size = row["length"], row["size"]
        values = np.frombuffer(row["values"], "<i4" if row["narrow"] else "<f8")
        values = values.reshape(self.size, length)
        self.order = np.frombuffer(row["orders"], "<u2").reshape(len(books), self.size)
        self.books, self.trees = [], []
        cuts, levels = part_cuts(length, len(books)), node_cuts(self.size)
        nodes = sum(len(c) - 1 for c in levels)
        low, high = (np.frombuffer(row[x], "<f8").reshape(nodes, length) for x in ("low", "high"))
        sums = np.frombuffer(row["sums"], "<f8").reshape(nodes, length) if row["sums"] else None
        largest = max([float(np.abs(x).max(initial=0)) for x in (low, high)]
                      + [float(max(map(abs, b.ravel()), default=0)) for b in books])
        for p, book in enumerate(books):
            a, b = cuts[p], cuts[p + 1]
            def told(x: np.ndarray) -> np.ndarray:
                return _numbers(x, self.size, b - a, largest)
            placed = told(values[self.order[p], a:b])
            self.books.append(told(book))
            self.trees.append(Tree(
                levels, placed, told(low[:, a:b]), told(high[:, a:b]),
                combined(np.add, placed, levels) if sums is None else told(sums[:, a:b])))


def _block(length: int, vectors: np.ndarray, parts: int) -> dict:
    values = np.clip(np.floor(np.clip(vectors, -LIMIT, LIMIT) * float(SCALE)), -LIMIT, LIMIT)
    levels, cuts = node_cuts(len(values)), part_cuts(length, parts)
    orders = [ordered(values[:, a:b]) for a, b in zip(cuts, cuts[1:])]
    largest = np.abs(values).max(initial=0)

    def nodes(how: np.ufunc) -> bytes:
        return np.concatenate([combined(how, values[o, a:b], levels) for o, a, b
                               in zip(orders, cuts, cuts[1:])], axis=1).astype("<f8").tobytes()

    narrow = bool(largest < 2 ** 31)
    return {"length": length, "size": len(values), "narrow": narrow,
            "values": values.astype("<i4" if narrow else "<f8").tobytes(),
            "orders": np.array(orders).astype("<u2").tobytes(),
            "low": nodes(np.minimum), "high": nodes(np.maximum),
            "sums": nodes(np.add) if largest * len(values) < EXACT else None}


_STORED = ("length int, size int, narrow boolean, values binary, orders binary, low binary,"
           " high binary, sums binary")


def _store(rows: DataFrame, parts: int) -> DataFrame:
    """Blocks of rows of (key, label, vector); a block holds vectors of one length."""
    kinds = [rows.schema["key"].dataType, rows.schema["label"].dataType]
    schema = T.StructType([T.StructField("keys", T.ArrayType(kinds[0])),
                           T.StructField("labels", T.ArrayType(kinds[1]))]
                          + T.StructType.fromDDL(_STORED).fields)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.array(pc.list_value_length(batch.column("vector")))
            for length in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == length)
                step = max(1, min(BLOCK, BLOCK_VALUES // max(length, 1)))
                for start in range(0, len(at), step):
                    part = batch.take(pa.array(at[start:start + step]))
                    vectors = np.array(pc.list_flatten(part.column("vector")), np.float64)
                    made = _block(length, vectors.reshape(part.num_rows, length), parts)
                    ends = pa.array([0, part.num_rows], pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.ListArray.from_arrays(ends, part.column(c)) for c in ("key", "label")]
                        + [pa.array([made[f.name]], arrow_type(f.dataType))
                           for f in schema.fields[2:]], names=schema.names)

    return stage(rows.mapInArrow(cut, schema), "blocks")


Books = dict[int, list[np.ndarray]]


def _sums(books: Books) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A pass of the assigning step: each task's counts and sums by entry and component."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[int, int, int], int] = {}
        totals: dict[tuple[int, int, int], np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, books[row["length"]])
                for p, (tree, book) in enumerate(zip(block.trees, block.books, strict=True)):
                    _, number, sums = tree.assign(book)
                    for e in np.flatnonzero(number).tolist():
                        key = (row["length"], p, e)
                        exact = sums[e].astype(np.int64).astype(object) \
                            if sums.dtype != object else sums[e]
                        counts[key] = counts.get(key, 0) + int(number[e])
                        totals[key] = totals[key] + exact if key in totals else exact
        flat = [(*key, place, counts[key], Decimal(int(total)))
                for key, held in totals.items() for place, total in enumerate(held.tolist())]
        columns = list(zip(*flat, strict=True)) or [()] * 6
        kinds = [pa.int32()] * 4 + [pa.int64(), pa.decimal128(38, 0)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["length", "part", "entry", "place", "rows", "total"])

    return run


def _improved(blocks: DataFrame, books: Books) -> Books:
    """One round: assign, then replace each used entry by its rows' floored mean."""
    made = (blocks.drop("keys", "labels").mapInArrow(
                _sums(books), "length int, part int, entry int, place int, rows long,"
                              " total decimal(38,0)")
            .groupBy("length", "part", "entry", "place")
            .agg(F.sum("rows").alias("rows"), F.sum("total").alias("total")))
    new = {length: [b.copy() for b in held] for length, held in books.items()}
    for r in made.collect():
        new[r.length][r.part][r.entry, r.place] = int(r.total) // r.rows
    return new


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components in decimal, by part, entry and place."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel())
                          .encode()).hexdigest()


def _coded(blocks: DataFrame, books: Books, kinds: list[T.DataType]) -> DataFrame:
    digests = {length: digest(held) for length, held in books.items()}
    schema = T.StructType([T.StructField("key", kinds[0]), T.StructField("label", kinds[1]),
                           *T.StructType.fromDDL(
                               "code string, error long, codebooks_sha256 string").fields])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.drop_columns(["keys", "labels"]).to_pylist()):
                block = Block(row, books[row["length"]])
                codes = np.empty((block.size, len(block.trees)), np.uint8)
                errors = np.zeros(block.size, object)
                for p, (tree, book) in enumerate(zip(block.trees, block.books, strict=True)):
                    chosen = tree.assign(book)[0]
                    gap = tree.rows - book[chosen]
                    codes[block.order[p], p] = chosen
                    errors[block.order[p]] += (gap * gap).sum(1).astype(object)
                yield pa.RecordBatch.from_arrays([
                    batch.column("keys")[i].values, batch.column("labels")[i].values,
                    pa.array([c.tobytes().hex() for c in codes], pa.string()),
                    pa.array([min(int(e), LARGEST) for e in errors], pa.int64()),
                    pa.array([digests[row["length"]]] * block.size, pa.string())],
                    names=schema.names)

    return blocks.mapInArrow(run, schema)


def compress(df: DataFrame, key: str = "vec_id", vector: str = "embedding",
             label: str = "label", parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS) -> DataFrame:
    """One row for each kept vector: key, code, error, label_error, codebooks_sha256.

    Vectors that are null or hold null or non-finite components are dropped. Components become
    floor(4096 * x) (within +-2**50); each of `parts` consecutive parts has a codebook of
    `entries` entries, at most 256: at first the parts of the smallest keys (null keys last; of
    equal keys the smaller vector first), then improved in `rounds` rounds of assigning and
    averaging with floors. `code` names the entries with two hex digits each. `error` is the sum
    of squared distances, `label_error` its sum over rows of the same label (null labels
    together); both stop at the largest long.

    Vectors are written once, as blocks with a tree for each part whose nodes keep box and sum.
    A round is one pass over the blocks, and gives the driver a count and a sum for each entry
    and component: a codebook's size, whatever the input holds. Vectors of different lengths
    have codebooks of their own, whose digest their rows carry; the lengths are taken to be few.
    A length that `parts` does not divide is cut as equally as can be. Fewer vectors than
    entries make as many entries as vectors; repeated rows and ties are rows like others; an
    empty table gives no rows; other columns are not read.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    rows = (df.select(F.col(key).alias("key"), F.col(label).alias("label"),
                      F.col(vector).cast("array<double>").alias("vector"))
            .where("vector is not null and forall(vector, x -> x is not null and not isnan(x)"
                   " and abs(x) < double('infinity'))"))
    kinds = [rows.schema["key"].dataType, rows.schema["label"].dataType]
    blocks = _store(rows, parts)
    order = Window.partitionBy("length").orderBy(F.col("key").asc_nulls_last(), "vector")
    first = (rows.withColumn("length", F.size("vector"))
             .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= entries)
             .select("length", "rank", "vector").collect())
    books: Books = {}
    for length in {r.length for r in first}:
        held = [r.vector for r in sorted((r for r in first if r.length == length),
                                         key=lambda r: r.rank)]
        whole = np.floor(np.clip(np.array(held, float).reshape(len(held), length),
                                 -LIMIT, LIMIT) * float(SCALE))
        whole = np.clip(whole, -LIMIT, LIMIT).astype(np.int64).astype(object)
        cuts = part_cuts(length, parts)
        books[length] = [whole[:, a:b] for a, b in zip(cuts, cuts[1:])]
    for _ in range(rounds):
        books = _improved(blocks, books)
    coded = stage(_coded(blocks, books, kinds), "codes")
    totals = stage(coded.groupBy("label").agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")),
                F.lit(LARGEST).cast("decimal(38,0)")).cast("long").alias("label_error")), "totals")
    return (coded.alias("c").join(totals.alias("t"), F.expr("c.label <=> t.label"))
            .select(F.col("c.key").alias(key), "c.code", "c.error", "t.label_error",
                    "c.codebooks_sha256"))
