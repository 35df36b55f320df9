"""SimHash near-dedup by the generalised pigeonhole principle."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from wicketflow.llm.common import append_columns
from wicketflow.llm.components import components
from wicketflow.session import stage

BITS = 64
SEED = 42
SHINGLE = 3
DISTANCE = 3
#: Fingerprints of a cell that are compared in one go; larger cells are cut into blocks.
BLOCK = 8192
#: Cost of moving a row, in compared pairs.
ROW_COST = 50.0
#: Numbers of partitions that are weighed against each other.
PARTITIONS = (2, 3, 4)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64 majority bits of the hashed shingles, as a signed integer; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1])).tolist()
    last = (ends - 1).tolist()[shingle - 1:] or [len(joined)]
    hashes = np.fromiter((xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts, last)),
                         np.uint64, len(last))
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    bits = 2 * ones.sum(axis=0, dtype=np.int64) > len(last)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprints(df: DataFrame, key: str, text: str, shingle: int = SHINGLE) -> DataFrame:
    """(key, fp) for each row."""
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    made = append_columns(rows, "text", lambda: lambda texts: [
        [fingerprint(t, shingle) for t in texts]], [T.StructField("fp", T.LongType())])
    return made.select("key", "fp")


def bit_counts(prints: DataFrame) -> np.ndarray:
    """How often each two bits are set together over all fingerprints, and their number.

    A 64 x 64 table for each partition, summed as a stream in a few tasks; what reaches the
    driver is one table for each of these.
    """

    def tables(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS + 1, BITS), np.float64)
        for batch in batches:
            fp = batch.column(0).to_numpy()
            bits = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1,
                                 bitorder="little").astype(np.float64)
            total[:BITS] += bits.T @ bits
            total[BITS, 0] += len(fp)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["table"])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS + 1, BITS), np.float64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                total += np.frombuffer(raw).reshape(BITS + 1, BITS)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["table"])

    few = prints.select("fp").mapInArrow(tables, "table binary").repartition(4)
    rows = few.mapInArrow(add, "table binary").collect()  # four rows of 33 kB
    return sum((np.frombuffer(r.table).reshape(BITS + 1, BITS) for r in rows),
               np.zeros((BITS + 1, BITS)))


def group_bits(counts: np.ndarray, parts: int) -> list[list[int]]:
    """Partitions of about equal width in which correlated bits stand together.

    Each partition starts with the two free bits that agree or disagree most and takes the
    bit with the largest mean correlation to it until it is full. What is correlated then
    shares a partition, and the partitions are as independent as can be.
    """
    n = max(counts[BITS, 0], 1.0)
    joint = counts[:BITS] / n
    p = np.diag(joint)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    related = np.abs((joint - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(related, 0)
    free, groups = list(range(BITS)), []
    for i in range(parts):
        width = len(free) // (parts - i)
        block = related[np.ix_(free, free)]
        a, b = np.unravel_index(int(np.argmax(block)), block.shape)
        chosen = [free[a], free[b]] if a != b else [free[0]]
        while len(chosen) < width:
            rest = [x for x in free if x not in chosen]
            chosen.append(rest[int(np.argmax(related[np.ix_(rest, chosen)].mean(axis=1)))])
        groups.append(sorted(chosen[:width]))
        free = [x for x in free if x not in groups[-1]]
    return groups


def part_value(fp: Column, bits: list[int]) -> Column:
    """The bits of a partition, as a mask on the fingerprint."""
    return fp.bitwiseAND(F.lit(mask_of(bits)).cast("long"))


def mask_of(bits: Iterable[int]) -> int:
    mask = sum(1 << b for b in bits)
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def ball(width: int, radius: int) -> int:
    return sum(math.comb(width, i) for i in range(radius + 1))


def allocate(pairs: list[float], widths: list[int], n: float,
             distance: int) -> tuple[float, list[int]]:
    """Thresholds with the least estimated cost, by dynamic programming over the partitions.

    Two fingerprints within `distance` agree within t_i bits in some partition i if the
    t_i + 1 add up to `distance` + 1; a threshold of -1 leaves a partition out. `pairs[i]` is
    the measured number of pairs with equal values in partition i; the estimate of candidates
    for a larger threshold adds the neighbouring values at mean density.
    """

    def cost(i: int, units: int) -> float:
        if not units:
            return 0.0
        probes = ball(widths[i], units - 1)
        return pairs[i] + n * n / 2 / 2.0 ** widths[i] * (probes - 1) + ROW_COST * n * probes

    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for i, width in enumerate(widths):
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (spent, chosen) in best.items():
            for units in range(min(distance + 1 - used, width + 1) + 1):
                total = spent + cost(i, units)
                if used + units not in step or total < step[used + units][0]:
                    step[used + units] = (total, [*chosen, units - 1])
        best = step
    return best[distance + 1]


def plan(prints: DataFrame, distance: int) -> list[tuple[list[int], int]]:
    """Partitions and thresholds for these fingerprints, from counts over all of them."""
    counts = bit_counts(prints)
    n = counts[BITS, 0]
    layouts = [group_bits(counts, m) for m in PARTITIONS]
    flat = [(k, i, bits) for k, groups in enumerate(layouts) for i, bits in enumerate(groups)]
    values = F.explode(F.array(*[
        F.struct(F.lit(j).alias("part"), part_value(F.col("fp"), bits).alias("value"))
        for j, (_, _, bits) in enumerate(flat)])).alias("x")
    equal = (prints.select(values).groupBy("x.part", "x.value").agg(F.count("*").alias("c"))
             .groupBy("part")
             .agg(F.sum(F.col("c").cast("double") * (F.col("c") - 1) / 2).alias("p")))
    pairs = {r.part: r.p for r in equal.collect()}  # one row for each partition
    options = []
    for k, groups in enumerate(layouts):
        own = [pairs.get(j, 0.0) for j, (kk, _, _) in enumerate(flat) if kk == k]
        spent, chosen = allocate(own, [len(g) for g in groups], n, distance)
        options.append((spent, list(zip(groups, chosen, strict=True))))
    return min(options, key=lambda o: o[0])[1]


def _neighbours(part: int, value: Column, flips: list[int]) -> Column:
    masks = F.array(*[F.lit(f).cast("long") for f in flips])
    return F.transform(masks, lambda f: F.struct(
        F.lit(part).alias("part"), value.bitwiseXOR(f).alias("value"),
        F.lit(True).alias("probe")))


def cells(prints: DataFrame, scheme: list[tuple[list[int], int]], block: int = BLOCK) -> DataFrame:
    """(part, value, pair, fp, probe): every fingerprint in its own cells, and as a probe in
    the cells within the partition's threshold.

    A cell of over `block` rows is cut into blocks, of which each two make one cell of their
    own (`pair`), so that no task compares more than two blocks at once.
    """
    fp = F.col("fp")
    homes, reach = [], []
    for part, (bits, radius) in enumerate(scheme):
        if radius < 0:
            continue
        homes.append(F.struct(F.lit(part).alias("part"), part_value(fp, bits).alias("value"),
                              F.lit(False).alias("probe")))
        flips = [mask_of(c) for r in range(1, radius + 1) for c in combinations(bits, r)]
        if flips:
            reach.append(_neighbours(part, part_value(fp, bits), flips))
    rows = prints.select("fp", F.explode(F.concat(F.array(*homes), *reach)).alias("x")).select(
        "x.part", "x.value", "fp", "x.probe")
    large = (rows.groupBy("part", "value").agg(F.count("*").alias("size"))
             .where(F.col("size") > block)
             .select("part", "value", F.ceil(F.col("size") / block).cast("int").alias("blocks")))
    cut = rows.join(large, ["part", "value"], "left")
    own = F.pmod(F.xxhash64("fp", F.lit(7)), F.coalesce("blocks", F.lit(1))).cast("int")
    others = F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)
    pair = F.transform(others, lambda j: F.least(j, own).cast("long") * 2**31 + F.greatest(j, own))
    return cut.select("part", "value", F.explode(pair).alias("pair"), "fp", "probe")


def cell_links(fp: np.ndarray, probe: np.ndarray, ends: np.ndarray,
               distance: int) -> list[np.ndarray]:
    """Links between rows of the same cell that join its groups, not every pair.

    Rows are sorted by cell; `ends` is the end of the cell of each row. Row i meets row
    i + shift for growing shifts. A pair whose rows are already joined is passed over, so a
    cell of close copies yields about as many links as rows.
    """
    n = len(fp)
    label = np.arange(n)
    left, right = [], []
    live = np.arange(n)
    shift = 1
    while len(live):
        live = live[live + shift < ends[live]]
        other = live + shift
        open_ = label[live] != label[other]
        i, j = live[open_], other[open_]
        both = ~(probe[i] & probe[j])
        i, j = i[both], j[both]
        near = np.bitwise_count((fp[i] ^ fp[j]).view(np.uint64)) <= distance
        i, j = i[near], j[near]
        if len(i):
            left.append(fp[i])
            right.append(fp[j])
            while True:
                low = np.minimum(label[i], label[j])
                if (label[i] == label[j]).all():
                    break
                np.minimum.at(label, label[i], low)
                np.minimum.at(label, label[j], low)
                while (deep := label[label] != label).any():
                    label[deep] = label[label[deep]]
        if shift & (shift - 1) == 0 and len(live):  # cells of one group are done
            breaks = np.add.accumulate(np.concatenate(([0], label[1:] != label[:-1])))
            live = live[breaks[ends[live] - 1] != breaks[live]]
        shift += 1
    return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right)]


def links(prints: DataFrame, scheme: list[tuple[list[int], int]], distance: int,
          block: int = BLOCK) -> DataFrame:
    """(a, b): verified links that connect all fingerprints within `distance` of each other."""
    placed = cells(prints, scheme, block)
    dealt = placed.repartition("part", "value", "pair").sortWithinPartitions(
        "part", "value", "pair", "fp")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(columns: list[np.ndarray]) -> pa.RecordBatch:
            part, value, pair, fp, probe = columns
            new = np.flatnonzero((part[1:] != part[:-1]) | (value[1:] != value[:-1])
                                 | (pair[1:] != pair[:-1])) + 1
            bounds = np.concatenate((new, [len(fp)]))
            ends = bounds[np.searchsorted(bounds, np.arange(len(fp)), side="right")]
            a, b = cell_links(fp, probe, ends, distance)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        held: list[np.ndarray] | None = None
        for batch in batches:
            new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            if not len(held[0]):
                continue
            tail = (held[0] == held[0][-1]) & (held[1] == held[1][-1]) & (held[2] == held[2][-1])
            whole = int(np.argmax(tail))  # the last cell may go on
            if whole:
                yield out([c[:whole] for c in held])
                held = [c[whole:] for c in held]
        if held is not None and len(held[0]):
            yield out(held)

    return dealt.mapInArrow(compare, "a long, b long")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text",
                    shingle: int = SHINGLE, distance: int = DISTANCE,
                    block: int = BLOCK) -> DataFrame:
    """(key, fingerprint, component_id) for each row of `df`.

    Rows link if their fingerprints differ in `distance` bits or fewer; component_id is the
    smallest key reachable. Equal fingerprints are one node from the start, so copies are
    never expanded into pairs. Null and empty texts, and texts of spaces, have fingerprint
    zero and link like any other. Rows without a key link too, but give no component its
    name; the component is null if no row has a key. Repeated rows are returned as often as
    they come. An empty table gives an empty one. Other columns are not read.
    """
    prints = stage(fingerprints(df, key, text, shingle), "prints")
    nodes = stage(prints.groupBy("fp").agg(F.min("key").alias("least")), "nodes")
    scheme = plan(nodes, distance)
    found = components(links(nodes, scheme, distance, block))
    named = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of = stage(named.join(names, "root").select("fp", "component_id"), "names")
    return prints.join(of, "fp").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id")
