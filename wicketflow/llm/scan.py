"""Running values along keys of any size: local scans, then carries between partitions."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wicketflow.session import stage


@dataclass(frozen=True)
class Law:
    """How values combine along a key.

    A run of n values x0, x1 ... is the pair (n, x0 + x1 base + x2 base^2 ... mod modulus), and
    two runs that follow each other combine to (n + m, v + base^n w mod modulus). Without a
    modulus (0) values are added up.
    """

    base: int = 1
    modulus: int = 0

    def power(self, n: int) -> int:
        return pow(self.base, n, self.modulus) if self.modulus else 1

    def combine(self, n: int, v: int, w: int) -> int:
        whole = v + self.power(n) * w
        return whole % self.modulus if self.modulus else whole

    def running(self, values: np.ndarray, place: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Values of the runs so far; `place` counts within a key from 0, `begin` is its row."""
        if self.modulus:
            powers = np.ones(1, np.int64)
            while len(powers) <= place.max(initial=0):
                powers = np.concatenate(
                    [powers, powers * self.power(len(powers)) % self.modulus])
            values = values * powers[place] % self.modulus
        total = np.cumsum(values)
        total -= (total - values)[begin]
        return total % self.modulus if self.modulus else total


def running(df: DataFrame, key: str, order: list[Column], laws: dict[str, Law],
            name: str = "scan") -> DataFrame:
    """`df` with `place` (from 1 within a key) and the columns of `laws` as running values.

    Keys are longs without nulls, and values longs below the modulus. Rows are dealt by ranges
    of key and `order`, so that a key of any size is spread over tasks; ties must not matter.
    Each task scans its rows; what the first and the last key of each partition come to is
    folded on the driver (two rows a partition) and carried into the partitions after it.
    """
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([f for f in df.schema.fields] + T.StructType.fromDDL(
        "place long, __part int, __edge boolean").fields)
    columns = df.columns

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        first, last = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key).to_numpy()
            row = np.arange(len(keys))
            begin = np.maximum.accumulate(np.where(np.r_[True, keys[1:] != keys[:-1]], row, 0))
            place = row - begin
            goes_on = last is not None and last[0] == keys[0]
            mine = begin == 0
            made = {c: law.running(batch.column(c).to_numpy(), place, begin)
                    for c, law in laws.items()}
            if goes_on:
                for c, law in laws.items():
                    ahead = last[2][c] + law.power(last[1]) * made[c][mine]
                    made[c][mine] = ahead % law.modulus if law.modulus else ahead
                place = place + np.where(mine, last[1], 0)
            if first is None or first[0] == keys[0]:
                first = _state(keys, place, made, int(mine.sum()) - 1)
            last = _state(keys, place, made, len(keys) - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(made[c]) if c in laws else batch.column(c) for c in columns]
                + [pa.array(place + 1), pa.array(np.full(len(keys), part, np.int32)),
                   pa.array(np.zeros(len(keys), bool))], names=schema.names)
            kinds = batch.schema
        if first is not None:
            both = [first, last]
            yield pa.RecordBatch.from_arrays(
                [pa.array([s[0] for s in both]) if c == key
                 else pa.array([s[2][c] for s in both]) if c in laws
                 else pa.nulls(2, kinds.field(c).type) for c in columns]
                + [pa.array([s[1] for s in both]), pa.array([part] * 2, pa.int32()),
                   pa.array([True] * 2)], names=schema.names)

    loose = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    dealt = df.repartitionByRange(tasks, F.col(key), *order).sortWithinPartitions(
        F.col(key), *order)
    made = stage(dealt.mapInArrow(scan, loose), name)
    edges = made.where("__edge").select("__part", key, "place", *laws).collect()
    carried = fold([tuple(r) for r in edges], list(laws.values()))
    rows = made.where("not __edge").drop("__edge")
    if not carried:
        return rows.drop("__part")
    given = [(part, k, n, [law.power(n) for law in laws.values()], v)
             for part, (k, n, v) in carried.items()]
    table = spark.createDataFrame(
        given, "__part int, __key long, __n long, __power array<long>, __value array<long>")
    joined = rows.join(F.broadcast(table), (rows["__part"] == table["__part"])
                       & (rows[key] == table["__key"]), "left").drop(table["__part"])
    new = {}
    for i, (c, law) in enumerate(laws.items()):
        ahead = F.col("__value")[i] + F.col("__power")[i] * F.col(c)
        ahead = ahead % law.modulus if law.modulus else ahead
        new[c] = F.when(F.col("__n").isNull(), F.col(c)).otherwise(ahead)
    new["place"] = F.col("place") + F.coalesce("__n", F.lit(0))
    return joined.withColumns(new).select(*columns, "place")


def _state(keys: np.ndarray, place: np.ndarray, made: dict, row: int) -> tuple:
    return int(keys[row]), int(place[row]) + 1, {c: int(v[row]) for c, v in made.items()}


def fold(edges: list[tuple], laws: list[Law]) -> dict[int, tuple]:
    """For each partition that goes on with a key, the key and what comes before.

    `edges` holds (partition, key, count, value ...) of the first and the last key of each
    partition that has rows.
    """
    parts: dict[int, list[tuple]] = {}
    for part, k, n, *v in edges:
        parts.setdefault(part, []).append((k, n, v))
    carried, before = {}, None
    for part in sorted(parts):
        first, last = min(parts[part]), max(parts[part])
        if before and before[0] == first[0]:
            carried[part] = before
            k, n, v = before
            whole = (k, n + first[1],
                     [law.combine(n, x, y) for law, x, y in zip(laws, v, first[2], strict=True)])
            last = whole if last[0] == first[0] else last
        before = last
    return carried
