"""Approximate nearest neighbours: multiprobe p-stable hashing."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from wicketflow.session import stage


@dataclass(frozen=True)
class Hashing:
    """`tables` tables of `hashes` projections each, cut into steps of `width`.

    Lengths are in units of the longest vector. A query visits buckets of a table in the
    order of their estimated success for a neighbour at distance `radius`, until the
    estimates add up to `mass`. For many more vectors take more `hashes`: buckets shrink,
    and the estimates, not a fixed number, decide how many are visited.
    """

    tables: int = 6
    hashes: int = 8
    width: float = 2.0
    radius: float = 1.1
    mass: float = 0.55
    seed: int = 1
    #: Rows that one task compares at once; larger buckets are split.
    shard_rows: int = 32_768

    def draw(self, dim: int) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng(self.seed)
        lines = rng.standard_normal((self.tables, self.hashes, dim))
        return lines, rng.uniform(0, self.width, (self.tables, self.hashes))


HASHING = Hashing()
#: Steps to either side of the query's own that a probe may take in one projection.
REACH = 4
SALTS = 64


def bucket_key(table: int, steps: np.ndarray) -> int:
    value = xxh64_intdigest(np.asarray(steps, np.int64).tobytes(), table)
    return value - (1 << 64) if value >> 63 else value


def probes(place: np.ndarray, width: float, radius: float, mass: float) -> Iterator[np.ndarray]:
    """Steps of the buckets to visit, the most promising first.

    `place` is a query's position in each projection, in steps. A neighbour at `radius` is
    off by a normal deviate in each projection, which gives each step its probability; a
    bucket's estimate is their product. Buckets are visited best first: each comes from the
    one with one step less in its last changed projection.
    """
    own = np.floor(place)
    offsets = np.arange(-REACH, REACH + 2)
    edges = (offsets[None, :] + own[:, None] - place[:, None]) * width / radius
    below = np.array([[0.5 * (1 + erf(x / sqrt(2))) for x in row] for row in edges])
    chance = np.diff(below, axis=1)
    order = np.argsort(-chance, axis=1, kind="stable")
    ranked = np.take_along_axis(chance, order, axis=1).tolist()
    steps = (own[:, None] + offsets[:-1][order]).astype(np.int64)
    n, choices, dims = len(place), len(offsets) - 1, np.arange(len(place))
    first = float(np.prod([r[0] for r in ranked]))
    heap = [(-first, (0,) * n, 0)]
    spent = 0.0
    while heap and spent < mass:
        estimate, ranks, last = heapq.heappop(heap)
        spent -= estimate
        yield steps[dims, list(ranks)]
        for i in range(last, n):
            r = ranks[i]
            if r + 1 < choices and ranked[i][r + 1] > 0:
                worse = estimate * ranked[i][r + 1] / ranked[i][r]
                heapq.heappush(heap, (worse, (*ranks[:i], r + 1, *ranks[i + 1:]), i))


def _usable(v: Column) -> Column:
    """Neither null nor zero, and of finite numbers alone."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0)


def vector_classes(df: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """(v, node, ids): distinct vectors with their k + 1 smallest keys, of which `node` is
    the first. No more keys of equal vectors can be among a query's k nearest. A vector
    that many rows share is thinned by salted ranks before its rows meet.
    """
    rows = df.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & _usable(F.col("v")))
    ranked = F.expr(f"row_number() over (partition by v, pmod(xxhash64(id), {SALTS}) order by id)")
    few = rows.withColumn("r", ranked).where(F.col("r") <= k + 1)
    ids = F.slice(F.array_sort(F.collect_set("id")), 1, k + 1)
    return few.groupBy("v").agg(ids.alias("ids")).withColumn("node", F.col("ids")[0])


def _cells(nodes: DataFrame, hashing: Hashing, dim: int, scale: float, query: bool) -> DataFrame:
    """(node, cell): a vector's bucket in each table, or all buckets that a query visits.

    Inner products become distances by one more coordinate: the rest of a candidate's
    squared length up to the longest one's; a query is stretched to that length instead.
    """
    lines, shifts = hashing.draw(dim + 1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = np.array(batch.column("v").to_pylist(), np.float64)
            size = np.linalg.norm(v, axis=1, keepdims=True)
            if query:
                v = np.concatenate((v / size, np.zeros_like(size)), axis=1)
            else:
                rest = np.sqrt(np.maximum(scale * scale - size * size, 0))
                v = np.concatenate((v, rest), axis=1) / scale
            places = (np.einsum("nd,tkd->tnk", v, lines) + shifts[:, None, :]) / hashing.width
            nodes_, cells = [], []
            ids = batch.column("node").to_pylist()
            for t in range(hashing.tables):
                for node, place in zip(ids, places[t]):
                    found = probes(place, hashing.width, hashing.radius, hashing.mass) if query \
                        else (np.floor(place).astype(np.int64),)
                    made = [bucket_key(t, steps) for steps in found]
                    cells += made
                    nodes_ += [node] * len(made)
            yield pa.RecordBatch.from_arrays([pa.array(nodes_, pa.int64()),
                                              pa.array(cells, pa.int64())], names=["node", "cell"])

    return nodes.select("node", "v").mapInArrow(run, "node long, cell long")


def _rerank(k: int):
    """Exact inner products of the queries of a shard with the candidates they visit."""
    out = pa.schema([("query", pa.int64()), ("node", pa.int64()), ("score", pa.float64())])

    def run(index: pa.Table, asked: pa.Table) -> pa.Table:
        made: list[tuple[int, int, float]] = []
        if index.num_rows and asked.num_rows:
            cells = index.column("place").to_numpy()
            by = np.argsort(cells, kind="stable")
            cells = cells[by]
            node = index.column("node").to_numpy()[by]
            data = np.array(index.column("v").to_pylist(), np.float64)[by]
            for query, places, v in zip(*(asked.column(c).to_pylist()
                                          for c in ("query", "places", "v")), strict=True):
                own = np.unique(np.array(places, np.int64))
                low = np.searchsorted(cells, own, side="left")
                size = np.searchsorted(cells, own, side="right") - low
                total = int(size.sum())
                if not total:
                    continue
                at = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(total)
                score = data[at] @ np.array(v, np.float64)
                # a vector stands in several buckets, at most one for each table
                names, first = np.unique(node[at], return_index=True)
                score = score[first]
                best = np.lexsort((names, -score))[:k + 1]
                made += zip([query] * len(best), names[best].tolist(), score[best].tolist())
        columns = list(zip(*made)) or [(), (), ()]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    return run


def _scan(k: int):
    """Exact inner products of some queries with all vectors of a block."""
    def run(block: pa.Table, asked: pa.Table) -> pa.Table:
        made: list[tuple[int, int, float]] = []
        if block.num_rows and asked.num_rows:
            node = block.column("node").to_numpy()
            data = np.array(block.column("v").to_pylist(), np.float64)
            for query, v in zip(*(asked.column(c).to_pylist() for c in ("query", "v")),
                                strict=True):
                score = data @ np.array(v, np.float64)
                best = np.lexsort((node, -score))[:k + 1]
                made += zip([query] * len(best), node[best].tolist(), score[best].tolist())
        columns = list(zip(*made)) or [(), (), ()]
        return pa.table([pa.array(c, f) for c, f in zip(
            columns, (pa.int64(), pa.int64(), pa.float64()))], names=["query", "node", "score"])

    return run


def _completed(best: DataFrame, query_nodes: DataFrame, nodes: DataFrame, k: int, count: int,
               hashing: Hashing) -> DataFrame:
    """`best` with the queries that found fewer than k others searched in all vectors.

    These few queries go to every block of vectors; blocks are of bounded size.
    """
    best = stage(best, "best")
    found = (best.join(nodes.select("node", F.size("ids").alias("n")), "node")
             .groupBy("query").agg(F.sum("n").alias("n")).where(F.col("n") > k))
    short = stage(query_nodes.join(found, F.col("node") == F.col("query"), "left_anti")
                  .select(F.col("node").alias("query"), "v"), "short")
    if short.isEmpty():
        return best
    blocks = max(1, -(-count // hashing.shard_rows))
    data = nodes.select(F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int").alias("block"),
                        "node", "v")
    asked = short.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
                         "query", "v")
    whole = (data.groupBy("block").cogroup(asked.groupBy("block"))
             .applyInArrow(_scan(k), "query long, node long, score double"))
    return best.join(short.select("query"), "query", "left_anti").unionByName(_ranked(whole, k))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k + 1 best of each query; of equal scores the smaller node."""
    return (found.withColumn("r", F.expr("row_number() over (partition by query"
                                         " order by score desc, node)"))
            .where(F.col("r") <= k + 1).select("query", "node", "score"))


def nearest(df: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding",
            k: int = 20, hashing: Hashing = HASHING) -> DataFrame:
    """(query_id, rank, key, score): the `k` largest inner products found for each query.

    Queries are the rows for which `is_query` (a condition on `df`) holds; candidates are
    all other rows. Ties go to the smaller key. Rows without a key, and vectors that are
    null, zero, of another length than most, or hold null or non-finite components, take no
    part. Equal vectors are searched for once. Repeated rows are one candidate and one
    query. A query whose buckets hold fewer than k candidates is searched in all vectors, so
    that k are returned, or all candidates if there are fewer; an empty table gives no rows.
    Other columns are not read.

    Every vector is in one bucket of each table. Buckets are dealt to shards by hash; one
    with over `shard_rows` vectors is split, and its queries go to each part.
    """
    usable = df.where(_usable(F.col(vector)) & F.col(key).isNotNull())
    lengths = usable.groupBy(F.size(vector).alias("d")).agg(F.count("*").alias("c"))
    top = lengths.orderBy(F.desc("c"), "d").first()
    empty = T.StructType([T.StructField("query_id", T.LongType()),
                          T.StructField("rank", T.IntegerType()),
                          T.StructField(key, T.LongType()), T.StructField("score", T.DoubleType())])
    if top is None:
        return df.sparkSession.createDataFrame([], empty)
    dim = top.d
    rows = usable.where(F.size(vector) == dim)
    nodes = stage(vector_classes(rows, key, vector, k), "vectors")
    asked = (rows.where(is_query).select(
        F.col(key).alias("query_id"), F.col(vector).cast("array<double>").alias("v"))
        .join(nodes.select("v", F.col("node").alias("query")), "v").select("query_id", "query")
        .distinct())
    asked = stage(asked, "queries")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    scale, count = nodes.agg(F.max(norm), F.count("*")).first()
    shards = max(1, -(-count // hashing.shard_rows)) * hashing.tables

    index = _cells(nodes, hashing, dim, scale, False)
    large = (index.groupBy("cell").agg(F.count("*").alias("c"))
             .where(F.col("c") > hashing.shard_rows)
             .select("cell", F.ceil(F.col("c") / hashing.shard_rows).cast("int").alias("parts")))
    parts = F.coalesce("parts", F.lit(1))

    def placed(cells: DataFrame, part: Column) -> DataFrame:
        cut = cells.join(large, "cell", "left").withColumn("part", part)
        place = F.xxhash64("cell", "part")
        return cut.select("node", place.alias("place"),
                          F.pmod(place, F.lit(shards)).cast("int").alias("shard"))

    own = placed(index, F.pmod(F.xxhash64("node"), parts).cast("int"))
    data = own.join(nodes.select("node", "v"), "node").select("shard", "place", "node", "v")
    query_nodes = nodes.join(asked.select(F.col("query").alias("node")).distinct(), "node",
                             "left_semi")
    visits = placed(_cells(query_nodes, hashing, dim, scale, True),
                    F.explode(F.sequence(F.lit(0), parts - 1)))
    wanted = (visits.groupBy("node", "shard").agg(F.collect_set("place").alias("places"))
              .join(query_nodes.select("node", "v"), "node")
              .select("shard", F.col("node").alias("query"), "places", "v"))
    found = (data.groupBy("shard").cogroup(wanted.groupBy("shard"))
             .applyInArrow(_rerank(k), "query long, node long, score double"))
    best = _ranked(found.groupBy("query", "node").agg(F.max("score").alias("score")), k)
    best = _completed(best, query_nodes, nodes, k, count, hashing)
    each = best.join(nodes.select("node", "ids"), "node").select(
        "query", "score", F.explode("ids").alias("id"))
    lists = each.groupBy("query").agg(F.slice(F.array_sort(F.collect_list(
        F.struct((-F.col("score")).alias("minus"), "id"))), 1, k + 1).alias("near"))
    return asked.join(lists, "query").select("query_id", F.posexplode(F.slice(F.filter(
        "near", lambda x: x["id"] != F.col("query_id")), 1, k)).alias("rank", "x")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("x.id").alias(key),
        (-F.col("x.minus")).alias("score"))
