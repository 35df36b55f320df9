import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wicketflow.llm import ann, queries

#: One bucket for all, so that the search is exact.
WHOLE = ann.Hashing(tables=1, hashes=1, width=1e6, mass=0.9, shard_rows=4)


def brute(rows, asked, k=20):
    """{query: [(key, score), ...]} of all usable rows."""
    data = {}
    for key, v in rows:
        ok = v is not None and key is not None and all(
            x is not None and math.isfinite(x) for x in v) and any(v)
        if ok:
            data[key] = np.array(v, np.float64)
    out = {}
    for q in data:
        if asked(q):
            found = sorted((-float(data[q] @ data[k_]), k_) for k_ in data if k_ != q)
            out[q] = [(key, -s) for s, key in found[:k]]
    return out


def lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_recall_over_the_whole_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/embeddings.parquet")
            .select("vec_id", "embedding").collect()]
    want = brute(rows, lambda q: q % 20 == 0)
    got = lists(queries.op2_nearest_neighbours(spark, small))
    assert set(got) == set(want)
    exact = dict(rows)
    hits = total = 0
    for q, near in got.items():
        assert len({key for key, _ in near}) == len(near) <= 20
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))
        for key, score in near:
            assert key != q
            assert score == pytest.approx(float(np.array(exact[q], np.float64)
                                                @ np.array(exact[key], np.float64)), abs=1e-12)
        hits += len({key for key, _ in near} & {key for key, _ in want[q]})
        total += len(want[q])
    assert hits >= 0.9 * total


@pytest.fixture(scope="module")
def odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 3)]) for i in range(60)]
    rows += [(i, [1.0, 2.0, 3.0]) for i in range(60, 100)]  # many equal vectors
    rows += [(100, None), (120, [0.0, 0.0, 0.0]), (140, [1.0, None, 2.0]), (None, [1.0, 1.0, 1.0]),
             (160, [math.nan, 1.0, 1.0]), (180, [math.inf, 1.0, 1.0]), rows[20], rows[60]]
    schema = "vec_id long, embedding array<double>"
    return rows, (spark.createDataFrame(rows, schema)
                  .withColumn("node", F.lit("x")).withColumn("cell", F.lit(1)))


def test_odd_vectors_ties_and_split_buckets(odd_vectors):
    rows, df = odd_vectors
    got = lists(ann.nearest(df, F.col("vec_id") % 20 == 0, hashing=WHOLE))
    assert got == brute(rows, lambda q: q % 20 == 0)


def test_fewer_candidates_and_empty_table(odd_vectors):
    rows, df = odd_vectors
    few = df.where("vec_id < 7")
    got = lists(ann.nearest(few, F.col("vec_id") == 0, hashing=WHOLE))
    assert got == brute([r for r in rows if r[0] is not None and r[0] < 7], lambda q: q == 0)
    assert ann.nearest(df.where("false"), F.lit(True)).count() == 0


def test_buckets_come_in_order_of_their_estimates():
    place = np.array([0.1, 0.6, -1.4])
    width, radius = 1.0, 0.8

    def estimate(steps):
        below = [[0.5 * (1 + math.erf((s + e - p) * width / radius / math.sqrt(2)))
                  for e in (0, 1)] for s, p in zip(steps, place)]
        return math.prod(b - a for a, b in below)

    found = [tuple(int(x) for x in s) for s in ann.probes(place, width, radius, 0.9)]
    made = [estimate(s) for s in found]
    assert len(set(found)) == len(found)
    assert all(a >= b - 1e-12 for a, b in zip(made, made[1:]))
    assert sum(made[:-1]) < 0.9 <= sum(made) + 1e-9
    every = sorted((estimate((a, b, c)) for a in range(-3, 4) for b in range(-3, 4)
                    for c in range(-5, 3)), reverse=True)
    assert made == pytest.approx(every[:len(made)])


@pytest.mark.parametrize("rows", [3, 12, 60])
def test_few_candidates_are_all_found(spark, rows):
    rng = np.random.default_rng(rows)
    data = [(i, rng.normal(size=64).tolist()) for i in range(rows)] + [(rows, [1.0] * 64)] * 2
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = ann.nearest(df, F.col("vec_id") % 20 == 0).collect()
    vectors = dict(data)
    for query in range(0, rows + 1, 20):
        own = sorted((r for r in got if r.query_id == query), key=lambda r: r.rank)
        assert len(own) == min(20, rows)
        assert len({r.vec_id for r in own} - {query}) == len(own)
        for r in own:
            assert r.score == pytest.approx(np.dot(vectors[query], vectors[r.vec_id]))
