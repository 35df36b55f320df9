import random

import numpy as np

from tests.llm import brute
from wicketflow.llm import queries, simhash
from wicketflow.llm.components import components


def test_whole_table(spark, small, documents):
    got = sorted(tuple(r) for r in queries.op3_simhash_near_dedup(spark, small).collect())
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    assert got == sorted(brute.near_duplicates(docs))
    assert len({r[2] for r in got}) < len(got)


def test_odd_rows(odd):
    got = [tuple(r) for r in simhash.near_duplicates(odd).collect()]
    want = brute.near_duplicates([(r.doc_id, r.text) for r in odd.collect()])
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_table(odd):
    assert simhash.near_duplicates(odd.where("false")).count() == 0


def prints(seed, n, flips, groups):
    """Fingerprints in groups of close copies: chains whose ends are far apart, and dense ones."""
    rng = random.Random(seed)
    made = []
    for _ in range(groups):
        fp = rng.getrandbits(64)
        for _ in range(n):
            made.append(fp)
            near = fp
            for _ in range(rng.randint(0, flips)):
                near ^= 1 << rng.randrange(64)
            made.append(near)
            if rng.random() < 0.3:
                fp = near
    return sorted({x - (1 << 64) if x >> 63 else x for x in made})


def groups(values, links):
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {v: root(v) for v in values}


def close(values, distance):
    arr = np.array(values, np.int64)
    return [(values[i], values[int(j)]) for i in range(len(arr))
            for j in np.flatnonzero(np.bitwise_count((arr ^ arr[i]).view(np.uint64)) <= distance)]


def test_every_scheme_finds_the_same_groups(spark):
    values = prints(1, 25, 4, 12)
    df = spark.createDataFrame([(v, v) for v in values], "fp long, least long")
    want = groups(values, close(values, 3))
    counts = simhash.bit_counts(df)
    assert counts[64, 0] == len(values)
    for parts, radii in ((4, [0, 0, 0, 0]), (4, [1, 0, 0, -1]), (3, [1, 0, 0]), (2, [2, 0]),
                         (2, [1, 1])):
        scheme = list(zip(simhash.group_bits(counts, parts), radii))
        assert sorted(b for g, _ in scheme for b in g) == list(range(64))
        for block in (8192, 7):
            found = simhash.links(df, scheme, 3, block).collect()
            assert all((r.a ^ r.b).bit_count() <= 3 if r.a ^ r.b >= 0 else True for r in found)
            assert groups(values, [(r.a, r.b) for r in found]) == want


def test_dense_cell_yields_few_links():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62)
    fps = np.unique(base ^ (1 << rng.integers(0, 62, 4000)))
    ends = np.full(len(fps), len(fps))
    a, b = simhash.cell_links(fps, np.zeros(len(fps), bool), ends, 3)
    assert len(a) < 3 * len(fps)
    assert len(set(groups(fps.tolist(), zip(a.tolist(), b.tolist())).values())) == 1


def test_allocation_fulfils_the_pigeonhole():
    for pairs in ([10, 10, 10, 10], [1e12, 5, 5, 5], [0, 0, 1e9, 1e9]):
        _, chosen = simhash.allocate(pairs, [16] * 4, 1e5, 3)
        assert sum(t + 1 for t in chosen) == 4
    assert simhash.allocate([1e12, 5, 5, 5], [16] * 4, 1e3, 3)[1][0] == -1


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(60)] + [(100, j) for j in range(101, 140)]
    edges += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    edges += [(7, 7), (3, 2), (3, 2)]
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    got = {r.node: r.root for r in rows}
    assert len(rows) == len(got)
    nodes = sorted({x for e in edges for x in e})
    assert got == {k: v for k, v in groups(nodes, edges).items() if k in got}
    assert set(got) >= {x for a, b in edges if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
