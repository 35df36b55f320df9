import hashlib
import math
import random

import numpy as np
import pytest

from wicketflow.llm import codes, queries


def plain(rows, parts=8, entries=16, rounds=6):
    """Lloyd rounds with lists of Python integers; rows of (key, vector, label), one length."""
    rows = [r for r in rows if r[1] is not None
            and all(x is not None and math.isfinite(x) for x in r[1])]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not rows:
        return []
    size = len(rows[0][1])
    cuts = [size * p // parts for p in range(parts + 1)]
    whole = [[math.floor(4096 * x) for x in r[1]] for r in rows]
    held = [[w[a:b] for w in whole] for a, b in zip(cuts, cuts[1:])]
    books = [[list(v) for v in h[:entries]] for h in held]

    def nearest(v, book):
        return min((sum((x - y) ** 2 for x, y in zip(v, b)), e) for e, b in enumerate(book))

    for _ in range(rounds):
        for h, book in zip(held, books):
            at = [nearest(v, book)[1] for v in h]
            for e in range(len(book)):
                mine = [v for v, a in zip(h, at) if a == e]
                if mine:
                    book[e] = [sum(c) // len(mine) for c in zip(*mine)]
    last = [[nearest(v, book) for v in h] for h, book in zip(held, books)]
    sha = hashlib.sha256(",".join(str(x) for book in books for b in book for x in b)
                         .encode()).hexdigest()
    errors = [sum(part[i][0] for part in last) for i in range(len(rows))]
    by_label = {}
    for r, e in zip(rows, errors):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    return [(r[0], "".join(f"{part[i][1]:02x}" for part in last), errors[i], by_label[r[2]], sha)
            for i, r in enumerate(rows)]


def same(df, expected):
    key = lambda r: tuple((v is None, v or 0) for v in r)
    assert sorted((tuple(r) for r in df.collect()), key=key) == sorted(expected, key=key)


def test_whole_table(spark, small):
    rows = [(r.vec_id, r.embedding, r.label)
            for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    same(queries.op13_vector_codes(spark, small), plain(rows))


SCHEMA = "vec_id long, embedding array<double>, label int, code string, key int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


@pytest.mark.parametrize("seed", range(4))
def test_clusters_ties_and_odd_rows(spark, seed):
    rng = random.Random(seed)
    centres = [[rng.choice([0.0, 0.5, -1.0, 2.0]) for _ in range(16)] for _ in range(20)]
    rows = [(i if i % 9 else i // 2, [c + rng.choice([0, 0, 0.001, -0.3]) for c in
                                      rng.choice(centres)], rng.choice([None, 1, 2]))
            for i in range(500)]
    rows += rows[:5] + [(None, [0.25] * 16, 1), (7, None, 1), (8, [None] * 16, 2),
                        (9, [float("nan")] * 16, 2), (10, [float("inf")] + [0.0] * 15, None)]
    same(codes.compress(frame(spark, rows).repartition(3)), plain(rows))


def test_few_uneven_empty_and_large_vectors(spark):
    few = [(i, [i / 3] * 8, None) for i in range(5)]
    same(codes.compress(frame(spark, few)), plain(few))
    uneven = [(i, [math.sin(i * j) for j in range(11)], i % 3) for i in range(90)]
    same(codes.compress(frame(spark, uneven)), plain(uneven))
    short = [(i, [math.sin(i * j) for j in range(3)], i % 3) for i in range(40)]
    same(codes.compress(frame(spark, short)), plain(short))
    same(codes.compress(frame(spark, [(1, [], 1), (2, [], 1)])), plain([(1, [], 1), (2, [], 1)]))
    assert codes.compress(frame(spark, uneven).where("false")).count() == 0
    large = [(i, [math.sin(i * j) * 2.0 ** 16 for j in range(16)], i % 3) for i in range(90)]
    same(codes.compress(frame(spark, large)), plain(large))


def test_lengths_do_not_mix(spark):
    one = [(i, [math.cos(i + j) for j in range(8)], 1) for i in range(60)]
    two = [(100 + i, [math.cos(i * j) for j in range(16)], 2) for i in range(60)]
    same(codes.compress(frame(spark, one + two)), plain(one) + plain(two))


def test_errors_stop_at_the_largest_long(spark):
    rows = [(i, [1e300 if i == j else -1e200 for j in range(8)], 1) for i in range(40)]
    got = codes.compress(frame(spark, rows)).collect()
    assert len(got) == 40 and all(0 <= r.error <= r.label_error <= codes.LARGEST for r in got)


def test_pruning_is_sound_and_prunes():
    rng = np.random.default_rng(5)
    values = np.floor(rng.normal(size=(600, 4)) * 50 + rng.integers(0, 6, (600, 1)) * 400)
    book = values[:16].copy()
    levels = codes.node_cuts(600)
    placed = values[codes.ordered(values)]
    tree = codes.Tree(levels, placed, *(codes.combined(u, placed, levels)
                                        for u in (np.minimum, np.maximum, np.add)))
    chosen, counts, sums = tree.assign(book)
    far = ((placed[:, None, :] - book[None]) ** 2).sum(2)
    assert (chosen == far.argmin(1)).all()
    assert (counts == np.bincount(chosen, minlength=16)).all()
    assert all((sums[e] == placed[chosen == e].sum(0)).all() for e in range(16))
    kept = codes.candidates(tree.low, tree.high, codes.entry_tree(book),
                            np.ones((len(tree.low), 16), bool))
    assert kept[-32:].mean() < 0.5
