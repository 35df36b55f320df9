import hashlib
import random

import pytest

from wicketflow.operators import target_stats as ts
from wicketflow.sources import html


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, c string, y double, other string")


def made_up(n=400):
    rng = random.Random(3)
    return [(i if i % 40 else 7, rng.choice(["hot"] * 8 + ["a", "b", None]),
             rng.choice([None, 1.0, 2.5, -4.0, 8.0]), "x") for i in range(n)]


def test_against_plain_loops(spark):
    rows = made_up()
    known = [r[2] for r in rows if r[2] is not None]
    mean = sum(known) / len(known)
    place = {i: hashlib.md5(f"|{i}".encode()).hexdigest() for i, *_ in rows}
    want = []
    for i, c, y, _ in rows:
        before = [r[2] for r in rows if r[1] == c and r[2] is not None and place[r[0]] < place[i]]
        want.append((i, str(c), str(y), (sum(before) + mean) / (len(before) + 1)))
    got = [(r.id, str(r.c), str(r.y), r.c_mean) for r in
           ts.ordered_target_mean(frame(spark, rows), "c", "y", ["id"]).collect()]
    for a, b in zip(sorted(got), sorted(want), strict=True):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3])


def test_a_row_does_not_see_its_own_target(spark):
    rows = [(i, "one" if i % 2 else f"own{i}", float(i), "x") for i in range(60)]
    code = {r.id: r.c_mean for r in ts.ordered_target_mean(
        frame(spark, rows), "c", "y", ["id"], mean=5.0).collect()}
    for changed in (1, 2, 31):
        moved = [(i, c, 1e6 if i == changed else y, x) for i, c, y, x in rows]
        again = {r.id: r.c_mean for r in ts.ordered_target_mean(
            frame(spark, moved), "c", "y", ["id"], mean=5.0).collect()}
        assert again[changed] == code[changed]
    assert all(code[i] == 5.0 for i in range(0, 60, 2))


def test_codes_for_rows_to_predict(spark):
    df = frame(spark, [(1, "a", 4.0, ""), (2, "a", None, ""), (3, None, 8.0, "")])
    mean = ts.prior(df, "y")
    means = ts.target_means(df, "c", "y", mean)
    new = frame(spark, [(1, "a", None, ""), (2, "new", None, ""), (3, None, None, "")])
    got = {r.id: r.c_mean for r in ts.apply_target_means(new, means, "c", mean).collect()}
    assert got == {1: 5.0, 2: 6.0, 3: 7.0}
    assert ts.prior(df.where("false"), "y") == 0.0
    assert ts.ordered_target_mean(df.where("false"), "c", "y", ["id"]).count() == 0


def test_links_of_any_form(spark):
    page = """<TITLE lang=en>T</TITLE><a href="/1">x</a><A class='b' HREF='/2'>x</A>
    <a data-x="a > b"
       href = /3>x</a><abbr href="/no"></abbr><a name="here">x</a><a href=''>x</a>
    <a data-href="/no" href="/4 5">x</a><link href="/no">"""
    df = spark.createDataFrame([("u", page)], "url string, html string")
    assert [(r.position, r.href, r.title) for r in html.page_links(df).collect()] == [
        (0, "/1", "T"), (1, "/2", "T"), (2, "/3", "T"), (3, "", "T"), (4, "/4 5", "T")]
