import random

import pytest

from tests.conftest import rows
from wicketflow.config import FeatureRules
from wicketflow.operators import features as ft
from wicketflow.operators.forecast import walk_forward
from wicketflow.operators.rolling import add_lagged_means, lagged_means, match_totals, number_rows


def expected_lags(data, windows):
    """Brute force: distinct values per match and key summed, then mean of the w previous."""
    sums = {}
    for match, key, value in data:
        if match is not None and key is not None:
            sums.setdefault((key, match), set()).add(value)
    totals = {k: sum(v for v in vs if v is not None) for k, vs in sums.items()}
    out = {}
    for key, match in totals:
        earlier = [totals[k, m] for k, m in sorted(totals, key=lambda x: x[1])
                   if k == key and m < match]
        out[match, key] = tuple(
            round(sum(earlier[-w:]) / w, 6) if len(earlier) >= w else None for w in windows)
    return out


@pytest.mark.parametrize("bits", [1, 3, 16])
def test_lags_for_every_slice_width(spark, bits):
    rng = random.Random(bits)
    # A hot key owns most rows; ids are sparse, so slices hold from none to many rows.
    data = [(rng.randrange(400), rng.choice(["hot"] * 6 + ["a", "b", None]),
             rng.choice([None, 1.0, 2.0, 5.0, 9.5])) for _ in range(600)]
    df = spark.createDataFrame(data, "matchid bigint, playername string, points double")
    windows = (2, 3, 5, 10)
    got = lagged_means(match_totals(df, "matchid", "playername", ["points"], "n"), "matchid",
                       "playername", ["points"], windows, bits, "n").collect()
    want = expected_lags(data, windows)
    assert {(r[0], r[1]): tuple(None if x is None else round(x, 6) for x in r[2:6])
            for r in got} == want
    for r in got:
        assert r["n"] == sum(1 for m, k, _ in data if k == r[1] and m is not None and m < r[0])


def test_lag_never_sees_its_own_match(spark):
    data = [(m, "p", float(10 ** m)) for m in range(6)]
    df = spark.createDataFrame(data, "matchid bigint, playername string, points double")
    got = rows(add_lagged_means(df, "matchid", "playername", ["points"], (2,)),
               "matchid", "points_playername_avg2")
    assert got == [(0, None), (1, None), (2, 5.5), (3, 55.0), (4, 550.0), (5, 5500.0)]


def test_equal_points_in_a_match_count_once_and_nulls_are_zero(spark):
    df = spark.createDataFrame(
        [(1, "v", 4.0), (1, "v", 4.0), (1, "v", 6.0), (2, "v", None), (3, "v", 1.0)],
        "matchid bigint, venue string, x double")
    assert rows(match_totals(df, "matchid", "venue", ["x"], "n")) == [
        (1, "v", 10.0, 3), (2, "v", 0.0, 1), (3, "v", 1.0, 1)]


@pytest.mark.parametrize("bits", [1, 4, 16])
def test_row_numbers(spark, bits):
    rng = random.Random(3)
    data = [(rng.randrange(100), rng.choice("ab"), i) for i in range(150)] + [(1, None, 999)]
    df = spark.createDataFrame(data, "matchid bigint, k string, i bigint")
    got = {r.i: (r.seq, r.size) for r in
           number_rows(df, "k", "matchid", ["i"], size="size", slice_bits=bits).collect()}
    for key in "ab":
        mine = sorted((m, i) for m, k, i in data if k == key)
        assert [got[i] for _, i in mine] == [(n + 1, len(mine)) for n in range(len(mine))]
    assert got[999][0] is None


def expected_forecast(series):
    out = [None] * len(series)
    n = len(series)
    for start in range(5, n, 5):
        train = series[start - 5:start] if n >= 20 else series[:start]
        x, y = train[:-1], train[1:]
        mx, my = sum(x) / len(x), sum(y) / len(y)
        var = sum((a - mx) ** 2 for a in x)
        if var == 0:
            values = [sum(train) / len(train)] * 5
        else:
            slope = max(-1.0, min(1.0, sum((a - mx) * (b - my) for a, b in zip(x, y)) / var))
            values, last = [], train[-1]
            for _ in range(5):
                last = my - slope * mx + slope * last
                values.append(last)
        for i in range(start, min(start + 5, n)):
            out[i] = values[i - start]
    return out


@pytest.mark.parametrize("size", [3, 5, 6, 12, 19, 20, 33])
def test_walk_forward_against_brute_force(spark, size):
    rng = random.Random(size)
    series = [float(rng.randrange(60)) for _ in range(size)]
    data = [(m * 3, "p", y) for m, y in enumerate(series)] + [(m, "flat", 7.0) for m in range(11)]
    df = spark.createDataFrame(data, "matchid bigint, playername string, total_points double")
    for bits in (2, 16):
        got = walk_forward(df, "playername", "matchid", "total_points", slice_bits=bits)
        mine = [r.ts_pred_points for r in got.filter("playername = 'p'").orderBy("matchid").collect()]
        assert mine == pytest.approx(expected_forecast(series))
        flat = got.filter("playername = 'flat'").orderBy("matchid").collect()
        assert [r.ts_pred_points for r in flat] == [None] * 5 + [7.0] * 6


def scored(spark, matches=30):
    rng = random.Random(9)
    data = []
    for m in range(matches):
        for p in range(6):
            side = f"T{p % 2}"
            bats = rng.random() < .8
            data.append((m, f"p{p}", "1" if bats else None, side if bats else None,
                         "T0" if side == "T1" else "T1", None if bats else "1",
                         None if bats else f"T{1 - p % 2}", None if bats else side,
                         float(rng.randrange(50)), float(rng.randrange(20)),
                         float(rng.randrange(70)), rng.randrange(8), rng.randrange(24), "Batsmen"))
    points = spark.createDataFrame(
        data, "matchid bigint, playername string, batsmen_innings string,"
        " batsmen_battingteam string, batsmen_bowlingteam string, bowlers_innings string,"
        " bowler_battingteam string, bowler_bowlingteam string, total_bat_points double,"
        " total_bowl_points double, total_points double, fallofwickets int,"
        " total_balls_bowled bigint, playing_role string")
    info = spark.createDataFrame(
        [(m, 2019, "Bangalore", ["M.Chinnaswamy Stadium", "Elsewhere"][m % 2], "T0", "T1",
          f"T{m % 2}") for m in range(matches)],
        "matchid bigint, year int, city string, venue string, team1 string, team2 string,"
        " toss_winner string")
    return points, info


def test_features_equal_the_single_steps(spark):
    points, info = scored(spark)
    rules = FeatureRules(slice_bits=3)
    whole = ft.features(points, info, rules=rules)
    steps = ft.add_lags(ft.add_match_count(ft.add_flags(ft.add_match_info(
        ft.add_teams(points), ft.clean_matches(info))), 3), rules)
    columns = sorted(whole.columns)
    assert columns == sorted(steps.columns)

    def digits(df):
        return [tuple(round(x, 6) if isinstance(x, float) else x for x in r)
                for r in rows(df, *columns)]
    assert digits(whole) == digits(steps)
    assert {r.venue for r in whole.collect()} == {"M Chinnaswamy Stadium", "Elsewhere"}
    assert {r.city for r in whole.collect()} == {"Bengaluru"}


def test_teams_flags_and_unknown_match(spark):
    points, info = scored(spark, 2)
    teamed = ft.add_teams(points)
    assert all(r.playing_team == f"T{int(r.playername[1]) % 2}" for r in teamed.collect())
    flags = ft.add_flags(ft.add_match_info(teamed, info.filter("matchid = 0")))
    assert {(r.home_game, r.toss_flag) for r in flags.filter("matchid = 1").collect()} == {(0, 0)}
    assert {(r.playing_team, r.home_game, r.toss_flag)
            for r in flags.filter("matchid = 0").collect()} == {("T0", 1, 1), ("T1", 0, 0)}


def test_team_renames_can_be_switched_off(spark):
    points, _ = scored(spark, 1)
    from pyspark.sql import functions as F

    from wicketflow.config import Cleaning
    old = points.withColumn("batsmen_battingteam", F.lit("Deccan Chargers")).withColumn(
        "batsmen_innings", F.lit("1"))
    assert {r.playing_team for r in ft.add_teams(old).collect()} == {"Sunrisers Hyderabad"}
    kept = ft.add_teams(old, Cleaning(rename_teams=False))
    assert {r.playing_team for r in kept.collect()} == {"Deccan Chargers"}


def test_lean_patch_is_zero_while_unknown(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0, 5.0, None), (1.0, 1.0, 1.0, 10.0)], ", ".join(
            f"total_points_playername_avg{w} double" for w in (2, 3, 5, 10)))
    got = ft.add_lean_patch(df).select("lean_patch_2", "lean_patch_3", "lean_patch_5").collect()
    assert [tuple(r) for r in got] == [(1, 0, 0), (0, 1, 1)]


def test_recent_squad_ranks_matches_per_team(spark):
    df = spark.createDataFrame(
        [(1, "old", "A", "Batsmen"), (5, "x", "A", "Batsmen"), (5, "y", "A", "Bowler"),
         (9, "x", "A", "Batsmen"), (2, "z", "B", "Batsmen"), (3, "n", None, "Batsmen")],
        "matchid bigint, playername string, playing_team string, playing_role string")
    got = ft.recent_squad(df)
    assert rows(got, "playername", "playing_team", "matchid") == [
        ("x", "A", 5), ("y", "A", 5), ("z", "B", 2)]
