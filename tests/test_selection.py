import numpy as np
import pytest
from pyspark.sql import functions as F

from wicketflow.config import RoleLimits, SelectionLimits
from wicketflow.operators import selection as sel

LIMITS = SelectionLimits()
DDL = ("matchid bigint, playername string, playing_role string, playing_team string,"
       " playercost double, pred_points double")
ROLES = ("Batsmen", "Bowler", "AllRounder", "Umpire")


def brute_force(points, steps, roles, slots, limits):
    """Every subset."""
    n = len(points)
    bits = (np.arange(1 << n)[:, None] >> np.arange(n)) & 1
    count = bits.sum(1)
    ok = (count == limits.max_players) if limits.exact else (count <= limits.max_players)
    ok &= bits @ steps <= limits.max_cost * limits.cost_steps
    for number, r in enumerate(limits.roles):
        size = bits @ (roles == number)
        ok &= (size >= r.at_least) & (size <= r.at_most)
    for slot in (0, 1):
        ok &= bits @ (slots == slot) <= limits.max_per_team
    return (bits @ points)[ok].max() if ok.any() else None


@pytest.mark.parametrize("seed", range(12))
def test_solver_against_every_subset(seed):
    rng = np.random.default_rng(seed)
    limits = SelectionLimits(exact=seed % 4 == 3, max_cost=90 if seed % 3 == 2 else 100)
    for _ in range(6):
        n = rng.integers(8, 16)
        points = rng.integers(-8, 60, n).astype(float)
        steps = rng.integers(14, 23, n)
        roles = rng.integers(0, 4 if seed % 2 else 3, n)
        slots = rng.integers(0, 3 if seed % 5 == 4 else 2, n)
        best = brute_force(points, steps, roles, slots, limits)
        picked = sel.solve(points, steps, roles, slots, limits)
        assert (picked is None) == (best is None)
        if picked is not None:
            assert points[picked].sum() == pytest.approx(best)
            one = np.zeros(n)
            one[picked] = 1
            assert one @ steps <= limits.max_cost * limits.cost_steps
            assert len(set(picked)) == len(picked) <= limits.max_players


# Fixed values, a published selection: name, role, team, cost, then points and pick of two models.
PUBLISHED = [
    ("DJ Bravo", "AllRounder", "CSK", 10.0, 38.22570960333232, 1, 78.66666666666667, 1),
    ("AR Patel", "AllRounder", "DC", 8.5, 38.155758062273264, 1, 60.66666666666666, 1),
    ("SS Iyer", "Batsmen", "DC", 9.0, 37.43565126940934, 1, 48.0, 1),
    ("F du Plessis", "Batsmen", "CSK", 9.0, 37.07216863175287, 1, 29.0, 1),
    ("RA Jadeja", "AllRounder", "CSK", 8.5, 35.73880147964806, 1, 28.0, 1),
    ("S Dhawan", "Batsmen", "DC", 10.0, 35.491344605693044, 1, 23.0, 0),
    ("AT Rayudu", "Batsmen", "CSK", 9.0, 33.548205520397865, 1, 17.0, 0),
    ("RR Pant", "Batsmen", "DC", 9.5, 33.20388486655509, 1, 34.0, 1),
    ("SN Thakur", "Bowler", "CSK", 8.5, 30.88664478629701, 1, 47.0, 1),
    ("K Rabada", "Bowler", "DC", 9.5, 29.668216557304287, 1, 32.666666666666664, 1),
    ("DL Chahar", "Bowler", "CSK", 8.5, 29.28993550060994, 1, 26.666666666666668, 1),
    ("PP Shaw", "Batsmen", "DC", 8.5, 32.559824427241885, 0, 10.0, 0),
    ("MP Stoinis", "AllRounder", "DC", 8.5, 31.87814036065698, 0, 11.333333333333334, 0),
    ("MS Dhoni", "Batsmen", "CSK", 9.5, 30.826473083635392, 0, 6.0, 0),
    ("SO Hetmyer", "Batsmen", "DC", 8.5, 28.70647089088797, 0, 18.33333333333333, 0),
    ("A Nortje", "Bowler", "DC", 8.0, 27.21395022870934, 0, 48.333333333333336, 1),
    ("R Ashwin", "Bowler", "DC", 9.0, 26.615883518573888, 0, 26.666666666666668, 1),
]


@pytest.mark.parametrize("model", [0, 1])
def test_published_selection(spark, model):
    df = spark.createDataFrame([(1, n, r, t, c, x[2 * model]) for n, r, t, c, *x in PUBLISHED], DDL)
    got = {r.playername for r in sel.best_teams(df, "pred_points").collect()}
    assert got == {n for n, _, _, _, *x in PUBLISHED if x[2 * model + 1]}


def frame(spark, n=26, seed=0, match=1, cost=None, teams=2):
    rng = np.random.default_rng(seed)
    return spark.createDataFrame([
        (match, f"p{i:05d}", ROLES[int(rng.integers(0, 3))], f"T{i % teams}",
         float(rng.integers(14, 23)) / 2 if cost is None else cost, float(rng.integers(0, 60)))
        for i in range(n)], DDL)


def test_a_huge_match_is_cut_to_a_bound_and_stays_exact(spark):
    df = frame(spark, 4000, seed=5)
    pool = sel.candidates(df, "pred_points")
    kept = pool.count()
    assert kept <= 2 * 3 * 9 * 7 < 4000
    everyone = df.withColumns({
        "role": F.when(F.col("playing_role") == "Batsmen", 0)
        .when(F.col("playing_role") == "Bowler", 1).otherwise(2),
        "slot": F.when(F.col("playing_team") == "T0", 0).otherwise(1)}).toPandas()
    picked = sel.solve(everyone.pred_points, everyone.playercost * 2, everyone.role, everyone.slot)
    total = sel.team_summary(sel.best_teams(df, "pred_points")).first()
    assert total.team_points == everyone.pred_points.iloc[picked].sum()
    assert total.players == 11


def test_limits_hold_and_random_feasible_teams_are_no_better(spark):
    df = frame(spark, 26, seed=2).union(frame(spark, 22, seed=3, match=2))
    got = sel.select_team(df, "pred_points", "pick", "rank").toPandas()
    rng = np.random.default_rng(1)
    for _, match in got.groupby("matchid"):
        team = match[match.pick == 1.0]
        assert len(team) <= 11 and team.playercost.sum() <= 100
        assert team.playing_team.value_counts().max() <= 7
        for r in LIMITS.roles:
            assert r.at_least <= (team.playing_role == r.name).sum() <= r.at_most
        assert sorted(team["rank"]) == list(range(len(team)))
        assert list(team.sort_values("rank").pred_points) == sorted(team.pred_points, reverse=True)
        for _ in range(300):
            other = match.sample(11, random_state=int(rng.integers(1 << 30)))
            sizes = [(other.playing_role == r.name).sum() for r in LIMITS.roles]
            if (other.playercost.sum() <= 100 and other.playing_team.value_counts().max() <= 7
                    and all(r.at_least <= s <= r.at_most for r, s in zip(LIMITS.roles, sizes))):
                assert other.pred_points.sum() <= team.pred_points.sum()


def test_infeasible_and_one_team_matches_give_no_rows(spark):
    batters = frame(spark).withColumn("playing_role", F.lit("Batsmen"))
    assert sel.best_teams(batters, "pred_points").count() == 0
    assert sel.best_teams(frame(spark, teams=1), "pred_points").count() == 0
    assert sel.select_team(batters, "pred_points", "pick", "rank").count() == batters.count()


def test_missing_cost_is_free_and_missing_points_are_zero(spark):
    df = frame(spark, cost=20.0).withColumn(
        "playercost", F.when(F.col("playername") > "p00013", F.lit(20.0)))
    picked = sel.best_teams(df, "pred_points").count()
    assert 5 < picked <= 11
    none = df.withColumn("pred_points", F.lit(None).cast("double"))
    assert sel.team_summary(sel.best_teams(none, "pred_points")).first().team_points == 0


@pytest.mark.parametrize("cost", [8.3, -1.0])
def test_costs_off_the_grid_and_below_zero(spark, cost):
    df = frame(spark, cost=cost)
    got = sel.team_summary(sel.best_teams(df, "pred_points")).first()
    finer = SelectionLimits(cost_steps=10) if cost > 0 else LIMITS
    same = df.withColumn("playercost", F.greatest("playercost", F.lit(0.0)))
    want = sel.team_summary(sel.best_teams(same, "pred_points", finer)).first()
    assert got.players == 11 and got.team_points == want.team_points


@pytest.mark.parametrize("seed", range(6))
def test_any_cost_against_every_subset(seed):
    rng = np.random.default_rng(seed)
    limits = SelectionLimits(exact=seed % 3 == 2, max_cost=70)
    for _ in range(4):
        n = rng.integers(10, 15)
        points = rng.integers(-8, 60, n).astype(float)
        steps = rng.normal(14, 7, n)
        roles, slots = rng.integers(0, 4, n), rng.integers(0, 3 if seed % 2 else 2, n)
        best = brute_force(points, steps, roles, slots, limits)
        picked = sel.solve(points, steps, roles, slots, limits)
        assert (picked is None) == (best is None)
        if picked is not None:
            assert points[picked].sum() == pytest.approx(best)
            assert steps[picked].sum() <= limits.max_cost * limits.cost_steps + 1e-6
            assert len(set(picked)) == len(picked) <= limits.max_players


def test_not_a_number_is_a_missing_value(spark):
    df = frame(spark)
    odd = df.withColumn("pred_points", F.when(F.col("playername") == "p00003", F.lit(float("nan")))
                        .otherwise(F.col("pred_points")))
    none = df.withColumn("pred_points", F.when(F.col("playername") != "p00003", F.col("pred_points")))
    assert sel.team_summary(sel.best_teams(odd, "pred_points")).first() == \
        sel.team_summary(sel.best_teams(none, "pred_points")).first()


def test_a_name_given_twice_counts_once(spark):
    df = frame(spark)
    got = sel.best_teams(df.union(df), "pred_points")
    assert got.count() == got.select("playername").distinct().count()


def test_other_limits(spark):
    limits = SelectionLimits(max_players=3, max_cost=30, max_per_team=2, roles=(
        RoleLimits("Batsmen", 1, 1), RoleLimits("Bowler", 1, 2)))
    assert sel.best_teams(frame(spark), "pred_points", limits).count() == 3


def test_captain_bonus_follows_the_rank(spark):
    got = sel.select_team(frame(spark), "pred_points", "pick", "rank", adjust_captain=True)
    plain = {r.playername: r.pred_points for r in frame(spark).collect()}
    for r in got.collect():
        factor = {0: 2.0, 1: 1.5}.get(r["rank"], 1.0)
        assert r.pred_points == plain[r.playername] * factor


def test_pool_is_what_enough_others_do_not_beat(spark):
    rng = np.random.default_rng(8)
    df = spark.createDataFrame([
        (m, f"p{i:04d}", ROLES[int(rng.integers(0, 4))], f"T{int(rng.integers(0, 3))}",
         float(rng.normal(9, 2)) if m == 1 else float(rng.integers(14, 23)) / 2,
         float(rng.integers(-5, 60))) for m in (1, 2) for i in range(1500)], DDL)
    got = {(r.matchid, r.playername) for r in sel.candidates(df.repartition(7), "pred_points")
           .collect()}
    want, kept = set(), sel._places(LIMITS)
    known = sel._known(df, "pred_points", LIMITS, sel.Columns()).collect()
    groups = {}
    for r in known:
        groups.setdefault((r.matchid, r.role, r.slot), []).append(r)
    for (_, role, slot), members in groups.items():
        for p in members:
            beaten = sum((q.steps, -q.points, [-ord(c) for c in q.playername])
                         < (p.steps, -p.points, [-ord(c) for c in p.playername])
                         and q.points >= p.points for q in members)
            if beaten < kept[role, slot]:
                want.add((p.matchid, p.playername))
    assert got == want and len(got) < 1200 < len(known)


@pytest.mark.parametrize("parts", [1, 9])
def test_a_match_of_any_cost_over_many_batches_is_solved_exactly(spark, parts):
    rng = np.random.default_rng(4)
    rows = [(1, f"p{i:04d}", ROLES[int(rng.integers(0, 3))], f"T{i % 2}",
             float(rng.normal(9, 2)), float(rng.integers(0, 60))) for i in range(600)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        df = spark.createDataFrame(rows, DDL).repartition(parts)
        got = sel.best_teams(df, "pred_points", partitions=2).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    roles = np.array([ROLES.index(r[2]) for r in rows])
    picked = sel.solve([r[5] for r in rows], [2 * r[4] for r in rows], roles,
                       [i % 2 for i in range(600)])
    assert sum(r.points for r in got) == sum(rows[i][5] for i in picked)
    assert sorted(r["rank"] for r in got) == list(range(len(got)))
    assert sum(r[4] for r in rows if r[1] in {g.playername for g in got}) <= 100


def test_tables_are_worked_on_where_they_are_reached():
    table = np.full((3, 4, 1, 50), sel.NONE)
    assert sel._reached(table) == ([0, 0, 0, 0], [0, 0, 0, 0])
    table[1, 2, 0, 7] = table[2, 1, 0, 30] = 5.0
    assert sel._reached(table) == ([1, 1, 0, 7], [3, 3, 1, 31])
