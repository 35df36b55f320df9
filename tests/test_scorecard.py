import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wicketflow.operators import scorecard as sc
from wicketflow.operators.points import batting_points, bowling_points, player_points

DDL = ("matchid bigint, innings string, battingteam string, bowlingteam string,"
       " batsmanname string, bowlername string, `over` double, fallofwickets int,"
       " scorevalue int, batsmanscorevalue int, dismissal string, dismissedtype string")


def ball(batter="A-B", bowler="X", over=0.1, score=0, off_bat=None, out=None, kind=None,
         innings="1", bat="T1", bowl="T2", match=1, down=0):
    return (match, innings, bat, bowl, batter, bowler, over, down, score,
            score if off_bat is None else off_bat, out, kind)


def card(spark, balls):
    return {r.playername: r for r in sc.match_card(spark.createDataFrame(balls, DDL)).collect()}


def test_batting_counts(spark):
    got = card(spark, [
        ball(score=6, down=2), ball(over=0.2, score=4, down=1), ball(over=0.2, score=1),
        ball("C", over=0.3, down=3)])["A B"]
    assert (got.total_runs, got.total_balls_faced, got.total_legal_balls_faced) == (11, 3, 2)
    assert (got.run_6, got.run_4, got.fallofwickets) == (1, 1, 0)
    assert got.batsmen_innings == "1" and got.total_balls_bowled is None
    assert got.economy_rate is None


def test_counts_that_match_nothing_are_null(spark):
    got = card(spark, [ball(score=1)])
    assert got["A B"].run_6 is None and got["A B"].run_4 is None
    assert got["X"].total_wickets is None and got["X"].total_runs is None


@pytest.mark.parametrize("out, kind, wickets", [
    ("t", "bowled", 1), ("true", "caught", 1), ("true", None, 1), ("true", "run out", None),
    ("t", "retired hurt", None), ("false", "bowled", None), (None, None, None)])
def test_credited_wickets(spark, out, kind, wickets):
    df = spark.createDataFrame([ball(out=out, kind=kind)], DDL)
    assert sc.bowling_wickets(df).first().total_wickets == wickets


def test_boolean_dismissal(spark):
    df = spark.createDataFrame([ball(out="true", kind="bowled")], DDL)
    df = df.withColumn("dismissal", df["dismissal"].cast("boolean"))
    assert sc.bowling_wickets(df).first().total_wickets == 1


def test_bowling_and_maidens(spark):
    got = card(spark, [
        ball(over=0.1, score=1, off_bat=0), ball(over=0.2), ball(over=1.1, score=4),
        ball(over=2.1)])["X"]
    assert (got.total_runs_given, got.total_balls_bowled, got.maiden_overs) == (4, 4, 2)
    assert got.economy_rate == 6.0


def test_two_sides_in_one_match_fan_out(spark):
    balls = [ball("P", score=1), ball("P", over=0.2, innings="2", bat="T2", bowl="T1"),
             ball("Q", "P", over=1.1, innings="2", bat="T2", bowl="T1"),
             ball("Q", "P", over=1.1, score=2, innings="1")]
    df = spark.createDataFrame(balls, DDL)
    found = [r for r in sc.match_card(df).collect() if r.playername == "P"]
    assert len(found) == 4
    assert {(r.total_runs, r.total_legal_balls_bowled, r.maiden_overs) for r in found} == {(1, 1, 0)}
    assert {(r.batsmen_innings, r.bowlers_innings) for r in found} == {
        ("1", "1"), ("1", "2"), ("2", "1"), ("2", "2")}


def test_one_pass_equals_the_outer_join(spark):
    balls = [ball(f"B{i % 5}", f"W{i % 3}", over=(i % 7) + (i % 4) / 10, score=i % 7,
                  innings=str(i % 2), match=i % 3, down=i % 4, out="t" if i % 6 == 0 else None,
                  bat=f"T{i % 2}", bowl=f"T{1 - i % 2}") for i in range(200)]
    balls += [ball("B1", "B2", match=7), ball(None, "W1", match=8), ball("B1", None, match=9)]
    df = spark.createDataFrame(balls, DDL)
    joined = sc.merge_summaries(sc.batting_summary(df), sc.bowling_summary(df))
    assert rows(sc.match_card(df)) == rows(joined, *sc.match_card(df).columns)


def test_null_players_and_matches_are_dropped(spark):
    got = card(spark, [ball(None, "X"), ball("Y", None), ball("Z", "Z", match=None)])
    assert set(got) == {"X", "Y"}


def test_role_counts_missing_as_zero(spark):
    df = spark.createDataFrame([
        ("both", 16, 12), ("both", None, None), ("bowler", 1, 6), ("batter", 30, None),
        (None, 9, 9)], "playername string, total_balls_faced bigint, total_balls_bowled bigint")
    assert rows(sc.player_role(df)) == [
        ("batter", "Batsmen"), ("both", "AllRounder"), ("bowler", "Bowler")]


# Fixed values, rows of a published scorecard: runs, balls, sixes, fours, wickets, balls bowled,
# maidens, economy; then bat, bowl and total points.
PUBLISHED = [
    ((24.0, 18, 2, 1, None, None, None, None), (29.0, None, 29.0)),
    ((61.0, 35, 4, 3, None, None, None, None), (80.0, None, 80.0)),
    ((8.0, 4, 1, None, 1, 18, 0, 9.666666666666666), (10.0, 23.0, 33.0)),
    ((25.0, 18, 3, None, None, None, None, None), (31.0, None, 31.0)),
    ((7.0, 5, None, 1, 1, 22, 0, 4.636363636363637), (8.0, 29.0, 37.0)),
    ((None, None, None, None, None, 22, 0, 14.0), (None, -6.0, -6.0)),
    ((None, None, None, None, 3, 26, 0, 7.2), (None, 75.0, 75.0)),
    ((12.0, 9, 1, None, 3, 24, 0, 3.5), (14.0, 81.0, 95.0)),
    ((4.0, 9, None, None, 2, 24, 0, 8.0), (4.0, 50.0, 54.0)),
    ((None, None, None, None, 3, 24, 0, 9.75), (None, 73.0, 73.0)),
]


@pytest.mark.parametrize("stats, points", PUBLISHED)
def test_published_points(spark, stats, points):
    df = spark.createDataFrame([stats], (
        "total_runs double, total_balls_faced bigint, run_6 bigint, run_4 bigint,"
        " total_wickets bigint, total_balls_bowled bigint, maiden_overs bigint,"
        " economy_rate double"))
    got = player_points(df).first()
    assert (got.total_bat_points, got.total_bowl_points, got.total_points) == points


@pytest.mark.parametrize("runs, bonus", [
    (0, -2), (1, 0), (49, 0), (50, 8), (99, 8), (100, 24), (None, 0)])
def test_milestones_add_up(spark, runs, bonus):
    df = spark.createDataFrame(
        [(None if runs is None else float(runs), 1, None, None)],
        "total_runs double, total_balls_faced bigint, run_6 bigint, run_4 bigint")
    assert batting_points(df).first().run_bonus_points == bonus


@pytest.mark.parametrize("economy, points", [
    (11.0, -6), (10.9, -4), (10.0, -4), (9.0, -2), (8.9, 0), (6.1, 0), (6.0, 2), (5.0, 4),
    (4.0, 6), (0.0, 6), (None, 0)])
def test_economy_bands(spark, economy, points):
    df = spark.createDataFrame(
        [(None, 1, 0, economy)],
        "total_wickets bigint, total_balls_bowled bigint, maiden_overs bigint, economy_rate double")
    got = bowling_points(df).first()
    assert got.economy_rate_points == points and got.total_bowl_points == points


@pytest.mark.parametrize("wickets, bonus", [(3, 0), (4, 8), (5, 16), (6, 16), (None, 0)])
def test_hauls_pay_once(spark, wickets, bonus):
    df = spark.createDataFrame(
        [(wickets, 1, 0, 7.0)],
        "total_wickets bigint, total_balls_bowled bigint, maiden_overs bigint, economy_rate double")
    assert bowling_points(df).first().wicket_bonus_points == bonus


def test_points_are_null_without_a_ball(spark):
    df = spark.createDataFrame(
        [(5.0, 0, None, None, 1, None, 0, 3.0)], (
            "total_runs double, total_balls_faced bigint, run_6 bigint, run_4 bigint,"
            " total_wickets bigint, total_balls_bowled bigint, maiden_overs bigint,"
            " economy_rate double"))
    got = player_points(df).first()
    assert (got.total_bat_points, got.total_bowl_points, got.total_points) == (None, None, None)


def test_balls_shrink_to_a_row_per_side_before_the_shuffle(spark):
    balls = [ball("P", "Q", over=(i % 120) / 10, score=i % 7) for i in range(2000)]
    balls += [ball("Q", "P", over=i % 20 + 0.3, innings="2", bat="T2", bowl="T1") for i in range(90)]
    df = spark.createDataFrame(balls, DDL)
    seen = sc._seen_by(df, sc._as_batter(), sc._as_bowler())
    assert sc._per_side(seen).count() == 4


def test_overs_of_any_form(spark):
    overs = [0.1, 0.1, 3.05, 3.05, 3.1, 19.6, 20.0, 25.3, 45.31, -0.5, None, 1234567.5]
    runs = [0, 1, -1, 0, 1, None, 0, 2, 0, -1, 0, 0]
    both = [ball("P", "Q", over=o, off_bat=0, innings=str(i % 2)) for i, o in enumerate(overs)]
    both = [(*b[:9], r, *b[10:]) for b, r in zip(both, runs)]
    got = {r for r in map(tuple, sc.match_card(spark.createDataFrame(both, DDL)).select(
        "playername", "total_legal_balls_faced", "total_legal_balls_bowled", "total_balls_bowled",
        "total_runs_given", "maiden_overs").collect())}
    distinct = len({o for o in overs if o is not None})
    sums = {}
    for o, r in zip(overs, runs):
        if o is not None:
            sums[int(o)] = sums.get(int(o), 0) + (r or 0)
    maidens = sum(total == 0 for total in sums.values())
    assert got == {("P", distinct, None, None, None, None),
                   ("Q", None, distinct, len(overs) - 1, 2.0, maidens)}


def test_deliveries_of_a_match_lie_together_however_they_are_stored(spark):
    balls = [ball(f"B{i % 10}", f"W{i % 7}", over=i % 120 / 10, match=i % 40) for i in range(4000)]
    df = spark.createDataFrame(balls, DDL).repartition(8)
    seen = sc._seen_by(df, sc._as_batter(), sc._as_bowler())
    places = seen.select("matchid", F.spark_partition_id().alias("place")).distinct().count()
    assert places <= 40 + 4 - 1


def test_a_large_match_is_spread_over_tasks(spark):
    balls = [ball("B", "W", over=i % 120 / 10, match=7) for i in range(4000)]
    balls += [ball(match=m) for m in (None, 1, 2, 8, 9)]
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        seen = sc._seen_by(spark.createDataFrame(balls, DDL), sc._as_batter(), sc._as_bowler())
        sizes = seen.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set(name, before)
    assert sum(r["count"] for r in sizes) == 2 * 4004
    assert max(r["count"] for r in sizes) < 4004
