import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wicketflow.config import RewardRules
from wicketflow.operators import backtest as bt


def teams(spark):
    data = []
    for match, good in ((1, True), (2, False)):
        for i in range(14):
            predicted = 1.0 if i < 11 and (good or i < 10) else None
            data.append((match, f"p{i:02d}", 10.0 + i, predicted, 1.0 if i >= 3 else None))
    return spark.createDataFrame(
        data, "matchid bigint, playername string, total_points double,"
        " pred_selection_true double, actual_selection_true double")


def test_error_needs_enough_picks(spark):
    got = {r.matchid: r for r in bt.match_error(teams(spark)).collect()}
    assert (got[1].pred_points_player, got[1].actual_points_player) == (165.0, 198.0)
    assert got[1].error == pytest.approx(33 / 198) and got[2].error is None
    assert got[2].pred_selection_cnt == 10
    assert bt.match_error(teams(spark), 10).filter("error is null").count() == 0


def test_no_points_at_all_gives_zero_and_no_error(spark):
    zero = teams(spark).withColumn("total_points", F.lit(None).cast("double"))
    assert rows(bt.match_error(zero), "pred_points_player", "actual_points_player", "error") == [
        (0.0, 0.0, None)] * 2


@pytest.mark.parametrize("error, reward", [
    (None, 0.0), (-0.2, 249950.0), (0.0, 249950.0), (0.01, 149950.0), (0.05, 3950.0),
    (0.07, 950.0), (0.12, 75.0), (0.2, 0.0), (0.25, -50.0), (0.9, -50.0)])
def test_reward_bands(spark, error, reward):
    df = spark.createDataFrame([(1, error)], "matchid bigint, error double")
    assert bt.rewards(df).first().rewards_earned == reward


def test_rewards_fall_as_the_error_grows(spark):
    df = spark.createDataFrame([(i, i / 200) for i in range(80)], "matchid bigint, error double")
    earned = [r.rewards_earned for r in bt.rewards(df).orderBy("error").collect()]
    assert earned == sorted(earned, reverse=True)
    other = bt.rewards(df, RewardRules(bands=((.1, 3),), stake=10))
    assert {r.rewards_earned for r in other.collect()} == {20.0, -10.0}


def test_years(spark):
    earned = spark.createDataFrame([(1, .1, 5.0), (2, None, 0.0), (3, .3, -50.0), (9, .5, 1.0)],
                                   "matchid bigint, error double, rewards_earned double")
    dates = spark.createDataFrame(
        [(1, "2019-04-01"), (1, "2019-04-01"), (2, "2019-04-02"), (3, "2020-01-01")],
        "matchid bigint, date string")
    assert rows(bt.rewards_yearly(earned, dates)) == [("2019", .1, 5.0), ("2020", .3, -50.0)]


def test_model_error(spark):
    df = spark.createDataFrame([("a", 5.0, 3.0), ("a", None, 4.0), ("b", 1.0, None), (None, 1.0, 1.0)],
                               "g string, y double, p double")
    assert rows(bt.model_error(df, "p", "y")) == [(2.0,)]
    assert rows(bt.model_error(df, "p", "y", "g")) == [("a", 3.0), ("b", None)]


def test_ranks_and_captaincy(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, "b", 9.0), (1, "c", 5.0)],
                               "matchid bigint, playername string, pts double")
    ranked = bt.rank_picked(df, "pts", "r")
    assert rows(ranked, "playername", "r") == [("a", 2), ("b", 0), ("c", 1)]
    assert rows(bt.captaincy(ranked, "pts", "r"), "playername", "pts") == [
        ("a", 5.0), ("b", 18.0), ("c", 7.5)]
    best = bt.pick_best(df, "pts", "pick", "r", size=2)
    assert rows(best, "playername", "r", "pick") == [
        ("a", None, None), ("b", 0, 1.0), ("c", 1, 1.0)]
