"""Fantasy points from scorecards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wicketflow.config import PointsRules
from wicketflow.functions.nulls import add_missing_as_zero


def _double(value) -> Column:
    return F.lit(float(value))


def _bonus(condition: Column, points: float) -> Column:
    return F.when(condition, _double(points)).otherwise(_double(0))


def batting_points(card: DataFrame, rules: PointsRules = PointsRules()) -> DataFrame:
    """Run, boundary and milestone points; the total is null if no ball was faced."""
    runs = F.col("total_runs")
    milestones = [_bonus(runs == 0, rules.duck), _bonus(runs >= 50, rules.fifty),
                  _bonus(runs >= 100, rules.hundred)]
    parts = {
        "total_runs_points": runs * _double(rules.run),
        "run_6_points": F.col("run_6") * _double(rules.six),
        "run_4_points": F.col("run_4") * _double(rules.four),
        "run_bonus_points": reduce(lambda a, b: a + b, milestones),
    }
    scored = card.withColumns(parts)
    return scored.withColumn("total_bat_points", F.when(
        F.col("total_balls_faced") >= 1, add_missing_as_zero(*map(F.col, parts))))


def economy_points(rate: Column, rules: PointsRules) -> Column:
    """First band that holds; a missing rate earns nothing."""
    bands = [(rate >= bound, points) for bound, points in rules.economy_at_least]
    bands += [(rate <= bound, points) for bound, points in rules.economy_at_most]
    first, *rest = bands
    ladder = F.when(first[0], _double(first[1]))
    for condition, points in rest:
        ladder = ladder.when(condition, _double(points))
    return ladder.otherwise(_double(0))


def bowling_points(card: DataFrame, rules: PointsRules = PointsRules()) -> DataFrame:
    """Wicket, maiden and economy points; the total is null if no ball was bowled."""
    wickets = F.col("total_wickets")
    parts = {
        "total_wickets_points": wickets * _double(rules.wicket),
        "economy_rate_points": economy_points(F.col("economy_rate"), rules),
        "maiden_overs_points": F.col("maiden_overs") * _double(rules.maiden),
        "wicket_bonus_points": F.when(wickets >= 5, _double(rules.five_wickets))
        .when(wickets >= 4, _double(rules.four_wickets)).otherwise(_double(0)),
    }
    scored = card.withColumns(parts)
    return scored.withColumn("total_bowl_points", F.when(
        F.col("total_balls_bowled") >= 1, add_missing_as_zero(*map(F.col, parts))))


def player_points(card: DataFrame, rules: PointsRules = PointsRules()) -> DataFrame:
    """All point columns; the total is null only when both parts are."""
    scored = bowling_points(batting_points(card, rules), rules)
    return scored.withColumn("total_points", add_missing_as_zero(
        F.col("total_bat_points"), F.col("total_bowl_points")))
