"""Ranks, captaincy, error, rewards and model errors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wicketflow.config import Columns, RewardRules
from wicketflow.functions.nulls import total
from wicketflow.functions.times import year_text
from wicketflow.operators.joins import lookup_join


def pick_best(df: DataFrame, points: str, pick: str, rank: str, size: int = 11,
              cols: Columns = Columns()) -> DataFrame:
    """Mark the `size` best rows of a match by points (no other limit) and rank them from 0.

    The bound on the rank is applied before the shuffle; the marks are joined
    back, so rows that are not picked never meet in one task.
    """
    best = Window.partitionBy(cols.match).orderBy(
        F.col(points).desc_nulls_last(), F.col(cols.player).desc_nulls_last())
    marks = (df.select(cols.match, cols.player, points)
             .withColumn(rank, F.row_number().over(best)).filter(F.col(rank) <= size)
             .select(cols.match, cols.player, (F.col(rank) - 1).alias(rank),
                     F.lit(1.0).alias(pick)))
    return df.join(marks, [cols.match, cols.player], "left")


def rank_picked(picked: DataFrame, points: str, rank: str,
                cols: Columns = Columns()) -> DataFrame:
    """Rank the picked players of a match from 0, best first; of equals the later name first."""
    best = Window.partitionBy(cols.match).orderBy(
        F.col(points).desc(), F.col(cols.player).desc())
    return picked.withColumn(rank, F.row_number().over(best) - 1)


def captaincy(df: DataFrame, points: str, rank: str,
              captain: float = 2.0, vice_captain: float = 1.5) -> DataFrame:
    """Points of rank 0 and rank 1 multiplied."""
    p = F.col(points)
    return df.withColumn(points, F.when(F.col(rank) == 0, p * captain)
                         .when(F.col(rank) == 1, p * vice_captain).otherwise(p))


def match_error(teams: DataFrame, min_players: int = 11,
                cols: Columns = Columns()) -> DataFrame:
    """Points of both elevens per match and their relative gap, if enough players were picked."""
    points = F.col(cols.actual_points)
    sums = teams.filter(F.col(cols.match).isNotNull()).groupBy(cols.match).agg(
        total(F.col(cols.pred_pick) * points).alias("pred_points_player"),
        total(F.col(cols.actual_pick) * points).alias("actual_points_player"),
        total(F.col(cols.pred_pick)).alias("pred_selection_cnt"))
    gap = F.col("actual_points_player") - F.col("pred_points_player")
    return sums.withColumn("error", F.when(
        F.col("pred_selection_cnt") >= min_players,
        F.try_divide(gap, F.col("actual_points_player"))))


def rewards(errors: DataFrame, rules: RewardRules = RewardRules()) -> DataFrame:
    """Money won by error band; a match without an error earns 0, a bad one loses the stake."""
    error = F.col("error")
    ladder = F.when(error.isNull(), F.lit(0.0))
    for bound, prize in rules.bands:
        ladder = ladder.when(error < bound, F.lit(float((prize - 1) * rules.stake)))
    return errors.withColumn("rewards_earned", ladder.otherwise(F.lit(-float(rules.stake))))


def rewards_yearly(earned: DataFrame, dates: DataFrame) -> DataFrame:
    """Mean error and summed rewards per year of the match date."""
    per_match = dates.select("matchid", "date").distinct()
    dated = lookup_join(earned, per_match, "matchid")
    return (dated.withColumn("year", year_text(F.col("date"))).filter("year is not null")
            .groupBy("year").agg(F.avg("error").alias("error"),
                                 total(F.col("rewards_earned")).alias("rewards_earned")))


def model_error(df: DataFrame, prediction: str, target: str,
                by: str | None = None) -> DataFrame:
    """Mean absolute error, over all rows or per value of a column; a missing target is 0."""
    gap = F.abs(F.coalesce(F.col(target), F.lit(0)) - F.col(prediction))
    if by is None:
        return df.agg(F.avg(gap).alias("error"))
    return df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.avg(gap).alias("error"))
