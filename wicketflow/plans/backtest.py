"""Predict over the whole history, pick teams, and measure error and reward."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wicketflow.config import Columns, RewardRules, SelectionLimits
from wicketflow.operators.backtest import match_error, rewards, rewards_yearly
from wicketflow.operators.selection import select_team
from wicketflow.plans.models import (MOVING_AVERAGE, fit_ensemble, load_model, predict,
                                     predict_ensemble, predict_moving_average)
from wicketflow.session import stage

MODEL_KEYS = ("matchid", "playername", "playing_role", "playing_team", "playercost",
              "total_points")


@dataclass(frozen=True)
class BackTest:
    teams: DataFrame
    matches: DataFrame
    years: DataFrame


def predict_all(features: DataFrame, model_paths: dict[str, str], names,
                blend: bool = False, out: str = "pred_points") -> DataFrame:
    """One prediction column per model, and `out` as their blend or the last model's value.

    The models are applied one after another to the same rows, without a join.
    """
    wide = features
    columns = [f"{out}_{n}" for n in names]
    for name, column in zip(names, columns):
        wide = (predict_moving_average(wide, column) if name == MOVING_AVERAGE
                else predict(load_model(model_paths[name]), wide, column))
    wide = wide.select(*MODEL_KEYS, *columns)
    if blend:
        return predict_ensemble(wide, fit_ensemble(wide, columns), out)
    return wide.withColumn(out, F.col(columns[-1]))


def backtest(predicted: DataFrame, dates: DataFrame, limits: SelectionLimits = SelectionLimits(),
             reward_rules: RewardRules = RewardRules(), squad_size: int = 11,
             cols: Columns = Columns()) -> BackTest:
    """Team by prediction, team by actual points with captaincy, then error and reward.

    The predictions and the teams are written once: no result runs the models or the
    solver again.
    """
    predicted = stage(predicted, "predicted")
    by_prediction = select_team(predicted, cols.pred_points, cols.pred_pick, cols.pred_rank,
                                limits, cols=cols)
    teams = select_team(by_prediction, cols.actual_points, cols.actual_pick, cols.actual_rank,
                        limits, adjust_captain=True, cols=cols)
    teams = stage(teams, "teams")
    per_match = rewards(match_error(teams, squad_size, cols), reward_rules)
    return BackTest(teams, per_match, rewards_yearly(per_match, dates))
