"""Deliveries to points, points to features, features to models; Parquet between stages."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wicketflow.config import Cleaning, FeatureRules, PointsRules, RoleRules
from wicketflow.functions.nulls import not_in
from wicketflow.operators.features import features
from wicketflow.operators.forecast import walk_forward
from wicketflow.operators.points import player_points
from wicketflow.operators.scorecard import scorecard
from wicketflow.plans.models import (MOVING_AVERAGE, ModelPlan, fit_model, save_model,
                                     train_test_split)
from wicketflow.session import stage


COMMITS = "run string, batch string"


@dataclass(frozen=True)
class Tables:
    """Where a job keeps its tables and models."""

    root: str
    # Match ids per folder of the append-only master tables.
    slice_width: int = 65_536

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """The table; of one that is written in runs, the rows of committed runs."""
        df = spark.read.parquet(self.path(name))
        if "run" not in df.columns:
            return df
        return df.join(self.commits(spark).select("run"), "run", "left_semi").drop("run")

    def commits(self, spark: SparkSession) -> DataFrame:
        """One row (run, batch) for each run whose tables are all written."""
        try:
            return spark.read.schema(COMMITS).json(self.path("commits"))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], COMMITS)

    def commit(self, spark: SparkSession, run: str, batch: str | None = None) -> None:
        """Make a run's rows visible: one row in one file, which Spark writes all or not."""
        row = spark.createDataFrame([(run, batch)], COMMITS)
        row.coalesce(1).write.mode("append").json(self.path("commits"))

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.read(df.sparkSession, name)


@dataclass(frozen=True)
class Rules:
    points: PointsRules = field(default_factory=PointsRules)
    role: RoleRules = field(default_factory=RoleRules)
    cleaning: Cleaning = field(default_factory=Cleaning)
    features: FeatureRules = field(default_factory=FeatureRules)
    model: ModelPlan = field(default_factory=ModelPlan)


def score_deliveries(deliveries: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Scorecards with points."""
    return player_points(scorecard(deliveries, rules.role, stage), rules.points)


def train(deliveries: DataFrame, matches: DataFrame, tables: Tables, models,
          hold_out_years=(2019,), rules: Rules = Rules(), fit_scaler_on: str = "all",
          use_forecast: bool = False, costs: DataFrame | None = None,
          stop_early=()) -> dict[str, str]:
    """Score, build features, fit and save the named models; returns the model paths.

    `costs` (matchid, playername, playercost) adds each player's cost, which picking teams
    needs; the greatest one counts if a player has several. Without it the cost is null.
    `fit_scaler_on`: `all` also uses the held-out years, `train` only the training rows.
    `stop_early` names the boosted models that stop when the held-out years get no better.
    `use_forecast` adds the walk-forward forecast of each player as a predictor.
    """
    points = tables.write(score_deliveries(deliveries, rules), "points")
    frame = features(points, matches, rules.cleaning, rules.features)
    if costs is None:
        frame = frame.withColumn("playercost", F.lit(None).cast("double"))
    else:
        keys = ["matchid", "playername"]
        frame = frame.join(costs.groupBy(*keys).agg(
            F.max(F.col("playercost").cast("double")).alias("playercost")), keys, "left")
    plan = rules.model
    if use_forecast:
        frame = walk_forward(frame, "playername", "matchid", plan.target)
        plan = ModelPlan(**{**plan.__dict__, "numeric": (*plan.numeric, "ts_pred_points")})
    frame = tables.write(frame, "features")
    rows, _ = train_test_split(frame, "year", list(hold_out_years))
    paths = {}
    for name in models:
        if name == MOVING_AVERAGE:
            continue
        scale_on = frame if fit_scaler_on == "all" else rows
        paths[name] = tables.path(f"models/{name}")
        known, held = rows, None
        if name in stop_early:
            known, held = frame.withColumn(
                "_held", ~not_in(F.col("year"), list(hold_out_years))), "_held"
        save_model(fit_model(name, known, plan, scale_on, held), paths[name])
    return paths
