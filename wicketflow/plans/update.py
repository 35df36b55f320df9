"""Append new matches to the master tables. Running it again changes nothing."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wicketflow.config import UNDECIDED, PointsRules, RoleRules
from wicketflow.functions.nulls import not_in
from wicketflow.operators.joins import append_common, append_outer, keep_new
from wicketflow.operators.points import player_points
from wicketflow.operators.scorecard import scorecard
from wicketflow.plans.train import Tables
from wicketflow.sources.files import write_per_key


@dataclass(frozen=True)
class Masters:
    deliveries: DataFrame
    points: DataFrame
    matches: DataFrame


def new_points(deliveries: DataFrame, scored: DataFrame,
               points_rules: PointsRules = PointsRules(), role_rules: RoleRules = RoleRules(),
               stage=None) -> DataFrame:
    """Scorecards of matches that are not scored yet, from their deliveries alone."""
    return player_points(
        scorecard(keep_new(deliveries, scored, "matchid"), role_rules, stage), points_rules)


def finished(matches: DataFrame) -> DataFrame:
    """Matches with a winner on record (or an unknown one)."""
    return matches.filter(not_in(F.col("winner"), [UNDECIDED]))


def update_masters(masters: Masters, deliveries: DataFrame, matches: DataFrame,
                   points_rules: PointsRules = PointsRules(),
                   role_rules: RoleRules = RoleRules(), stage=None) -> Masters:
    """The masters with the unseen matches of the incoming tables appended."""
    return Masters(
        append_common(masters.deliveries, keep_new(deliveries, masters.deliveries, "matchid")),
        append_common(masters.points, new_points(
            deliveries, masters.points, points_rules, role_rules, stage)),
        append_outer(masters.matches, keep_new(finished(matches), masters.matches, "matchid")))


def _sliced(df: DataFrame, width: int) -> DataFrame:
    return df.withColumn("match_slice", F.floor(F.col("matchid") / width).cast("bigint"))


def _append(df: DataFrame, tables: Tables, name: str, run: str) -> None:
    """Append a run's rows in folders of consecutive match ids.

    A later update joins on folder and match id, so it reads only the folders
    that its own match ids fall into.
    """
    rows = _sliced(df, tables.slice_width).withColumn("run", F.lit(run))
    write_per_key(rows, tables.path(name), ["match_slice", "run"], mode="append")


def _write(fresh: dict[str, DataFrame], tables: Tables, batch: str | None) -> None:
    """Write all tables of a run, then commit it. A run that dies leaves rows no one reads."""
    run, spark = uuid.uuid4().hex, None
    for name, df in fresh.items():
        spark = df.sparkSession
        _append(df, tables, name, run)
    tables.commit(spark, run, batch)


def append_to_tables(tables: Tables, deliveries: DataFrame, matches: DataFrame,
                     points_rules: PointsRules = PointsRules(),
                     role_rules: RoleRules = RoleRules(), stage=None,
                     extra: dict[str, DataFrame] | None = None, batch: str | None = None) -> None:
    """Write only the new rows behind the stored masters: all tables, or none.

    Rows carry the id of their run, and readers see the runs of a commit log that is
    written last. A job that dies before that has changed nothing that can be read, and
    writes all of its rows when it is run again. A `batch` that is in the log is not run
    again. `extra` tables (with a matchid) are part of the run. One job may write at a time.
    """
    spark = deliveries.sparkSession
    if batch is not None and not tables.commits(spark).where(F.col("batch") == batch).isEmpty():
        return
    key = ["match_slice", "matchid"]
    incoming = _sliced(deliveries, tables.slice_width)
    played = _sliced(finished(matches), tables.slice_width)
    master = {n: tables.read(spark, n) for n in ("deliveries", "points", "matches")}
    unscored = keep_new(incoming, master["points"], key).drop("match_slice")
    fresh = {
        "points": player_points(scorecard(unscored, role_rules, stage), points_rules),
        "deliveries": keep_new(incoming, master["deliveries"], key),
        "matches": keep_new(played, master["matches"], key),
    }
    written = {name: df.select(*[c for c in master[name].columns
                                 if c in df.columns and c != "match_slice"])
               for name, df in fresh.items()}
    _write({**written, **(extra or {})}, tables, batch)


def create_tables(tables: Tables, deliveries: DataFrame, points: DataFrame,
                  matches: DataFrame) -> None:
    _write({"deliveries": deliveries, "points": points, "matches": matches}, tables, None)
