"""The upcoming match: rows to predict, announced players, and the report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wicketflow.config import Cleaning, Columns, FeatureRules, SelectionLimits
from wicketflow.functions.text import canonical
from wicketflow.operators.features import (
    add_flags, add_match_info, add_teams, clean_matches, features, recent_squad,
)
from wicketflow.operators.joins import append_outer, keep_known, lookup_join
from wicketflow.operators.rolling import match_totals
from wicketflow.operators.selection import best_teams
from wicketflow.operators.tails import merge_tails, tail_means, tails
from wicketflow.session import stage

REPORT_KEYS = ("matchid", "playername", "playing_role", "playing_team", "playercost")


def upcoming_squad(squad_costs: DataFrame, team1: str, team2: str, matchid: int) -> DataFrame:
    """Both teams' players with their opposition and the new match id."""
    team = F.col("playing_team")
    return (squad_costs.filter(team.isin(team1, team2)).select(
        F.lit(matchid).cast("bigint").alias("matchid"), "playername", "playing_team",
        "playing_role", F.when(team == team1, team2).otherwise(team1).alias("opposition_team"),
        "playercost"))


def next_match_frame(points: DataFrame, matches: DataFrame, squad_costs: DataFrame, team1: str,
                     team2: str, city: str, venue: str, toss_winner: str, year: int,
                     cleaning: Cleaning = Cleaning(),
                     rules: FeatureRules = FeatureRules()) -> DataFrame:
    """Features of the players of a match that has not been played.

    The new rows join the history, features are rebuilt and only the new match
    is kept. Only history that can matter goes in: rows of these players, and
    rows at this venue.
    """
    matchid = points.agg(F.max("matchid")).first()[0] + 1
    squad = upcoming_squad(squad_costs, team1, team2, matchid)
    summary = points.sparkSession.createDataFrame(
        [(matchid, year, city, venue, team1, team2, toss_winner)],
        "matchid bigint, year bigint, city string, venue string, team1 string, team2 string,"
        " toss_winner string")
    history = _relevant(points, squad, matches, venue, cleaning)
    frame = features(append_outer(history, squad), append_outer(matches, summary), cleaning, rules)
    return frame.filter(F.col("matchid") == matchid)


def _relevant(points: DataFrame, squad: DataFrame, matches: DataFrame, venue: str,
              cleaning: Cleaning) -> DataFrame:
    """History rows of the squad's players, and all rows of matches at the venue."""
    players = squad.select("playername", F.lit(True).alias("_player")).distinct()
    place = canonical(F.lit(venue), cleaning.venue)
    here = (matches.filter(canonical(F.col("venue"), cleaning.venue) == place)
            .select("matchid", F.lit(True).alias("_here")).distinct())
    marked = lookup_join(lookup_join(points, players, "playername"), here, "matchid")
    return marked.filter("_player or _here").select(*points.columns)


@dataclass(frozen=True)
class Tails:
    """What features of a coming match need of the past: a row per player and per venue."""

    players: DataFrame
    venues: DataFrame


def history_tails(points: DataFrame, matches: DataFrame, cleaning: Cleaning = Cleaning(),
                  rules: FeatureRules = FeatureRules()) -> Tails:
    """The tails of whole matches."""
    depth = max(rules.windows)
    played = match_totals(points, "matchid", "playername", rules.player_columns, "_rows")
    places = add_match_info(points.select("matchid", *rules.venue_columns),
                            clean_matches(matches, cleaning))
    hosted = match_totals(places, "matchid", "venue", rules.venue_columns)
    return Tails(tails(played, "matchid", "playername", rules.player_columns, depth, "_rows"),
                 tails(hosted, "matchid", "venue", rules.venue_columns, depth))


def stored_tails(state: Tails) -> Tails:
    """The tails written once and read back, as each merge and frame uses them more than once."""
    return Tails(stage(state.players, "player-tails"), stage(state.venues, "venue-tails"))


def merged_tails(state: Tails, batch: Tails, rules: FeatureRules = FeatureRules()) -> Tails:
    """The tails after a batch of matches that the state does not hold yet."""
    depth = max(rules.windows)
    return Tails(
        merge_tails(state.players, batch.players, "matchid", "playername", rules.player_columns,
                    depth),
        merge_tails(state.venues, batch.venues, "matchid", "venue", rules.venue_columns, depth))


def next_match_from_tails(state: Tails, squad_costs: DataFrame, team1: str, team2: str, city: str,
                          venue: str, toss_winner: str, year: int,
                          cleaning: Cleaning = Cleaning(),
                          rules: FeatureRules = FeatureRules()) -> DataFrame:
    """As `next_match_frame`, from the tails alone: no history is read.

    Only the tails of the squad's players and of the venue leave the scans.
    """
    matchid = (state.players.agg(F.max("newest")).first()[0] or 0) + 1
    squad = upcoming_squad(squad_costs, team1, team2, matchid)
    teams = {c: canonical(F.col(c), cleaning.team) if cleaning.rename_teams else F.col(c)
             for c in ("playing_team", "opposition_team")}
    place = canonical(F.lit(venue), cleaning.venue)
    known = add_flags(squad.withColumns(teams | {
        "year": F.lit(year).cast("bigint"), "city": canonical(F.lit(city), cleaning.city),
        "venue": place, "home_team": F.lit(team1), "away_team": F.lit(team2),
        "toss_winner": F.lit(toss_winner)}))
    of_players = tail_means(keep_known(state.players, squad, "playername"), "playername",
                            rules.player_columns, rules.windows)
    of_venue = tail_means(state.venues.filter(F.col("venue") == place), "venue",
                          rules.venue_columns, rules.windows).drop("running")
    again = Window.partitionBy("playername").orderBy("playing_team")
    return (known.join(of_players, "playername", "left").join(of_venue, "venue", "left")
            .withColumn("player_match_count",
                        F.coalesce("running", F.lit(0)) + F.row_number().over(again))
            .drop("running"))


def restrict_to_squad(frame: DataFrame, announced: DataFrame | None,
                      history: DataFrame, matches_back: int = 2) -> DataFrame:
    """Keep announced players; before the announcement, those of each team's last matches."""
    if announced is not None and not announced.isEmpty():
        return keep_known(frame, announced, "playername")
    teams = frame.select("playing_team").distinct()
    played = keep_known(add_teams(history), teams, "playing_team")
    return keep_known(frame, recent_squad(played, matches_back), "playername")


def pick_per_model(frame: DataFrame, models, limits: SelectionLimits = SelectionLimits(),
                   cols: Columns = Columns()) -> DataFrame:
    """A prediction and a pick column per model, for a frame with `pred_points_<model>` columns."""
    names = [(f"{cols.pred_points}_{m}", f"{cols.pred_pick}_{m}") for m in models]
    wide = stage(frame.select(*REPORT_KEYS, *[points for points, _ in names]), "report")
    for points, pick in names:
        marks = best_teams(wide, points, limits, cols).select(
            cols.match, cols.player, F.lit(1.0).alias(pick))
        wide = wide.join(marks, [cols.match, cols.player], "left")
    return wide.select(*REPORT_KEYS, *[c for pair in names for c in pair])


def selection_report(wide: DataFrame, first: str = "catboost",
                     second: str = "ensemble") -> DataFrame:
    """Eight named columns for two models, points rounded half to even."""
    columns = {"playername": "playername", "playing_team": "teamname",
               "playing_role": "playingrole", "playercost": "playercost"}
    out = [F.col(c).alias(n) for c, n in columns.items()]
    for number, model in ((1, first), (2, second)):
        out += [F.bround(f"pred_points_{model}", 0).alias(f"model{number}_points"),
                F.col(f"pred_selection_true_{model}").alias(f"model{number}_team")]
    return wide.select(*out)


def report_order(wide: DataFrame, model: str = "catboost") -> DataFrame:
    """Newest match first, picked players first, best first; missing values last."""
    return wide.orderBy(*[F.col(c).desc_nulls_last() for c in (
        "matchid", f"pred_selection_true_{model}", f"pred_points_{model}", "playername")])
