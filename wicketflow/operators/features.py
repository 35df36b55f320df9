"""Feature columns of a player in a match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wicketflow.config import Cleaning, FeatureRules
from wicketflow.functions.text import canonical
from wicketflow.operators.joins import first_per_key, fits_broadcast, lookup_join
from wicketflow.operators.rolling import lagged_means, match_totals, number_rows


def clean_matches(matches: DataFrame, cleaning: Cleaning = Cleaning()) -> DataFrame:
    """City and venue under their canonical names."""
    return matches.withColumns({
        "city": canonical(F.col("city"), cleaning.city),
        "venue": canonical(F.col("venue"), cleaning.venue)})


def add_teams(points: DataFrame, cleaning: Cleaning = Cleaning()) -> DataFrame:
    """The player's team and opposition: the batting side if they batted, else the bowling side.

    Teams a row carries already (an upcoming match) are kept.
    """
    bowled_only = F.col("batsmen_innings").isNull()
    sides = {
        "playing_team": ("bowler_bowlingteam", "batsmen_battingteam"),
        "opposition_team": ("bowler_battingteam", "batsmen_bowlingteam"),
    }
    new = {}
    for name, (bowling, batting) in sides.items():
        picked = F.when(bowled_only, F.col(bowling)).otherwise(F.col(batting))
        if name in points.columns:
            picked = F.coalesce(F.col(name), picked)
        new[name] = canonical(picked, cleaning.team) if cleaning.rename_teams else picked
    return points.withColumns(new)


def _match_info(matches: DataFrame) -> DataFrame:
    return matches.select("matchid", "year", "city", "venue", F.col("team1").alias("home_team"),
                          F.col("team2").alias("away_team"), "toss_winner")


def add_match_info(points: DataFrame, matches: DataFrame) -> DataFrame:
    """Season, place, home and away team and toss winner of the match."""
    return lookup_join(points, _match_info(matches), "matchid")


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def add_flags(df: DataFrame) -> DataFrame:
    """Home game and won toss as 0 or 1; an unknown team gives 0."""
    return df.withColumns({
        "home_game": _flag(F.col("playing_team") == F.col("home_team")),
        "toss_flag": _flag(F.col("playing_team") == F.col("toss_winner"))})


def _tie_break(df: DataFrame) -> list[str]:
    return [c for c in ("batsmen_innings", "bowlers_innings", "playing_team") if c in df.columns]


def add_match_count(df: DataFrame, slice_bits: int = FeatureRules.slice_bits) -> DataFrame:
    """How many matches the player has played, this one included."""
    return number_rows(df, "playername", "matchid", _tie_break(df), "player_match_count",
                       slice_bits=slice_bits)


def add_lags(df: DataFrame, rules: FeatureRules = FeatureRules()) -> DataFrame:
    """Lagged means per venue and per player."""
    out = df
    for key, columns in (("venue", rules.venue_columns), ("playername", rules.player_columns)):
        lags = lagged_means(match_totals(df, "matchid", key, columns), "matchid", key, columns,
                            rules.windows, rules.slice_bits)
        out = out.join(lags, ["matchid", key], "left")
    return out


def add_lean_patch(df: DataFrame, base: str = "total_points_playername_avg") -> DataFrame:
    """1 when the short-run mean is under 0.6 of the long-run mean; 0 while that is unknown."""
    return df.withColumns({
        f"lean_patch_{short}": _flag(F.col(f"{base}{short}") < F.col(f"{base}{long}") * 0.6)
        for short, long in ((3, 10), (2, 5), (5, 10))})


def features(points: DataFrame, matches: DataFrame, cleaning: Cleaning = Cleaning(),
             rules: FeatureRules = FeatureRules()) -> DataFrame:
    """Teams, match info, flags, match count and all lags of every player and match.

    Equal to the single steps in a row, but the wide table moves once. Venue
    lags belong to a match and travel with its info; player lags and the count
    of earlier rows share one history per player; the count within a match
    reuses the partitioning of that last join.
    """
    info = _match_info(clean_matches(matches, cleaning))
    small = fits_broadcast(info.select("matchid"))
    places = lookup_join(points.select("matchid", *rules.venue_columns),
                         info.select("matchid", "venue"), "matchid", small=small)
    venue_lags = lagged_means(
        match_totals(places, "matchid", "venue", rules.venue_columns), "matchid", "venue",
        rules.venue_columns, rules.windows, rules.slice_bits)
    described = info.join(venue_lags, ["matchid", "venue"], "left")
    player_lags = lagged_means(
        match_totals(points, "matchid", "playername", rules.player_columns, "_earlier_rows"),
        "matchid", "playername", rules.player_columns, rules.windows, rules.slice_bits,
        "_earlier_rows")
    known = add_flags(lookup_join(add_teams(points, cleaning), described, "matchid", small=small))
    joined = known.join(player_lags, ["matchid", "playername"], "left")
    same_match = Window.partitionBy("matchid", "playername").orderBy(*_tie_break(known))
    return joined.withColumn(
        "player_match_count", F.col("_earlier_rows") + F.row_number().over(same_match)
    ).drop("_earlier_rows")


def recent_squad(card: DataFrame, matches_back: int = 2) -> DataFrame:
    """Players of each team's last matches, one row per player and team.

    The rank runs over distinct (team, match) pairs and its bound is applied
    before the shuffle, so a team with very many matches stays small.
    """
    newest = Window.partitionBy("playing_team").orderBy(F.col("matchid").desc())
    recent = (card.select("playing_team", "matchid").filter("playing_team is not null").distinct()
              .withColumn("_rank", F.dense_rank().over(newest))
              .filter(F.col("_rank") <= matches_back).drop("_rank"))
    players = lookup_join(card, recent, ["playing_team", "matchid"], "left_semi")
    return first_per_key(players, ["playername", "playing_team"], [
        F.col("matchid").asc(), F.col("playing_role").asc_nulls_first()])
