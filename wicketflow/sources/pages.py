"""Landed JSON pages to tables: play-by-play, schedule and squads.

A page is a text column; everything is parsed and flattened JVM-side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wicketflow import schemas
from wicketflow.config import UNDECIDED
from wicketflow.functions.text import whole_numbers

ANNOUNCED = "Playing XI"


def _is_empty(item: Column) -> Column:
    """A missing item, or one without any field."""
    return reduce(lambda a, b: a & b, [item[f].isNull() for f in schemas.PLAY_ITEM])


def play_items(pages: DataFrame, page: str = "page") -> DataFrame:
    """One row per item of a play-by-play page; the first empty item ends the page."""
    parsed = pages.withColumn("_items", F.from_json(page, schemas.PLAY_PAGE)["commentary"]["items"])
    # A column of its own, so that the items are looked through once.
    placed = parsed.withColumn("_end", F.array_position(
        F.transform("_items", _is_empty), F.lit(True)).cast("int"))
    kept = F.when(F.col("_end") > 0, F.slice("_items", F.lit(1), F.col("_end") - 1)).otherwise(
        F.col("_items"))
    return placed.select(*[c for c in pages.columns if c != page],
                         F.explode(kept).alias("item"))


def feed_deliveries(pages: DataFrame, page: str = "page", season: str = "ipl_season",
                    event: str = "eventid") -> DataFrame:
    """Play-by-play pages (season, event, page text) to one row per delivery."""
    i = F.col("item")
    over, innings, out = i["over"], i["innings"], i["dismissal"]["dismissal"]
    athlete = F.get(i["athletesInvolved"], F.lit(0))
    return play_items(pages, page).select(
        F.col(season).alias("ipl_season"), i["sequence"].alias("sequence"),
        F.col(event).cast("bigint").alias("eventid"), i["periodText"].alias("innings"),
        innings["target"].alias("target"), innings["remainingBalls"].alias("remainingballs"),
        i["homeScore"].alias("homescore"), i["awayScore"].alias("awayscore"),
        innings["fallOfWickets"].alias("fallofwickets"), innings["balls"].alias("ball"),
        over["overs"].alias("over"), i["scoreValue"].alias("scorevalue"),
        (over["noBall"] + over["wide"]).alias("validball"),
        (over["noBall"] + over["wide"] + over["byes"] + innings["legByes"]).alias("extras"),
        out.alias("dismissal"), i["dismissal"]["type"].alias("dismissaltype"),
        i["batsman"]["athlete"]["id"].alias("batsmanid"),
        i["batsman"]["athlete"]["name"].alias("batsman"),
        i["batsman"]["team"]["name"].alias("batsmanteam"),
        i["bowler"]["athlete"]["id"].alias("bowlerid"),
        i["bowler"]["athlete"]["name"].alias("bowler"),
        i["bowler"]["team"]["name"].alias("bowlerteam"),
        F.when(out, athlete["id"]).alias("otherathleteinvolvedid"),
        F.when(out, athlete["name"]).otherwise("").alias("otherathleteinvolved"),
        i["otherBatsman"]["athlete"]["id"].alias("nonstrikerid"),
        i["otherBatsman"]["athlete"]["name"].alias("nonstriker"),
        innings["totalRuns"].alias("runs"), innings["runRate"].alias("runrate"))


def winner(competitors: Column) -> Column:
    first, second = F.get(competitors, F.lit(0)), F.get(competitors, F.lit(1))
    return (F.when(first["isWinner"], first["name"]).when(second["isWinner"], second["name"])
            .otherwise(UNDECIDED))


def win_kind(status: Column, match_wkts: bool = False) -> Column:
    """`runs`, `wickets` or empty. The short form `wkts` counts only on request."""
    wickets = status.contains("wickets")
    if match_wkts:
        wickets = wickets | status.contains("wkts")
    return F.when(status.contains("runs"), "runs").when(wickets, "wickets").otherwise("")


def schedule_matches(pages: DataFrame, page: str = "page", year: str = "year",
                     match_wkts: bool = False) -> DataFrame:
    """Schedule pages (season year, page text) to the match table."""
    events = pages.select(F.col(year).cast("int").alias("year"), F.explode(
        F.from_json(page, schemas.SCHEDULE_PAGE)["content"]["matchEvents"]).alias("e"))
    e, sides = F.col("e"), F.col("e.competitors")
    return events.select(
        e["id"].alias("matchid"), e["date"].alias("date"), "year",
        e["venue"]["name"].alias("city"), e["venue"]["name"].alias("venue"),
        F.get(sides, F.lit(0))["name"].alias("team1"), F.get(sides, F.lit(1))["name"].alias("team2"),
        e["statusText"].alias("result"), F.lit("").alias("tossdecision"),
        winner(sides).alias("winner"), win_kind(e["statusText"], match_wkts).alias("by_what"),
        whole_numbers(e["statusText"]).alias("by_how_many"), F.lit("").alias("mom"))


def squad_players(pages: DataFrame, page: str = "page", announced_only: bool = True) -> DataFrame:
    """Squad pages to one row per player.

    With `announced_only`, a page counts only once its first block is the announced eleven.
    """
    keep = [c for c in pages.columns if c != page]
    squads = pages.select(*keep, F.from_json(page, schemas.SQUADS_PAGE)["content"]["squads"]
                          .alias("squads"))
    if announced_only:
        squads = squads.filter(F.get("squads", F.lit(0))["title"] == ANNOUNCED)
    teams = squads.select(*keep, F.explode("squads").alias("s"))
    players = teams.select(*keep, F.col("s.teamName").alias("teamname"),
                           F.explode("s.players").alias("p"))
    return players.select(
        *keep, F.col("p.name").alias("playername"), F.col("p.isCaptain").alias("iscaptain"),
        F.col("p.position").alias("position"), F.col("p.link.href").alias("profilelink"),
        "teamname")


#: Kinds of pages: their schema, and what a page must have to be one.
PLAYS = (schemas.PLAY_PAGE, "commentary.items")
SCHEDULE = (schemas.SCHEDULE_PAGE, "content.matchEvents")
SQUADS = (schemas.SQUADS_PAGE, "content.squads")


def fault(page: str, kind: tuple[str, str]) -> Column:
    """Why a page cannot be read as its kind; null for a sound one.

    `no text`; `broken` when it is no JSON or a value does not fit its type; `no content` when
    the list that such a page is made of is missing. An empty list is sound.
    """
    schema, needed = kind
    text = F.col(page)

    def judge(read: Column) -> Column:
        content = reduce(lambda c, name: c[name], needed.split("."), read)
        return (F.when(text.isNull() | (F.trim(text) == ""), "no text")
                .when(read.isNull() | read["_broken"].isNotNull(), "broken")
                .when(content.isNull(), "no content"))

    parsed = F.from_json(text, f"{schema}, _broken string",
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    # Within a lambda the page is parsed once, however often the parts are looked at.
    return F.element_at(F.transform(F.array(parsed), judge), 1)


def sound_pages(pages: DataFrame, kind: tuple[str, str], page: str = "page") -> DataFrame:
    """The pages that can be read as their kind."""
    return pages.where(fault(page, kind).isNull())


def broken_pages(pages: DataFrame, kind: tuple[str, str], page: str = "page") -> DataFrame:
    """The other pages, with the column `fault`; with `sound_pages` they are all the input."""
    return pages.withColumn("fault", fault(page, kind)).where("fault is not null")


def quarantine(pages: DataFrame, kind: tuple[str, str], path: str,
               page: str = "page") -> DataFrame:
    """Append the broken pages to `path`, for repair, and return the sound ones."""
    broken_pages(pages, kind, page).write.mode("append").parquet(path)
    return sound_pages(pages, kind, page)
