"""Table schemas as DDL texts. Files are read by column name against these."""

from __future__ import annotations

FEED_DELIVERY = """
    ipl_season string, sequence bigint, eventid bigint, innings string, target int,
    remainingballs int, homescore string, awayscore string, fallofwickets int, ball int,
    `over` double, scorevalue int, validball int, extras int, dismissal boolean,
    dismissaltype string, batsmanid bigint, batsman string, batsmanteam string, bowlerid bigint,
    bowler string, bowlerteam string, otherathleteinvolvedid bigint, otherathleteinvolved string,
    nonstrikerid bigint, nonstriker string, runs int, runrate double"""

DELIVERIES = """
    date string, matchid bigint, innings string, target int, fallofwickets int, ball int,
    `over` double, scorevalue int, validball int, extras int, extratype string,
    batsmanname string, batsmanscorevalue int, bowlername string, nonstrikername string,
    totalruns int, dismissal boolean, dismissedtype string, dismissedplayer string,
    battingteam string, bowlingteam string"""

MATCHES = """
    matchid bigint, date string, year int, city string, venue string, team1 string, team2 string,
    result string, tossdecision string, winner string, by_what string, by_how_many array<int>,
    mom string"""

SCORECARD = """
    matchid bigint, playername string, total_runs double, total_balls_faced bigint,
    total_legal_balls_faced bigint, run_6 bigint, run_4 bigint, fallofwickets int,
    batsmen_innings string, batsmen_battingteam string, batsmen_bowlingteam string,
    total_wickets bigint, total_balls_bowled bigint, total_legal_balls_bowled bigint,
    total_runs_given double, maiden_overs bigint, bowlers_innings string,
    bowler_battingteam string, bowler_bowlingteam string, economy_rate double,
    playing_role string"""

POINT_COLUMNS = (
    "total_runs_points", "run_6_points", "run_4_points", "run_bonus_points", "total_bat_points",
    "total_wickets_points", "economy_rate_points", "maiden_overs_points", "wicket_bonus_points",
    "total_bowl_points", "total_points")

POINTS = SCORECARD + "".join(f", {c} double" for c in POINT_COLUMNS)

NAME_MAP = "row_no bigint, feed_name string, master_name string"

SQUAD = """
    playername string, iscaptain boolean, position string, profilelink string, teamname string"""

SQUAD_COST = "playername string, playing_team string, playing_role string, playercost double"

_NAMED = "struct<id:bigint,name:string>"
_SIDE = f"struct<athlete:{_NAMED},team:struct<name:string>>"
PLAY_ITEM = {
    "sequence": "bigint",
    "periodText": "string",
    "innings": "struct<balls:int,legByes:int,totalRuns:int,fallOfWickets:int,runRate:double,"
               "target:int,remainingBalls:int>",
    "over": "struct<overs:double,noBall:int,wide:int,byes:int>",
    "scoreValue": "int",
    "dismissal": "struct<dismissal:boolean,type:string>",
    "batsman": _SIDE,
    "bowler": _SIDE,
    "otherBatsman": f"struct<athlete:{_NAMED}>",
    "athletesInvolved": f"array<{_NAMED}>",
    "homeScore": "string",
    "awayScore": "string",
}
PLAY_PAGE = ("commentary struct<items:array<struct<"
             + ",".join(f"`{name}`:{kind}" for name, kind in PLAY_ITEM.items()) + ">>>")

SCHEDULE_PAGE = """
    content struct<matchEvents:array<struct<
        id:bigint, date:string, venue:struct<name:string>,
        competitors:array<struct<name:string,isWinner:boolean>>, statusText:string>>>"""

SQUADS_PAGE = """
    content struct<squads:array<struct<
        title:string, teamName:string,
        players:array<struct<name:string,isCaptain:boolean,position:string,
                             link:struct<href:string>>>>>>"""
