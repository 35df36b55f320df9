"""The test tables seen as match data. Every view covers its whole source table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delivery per order line: 50 orders make a match, line parity the innings."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey div 50 as matchid", "l_linenumber % 2 as inn", "cast(l_quantity as int) as q",
        "cast(l_partkey as int) as pk", "cast(l_suppkey as int) as sk", "l_returnflag as rf",
        "l_linestatus as ls", "l_orderkey", "l_linenumber")
    teams = lines.selectExpr(
        "*", "cast(matchid % 8 as int) as t1",
        "cast((matchid % 8 + 1 + (matchid div 8) % 7) % 8 as int) as t2",
        "cast(((pk % 11) * ((pk div 11) % 11)) div 11 as int) as bi", "2 + sk % 7 as wi")
    sides = teams.selectExpr(
        "*", "if(inn = 1, t1, t2) as bt", "if(inn = 1, t2, t1) as bw",
        "rf = 'R' and q % 5 = 0 as dismissal")
    return sides.selectExpr(
        "matchid",
        "if(inn = 1, '1st innings', '2nd innings') as innings",
        "concat('Team', bt) as battingteam", "concat('Team', bw) as bowlingteam",
        "concat('P-', bt * 11 + bi) as batsmanname", "concat('P-', bw * 11 + wi) as bowlername",
        "pk % 20 + ((sk div 7) % 6 + 1) / cast(10 as double) as over",
        "bi as fallofwickets",
        "case when q <= 20 then 0 when q <= 36 then 1 when q <= 40 then 2 when q <= 46 then 4"
        " when q <= 49 then 6 else 3 end as scorevalue",
        "case when q <= 20 or q = 50 then 0 when q <= 36 then 1 when q <= 40 then 2"
        " when q <= 46 then 4 else 6 end as batsmanscorevalue",
        "dismissal",
        "case when not dismissal then null when q = 25 then 'run out' when q = 40 then"
        " 'retired hurt' when ls = 'F' then 'bowled' end as dismissedtype",
        "l_orderkey * 8 + l_linenumber as sequence")


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One summary row per match."""
    first = F.col("innings") == "1st innings"
    batting, bowling = (F.expr(f"cast(substr({c}, 5) as int)")
                        for c in ("battingteam", "bowlingteam"))
    # Numbers of teams, of which a task keeps the least without sorting the deliveries.
    numbers = deliveries(spark, sf_dir).groupBy("matchid").agg(
        F.min(F.when(first, batting).otherwise(bowling)).alias("team1"),
        F.min(F.when(first, bowling).otherwise(batting)).alias("team2"))
    pairs = numbers.withColumns({c: F.concat(F.lit("Team"), c) for c in ("team1", "team2")})
    return pairs.selectExpr(
        "matchid", "2008 + matchid % 12 as year",
        "concat(2008 + matchid % 12, '-04-', lpad(1 + matchid % 28, 2, '0'), 'T14:00Z') as date",
        "case matchid % 4 when 0 then 'Bangalore' when 1 then 'Bengaluru' when 2 then 'Mohali'"
        " else 'Mumbai' end as city",
        "case matchid % 4 when 0 then 'M Chinnaswamy Stadium' when 1 then 'M.Chinnaswamy Stadium'"
        " when 2 then 'Punjab Cricket Association IS Bindra Stadium, Mohali'"
        " else 'Wankhede Stadium, Mumbai' end as venue",
        "team1", "team2", "if(matchid % 3 = 0, team1, team2) as toss_winner",
        "case when matchid % 10 = 9 then 'Starts at 18:00 local time'"
        " when matchid % 10 = 8 then 'Match tied (Team0 won the one-over eliminator)'"
        " when matchid % 2 = 0 then concat(team1, ' won by ', 1 + matchid % 60, ' runs')"
        " else concat(team2, ' won by ', 1 + matchid % 9, ' wkts (3b rem)') end as result",
        "case when matchid % 10 >= 8 then 'Match Tied/Cancelled/Not yet ended'"
        " when matchid % 2 = 0 then team1 else team2 end as winner")


def squads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every player who took part in a match, with a cost and a made-up prediction."""
    # A bit per player: a task keeps a row per match, team and 64 numbers of players, not a row
    # per player, so few rows are held and shuffled in whatever order the deliveries come.
    entries = deliveries(spark, sf_dir).selectExpr("matchid", """inline(array(
        struct(cast(substr(battingteam, 5) as int) as team,
               cast(substr(batsmanname, 3) as int) as id),
        struct(cast(substr(bowlingteam, 5) as int) as team,
               cast(substr(bowlername, 3) as int) as id)))""")
    masks = entries.selectExpr("*", "shiftright(id, 6) as block").groupBy(
        "matchid", "team", "block").agg(F.expr("bit_or(shiftleft(1L, id & 63)) as mask"))
    # Without a number there is no mask, but still one row.
    places = "if(mask is null, array(0), filter(sequence(0, 63), k -> getbit(mask, k) = 1))"
    seen = masks.selectExpr("*", f"explode({places}) as place").selectExpr(
        "matchid", "concat('Team', team) as playing_team", "block * 64 + place as id")
    return seen.withColumn("playername", F.expr("concat('P-', id)")).selectExpr(
        "matchid", "playing_team", "playername", "id % 11 as idx",
        "(16 + (id * 7) % 6) / cast(2 as double) as playercost",
        "cast((id * 37 + matchid * 13) % 101 as double) as pred_points")


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`squads` under cleaned names."""
    return squads(spark, sf_dir).withColumn("playername", F.translate("playername", "-", " "))


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deliveries in the shape of the play-by-play feed."""
    return deliveries(spark, sf_dir).selectExpr(
        "'season' as ipl_season", "sequence", "matchid as eventid", "innings", "150 as target",
        "120 - cast(over as int) * 6 as remainingballs",
        "if(innings = '1st innings', concat(fallofwickets * 10 + scorevalue, '/', fallofwickets),"
        " '0') as homescore",
        "if(innings = '1st innings', '0', concat(fallofwickets * 10 + scorevalue, '/',"
        " fallofwickets)) as awayscore",
        "fallofwickets", "cast(round(over * 10) as int) as ball", "over", "scorevalue",
        "if(scorevalue = 3, 1, 0) + if(dismissal, 1, 0) as validball",
        "if(scorevalue = 3, 1, 0) + if(dismissal, 1, 0) + scorevalue % 2 + fallofwickets % 2"
        " as extras",
        "dismissal", "dismissedtype as dismissaltype",
        "cast(substr(batsmanname, 3) as bigint) as batsmanid", "batsmanname as batsman",
        "battingteam as batsmanteam", "cast(substr(bowlername, 3) as bigint) as bowlerid",
        "bowlername as bowler", "bowlingteam as bowlerteam",
        "if(dismissal, cast(substr(bowlername, 3) as bigint), null) as otherathleteinvolvedid",
        "if(dismissal, bowlername, '') as otherathleteinvolved",
        "cast(substr(batsmanname, 3) as bigint) + 1 as nonstrikerid",
        "concat('P-', cast(substr(batsmanname, 3) as bigint) + 1) as nonstriker",
        "fallofwickets * 10 + scorevalue as runs", "scorevalue * cast(1.5 as double) as runrate")


def play_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each delivery as a JSON page: its item, an empty item, and one that must not be read."""
    rest = """named_struct(
        'periodText', innings,
        'innings', named_struct('balls', ball, 'legByes', fallofwickets % 2, 'totalRuns', runs,
            'fallOfWickets', fallofwickets, 'runRate', runrate, 'target', target,
            'remainingBalls', remainingballs),
        'over', named_struct('overs', over, 'noBall', if(scorevalue = 3, 1, 0),
            'wide', if(dismissal, 1, 0), 'byes', scorevalue % 2),
        'scoreValue', scorevalue,
        'dismissal', named_struct('dismissal', dismissal, 'type', dismissaltype),
        'batsman', named_struct('athlete', named_struct('id', batsmanid, 'name', batsman),
            'team', named_struct('name', batsmanteam)),
        'bowler', named_struct('athlete', named_struct('id', bowlerid, 'name', bowler),
            'team', named_struct('name', bowlerteam)),
        'otherBatsman', named_struct('athlete',
            named_struct('id', nonstrikerid, 'name', nonstriker)),
        'athletesInvolved', if(dismissal,
            array(named_struct('id', bowlerid, 'name', bowler)), array()),
        'homeScore', homescore, 'awayScore', awayscore)"""
    # The two items differ in their sequence alone, so the rest is made once.
    one = feed(spark, sf_dir).selectExpr(
        "ipl_season", "eventid", "sequence", f"substr(to_json({rest}), 2) as rest")
    item = "'{{', coalesce(concat('\"sequence\":', sequence + {0}, ','), ''), rest"
    # As the element of an array a page is made by generated code; Spark would else make it
    # within the reading of JSON, which interprets its input term by term.
    return one.selectExpr(
        "ipl_season", "eventid", "sequence", "explode(array(concat("
        f"'{{\"commentary\":{{\"items\":[', {item.format(0)}, ',{{}},', {item.format(1)}, ']}}}}'"
        "))) as page")


def damaged_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Play pages of which some are cut off, empty, of another kind or with a wrong value."""
    return play_pages(spark, sf_dir).withColumn("page", F.expr(
        "case sequence % 23 when 3 then substr(page, 1, 60) when 7 then '  ' when 11 then null"
        " when 13 then '{\"content\":{}}' when 17 then"
        " replace(page, '\"scoreValue\":', '\"scoreValue\":\"x\",\"was\":') else page end"))


def schedule_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each match as a JSON schedule page."""
    return matches(spark, sf_dir).selectExpr("year", """to_json(named_struct('content', named_struct(
        'matchEvents', array(named_struct('id', matchid, 'date', date,
            'venue', named_struct('name', venue),
            'competitors', array(
                named_struct('name', team1, 'isWinner', winner = team1),
                named_struct('name', team2, 'isWinner', winner = team2)),
            'statusText', result))))) as page""")


def series_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each match as a series page of two blocks, one of them without status and link."""
    block = """'<div class="x default-match-block"><p>Match <span class="bold">', {date},
        '</span></p><br><div class="innings-info-1">', team1, ' <b>', matchid % 200, '/4</b></div>',
        '<div class=innings-info-2>', team2, ' &amp; others</div>'"""
    link = """'<div class="match-status"> ', result, '</div><a href="http://host/series/8048/game/',
        matchid, '/scorecard/', year, '">Scorecard</a>'"""
    page = (f"concat('<title>', year, '</title><span class=\"bold\">menu</span>',"
            f" {block.format(date='date')}, {link}, '</div>',"
            f" {block.format(date='year')}, '</div><div class=\"match-status\">after</div>')")
    return matches(spark, sf_dir).selectExpr("cast(year as string) as ipl", f"{page} as html")


def squad_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each squad entry as a JSON page of two blocks; every third match is not announced yet."""
    return squads(spark, sf_dir).selectExpr("matchid", """to_json(named_struct('content', named_struct(
        'squads', array(
            named_struct('title', if(matchid % 3 = 0, 'Squads', 'Playing XI'),
                'teamName', playing_team, 'players', array(named_struct('name', playername,
                    'isCaptain', idx = 0, 'position', concat('Pos', idx),
                    'link', named_struct('href', concat('/player/', idx))))),
            named_struct('title', 'Bench', 'teamName', playing_team,
                'players', array(named_struct('name', concat('Sub ', playername),
                    'isCaptain', false, 'position', 'Bench',
                    'link', named_struct('href', '/bench')))))))) as page""")


def name_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two of three player names mapped, some of them twice."""
    d = deliveries(spark, sf_dir)
    ids = (d.select(F.col("batsmanname").alias("n")).union(d.select("bowlername")).distinct()
           .selectExpr("n", "cast(substr(n, 3) as int) as id"))
    return (ids.filter("id % 3 <> 0").selectExpr(
                "cast(id as bigint) as row_no", "n as feed_name",
                "concat('Player ', id) as master_name")
            .union(ids.filter("id % 5 = 1").selectExpr(
                "cast(id + 1000 as bigint)", "n", "concat('Alias ', id)")))


def last_match(spark: SparkSession, sf_dir: str) -> int:
    return table(spark, sf_dir, "lineitem").agg(F.max("l_orderkey")).first()[0] // 50
