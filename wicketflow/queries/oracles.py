"""DuckDB SQL for the registered queries, over the same tables."""

from __future__ import annotations


DELIVERIES = """
with b as (
  select l_orderkey // 50 as matchid, l_linenumber % 2 as inn, cast(l_quantity as int) as q,
    cast(l_partkey as int) as pk, cast(l_suppkey as int) as sk, l_returnflag as rf,
    l_linestatus as ls, l_orderkey * 8 + l_linenumber as sequence
  from lineitem),
t as (
  select *, cast(matchid % 8 as int) as t1,
    cast((matchid % 8 + 1 + (matchid // 8) % 7) % 8 as int) as t2,
    cast(((pk % 11) * ((pk // 11) % 11)) // 11 as int) as bi, 2 + sk % 7 as wi
  from b),
u as (
  select *, case when inn = 1 then t1 else t2 end as bt, case when inn = 1 then t2 else t1 end as bw
  from t)
select matchid, case when inn = 1 then '1st innings' else '2nd innings' end as innings,
  'Team' || bt as battingteam, 'Team' || bw as bowlingteam,
  'P-' || (bt * 11 + bi) as batsmanname, 'P-' || (bw * 11 + wi) as bowlername,
  pk % 20 + ((sk // 7) % 6 + 1) / cast(10 as double) as "over", bi as fallofwickets,
  case when q <= 20 then 0 when q <= 36 then 1 when q <= 40 then 2 when q <= 46 then 4
       when q <= 49 then 6 else 3 end as scorevalue,
  case when q <= 20 or q = 50 then 0 when q <= 36 then 1 when q <= 40 then 2 when q <= 46 then 4
       else 6 end as batsmanscorevalue,
  (rf = 'R' and q % 5 = 0) as dismissal,
  case when rf <> 'R' or q % 5 <> 0 then null when q = 25 then 'run out'
       when q = 40 then 'retired hurt' when ls = 'F' then 'bowled' end as dismissedtype,
  sequence
from u"""

MATCHES = """
select matchid, 2008 + matchid % 12 as year,
  concat(2008 + matchid % 12, '-04-', lpad(cast(1 + matchid % 28 as varchar), 2, '0'), 'T14:00Z')
    as date,
  case matchid % 4 when 0 then 'Bangalore' when 1 then 'Bengaluru' when 2 then 'Mohali'
       else 'Mumbai' end as city,
  case matchid % 4 when 0 then 'M Chinnaswamy Stadium' when 1 then 'M.Chinnaswamy Stadium'
       when 2 then 'Punjab Cricket Association IS Bindra Stadium, Mohali'
       else 'Wankhede Stadium, Mumbai' end as venue,
  team1, team2, case when matchid % 3 = 0 then team1 else team2 end as toss_winner,
  case when matchid % 10 = 9 then 'Starts at 18:00 local time'
       when matchid % 10 = 8 then 'Match tied (Team0 won the one-over eliminator)'
       when matchid % 2 = 0 then concat(team1, ' won by ', 1 + matchid % 60, ' runs')
       else concat(team2, ' won by ', 1 + matchid % 9, ' wkts (3b rem)') end as result,
  case when matchid % 10 >= 8 then 'Match Tied/Cancelled/Not yet ended'
       when matchid % 2 = 0 then team1 else team2 end as winner
from (select matchid,
        min(case when innings = '1st innings' then battingteam else bowlingteam end) as team1,
        min(case when innings = '1st innings' then bowlingteam else battingteam end) as team2
      from deliveries group by matchid)"""

SQUADS = """
select matchid, playing_team, playername, id % 11 as idx,
  (16 + (id * 7) % 6) / cast(2 as double) as playercost,
  cast((id * 37 + matchid * 13) % 101 as double) as pred_points
from (select matchid, playing_team, playername, cast(substr(playername, 3) as int) as id
      from (select matchid, battingteam as playing_team, batsmanname as playername from deliveries
            union select matchid, bowlingteam, bowlername from deliveries))"""

PLAYERS = "select * replace (replace(playername, '-', ' ') as playername) from squads"

BATTING = """
select t.*, s.batsmen_innings, s.batsmen_battingteam, s.batsmen_bowlingteam
from (select matchid, replace(batsmanname, '-', ' ') as playername,
        cast(sum(scorevalue) as double) as total_runs, count("over") as total_balls_faced,
        count(distinct "over") as total_legal_balls_faced,
        nullif(count(*) filter (scorevalue = 6), 0) as run_6,
        nullif(count(*) filter (scorevalue = 4), 0) as run_4,
        min(fallofwickets) as fallofwickets
      from {d} group by 1, 2) t
left join (select distinct matchid, replace(batsmanname, '-', ' ') as playername,
             innings as batsmen_innings, battingteam as batsmen_battingteam,
             bowlingteam as batsmen_bowlingteam from {d}) s using (matchid, playername)"""

BOWLING = """
select t.*, m.maiden_overs, s.bowlers_innings, s.bowler_battingteam, s.bowler_bowlingteam,
  total_runs_given * 6 / total_legal_balls_bowled as economy_rate
from (select matchid, replace(bowlername, '-', ' ') as playername,
        nullif(count(*) filter (dismissal and coalesce(
          dismissedtype not in ('run out', 'retired hurt'), true)), 0) as total_wickets,
        count("over") as total_balls_bowled, count(distinct "over") as total_legal_balls_bowled,
        cast(sum(batsmanscorevalue) as double) as total_runs_given
      from {d} group by 1, 2) t
join (select matchid, playername, cast(sum(case when runs = 0 then 1 else 0 end) as bigint)
             as maiden_overs
      from (select matchid, replace(bowlername, '-', ' ') as playername, cast(trunc("over") as int),
              sum(batsmanscorevalue) as runs from {d} group by 1, 2, 3)
      group by 1, 2) m using (matchid, playername)
left join (select distinct matchid, replace(bowlername, '-', ' ') as playername,
             innings as bowlers_innings, battingteam as bowler_battingteam,
             bowlingteam as bowler_bowlingteam from {d}) s using (matchid, playername)"""

CARD = "select * from {a}batting full join {a}bowling using (matchid, playername)"

ROLE = """
select playername, case when faced >= 8 and bowled >= 6 then 'AllRounder'
                        when bowled >= 6 then 'Bowler' else 'Batsmen' end as playing_role
from (select playername, avg(coalesce(total_balls_faced, 0)) as faced,
        avg(coalesce(total_balls_bowled, 0)) as bowled from {a}merged group by 1)"""

POINTS = """
select *, case when total_bat_points is null and total_bowl_points is null then null
          else coalesce(total_bat_points, 0) + coalesce(total_bowl_points, 0) end as total_points
from (select *,
    case when total_balls_faced >= 1 then coalesce(total_runs_points, 0)
      + coalesce(run_6_points, 0) + coalesce(run_4_points, 0) + run_bonus_points end
      as total_bat_points,
    case when total_balls_bowled >= 1 then coalesce(total_wickets_points, 0)
      + coalesce(maiden_overs_points, 0) + wicket_bonus_points + economy_rate_points end
      as total_bowl_points
  from (select *,
      total_runs * cast(1 as double) as total_runs_points,
      run_6 * cast(2 as double) as run_6_points, run_4 * cast(1 as double) as run_4_points,
      cast((case when total_runs = 0 then -2 else 0 end)
        + (case when total_runs >= 50 then 8 else 0 end)
        + (case when total_runs >= 100 then 16 else 0 end) as double) as run_bonus_points,
      total_wickets * cast(25 as double) as total_wickets_points,
      maiden_overs * cast(8 as double) as maiden_overs_points,
      cast(case when economy_rate >= 11 then -6 when economy_rate >= 10 then -4
        when economy_rate >= 9 then -2 when economy_rate <= 4 then 6 when economy_rate <= 5 then 4
        when economy_rate <= 6 then 2 else 0 end as double) as economy_rate_points,
      cast(case when total_wickets >= 5 then 16 when total_wickets >= 4 then 8 else 0 end
        as double) as wicket_bonus_points
    from {a}card))"""

TEAMS = """
select *, case when batsmen_innings is null then bowler_bowlingteam else batsmen_battingteam end
    as playing_team,
  case when batsmen_innings is null then bowler_battingteam else batsmen_bowlingteam end
    as opposition_team
from points"""

CLEAN = """
select * replace (
  case when city in ('Bangalore', 'Bengaluru') then 'Bengaluru' else city end as city,
  case when venue in ('M Chinnaswamy Stadium', 'M.Chinnaswamy Stadium')
         then 'M Chinnaswamy Stadium'
       when venue in ('Punjab Cricket Association IS Bindra Stadium, Mohali',
         'Punjab Cricket Association Stadium, Mohali') then 'Punjab Cricket Association Stadium'
       else venue end as venue)
from matches"""

KNOWN = """
select p.*, m.year, m.city, m.venue, m.team1 as home_team, m.team2 as away_team, m.toss_winner,
  case when p.playing_team = m.team1 then 1 else 0 end as home_game,
  case when p.playing_team = m.toss_winner then 1 else 0 end as toss_flag,
  row_number() over (partition by playername order by matchid, batsmen_innings nulls first,
    bowlers_innings nulls first, playing_team nulls first) as player_match_count
from {teams} p left join {clean} m using (matchid)"""

WINDOWS = (2, 3, 5, 10)
VENUE = ("total_bat_points", "total_bowl_points")
PLAYER = ("total_points", "fallofwickets", "total_balls_bowled")


def lag_ctes(known: str, key: str, columns, windows=WINDOWS) -> list[tuple[str, str]]:
    sums = ", ".join(f"cast(coalesce(sum(distinct {c}), 0) as double) as {c}" for c in columns)
    means = ", ".join(
        f"case when count(*) over w{w} = {w} then avg({c}) over w{w} end as {c}_{key}_avg{w}"
        for w in windows for c in columns)
    frames = ", ".join(
        f"w{w} as (partition by {key} order by matchid rows between {w} preceding and 1 preceding)"
        for w in windows)
    return [
        (f"{key}_sums", f"select matchid, {key}, {sums} from {known} where {key} is not null"
                        " group by 1, 2"),
        (f"{key}_lags", f"select matchid, {key}, {means} from {key}_sums window {frames}"),
    ]


def lag_names(key: str, columns, windows=WINDOWS) -> list[str]:
    return [f"{c}_{key}_avg{w}" for w in windows for c in columns]


BASE = [("deliveries", DELIVERIES)]
SCORE = BASE + [("batting", BATTING.format(d="deliveries")),
                ("bowling", BOWLING.format(d="deliveries")),
                ("merged", CARD.format(a="")), ("role", ROLE.format(a="")),
                ("card", "select * from merged left join role using (playername)"),
                ("points", POINTS.format(a=""))]
MATCH = BASE + [("matches", MATCHES)]
SQUAD = BASE + [("squads", SQUADS), ("players", PLAYERS)]
INFO = SCORE + [("matches", MATCHES), ("clean", CLEAN), ("teams", TEAMS),
                ("known", KNOWN.format(teams="teams", clean="clean"))]
LAGS = INFO + lag_ctes("known", "venue", VENUE) + lag_ctes("known", "playername", PLAYER)
FEATURES = LAGS + [("features", """
    select * from known left join venue_lags using (matchid, venue)
    left join playername_lags using (matchid, playername)""")]
BACK = SCORE + [("squads", SQUADS), ("players", PLAYERS), ("base", """
    select p.matchid, p.playername, p.playing_role, q.playing_team, q.playercost, q.pred_points,
      p.total_points
    from points p join players q using (matchid, playername)"""),
    ("picked", """
    select *, case when pr < 11 then pr end as pred_selection_rank,
      case when ar < 11 then ar end as actual_selection_rank,
      case when pr < 11 then cast(1 as double) end as pred_selection_true,
      case when ar < 11 then cast(1 as double) end as actual_selection_true
    from (select *,
        row_number() over (partition by matchid order by pred_points desc, playername desc) - 1
          as pr,
        row_number() over (partition by matchid order by total_points desc, playername desc) - 1
          as ar from base)"""),
    ("armband", """
    select * replace (case when actual_selection_rank = 0 then total_points * 2
      when actual_selection_rank = 1 then total_points * 1.5 else total_points end
      as total_points) from picked"""),
    ("errors", """
    select *, case when pred_selection_cnt >= 11
      then (actual_points_player - pred_points_player) / actual_points_player end as error
    from (select matchid,
        cast(coalesce(sum(pred_selection_true * total_points), 0) as double) as pred_points_player,
        cast(coalesce(sum(actual_selection_true * total_points), 0) as double)
          as actual_points_player,
        cast(coalesce(sum(pred_selection_true), 0) as double) as pred_selection_cnt
      from armband group by 1)"""),
    ("earned", "select *, cast(case when error is null then 0 " + " ".join((
        # Fixed values of the prize table: 50 times (multiple - 1).
        "when error < 0.01 then 249950", "when error < 0.02 then 149950",
        "when error < 0.03 then 24950", "when error < 0.04 then 9950",
        "when error < 0.05 then 4950", "when error < 0.06 then 3950",
        "when error < 0.08 then 950", "when error < 0.1 then 350",
        "when error < 0.15 then 75", "when error < 0.2 then 50", "when error < 0.25 then 0"))
        + " else -50 end as double) as rewards_earned from errors")]

FEED = BASE + [("feed", """
    select 'season' as ipl_season, sequence, matchid as eventid, innings, 150 as target,
      120 - cast(trunc("over") as int) * 6 as remainingballs,
      case when innings = '1st innings'
        then concat(fallofwickets * 10 + scorevalue, '/', fallofwickets) else '0' end as homescore,
      case when innings = '1st innings' then '0'
        else concat(fallofwickets * 10 + scorevalue, '/', fallofwickets) end as awayscore,
      fallofwickets, cast(round("over" * 10) as int) as ball, "over", scorevalue,
      (case when scorevalue = 3 then 1 else 0 end) + (case when dismissal then 1 else 0 end)
        as validball,
      (case when scorevalue = 3 then 1 else 0 end) + (case when dismissal then 1 else 0 end)
        + scorevalue % 2 + fallofwickets % 2 as extras,
      dismissal, dismissedtype as dismissaltype,
      cast(substr(batsmanname, 3) as bigint) as batsmanid, batsmanname as batsman,
      battingteam as batsmanteam, cast(substr(bowlername, 3) as bigint) as bowlerid,
      bowlername as bowler, bowlingteam as bowlerteam,
      case when dismissal then cast(substr(bowlername, 3) as bigint) end as otherathleteinvolvedid,
      case when dismissal then bowlername else '' end as otherathleteinvolved,
      cast(substr(batsmanname, 3) as bigint) + 1 as nonstrikerid,
      'P-' || (cast(substr(batsmanname, 3) as bigint) + 1) as nonstriker,
      fallofwickets * 10 + scorevalue as runs, scorevalue * cast(1.5 as double) as runrate
    from deliveries""")]
NAMES = [("ids", """
    select n, cast(substr(n, 3) as int) as id from (
      select batsmanname as n from deliveries union select bowlername from deliveries)"""),
    ("names", """
    select n as feed_name, 'Player ' || id as master_name from ids where id % 3 <> 0
    union all select n, 'Alias ' || id from ids where id % 5 = 1"""),
    ("first_name", "select feed_name, min(master_name) as master_name from names group by 1")]
CUT = [("cut", "select cast(floor(max(matchid) * cast(0.8 as double)) as bigint) as hi,"
               " cast(floor(max(matchid) * cast(0.7 as double)) as bigint) as lo from deliveries")]


def sql(ctes: list[tuple[str, str]], body: str) -> str:
    return "with " + ",\n".join(f"{name} as ({text})" for name, text in ctes) + "\n" + body


def rounded(names, digits: int = 6) -> str:
    return ", ".join(f"round({n}, {digits}) as {n}" for n in names)


ORACLES: dict[str, str] = {}


def add(name: str, ctes, body: str) -> None:
    ORACLES[name] = sql(ctes, body) if ctes else body


add("scan_roundtrip", BASE, "select * from deliveries")
add("partitioned_sink", SQUAD, "select matchid, playing_team, playername, playercost from squads")
add("json_deliveries", FEED, "select * from feed")
add("json_matches", MATCH, """
select matchid, date, cast(year as int) as year, venue as city, venue, team1, team2, result,
  '' as tossdecision, winner, case when contains(result, 'runs') then 'runs'
    when contains(result, 'wickets') then 'wickets' else '' end as by_what,
  array_to_string([x for x in string_split(result, ' ') if regexp_full_match(x, '[0-9]+')], ',')
    as by_how_many, '' as mom
from matches""")
add("json_squads", SQUAD, """
select matchid, playername, idx = 0 as iscaptain, 'Pos' || idx as position,
  '/player/' || idx as profilelink, playing_team as teamname from squads where matchid % 3 <> 0
union all
select matchid, 'Sub ' || playername, false, 'Bench', '/bench', playing_team
from squads where matchid % 3 <> 0""")
add("html_links", None, """
with links as (select url, html, regexp_extract_all(html, '<a href="([^"]*)"', 1) as hrefs
               from pages)
select url, regexp_extract(html, '<title>([^<]*)</title>', 1) as title,
  cast(i - 1 as int) as position, hrefs[i] as href, split_part(url, '/', 3) as host,
  nullif(split_part(url, '/', 7), '') as part6, replace(url, 'example', 'sample') as renamed
from (select *, unnest(range(1, len(hrefs) + 1)) as i from links)""")
add("html_blocks", None, """
select page_id, cast(0 as int) as block, trim(replace(replace(replace(replace(
    regexp_extract(html, '<div class="ad">([^<]*)</div>', 1),
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&')) as text,
  cast(null as varchar) as link
from pages where html like '%<div class="ad">%'""")

add("match_list", MATCH, """
select cast(year as varchar) as ipl, case when whole then date else cast(year as varchar) end as date,
  case when whole then cast(matchid as varchar) end as eventid,
  concat(team1, ' ', matchid % 200, '/4') as inningsinfo1,
  concat(team2, ' & others') as inningsinfo2, case when whole then result end as matchstatus,
  case when whole then concat('http://host/series/8048/game/', matchid, '/commentary/', year) end
    as commentary_link
from matches, (values (true), (false)) as blocks(whole)""")

BAT = ("matchid, playername, total_runs, total_balls_faced, total_legal_balls_faced, run_6, run_4,"
       " fallofwickets, batsmen_innings, batsmen_battingteam, batsmen_bowlingteam")
BOWL = ("matchid, playername, total_wickets, total_balls_bowled, total_legal_balls_bowled,"
        " total_runs_given, maiden_overs, bowlers_innings, bowler_battingteam,"
        " bowler_bowlingteam, round(economy_rate, 6) as economy_rate")
add("batting_summary", SCORE, f"select {BAT} from batting")
add("bowling_summary", SCORE, f"select {BOWL} from bowling")
add("merge_summaries", SCORE, f"select {BAT}, {BOWL.split('playername, ', 1)[1]} from merged")
add("bowling_wickets", SCORE, "select matchid, playername, total_wickets from bowling")
add("maiden_overs", SCORE, "select matchid, playername, maiden_overs from bowling")
add("player_role", SCORE, "select playername, playing_role from role")
add("scorecard", SCORE,
    f"select {BAT}, {BOWL.split('playername, ', 1)[1]}, playing_role from card")
add("batting_points", SCORE, """
select matchid, playername, total_runs_points, run_6_points, run_4_points, run_bonus_points,
  total_bat_points from points""")
add("bowling_points", SCORE, """
select matchid, playername, total_wickets_points, economy_rate_points, maiden_overs_points,
  wicket_bonus_points, total_bowl_points from points""")
add("points", SCORE, """
select matchid, playername, playing_role, total_bat_points, total_bowl_points, total_points
from points""")
add("completed_matches", MATCH, """
select matchid, result from matches
where contains(result, 'won') and not contains(result, 'Starts')""")
add("canonical_venue", MATCH + [("clean", CLEAN)], "select matchid, city, venue from clean")
add("split_prefix", MATCH, """
select matchid, split_part(venue, ',', 1) as venue, split_part(date, '-', 1) as year from matches""")
add("player_team", INFO, "select matchid, playername, playing_team, opposition_team from teams")
add("match_features", INFO, """
select matchid, playername, year, city, venue, home_team, away_team, toss_winner from known""")
add("match_flags", INFO, "select matchid, playername, home_game, toss_flag from known")
add("player_match_count", INFO, "select matchid, playername, player_match_count from known")
LAG_COLUMNS = lag_names("venue", VENUE) + lag_names("playername", PLAYER)
add("lag_features", FEATURES, f"select matchid, playername, {rounded(LAG_COLUMNS)} from features")
add("features", FEATURES, f"""
select matchid, playername, playing_team, opposition_team, playing_role, year, city, venue,
  home_team, away_team, toss_winner, home_game, toss_flag, player_match_count, total_points,
  {rounded(LAG_COLUMNS)} from features""")
add("lean_patch", FEATURES, "select matchid, playername, " + ", ".join(
    f"case when total_points_playername_avg{s} < total_points_playername_avg{n} * 0.6"
    f" then 1 else 0 end as lean_patch_{s}" for s, n in ((3, 10), (2, 5), (5, 10)))
    + " from features")
add("predict_moving_average", FEATURES, """
select matchid, playername, round(total_points_playername_avg3, 6) as pred_points from features""")
add("saved_model", INFO, "select matchid, playername, true as same from known")
add("train_test_split", INFO, """
select matchid, playername, case when year in (2019) then 'test' else 'train' end as part
from known""")
add("recent_squad", INFO, """
select playername, playing_team, first(playing_role) as playing_role
from (select *, dense_rank() over (partition by playing_team order by matchid desc) as r
      from teams where playing_team is not null)
where r <= 2 group by 1, 2""")
add("selection", BACK, """
select matchid, playername, coalesce(case when matchid % 7 = 0 then null else total_points end, 0)
    as points, coalesce(case when matchid % 5 = 0 then null else playercost end, 0) as cost,
  playing_role as role, playing_team as team from base""")
add("selection_rank", BACK, """
select matchid, playername, pred_selection_rank, actual_selection_rank, pred_selection_true,
  actual_selection_true from picked""")
add("captaincy", BACK, "select matchid, playername, total_points from armband")
add("match_error", BACK, """
select matchid, pred_points_player, actual_points_player, pred_selection_cnt,
  round(error, 6) as error from errors""")
add("rewards", BACK, "select matchid, rewards_earned from earned")
add("rewards_yearly", BACK + [("matches", MATCHES)], """
select split_part(date, '-', 1) as year, round(avg(error), 6) as error,
  cast(sum(rewards_earned) as double) as rewards_earned
from earned left join (select distinct matchid, date from matches) using (matchid) group by 1""")
add("model_error", BACK + [("matches", MATCHES)], """
select cast(null as bigint) as year,
  round(avg(abs(coalesce(total_points, 0) - pred_points)), 6) as error from base
union all
select year, round(avg(abs(coalesce(total_points, 0) - pred_points)), 6)
from base join matches using (matchid) group by 1""")
add("model_wide", BACK, """
select matchid, playername, playing_role, playing_team, playercost, pred_points as pred_points_a,
  case when matchid % 2 = 0 then pred_points / 2 end as pred_points_b,
  playercost * 3 as pred_points_c from base""")
add("selection_report", BACK, """
select playername, playing_team as teamname, playing_role as playingrole, playercost,
  round_even(pred_points / 2, 0) + 0 as model1_points, pred_selection_true as model1_team,
  round_even(total_points / 4, 0) + 0 as model2_points, actual_selection_true as model2_team
from picked""")
add("ensemble_fit", BACK + [("s", """
    select sum(a * a) as aa, sum(a * b) as ab, sum(b * b) as bb, sum(a * y) as ay, sum(b * y) as b_y
    from (select pred_points as a, case when matchid % 2 = 0 then playercost end as b,
            total_points as y from base)
    where a is not null and b is not null and y is not null""")], """
select 'pred_points' as model, round((ay * bb - b_y * ab) / (aa * bb - ab * ab), 6) as weight from s
union all
select 'cost_points', round((b_y * aa - ay * ab) / (aa * bb - ab * ab), 6) from s""")
add("standardise", SCORE, """
select matchid, playername,
  round((total_bat_points - avg(total_bat_points) over ()) /
    coalesce(nullif(stddev_pop(total_bat_points) over (), 0), 1), 6) as total_bat_points,
  round((total_bowl_points - avg(total_bowl_points) over ()) /
    coalesce(nullif(stddev_pop(total_bowl_points) over (), 0), 1), 6) as total_bowl_points
from points""")
add("one_hot", SCORE, """
select matchid, playername,
  case when playing_role = 'AllRounder' then 1 else 0 end as playing_role_1,
  case when playing_role = 'Batsmen' then 1 else 0 end as playing_role_2,
  case when playing_role = 'Bowler' then 1 else 0 end as playing_role_3,
  case when batsmen_innings = '1st innings' then 1 else 0 end as batsmen_innings_1,
  case when batsmen_innings = '2nd innings' then 1 else 0 end as batsmen_innings_2,
  case when batsmen_innings is null then 1 else 0 end as batsmen_innings_3
from card""")
add("ordered_means", BACK, """
select matchid, playername, round((coalesce(sum(total_points) over before, 0) + mean)
                                  / (count(total_points) over before + 1), 6) as before
from (select matchid, playername, total_points, avg(total_points) over () as mean,
        md5('|' || matchid || '|' || playername) as place from base)
window before as (partition by playername order by place
                  rows between unbounded preceding and 1 preceding)""")
add("walk_forward", SCORE + [
    ("n", """select matchid, playername, total_points as y,
      row_number() over (partition by playername order by matchid) as seq,
      count(*) over (partition by playername) as size from points"""),
    ("r", """select *, (seq - 1) // 5 as block, case when size >= 20 then (seq - 1) // 5 else 0 end
      as part from n"""),
    ("x", "select *, lag(y) over (partition by playername, part order by seq) as x from r"),
    ("f", """select b.playername, b.block, avg(t.y) as mean, max_by(t.y, t.seq) as last,
        case when min(t.x) filter (t.y is not null) < max(t.x) filter (t.y is not null) then
          greatest(-1, least(1, regr_slope(t.y, t.x))) end as slope,
        avg(t.x) filter (t.y is not null) as mx, avg(t.y) filter (t.x is not null) as my
      from (select distinct playername, block, size from r where block > 0) b
      join x t on t.playername = b.playername and t.block < b.block
        and (b.size < 20 or t.block = b.block - 1)
      group by 1, 2"""),
    ("c", "select *, my - slope * mx as a from f"),
    ("h", """select *, a + slope * last as f1, a + slope * f1 as f2, a + slope * f2 as f3,
      a + slope * f3 as f4, a + slope * f4 as f5 from c""")], """
select matchid, playername, round(case when slope is null or last is null then mean else
  case (seq - 1) % 5 when 0 then f1 when 1 then f2 when 2 then f3 when 3 then f4 else f5 end end, 4)
  as ts_pred_points
from r left join h using (playername, block)""")
add("selection_objective", BACK + [
    ("pool", """select matchid, total_points as p, cast(playercost * 2 as int) as c,
      case playing_role when 'Batsmen' then 1 else 0 end as ba,
      case playing_role when 'Bowler' then 1 else 0 end as bo,
      case playing_role when 'AllRounder' then 1 else 0 end as al,
      case when playing_team = min(playing_team) over (partition by matchid) then 1 else 0 end
        as t1,
      row_number() over (partition by matchid order by playername) as i from base""")], """
select matchid, round(max(p), 6) as team_points from (
  with recursive s as (
    select matchid, 0 as i, 0 as n, 0 as ba, 0 as bo, 0 as al, 0 as t1, 0 as c,
      cast(0 as double) as p from (select distinct matchid from pool)
    union all
    select s.matchid, q.i, s.n + k, s.ba + k * q.ba, s.bo + k * q.bo, s.al + k * q.al,
      s.t1 + k * q.t1, s.c + k * q.c, max(s.p + k * q.p)
    from s join pool q on q.matchid = s.matchid and q.i = s.i + 1 cross join (values (0), (1)) v(k)
    where s.n + k <= 11 and s.ba + k * q.ba <= 7 and s.bo + k * q.bo <= 6
      and s.al + k * q.al <= 4 and s.t1 + k * q.t1 <= 7
      and s.n + k - s.t1 - k * q.t1 <= 7 and s.c + k * q.c <= 200
    group by 1, 2, 3, 4, 5, 6, 7, 8)
  select s.* from s join (select matchid, max(i) as last from pool group by 1) z
    on z.matchid = s.matchid and z.last = s.i
  where ba >= 3 and bo >= 3 and al >= 1)
group by 1""")
add("next_match", MATCH, """
select matchid, date, team1, team2, split_part(venue, ',', 1) as venue from matches
where date > '2015-06-01T00:00Z' order by date, matchid, team1, team2 limit 1""")
add("announced_squad", INFO + SQUAD[1:], """
, coming as (
  select distinct s.playername, s.playing_team, s.playercost, r.playing_role
  from players s join (select distinct playername, playing_role from points) r using (playername)
  where s.playing_team in ('Team0', 'Team1')),
recent as (
  select playername from (
    select *, dense_rank() over (partition by playing_team order by matchid desc) as r
    from teams where playing_team in ('Team0', 'Team1'))
  where r <= 2)
select 'announced' as state, playername, playing_team, playercost from coming
where playername in (select playername from players
                     where matchid = (select max(matchid) from players))
union all
select 'recent', playername, playing_team, playercost from coming
where playername in (select playername from recent)""")
add("semi_squad", SQUAD, """
select matchid, playername from players
where playername in (select playername from players
                     where matchid = (select max(matchid) from players))""")
add("new_matches", BASE + CUT, """
select distinct matchid from deliveries where matchid >= (select lo from cut)
  and matchid not in (select matchid from deliveries where matchid <= (select hi from cut))""")
add("append_common", BASE + CUT, """
select matchid, innings, batsmanname, bowlername, scorevalue from deliveries
where matchid <= (select hi from cut) or matchid > (select hi from cut)""")
add("append_outer", MATCH + CUT, """
select matchid, case when matchid <= (select hi from cut) then toss_winner end as toss_winner,
  winner, case when matchid > (select hi from cut) then result end as result from matches
where matchid <= (select hi from cut) or winner <> 'Match Tied/Cancelled/Not yet ended'""")
add("dedupe_squad", SQUAD, """
select playing_team as teamname, playername, min(matchid) as matchid from players group by 1, 2""")
add("squad_names", SQUAD + NAMES, """
select matchid, playing_team, master_name as playername from squads
join names on feed_name = playername""")
add("name_lookup", FEED + NAMES, """
select sequence, coalesce(a.master_name, batsman) as batsman,
  coalesce(b.master_name, bowler) as bowler, coalesce(c.master_name, nonstriker) as nonstriker
from feed left join first_name a on a.feed_name = batsman
left join first_name b on b.feed_name = bowler
left join first_name c on c.feed_name = nonstriker""")
add("heavy_names", FEED + NAMES, """
select sequence, coalesce(master_name, player) as player
from (select sequence, case when sequence % 5 < 2 then 'P-1' when sequence % 5 = 2 then batsman
        when sequence % 7 > 0 then bowler end as player from feed)
left join first_name on feed_name = player""")
add("feed_completeness", FEED, """
select eventid, innings, "over" as last_over, "over" >= 19.6 as complete
from (select *, row_number() over (partition by eventid, innings
        order by sequence desc, "over" desc) as r from feed) where r = 1""")
add("master_deliveries", FEED + NAMES + [("matches", MATCHES)] + CUT, """
select cast(cast(date[:10] as date) as varchar) as date, eventid as matchid, innings, target,
  fallofwickets, ball, "over", scorevalue, validball, extras, 'Nan' as extratype,
  coalesce(a.master_name, batsman) as batsmanname, scorevalue as batsmanscorevalue,
  coalesce(b.master_name, bowler) as bowlername,
  coalesce(c.master_name, nonstriker) as nonstrikername,
  cast(split_part(case when homescore = '0' then awayscore else homescore end, '/', 1) as int)
    as totalruns, dismissal, dismissaltype as dismissedtype,
  case when dismissal then coalesce(a.master_name, batsman) else '' end as dismissedplayer,
  batsmanteam as battingteam, bowlerteam as bowlingteam
from feed left join first_name a on a.feed_name = batsman
left join first_name b on b.feed_name = bowler
left join first_name c on c.feed_name = nonstriker
left join matches m on m.matchid = eventid
where eventid > (select hi from cut)""")


def _scored(alias: str, source: str) -> list[tuple[str, str]]:
    """The scoring chain over another set of deliveries."""
    return [(f"{alias}batting", BATTING.format(d=source)),
            (f"{alias}bowling", BOWLING.format(d=source)),
            (f"{alias}merged", CARD.format(a=alias)), (f"{alias}role", ROLE.format(a=alias)),
            (f"{alias}card", f"select * from {alias}merged left join {alias}role"
                             " using (playername)"),
            (f"{alias}points", POINTS.format(a=alias))]


add("master_update", BASE + CUT
    + [("old_d", "select * from deliveries where matchid <= (select hi from cut)"),
       ("new_d", "select * from deliveries where matchid > (select hi from cut)")]
    + _scored("old_", "old_d") + _scored("new_", "new_d"), """
select matchid, playername, playing_role, total_points from old_points
union all select matchid, playername, playing_role, total_points from new_points""")

add("stored_update", MATCH + CUT + [
    ("low", "select cast(floor(max(matchid) * cast(0.7 as double)) as bigint) as lo from deliveries"),
    ("squads", SQUADS)], """
select 'deliveries' as name, matchid, count(*) as stored from deliveries group by matchid
union all select 'points', matchid, count(*) from (
  select distinct matchid, playername from squads) group by matchid
union all select 'matches', matchid, count(*) from matches
  where matchid <= (select hi from cut) or winner <> 'Match Tied/Cancelled/Not yet ended'
  group by matchid""")
add("released_matches", FEED, """
select eventid, innings, sequence, "over", batsman, scorevalue, dismissal, runrate,
  eventid in (select eventid from (select eventid, innings from feed where "over" >= 19.6
                                   group by all) group by eventid having count(*) >= 2) as complete
from (select distinct * from feed)""")
add("broken_pages", FEED, """
select eventid, sequence, case sequence % 23 when 3 then 'broken' when 17 then 'broken'
  when 13 then 'no content' else 'no text' end as fault
from feed where sequence % 23 in (3, 7, 11, 13, 17)""")
add("sound_deliveries", FEED, """
select eventid, innings, sequence, "over", scorevalue, batsman from feed
where sequence % 23 not in (3, 7, 11, 13, 17)""")
add("drifting_headers", SQUAD, """
select matchid, playername, playing_team, case when matchid % 3 <> 2 then playercost end
  as playercost from squads""")

NEXT = SCORE + [
    ("matches0", MATCHES), ("squads", SQUADS), ("players", PLAYERS),
    ("next_id", "select max(matchid) + 1 as id from points"),
    ("squad", """
    select distinct q.playername, q.playing_team, r.playing_role, q.playercost,
      case when q.playing_team = 'Team0' then 'Team1' else 'Team0' end as opposition_team
    from players q join role r using (playername) where q.playing_team in ('Team0', 'Team1')"""),
    ("matches", """
    select matchid, year, city, venue, team1, team2, toss_winner from matches0
    union all select id, 2020, 'Mumbai', 'Wankhede Stadium, Mumbai', 'Team0', 'Team1', 'Team0'
    from next_id"""),
    ("clean", CLEAN),
    ("teams", TEAMS.replace("from points", """from (
      select *, cast(null as double) as playercost, cast(null as varchar) as pt,
        cast(null as varchar) as ot from points
      union all by name
      select id as matchid, playername, playing_role, playercost, playing_team as pt,
        opposition_team as ot from squad, next_id)""")),
    ("teams2", "select * replace (coalesce(pt, playing_team) as playing_team,"
               " coalesce(ot, opposition_team) as opposition_team) from teams"),
    ("known", KNOWN.format(teams="teams2", clean="clean")),
    *lag_ctes("known", "venue", VENUE), *lag_ctes("known", "playername", PLAYER)]
for frame in ("next_match_frame", "next_match_tails"):
    add(frame, NEXT, f"""
select matchid, playername, playing_team, opposition_team, playing_role, playercost, year, city,
  venue, home_game, toss_flag, player_match_count, {rounded(LAG_COLUMNS)}
from known left join venue_lags using (matchid, venue)
left join playername_lags using (matchid, playername)
where matchid = (select id from next_id)""")
