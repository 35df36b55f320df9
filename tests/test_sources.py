import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wicketflow import schemas
from wicketflow.queries import views
from wicketflow.sources import feed, files, html, pages


def item(sequence, **extra):
    side = {"athlete": {"id": 7, "name": "Bat"}, "team": {"name": "T1"}}
    return {
        "sequence": sequence, "periodText": "1st innings",
        "innings": {"balls": 1, "legByes": 4, "totalRuns": 9, "fallOfWickets": 2, "runRate": 6.5,
                    "target": 0, "remainingBalls": 100},
        "over": {"overs": 0.1, "noBall": 1, "wide": 2, "byes": 3}, "scoreValue": 4,
        "dismissal": {"dismissal": False, "type": ""}, "batsman": side, "bowler": side,
        "otherBatsman": {"athlete": {"id": 8, "name": "Other"}}, "athletesInvolved": [],
        "homeScore": "9/2", "awayScore": "0", "unknown": [1], **extra}


def test_play_pages(spark):
    out = item(2, dismissal={"dismissal": True, "type": "caught"},
               athletesInvolved=[{"id": 5, "name": "Keeper"}, {"id": 6, "name": "No"}])
    broken = item(3, dismissal={"dismissal": True, "type": "bowled"})
    texts = [json.dumps({"commentary": {"items": items}}) for items in (
        [item(1), out, {}, item(99)], [broken, None, item(98)], [], [{}, item(97)])]
    df = spark.createDataFrame([("s", 11, t) for t in texts],
                               "ipl_season string, eventid bigint, page string")
    got = pages.feed_deliveries(df)
    assert len(got.columns) == 28
    found = {r.sequence: r for r in got.collect()}
    assert set(found) == {1, 2, 3}
    first = found[1]
    assert (first.validball, first.extras, first.scorevalue, first.runs) == (3, 10, 4, 9)
    assert (first.otherathleteinvolvedid, first.otherathleteinvolved) == (None, "")
    assert (found[2].otherathleteinvolvedid, found[2].otherathleteinvolved) == (5, "Keeper")
    assert found[3].otherathleteinvolved is None


@pytest.mark.parametrize("status, kind, wkts", [
    ("A won by 10 runs", "runs", "runs"), ("B won by 3 wickets", "wickets", "wickets"),
    ("B won by 3 wkts", "", "wickets"), ("No result", "", "")])
def test_schedule(spark, status, kind, wkts):
    page = json.dumps({"content": {"matchEvents": [{
        "id": 5, "date": "2021-10-04T14:00Z", "venue": {"name": "V, City"}, "statusText": status,
        "competitors": [{"name": "A", "isWinner": False},
                        {"name": "B", "isWinner": status.startswith("B")}]}]}})
    df = spark.createDataFrame([(2021, page)], "year bigint, page string")
    got = pages.schedule_matches(df).first()
    assert (got.by_what, got.city, got.venue, got.year) == (kind, "V, City", "V, City", 2021)
    assert got.winner == ("B" if status.startswith("B") else "Match Tied/Cancelled/Not yet ended")
    assert got.by_how_many == [int(x) for x in status.split() if x.isdigit()]
    assert pages.schedule_matches(df, match_wkts=True).first().by_what == wkts


def test_squads_wait_for_the_announcement(spark):
    def page(title):
        player = {"name": "P", "isCaptain": True, "position": "Bowler", "link": {"href": "/p"}}
        return json.dumps({"content": {"squads": [
            {"title": title, "teamName": "A", "players": [player]},
            {"title": "Other", "teamName": "B", "players": [player, {**player, "name": "Q"}]}]}})
    df = spark.createDataFrame([(1, page("Playing XI")), (2, page("Squads"))],
                               "matchid bigint, page string")
    assert rows(pages.squad_players(df), "matchid", "playername", "teamname") == [
        (1, "P", "A"), (1, "P", "B"), (1, "Q", "B")]
    assert pages.squad_players(df, announced_only=False).count() == 6


def test_headers_may_drift(spark, tmp_path):
    texts = {
        "a.csv": "playername,iscaptain,position,profilelink,teamname\nP,False,Bowler,/p,A\n",
        "b.csv": "iscaptain,position,profilelink,teamname,new_playername\nTrue,Batsman,/q,B,Q\n",
        "c.csv": "iscaptain,position,profilelink,teamname,playername\nFalse,Keeper,/r,C,R\n",
        "d.csv": "playername,teamname\nS,D\n"}
    for name, content in texts.items():
        (tmp_path / name).write_text(content)
    got = files.read_csv_any_header(spark, [str(tmp_path / n) for n in texts], schemas.SQUAD,
                                    {"new_playername": "playername"})
    assert got.dtypes[:2] == [("playername", "string"), ("iscaptain", "boolean")]
    assert rows(got, "playername", "iscaptain", "teamname") == [
        ("P", False, "A"), ("Q", True, "B"), ("R", False, "C"), ("S", None, "D")]


def test_one_folder_per_key(spark, tmp_path):
    df = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3)], "team string, n bigint")
    path = str(tmp_path / "out")
    files.write_per_key(df, path, "team", "csv")
    assert {p.name for p in (tmp_path / "out").iterdir() if p.is_dir()} == {"team=A", "team=B"}
    assert rows(files.read_csv(spark, path, "n bigint, team string")) == [
        (1, "A"), (2, "A"), (3, "B")]


PAGE = """<html><body><a href="/outside">x</a>
<div class="match default-match-block"><span class="bold">Apr <b>5</b></span>
<div class="innings-info-1">A 10/2 &amp; more<br></div><div class="innings-info-2"> B </div>
<p class="match-status">A won</p>
<a href="http://host/ci/engine/match/991/scorecard/991.html">card</a><a href="/second">y</a></div>
<div class="default-match-block"><div class="innings-info-1">only</div></div></body></html>"""


def test_match_blocks(spark):
    df = spark.createDataFrame([("s1", PAGE), ("s2", None), ("s3", "<p>none")],
                               "ipl string, html string")
    got = html.match_list(df).orderBy("inningsinfo1").collect()
    assert len(got) == 2
    assert tuple(got[0]) == (
        "s1", "Apr 5", "991", "A 10/2 & more", "B", "A won",
        "http://host/ci/engine/match/991/commentary/991.html")
    assert (got[1].inningsinfo1, got[1].date, got[1].commentary_link) == ("only", None, None)


def test_feed_to_master(spark):
    deliveries = spark.createDataFrame([
        (1, "1st innings", "A", "X", "A", True, "0", "12/1", 4),
        (1, "1st innings", "Q", "X", "A", False, "7/0", "0", 0),
        (2, "1st innings", "A", "X", "A", False, "7/0", "0", 0)],
        "eventid bigint, innings string, batsman string, bowler string, nonstriker string,"
        " dismissal boolean, homescore string, awayscore string, scorevalue int")
    for name in ("target", "fallofwickets", "ball", "over", "validball", "extras",
                 "dismissaltype", "batsmanteam", "bowlerteam"):
        deliveries = deliveries.withColumn(name, F.lit(None).cast("string"))
    names = spark.createDataFrame([(1, "A", "AA")], schemas.NAME_MAP)
    matches = spark.createDataFrame([(1, "2021-10-04T14:00Z")], "matchid bigint, date string")
    master = spark.createDataFrame([(2,)], "matchid bigint")
    got = feed.master_deliveries(deliveries, names, matches, master)
    assert set(got.columns) == {c.split()[0].strip("`") for c in
                                schemas.DELIVERIES.replace("\n", " ").split(",")}
    assert rows(got, "batsmanname", "bowlername", "nonstrikername", "totalruns",
                "dismissedplayer", "date") == [
        ("AA", "X", "AA", 12, "AA", "2021-10-04"), ("Q", "X", "AA", 7, "", "2021-10-04")]


def test_next_match_is_the_earliest_later_one(spark):
    df = spark.createDataFrame([
        (1, "2021-10-09T14:00Z", "A", "B", "V1, C"), (2, "2021-10-05T14:00Z", "C", "D", "V2, C"),
        (3, "2021-10-04T10:00Z", "E", "F", "V3")],
        "matchid bigint, date string, team1 string, team2 string, venue string")
    got = feed.next_match(df, "2021-10-04T15:00+04:00")
    assert rows(got, "matchid", "venue") == [(2, "V2")]
    assert feed.next_match(df, "2022-01-01T00:00Z").count() == 0


def test_completeness_per_innings(spark):
    df = spark.createDataFrame([
        (1, "1st innings", 5, 19.6), (1, "1st innings", 4, 0.1), (1, "2nd innings", 9, 12.3)],
        "eventid bigint, innings string, sequence bigint, `over` double")
    assert rows(feed.feed_completeness(df)) == [
        (1, "1st innings", 19.6, True), (1, "2nd innings", 12.3, False)]


def test_squad_names_drop_unmapped_and_repeat_mapped(spark):
    squad = spark.createDataFrame([("A", "T"), ("A", "T"), ("Z", "T")],
                                  "playername string, teamname string")
    names = spark.createDataFrame([(1, "A", "A1"), (2, "A", "A2")], schemas.NAME_MAP)
    assert rows(feed.squad_names(squad, names), "playername") == [("A1",), ("A2",)]


def test_headers_are_read_in_one_pass(spark, tmp_path):
    for i in range(40):
        folder = tmp_path / f"a b%20{i % 3}"
        folder.mkdir(exist_ok=True)
        columns = ["n", "team"] if i % 2 else ["team", "n"]
        text = ",".join(columns) + "\n" + "".join(
            ",".join({"n": str(100 * i + j), "team": '"x, y"'}[c] for c in columns) + "\n"
            for j in range(3))
        (folder / f"f {i}.csv").write_text("" if i == 39 else ("\ufeff" if i == 4 else "") + text)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "")
    shapes = files.header_shapes(spark, [str(p) for p in sorted(tmp_path.iterdir())])
    jobs = len(tracker.getJobIdsForGroup("headers"))
    spark.sparkContext.setJobGroup("", "")
    assert set(shapes) == {("n", "team"), ("team", "n")} and jobs <= 3
    assert sum(map(len, shapes.values())) == 39
    got = files.read_csv_any_header(spark, [str(p) for p in sorted(tmp_path.iterdir())],
                                    "team string, n bigint, more int")
    assert sorted(map(tuple, got.collect())) == [
        ("x, y", 100 * i + j, None) for i in range(39) for j in range(3)]
    assert files.read_csv_any_header(spark, [str(tmp_path / "a b%200" / "f 39.csv")],
                                     "n bigint").count() == 0


def test_broken_pages_are_set_aside(spark, tmp_path):
    good = '{"content":{"squads":[]}}'
    landed = [(1, good), (2, good[:-3]), (3, "[1"), (4, ""), (5, " "), (6, None), (7, "{}"),
              (8, '{"content":{"squads":null}}'), (9, '{"content":{"squads":5}}'), (1, good),
              (10, "null")]
    df = spark.createDataFrame(landed, "id int, page string")
    path = str(tmp_path / "broken")
    sound = pages.quarantine(df, pages.SQUADS, path)
    broken = spark.read.parquet(path)
    assert rows(sound, "id") == [(1,), (1,)]
    assert sound.count() + broken.count() == len(landed)
    faults = dict(rows(broken, "id", "fault"))
    assert faults == {2: "broken", 3: "broken", 4: "no text", 5: "no text", 6: "no text",
                      7: "no content", 8: "no content", 9: "broken", 10: faults[10]}


def lines(spark, folder):
    """Order lines, some without a number, quantity, supplier or flag."""
    spark.range(240).selectExpr(
        "if(id % 11 = 3, null, id div 4) as l_orderkey", "id * 7 % 90 as l_partkey",
        "if(id % 13 = 5, null, id % 40) as l_suppkey", "cast(id % 4 as int) as l_linenumber",
        "if(id % 17 = 2, null, cast(1 + id % 50 as double)) as l_quantity",
        "if(id % 3 = 0, 'R', if(id % 3 = 1, 'N', null)) as l_returnflag",
        "if(id % 2 = 0, 'F', 'O') as l_linestatus").write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_pages_of_deliveries_are_made_outside_of_their_reading(spark, tmp_path):
    made = views.play_pages(spark, lines(spark, tmp_path))
    plan = pages.feed_deliveries(made)._jdf.queryExecution().executedPlan().toString()
    reading = [line for line in plan.splitlines() if "from_json" in line]
    assert len(reading) == 1 and not any(
        word in reading[0] for word in ("named_struct", "concat", "invoke", "Team"))

    found = made.select("sequence", "page").collect()
    assert len(found) == 240
    for sequence, page in found:
        first, empty, decoy = json.loads(page)["commentary"]["items"]
        assert empty == {} and first.get("sequence") == sequence
        assert decoy.get("sequence") == (None if sequence is None else sequence + 1)
        assert {**first, "sequence": 0} == {**decoy, "sequence": 0}
        assert first["periodText"] in ("1st innings", "2nd innings")


def test_matches_sort_no_deliveries(spark, tmp_path):
    found = views.matches(spark, lines(spark, tmp_path))
    assert "Sort" not in found._jdf.queryExecution().executedPlan().toString()
    assert rows(found, "matchid", "team1", "team2") == [
        (None, None, None), (0, "Team0", "Team1"), (1, "Team1", "Team2")]


def test_squads_are_the_distinct_players_of_all_deliveries(spark, tmp_path):
    folder = lines(spark, tmp_path)
    played = views.deliveries(spark, folder).select(
        "matchid", F.inline(F.array(*[
            F.struct(F.col(team).alias("playing_team"), F.col(name).alias("playername"))
            for team, name in (("battingteam", "batsmanname"), ("bowlingteam", "bowlername"))])))
    found = views.squads(spark, folder)
    assert rows(found, "matchid", "playing_team", "playername") == rows(played.distinct())
    assert found.filter("playername is null").count() > 0

    plan = found._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(moved) == 1 and "playername" not in moved[0] and "block" in moved[0]
