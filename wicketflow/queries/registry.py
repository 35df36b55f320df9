"""Registered queries: every operator run over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wicketflow.operators import backtest as bt
from wicketflow.operators import features as ft
from wicketflow.operators import joins, points as pt, rolling, scaling, scorecard as sc
from wicketflow.operators import selection as sel, target_stats
from wicketflow.operators.forecast import walk_forward as forecast
from wicketflow.config import FeatureRules
from wicketflow.functions import text
from wicketflow.functions.times import year_text
from wicketflow.plans import backtest as full, models, nextmatch, update
from wicketflow.plans.train import Tables
from wicketflow.queries import views as v
from wicketflow.session import free_shuffles, fresh_path, stage, state_on_disk
from wicketflow.sources import feed as fd, files, html, pages
from wicketflow.streaming.release import Hold, release

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
KEYS = ["matchid", "playername"]
RULES = FeatureRules()
LAGS = [f"{c}_{k}_avg{w}" for k, cs in (("venue", RULES.venue_columns),
                                        ("playername", RULES.player_columns))
        for w in RULES.windows for c in cs]
# The search of predict_gbt and feature_importance: two values at least of every
# searched setting, drawn and cross-validated in four folds over all rows, with fewer draws and
# trees than `SEARCH`.
SHORT_SEARCH = models.ModelPlan(search={
    "rf": {"maxDepth": [4, 5], "minInstancesPerNode": [5, 10], "minInfoGain": [.001, .01],
           "numTrees": [10, 20], "featureSubsetStrategy": ["sqrt", "log2"]},
    "gbt": {"maxDepth": [2, 3], "stepSize": [.05, .1], "subsamplingRate": [.6, .8],
            "featureSubsetStrategy": ["0.7", "0.9"], "minInfoGain": [0.0, .01],
            "maxIter": [5, 8]}}, draws=2)


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def rounded(columns, digits: int = 6):
    return [F.round(c, digits).alias(c) for c in columns]


def _card(spark, d):
    return sc.scorecard(v.deliveries(spark, d), stage=stage)


def _points(spark, d):
    return pt.player_points(_card(spark, d))


def _known(spark, d, points=None):
    """Points with teams, match info and flags."""
    scored = _points(spark, d) if points is None else points
    return ft.add_flags(ft.add_match_info(
        ft.add_teams(scored), ft.clean_matches(v.matches(spark, d))))


def _features(spark, d):
    return ft.features(stage(_points(spark, d)), stage(v.matches(spark, d)))


def _base(spark, d):
    """One row per player and match with cost, prediction and actual points."""
    squad = v.players(spark, d).select(*KEYS, "playing_team", "playercost", "pred_points")
    return _points(spark, d).select(*KEYS, "playing_role", "total_points").join(squad, KEYS)


def _picked(spark, d):
    by_prediction = bt.pick_best(stage(_base(spark, d)), "pred_points", "pred_selection_true",
                                 "pred_selection_rank")
    return bt.pick_best(by_prediction, "total_points", "actual_selection_true",
                        "actual_selection_rank")


def _armband(spark, d):
    return bt.captaincy(_picked(spark, d), "total_points", "actual_selection_rank")


def _rewards(spark, d):
    return bt.rewards(bt.match_error(_armband(spark, d)))


def _cut(spark, d):
    last = v.last_match(spark, d)
    return int(last * 0.7), int(last * 0.8)


# Sources and sinks.

@query
def scan_roundtrip(spark, d):
    df = v.deliveries(spark, d)
    csv, parquet = fresh_path(spark, "csv"), fresh_path(spark, "parquet")
    files.write_csv(df, csv)
    files.write_parquet(files.read_csv(spark, csv, df.schema), parquet)
    return files.read_parquet(spark, parquet, df.schema)


@query
def partitioned_sink(spark, d):
    df = v.squads(spark, d).select("matchid", "playing_team", "playername", "playercost")
    path = fresh_path(spark, "per-team")
    files.write_per_key(df, path, "playing_team", "csv")
    return files.read_csv(spark, path, df.schema)


@query
def json_deliveries(spark, d):
    return pages.feed_deliveries(v.play_pages(spark, d).drop("sequence"))


@query
def json_matches(spark, d):
    return pages.schedule_matches(v.schedule_pages(spark, d)).withColumn(
        "by_how_many", F.concat_ws(",", F.col("by_how_many").cast("array<string>")))


@query
def json_squads(spark, d):
    return pages.squad_players(v.squad_pages(spark, d))


@query
def broken_pages(spark, d):
    landed = stage(v.damaged_pages(spark, d))
    return pages.broken_pages(landed, pages.PLAYS).select("eventid", "sequence", "fault")


@query
def sound_deliveries(spark, d):
    path = fresh_path(spark, "broken")
    sound = pages.quarantine(stage(v.damaged_pages(spark, d)), pages.PLAYS, path)
    return pages.feed_deliveries(sound.drop("sequence")).select(
        "eventid", "innings", "sequence", "over", "scorevalue", "batsman")


@query
def drifting_headers(spark, d):
    squad = v.squads(spark, d).select("matchid", "playername", "playing_team", "playercost")
    shapes = [squad.where("matchid % 3 = 0"),
              squad.where("matchid % 3 = 1").select(*reversed(squad.columns))
              .withColumnRenamed("playername", "new_playername"),
              squad.where("matchid % 3 = 2").drop("playercost").withColumn("note", F.lit("x, y"))]
    paths = [fresh_path(spark, f"shape{i}") for i in range(len(shapes))]
    for df, path in zip(shapes, paths):
        files.write_per_key(df.withColumn("folder", F.col("playing_team")), path, "folder", "csv")
    return files.read_csv_any_header(
        spark, [f"{p}/*" for p in paths],
        "matchid bigint, playername string, playing_team string, playercost double",
        {"new_playername": "playername"})


@query
def html_links(spark, d):
    return html.page_links(v.table(spark, d, "pages")).select(
        "url", "title", "position", "href", text.url_segment(F.col("url"), 2).alias("host"),
        text.url_segment(F.col("url"), 6).alias("part6"),
        F.regexp_replace("url", "example", "sample").alias("renamed"))


@query
def html_blocks(spark, d):
    found = v.table(spark, d, "pages").select("page_id", "html")
    return html.class_blocks(found, "ad", {"text": "ad"})


@query
def match_list(spark, d):
    return html.match_list(v.series_pages(spark, d))


# Scorecards and points.

@query
def batting_summary(spark, d):
    return sc.batting_summary(v.deliveries(spark, d))


@query
def bowling_summary(spark, d):
    return sc.bowling_summary(v.deliveries(spark, d)).withColumn(
        "economy_rate", F.round("economy_rate", 6))


@query
def bowling_wickets(spark, d):
    return sc.bowling_wickets(v.deliveries(spark, d))


@query
def maiden_overs(spark, d):
    return sc.maiden_overs(v.deliveries(spark, d))


@query
def merge_summaries(spark, d):
    balls = v.deliveries(spark, d)
    return sc.merge_summaries(sc.batting_summary(balls), sc.bowling_summary(balls)).withColumn(
        "economy_rate", F.round("economy_rate", 6))


@query
def player_role(spark, d):
    return sc.player_role(sc.match_card(v.deliveries(spark, d)))


@query
def scorecard(spark, d):
    return _card(spark, d).withColumn("economy_rate", F.round("economy_rate", 6))


@query
def batting_points(spark, d):
    scored = pt.batting_points(sc.match_card(v.deliveries(spark, d)))
    return scored.select(*KEYS, "total_runs_points", "run_6_points", "run_4_points",
                         "run_bonus_points", "total_bat_points")


@query
def bowling_points(spark, d):
    scored = pt.bowling_points(sc.match_card(v.deliveries(spark, d)))
    return scored.select(*KEYS, "total_wickets_points", "economy_rate_points",
                         "maiden_overs_points", "wicket_bonus_points", "total_bowl_points")


@query
def points(spark, d):
    return _points(spark, d).select(
        *KEYS, "playing_role", "total_bat_points", "total_bowl_points", "total_points")


# Features.

@query
def canonical_venue(spark, d):
    return ft.clean_matches(v.matches(spark, d)).select("matchid", "city", "venue")


@query
def split_prefix(spark, d):
    return v.matches(spark, d).select(
        "matchid", text.first_piece(F.col("venue"), ",").alias("venue"),
        year_text(F.col("date")).alias("year"))


@query
def player_team(spark, d):
    return ft.add_teams(sc.match_card(v.deliveries(spark, d))).select(
        *KEYS, "playing_team", "opposition_team")


@query
def match_features(spark, d):
    return _known(spark, d, sc.match_card(v.deliveries(spark, d))).select(
        *KEYS, "year", "city", "venue", "home_team", "away_team", "toss_winner")


@query
def match_flags(spark, d):
    return _known(spark, d, sc.match_card(v.deliveries(spark, d))).select(
        *KEYS, F.col("home_game").cast("int"), F.col("toss_flag").cast("int"))


@query
def player_match_count(spark, d):
    teams = ft.add_teams(stage(sc.match_card(v.deliveries(spark, d))))
    return ft.add_match_count(teams).select(*KEYS, "player_match_count")


@query
def lag_features(spark, d):
    scored = pt.player_points(stage(sc.match_card(v.deliveries(spark, d))))
    known = ft.add_match_info(scored, ft.clean_matches(v.matches(spark, d)))
    return ft.add_lags(known).select(*KEYS, *rounded(LAGS))


@query
def features(spark, d):
    return _features(spark, d).select(
        *KEYS, "playing_team", "opposition_team", "playing_role", "year", "city", "venue",
        "home_team", "away_team", "toss_winner", "home_game", "toss_flag", "player_match_count",
        "total_points", *rounded(LAGS))


def _player_lags(spark, d):
    """Points with the lagged means of the player's points."""
    scored = stage(pt.player_points(sc.match_card(v.deliveries(spark, d)))
                   .select(*KEYS, "total_points"))
    return rolling.add_lagged_means(scored, "matchid", "playername", ["total_points"],
                                    RULES.windows)


@query
def lean_patch(spark, d):
    return ft.add_lean_patch(_player_lags(spark, d)).select(
        *KEYS, "lean_patch_2", "lean_patch_3", "lean_patch_5")


@query
def recent_squad(spark, d):
    return ft.recent_squad(ft.add_teams(_card(spark, d))).select(
        "playername", "playing_team", "playing_role")


@query
def walk_forward(spark, d):
    scored = stage(pt.player_points(sc.match_card(v.deliveries(spark, d)))
                   .select(*KEYS, "total_points"))
    return forecast(scored, "playername", "matchid", "total_points").select(
        *KEYS, F.round("ts_pred_points", 4).alias("ts_pred_points"))


@query
def standardise(spark, d):
    scored = stage(pt.player_points(sc.match_card(v.deliveries(spark, d))))
    columns = ["total_bat_points", "total_bowl_points"]
    return scaling.fit_scaler(scored, columns).transform(scored).select(*KEYS, *rounded(columns))


@query
def one_hot(spark, d):
    card = stage(_card(spark, d))
    encoder = scaling.fit_one_hot(card, ["playing_role", "batsmen_innings"])
    known = {"playing_role": ("AllRounder", "Batsmen", "Bowler"),
             "batsmen_innings": ("1st innings", "2nd innings", None)}
    return encoder.flags(encoder.transform(card), known).select(
        *KEYS, *[f"{c}_{n}" for c in known for n in (1, 2, 3)])


# Models.

@query
def ordered_means(spark, d):
    known = stage(_base(spark, d))
    coded = target_stats.ordered_target_mean(known, "playername", "total_points", KEYS, "before")
    return coded.select(*KEYS, F.round("before", 6).alias("before"))


@query
def train_test_split(spark, d):
    known = _known(spark, d, stage(sc.match_card(v.deliveries(spark, d)))).select(*KEYS, "year")
    train, test = models.train_test_split(known, "year", [2019])
    return joins.append_common(train.withColumn("part", F.lit("train")),
                               test.withColumn("part", F.lit("test"))).drop("year")


@query
def predict_moving_average(spark, d):
    return models.predict_moving_average(_player_lags(spark, d)).select(
        *KEYS, F.round("pred_points", 6).alias("pred_points"))


def _predicted(spark, d, name, plan=models.ModelPlan()):
    frame = stage(_features(spark, d))
    train, _ = models.train_test_split(frame, "year", [2019])
    return models.run_model(name, train, frame, plan).select(*KEYS, "pred_points")


@query
def predict_rf(spark, d):
    return _predicted(spark, d, "rf")


@query
def predict_gbt(spark, d):
    return _predicted(spark, d, "gbt", SHORT_SEARCH)


@query
def predict_gbt_cat(spark, d):
    return _predicted(spark, d, "gbt_cat")


@query
def saved_model(spark, d):
    """Rows with a prediction, and whether a model read back from its files predicts the same."""
    frame = stage(_features(spark, d))
    plan = models.ModelPlan(search={"gbt": {"maxDepth": [2], "maxIter": [2]}})
    model = models.fit_model("gbt", frame, plan)
    path = fresh_path(spark, "model")
    models.save_model(model, path)
    both = models.predict(models.load_model(path),
                          models.predict(model, frame, "before"), "after")
    return both.select(*KEYS, (F.col("before") == F.col("after")).alias("same"))


@query
def feature_importance(spark, d):
    frame = stage(_features(spark, d))
    return models.feature_importance(models.fit_model("rf", frame, SHORT_SEARCH), frame)


@query
def ensemble_fit(spark, d):
    rows = stage(_base(spark, d)).withColumn(
        "cost_points", F.when(F.col("matchid") % 2 == 0, F.col("playercost")))
    weights = models.fit_ensemble(rows, ["pred_points", "cost_points"])
    return models.blend_model(spark, {m: round(w, 6) for m, w in weights.items()})


@query
def model_error(spark, d):
    base = stage(_base(spark, d))
    dated = joins.lookup_join(base, v.matches(spark, d).select("matchid", "year"), "matchid")
    return joins.append_outer(bt.model_error(dated, "pred_points", "total_points", "year"),
                              bt.model_error(base, "pred_points", "total_points")).select(
        "year", F.round("error", 6).alias("error"))


@query
def model_wide(spark, d):
    base = stage(_base(spark, d)).select(*KEYS, "playing_role", "playing_team", "playercost",
                                         "pred_points")
    keys = base.columns[:-1]
    return joins.combine_predictions(base.drop("pred_points"), {
        "a": base,
        "b": base.filter("matchid % 2 = 0").withColumn("pred_points", F.col("pred_points") / 2),
        "c": base.withColumn("pred_points", F.col("playercost") * 3)}, keys)


# Selection and back-test.

@query
def selection(spark, d):
    base = _base(spark, d).withColumns({
        "total_points": F.when(F.col("matchid") % 7 != 0, F.col("total_points")),
        "playercost": F.when(F.col("matchid") % 5 != 0, F.col("playercost"))})
    return sel.fill_candidates(base, "total_points")


@query
def selection_objective(spark, d):
    picks = sel.best_teams(stage(_base(spark, d)), "total_points")
    return sel.team_summary(picks).select("matchid", F.round("team_points", 6).alias("team_points"))


@query
def selection_team(spark, d):
    return sel.select_team(stage(_base(spark, d)), "pred_points", "pred_selection_true",
                           "pred_selection_rank")


@query
def selection_rank(spark, d):
    return _picked(spark, d).select(
        *KEYS, F.col("pred_selection_rank").cast("bigint"),
        F.col("actual_selection_rank").cast("bigint"), "pred_selection_true",
        "actual_selection_true")


@query
def captaincy(spark, d):
    return _armband(spark, d).select(*KEYS, "total_points")


@query
def match_error(spark, d):
    return bt.match_error(_armband(spark, d)).withColumn("error", F.round("error", 6))


@query
def rewards(spark, d):
    return _rewards(spark, d).select("matchid", "rewards_earned")


@query
def rewards_yearly(spark, d):
    return bt.rewards_yearly(_rewards(spark, d), v.matches(spark, d)).withColumn(
        "error", F.round("error", 6))


@query
def backtest_yearly(spark, d):
    """The whole back-test with exact teams."""
    return full.backtest(stage(_base(spark, d)), v.matches(spark, d)).years


@query
def selection_report(spark, d):
    wide = _picked(spark, d).select(
        *KEYS, "playing_role", "playing_team", "playercost",
        (F.col("pred_points") / 2).alias("pred_points_catboost"),
        F.col("pred_selection_true").alias("pred_selection_true_catboost"),
        (F.col("total_points") / 4).alias("pred_points_ensemble"),
        F.col("actual_selection_true").alias("pred_selection_true_ensemble"))
    return nextmatch.selection_report(nextmatch.report_order(wide))


# Next match.

@query
def next_match(spark, d):
    return fd.next_match(v.matches(spark, d), "2015-06-01T00:00Z")


#: Teams, city, venue, toss winner and year of the coming match.
COMING = ("Team0", "Team1", "Mumbai", "Wankhede Stadium, Mumbai", "Team0", 2020)


def _coming_squad(spark, d, scored):
    roles = scored.select("playername", "playing_role").distinct()
    return (v.players(spark, d).select("playername", "playing_team", "playercost").distinct()
            .join(roles, "playername"))


def _frame_columns(frame):
    return frame.select(
        *KEYS, "playing_team", "opposition_team", "playing_role", "playercost", "year", "city",
        "venue", "home_game", "toss_flag", "player_match_count", *rounded(LAGS))


@query
def next_match_frame(spark, d):
    scored = stage(_points(spark, d))
    return _frame_columns(nextmatch.next_match_frame(
        scored, stage(v.matches(spark, d)), _coming_squad(spark, d, scored), *COMING))


@query
def next_match_tails(spark, d):
    """The frame of the next match from tails that an update has merged forward."""
    _, high = _cut(spark, d)
    scored, info = stage(_points(spark, d)), stage(v.matches(spark, d))
    state, batch = (nextmatch.stored_tails(nextmatch.history_tails(scored.filter(part), info))
                    for part in (F.col("matchid") <= high, F.col("matchid") > high))
    kept = nextmatch.stored_tails(nextmatch.merged_tails(state, batch))
    return _frame_columns(nextmatch.next_match_from_tails(
        kept, _coming_squad(spark, d, scored), *COMING))


@query
def announced_squad(spark, d):
    """The coming match's players: those announced, and those of recent matches before that."""
    scored = stage(_points(spark, d))
    squad = nextmatch.upcoming_squad(_coming_squad(spark, d, scored), *COMING[:2], 0)
    announced = v.players(spark, d).filter(
        F.col("matchid") == v.last_match(spark, d)).select("playername")
    return reduce(DataFrame.unionByName, [
        nextmatch.restrict_to_squad(squad, names, scored).select(
            F.lit(state).alias("state"), "playername", "playing_team", "playercost")
        for state, names in (("announced", announced), ("recent", None))])


@query
def semi_squad(spark, d):
    squad = v.players(spark, d).select(*KEYS)
    newest = squad.filter(F.col("matchid") == v.last_match(spark, d))
    return joins.keep_known(squad, newest, "playername")


# Feed and masters.

@query
def completed_matches(spark, d):
    return fd.completed_matches(v.matches(spark, d)).select("matchid", "result")


@query
def new_matches(spark, d):
    low, high = _cut(spark, d)
    ids = v.deliveries(spark, d).select("matchid")
    return joins.keep_new(ids.filter(F.col("matchid") >= low).distinct(),
                          ids.filter(F.col("matchid") <= high), "matchid")


@query
def append_common(spark, d):
    _, high = _cut(spark, d)
    balls = v.deliveries(spark, d)
    shared = ["matchid", "innings", "batsmanname", "bowlername", "scorevalue"]
    master = balls.filter(F.col("matchid") <= high).select(*shared, "fallofwickets")
    incoming = balls.filter(F.col("matchid") > high).select("over", *reversed(shared))
    return joins.append_common(master, incoming)


@query
def append_outer(spark, d):
    _, high = _cut(spark, d)
    summary = v.matches(spark, d)
    master = summary.filter(F.col("matchid") <= high).select("matchid", "toss_winner", "winner")
    incoming = summary.filter(F.col("matchid") > high).select("matchid", "winner", "result")
    return joins.append_outer(master, update.finished(incoming))


@query
def dedupe_squad(spark, d):
    squad = v.players(spark, d).select(
        F.col("playing_team").alias("teamname"), "playername", "matchid")
    return fd.dedupe_squad(squad, [F.col("matchid")])


@query
def squad_names(spark, d):
    squad = v.squads(spark, d).select("matchid", "playing_team", "playername")
    return fd.squad_names(squad, v.name_map(spark, d))


@query
def name_lookup(spark, d):
    feed = v.feed(spark, d).select("sequence", "batsman", "bowler", "nonstriker")
    return joins.lookup_name(feed, v.name_map(spark, d), ["batsman", "bowler", "nonstriker"])


@query
def heavy_names(spark, d):
    """Names looked up without a broadcast, two rows of five under one name and some without."""
    feed = v.feed(spark, d).select("sequence", F.when(F.col("sequence") % 5 < 2, "P-1").when(
        F.col("sequence") % 5 == 2, F.col("batsman")).otherwise(
        F.when(F.col("sequence") % 7 > 0, F.col("bowler"))).alias("player"))
    return joins.lookup_name(stage(feed), v.name_map(spark, d), ["player"], small=False)


@query
def feed_completeness(spark, d):
    return fd.feed_completeness(v.feed(spark, d))


@query
def master_deliveries(spark, d):
    _, high = _cut(spark, d)
    master = v.deliveries(spark, d).filter(F.col("matchid") <= high)
    return fd.master_deliveries(v.feed(spark, d), v.name_map(spark, d), v.matches(spark, d), master)


@query
def master_update(spark, d):
    low, high = _cut(spark, d)
    balls, summary = v.deliveries(spark, d), v.matches(spark, d)
    old = balls.filter(F.col("matchid") <= high)
    masters = update.Masters(
        old, stage(pt.player_points(sc.scorecard(old, stage=stage))),
        summary.filter(F.col("matchid") <= high))
    after = update.update_masters(masters, balls.filter(F.col("matchid") >= low),
                                  summary.filter(F.col("matchid") >= low), stage=stage)
    return after.points.select(*KEYS, "playing_role", "total_points")


@query
def stored_update(spark, d):
    """Counts of the stored masters after an update that is run twice."""
    low, high = _cut(spark, d)
    balls, summary = stage(v.deliveries(spark, d)), stage(v.matches(spark, d))
    tables = Tables(fresh_path(spark, "masters"))
    old = balls.filter(F.col("matchid") <= high)
    update.create_tables(tables, old, pt.player_points(sc.scorecard(old, stage=stage)),
                         summary.filter(F.col("matchid") <= high))
    for batch in ("first", None):
        update.append_to_tables(tables, balls.filter(F.col("matchid") >= low),
                                summary.filter(F.col("matchid") >= low), stage=stage, batch=batch)
    return reduce(DataFrame.unionByName, [
        tables.read(spark, name).groupBy("matchid").agg(F.count("*").alias("stored"))
        .select(F.lit(name).alias("name"), "matchid", "stored")
        for name in ("deliveries", "points", "matches")])


@query
def released_matches(spark, d):
    """The feed landed in three parts, some of it twice, and read as a stream a part at a time."""
    landing, out, progress = (fresh_path(spark, n) for n in ("landing", "released", "progress"))
    feed = v.feed(spark, d)
    part = F.pmod(F.xxhash64("sequence"), F.lit(3))
    columns = feed.columns + ["landed"]
    # Sequence numbers of the test feed come more than once; deliveries are told by all columns.
    hold = Hold(unique=tuple(feed.columns))
    for day in (1, 2, 3, 60):
        stamp = F.date_add(F.to_date(F.lit("2021-01-01")), day).cast("timestamp")
        now = feed.where((part == day - 1) | (part == 0) & (day == 3)) if day < 60 else \
            spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name)
                                    for f in feed.schema])
        now.withColumn("landed", stamp).select(*columns).write.mode("append").option(
            "compression", "zstd").parquet(landing)
        rows = release(spark.readStream.schema(spark.read.parquet(landing).schema)
                       .parquet(landing), hold)
        with state_on_disk(spark):
            stream = (rows.writeStream.format("parquet").option("path", out)
                      .option("compression", "zstd").option("checkpointLocation", progress)
                      .trigger(availableNow=True).start())
            stream.awaitTermination()
        del stream
        free_shuffles(spark)
    return spark.read.parquet(out).select("eventid", "innings", "sequence", "over", "batsman",
                                          "scorevalue", "dismissal", "runrate", "complete")
