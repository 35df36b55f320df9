import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_rolling import scored
from wicketflow.config import FeatureRules
from wicketflow.operators.scaling import fit_one_hot, fit_scaler
from wicketflow.plans import backtest as full
from wicketflow.plans import models, nextmatch, update
from wicketflow.plans.train import Rules, Tables, train
from wicketflow.queries import views
from wicketflow.session import stage
from wicketflow.streaming.feed import stream_updates

SF = "/root/testdata/sf0.001"


def test_scaler(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0), (None, None)], "a double, b double")
    assert rows(fit_scaler(df, ["a", "b"]).transform(df)) == [
        (None, None), (-1.0, 0.0), (1.0, 0.0)]


def test_one_hot(spark):
    df = spark.createDataFrame([("x",), ("y",), (None,)], "c string")
    encoder = fit_one_hot(df, ["c"])
    seen = encoder.transform(df.union(spark.createDataFrame([("new",)], "c string")))
    assert rows(seen) == [(None, 3), ("new", 0), ("x", 1), ("y", 2)]
    assert rows(encoder.flags(seen.drop("c_index"), {"c": ("x", "y", None)})) == [
        (None, 0, 0, 1), ("new", 0, 0, 0), ("x", 1, 0, 0), ("y", 0, 1, 0)]


def test_one_hot_of_many_values(spark):
    df = spark.range(5000).select(F.format_string("v%05d", "id").alias("c"), F.lit(1).alias("d"))
    got = fit_one_hot(df, ["c", "d"]).transform(df)
    assert got.filter("c_index <> cast(substr(c, 2) as int) + 1 or d_index <> 1").count() == 0
    assert got.count() == 5000


def test_boosted_trees_take_any_number_of_categories(spark):
    df = spark.range(900).selectExpr(
        "concat('city', id % 300) as city", "id % 3 as n", "cast(id % 7 as double) as total_points")
    plan = models.ModelPlan(categorical=("city",), numeric=("n",), folds=2, search={
        "gbt_cat": {"maxDepth": [2], "maxIter": [2, 3]}})
    model = models.fit_model("gbt_cat", df, plan)
    assert models.predict(model, df).filter("pred_points is null").count() == 0


def test_split(spark):
    df = spark.createDataFrame([(2018,), (2019,), (None,)], "year int")
    train_rows, test_rows = models.train_test_split(df, "year", [2019])
    assert rows(train_rows) == [(None,), (2018,)] and rows(test_rows) == [(2019,)]
    train_rows, test_rows = models.train_test_split(df)
    assert train_rows.count() == 3 and test_rows.count() == 0


def test_ensemble(spark):
    rng = random.Random(1)
    data = [(a, b, 2 * a - .5 * b) for a, b in
            ((rng.random() * 9, rng.random() * 9) for _ in range(50))] + [(1.0, None, 5.0)]
    df = spark.createDataFrame(data, "a double, b double, total_points double")
    weights = models.fit_ensemble(df, ["a", "b"])
    assert weights == {"a": pytest.approx(2), "b": pytest.approx(-.5)}
    got = models.predict_ensemble(df, weights)
    assert got.filter("pred_points is null").count() == 1
    assert got.filter("abs(pred_points - total_points) > 1e-6").count() == 0


PLAN = models.ModelPlan(
    categorical=("team", "city"), numeric=("n", "m"), draws=2, folds=2, max_bins=16, search={
        "rf": {"maxDepth": [3], "numTrees": [5, 8]}, "gbt": {"maxDepth": [3], "maxIter": [5]},
        "gbt_cat": {"maxDepth": [3], "maxIter": [5], "stepSize": lambda r: r.uniform(.1, .3)}})


def model_rows(spark):
    rng = random.Random(2)
    return spark.createDataFrame([
        (i, rng.choice(["A", "B", None]), "c", rng.choice([None, rng.random()]), rng.random(),
         float(i % 7), i % 5 == 0) for i in range(120)],
        "i bigint, team string, city string, n double, m double, total_points double, held boolean")


@pytest.mark.parametrize("name", ["rf", "gbt", "gbt_cat"])
def test_models_fit_save_and_score_unseen_values(spark, tmp_path, name):
    df = model_rows(spark)
    model = models.fit_model(name, df, PLAN, validation="held" if name == "gbt_cat" else None)
    models.save_model(model, str(tmp_path / name))
    loaded = models.load_model(str(tmp_path / name))
    fresh = df.withColumn("team", F.when(F.col("i") % 2 == 0, "never seen").otherwise(F.col("team")))
    assert rows(models.predict(loaded, fresh), "i", "pred_points") == rows(
        models.predict(model, fresh), "i", "pred_points")
    assert models.predict(loaded, fresh).filter("pred_points is null").count() == 0
    weights = {r.feature_name: r.feature_importance
               for r in models.feature_importance(model, df).collect()}
    assert set(weights) == {"team", "city", "n", "m"}
    assert sum(weights.values()) == pytest.approx(1)


def test_search_settings_are_drawn_once_per_seed():
    class Learner:
        def getParam(self, name):
            return name
    space = {"a": [1, 2, 3], "b": [1, 2, 3]}
    assert len(models._draw(Learner(), space, 100, 1)) == 9
    assert models._draw(Learner(), space, 4, 1) == models._draw(Learner(), space, 4, 1)
    assert len(models._draw(Learner(), {"a": lambda r: r.random()}, 5, 1)) == 5


def test_train_predict_and_back_test(spark, tmp_path):
    balls, matches = views.deliveries(spark, SF), views.matches(spark, SF)
    tables = Tables(str(tmp_path))
    small = models.ModelPlan(draws=1, search={"gbt_cat": {"maxDepth": [3], "maxIter": [3]}})
    paths = train(balls, matches, tables, ["movingaverage", "gbt_cat"],
                  rules=Rules(model=small), fit_scaler_on="train", use_forecast=True,
                  costs=views.players(spark, SF))
    assert set(paths) == {"gbt_cat"}
    frame = tables.read(spark, "features")
    wide = full.predict_all(frame, paths, ["movingaverage", "gbt_cat"], blend=True)
    assert {"pred_points_movingaverage", "pred_points_gbt_cat", "pred_points"} <= set(wide.columns)
    assert wide.count() == frame.count()
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Join" not in plan
    result = full.backtest(wide, matches)
    assert result.matches.count() == frame.select("matchid").distinct().count()
    counted = result.matches.filter("pred_selection_cnt = 11")
    assert counted.count() > 0 and counted.filter("error < -1e-9 or error is null").count() == 0
    assert result.years.agg(F.sum("rewards_earned")).first()[0] == \
        result.matches.agg(F.sum("rewards_earned")).first()[0]


def test_appending_twice_changes_nothing(spark, tmp_path):
    balls, matches = views.deliveries(spark, SF), views.matches(spark, SF)
    tables = Tables(str(tmp_path), slice_width=4)
    old = balls.filter("matchid < 20")
    from wicketflow.plans.train import score_deliveries
    update.create_tables(tables, old, score_deliveries(old), matches.filter("matchid < 20"))

    def state():
        return {n: rows(tables.read(spark, n).drop("match_slice"))
                for n in ("deliveries", "points", "matches")}
    update.append_to_tables(tables, balls.filter("matchid >= 15"), matches)
    once = state()
    assert once["deliveries"] == rows(balls, *tables.read(spark, "deliveries").drop("match_slice").columns)
    assert len(once["points"]) == views.squads(spark, SF).count()
    unfinished = matches.filter("matchid >= 20 and matchid % 10 >= 8").count()
    assert len(once["matches"]) == matches.count() - unfinished
    update.append_to_tables(tables, balls, matches)
    assert state() == once


def test_stream_equals_batch(spark, tmp_path):
    balls, matches = views.deliveries(spark, SF), views.matches(spark, SF)
    tables = Tables(str(tmp_path / "tables"))
    old = balls.filter("matchid < 25")
    from wicketflow.plans.train import score_deliveries
    update.create_tables(tables, old, score_deliveries(old), matches.filter("matchid < 25"))
    landing = str(tmp_path / "landing")
    balls.filter("matchid >= 20").coalesce(1).write.parquet(landing)
    for _ in range(2):
        query = stream_updates(spark, landing, matches, tables, str(tmp_path / "progress"),
                               balls.schema)
        query.awaitTermination(120)
        assert query.exception() is None
    assert tables.read(spark, "deliveries").count() == balls.count()
    assert tables.read(spark, "points").count() == views.squads(spark, SF).count()


def test_next_match_frame_needs_only_part_of_the_history(spark):
    points, info = scored(spark)
    costs = spark.createDataFrame(
        [("p0", "T0", "Batsmen", 9.0), ("p1", "T1", "Bowler", 8.0), ("rookie", "T1", "Bowler", 8.5),
         ("other", "T7", "Bowler", 8.5)],
        "playername string, playing_team string, playing_role string, playercost double")
    frame = nextmatch.next_match_frame(points, info, costs, "T0", "T1", "Bengaluru",
                                       "M Chinnaswamy Stadium", "T1", 2021)
    got = {r.playername: r for r in frame.collect()}
    assert set(got) == {"p0", "p1", "rookie"}
    assert {(r.matchid, r.year, r.venue) for r in got.values()} == {
        (30, 2021, "M Chinnaswamy Stadium")}
    assert (got["p0"].opposition_team, got["p0"].home_game, got["p0"].toss_flag) == ("T1", 1, 0)
    assert (got["p0"].player_match_count, got["rookie"].player_match_count) == (31, 1)
    assert got["rookie"].total_points_playername_avg2 is None
    last = [r.total_points for r in
            points.filter("playername = 'p0'").orderBy(F.desc("matchid")).limit(3).collect()]
    assert got["p0"].total_points_playername_avg3 == pytest.approx(sum(last) / 3)
    here = [r for r in points.collect() if r.matchid in (26, 28)]
    wanted = sum(sum({r.total_bat_points for r in here if r.matchid == m}) for m in (26, 28)) / 2
    assert {r.total_bat_points_venue_avg2 for r in got.values()} == {wanted}


@pytest.mark.parametrize("cuts", [(), (5, 29)])
def test_tails_merged_forward_equal_the_full_history(spark, cuts):
    points, info = (stage(df) for df in scored(spark))
    costs = spark.createDataFrame(
        [("p0", "T0", "Batsmen", 9.0), ("p1", "T1", "Bowler", 8.0), ("rookie", "T1", "Bowler", 8.5),
         ("rookie", "T0", "Bowler", 8.0), ("other", "T7", "Bowler", 8.5)],
        "playername string, playing_team string, playing_role string, playercost double")
    coming = ("T0", "T1", "Bengaluru", "M Chinnaswamy Stadium", "T1", 2021)
    wanted = nextmatch.next_match_frame(points, info, costs, *coming)
    edges = [-1, *cuts, 10 ** 6]
    state = None
    # Batches in falling order: later ones hold older matches.
    for low, high in reversed(list(zip(edges, edges[1:]))):
        part = points.filter((F.col("matchid") > low) & (F.col("matchid") <= high))
        batch = nextmatch.stored_tails(nextmatch.history_tails(part, info))
        state = batch if state is None else nextmatch.stored_tails(
            nextmatch.merged_tails(state, batch))
    got = nextmatch.next_match_from_tails(state, costs, *coming)
    columns = [c for c in got.columns if c in wanted.columns and c != "player_match_count"]
    assert [c for c in columns if "_avg" in c] and rows(got, *columns) == rows(wanted, *columns)
    assert rows(got, "playername", "player_match_count") == rows(
        wanted, "playername", "player_match_count")
    assert state.players.filter("size(tail) > 10").isEmpty()


def test_squad_restriction(spark):
    frame = spark.createDataFrame([(9, "x", "A"), (9, "y", "A"), (9, "z", "B")],
                                  "matchid bigint, playername string, playing_team string")
    history = spark.createDataFrame(
        [(m, p, t, "1", t, "?", "Batsmen") for m, p, t in
         ((1, "y", "A"), (2, "x", "A"), (3, "x", "A"), (1, "z", "B"), (7, "q", "C"))],
        "matchid bigint, playername string, bowler_bowlingteam string, batsmen_innings string,"
        " batsmen_battingteam string, batsmen_bowlingteam string, playing_role string"
    ).withColumn("bowler_battingteam", F.lit(None).cast("string"))
    announced = spark.createDataFrame([("y",)], "playername string")
    assert rows(nextmatch.restrict_to_squad(frame, announced, history), "playername") == [("y",)]
    for nobody in (None, announced.limit(0)):
        got = nextmatch.restrict_to_squad(frame, nobody, history)
        assert rows(got, "playername") == [("x",), ("z",)]


def test_report(spark):
    from tests.test_selection import PUBLISHED
    frame = spark.createDataFrame(
        [(1, n, r, t, c, a, b) for n, r, t, c, a, _, b, _ in PUBLISHED],
        "matchid bigint, playername string, playing_role string, playing_team string,"
        " playercost double, pred_points_catboost double, pred_points_ensemble double")
    wide = nextmatch.pick_per_model(frame, ["catboost", "ensemble"])
    ordered = nextmatch.report_order(wide)
    report = nextmatch.selection_report(ordered)
    assert report.columns == ["playername", "teamname", "playingrole", "playercost",
                              "model1_points", "model1_team", "model2_points", "model2_team"]
    top = report.first()
    assert (top.playername, top.model1_points, top.model1_team) == ("DJ Bravo", 38.0, 1.0)
    assert report.filter("model1_team = 1").count() == 11
    assert [r.model1_team for r in report.collect()] == [1.0] * 11 + [None] * 6


def test_windows_of_a_narrow_rule_set(spark):
    points, info = scored(spark, 6)
    from wicketflow.operators.features import features
    got = features(points, info, rules=FeatureRules(windows=(2,)))
    assert not [c for c in got.columns if c.endswith("avg3")]
