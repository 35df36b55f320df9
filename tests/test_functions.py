from pyspark.sql import functions as F

from tests.conftest import rows
from wicketflow.functions import nulls, text, times


def test_null_rules(spark):
    df = spark.createDataFrame(
        [(1, None, "x"), (None, None, None), (2, 3, "y")], "a int, b int, s string")
    got = df.select(nulls.add_missing_as_zero(F.col("a"), F.col("b")).alias("t"),
                    nulls.not_in(F.col("s"), ["x"]).alias("n"))
    assert rows(got) == [(None, True), (1, False), (5, True)]
    assert rows(df.agg(nulls.total(F.col("b")))) == [(3,)]
    assert rows(df.filter("b is null").agg(nulls.total(F.col("b")))) == [(0,)]
    assert rows(df.agg(nulls.count_or_null(F.col("a") > 5))) == [(None,)]
    assert rows(df.agg(nulls.count_or_null(F.col("a") > 1))) == [(1,)]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "a double, b int")
    assert rows(nulls.nan_to_null(df)) == [(None, 1), (2.0, 2)]


def test_fill_and_drop(spark):
    df = spark.createDataFrame([(None, None, "t"), (1.0, 2.0, None)], "a double, b double, s string")
    assert rows(nulls.fill(df, 0.0)) == [(0.0, 0.0, "t"), (1.0, 2.0, None)]
    assert rows(nulls.fill(df, -100.0, ["a"])) == [(-100.0, None, "t"), (1.0, 2.0, None)]
    assert rows(nulls.drop_incomplete(df, ["a", "b"])) == [(1.0, 2.0, None)]


def test_text(spark):
    df = spark.createDataFrame([
        ("A-B won by 31 runs in 2 days (3b rem)", "http://host/a/b/c/d/scorecard/9.html"),
        ("tie", "short")], "t string, u string")
    got = df.select(text.whole_numbers(F.col("t")).alias("n"), text.clean_name(F.col("t")).alias("c"),
                    text.url_segment(F.col("u"), 6).alias("s"),
                    text.first_piece(F.col("t"), " ").alias("p"))
    assert [tuple(r) for r in got.collect()] == [
        ([31, 2], "A B won by 31 runs in 2 days (3b rem)", "d", "A-B"), ([], "tie", None, "tie")]


def test_times_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("2021-10-04T23:30Z",), ("2021-10-05T01:30+04:00",)], "d string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "Asia/Tokyo", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            got = df.select(times.start_date(F.col("d")).cast("string"), times.year_text(F.col("d")))
            assert [tuple(r) for r in got.collect()] == [("2021-10-04", "2021"), ("2021-10-04", "2021")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
