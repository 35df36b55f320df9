"""Line dedup by site-relative frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A line is boilerplate if it is on over this share of a host's pages ...
RATIO = 0.05
#: ... and on so many of them.
MIN_PAGES = 5


def _key(line: Column) -> Column:
    """What makes lines equal: the line without spaces and tabs at its ends, as a digest."""
    return F.unhex(F.md5(F.btrim(line, F.lit(" \t\r"))))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _with_words(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r")) != ""


def boilerplate(df: DataFrame, text: str, host: str, ratio: float = RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, lines): the keys of each host's boilerplate lines; hosts without any are left out.

    A page is a row. Distinct lines of a page are counted by host and line, combined before
    the shuffle, and divided by the host's pages. At most (lines per page) / `ratio` lines of
    a host can pass, which bounds the array.
    """
    pages = df.select(F.col(host).alias("host"), F.col(text).alias("text"))
    keys = F.array_distinct(F.transform(F.filter(_lines(F.col("text")), _with_words), _key))
    seen = (pages.select("host", F.explode(keys).alias("line"))
            .groupBy("host", "line").agg(F.count("*").alias("pages"))
            .where(F.col("pages") >= min_pages))
    total = pages.groupBy("host").agg(F.count("*").alias("total"))
    own = total.withColumnRenamed("host", "own")
    return (seen.join(own, F.col("host").eqNullSafe(F.col("own")))
            .where(F.col("pages") > ratio * F.col("total"))
            .groupBy("host").agg(F.collect_list("line").alias("lines")))


def drop_boilerplate(df: DataFrame, text: str = "text", host: str = "source",
                     ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """`df` with `clean_text`, `n_lines`, `n_dropped`: boilerplate lines of its host are dropped.

    Lines are what "\\n" separates; they are compared without outer spaces and tabs, and
    blank lines are never dropped. The remaining lines are joined by "\\n" as they were; a
    text without any left becomes empty, and a null text stays null with no lines. Rows
    without a host form one host. Equal rows count as several pages. A line that is on
    exactly `ratio` of the pages stays. Other columns pass through; none may be called like
    the new ones. Only hosts that have boilerplate take part in the join; a hot host's rows
    are split by adaptive execution.
    """
    clash = {"clean_text", "n_lines", "n_dropped"} & set(df.columns)
    if clash:
        raise ValueError(f"columns already exist: {sorted(clash)}")
    found = boilerplate(df, text, host, ratio, min_pages).select(
        F.col("host").alias("__host"), F.col("lines").alias("__lines"))
    joined = df.join(found, df[host].eqNullSafe(F.col("__host")), "left")
    lines = _lines(F.col(text))
    kept = F.when(F.col("__lines").isNull(), lines).otherwise(F.filter(
        lines, lambda x: ~_with_words(x) | ~F.array_contains(F.col("__lines"), _key(x))))
    has = F.col(text).isNotNull()
    return (joined.withColumn("__kept", kept)
            .withColumn("clean_text", F.when(has, F.array_join("__kept", "\n")))
            .withColumn("n_lines", F.when(has, F.size(lines)).otherwise(0).cast("long"))
            .withColumn("n_dropped",
                        F.when(has, F.size(lines) - F.size("__kept")).otherwise(0).cast("long"))
            .drop("__host", "__lines", "__kept"))
