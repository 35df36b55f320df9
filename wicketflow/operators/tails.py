"""The last matches of each key as a small table that grows with keys, not with history."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def tails(totals: DataFrame, match: str, key: str, columns, depth: int,
          running: str | None = None) -> DataFrame:
    """One row per key: its newest match, running sum, and last `depth` matches, newest first.

    `totals` holds one row per match and key. The bound on the rank is applied before the
    shuffle, so a key that owns many matches sends `depth` rows per partition.
    """
    counted = F.col(running) if running else F.lit(1)
    sums = totals.groupBy(key).agg(F.sum(counted).cast("long").alias("running"))
    return _gathered(totals.select(key, match, *columns), sums, match, key, columns, depth)


def merge_tails(state: DataFrame, batch: DataFrame, match: str, key: str, columns,
                depth: int) -> DataFrame:
    """The tails of both. No match may be in both: a batch holds whole matches that are new.

    Matches may come late: the newest `depth` of both stay, in whatever order they came.
    """
    both = state.unionByName(batch)
    rows = both.select(key, F.explode("tail").alias("_t")).select(key, "_t.*")
    sums = both.groupBy(key).agg(F.sum("running").alias("running"))
    return _gathered(rows, sums, match, key, columns, depth)


def _gathered(rows: DataFrame, sums: DataFrame, match: str, key: str, columns,
              depth: int) -> DataFrame:
    newest = Window.partitionBy(key).orderBy(F.col(match).desc())
    last = (rows.filter(F.col(key).isNotNull())
            .withColumn("_row", F.row_number().over(newest)).filter(F.col("_row") <= depth))
    kept = last.groupBy(key).agg(
        F.max(match).alias("newest"),
        F.sort_array(F.collect_list(F.struct(match, *columns)), asc=False).alias("tail"))
    return kept.join(sums, key).select(key, "newest", "running", "tail")


def tail_means(state: DataFrame, key: str, columns, windows) -> DataFrame:
    """What a match after the newest one sees: (key, running, means of the last w matches).

    A mean is null until the key has w matches, as in `rolling.lagged_means`.
    """
    def mean(column, w):
        total = F.aggregate(F.slice("tail", 1, w), F.lit(0.0),
                            lambda acc, m: acc + m[column].cast("double"))
        return F.when(F.size("tail") >= w, total / w).alias(f"{column}_{key}_avg{w}")

    return state.select(key, "running", *[mean(c, w) for w in windows for c in columns])
