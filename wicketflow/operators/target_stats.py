"""Categories as numbers: the mean target of rows that come before, in a hashed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Leading hex digits of the order that make a slice: 256 slices of each category.
SLICE_DIGITS = 2
#: How many rows of mean target each category begins with.
PRIOR_WEIGHT = 1.0


def hashed_order(keys: list[str], seed: str = "") -> Column:
    """A row's place in an order that depends on its keys alone (null keys count as empty)."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", F.lit(seed), *parts))


def prior(df: DataFrame, target: str) -> float:
    """The mean target of all rows that have one; 0 without any."""
    return df.agg(F.avg(F.col(target).cast("double"))).first()[0] or 0.0


def ordered_target_mean(df: DataFrame, category: str, target: str, keys: list[str],
                        out: str | None = None, mean: float | None = None,
                        weight: float = PRIOR_WEIGHT, seed: str = "") -> DataFrame:
    """`df` with the mean target of the category's rows before this one.

    Rows are ordered by a hash of `keys`, which should tell them apart; of equal hashes the
    rows do not see one another. The rows before are joined by `weight` rows of the overall
    mean, so the first row of a category has that mean. A row never sees its own target, nor
    one that sees its own: trees cannot read the answer off the code, whatever the number of
    values. A null category is a category; rows without a target are coded but not counted.

    A category is cut into slices of the order: what the slices before hold is added from a
    table of categories and slices, so that one with a third of all rows is spread over tasks.
    """
    out = out or f"{category}_mean"
    mean = prior(df, target) if mean is None else mean
    value = F.col(target).cast("double")
    told = df.withColumn("_order", hashed_order(keys, seed)).withColumn(
        "_slice", F.substring("_order", 1, SLICE_DIGITS))
    group = ["_category", "_slice"]
    told = told.withColumn("_category", F.col(category))
    slices = told.groupBy(*group).agg(F.sum(value).alias("_sum"), F.count(value).alias("_count"))
    ahead = Window.partitionBy("_category").orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1)
    slices = slices.select(F.col("_category").alias("_c"), F.col("_slice").alias("_s"),
                           F.coalesce(F.sum("_sum").over(ahead), F.lit(0.0)).alias("_sums"),
                           F.coalesce(F.sum("_count").over(ahead), F.lit(0)).alias("_counts"))
    # The rows up to this one, less those of its own hash: equal hashes do not see each other.
    upto = Window.partitionBy(*group).orderBy("_order").rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    peers = Window.partitionBy(*group, "_order")
    told = told.withColumns({
        "_own": F.coalesce(F.sum(value).over(upto), F.lit(0.0))
        - F.coalesce(F.sum(value).over(peers), F.lit(0.0)),
        "_n": F.count(value).over(upto) - F.count(value).over(peers)})
    joined = told.join(slices, F.col("_category").eqNullSafe(F.col("_c"))
                       & (F.col("_slice") == F.col("_s")), "left")
    code = (F.col("_own") + F.col("_sums") + F.lit(mean * weight)) / (
        F.col("_n") + F.col("_counts") + F.lit(weight))
    return joined.withColumn(out, code).select(*df.columns, out)


def target_means(df: DataFrame, category: str, target: str, mean: float | None = None,
                 weight: float = PRIOR_WEIGHT) -> DataFrame:
    """(value, code): what each category's rows come to as a whole, for rows to predict."""
    mean = prior(df, target) if mean is None else mean
    value = F.col(target).cast("double")
    return df.groupBy(F.col(category).alias("value")).agg(
        ((F.coalesce(F.sum(value), F.lit(0.0)) + F.lit(mean * weight))
         / (F.count(value) + F.lit(weight))).alias("code"))


def apply_target_means(df: DataFrame, means: DataFrame, category: str, mean: float,
                       out: str | None = None) -> DataFrame:
    """`df` with the category's code; a category that was not seen has the overall mean."""
    out = out or f"{category}_mean"
    coded = df.join(means.select(F.col("value").alias("_value"), F.col("code").alias("_code")),
                    F.col(category).eqNullSafe(F.col("_value")), "left")
    return coded.withColumn(out, F.coalesce("_code", F.lit(mean))).select(*df.columns, out)
