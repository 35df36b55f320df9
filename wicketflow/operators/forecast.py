"""Walk-forward forecasts per key with an autoregression on the previous value."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wicketflow.operators.rolling import SLICE_BITS, number_rows

BLOCK = 5
LONG_SERIES = 20


def walk_forward(df: DataFrame, key: str, order: str, target: str, out: str = "ts_pred_points",
                 tie: list[str] | None = None, slice_bits: int = SLICE_BITS) -> DataFrame:
    """Forecast each block of 5 rows from rows before it; the first 5 rows get null.

    A series of 20 rows or more learns from the previous block only, a shorter
    one from all earlier rows. The model is y[t] = a + b * y[t-1] by least
    squares with b held in [-1, 1]; without a usable slope it is the mean.

    Blocks, not histories, are grouped: 5 rows of a long series, fewer than 20
    of a short one. A key of any length is therefore spread over many tasks.
    """
    numbered = number_rows(df, key, order, tie, "_seq", "_size", slice_bits)
    rows = numbered.filter(F.col(key).isNotNull()).select(
        key, F.col(target).cast("double").alias("_y"), "_seq", "_size",
        F.floor((F.col("_seq") - 1) / BLOCK).alias("_block"))
    long = F.col("_size") >= LONG_SERIES
    last_block = F.floor((F.col("_size") - 1) / BLOCK)
    # Pairs (previous, current) never cross the start of a training set.
    neighbours = Window.partitionBy(key, "_part").orderBy("_seq")
    pairs = (rows.withColumn("_part", F.when(long, F.col("_block")).otherwise(F.lit(0)))
             .withColumn("_x", F.lag("_y").over(neighbours)))
    until = F.when(long, F.col("_block") + 1).otherwise(last_block)
    teaches = pairs.filter(F.col("_block") < last_block).withColumn(
        "_block", F.explode(F.sequence(F.col("_block") + 1, until)))
    slope = F.when(F.col("_low") < F.col("_high"),
                   F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("_b"))))
    fits = (teaches.groupBy(key, "_block").agg(
                F.regr_slope("_y", "_x").alias("_b"),
                F.min(F.when(F.col("_y").isNotNull(), F.col("_x"))).alias("_low"),
                F.max(F.when(F.col("_y").isNotNull(), F.col("_x"))).alias("_high"),
                F.avg(F.when(F.col("_y").isNotNull(), F.col("_x"))).alias("_mean_x"),
                F.avg(F.when(F.col("_x").isNotNull(), F.col("_y"))).alias("_mean_y"),
                F.avg("_y").alias("_mean"), F.max_by("_y", "_seq").alias("_last"))
            .withColumn("_b", slope)
            .withColumn("_a", F.col("_mean_y") - F.col("_b") * F.col("_mean_x"))
            .select(key, "_block", "_a", "_b", "_mean", "_last"))
    ahead = F.aggregate(
        F.sequence(F.lit(1), (F.col("_seq") - 1) % BLOCK + 1), F.col("_last"),
        lambda value, _: F.col("_a") + F.col("_b") * value)
    placed = numbered.withColumn("_block", F.floor((F.col("_seq") - 1) / BLOCK))
    return (placed.join(fits, [key, "_block"], "left")
            .withColumn(out, F.when(F.col("_a").isNull() | F.col("_last").isNull(), F.col("_mean"))
                        .otherwise(ahead))
            .select(*df.columns, out))
