"""Join helpers: size-checked broadcast, measured hot keys, key membership."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A lookup table may be broadcast up to this many rows of a few narrow columns.
BROADCAST_ROWS = 100_000
#: Hot keys that a join spreads at most; a key below one row in so many is never hot.
HOT_KEYS = 1000
#: Keys that the sketch of frequent keys tracks: its counts are off by less than 2 rows in so many.
TRACKED = 16 * HOT_KEYS


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """True when the table has at most `max_rows` rows. A distributed count; nothing is collected."""
    return df.count() <= max_rows


def lookup_join(facts: DataFrame, lookup: DataFrame, on, how: str = "left",
                small: bool | None = None, salts: int = 0) -> DataFrame:
    """Join a large table to a lookup table (left, inner, semi or anti).

    A lookup is broadcast once its size is known to fit; `small` passes on a
    size the caller has checked already. A larger one is a shuffled join, whose
    hot partitions adaptive execution splits. With `salts`, the number of tasks to
    spread over, hot keys are measured and spread instead: for few lookup rows
    against many facts per key.
    """
    if fits_broadcast(lookup) if small is None else small:
        return facts.join(F.broadcast(lookup), on, how)
    if salts:
        return spread_join(facts, lookup, on, how, salts)
    return facts.join(lookup, on, how)


def hot_keys(facts: DataFrame, on, tasks: int) -> tuple[dict[int, int], int]:
    """Key hashes with more rows than a task's share, and over how many tasks to spread each.

    Also the same number for the rows whose key holds a null (1: not hot). One pass over
    the keys alone: a sketch of frequent items of fixed size, combined before the shuffle. Only
    keys above the share come to the driver, fewer than `tasks` and at most `HOT_KEYS`.
    """
    keys = [on] if isinstance(on, str) else list(on)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    hashed = facts.select(F.when(known, F.xxhash64(*keys)).alias("_key"))
    found = hashed.agg(
        F.count("*").alias("rows"), F.count("_key").alias("known"),
        F.expr(f"approx_top_k(_key, {HOT_KEYS}, {TRACKED})").alias("top"))
    wide = F.expr("transform(filter(top, t -> t.item is not null and"
                  f" t.count > rows / {float(min(tasks, HOT_KEYS))}D), t ->"
                  f" struct(t.item as key, cast(ceil(t.count * {float(tasks)}D / rows) as int)"
                  " as copies))")
    told = found.select("rows", "known", wide.alias("hot")).first()
    nulls = told["rows"] - told["known"]
    copies = {r["key"]: min(r["copies"], tasks) for r in told["hot"] or []}
    return copies, max(1, -(-nulls * tasks // told["rows"])) if told["rows"] else 1


def spread_join(facts: DataFrame, lookup: DataFrame, on, how: str = "left",
                tasks: int | None = None) -> DataFrame:
    """Equi-join (left, inner, semi or anti) that spreads hot keys of `facts` by their share.

    A key with a third of the rows goes to a third of the tasks, and only its lookup rows
    are copied as often; all other keys stay as they are. Rows without a key find nothing and
    are spread alike. The salt is a hash of the row, so that a retried task sends rows
    to the same place; rows that are equal in all columns stay together.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"lookup rows are copied, so no {how} join")
    keys = [on] if isinstance(on, str) else list(on)
    spark = facts.sparkSession
    tasks = tasks or _tasks(facts)
    hot, nulls = hot_keys(facts, keys, tasks)
    if not hot and nulls == 1:
        return facts.join(lookup, keys, how)
    copies = F.broadcast(spark.createDataFrame(list(hot.items()), "_key bigint, _copies int"))
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    place = F.pmod(F.xxhash64(*[F.col(c) for c in facts.columns]),
                   F.when(known, F.coalesce("_copies", F.lit(1))).otherwise(nulls)).cast("int")
    salted = (facts.withColumn("_key", F.xxhash64(*keys)).join(copies, "_key", "left")
              .withColumn("_salt", place).drop("_key", "_copies"))
    copied = (lookup.withColumn("_key", F.xxhash64(*keys)).join(copies, "_key", "left")
              .withColumn("_salt", F.explode(F.sequence(
                  F.lit(0), F.coalesce("_copies", F.lit(1)) - 1))).drop("_key", "_copies"))
    return salted.join(copied, [*keys, "_salt"], how).drop("_salt")


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def null_safe_join(left: DataFrame, right: DataFrame, on, how: str = "left") -> DataFrame:
    """Equi-join in which a null key equals a null key. Key columns come from the left."""
    keys = list(on)
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def keep_known(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in the other table."""
    return lookup_join(df, other.select(key).distinct(), key, "left_semi")


def keep_new(df: DataFrame, master: DataFrame, on) -> DataFrame:
    """Rows whose key does not occur in the master table.

    The incoming side is the smaller one, so its keys filter the master's scan
    first; the master's own keys are neither collected nor shuffled as a whole.
    """
    keys = [on] if isinstance(on, str) else list(on)
    wanted = df.select(*keys).distinct()
    seen = master.select(*keys)
    if fits_broadcast(wanted):
        known = seen.join(F.broadcast(wanted), keys, "left_semi").distinct()
        return df.join(F.broadcast(known), keys, "left_anti")
    known = seen.distinct().join(wanted, keys, "left_semi")
    return df.join(known, keys, "left_anti")


def first_per_key(df: DataFrame, keys, order: list[Column]) -> DataFrame:
    """One row per key: the first under an explicit order.

    The rank filter is applied to each input partition before the shuffle, so a
    key that owns many rows sends one row per partition.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rank", F.row_number().over(window))
            .filter("_rank = 1").drop("_rank"))


def last_row(df: DataFrame, keys, by: str) -> DataFrame:
    """One row per key: the whole row with the greatest `by`, ties broken by the other columns."""
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(F.col(by), *[F.col(c) for c in rest if c != by])
    return (df.groupBy(*keys).agg(F.max(order).alias("_row"))
            .select(*keys, *[F.col("_row")[c].alias(c) for c in rest]))


def lookup_name(df: DataFrame, names: DataFrame, columns,
                source: str = "feed_name", target: str = "master_name",
                order: str | None = None, small: bool | None = None) -> DataFrame:
    """Replace names by their mapped value; unmapped names stay, the first mapping wins.

    `small` passes on whether the names fit a broadcast; if they do not, hot names are spread.
    """
    first = (names.filter(F.col(source).isNotNull())
             .groupBy(source).agg(F.min_by(target, order or target).alias(target)))
    small = fits_broadcast(first) if small is None else small
    for column in columns:
        mapped = first.select(F.col(source).alias(column), F.col(target).alias("_mapped"))
        df = (lookup_join(df, mapped, column, small=small, salts=_tasks(df))
              .withColumn(column, F.coalesce("_mapped", column)).drop("_mapped"))
    return df


def map_names_inner(df: DataFrame, names: DataFrame, column: str,
                    source: str = "feed_name", target: str = "master_name") -> DataFrame:
    """Replace names through a map; unmapped rows are lost and repeated keys multiply."""
    mapped = names.select(F.col(source).alias(column), F.col(target).alias("_mapped"))
    return (lookup_join(df, mapped, column, "inner", salts=_tasks(df))
            .withColumn(column, F.col("_mapped")).drop("_mapped"))


def append_common(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of both tables, with the columns they share, in the first one's order."""
    shared = [c for c in first.columns if c in set(second.columns)]
    return first.select(*shared).unionByName(second.select(*shared))


def append_outer(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of both tables with all columns; null where a table lacks one."""
    return first.unionByName(second, allowMissingColumns=True)


def combine_predictions(base: DataFrame, predictions: dict[str, DataFrame], keys,
                        value: str = "pred_points") -> DataFrame:
    """One prediction column per model, left-joined on the same keys.

    Every step joins on the same keys, so the running result keeps its
    partitioning and only the next model's table is shuffled.
    """
    out = base
    for model, df in predictions.items():
        part = df.select(*keys, F.col(value).alias(f"{value}_{model}"))
        out = null_safe_join(out, part, keys)
    return out
