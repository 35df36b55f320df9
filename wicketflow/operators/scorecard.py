"""Per-match player scorecards from ball-by-ball deliveries.

A delivery is seen twice: by its batter and by its bowler. Deliveries move once, in
few columns, to ranges of equal size, so that those of a match lie together in whatever
order they were stored. A task then sums up its range to a row per player, match and
side, with a bit per ball and a sum per over. A match or a player that owns a large
share of all deliveries is spread over many ranges, so it is no hot spot.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wicketflow.config import RoleRules
from wicketflow.functions.nulls import not_in, total
from wicketflow.functions.text import clean_name

# Dismissal kinds that are not credited to the bowler.
NOT_BOWLED_OUT = ("run out", "retired hurt")

# Over numbers of a block, and how many of them share a number of bits, ten for each.
BLOCK = 20
OVERS = 5
# Overs from here on are told by their value, not by tenths.
FINEST = 1e6

KEYS = ("matchid", "playername")
SIDE = ("innings", "battingteam", "bowlingteam")
BATTING = ("total_runs", "total_balls_faced", "total_legal_balls_faced", "run_6", "run_4",
           "fallofwickets")
BATTING_SIDE = ("batsmen_innings", "batsmen_battingteam", "batsmen_bowlingteam")
BOWLING = ("total_wickets", "total_balls_bowled", "total_legal_balls_bowled", "total_runs_given",
           "maiden_overs")
BOWLING_SIDE = ("bowlers_innings", "bowler_battingteam", "bowler_bowlingteam")


def _wicket() -> Column:
    dismissed = F.col("dismissal").cast("string").isin("t", "true")
    return dismissed & not_in(F.col("dismissedtype"), NOT_BOWLED_OUT)


def _as_batter() -> list[Column]:
    score = F.col("scorevalue")
    return [F.col("batsmanname").alias("playername"), F.lit(True).alias("bats"),
            score.alias("runs"), (score == 6).alias("six"), (score == 4).alias("four"),
            F.col("fallofwickets").alias("wickets_down"), F.lit(False).alias("wicket")]


def _as_bowler() -> list[Column]:
    return [F.col("bowlername").alias("playername"), F.lit(False).alias("bats"),
            F.col("batsmanscorevalue").alias("runs"), F.lit(False).alias("six"),
            F.lit(False).alias("four"), F.lit(None).cast("int").alias("wickets_down"),
            _wicket().alias("wicket")]


def _together(deliveries: DataFrame) -> DataFrame:
    """Deliveries in ranges of matches, and of overs and players within a large match.

    Where the rows of a match are stored all over the table, a task would find few rows to
    sum up, and its wide sums would fill its memory and the shuffle.
    """
    return deliveries.filter(F.col("matchid").isNotNull()).repartitionByRange(
        "matchid", "over", *[c for c in ("batsmanname", "bowlername") if c in deliveries.columns])


def _seen_by(deliveries: DataFrame, *views: list[Column]) -> DataFrame:
    """Deliveries from the given points of view; rows without match or player are dropped."""
    shared = ["matchid", "over", *SIDE]
    together = _together(deliveries)
    if len(views) == 1:
        seen = together.select(*shared, *views[0])
    else:
        seen = together.select(
            *shared, F.inline(F.array(*[F.struct(*view) for view in views])))
    return seen.filter(F.col("playername").isNotNull())


def _per_side(balls: DataFrame) -> DataFrame:
    """Totals per match, player, point of view and side in which the player took part.

    The balls of 20 over numbers fit the bits of four numbers, and their runs 20 sums, so a
    task holds one row of a player's match however many balls it reads, and only such rows are
    shuffled. An over that is no whole number of tenths has a row of its own (`fine`).
    """
    number = F.col("over").cast("int")
    tenths = F.floor(F.col("over") * 10 + 0.5)
    placed = balls.select(
        "*", F.pmod(number, F.lit(BLOCK)).alias("place"), number.alias("number"),
        F.when((F.col("over") >= 0) & (F.col("over") < FINEST) & (tenths / 10 == F.col("over")),
               tenths % 10).alias("tenth"))
    return placed.withColumns({
        "block": ((F.col("number") - F.col("place")) / BLOCK).cast("int"),
        "fine": F.when(F.col("tenth").isNull(), F.col("over")),
        "word": F.floor(F.col("place") / OVERS)}).groupBy(
        *KEYS, "bats", *SIDE, "block", "fine").agg(
        F.sum("runs").alias("runs"), F.count("over").alias("balls"),
        F.count_if("six").alias("sixes"), F.count_if("four").alias("fours"),
        F.count_if("wicket").alias("wickets"), F.min("wickets_down").alias("wickets_down"),
        *[F.expr(f"bit_or(case when tenth is not null and word = {w} then"
                 f" shiftleft(1L, cast(place % {OVERS} * 10 + tenth as int)) end) as bits_{w}")
          for w in range(BLOCK // OVERS)],
        F.expr("bit_or(case when not bats then shiftleft(1L, place) end) as overs"),
        *[F.expr(f"sum(case when not bats and place = {k} then runs end) as runs_{k}")
          for k in range(BLOCK)])


def _per_block(balls: DataFrame) -> DataFrame:
    """Totals, distinct balls and maiden overs per match, player, point of view and block, and
    rows with `is_side`: the innings and teams that the player took part in.

    All rows of a player's match meet in one task; they are few. Names are cleaned here, once a
    row and not once a ball. The rows are wide and grow in memory, but adaptive execution gathers
    partitions by the bytes shuffled: a fixed number of partitions stays as it is.
    """
    parts = int(balls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    view = [*KEYS, "bats", "is_side", *SIDE, "block"]
    sums = [f"runs_{k}" for k in range(BLOCK)]
    counts = ["balls", "sixes", "fours", "wickets"]
    words = [f"bits_{w}" for w in range(BLOCK // OVERS)]
    per_side = (_per_side(balls).withColumn("playername", clean_name(F.col("playername")))
                .repartition(parts, *KEYS)
                .withColumn("is_side", F.explode(F.array(F.lit(False), F.lit(True)))))
    measures = ["block", "fine", "runs", *counts, *words, "overs", *sums]
    rows = per_side.selectExpr(
        *KEYS, "bats", "is_side", *[f"case when is_side then {c} end as {c}" for c in SIDE],
        *[f"case when not is_side then {c} end as {c}" for c in measures], "wickets_down")
    merged = [F.expr(f"{f}({c}) as {c}") for f, c in (
        *(("sum", c) for c in ("runs", *counts, *sums)), ("min", "wickets_down"),
        ("bit_or", "overs"))]
    distinct = " + ".join(f"coalesce(bit_count(bit_or({w})), 0)" for w in words)
    exact = rows.groupBy(*view, "fine").agg(
        *merged, F.expr(f"case when fine is not null then 1 else {distinct} end as legal_balls"))
    blocks = exact.groupBy(*view).agg(*merged, F.sum("legal_balls").alias("legal_balls"))
    maidens = " + ".join(f"if(overs & {1 << k} <> 0 and coalesce({c}, 0) = 0, 1, 0)"
                         for k, c in enumerate(sums))
    return blocks.select(
        *view, F.coalesce("runs", F.lit(0)).alias("runs"), *counts, "wickets_down",
        "legal_balls", F.expr(f"{maidens} as maidens"))


def _totals(blocks: DataFrame, *names: str) -> DataFrame:
    """Match totals. An over number is a function of `over`, so distinct balls add up.

    Columns of a view in which the player does not appear come out null.
    """
    bats = F.col("bats") & ~F.col("is_side")
    bowls = ~F.col("bats") & ~F.col("is_side")

    def batting(value):
        return F.sum(F.when(bats, F.col(value)))

    def bowling(value):
        return F.sum(F.when(bowls, F.col(value)))

    def sides(of_batter):
        # At most one entry per innings and pair of teams, so these lists are short.
        return F.collect_list(F.when(F.col("is_side") & (F.col("bats") == of_batter),
                                     F.struct(*SIDE)))

    formulas = {
        "total_runs": batting("runs").cast("double"),
        "total_balls_faced": batting("balls"),
        "total_legal_balls_faced": batting("legal_balls"),
        "run_6": F.nullif(batting("sixes"), F.lit(0)),
        "run_4": F.nullif(batting("fours"), F.lit(0)),
        "fallofwickets": F.min("wickets_down"),
        "total_wickets": F.nullif(bowling("wickets"), F.lit(0)),
        "total_balls_bowled": bowling("balls"),
        "total_legal_balls_bowled": bowling("legal_balls"),
        "total_runs_given": bowling("runs").cast("double"),
        "maiden_overs": bowling("maidens"),
        "_bat": sides(True),
        "_bowl": sides(False),
    }
    return blocks.groupBy(*KEYS).agg(*[formulas[n].alias(n) for n in names])


def _with_sides(card: DataFrame, sides: str, names: tuple[str, ...]) -> DataFrame:
    """A row per innings and teams in the list `sides`: mostly one per match, sometimes more."""
    return (card.withColumn(sides, F.explode_outer(sides))
            .withColumns({n: F.col(f"{sides}.{f}") for f, n in zip(SIDE, names)}).drop(sides))


def _economy() -> Column:
    return F.try_divide(F.col("total_runs_given") * 6, F.col("total_legal_balls_bowled"))


def batting_summary(deliveries: DataFrame) -> DataFrame:
    """Runs, balls, boundaries, batting position, innings and teams per match and batter."""
    blocks = _per_block(_seen_by(deliveries, _as_batter()))
    return _with_sides(_totals(blocks, *BATTING, "_bat"), "_bat", BATTING_SIDE)


def bowling_summary(deliveries: DataFrame) -> DataFrame:
    """Wickets, balls, runs, maidens, economy, innings and teams per match and bowler."""
    blocks = _per_block(_seen_by(deliveries, _as_bowler()))
    return (_with_sides(_totals(blocks, *BOWLING, "_bowl"), "_bowl", BOWLING_SIDE)
            .withColumn("economy_rate", _economy()))


def bowling_wickets(deliveries: DataFrame) -> DataFrame:
    """Wickets credited per match and bowler; null when there is none."""
    return _totals(_per_block(_seen_by(deliveries, _as_bowler())), "total_wickets")


def maiden_overs(deliveries: DataFrame) -> DataFrame:
    """Overs without a run per match and bowler."""
    return _totals(_per_block(_seen_by(deliveries, _as_bowler())), "maiden_overs")


def merge_summaries(batting: DataFrame, bowling: DataFrame) -> DataFrame:
    """Full outer join of two finished summaries on match and player."""
    return batting.join(bowling, list(KEYS), "full")


def match_card(deliveries: DataFrame) -> DataFrame:
    """The merged summaries in one pass over the deliveries, without a join.

    Equal to `merge_summaries(batting_summary(d), bowling_summary(d))`: totals and sides of
    both views come from one aggregation.
    """
    blocks = _per_block(_seen_by(deliveries, _as_batter(), _as_bowler()))
    totals = _totals(blocks, *BATTING, *BOWLING, "_bat", "_bowl")
    card = _with_sides(_with_sides(totals, "_bat", BATTING_SIDE), "_bowl", BOWLING_SIDE)
    return card.select(*KEYS, *BATTING, *BATTING_SIDE, *BOWLING, *BOWLING_SIDE,
                       _economy().alias("economy_rate"))


def player_role(card: DataFrame, rules: RoleRules = RoleRules()) -> DataFrame:
    """Role per player from mean balls faced and bowled over all matches."""
    faced, bowled = F.col("mean_faced"), F.col("mean_bowled")
    bowls = bowled >= rules.min_balls_bowled
    return (card.filter(F.col("playername").isNotNull()).groupBy("playername").agg(
                F.avg(F.coalesce("total_balls_faced", F.lit(0))).alias("mean_faced"),
                F.avg(F.coalesce("total_balls_bowled", F.lit(0))).alias("mean_bowled"))
            .select("playername",
                    F.when((faced >= rules.min_balls_faced) & bowls, "AllRounder")
                    .when(bowls, "Bowler").otherwise("Batsmen").alias("playing_role")))


def scorecard(deliveries: DataFrame, rules: RoleRules = RoleRules(),
              stage: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Batting, bowling and role per match and player.

    The role needs a pass over the finished card. `stage` lets a job store the
    card first, so that the deliveries are not read and shuffled again for it.
    """
    card = match_card(deliveries)
    if stage:
        card = stage(card)
    return card.join(player_role(card, rules), "playername", "left").select(
        *card.columns, "playing_role")
