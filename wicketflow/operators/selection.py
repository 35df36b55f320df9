"""Best team per match under role, team and budget limits, solved exactly.

A player whom enough others of the same team and role beat, at no more cost and with no fewer
points, is not needed: of those others one is always free to take the place. What is left is a
skyband, and skybands of parts combine to that of the whole. So each task cuts its rows before
the shuffle, however many players a match has, and cuts again while the rows of a match
stream by, before one small numpy program solves it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from heapq import heappush, heapreplace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wicketflow.config import Columns, SelectionLimits
from wicketflow.operators.backtest import captaincy


def fill_candidates(df: DataFrame, points: str, cols: Columns = Columns()) -> DataFrame:
    """Candidates with missing points and cost as 0, and missing team and role as their own.

    Not a number counts as missing.
    """
    def number(column):
        value = F.col(column).cast("double")
        return F.coalesce(F.when(~F.isnan(value), value), F.lit(0.0))

    return df.select(
        cols.match, cols.player, number(points).alias("points"),
        number(cols.cost).alias("cost"),
        F.coalesce(cols.role, F.lit("")).alias("role"),
        F.coalesce(cols.team, F.lit("")).alias("team"))


def _known(df: DataFrame, points: str, limits: SelectionLimits, cols: Columns) -> DataFrame:
    """Affordable candidates as numbers: match, player, points, steps, role, slot.

    Team limits bind the first and the last team by name, which are the two
    teams of an ordinary match; a match of one team yields nothing. A name that
    occurs twice in a match counts once.
    """
    filled = fill_candidates(df, points, cols).filter(
        F.col(cols.match).isNotNull() & F.col(cols.player).isNotNull())
    once = (filled.groupBy(cols.match, cols.player)
            .agg(F.max(F.struct("points", "cost", "role", "team")).alias("p"))
            .select(cols.match, cols.player, "p.*"))
    teams = (filled.groupBy(cols.match).agg(F.min("team").alias("first_team"),
                                            F.max("team").alias("last_team"),
                                            F.sum(F.least("cost", F.lit(0.0))).alias("refund"))
             .filter("first_team <> last_team"))
    exact = F.col("cost") * limits.cost_steps
    steps = F.when(F.abs(F.round(exact) - exact) < 1e-9, F.round(exact)).otherwise(exact)
    role = F.lit(len(limits.roles))
    for number, r in enumerate(limits.roles):
        role = F.when(F.col("role") == r.name, number).otherwise(role)
    # Players of negative cost pay for others, all of them together for `refund` at most.
    affordable = F.col("steps") <= (F.lit(limits.max_cost) - F.col("refund")) * limits.cost_steps
    return once.join(teams, cols.match).select(
        cols.match, cols.player, "points", steps.alias("steps"), role.alias("role"),
        F.when(F.col("team") == F.col("first_team"), 0)
        .when(F.col("team") == F.col("last_team"), 1).otherwise(2).alias("slot"),
        "refund").filter(affordable).drop("refund")


def _places(limits: SelectionLimits) -> dict[tuple[int, int], int]:
    """Most players of each (role, slot) in a team."""
    roles = [r.at_most for r in limits.roles] + [limits.max_players]
    slots = (limits.max_per_team, limits.max_per_team, limits.max_players)
    return {(role, slot): max(min(most, cap, limits.max_players), 0)
            for role, most in enumerate(roles) for slot, cap in enumerate(slots)}


def _needed(rows: pa.RecordBatch, match: str, player: str, places: dict) -> pa.RecordBatch:
    """The rows that fewer players than there are places beat, in the order of matches and points.

    In order of cost a row is beaten by the rows before it with as many points: the best
    points so far, as many as there are places, tell whether there are enough of them.
    """
    order = pc.sort_indices(rows, [(match, "ascending"), ("role", "ascending"),
                                   ("slot", "ascending"), ("steps", "ascending"),
                                   ("points", "descending"), (player, "descending")])
    rows = rows.take(order)
    kept, group, best, most = [], None, [], 0
    for at, (m, role, slot, value) in enumerate(zip(*(
            rows.column(c).to_pylist() for c in (match, "role", "slot", "points")))):
        if group != (m, role, slot):
            group, best, most = (m, role, slot), [], places[role, slot]
        if len(best) < most:
            heappush(best, value)
        elif most and value > best[0]:
            heapreplace(best, value)
        else:
            continue
        kept.append(at)
    rows = rows.take(pa.array(kept, pa.int64()))
    return rows.take(pc.sort_indices(rows, [(match, "ascending"), ("points", "descending"),
                                            (player, "descending")]))


def _each_match(batches: Iterable[pa.RecordBatch], match: str, player: str,
                places: dict) -> Iterator[pa.RecordBatch]:
    """The needed rows of each match of a partition in which a match's rows follow one another."""
    held = None
    for batch in batches:
        start = 0
        for end in pc.run_end_encode(batch.column(match)).run_ends.to_pylist():
            part = batch.slice(start, end - start)
            start = end
            if held is not None and held.column(match)[0].equals(part.column(match)[0]):
                part = pa.concat_batches([held, part])
            elif held is not None:
                yield held
            held = _needed(part, match, player, places)
    if held is not None:
        yield held


def _pool(df: DataFrame, points: str, limits: SelectionLimits, cols: Columns,
          partitions: int | None) -> DataFrame:
    """Rows that may be needed, a match's rows one after another in one partition."""
    match, player, places = cols.match, cols.player, _places(limits)
    known = _known(df, points, limits, cols)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _needed(batch, match, player, places)

    # Solving costs time per match, not per byte, but adaptive execution gathers partitions by
    # bytes: a fixed number of partitions stays as it is.
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (known.mapInArrow(cut, known.schema).repartition(parts, match)
            .sortWithinPartitions(match))


def candidates(df: DataFrame, points: str, limits: SelectionLimits = SelectionLimits(),
               cols: Columns = Columns(), partitions: int | None = None) -> DataFrame:
    """The players of each match that an optimal team can need, for any costs.

    Of players of one team, role and cost no more remain than a team has places for them, and
    a dearer one remains only if fewer cheaper ones score as much. Team limits bind the first
    and the last team by name; a match of one team yields nothing.
    """
    pool, places = _pool(df, points, limits, cols, partitions), _places(limits)
    return pool.mapInArrow(
        lambda batches: _each_match(batches, cols.match, cols.player, places), pool.schema)


NONE = -np.inf


def _best_by_count_and_cost(points, steps, most: int, budget: int) -> list[np.ndarray]:
    """Tables [count, cost] of the best points, before any player and after each one."""
    table = np.full((most + 1, budget + 1), NONE)
    table[0, 0] = 0.0
    tables = [table]
    for value, cost in zip(points, steps):
        grown = tables[-1].copy()
        if cost > budget:
            tables.append(grown)
            continue
        np.maximum(grown[1:, cost:], tables[-1][:-1, :budget + 1 - cost] + value,
                   out=grown[1:, cost:])
        tables.append(grown)
    return tables


def _reached(table: np.ndarray) -> tuple[list[int], list[int]]:
    """Along each side of the table, the first place that holds an entry and the one after the last.
    """
    low, high = [], []
    held = table > NONE
    for side in range(table.ndim):
        places = np.flatnonzero(held.any(axis=tuple(x for x in range(table.ndim) if x != side)))
        low.append(int(places[0]) if len(places) else 0)
        high.append(int(places[-1]) + 1 if len(places) else 0)
    return low, high


def _useful(table: np.ndarray) -> list[tuple[int, int, float]]:
    """(count, cost, points) entries that no cheaper entry of the same count matches."""
    out = []
    for count, row in enumerate(table):
        best_cheaper = np.concatenate(([NONE], np.maximum.accumulate(row)[:-1]))
        out += [(count, int(c), float(row[c])) for c in np.flatnonzero(row > best_cheaper)]
    return out


def _members(tables: list[np.ndarray], rows: np.ndarray, steps, count: int, cost: int) -> list[int]:
    """Players behind entry [count, cost] of the last table."""
    picked = []
    for i in range(len(rows) - 1, -1, -1):
        if tables[i + 1][count, cost] != tables[i][count, cost]:
            picked.append(int(rows[i]))
            count, cost = count - 1, cost - int(steps[i])
    return picked


def _pay_off(cost: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Entries with more points than every cheaper one, in order of cost."""
    order = np.lexsort((-points, cost))
    ranked = points[order]
    best = np.concatenate(([NONE], np.maximum.accumulate(ranked)[:-1]))
    return order[ranked > best]


def _joined(fronts: dict, more: dict, fits) -> dict:
    """Sums of two families of fronts, {counts: (cost, points, members)}, cut to what pays off."""
    sums: dict[tuple, list] = {}
    for a, (cost_a, points_a, members_a) in fronts.items():
        for b, (cost_b, points_b, members_b) in more.items():
            counts = tuple(x + y for x, y in zip(a, b))
            if fits(counts):
                sums.setdefault(counts, []).append((
                    np.add.outer(cost_a, cost_b).ravel(), np.add.outer(points_a, points_b).ravel(),
                    members_a, members_b))
    out = {}
    for counts, parts in sums.items():
        cost = np.concatenate([p[0] for p in parts])
        value = np.concatenate([p[1] for p in parts])
        ends = np.cumsum([len(p[0]) for p in parts])
        kept = _pay_off(cost, value)
        members = []
        for place in kept:
            part = int(np.searchsorted(ends, place, side="right"))
            _, _, left, right = parts[part]
            i, j = divmod(int(place - (ends[part - 1] if part else 0)), len(right))
            members.append(left[i] + right[j])
        out[counts] = cost[kept], value[kept], members
    return out


def _solve_any_cost(points, steps, roles, slots, limits: SelectionLimits):
    """As `solve`, for costs that are negative or off the grid.

    Instead of a table by cost it keeps, for each number of players per team, the costs at
    which the points grow: exact for any costs, but such a list is not bounded by the budget.
    """
    players = limits.max_players
    caps = (min(limits.max_per_team, players),) * 2 + (players,)
    bounds = [(r.at_least, min(r.at_most, players)) for r in limits.roles] + [(0, players)]

    def fits(counts):
        return sum(counts) <= players and all(c <= cap for c, cap in zip(counts, caps))

    nobody = {(0, 0, 0): (np.zeros(1), np.zeros(1), [()])}
    team = nobody
    for role, (least, most) in enumerate(bounds):
        part = nobody
        for row in np.flatnonzero(roles == role):
            one = tuple(int(slots[row] == s) for s in range(3))
            choice = {**nobody, one: (steps[row:row + 1], points[row:row + 1], [(int(row),)])}
            part = _joined(part, choice, lambda c: fits(c) and sum(c) <= most)
        part = {c: front for c, front in part.items() if sum(c) >= least}
        team = _joined(team, part, fits)
    budget = limits.max_cost * limits.cost_steps + 1e-9
    best = None
    for counts, (cost, value, members) in sorted(team.items()):
        if limits.exact and sum(counts) != players:
            continue
        for c, v, m in zip(cost, value, members):
            if c <= budget and (best is None or v > best[0]):
                best = v, m
    return None if best is None else sorted(best[1])


def solve(points, steps, roles, slots, limits: SelectionLimits = SelectionLimits()):
    """Row numbers of an optimal team, or None when the limits cannot be met.

    Per role and team: best points by count and cost. Per role: combinations of
    the teams' entries within the role's bounds. Across roles only the players
    per team and the cost matter, so the state stays small.
    """
    points, steps = np.asarray(points, float), np.asarray(steps, float)
    roles, slots = np.asarray(roles, int), np.asarray(slots, int)
    if (steps < 0).any() or (steps != np.round(steps)).any():
        return _solve_any_cost(points, steps, roles, slots, limits)
    budget = int(limits.max_cost * limits.cost_steps)
    # A player above the budget cannot be afforded, even beside free ones.
    steps = np.minimum(steps, budget + 1).astype(int)
    per_team, players = min(limits.max_per_team, limits.max_players), limits.max_players
    others = players if (slots == 2).any() else 0
    caps = (per_team, per_team, others)
    bounds = [(r.at_least, min(r.at_most, players)) for r in limits.roles] + [(0, players)]

    options = []  # per role: entries (counts per team, cost, points), with their team entries
    cells = {}
    for role, (least, most) in enumerate(bounds):
        parts = []
        for slot, cap in enumerate(caps):
            rows = np.flatnonzero((roles == role) & (slots == slot))
            tables = _best_by_count_and_cost(points[rows], steps[rows], min(most, cap), budget)
            cells[role, slot] = (tables, rows, steps[rows])
            parts.append(_useful(tables[-1]))
        entries = [(a[0], b[0], c[0], a[1] + b[1] + c[1], a[2] + b[2] + c[2], a, b, c)
                   for a in parts[0] for b in parts[1] for c in parts[2]
                   if least <= a[0] + b[0] + c[0] <= most and a[1] + b[1] + c[1] <= budget]
        # Of entries with the same counts, keep those that pay for their cost.
        entries.sort(key=lambda e: (e[0], e[1], e[2], e[3], -e[4]))
        kept = []
        for e in entries:
            if kept and kept[-1][:3] == e[:3] and kept[-1][4] >= e[4]:
                continue
            kept.append(e)
        if not kept:
            return None
        options.append(kept)

    shape = (caps[0] + 1, caps[1] + 1, caps[2] + 1, budget + 1)
    state = np.full(shape, NONE)
    state[0, 0, 0, 0] = 0.0
    states = [state]
    for entries in options:
        grown = np.full(shape, NONE)
        before = states[-1]
        # Nothing grows from what is not reached, and most of a table is empty.
        (a0, b0, c0, s0), (a1, b1, c1, s1) = _reached(before)
        for a, b, c, cost, value, *_ in entries:
            a2, b2 = min(a1, shape[0] - a), min(b1, shape[1] - b)
            c2, s2 = min(c1, shape[2] - c), min(s1, shape[3] - cost)
            target = grown[a0 + a:a2 + a, b0 + b:b2 + b, c0 + c:c2 + c, s0 + cost:s2 + cost]
            np.maximum(target, before[a0:a2, b0:b2, c0:c2, s0:s2] + value, out=target)
        states.append(grown)
    count = np.add.outer(np.add.outer(np.arange(shape[0]), np.arange(shape[1])),
                         np.arange(shape[2]))[..., None]
    allowed = count == players if limits.exact else count <= players
    final = np.where(allowed, states[-1], NONE)
    spot = np.unravel_index(int(np.argmax(final)), shape)
    if final[spot] == NONE:
        return None
    picked = []
    spot = tuple(int(x) for x in spot)
    for role in range(len(options) - 1, -1, -1):
        for a, b, c, cost, value, *team_entries in options[role]:
            origin = (spot[0] - a, spot[1] - b, spot[2] - c, spot[3] - cost)
            if min(origin) >= 0 and states[role][origin] + value == states[role + 1][spot]:
                for slot, (number, spent, _) in enumerate(team_entries):
                    picked += _members(*cells[role, slot], number, spent)
                spot = origin
                break
    return sorted(picked)


def best_teams(df: DataFrame, points: str, limits: SelectionLimits = SelectionLimits(),
               cols: Columns = Columns(), partitions: int | None = None) -> DataFrame:
    """Picked players per match with their points and rank (0 = best; of equals the later name)."""
    match, player, places = cols.match, cols.player, _places(limits)
    pool = _pool(df, points, limits, cols, partitions)
    match_type = dict(pool.dtypes)[match]

    def pick(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _each_match(batches, match, player, places):
            numbers = [rows.column(c).to_numpy() for c in ("points", "steps", "role", "slot")]
            team = rows.take(pa.array(solve(*numbers, limits) or [], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*team.select([match, player, "points"]).columns,
                 pa.array(np.arange(len(team)), pa.int32())],
                names=[match, player, "points", "rank"])

    return pool.mapInArrow(
        pick, f"`{match}` {match_type}, `{player}` string, points double, rank int")


def select_team(df: DataFrame, points: str, pick: str, rank: str,
                limits: SelectionLimits = SelectionLimits(), adjust_captain: bool = False,
                cols: Columns = Columns()) -> DataFrame:
    """`df` with the optimal team of each match marked and ranked."""
    marks = best_teams(df, points, limits, cols).select(
        cols.match, cols.player, F.col("rank").alias(rank), F.lit(1.0).alias(pick))
    out = df.join(marks, [cols.match, cols.player], "left")
    return captaincy(out, points, rank) if adjust_captain else out


def team_summary(picks: DataFrame, match: str = "matchid") -> DataFrame:
    """Optimum and team size per match."""
    return picks.groupBy(match).agg(F.sum("points").alias("team_points"),
                                    F.count("*").alias("players"))
