"""Rules and limits. Operators take these as arguments; nothing reads globals."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class PointsRules:
    """Fantasy points per event and per threshold."""

    # Fixed values of the published points rulebook.
    run: float = 1
    six: float = 2
    four: float = 1
    fifty: float = 8
    hundred: float = 16
    duck: float = -2
    wicket: float = 25
    four_wickets: float = 8
    five_wickets: float = 16
    maiden: float = 8
    # (bound, points), first match wins: rate >= bound, then rate <= bound.
    economy_at_least: tuple[tuple[float, float], ...] = ((11, -6), (10, -4), (9, -2))
    economy_at_most: tuple[tuple[float, float], ...] = ((4, 6), (5, 4), (6, 2))


@dataclass(frozen=True)
class RewardRules:
    """Prize multiple by relative error of the picked team."""

    # Fixed values: (error below, prize multiple), first match wins.
    bands: tuple[tuple[float, float], ...] = (
        (0.01, 5000), (0.02, 3000), (0.03, 500), (0.04, 200), (0.05, 100), (0.06, 80),
        (0.08, 20), (0.10, 8), (0.15, 2.5), (0.20, 2), (0.25, 1),
    )
    stake: float = 50


@dataclass(frozen=True)
class RoleLimits:
    name: str
    at_least: int
    at_most: int


@dataclass(frozen=True)
class SelectionLimits:
    """Constraints on a picked team."""

    # Fixed values of the selection rules.
    max_players: int = 11
    max_cost: float = 100
    max_per_team: int = 7
    roles: tuple[RoleLimits, ...] = (
        RoleLimits("Batsmen", 3, 7), RoleLimits("Bowler", 3, 6), RoleLimits("AllRounder", 1, 4))
    # Matches whose costs are multiples of 1 / cost_steps are solved by a table of whole steps,
    # others by lists of the costs that occur.
    cost_steps: int = 2
    # False: at most max_players may be picked. True: exactly that many.
    exact: bool = False


@dataclass(frozen=True)
class RoleRules:
    """Mean balls per match that make a player a batter, bowler or both."""

    # Fixed values.
    min_balls_faced: float = 8
    min_balls_bowled: float = 6


@dataclass(frozen=True)
class Cleaning:
    """Alias maps: many spellings to one canonical value."""

    # Spellings that occur in the public match data.
    city: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "Bengaluru": ("Bangalore", "Bengaluru")})
    venue: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "M Chinnaswamy Stadium": ("M Chinnaswamy Stadium", "M.Chinnaswamy Stadium"),
        "Punjab Cricket Association Stadium": (
            "Punjab Cricket Association IS Bindra Stadium, Mohali",
            "Punjab Cricket Association Stadium, Mohali")})
    team: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "Delhi Capitals": ("Delhi Daredevils",),
        "Pune Warriors": ("Rising Pune Supergiants", "Rising Pune Supergiant"),
        "Sunrisers Hyderabad": ("Deccan Chargers",)})
    rename_teams: bool = True


@dataclass(frozen=True)
class FeatureRules:
    windows: tuple[int, ...] = (2, 3, 5, 10)
    venue_columns: tuple[str, ...] = ("total_bat_points", "total_bowl_points")
    player_columns: tuple[str, ...] = ("total_points", "fallofwickets", "total_balls_bowled")
    # A key's history is cut into slices of 2 ** slice_bits match ids; a window task sees one.
    slice_bits: int = 16


@dataclass(frozen=True)
class Columns:
    """Logical to physical column names."""

    match: str = "matchid"
    player: str = "playername"
    team: str = "playing_team"
    role: str = "playing_role"
    cost: str = "playercost"
    actual_points: str = "total_points"
    pred_points: str = "pred_points"
    pred_pick: str = "pred_selection_true"
    actual_pick: str = "actual_selection_true"
    pred_rank: str = "pred_selection_rank"
    actual_rank: str = "actual_selection_rank"


# Columns the models learn from.
CATEGORICAL = ("playing_team", "playing_role", "opposition_team", "city")
NUMERIC = (
    "home_game", "toss_flag", "player_match_count",
    *(f"{c}_{k}_avg{w}"
      for w in (2, 5, 10)
      for k, cols in (("playername", ("fallofwickets", "total_balls_bowled", "total_points")),
                      ("venue", ("total_bat_points", "total_bowl_points")))
      for c in cols),
)
UNDECIDED = "Match Tied/Cancelled/Not yet ended"
