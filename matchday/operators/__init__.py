"""Table operators (DataFrame -> DataFrame)."""

from .conform import checked_broadcast, clean, conform_leagues, conform_teams, unmapped_teams
from .lookups import null_spread_salt, previous_day_features
from .metrics import mean_poisson_deviance, mean_tip_score, with_tip_score
from .normalize import flatten, normalize, seasons_without_records, validate_meta, validate_records
from .panels import performance_stats, rolling_sum, running_avg, running_sum, running_totals, table_rank
from .sampling import half_sample, half_sample_cut, half_sample_flag
from .views import (
    goals_base_view,
    load_match_results,
    result_class_base_view,
    team_side_view,
    team_view,
)

__all__ = [
    "checked_broadcast",
    "clean",
    "conform_leagues",
    "conform_teams",
    "flatten",
    "goals_base_view",
    "half_sample",
    "half_sample_cut",
    "half_sample_flag",
    "load_match_results",
    "mean_poisson_deviance",
    "null_spread_salt",
    "mean_tip_score",
    "normalize",
    "performance_stats",
    "previous_day_features",
    "result_class_base_view",
    "rolling_sum",
    "running_avg",
    "running_sum",
    "running_totals",
    "seasons_without_records",
    "table_rank",
    "team_side_view",
    "team_view",
    "unmapped_teams",
    "validate_meta",
    "validate_records",
    "with_tip_score",
]
