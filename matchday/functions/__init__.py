"""Column factories: named features, filters and scoring expressions."""

from .features import DEFAULT_FEATURES, FEATURES, build_features, register_feature, suffix_alias
from .predicates import EXCLUDED_LEAGUE_IDS, final_results, not_excluded_league
from .scoring import poisson_deviance_term, tip_score

__all__ = [
    "DEFAULT_FEATURES",
    "EXCLUDED_LEAGUE_IDS",
    "FEATURES",
    "build_features",
    "final_results",
    "not_excluded_league",
    "poisson_deviance_term",
    "register_feature",
    "suffix_alias",
    "tip_score",
]
