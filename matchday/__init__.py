"""Match analytics on Spark: nested match feeds -> conformed match tables -> league
tables, form statistics, previous-match-day features and prediction metrics.

Every core function is ``DataFrame -> DataFrame`` built from Spark expressions,
windows and joins; path-level wrappers live in :mod:`matchday.plans`.
"""

from .session import get_session

__all__ = ["get_session"]
__version__ = "0.1.0"
