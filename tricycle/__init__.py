"""Analytics over directed edge tables ``(follower, user)`` on PySpark."""

from tricycle.operators import *  # noqa: F401,F403
from tricycle.operators import __all__ as _operators
from tricycle.plans import RunCounters, explain_text, with_metrics
from tricycle.sources import *  # noqa: F401,F403
from tricycle.sources import __all__ as _sources

__all__ = [*_operators, *_sources, "RunCounters", "explain_text", "with_metrics"]
