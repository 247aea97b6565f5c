"""Physical choices a caller can see: join route, hot-key slots, plan text, metrics."""

from followgraph.plans.inspect import plan_text, with_metrics
from followgraph.plans.route import STRATEGIES, Limits

__all__ = ["STRATEGIES", "Limits", "plan_text", "with_metrics"]
