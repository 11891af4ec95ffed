"""Query registry, oracle SQL, stand-in input staging and plan inspection."""

from quiver.plans.inspect import counted, plan_text
from quiver.plans.oracle import oracle_sql
from quiver.plans.registry import QUERIES

__all__ = ["QUERIES", "counted", "oracle_sql", "plan_text"]
