"""All registered queries."""

from retaloom.queries import checks, cleaning, dashboard, loads, models, olap, star  # noqa: F401
from retaloom.queries.registry import QUERIES

__all__ = ["QUERIES"]
