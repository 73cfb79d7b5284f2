"""Query catalogue: importing the query modules fills the registry."""

from waymark.plans import q_bags, q_cities, q_guesses, q_metrics, q_model, q_sheets, q_signs, q_text  # noqa: F401
from waymark.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
