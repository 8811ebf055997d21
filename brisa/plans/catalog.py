"""All registered queries (importing the family modules fills the registry)."""

from brisa.plans import catalog_models, catalog_reviews, catalog_series, catalog_stores  # noqa: F401
from brisa.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
