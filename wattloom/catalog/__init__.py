"""All registered queries."""

from wattloom.catalog import features_q, models_q, phases_q, sources_q, streaming_q  # noqa: F401
from wattloom.catalog.base import CHECK_SQL, QUERIES

__all__ = ["CHECK_SQL", "QUERIES"]
