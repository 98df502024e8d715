"""Query catalogue and its SQL oracle."""

from .oracle import ORACLE
from .queries import QUERIES, entities

__all__ = ["ORACLE", "QUERIES", "entities"]
