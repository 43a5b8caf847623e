"""All registered queries."""

from verification import companions, modelling, readers, relational, statistics
from verification.relational import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "companions", "modelling", "readers", "relational", "statistics"]
