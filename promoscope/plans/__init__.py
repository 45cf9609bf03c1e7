"""Named queries over the driver tables and their oracle SQL."""

from promoscope.plans.catalog import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
