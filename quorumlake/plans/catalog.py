"""All queries of the contest, career, linkage, text, spatial and source families."""

from quorumlake.plans import career_queries, contest_queries, family_queries, map_queries, raster_queries, spatial_queries, text_queries  # noqa: F401  they register themselves
from quorumlake.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
