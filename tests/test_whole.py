"""Queries that must read all of their input."""

import re

from quorumlake.plans.catalog import QUERIES


def test_whole_tables_are_read():
    """No registered query keeps a slice of a table's rows by a modulo, or a prefix of its texts."""
    import inspect

    from quorumlake.plans import career_queries, contest_queries, family_queries, map_queries, raster_queries, spatial_queries, text_queries

    for module in (career_queries, contest_queries, family_queries, map_queries, raster_queries, spatial_queries, text_queries):
        text = inspect.getsource(module)
        assert not re.search(r"WHERE \w+key % \d+ = \d|where\(\"\w+key % ", text.replace("p_partkey % 10", ""))
