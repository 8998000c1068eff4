"""A Spark-first engine for contest-style tables: ranking, linkage, careers, spatial apportionment."""
