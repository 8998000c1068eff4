import hashlib
import re

import pytest
from pyspark.sql import functions as F

from quorumlake.llm import exact_dedup
from quorumlake.llm.queries import QUERIES

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(SPACE.sub("", t or ""), []).append((i, t or ""))
    out = []
    for norm, members in groups.items():
        order = sorted(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        out += [(i, order[0][0], len(members), n == 0, hashlib.sha256(norm.encode()).hexdigest()) for n, (i, _) in enumerate(order)]
    return sorted(out, key=repr)


ROWS = [
    (1, "a b c"), (2, "abc"), (3, "a\tb\nc "), (4, "a\x0bbc  "), (5, None), (6, ""), (7, " \r\n"), (8, "ä ö"), (9, "äö"), (10, "a b"), (11, "ab"), (None, "ab   "), (None, None),
    (12, "x" * 100_000), (13, "x" * 99_999 + " x"), (2, "abc"), (14, "alone"), (15, "A b c"),
]


@pytest.mark.parametrize("how", [{}, {"most_sent": 0}, {"hashed": lambda c: F.substring(c, 1, 1).cast("binary")}, {"hashed": lambda c: F.lit(b"all")}])
def test_rows(spark, how):
    """Any hash, even one that puts unlike texts together, gives groups of equal bytes."""
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    assert sorted(map(tuple, exact_dedup.marks(df, **how).collect()), key=repr) == brute(ROWS)


def test_clashing_columns_and_rows_that_stay(spark):
    df = spark.createDataFrame([(*r, "m", 1, 2) for r in ROWS], "doc_id long, text string, norm string, row int, _row int")
    left = exact_dedup.keep_one(df)
    assert left.columns == df.columns
    want = sorted((i for i, _, _, kept, _ in brute(ROWS) if kept), key=repr)
    assert sorted((r.doc_id for r in left.collect()), key=repr) == want
    assert exact_dedup.marks(df.limit(0)).count() == 0


def test_query_on_its_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op11_exact_dedup"](spark, sf).collect()), key=repr) == brute(rows)
