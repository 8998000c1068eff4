import random

import pytest
from pyspark.sql import functions as F

from quorumlake.functions.similarity import lcs
from quorumlake.functions.textnorm import name_forms
from quorumlake.operators import linkage as L
from quorumlake.operators.simjoin import similar_rows, similar_strings


def edit(word, r, n):
    for _ in range(n):
        at = r.randrange(len(word) + 1)
        word = r.choice([word[:at] + r.choice("abc") + word[at:], word[:at] + word[at + 1 :], word[:at] + r.choice("abc") + word[at + 1 :]])
    return word


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def ratio(a, b):
    return 100.0 if a == b else 200.0 * lcs(a, b) / (len(a) + len(b))


@pytest.mark.parametrize(("least", "edits"), [(93, 1), (80, 0), (95, 0), (100, 0)])
def test_all_similar_strings_of_a_group_are_found(spark, least, edits):
    r = random.Random(least)
    base = ["".join(r.choice("abc") for _ in range(r.randrange(0, 40))) for _ in range(40)]
    rows = [(i, r.choice("pq"), edit(r.choice(base), r, r.randrange(0, 5))) for i in range(400)]
    rows += [(400, None, base[0]), (401, "p", None), (402, "p", ""), (403, "p", "")]
    df = spark.createDataFrame(rows, "id long, g string, s string")
    true = set()
    for i, (a, g, s) in enumerate(rows):
        for b, h, t in rows[i + 1 :]:
            if g is not None and g == h and s is not None and t is not None:
                if ratio(s, t) >= least or (edits and max(len(s), len(t)) >= 10 and levenshtein(s, t) <= edits):
                    true.add((a, b))
    got = [(x.a, x.b) for x in similar_rows(df, "id", "g", "s", least, edits=edits, edits_from=10).collect()]
    assert len(got) == len(set(got)) and set(got) == true and len(true) > 40


def test_equal_strings_are_one_row_and_empty_tables(spark):
    df = spark.createDataFrame([(i, "p", "same name") for i in range(50)], "id long, g string, s string")
    assert [tuple(x) for x in similar_strings(df, "g", "s", 93).collect()] == [("p", "same name", "same name")]
    assert similar_rows(df, "id", "g", "s", 93).count() == 50 * 49 // 2
    assert similar_rows(df.limit(0), "id", "g", "s", 93).count() == 0


@pytest.mark.parametrize("how", [{}, {"modern": False, "same_year": True}])
def test_hot_districts_give_the_same_matches(spark, how):
    """Every size of a district from which its rows meet by parts gives what all pairs of the blocks give."""
    r = random.Random(5)
    words = ["Muhammad", "Khan", "Tarvolin", "Beskrad", "Quilfex", "Syed", "Ozmir", "Wentiq", "Ali", "Hestram"]
    names = [" ".join(r.sample(words, r.randrange(1, 5))) for _ in range(60)]
    full = []
    for i in range(300):
        name = r.choice(names)
        name = edit(name, r, 1) if i % 3 == 0 else " ".join(r.sample(name.split(), len(name.split()))) if i % 3 == 1 else name + " Khan" * (i % 2)
        full.append((i, name, r.choice(["d1", "d1", "d2", ""]), r.choice(["Punjab", "Sindh"]), r.choice(["A", "IND"]), 1990 + i % 3, f"NA-{i % 7}"))
    df = spark.createDataFrame(full, "id long, name_raw string, district string, province string, party string, year int, na string")
    df = df.withColumn("_n", name_forms(F.col("name_raw"))).select("*", "_n.core", "_n.squash", "_n.distinct").drop("_n")
    df = L.rare_tokens(df.withColumn("_t", F.split("core", " ")), "id", "_t").drop("_t").cache()
    true = sorted(map(tuple, L.matches(df, L.block_pairs(L.blocks(df, "id"), "id"), "id", **how).collect()))
    assert len(true) > 100
    for held in (0, 100, 400):
        pairs = L.candidates(df, "id", held=held)
        assert sorted(map(tuple, L.matches(df, pairs, "id", **how).collect())) == true
