import random
import re

from quorumlake.llm import licenses as L


def brute(rows, templates, least=0.8):
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = []
    for i, t in rows:
        w = words(t)
        mine = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        for name, text in templates.items():
            v = words(text)
            s = {tuple(v[k : k + 5]) for k in range(len(v) - 4)}
            if s and len(s & mine) / len(s) >= least:
                out.append((i, name, round(len(s & mine) / len(s), 9)))
    return sorted(out)


def test_against_brute_force(spark):
    r = random.Random(1)
    rows = [(0, None), (1, ""), (2, "a b c d")]
    names = list(L.TEMPLATES)
    for i in range(3, 150):
        body = [r.choice(["lorem", "ipsum", "the", "license", "under"]) for _ in range(r.randint(0, 60))]
        for _ in range(r.randint(0, 2)):
            notice = L.TEMPLATES[r.choice(names)].split()
            if i % 3 == 0:
                notice = [w.upper() + "!!" for w in notice]
            if i % 4 == 0 and len(notice) > 30:
                notice[len(notice) // 2] = "changed"
            at = r.randint(0, len(body))
            body[at:at] = notice
        rows.append((i, " ".join(body)))
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, template string")
    got = L.scan(df)
    assert sorted((x.doc_id, x.template, round(x.containment, 9)) for x in got.collect()) == brute(rows, L.TEMPLATES)


def test_place_and_repeats(spark):
    notice = L.TEMPLATES["GPL-3.0"]
    df = spark.createDataFrame([(1, f"x y z {notice} q {notice}"), (1, "none"), (None, notice)], "doc_id long, text string")
    got = {(r.doc_id, r.template): r for r in L.scan(df).collect()}
    assert set(got) == {(1, "GPL-3.0"), (None, "GPL-3.0")} and got[1, "GPL-3.0"].first_word == 3


def test_own_templates_and_empty(spark):
    df = spark.createDataFrame([(1, "this is my very own notice text")], "doc_id long, text string")
    own = spark.createDataFrame([("own", "my very own notice text"), ("short", "own notice")], "template string, text string")
    assert [(r.template, r.containment) for r in L.scan(df, own).collect()] == [("own", 1.0)]
    assert L.scan(df.limit(0), own).count() == 0 and L.scan(df, own.limit(0)).count() == 0


def test_windows_that_hold_for_certain():
    for n in range(1, 60):
        run = L.run_of(n)
        step = max(1, run // 2)
        for start in range(40):  # an unbroken stretch at any place holds a whole window
            assert any(s >= start and s + run <= start + L.unbroken(n) for s in range(0, 200, step))


def test_insertions_deletions_and_moves(spark):
    """Copies that keep four fifths of the shingles, whatever the changes, are all found; one scan does it."""
    r = random.Random(4)
    rows = []
    for i in range(400):
        w = L.TEMPLATES[r.choice(list(L.TEMPLATES))].split()
        for _ in range(r.randint(0, 1 + len(w) // 25)):
            at = r.randrange(len(w))
            w[at : at + r.choice([0, 0, 1, 2])] = r.choice([["new"], ["two", "words"], []])
        if i % 5 == 0:
            w = w[len(w) // 2 :] + w[: len(w) // 2]
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((x.doc_id, x.template, round(x.containment, 9)) for x in L.scan(df).collect())
    assert got == brute(rows, L.TEMPLATES) and len(got) > 200
    plan = L.scan(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") <= 2


def test_very_long_text(spark):
    text = "filler words of a long text " * 30_000 + L.TEMPLATES["Zlib"] + " more of it" * 1000
    df = spark.createDataFrame([(1, text), (2, "")], "doc_id long, text string")
    assert [(x.doc_id, x.template, x.first_word) for x in L.scan(df).collect()] == [(1, "Zlib", 180_000)]


def test_native_plan(spark):
    df = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    plan = L.scan(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
