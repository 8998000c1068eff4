import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quorumlake.llm import language_id as L

WORDS = {
    "en": "the of and that with from have this house water people time would about other".split(),
    "de": "der die und das nicht mit haus wasser menschen zeit über werden andere schon für".split(),
    "fr": "le la les des avec dans pour maison eau gens temps être autre déjà une".split(),
    "es": "el los las con para casa agua gente tiempo estar otro años una por muy".split(),
}


def rows(n, seed):
    r = random.Random(seed)
    out = []
    for i in range(n):
        l = sorted(WORDS)[i % 4]
        out.append((seed * 10**6 + i, " ".join(r.choices(WORDS[l], k=r.randint(4, 40))), l, f"h{i % 4}" if i % 2 else "mixed", l))
    return out


SCHEMA = "doc_id long, text string, lang string, source string, truth string"


@pytest.fixture(scope="module")
def model(spark):
    return L.fit(spark.createDataFrame(rows(400, 1), SCHEMA), sorted(WORDS))


def test_held_out_accuracy(spark, model):
    held = spark.createDataFrame(rows(400, 2), SCHEMA)
    got = L.identify(held, model).join(held, "doc_id")
    assert got.where("language = truth").count() >= 396


def test_evidence_decides_where_text_cannot(spark, model):
    plain = rows(200, 3)
    unsure = [(9, "zqxj", "de", "h0", ""), (10, "zqxj", "fr", "h1", "")]
    df = spark.createDataFrame(plain + unsure, SCHEMA)
    got = {r.doc_id: r.language for r in L.identify(df, model, declared=F.col("lang")).where("doc_id < 100").collect()}
    assert got == {9: "de", 10: "fr"}


def test_hosts_are_smoothed_by_their_domain(spark, model):
    data = [(i, t, l, f"{l}{i % 3}.{l}site.example", l) for i, t, l, _, _ in rows(240, 4)] + [(5, "zqxj", None, "new.desite.example", "")]
    df = spark.createDataFrame(data, SCHEMA)
    got = L.identify(df, model, host=F.col("source"), domain=F.substring_index("source", ".", -2)).where("doc_id = 5").first()
    assert got.language == "de"


def test_edges(spark, model):
    df = spark.createDataFrame([(1, None, None, None, ""), (2, "", "en", "x", ""), (3, "12 34 !!", "en", "x", ""), (4, "the house of people with the water", None, None, ""), (4, None, None, None, "")], SCHEMA)
    found = L.identify(df, model, declared=F.col("lang"), host=F.col("source"))
    got = sorted((r.doc_id, r.language, r.keep) for r in found.collect())
    assert got == [(1, "und", False), (2, "und", False), (3, "und", False), (4, "en", True), (4, "und", False)]
    assert sorted(r.doc_id for r in L.accepted(df.withColumn('_gone', F.lit(1)), found).collect()) == [4, 4]
    assert L.documents(df.limit(0)).count() == 0


def test_pages(spark, model):
    html = lambda l, body: f'<!DOCTYPE html><html lang="{l}"><style>p{{}}</style><p>{body}</p>'
    pages = [(i, f"https://www.{l}host.{l}/x", html(l, t)) for i, t, l, _, _ in rows(80, 5)] + [(1, "http://www.frhost.fr/", html("fr", "zqxj")), (2, None, None)]
    got = {r.page_id: r.language for r in L.pages(spark.createDataFrame(pages, "page_id long, url string, html string"), model).collect()}
    assert got[1] == "fr" and got[2] == "und" and len(got) == 82


def brute(rows, languages, ids_half, evidence, strength=20.0, most=200):
    """The whole fusion by dictionaries: rows are (id, text, declared, suffix, domain, host)."""
    fold = lambda b: b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32
    names = [*languages, L.NONE]
    grams = {}
    for k, (i, text, *_) in enumerate(rows):
        b = [fold(x) for x in (text or "").encode()]
        grams[k] = [((b[j] << 16 | b[j + 1] << 8 | b[j + 2]) * 2654435761 & 0xFFFFFFFF) >> 16 for j in range(len(b) - 2) if b[j + 1] != 32]
    counts = {}
    for k, (i, *_) in enumerate(rows):
        if evidence[k] in languages:
            counts.setdefault((ids_half[k], evidence[k]), Counter()).update(grams[k])

    def likely(k):
        out = []
        for name in languages:
            c = counts.get((1 - ids_half[k], name), Counter())
            n = sum(c.values())
            out.append(sum(math.log(0.9 * ((c[g] + 1e-9) / (n + 1e-9 * 65536)) + 0.1 / 65536) for g in grams[k]))
        out.append(len(grams[k]) * (-16 * math.log(2) + L.NONE_LOG))
        return [x * min(1, most / max(1, len(grams[k]))) for x in out]

    ll = [likely(k) for k in range(len(rows))]
    own = [x.index(max(x)) if grams[k] else len(languages) for k, x in enumerate(ll)]
    whole = [own.count(j) for j in range(len(names))]
    top = [(c + 1) / (len(rows) + len(names)) for c in whole]
    tally = lambda pick: {v: [sum(own[k] == j for k in range(len(rows)) if pick(rows[k]) == v) for j in range(len(names))] for v in {pick(r) for r in rows} if v is not None}
    ld, ls = ({v: [math.log((a + p) / (w + 1)) for a, p, w in zip(c, top, whole)] for v, c in tally(lambda r, at=at: r[at]).items()} for at in (2, 3))
    smooth = lambda c, prior: [(a + strength * p) / (sum(c) + strength) for a, p in zip(c, prior)]
    domains = {v: smooth(c, top) for v, c in tally(lambda r: r[4]).items()}
    hosts = {v: smooth(c, domains.get(v[1], top)) for v, c in tally(lambda r: (r[5], r[4]) if r[5] is not None else None).items()}
    out = []
    for k, (i, _, d, s, dom, h) in enumerate(rows):
        total = [x + ld.get(d, [0] * 9)[j] + ls.get(s, [0] * 9)[j] + math.log(hosts[h, dom][j] if h is not None else top[j]) for j, x in enumerate(ll[k])]
        e = [math.exp(x - max(total)) for x in total]
        p = max(e) / sum(e)
        name = names[e.index(max(e))] if grams[k] else L.NONE
        out.append((i, name, round(p, 6) if grams[k] else 1.0, len(grams[k]), name != L.NONE and p >= 0.5))
    return out


def test_whole_fusion_against_brute_force(spark):
    """Declaration, suffix, domain and host at once, and each row's label held out of the model that scores it."""
    r = random.Random(6)
    data = []
    for i, t, l, h, _ in rows(160, 7):
        d = r.choice([l, l, "en", None])
        host = None if i % 9 == 0 else f"{h}.{l}{i % 3}.example.{r.choice([l, 'com'])}"
        text = None if i % 31 == 0 else "zqx j" if i % 13 == 0 else t if i % 17 else t + " und the la"
        data.append((i, text, d, host and host.rsplit(".", 1)[-1], host and ".".join(host.rsplit(".", 2)[-2:]), host))
    data += [(None, "the house of people", "en", None, None, None), (data[5][0], "der die das haus", "de", *data[5][3:])]
    df = spark.createDataFrame([(*x, "clash") for x in data], "doc_id long, text string, lang string, suffix string, domain string, source string, _half string")
    half = [x.h for x in df.select(L.half_of("doc_id").alias("h")).collect()]
    assert 0 < sum(half) < len(half)
    languages = sorted(WORDS)
    found = L.identify(df, L.fit(df, languages), declared=F.col("lang"), suffix=F.col("suffix"), domain=F.col("domain"), host=F.col("source"))
    got = sorted(((x.doc_id, x.language, round(x.posterior, 6), x.n_grams, x.keep) for x in found.collect()), key=str)
    want = sorted(brute(data, languages, half, [x[2] for x in data]), key=str)
    assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], abs=2e-4)


def test_very_long_text(spark, model):
    df = spark.createDataFrame([(1, "the house of the people with the water " * 50_000, "en", "s", "")], SCHEMA)
    got = L.identify(df, model, declared=F.col("lang")).first()
    assert got.language == "en" and got.n_grams > 1_000_000


def test_suffix_and_domain_of_addresses(spark):
    from quorumlake.llm.language_id import address

    want = {
        "news.shop.co.uk": ("co.uk", "shop.co.uk"), "shop.co.uk": ("co.uk", "shop.co.uk"), "co.uk": ("co.uk", None), "www.example.de": ("de", "example.de"),
        "example.de.": ("de", "example.de"), "localhost": ("localhost", None), "192.168.0.1": (None, None), "[2001:db8::1]": (None, None), None: (None, None),
    }
    suffix, domain = address(F.col("h"))
    rows = spark.createDataFrame([(h,) for h in want], "h string").select("h", suffix.alias("s"), domain.alias("d")).collect()
    assert {r.h: (r.s, r.d) for r in rows} == want
    suffix, domain = address(F.col("h"), ())
    assert tuple(spark.createDataFrame([("a.b.co.uk",)], "h string").select(suffix, domain).first()) == ("uk", "co.uk")
