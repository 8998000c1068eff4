"""Page parsers, templates, guarded patches and fetching."""

import http.server
import re
import threading

import pytest
from pyspark.sql import functions as F

from quorumlake.functions import extract as X
from quorumlake.functions import similarity as S
from quorumlake.sources import fetch, sinks

ONE_LINE = "Candidate Name Party Votes\nAli Khan\nppp\n1,234\nNoor Din\nX\nn/a\nTotal\n9\n9"
PAGES = {
    "split, bars and stars": ("**Candidate Name** |\nParty Name |\nVote |\nAli Khan |\nindependant |\n**12** |\nHome Page", [("Ali Khan", "Independent", 12)]),
    "split, no party": ("Candidate Name\nVotes\nAli Khan\n5\nNoor Din\n7\n", [("Ali Khan", "", 5), ("Noor Din", "", 7)]),
    "one line, no party column in the text": (ONE_LINE, [("Ali Khan", "", 1234), ("Noor Din", "", None)]),
    "one line": ("Party Name\n" + ONE_LINE, [("Ali Khan", "PPP", 1234), ("Noor Din", "X", None)]),
    "a rest of too few lines": ("Candidate Name Votes\nAli Khan\n5\nNoor Din", [("Ali Khan", "", 5)]),
    "no header": ("Ali Khan\n5\n", []),
    "header alone": ("Candidate Name |\nVotes |", []),
    "empty": ("", []),
    "pipes first": ("| Candidate Name | Party Name | Votes |\n|---|:--:|---|\n| **A B** | ppp | 1.234 |\n| C | D | 0 |\nCandidate Name Votes\nE\n5", [("A B", "PPP", 1234)]),
    "a bare winner": ("| Candidate Name | Party Name |\n| A B | X |\n| C D | Y |", [("A B", "X", None)]),
    "prose is no winner": ("| The complete result of this constituency | x |", []),
}


@pytest.mark.parametrize("name", PAGES)
def test_page_rows(spark, name):
    text, want = PAGES[name]
    got = spark.createDataFrame([(text,)], "t string").select(X.page_rows(F.col("t")).alias("r")).first().r
    assert [tuple(r) for r in got] == want


def brute_plain(text):
    """Line by line."""
    cells = [c for c in (re.sub(r"\*+", "", re.sub(r"\|\s*$", "", x).strip()).strip() for x in text.split("\n")) if c]
    start = next((i for i, c in enumerate(cells) if re.match(r"(?i)candidate\s*name", c)), None)
    if start is None:
        return []
    if "vote" in cells[start].lower():
        width, at = (3 if "party" in cells[start].lower() else 2), start + 1
    else:
        at = start + 1
        while at < len(cells) and re.fullmatch(r"(?i)party(\s*name)?|votes?", cells[at]):
            at += 1
        width = max(2, at - start)
    out = []
    while at + width <= len(cells):
        group = cells[at : at + width]
        if not re.search("[A-Za-z]", group[0]) or re.match(X.SKIP, group[0]):
            break
        vote = group[-1].replace(",", "")
        party = group[1] if width > 2 and re.search(r"(?i)party\s*name", text) else ""
        out.append((group[0], X.PARTY_FIX.get(party.lower(), party), int(vote) if vote.isdigit() else None))
        at += width
    return out


def test_plain_rows_against_brute_force(spark):
    import random

    r = random.Random(3)
    parts = ["Candidate Name", "candidate  name Votes", "Candidate Name Party Votes", "Party Name |", "Votes", "Vote |", "Ali", "**Noor** |", "12", "1,234 |", "Total", "ppp", "", "x | y", "99 **"]
    texts = ["\n".join(r.choices(parts, k=r.randint(0, 14))) for _ in range(800)]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", X.plain_rows(F.col("t")).alias("r")).collect()
    for row in got:
        assert [tuple(x) for x in row.r] == brute_plain(texts[row.i]), texts[row.i]


def test_edit_similarity(spark):
    pairs = [("kitten", "sitting", 61.54), ("", "", 100.0), ("a", "", 0.0), ("abc", "abc", 100.0), (None, "a", None)]
    got = spark.createDataFrame(pairs, "a string, b string, want double").select("want", F.round(S.indel_ratio(F.col("a"), F.col("b")), 2).alias("got")).collect()
    assert all(r.want == r.got for r in got)
    assert spark.range(1).select(S.indel_ratio(F.lit("abcdef"), F.lit("a"), 90).alias("r")).first().r == 0


def test_templates_and_patches(spark, tmp_path):
    assert sinks.fill_template("a /*__X__*/ b /*__X__*/", {"X": "1"}) == "a 1 b 1"
    for text, values in (("a", {"X": "1"}), ("/*__X__*/ /*__Y__*/", {"X": "1"})):
        with pytest.raises(ValueError):
            sinks.fill_template(text, values)
    assert sinks.patch_once("a b c", "b", "x") == "a x c"
    for text in ("a c", "b b"):
        with pytest.raises(ValueError):
            sinks.patch_once(text, "b", "x")
    text = 'var A = 1; "DATA": {"s": "}{", "n": [1, {"m": "\\"}"}]}, B'
    assert sinks.replace_value(text, "DATA", "[]") == 'var A = 1; "DATA": [], B'
    for key in ("NONE", "A"):
        with pytest.raises(ValueError):
            sinks.replace_value(text, key, "x")
    f = tmp_path / "page.html"
    f.write_text("one two")
    copy = sinks.patch_file(spark, str(f), lambda x: sinks.patch_once(x, "two", "2"))
    assert f.read_text() == "one 2" and open(copy.removeprefix("file:")).read() == "one two"
    with pytest.raises(ValueError):
        sinks.patch_file(spark, str(f), lambda x: sinks.patch_once(x, "two", "2"))
    assert f.read_text() == "one 2"


def test_fetching_with_retries_and_encodings(spark):
    seen = {}

    class Pages(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            n = int(self.path.rsplit("/", 1)[-1])
            seen[n] = seen.get(n, 0) + 1
            if n == 3 or (n == 2 and seen[n] == 1):
                self.send_error(500)
                return
            self.send_response(200)
            self.end_headers()
            self.wfile.write({1: "é".encode(), 2: "é–".encode("cp1252"), 4: b"\x81\xe9"}[n])

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Pages)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    fetch.register(spark)
    how = {"url": f"http://127.0.0.1:{server.server_port}/p/{{n}}", "low": 1, "high": 4, "delay": 0, "pause": 0, "tries": 2, "tasks": 2}
    got = {r.number: r for r in spark.read.format("http_pages").options(**how).load().collect()}
    server.shutdown()
    assert got[1].text == "é" and got[2].text == "é–" and got[2].tries == 2 and got[4].text == "\x81é"
    assert got[3].text is None and got[3].tries == 2 and "500" in got[3].error and len(got) == 4
