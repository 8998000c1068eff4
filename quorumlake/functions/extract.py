"""Result rows out of web pages: HTML tables, pipe tables, and one-cell-a-line text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quorumlake.functions.textnorm import PARTY_FIX, recode, vote_literal

#: Lines that are headers, totals or navigation, and prose that is no name (fixed values).
SKIP = r"(?i)^(candidate\s*name|party(\s*name)?|votes?|total|valid|rejected|registered|turnout|polled|home\s*page|privacy|disclaimer|policy|general election|na[\s-]?\d+\s|\[|!\[|http)"
PROSE = r"(?i)detail|complete|elected|\bresult\b|constituency|provide|information|consolidated|general election|votes detail"
TOTALS = r"(?i)^(total|valid|rejected|registered|turnout|polled)"
ROW = "struct<name:string,party:string,votes:bigint>"


def clean_cell(s: Column) -> Column:
    """Text of a cell: tags to spaces, four entities, single spaces."""
    s = F.regexp_replace(s, "<[^>]*>", " ")
    for entity, c in (("&nbsp;", " "), ("&amp;", "&"), ("&#39;", "'"), ("&quot;", '"')):
        s = F.replace(s, F.lit(entity), F.lit(c))
    return F.btrim(F.regexp_replace(s, r"\s+", " "))


def page_title(html: Column) -> Column:
    return clean_cell(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value made once, which inside lambdas it would otherwise be for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _entry(cells: Column, has_party: Column | None = None, fix_party: bool = True) -> Column:
    """struct of a row's cells: the last vote-like cell is the vote, the first other one the name, the second the party."""

    def parted(v: Column) -> Column:
        others = F.filter(F.transform(cells, lambda c, i: F.when(v["at"].isNull() | (i != v["at"]), F.nullif(c, F.lit("")))), lambda c: c.isNotNull())
        return _let(F.struct(others.alias("others"), F.get(v["votes"], v["at"]).alias("vote")), named)

    def named(v: Column) -> Column:
        party = F.get(v["others"], F.lit(1))
        party = F.coalesce(_fixed(party) if fix_party else party, F.lit(""))
        if has_party is not None:
            party = F.when(has_party, party).otherwise("")
        return F.struct(F.get(v["others"], F.lit(0)).alias("name"), party.alias("party"), v["vote"].alias("votes"))

    last = lambda votes: F.array_max(F.filter(F.transform(votes, lambda v, i: F.when(v.isNotNull(), i)), lambda i: i.isNotNull()))
    votes = F.transform(cells, lambda c: vote_literal(c))
    return _let(votes, lambda v: _let(F.struct(v.alias("votes"), last(v).alias("at")), parted))


def _fixed(party: Column) -> Column:
    return recode(F.lower(party), PARTY_FIX, party)


def html_rows(html: Column) -> Column:
    """``array<struct<name,party,votes>>`` of table rows of three or more cells, one of them a vote count; parties as written."""
    rows = F.regexp_extract_all(html, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    cells = F.transform(rows, lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)), lambda c: clean_cell(c)))
    entries = F.transform(F.filter(cells, lambda c: F.size(c) >= 3), lambda c: _entry(c, fix_party=False))
    return F.filter(entries, lambda e: e["votes"].isNotNull() & e["name"].rlike("[A-Za-z]") & ~e["name"].rlike(TOTALS))


def has_party_column(text: Column) -> Column:
    return text.rlike(r"(?i)party\s*name|\|\s*\*\*\s*party")


def pipe_rows(text: Column, has_party: Column | None = None) -> Column:
    """Rows of ``| a | b |`` tables; without any vote count, the first plausible bare name alone. A row whose number is no possible count (a million and
    more) stays beside counted ones, with a null vote; the reference drops it."""
    party = has_party_column(text) if has_party is None else has_party
    lines = F.filter(F.transform(F.split(text, r"\r?\n"), lambda x: F.btrim(x)), lambda x: x.startswith("|"))
    cells = F.transform(lines, lambda x: F.transform(F.split(F.btrim(x, F.lit("|")), r"\|"), lambda c: F.btrim(F.regexp_replace(c, r"\*\*", ""))))
    cells = F.filter(cells, lambda c: (F.size(c) >= 2) & ~F.forall(c, lambda x: (x == "") | x.rlike(r"^:?-{2,}:?$")))
    good = lambda e: F.coalesce(e["name"].rlike("[A-Za-z]") & ~e["name"].rlike(SKIP), F.lit(False))

    def chosen(entries: Column) -> Column:
        counted = F.filter(entries, lambda e: e["votes"].isNotNull())
        bare = F.filter(entries, lambda e: e["votes"].isNull() & (F.length(e["name"]) <= 45) & ~e["name"].rlike(PROSE))
        kept = F.filter(entries, lambda e: e["votes"].isNotNull() | e["beyond"])
        return F.transform(F.when(F.size(counted) > 0, kept).otherwise(F.slice(bare, 1, 1)), lambda e: e.dropFields("beyond"))

    beyond = lambda c: F.exists(c, lambda x: F.regexp_replace(x, "[,.]", "").rlike("^[0-9]{7,}$"))
    read = lambda c, p: _let(_entry(c, p), lambda e: e.withField("beyond", e["votes"].isNull() & beyond(c)))
    entries = _let(party, lambda p: F.filter(F.transform(cells, lambda c: read(c, p)), good))
    return _let(entries, chosen)


def plain_rows(text: Column) -> Column:
    """Rows of text with one cell a line, whose lines may end in a bar and hold stars.

    The first line that begins with Candidate Name is the header: alone if it names the votes too (three columns if also the
    party, else two), else with the Party and Votes lines that follow. Then come groups of so many lines, until
    one does not begin with a name. The last line of a group is the vote, without a number null; the party is taken only
    from three columns and where the text has a party column. A rest of too few lines is no row.
    """
    lines = F.transform(F.split(text, r"\r?\n"), lambda x: F.btrim(F.replace(F.btrim(F.regexp_replace(x, r"\|\s*$", "")), F.lit("*"), F.lit(""))))
    lines = F.filter(lines, lambda x: x != "")
    is_head = lambda x: x.rlike(r"(?i)^candidate\s*name")
    none = F.array().cast("array<string>")

    def with_head(v: Column) -> Column:
        after = F.when(v["head"] > 0, F.slice(v["lines"], v["head"] + 1, F.size(v["lines"]))).otherwise(none)
        first = F.try_element_at(v["lines"], F.nullif(v["head"], F.lit(0)))
        return _let(F.struct(after.alias("after"), first.alias("first"), v["party"].alias("party")), with_rest)

    def with_rest(v: Column) -> Column:
        other = F.array_position(F.transform(v["after"], lambda x: x.rlike(r"(?i)^(party(\s*name)?|votes?)$")), False).cast("int")
        more = F.when(v["first"].rlike("(?i)vote"), 0).when(other > 0, other - 1).otherwise(F.size(v["after"]))
        return _let(F.struct(v["after"].alias("after"), v["first"].alias("first"), v["party"].alias("party"), more.alias("more")), with_width)

    def with_width(v: Column) -> Column:
        single = v["first"].rlike("(?i)vote")
        width = F.when(single, F.when(v["first"].rlike("(?i)party"), 3).otherwise(2)).otherwise(F.greatest(F.lit(2), v["more"] + 1))
        body = F.slice(v["after"], v["more"] + 1, F.size(v["after"]))
        return _let(F.struct(body.alias("body"), width.alias("width"), (v["party"] & (width >= 3)).alias("party")), with_body)

    def with_body(v: Column) -> Column:
        full = F.floor(F.size(v["body"]) / v["width"]).cast("int")
        at = F.when(full > 0, F.sequence(F.lit(0), full - 1)).otherwise(F.array().cast("array<int>"))
        return _let(F.transform(at, lambda k: entry(v, k)), until_bad)

    def entry(v: Column, k: Column) -> Column:
        cell = lambda i: F.get(v["body"], (k * v["width"] + i).cast("int"))
        vote = F.replace(cell(v["width"] - 1), F.lit(","), F.lit(""))
        return F.struct(
            cell(F.lit(0)).alias("name"), F.when(v["party"], _fixed(cell(F.lit(1)))).otherwise("").alias("party"),
            F.when(vote.rlike("^[0-9]{1,18}$"), vote).cast("long").alias("votes"),
        )

    def until_bad(entries: Column) -> Column:
        stop = F.array_position(F.transform(entries, lambda e: e["name"].rlike("[A-Za-z]") & ~e["name"].rlike(SKIP)), False).cast("int")
        return F.when(stop > 0, F.slice(entries, 1, stop - 1)).otherwise(entries)

    head = lambda x: F.array_position(F.transform(x, is_head), True).cast("int")
    return _let(lines, lambda x: _let(F.struct(x.alias("lines"), head(x).alias("head"), has_party_column(text).alias("party")), with_head))


def page_rows(text: Column) -> Column:
    """Pipe tables, else one-cell-a-line text."""
    return _let(pipe_rows(text), lambda piped: F.when(F.size(piped) > 0, piped).otherwise(plain_rows(text)))
