"""Scalar functions against worked-out edge rows and Python's own re and str."""

import hashlib
import html
import re
import sys

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusflow.functions import picks, regex, strict_json, text
from corpusflow.functions.cleaners import CLEANERS, apply_cleaners, cleaner, text_cleaner


def column(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[1] for r in sorted(df.select("i", fn(F.col("s")).alias("o")).collect())]


def test_whitespace_is_pythons():
    assert set(text.WHITESPACE) == {chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace()}


def test_strip_and_content_hash(spark):
    values = ["", " \n\t", "a", " a ", " a ", "A", "x \x1c", None]
    want = [hashlib.md5(v.strip().encode()).hexdigest() if v and v.strip() else "" for v in values]
    assert column(spark, values, text.content_hash) == want
    assert column(spark, values[:-1], text.py_strip) == [v.strip() for v in values[:-1]]


EDGES = st.text(" \n\r\t\x0b\x1c\x1f\x85\u2028\xa0a&é", max_size=14)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(EDGES, min_size=1, max_size=40))
def test_strip_agrees_with_python(spark, texts):
    texts = texts + ["x" * 40 + " " * 50, " " * 80, "x" + "\n" * 70 + "y" + "\n" * 33]
    assert column(spark, texts, text.py_strip) == [s.strip() for s in texts]


def test_block_content(spark):
    source = "  p1 l1\nl2  \n\n\r\n p2 \x0b q\n \n\np3\rz\n"
    got = column(spark, [source, '<a href="x">\'&', " \n\n ", ""], text.block_content)
    wrap = lambda p: f"<!-- wp:paragraph -->\n<p>{p}</p>\n<!-- /wp:paragraph -->"
    paragraphs = ["p1 l1<br/>l2", "p2 <br/> q", "p3<br/>z"]
    assert got[0] == "\n\n".join(wrap(p) for p in paragraphs)
    assert got[1] == wrap(html.escape('<a href="x">\'&'))
    assert got[2:] == ["", ""]
    long = column(spark, ["x" + "\n" * 70 + "y" + "\n" * 33, "a\n \nb", "a\r\n\r\nb", "a\n\t\n\nb\nc"], text.block_content)
    assert long == ["\n\n".join(map(wrap, p)) for p in (["x", "y"], ["a", "b"], ["a", "b"], ["a", "b<br/>c"])]


def test_byline_slug_names_email(spark):
    got = column(spark, ["A & B"], lambda c: text.with_byline(F.lit("body"), c))
    assert got == [
        "<!-- wp:paragraph -->\n<p><em>By A &amp; B</em></p>\n<!-- /wp:paragraph -->\n\nbody"
    ]
    assert column(spark, ["Sci & Tech", "!!!", "World"], lambda c: text.slugify(c, "category")) == [
        "sci-tech",
        "category",
        "world",
    ]
    assert column(spark, ["Ana Maria Paz", "Ana"], text.first_name) == ["Ana", "Ana"]
    assert column(spark, ["Ana Maria Paz", "Ana"], text.last_name) == ["Maria Paz", ""]
    assert column(spark, ["ana"], lambda c: text.synthetic_email(c, "x.org")) == ["ana@x.org"]


def test_redact(spark):
    long_token = "A" * 40
    got = column(spark, [f"Basic {long_token}== end", "x" * 31, "y " * 400], text.redact)
    assert got[0] == "Basic [redacted] end"
    assert got[1] == "x" * 31
    assert len(got[2]) == 300


def test_titles(spark):
    words = "word " * 30
    got = column(
        spark,
        ['Headline: "Q"', "**Bold**", "a\nb", words.strip(), "x" * 50, "title:headline: z"],
        lambda c: text.clean_title(c, 40),
    )
    assert got == [
        "Q",
        "Bold",
        "a",
        " ".join(["word"] * 8) + "...",
        "x" * 40 + "...",
        "headline: z",
    ]
    got = column(
        spark, ["First one. Second.", "", "  ", ". x", None], lambda c: text.title_from_summary(c, 40)
    )
    assert got == ["First one", "Untitled", "Untitled", "Untitled", "Untitled"]


DESK_MARK = r"^\[desk \d{1,3}\][\s:]*"


@pytest.mark.parametrize(
    "spec, source, want",
    [
        ({"type": "regex_strip", "pattern": "X"}, "aXbXc", "abXc"),
        ({"type": "regex_strip", "pattern": "X", "count": 2}, "XaXbXc", "abXc"),
        ({"type": "regex_strip", "pattern": "X", "count": 0}, "aXbXc", "abc"),
        ({"type": "regex_strip", "pattern": "x", "ignore_case": True}, "aXb", "ab"),
        ({"type": "regex_strip", "pattern": "^X"}, "aX\nXd", "aX\nd"),
        ({"type": "regex_strip", "pattern": "^X"}, "a\rXd", "a\rXd"),
        ({"type": "regex_strip", "pattern": DESK_MARK}, "[desk 12]: Rain falls", "Rain falls"),
        ({"type": "regex_strip", "pattern": DESK_MARK}, "[desk 1] A [desk 2] B", "A [desk 2] B"),
        ({"type": "regex_replace", "pattern": "X", "replacement": "-"}, "aXbX", "a-b-"),
        ({"type": "regex_replace", "pattern": "X", "replacement": "$1\\\\", "count": 1}, "aXX", "a$1\\X"),
        ({"type": "regex_replace", "pattern": "(a)(b)", "replacement": r"\2$\g<1>"}, "abab", "b$ab$a"),
        ({"type": "regex_replace", "pattern": "(a)(b)", "replacement": r"\2\1", "count": 1}, "abab", "baab"),
        ({"type": "regex_replace", "pattern": "x*", "replacement": "-"}, "abxd", "-a-b--d-"),
        ({"type": "regex_replace", "pattern": r"(?P<q>\w)=(?P=q)", "replacement": r"\g<q>"}, "é=é", "é"),
        ({"type": "regex_replace", "pattern": r"{[^{}]*}", "replacement": "-"}, "a{b}{{c}}", "a-{-}"),
        ({"type": "regex_replace", "pattern": "x{", "replacement": "-"}, "x{x", "-x"),
        ({"type": "regex_replace", "pattern": "{{x}}", "replacement": "-"}, "{x}{{x}}", "{x}-"),
        ({"type": "regex_replace", "pattern": "a{,3}b", "replacement": "-"}, "aaaab", "a-"),
        ({"type": "regex_replace", "pattern": "a{2}b{}", "replacement": "-"}, "aab{}", "-"),
        ({"type": "regex_replace", "pattern": r"<[\s\S]{1,4}>", "replacement": "-"}, "<a\nb>c", "-c"),
        ({"type": "regex_replace", "pattern": r"[\D,]+x", "replacement": "-"}, "1,ax", "1-"),
        ({"type": "regex_replace", "pattern": r"[^\S ]", "replacement": "-"}, "a b\tc", "a b-c"),
        ({"type": "html_strip"}, "<p>a<br/>b &amp; c</p>", "ab &amp; c"),
        ({"type": "collapse_whitespace"}, "a \t b\n\n c", "a b\n\n c"),
        ({"type": "trim"}, "  a  ", "a"),
    ],
)
def test_cleaners(spark, spec, source, want):
    assert column(spark, [source], lambda c: apply_cleaners(c, [spec])) == [want]


PATTERNS = [
    r"[A-Z][a-z]+",
    r"\s+",
    r"[\s,]+$",
    r"^\W+",
    r"\w+\Z",
    r"[[a&&b]+",
    r"(a|b)+c?",
    r"\d{1,2}:\d{2}",
    r"[^\s]x",
    r"a.b",
    r"(\w)\1",
    r"[]x]",
]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("ab xXcé1:2\n\r\t\x1c,[]&_ ", max_size=12), min_size=1, max_size=8))
def test_patterns_agree_with_python(spark, texts):
    outs = [
        apply_cleaners(F.col("s"), [{"type": "regex_replace", "pattern": p, "replacement": "_", "count": n}])
        for p in PATTERNS
        for n in (0, 1, 2)
    ]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(texts)], "i int, s string")
    for row in df.select("s", F.array(*outs).alias("o")).collect():
        want = [
            re.sub(p, "_", row.s, count=n, flags=re.S | re.M) for p in PATTERNS for n in (0, 1, 2)
        ]
        assert row.o == want, (row.s, [(p, w, g) for p, w, g in zip([p for p in PATTERNS for _ in range(3)], want, row.o) if w != g])


def test_most_patterns_stay_native():
    assert all(regex.to_java(p) for p in PATTERNS)
    assert regex.to_java(r"[^\S]") is None
    assert regex.to_java(r"(?a)x") is None


def test_chain_is_checked_when_built():
    with pytest.raises(ValueError, match="unknown type 'nope'"):
        apply_cleaners(F.lit("x"), [{"type": "trim"}, {"type": "nope"}])
    with pytest.raises(ValueError, match="'type' key"):
        apply_cleaners(F.lit("x"), [{"pattern": "x"}])


def test_registered_cleaners(spark):
    @cleaner("shout")
    def shout(c, spec):
        return F.concat(F.upper(c), F.lit(spec.get("mark", "!")))

    @text_cleaner("reverse")
    def reverse(s, spec):
        return s[::-1]

    try:
        specs = [{"type": "shout", "mark": "?"}, {"type": "reverse"}]
        assert column(spark, ["abc"], lambda c: apply_cleaners(c, specs)) == ["?CBA"]
    finally:
        CLEANERS.pop("shout"), CLEANERS.pop("reverse")


F3 = "```"
OUTPUTS = [
    ('{"title":"A title","category":"tech","date":"2010-05"}', ("A title", "Tech", "2010-05")),
    (F3 + 'json\n{"title":"Headline: \\"Q\\"","category":"World News","date":"2010-13"}\n' + F3, ("Q", "News", "")),
    ('Sure! {"title":"T2","category":"x"} thanks', ("T2", "", "")),
    ('[{"title":"a"}]', ("", "", "")),
    ('"str"', ("", "", "")),
    ("garbage", ("", "", "")),
    ("", ("", "", "")),
    (None, ("", "", "")),
    ('{"title":"T","category":{"a":1},"date":"2010-01"}', ("T", "", "2010-01")),
    ('Note {"a":{"title":"inner"}} end', ("inner", "", "")),
    ('{"title":0,"category":null}', ("", "", "")),
    ('{"title":"0","category":false}', ("0", "", "")),
    ('{"title":"x"} {"title":"y"}', ("x", "", "")),
    (F3 + "\n{'title':'a'}\n" + F3, ("", "", "")),
    ('{"title":"line1\\nline2"}', ("line1", "", "")),
    ("5", ("", "", "")),
    (F3 + 'JSON {"title":"U"}' + F3, ("U", "", "")),
    ("null", ("", "", "")),
    ('{"title":""}', ("", "", "")),
    ('{"title":"' + " ".join(["word"] * 30) + '"}', (" ".join(["word"] * 8) + "...", "", "")),
]


def test_parse_output(spark):
    df = spark.createDataFrame([(i, raw) for i, (raw, _) in enumerate(OUTPUTS)], "i int, raw string")
    parsed = strict_json.parse_output(df, "raw", ["News", "Tech", "World"], 40)
    assert parsed.columns == ["i", "raw", "parsed"]
    got = [tuple(r.parsed) for r in sorted(parsed.collect())]
    assert got == [want for _, want in OUTPUTS]


def test_response_schema(spark):
    ok = '{"title":"A","category":"Tech","date":"2010-05"}'
    bad = [
        ok.replace("Tech", "tech"),
        ok.replace("-05", "-13"),
        ok.replace('"A"', "1"),
        ok[:-1] + ',"x":1}',
        '{"title":"A","category":"Tech"}',
        "x",
    ]
    got = column(spark, [ok, *bad], lambda c: strict_json.conforms(c, ["News", "Tech"]))
    assert got == [True] + [False] * len(bad)


def test_picks_are_per_row_and_in_range(spark):
    df = spark.range(400).select(F.col("id").cast("string").alias("id"))
    out = df.select(
        "id",
        picks.pick_author(F.col("id"), ["a", "b", "c"]).alias("author"),
        picks.pick_author(F.col("id"), []).alias("nobody"),
        picks.pick_date(F.col("id"), "2007-04-01", "2015-04-30").alias("d"),
        picks.pick_date(F.col("id"), "2015-04-30", "2007-04-01").alias("backwards"),
        picks.date_from_year_month(F.lit("2012-02"), F.col("id"), "2012-02-15", "2013-01-01").alias("leap"),
        picks.date_from_year_month(F.lit("2011-02"), F.col("id"), "2011-01-01", "2013-01-01").alias("feb"),
        picks.date_from_year_month(F.lit("2013-02"), F.col("id"), "2011-01-01", "2013-01-31").alias("late"),
        picks.date_from_year_month(F.lit("2013-2"), F.col("id"), "2011-01-01", "2014-01-31").alias("form"),
    )
    rows = out.collect()
    again = {r.id: r for r in out.repartition(5).collect()}
    assert all(again[r.id] == r for r in rows)
    assert {r.author for r in rows} == {"a", "b", "c"} and {r.nobody for r in rows} == {""}
    assert all("2007-04-01T00:00:00" <= r.d <= "2015-04-30T00:00:00" for r in rows)
    assert {r.backwards for r in rows} == {"2015-04-30T00:00:00"}
    assert {int(r.leap[8:10]) for r in rows} == set(range(1, 30))
    assert {int(r.feb[8:10]) for r in rows} == set(range(1, 29))
    assert all(r.late is None and r.form is None for r in rows)
    assert column(spark, ["2012-02-15"], text.year_month) == ["2012-02"]
