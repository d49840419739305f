import random

import pytest
from pyspark.sql import functions as F

from tests.plain_html import text_lines
from vetline import functions as V


def one(spark, value, *columns):
    return spark.createDataFrame([value], ", ".join(f"c{i} string" for i in range(len(value)))).select(*columns).first()


@pytest.mark.parametrize(
    ("left", "right", "score"),
    [
        ("ADF NALU", "ADF/NALU", 1.0),
        ("Allied Democrtic Forces", "Allied Democratic Forces", 0.8148),
        ("Frank Kakolele Bwambal", "FRANK KAKOLELE BWAMBALE", 0.9167),
        ("", "", 0.0),
        ("a", "", 0.0),
    ],
)
def test_similarity_golden(spark, left, right, score):
    a, b = V.normalize_name_ascii("c0"), V.normalize_name("c1")
    assert one(spark, (left, right), F.round(V.trigram_similarity(a, b), 4))[0] == score


def test_similarity_null(spark):
    df = spark.createDataFrame([("a", None)], "a string, b string")
    assert df.select(V.trigram_similarity("a", "b")).first()[0] is None


def test_trigrams_stay_inside_words(spark):
    assert set(one(spark, ("ab -- c!",), V.trigrams("c0"))[0]) == {"  a", " ab", "ab ", "  c", " c "}
    assert one(spark, ("--",), V.trigrams("c0"))[0] == []
    row = one(spark, ("ёж 𝒳yz",), V.trigrams("c0").alias("g"), V.packed_trigrams("c0").alias("p"))
    assert len(row.g) == len(set(row.p)) == len(row.p)


@pytest.mark.parametrize(
    ("name", "unicode_form", "ascii_form"),
    [
        ("  Al-Qaida / in  Iraq!", "al qaida in iraq", "al qaida in iraq"),
        ("Аль-Каида", "аль каида", ""),
        ("a\tb \nc", "a b c", "a b c"),
        ("--", "", ""),
    ],
)
def test_normalisers(spark, name, unicode_form, ascii_form):
    assert tuple(one(spark, (name,), V.normalize_name("c0"), V.normalize_name_ascii("c0"))) == (unicode_form, ascii_form)


def test_json_helpers(spark):
    texts = ["null", "NaN", "[]", "[ ]", "{}", '{"a":1}', "[1]"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(V.empty_json_to_null("t")).collect()] == [None, None, None, None, "{}", '{"a":1}', "[1]"]
    flags = ["null", "NaN", "false", "0", "true", "1", "x", ""]
    df = spark.createDataFrame([(t,) for t in flags], "t string")
    assert [r[0] for r in df.select(V.bool_or_null("t")).collect()] == [None, None, False, False, True, True, True, False]
    row = one(spark, ('{"id":12,"name":null,"n":{"x":1}}',), V.json_fields("c0", "id", "name", "n").alias("j")).j
    assert tuple(row) == ("12", None, '{"x":1}')


def test_html_variants(spark):
    html = "<p>a&nbsp;b</p>c <br/>"
    assert one(spark, (html,), V.clean_html_spaced("c0"))[0] == "a b c"
    assert one(spark, (html,), V.strip_tags("c0"))[0] == "a&nbsp;bc "
    df = spark.createDataFrame([("", "real"), (None, " real "), (None, None), ("b", "real")], "b string, p string")
    assert [r[0] for r in df.select(V.display_text("b", "p")).collect()] == [None, "real", None, "b"]
    assert [r[0] for r in df.select(V.strip_tags("b")).collect()] == ["", "", "", "b"]


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<div>a<p>b</p>c</div>", "a\nb\nc"),
        ("<p>x &amp; y<!-- no --></p>", "x & y"),
        ("<script>var a='<p>';</script><style>p{}</style><b>z</b>", "z"),
        ("<ul>  <li>1</li>\n <li>2</li></ul>", "1\n\n\n2"),
        ("plain", "plain"),
        ("", ""),
        (None, ""),
    ],
)
def test_text_lines(spark, html, text):
    assert text_lines(html) == text
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(V.visible_text_lines("h")).first()[0] == text


PIECES = [
    "<p>", "</p>", "<P class='a>b'>", "<br>", "<br/>", "<div/>", "</div>", "<pre>", "</pre>", "<textarea>", "</textarea>", "<template>", "</template>", "<rt>", "</rt>",
    "<b>", "</b>", "<script>", "</script>", "<style type=x>", "</style>", "<SCRIPT>var a = '<p>' < 3;</SCRIPT>", "<script/>", "<!-- a > b <p> -->", "<!doctype html>", "<?pi x?>",
    "<![CDATA[ raw & <b> ]]>", "text", " ", "\n", " \n ", "\t", "a < b", "1<2", "&amp;", "&amp", "&copy;2", "&copy2", "&notit;", "&nosuch;", "&", "&#65;", "&#x41", "&#0;", "&#128;",
    "&#129;", "&#x9f;", "&#1;", "&#xFFFE;", "&#55296;", "&#1114112;", "&#99999999999;", "&#;", "&#x;", "é ü\u3000", "\xa0", "&nbsp;", "&NotEqualTilde;", "&ampx;", "</ p>", "<a href=\"x\"y>",
]


def test_text_lines_of_any_pieces_are_those_of_a_parser(spark):
    rng = random.Random(1)
    pages = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 14))) for _ in range(1500)]
    pages += [f"{page}{end}" for page in pages[:40] for end in ("<p", "<a href='x", "&am", "&amp", "<")]
    got = [r[0] for r in spark.createDataFrame([(i, page) for i, page in enumerate(pages)], "i int, h string").orderBy("i").select(V.visible_text_lines("h")).collect()]
    wrong = [(page, own, text_lines(page)) for page, own in zip(pages, got, strict=True) if own != text_lines(page)]
    assert not wrong, (len(wrong), wrong[:3])


def test_text_lines_of_given_and_large_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html")
    large = spark.createDataFrame([("a < b " * 20_000,), ("<p>x</p>" * 5_000,), ("<pre> \n </pre>" + "<i>y" * 1_000,), ("x" * 500_000 + "&lt;",), ("<a " + "b=c " * 20_000 + ">z",)], "html string")
    rows = pages.union(large).select("html", V.visible_text_lines("html").alias("own"))
    assert all(r.own == text_lines(r.html) for r in rows.collect())
    plan = pages.select(V.visible_text_lines("html"))._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in ("EvalPython", "MapInArrow", "MapInPandas"))


def test_name_parts_and_hash(spark):
    df = spark.createDataFrame([(" A ", None, "", "D ")], "a string, b string, c string, d string")
    assert df.select(V.person_name("a", "b", "c", "d")).first()[0] == "A D"
    assert df.select(V.entity_hash("a", "b", "c") == F.sha2(F.lit(" A None"), 256)).first()[0]
    row = one(spark, ("", "  ", "2015-04-07-04:00"), V.safe_text("c0"), V.safe_text("c1"), V.date_prefix("c2"))
    assert tuple(row) == (None, "", "2015-04-07")


def test_decisions(spark):
    df = spark.createDataFrame([(404,), (429,), (500,), (599,), (403,), (418,)], "s int")
    reasons = [r[0] for r in df.select(V.classify_http_reason(F.col("s"))).collect()]
    assert reasons == ["not_found", "rate_limited", "server_error", "server_error", "forbidden", "http_error"]
    cases = [(0, 0, 0.0), (10, 0, 100.0), (100, 5, 95.0), (300, 6, 98.0), (2803, 10, 99.64)]
    df = spark.createDataFrame(cases, "e int, m int, p double")
    levels = [r[0] for r in df.select(V.coverage_severity(F.col("e"), F.col("m"), F.col("p"))).collect()]
    assert levels == ["CRITICAL", "OK", "WARNING", "CRITICAL", "WARNING"]
