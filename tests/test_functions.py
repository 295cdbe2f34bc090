import pytest
from pyspark.sql import functions as F

from corpusmill.functions import html, text, urls, values


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("r")).first()[0]


@pytest.mark.parametrize(
    "value, expected",
    [("Hello, `World`!", "hello-world"), ("", "section"), ("***", "section"), (None, "section"), ("a" * 70, "a" * 60), ("--x--", "x"), ("Café", "caf")],
)
def test_slug(spark, value, expected):
    assert one(spark, value, text.slug) == expected


@pytest.mark.parametrize(
    "value, expected",
    [("# Head\nText **bold** [link](u) ![i](p)", "Text bold link"), ("> quote", "quote"), (None, None), ("", ""), ("x" * 300, "x" * 240 + "…"), ("- – item", "item")],
)
def test_snippet(spark, value, expected):
    assert one(spark, value, text.snippet) == expected


def test_words(spark):
    assert one(spark, "  a  b\nc ", text.count_words) == 3
    assert one(spark, None, text.count_words) == 0
    assert one(spark, "", text.section_words) == 0
    assert one(spark, "word " * 200_000, text.count_words) == 200_000


@pytest.mark.parametrize("value, expected", [("By  Ann Lee", "Ann Lee"), ("x", None), ("12 34 56", None), (None, None), ("a1", "a1")])
def test_author(spark, value, expected):
    assert one(spark, value, text.clean_author) == expected


def test_titles_and_names(spark):
    assert one(spark, "A - B — C | D", text.clean_title) == "A - B"
    assert one(spark, " | Site", text.clean_title) == "| Site"
    assert one(spark, "Acme Wealth Management, LLC", text.short_name) == "Acme"
    assert one(spark, "Acme (US)", text.short_name) == "Acme"
    assert one(spark, "ACME, Inc. & Co", text.legal_name) == "acme &"
    assert one(spark, "wealth-co AB", text.folder_name) == "Wealth_Co_Ab"


def test_cells(spark):
    assert one(spark, 'a"b', text.csv_cell) == '"a""b"'
    assert one(spark, "a,b\n", text.csv_cell) == '"a,b\n"'
    assert one(spark, None, text.csv_cell) == ""
    assert one(spark, '<&">', text.html_escape) == "&lt;&amp;&quot;&gt;"
    assert one(spark, None, text.yes_no, "boolean") == "—"
    assert one(spark, 1_234_000_000, text.billions, "bigint") == "$1.23B"


def test_markers(spark):
    f = lambda c: text.between_markers(c, "<a>", "</a>", F.lit("new"))
    assert one(spark, "x<a>old</a>y", f) == "x<a>\nnew\n</a>y"
    assert one(spark, "</a>x<a>", f) is None
    assert one(spark, "none", f) is None


def test_front_matter(spark):
    df = spark.createDataFrame([('a "q"', None, ["x", "y"])], "title string, author string, tags array<string>")
    r = df.select(text.front_matter({"title": F.col("title"), "author": F.col("author")}, {"tags": F.col("tags")})).first()[0]
    assert r == '---\ntitle: "a \\"q\\""\nauthor: null\ntags: ["x", "y"]\n---'


@pytest.mark.parametrize(
    "value, expected",
    [("https://A.com/x/?q#h", "https://A.com/x"), ("https://a.com/", "https://a.com/"), ("not a url", "not a url"), (None, None)],
)
def test_canonical(spark, value, expected):
    assert one(spark, value, urls.canonical) == expected


@pytest.mark.parametrize(
    "value, expected",
    [("https://a.com/2024/3/7/x", "2024-03-07"), ("https://a.com/2024/3/", "2024-03-01"), ("https://a.com/x-2024-03-07-y", "2024-03-07"), ("https://a.com/x", None)],
)
def test_dated(spark, value, expected):
    assert one(spark, value, urls.dated) == expected


def test_url_tests(spark):
    assert one(spark, "https://a.com/blog/x", urls.is_content) is True
    assert one(spark, "https://a.com/page/2", urls.is_index) is True
    assert one(spark, "https://a.com/a.PDF", urls.is_file) is True
    assert one(spark, "https://a.com/a-long-slug-with-many-parts", urls.is_slug_like) is True
    assert one(spark, None, urls.is_content) is False
    assert one(spark, "https://www.brand-name.com/x", urls.slug_of_site) == "Brand_Name"
    assert one(spark, "Acme & Sons Wealth Group Inc", lambda c: urls.search_address("q=", c)) == "q=Acme%20%26%20Sons%20Wealth"


@pytest.mark.parametrize("value, expected", [("2024-01-02T10", "2024-01-02"), ("March 7, 2024", "2024-03-07"), ("Mar 7 2024", "2024-03-07"), ("03/07/2024", "2024-03-07"), ("soon", None), (None, None)])
def test_dates(spark, value, expected):
    assert one(spark, value, values.iso_date) == expected


def test_numbers(spark):
    assert one(spark, "1,204", values.comma_number) == 1204
    assert one(spark, "x", values.comma_number) is None
    assert one(spark, "12abc", values.leading_number) == 12
    assert one(spark, 1.005, values.rounded, "double") == pytest.approx(1.0)
    assert one(spark, "01/02/2020 and 11/12/2024", values.latest_us_date) == "2024-11-12"
    assert [one(spark, n, values.size_band, "int") for n in (1, 30, 31, 301, None)] == ["solo", "small", "mid", "large", None]


PAGE = "<html><head><title> T </title><meta content='D' name='description'><script>var x='</p>';</script></head><body><nav>n</nav><main><h1>One <b>x</b></h1><p>a &amp; b<ul><li>i<li>j</ul><a href='/u'>go</a></main></body>"


def test_html(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, "<b>unclosed <h2>h</h2>")], "id int, html string")
    flat = df.select(html.title(F.col("html")), html.description(F.col("html")), html.links(F.col("html"))).first()
    assert tuple(flat) == ("T", "D", ["/u"])
    got = {r.id: r for r in html.parsed(df, "id", "html").collect()}
    assert [(h.level, h.text) for h in got[1].headings] == [(1, "One x")]
    assert [(x.href, x.text) for x in got[1].links] == [("/u", "go")]
    assert got[1].markdown.startswith("# One **x**") and "a & b" in got[1].markdown and "- i" in got[1].markdown and "var x" not in got[1].markdown
    assert got[2].markdown == "" and [h.text for h in got[3].headings] == ["h"]
