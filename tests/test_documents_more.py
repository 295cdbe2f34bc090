from pyspark.sql import functions as F

from corpusmill.functions import html as hx
from corpusmill.operators import catalog, crawl, documents, nested, sections
from corpusmill.plans import knowledge_base as kb
from tests.conftest import rows

# The matrix's dimensions in their order, as readers know the document.
DIMENSIONS = [
    "Threat level", "Confidence", "Competitor type", "Team size", "Branches", "Geography", "Pricing model", "Fee schedule public", "Wealth tiers", "Early adults (first investment)", "Mid-career 401(k)",
    "Jurisdiction", "Regulator", "SEC registered", "CRD", "Ownership", "Fiduciary stated", "Fee-only stated", "Disciplinary disclosures", "Media presence", "Design tone",
]


def test_matrix_has_all_dimensions(spark):
    assert [label for group in catalog.MATRIX.values() for label in group] == DIMENSIONS
    kinds = {"fee_schedule_published": "boolean", "sec_registered": "boolean", "fiduciary_stated_explicitly": "boolean", "fee_only_stated_explicitly": "boolean", "disciplinary_disclosures": "boolean", "wealth_tiers_served": "array<string>", "branch_count": "bigint"}
    columns = [c for group in catalog.MATRIX.values() for c in group.values()]
    values = {"threat_level": "high", "branch_count": 40, "fee_schedule_published": False, "wealth_tiers_served": ["hnw", "uhnw"], "fee_only_stated_explicitly": True}
    df = spark.createDataFrame([("a", *[values.get(c) for c in columns])], ", ".join(["slug string", *[f"{c} {kinds.get(c, 'string')}" for c in columns]]))
    got = {r.dimension: r.value for r in catalog.matrix(df).collect()}
    assert len(got) == 21 and got["Threat level"] == "high" and got["Branches"] == "40" and got["Fee schedule public"] == "no" and got["Wealth tiers"] == "hnw, uhnw" and got["Fee-only stated"] == "yes" and got["Jurisdiction"] == "—"
    lines = documents.matrix_markdown(catalog.matrix(df), F.lit(0)).collect()
    assert "| Scale & scope / Branches | 40 |" in {r.line for r in lines}


def test_csv_numbers_are_plain(spark):
    df = spark.createDataFrame([(0.0005, 1.0, None, "a,b")], "w double, x double, y double, z string")
    assert df.select(catalog.csv_line(df, ["w", "x", "y", "z"])).first()[0] == '0.0005,1,,"a,b"'


def test_spans(spark):
    h = spark.createDataFrame([("a", "2024-06-01", 100), ("a", "2023-05", 80), ("a", "2022", 50), ("a", "soon", 1), ("a", None, 1), ("b", "2024", 7), ("c", "2024-01-01", None)], "k string, d string, v bigint")
    got = {r.k: (r.as_of, r.value, r.year_ago, r.years_ago, r.change_12m, r.change_24_36m) for r in catalog.spans(h, "k", "d", "v").collect()}
    assert got == {"a": ("2024-06-01", 100, 80, 50, 20, 50), "b": ("2024", 7, None, None, None, None)}
    assert catalog.spans(h.where("false"), "k", "d", "v").count() == 0


def test_posts_by_date(spark):
    df = spark.createDataFrame([("f", "2024-01-02", "a"), ("f", None, "b"), ("f", "2024-02", "c"), ("f", "2024-01-02", "d"), (None, "2020", "e"), ("f", "", "g")], "firm string, date string, url string")
    got = {r.url: r.place for r in documents.posts_by_date(df).collect()}
    assert got == {"c": 1, "a": 2, "d": 3, "b": 4, "g": 5, "e": 1}


def test_firm_page(spark):
    firms = spark.createDataFrame([("s", "S & Co", "ria", None, 2_000_000_000, None, 1)], "slug string, competitor string, competitor_type string, regulator string, aum_usd bigint, website string, posts bigint")
    docs = spark.createDataFrame([("s", "Full_Profile.md")], "slug string, name string")
    posts = spark.createDataFrame([("s", None, "T", "u"), ("x", None, "T", "u")], "firm string, date string, title string, url string")
    got = [r.line for r in documents.firm_page_lines(firms, docs, posts).orderBy("part", "place").collect()]
    assert got == ["# S & Co", "ria · $2.00B · 1 post", "- [Full Profile](/s/Full_Profile.md)", "- undated: [T](u)"]


def test_sitemaps(spark):
    robots = spark.createDataFrame([("s", "User-agent: *\nSitemap: https://s/i0\n  sitemap: https://s/gone"), ("t", None)], "site string, text string")
    nested_ = [("s", "b", f"https://s/i{k}", f"<sitemapindex><loc>https://s/i{k + 1}</loc></sitemapindex>") for k in range(7)]
    pages_ = [("s", "b", "https://s/i3", "<urlset><loc> https://s/p </loc></urlset>"), ("s", "b", "https://s/i9", "<urlset/>")]
    maps = spark.createDataFrame([x for x in nested_ if x[2] != "https://s/i3"] + pages_, "site string, base string, url string, xml string")
    assert [r.url for r in crawl.reachable_sitemaps(maps, crawl.robots_sitemaps(robots)).collect()] == ["https://s/i3"]
    assert crawl.reachable_sitemaps(maps, crawl.robots_sitemaps(robots), levels=2).count() == 0


def test_post_metadata(spark):
    page = '''<head><meta name="keywords" content="Tax, tax ,Estate"><meta property="article:tag" content="Roth"></head><a rel="nofollow tag" href="/t">IRA</a><a rel="tagline">no</a>'''
    linked = '''<script type="application/ld+json">{"author": {"@type": "Person", "name": "Ann Lee"}}</script>'''
    df = spark.createDataFrame([(page,), (linked,), (None,)], "h string")
    got = df.select(hx.author(F.col("h")).alias("a"), hx.post_tags(F.col("h")).alias("t")).collect()
    assert got[0].t == ["tax", "estate", "roth", "ira"] and got[0].a is None and got[1].a == "Ann Lee" and got[2].a is None


def test_sections_keep_control_characters(spark):
    df = spark.createDataFrame([(1, "intro \x01 text\n# One\nbody\x01\n## Two\n# One\nlast", "T")], "id int, body string, title string")
    got = [(r.heading, r.anchor, r.body) for r in sections.sections(df, ["id"], "body", "title").orderBy("ordinal").collect()]
    assert got == [("T", "t", "intro \x01 text"), ("One", "one", "# One\nbody\x01"), ("Two", "two", "## Two"), ("One", "one-2", "# One\nlast")]


def test_listed_posts(spark):
    listed = spark.createDataFrame([("f", "a.md"), ("f", "b.md")], "firm string, file string")
    assert rows(kb.listed_posts(listed, listed.where("file = 'a.md'"), "firm", "file")) == [("f", "a.md")]


META = "meta_id bigint, trajectory struct<aum_history:array<struct<as_of:string,value_usd:bigint,source:string>>,advisor_count_history:array<struct<as_of:string,value:bigint,source:string>>,employee_count_history:array<struct<as_of:string,value:bigint,source:string>>,branch_count_history:array<struct<as_of:string,value:bigint,source:string>>,notable_events:array<struct<date:string,event:string,source:string>>>, src string"
FACTS = "facts_id bigint, auto_filled struct<footer_emails:array<string>,footer_phones:array<string>,sec_iapd:struct<crd_number:string,dbas_and_affiliates:array<string>>>, pos string"


def test_target_tables(spark):
    """Every table has its parent, its place and all its fields; repeated rows count once."""
    m = spark.createDataFrame([(1, ([("2024", 5, None), None, (None, None, None), (None, 7, "x")], None, [], None, [("2020", "moved", "web")]), "z")] * 2 + [(2, None, "z")], META)
    f = spark.createDataFrame([(1, (["a@b", "", None], None, ("77", ["D"])), "z"), (2, (None, None, None), "z"), (3, None, "z")], FACTS)
    raw = spark.createDataFrame([(9, '{"data": {"trajectory": {"aumHistory": [{"asOf": "2023", "valueUsd": 3}]}}, "auto-filled": "{\\"secIapd\\": {\\"CRD-Number\\": \\"5\\"}}"}'), (10, "broken {"), (11, None), (12, "1, 2")], "record_id bigint, payload string")
    t = nested.target_tables(m, f, raw)
    assert rows(t["aum_history"][0]) == [("firm_metadata", 1, 1, "2024", "5", None), ("firm_metadata", 1, 4, None, "7", "x")]
    assert rows(t["aum_history"][1]) == [("raw_record", 9, 1, "2023", "3", None)] and rows(t["notable_events"][0]) == [("firm_metadata", 1, 1, "2020", "moved", "web")]
    assert rows(t["sec_iapd"][0]) == [("company_facts", 1, 1, "77")] and rows(t["sec_iapd"][1]) == [("raw_record", 9, 1, "5")]
    assert rows(nested.all_children(m, f, raw).where("child = 'aum_history'")) == [("firm_metadata", 1, "aum_history", 1, "2024"), ("firm_metadata", 1, "aum_history", 4, ""), ("raw_record", 9, "aum_history", 1, "2023")]
    assert nested.all_children(m.where("false"), f.where("false"), raw.where("false")).count() == 0
