import datetime
import json

import pytest
from pyspark.sql import functions as F

from corpusmill import catalog_queries
from corpusmill.operators import catalog, crawl, facets, nested, pages, quality, registry, search, sections
from corpusmill.streaming import ingest
from tests.conftest import rows

META = "meta_id bigint, trajectory struct<aum_history:array<struct<as_of:string,value_usd:bigint,source:string>>,advisor_count_history:array<struct<as_of:string,value:bigint,source:string>>,employee_count_history:array<struct<as_of:string,value:bigint,source:string>>,branch_count_history:array<struct<as_of:string,value:bigint,source:string>>,notable_events:array<struct<date:string,event:string,source:string>>>, pos int"
FACTS = "facts_id bigint, auto_filled struct<footer_emails:array<string>,footer_phones:array<string>,sec_iapd:struct<crd_number:string,dbas_and_affiliates:array<string>>>, item string"


def nested_rows(spark, metas=(), facts=(), raws=()):
    m = spark.createDataFrame(list(metas), META)
    f = spark.createDataFrame(list(facts), FACTS)
    r = spark.createDataFrame(list(raws), "record_id bigint, record_kind string, payload string, child string")
    return rows(nested.all_children(m, f, r))


def test_nested_tables(spark):
    history = [("2020", 1, "a"), None, (None, None, None), (None, 5, None), ("", None, "")]
    metas = [(1, (history, None, [], None, [("2021", None, None)]), 9), (2, None, 9), (1, (history, None, [], None, [("2021", None, None)]), 9)]
    facts = [(7, (["a@b", "", None, "c@d"], None, ("12", ["D"])), "x"), (8, (None, None, None), "x"), (9, None, "x")]
    assert nested_rows(spark, metas, facts) == sorted(
        [("firm_metadata", 1, "aum_history", 1, "2020"), ("firm_metadata", 1, "aum_history", 4, ""), ("firm_metadata", 1, "notable_events", 1, "2021"), ("company_facts", 7, "footer_emails", 1, "a@b"), ("company_facts", 7, "footer_emails", 4, "c@d"), ("company_facts", 7, "sec_iapd", 1, "12"), ("company_facts", 7, "dbas_and_affiliates", 1, "D")],
        key=repr,
    )


def test_nested_payloads(spark):
    inner = {"trajectory": {"aumHistory": {"asOf": "2020", "valueUsd": 3}, "notable_events": [{"date": None, "event": "e"}, None]}}
    facts = {"auto_filled": {"footer-emails": "x@y", "secIapd": {"CRD_NUMBER": 55, "dbas_and_affiliates": []}}}
    raws = [(1, "metadata", json.dumps(inner), ""), (2, "metadata", json.dumps([inner]), ""), (3, "metadata", json.dumps({"data": inner}), ""), (4, "x", json.dumps(inner)[:-1], ""), (5, "x", "", ""), (6, "x", None, ""), (7, "company_facts", json.dumps(facts), ""), (8, "x", json.dumps(inner) + " x", ""), (9, "metadata", json.dumps({"trajectory": json.dumps(inner["trajectory"])}), ""), (10, "x", "3", "")]
    got = nested_rows(spark, raws=raws)
    expected = [("raw_record", i, "aum_history", 1, "2020") for i in (1, 2, 3, 9)] + [("raw_record", i, "notable_events", 1, "") for i in (1, 2, 3, 9)] + [("raw_record", 7, "footer_emails", 1, "x@y"), ("raw_record", 7, "sec_iapd", 1, "55")]
    assert got == sorted(expected, key=repr)


def test_nested_empty(spark):
    assert nested_rows(spark) == []


def test_nested_long(spark):
    metas = [(1, ([("2020", i, None) for i in range(20_000)], None, None, None, None), 0)]
    assert len(nested_rows(spark, metas)) == 20_000


def test_sections(spark):
    body = "intro\n# One #\ntext\n### deep\nx\n## One\n\n## Two\r\nend\n# \n"
    df = spark.createDataFrame([(1, body, "Fallback", 5), (2, None, "t", 5), (3, "", None, 5), (4, "# X\n# X\n# X 2", "t", 5)], "id int, b string, t string, ordinal int").drop("ordinal")
    got = [(r.id, r.level, r.heading, r.anchor) for r in sections.sections(df, ["id"], "b", "t").orderBy("id", "ordinal").collect()]
    assert got == [(1, 1, "Fallback", "fallback"), (1, 1, "One", "one"), (1, 2, "One", "one-2"), (1, 2, "Two", "two"), (1, 1, "", "section"), (4, 1, "X", "x"), (4, 1, "X", "x-2"), (4, 1, "X 2", "x-2")]
    strict = [r.anchor for r in sections.sections(df.where("id = 4"), ["id"], "b", "t", strict=True).collect()]
    assert len(set(strict)) == 3


def test_search(spark):
    docs = spark.createDataFrame([(1, "Roth conversion basics"), (2, "conversion of trusts"), (3, None), (4, "")], "id int, text string")
    index = search.build(docs, "id", ["text"])
    assert [r.id for r in search.ranked(index, "roth conversion", 5).collect()] == [1, 2]
    assert [r.id for r in search.ranked(index, "conv", 5).collect()] == [1, 2]
    assert [r.id for r in search.ranked(index, "konversion", 5).collect()] == [1, 2]
    assert search.ranked(index, "", 5).count() == 0
    assert search.build(docs.where("false"), "id", ["text"]).postings.count() == 0


@pytest.mark.parametrize("k, expected", [(None, 8), ("", 8), ("0", 8), ("-3", 1), ("99", 25), ("12abc", 12), (5, 5)])
def test_clamp(k, expected):
    assert search.clamp_k(k) == expected


def test_score_grows_with_frequency(spark):
    docs = spark.createDataFrame([(i, "tax " * i + "word " * (10 - i)) for i in range(1, 10)], "id int, text string")
    scores = [r.score for r in search.ranked(search.build(docs, "id", ["text"]), "tax", 9, fuzzy=0).orderBy("id").collect()]
    assert scores == sorted(scores)


def test_index_round_trip(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (2, "b c")], "id int, text string")
    index = search.build(docs, "id", ["text"])
    search.save(index, str(tmp_path))
    assert rows(search.ranked(search.load(spark, str(tmp_path)), "b", 5)) == rows(search.ranked(index, "b", 5))


def test_tags_tie_by_first_appearance(spark):
    df = spark.createDataFrame([(1, ["b", "a"]), (2, ["a", "b", None]), (3, None), (4, [])], "id int, tags array<string>")
    assert [(r.tag, r.label) for r in catalog.top_tags(df, "tags", "id").orderBy("place").collect()] == [("b", "2/4"), ("a", "2/4")]


def test_tally_counts_only_named_values(spark):
    df = spark.createDataFrame([("strong",), ("odd",), (None,)], "s string")
    assert rows(catalog.tally(df, ["s"], ["strong", "ok"])) == [("s", 1, 0, 3)]


def test_upsert_and_diff(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", 2)], "k int, x string, y int")
    new = spark.createDataFrame([(1, None, 9), (3, "c", 3)], "k int, x string, y int")
    assert rows(catalog.upsert(old, new, "k", ["x", "y"])) == [(1, "a", 9), (2, "b", 2)]
    assert rows(catalog.changed_fields(old, new, "k", ["y"])) == [(1, "y", None, "9"), (2, "y", "2", None), (3, "y", None, "3")]


def test_csv_line(spark):
    df = spark.createDataFrame([("a,b", None, True, ["x", "y"])], "competitor string, slug string, sec_registered boolean, tags array<string>")
    assert df.select(catalog.csv_line(df, ["competitor", "slug", "sec_registered", "tags"])).first()[0] == '"a,b",,true,"x, y"'


def test_catalog_order(spark):
    df = spark.createDataFrame([("b", "low"), ("A", "low"), ("c", "high"), ("d", None), ("e", "odd")], "competitor string, threat_level string")
    assert [r[0] for r in catalog.in_catalog_order(df).collect()] == ["c", "A", "b", "d", "e"]


def test_picks(spark):
    df = spark.createDataFrame([("s", "https://a.com/x/pricing", "Pricing", 0), ("s", "https://a.com/fees", "Fees", 1), ("s", "https://a.com/z", "About us", 0), ("s", None, "Blog", 0)], "site string, url string, text string, source_rank int")
    assert rows(crawl.pick_pages(df)) == [("s", 1, "about", "https://a.com/z"), ("s", 2, "pricing", "https://a.com/fees")]
    assert rows(crawl.greedy_text_picks(df)) == [("s", "about", "https://a.com/z"), ("s", "pricing", "https://a.com/x/pricing")]


def test_post_discovery(spark):
    base = "https://a.com/blog"
    links = ["https://a.com/blog/2024/01/05/x?q=1", "https://a.com/blog/2024/01/05/x", "https://a.com/blog/page/2", "https://a.com/a.pdf", "https://b.com/blog/x/y", "https://a.com/about", "https://a.com/blog/b/c", base + "/"]
    df = spark.createDataFrame([("s", base, x) for x in links], "site string, blog_url string, url string")
    found = crawl.newest_first(crawl.post_candidates(df), 30).orderBy("place")
    assert [(r.url, r.date) for r in found.collect()] == [("https://a.com/blog/2024/01/05/x", "2024-01-05"), ("https://a.com/blog/b/c", None)]


def test_sitemap(spark):
    xml = "<urlset><loc>https://a.com/about-us</loc><loc>https://a.com/a/b/c</loc><loc>https://b.com/x</loc></urlset>"
    df = spark.createDataFrame([("s", "https://a.com", xml)], "site string, base string, xml string")
    assert [(r.url, r.text) for r in crawl.sitemap_links(df).collect()] == [("https://a.com/about-us", "about us")]


def test_registry(spark):
    hits = spark.createDataFrame([("1", "MARLENE & ASSOCIATES, INC.", None), ("2", "OTHER LLC", ["MARL GROUP"])], "firm_source_id string, firm_name string, firm_other_names array<string>")
    q = spark.createDataFrame([("Marlen",), ("Marl Group",), ("Nobody",)], "query string")
    assert [(r.query, r.firm_source_id) for r in registry.best_hits(q, hits).orderBy("query").collect()] == [("Marl Group", "2"), ("Marlen", "1")]
    assert [r.query for r in registry.best_hits(q, hits, strict=True).collect()] == ["Marl Group"]


FILING = "Approximately how many employees do you have? Include full- and part-time but do not include any clerical workers. 1,204 perform investment advisory functions (including research)? 37 registered with one or more state securities authorities as investment adviser representatives? 5 Discretionary: (a) $ 1,250,000,000 (d) 900 Non-Discretionary: (b) $ 0 (e) 0 Total: (c) $ 1,250,000,000 (f) 912 DRP - Regulatory Disclosure signed 03/14/2023 amended 11/02/2024"


def test_registry_finds_words_inside_words(spark):
    hits = spark.createDataFrame([("2", "CITISHARES GROUP", None), ("1", "CITISHARES GROUP", None), ("3", "SHARE CO", [None])], "firm_source_id string, firm_name string, firm_other_names array<string>")
    q = spark.createDataFrame([("shares",), ("tish group",), ("llc",), ("",), (None,)], "query string")
    assert rows(registry.best_hits(q, hits).select("query", "firm_source_id")) == [("shares", "1"), ("tish group", "1")]


def test_skip_reasons(spark):
    df = spark.createDataFrame([(None, True, True, "u"), (True, None, True, "u"), (True, True, None, "u"), (True, True, True, ""), (True, True, True, "u")], "f boolean, m boolean, x boolean, u string")
    assert [r[0] for r in df.select(registry.skip_reason(F.col("f"), F.col("m"), F.col("x"), F.col("u"))).collect()] == ["no facts", "no metadata", "not matched", "no address", None]


def test_filing(spark):
    df = spark.createDataFrame([(FILING,), ("",), (None,)], "t string").select(*registry.filing_fields(F.col("t")))
    first, empty, null = df.collect()
    assert (first.employee_count, first.advisor_count, first.iar_state_count, first.aum_total_usd, first.account_count_total, first.filing_date) == (1204, 37, 5, 1_250_000_000, 912, "2024-11-02")
    assert empty.employee_count is None and empty.has_filed_drps is False and null.filing_date is None


def test_contacts(spark):
    df = spark.createDataFrame([(1, "f", "u1", [("t", "a", "mailto:a@b.co")], "call (555) 212-0000 or a@b.co"), (2, "f", "u2", None, None)], "page_id int, firm string, url string, ctas array<struct<text:string,tag:string,href:string>>, body_text string")
    assert rows(pages.contacts(df)) == [("f", "email", 1, "a@b.co"), ("f", "phone", 1, "(555) 212-0000")]


def test_facets(spark):
    df = spark.createDataFrame([("A%b", "ria", True), ("x", None, None)], "name string, type string, has boolean")
    f = lambda **p: rows(facets.filtered(df, p, {"type": "type"}, {"has": "has"}, {"q": ["name"]}).select("name"))
    assert f(type=" RIA ") == [("A%b",)] and f(has="no") == [("x",)] and f(q="%") == [("A%b",)] and len(f(type="")) == 2


def test_quality(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k int, t string")
    b = spark.createDataFrame([(1, "x"), (2, "n"), (4, "w")], "k int, t string")
    assert rows(quality.drifted(a, b, "k", "t")) == [(2, "differs"), (3, "missing"), (4, "extra")]
    p = spark.createDataFrame([(1, ["r", "g", "g", "b", "r", None])], "k int, c array<string>")
    assert rows(quality.palette(p, "k", "c")) == [(1, ["r", "g", "b"], "g", "b")]


def test_append_is_idempotent(spark):
    at = datetime.datetime(2024, 1, 1)
    new = spark.createDataFrame([("u", 2, at), ("u", 1, at), ("v", 3, at)], "url string, post_id int, captured timestamp")
    once = ingest.append_new(new.where("false"), new)
    assert rows(once.select("url", "post_id")) == [("u", 1), ("v", 3)]
    assert rows(ingest.append_new(once, new)) == rows(once)


def test_streams(spark, tmp_path):
    at = datetime.datetime(2024, 1, 1)
    new = spark.createDataFrame([("u", 1, at), ("u", 2, at), ("v", 3, at)], "url string, post_id int, captured timestamp")
    new.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = ingest.capture_stream(spark, str(tmp_path / "in"), new.schema)
    ingest.write_stream(stream, str(tmp_path / "out"), str(tmp_path / "c1")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    for k in (1, 2):
        raw = spark.readStream.schema(new.schema).parquet(str(tmp_path / "in"))
        ingest.merge_stream(raw, str(tmp_path / "merged"), str(tmp_path / f"m{k}")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "merged")).count() == 2
