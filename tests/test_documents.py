import json

from pyspark.sql import functions as F

from corpusmill.operators import documents
from tests.conftest import rows


def test_snapshot_sentence(spark):
    df = spark.createDataFrame([(1200, None, None, None, None), (1, 2, 3_000, 4, "2024")], "employee_count bigint, advisor_count bigint, aum_usd bigint, branch_count bigint, aum_as_of string")
    assert [r[0] for r in df.select(documents.snapshot_sentence()).collect()] == ["1,200 employees; ? advisors; $0 under management", "1 employees; 2 advisors; $3,000 under management; 4 branches; as of 2024"]


def test_matrix_lines_are_in_order_and_escaped(spark):
    df = spark.createDataFrame([("s", "d", 2, "b|c"), ("s", "d", 1, "a"), ("s", "d", 11, "z")], "section string, dimension string, firm int, value string")
    assert rows(documents.matrix_markdown(df, F.floor(F.col("firm") / 10))) == [("s", "d", 0, "| s / d | a | b\\|c |"), ("s", "d", 1, "| s / d | z |")]


def test_index_document_keeps_all_entries(spark):
    data = [("f", "blog", f"t{i}", f"u{i}") for i in range(50)] + [(None, "home", "t", "u"), ("f", "home", "t", "u"), ("f", "home", "t", "u")]
    got = documents.index_document(spark.createDataFrame(data, "firm string, kind string, title string, url string"), entries=10).collect()
    assert sum(len(json.loads(r.document)) for r in got) == len(data) and len([r for r in got if r.kind == "blog"]) > 2


def test_facts_again(spark):
    schema = "competitor string, auto_filled struct<footer_emails:array<string>,sec_iapd:struct<crd_number:string>>, manual struct<founded:string>"
    old = spark.createDataFrame([("a", (["x"], ("1",)), ("1990",)), ("b", None, None)], schema)
    new = spark.createDataFrame([("a", (["y"], None), None), ("b", (["z"], ("2",)), ("n",)), ("c", None, ("m",))], schema)
    got = {r.competitor: r for r in documents.facts_again(old, new).collect()}
    assert got["a"].auto_filled.footer_emails == ["y"] and got["a"].auto_filled.sec_iapd.crd_number == "1" and got["a"].manual.founded == "1990"
    assert got["b"].auto_filled.sec_iapd.crd_number == "2" and got["b"].manual.founded == "n" and got["c"].auto_filled is None


def test_unwrap(spark):
    df = spark.createDataFrame([("q", '{"hits": {"hits": [{"_source": {"firm_name": "A"}}, {"_source": {"firm_name": "B"}}]}}'), ("r", "broken"), ("s", None)], "query string, response string")
    assert rows(documents.responses_unwrapped(df, "response", "struct<firm_name:string>")) == [("q", "A"), ("q", "B")]


def test_empty(spark):
    meta = spark.createDataFrame([], "slug string")
    posts = spark.createDataFrame([], "firm string, url string")
    assert rows(documents.statistics(meta, posts)) == [(0, 0, 0, 0)]
