import itertools
import json

import pytest

from corpusmill.llm import entities as e
from corpusmill.llm import queries
from tests.conftest import rows


def test_marginals_on_a_tree_are_exact(spark):
    """On a forest belief propagation is exact: against the sum over all matchings."""
    edges = [("a1", "b1", 2.0), ("a1", "b2", 0.5), ("a2", "b2", 3.0), ("a3", "b3", 1.0)]
    weight, mass = 0.0, dict.fromkeys([x[:2] for x in edges], 0.0)
    for k in range(len(edges) + 1):
        for c in itertools.combinations(edges, k):
            if len({x[0] for x in c}) == k == len({x[1] for x in c}):
                w = 1.0
                for x in c:
                    w *= x[2]
                weight += w
                for x in c:
                    mass[x[:2]] += w
    got = {(r.a, r.b): r.probability for r in e.marginals(spark.createDataFrame(edges, "a string, b string, odds double")).collect()}
    assert got == {k: pytest.approx(v / weight, abs=0.01) for k, v in mass.items()}


def test_ties_share(spark):
    got = e.marginals(spark.createDataFrame([("a", "b1", 1000.0), ("a", "b2", 1000.0)], "a string, b string, odds double")).collect()
    assert all(0.45 < r.probability < 0.5 for r in got)
    assert e.marginals(spark.createDataFrame([], "a string, b string, odds double")).count() == 0


@pytest.mark.parametrize(
    "a, b, level",
    [("Nathby & Norbury Group", "NAHTBY NOORBURY GROUP, L.L.C.", 2), ("Arkholt Yeldina", "ARKHOLTYELDINA CAPITAL LTD", 4), ("Mordby Ferrlow", "FERRLOW MORDBY, PLLC", 3), ("Arkholt Yeldina", "Arkholt Sibwell", 1), ("Wealth Partners", "Capital Group", 0), ("", "x", 0)],
)
def test_names(spark, a, b, level):
    assert e.name_level(e.own_words(a), e.own_words(b)) == level
    if level >= 2:
        assert e.keys(e.own_words(a), spark) & e.keys(e.own_words(b), spark)


def test_places():
    assert e.place_level((e.city_key("N. Dunmere"), e.state_key("Ohio")), (e.city_key("NORTH DUNMERE"), e.state_key("OH"))) == (2, 2)
    assert e.place_level(("", "oh"), ("millrace", "ny")) == (1, 0)
    assert e.address_words("HTTPS://WWW.Arkholt-Yeldina.example/x") == ["arkholt", "yeldina"] and e.address_words(None) == []


META = "slug string, competitor string, website string, headquarters_city string, headquarters_state string, crd_number string, firm_name string"
HITS = "firm_source_id string, firm_name string, firm_other_names array<string>, firm_ia_address_details string, slug string"


def tables(spark, firms, hits):
    return spark.createDataFrame([(*f, "x") for f in firms], META), spark.createDataFrame([(*h, "x") for h in hits], HITS)


def place(city, state):
    return json.dumps({"officeAddress": {"city": city, "state": state}})


def test_matches(spark):
    firms = [("A", "Arkholt & Yeldina", None, "Oxbow", "PA", None), ("A", "Arkholt & Yeldina", None, None, "PA", None), ("B", "Brockgate Lundmere", "https://zornsett-hurnham.example", "Millrace", "NY", None), ("C", "Corvrell Thalby", None, "Oxbow", "PA", "7"), ("D", None, None, None, None, None), (None, "Arkholt Yeldina", None, None, None, None)]
    hits = [("1", "ARKHOLTYELDINA LLC", None, place("OXBOW", "PA")), ("1", "ARKHOLTYELDINA LLC", None, place("OXBOW", "PA")), ("2", "ARKHOLT YELDINA LLC", [], place("SABLE CREEK", "TX")), ("3", "ZORNSETT HURNHAM INC", None, place("MILRACE", "NY")), ("7", "CORVRELL THALBY", None, "broken {"), ("9", None, [None], None)]
    m, h = tables(spark, firms, hits)
    assert rows(e.matches(m, h).select("slug", "firm_source_id")) == [("A", "1"), ("B", "3")]


def test_hot_name_is_split_by_place(spark):
    """A name that hundreds of records share: pairs are made by place only, and the matches are right."""
    n = 600
    firms = [(f"F{i}", "Arkholt Yeldina", None, f"{'abcdefghij'[i % 10] * 4}{'klmnopqrst'[i // 10 % 10] * 4}{'uvwxyz'[i // 100] * 4}", "PA", None) for i in range(n)]
    hits = [(str(i), "ARKHOLT YELDINA LLC", None, place(firms[i][3].upper(), "PA")) for i in range(n)]
    m, h = tables(spark, firms, hits)
    names_a = m.select(e.F.col("slug").alias("id"), e.F.lit("name").alias("kind"), e.F.col("competitor").alias("name"))
    names_b = h.select(e.F.col("firm_source_id").alias("id"), e.F.lit("name").alias("kind"), e.F.col("firm_name").alias("name"))
    places_a = m.select(e.F.col("slug").alias("id"), e.F.col("headquarters_city").alias("city"), e.F.col("headquarters_state").alias("state"))
    places_b = h.select(e.F.col("firm_source_id").alias("id"), e.F.get_json_object("firm_ia_address_details", "$.officeAddress.city").alias("city"), e.F.lit("PA").alias("state"))
    assert e.candidate_pairs(names_a, names_b, places_a, places_b, hot_pairs=10_000).count() == n
    assert rows(e.matches(m, h).select("slug", "firm_source_id")) == sorted([(f"F{i}", str(i)) for i in range(n)], key=repr)


def test_common_names_at_other_places_meet(spark):
    """A name that 501 records of either side carry, all at other places: as many pairs as the product. 250,000 was the most before they were dropped."""
    n = 501
    names = [spark.createDataFrame([(f"{side}{i}", "name", "Arkholt Yeldina") for i in range(n)], "id string, kind string, name string") for side in "ab"]
    places = [spark.createDataFrame([(f"{side}{i}", city, "PA") for i in range(n)], "id string, city string, state string") for side, city in (("a", "Oxbow"), ("b", "Millrace"))]
    got = e.candidate_pairs(*names, *places)
    assert rows(got.groupBy("name", "city", "state").count()) == [(4, 0, 2, n * n)]


def test_pairs_are_the_same_for_any_hot_pairs(spark):
    """Records of a common name at own, other and unknown places: the pairs don't depend on how many are thought too many."""
    cities = ["Oxbow", "Oxbwo", "Millrace", None, "Sable Creek"]
    names = [spark.createDataFrame([(f"{side}{i}", "name", ("Arkholt Yeldina", "Yeldina Arkholt")[i % 2]) for i in range(n)], "id string, kind string, name string") for side, n in (("a", 11), ("b", 13))]
    places = [spark.createDataFrame([(f"{side}{i}", ("Thornbury" if i == 8 and side == "a" else cities[i % (4 if side == "a" else 5)]), "PA") for i in range(n)], "id string, city string, state string") for side, n in (("a", 11), ("b", 13))]
    whole = rows(e.candidate_pairs(*names, *places))
    assert {r[5] for r in whole} == {0, 1, 2} and len(whole) == len({r[:2] for r in whole})
    assert all(rows(e.candidate_pairs(*names, *places, hot_pairs=k)) == whole for k in (0, 9))


def test_hot_keys_keep_unknown_and_misspelt_places(spark):
    names_a = [("A", "name", "Smith Johnson"), ("B", "name", "Mordby Ferrlow"), ("C", "name", "Arkholt Yeldina")]
    names_b = [("1", "name", "JOHNSON SMITH LLC"), ("2", "name", "FERRLOW MORDBY"), ("3", "name", "YELDINA ARKHOLT"), ("4", "name", "Mordby Ferrlow Trust")]
    places_a = [("A", None, None), ("B", "Millrace", "OH"), ("C", "Oxbow", "PA")]
    places_b = [("1", "Oxbow", "PA"), ("2", "Millrcae", "OH"), ("3", "Oxbow", "PA"), ("4", None, "OH")]
    frames = [spark.createDataFrame(x, "id string, kind string, name string") for x in (names_a, names_b)] + [spark.createDataFrame(x, "id string, city string, state string") for x in (places_a, places_b)]
    split = rows(e.candidate_pairs(*frames, hot_pairs=0))
    assert split == rows(e.candidate_pairs(*frames)) and {x[:2] for x in split} == {("A", "1"), ("B", "2"), ("B", "4"), ("C", "3")}


def test_short_and_long_names_meet(spark):
    assert e.keys(["bny"], spark) == e.keys(["bny"], spark) != set()
    a, b = "oak ridge blue harbor lantern summit".split(), "summit lantern harbor blue ridge oak".split()
    assert e.name_level(a, b) == 3 and e.keys(a, spark) & e.keys(b, spark)


def test_refined_keys_lose_no_pair(spark):
    """One word that most names share makes a hot key; the pairs are the same with and without its refinement."""
    others = ["Ferrlow", "Ferlow", "Yeldina", "Yledina", "Sibwell", "Sibwel", "Thalby", "Hurnham", "Hurnhma", "Lundmere"]
    frames = [e._named(spark.createDataFrame([(f"{side}{i}", "name", f"Smith {w}" if i % 3 else f"{w} Smith") for i, w in enumerate(others[k:] + others[:k])], "id string, kind string, name string")) for k, side in ((0, "a"), (3, "b"))]
    whole = rows(e.name_pairs(*frames))
    assert len(whole) > len(others) and rows(e.name_pairs(*frames, hot_pairs=3)) == whole == rows(e.name_pairs(*frames, hot_pairs=0))


def test_empty(spark):
    m, h = tables(spark, [], [])
    assert e.matches(m, h).count() == 0


def test_labelled_firms_are_found(spark, data):
    """Held against firms whose registry number is known."""
    at = data.replace("sf0.001", "sf0.01")
    m, h = spark.read.parquet(f"{at}/firm_metadata.parquet"), spark.read.parquet(f"{at}/iapd_hit.parquet")
    known = {tuple(r) for r in m.where("crd_number is not null").join(h.select("firm_source_id").distinct(), m.crd_number == h.firm_source_id).select("slug", "crd_number").distinct().collect()}
    labelled = {r[0] for r in m.where("crd_number is not null").select("slug").collect()}
    got = {(r.slug, r.firm_source_id) for r in e.match_firms(m, h, known_too=True).where("probability >= 0.5").collect() if r.slug in labelled}
    assert len(got & known) >= 0.9 * len(known) and len(got & known) >= 0.95 * len(got)


def test_query(spark, data):
    assert queries.p2_found(spark, data).columns == ["slug", "firm_source_id"]
