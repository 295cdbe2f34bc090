import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.llm import mixture as m
from corpusmill.llm import queries
from tests.conftest import rows

DOCS = "doc_id bigint, text string, source string, copy int, shard string"


@settings(max_examples=50, deadline=None)
@given(st.dictionaries(st.sampled_from("abcdef"), st.integers(0, 200), min_size=1), st.integers(1, 40))
def test_tree_is_exact(counts, shards):
    leaves = m.splitting_tree(counts, shards)
    assert len(leaves) == shards
    assert {s: sum(x[s] for x in leaves) for s in counts} == counts
    sizes = [sum(x.values()) for x in leaves]
    assert max(sizes) - min(sizes) <= max(2, shards.bit_length())


def test_tree_is_fair():
    """Over many draws each shard's share of a source is that of all."""
    got = [x["a"] for seed in range(300) for x in m.splitting_tree({"a": 30, "b": 70}, 4, seed)[:1]]
    assert 6.8 < sum(got) / len(got) < 8.2


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.sampled_from("abcd"), st.integers(1, 10_000), min_size=1), st.lists(st.tuples(st.floats(0.05, 1), st.integers(1, 5)), min_size=4, max_size=4), st.one_of(st.none(), st.integers(1, 100_000)))
def test_quotas_keep_caps(available, targets, total):
    want = dict(zip("abcd", targets, strict=True))
    q = m.quotas(available, want, total)
    assert all(q[s] <= available[s] * want[s][1] for s in q)
    if total is None:
        whole = sum(want[s][0] for s in q)
        assert all(abs(q[s] - sum(q.values()) * want[s][0] / whole) <= len(q) + 1 for s in q)


def test_draws_repeat_at_most_as_needed():
    drawn = m.draw_blocks({"a": [(0, 10), (1, 20), (2, 5)]}, {"a": 90})
    assert sum(d[3] for d in drawn) == 90 and max(d[2] for d in drawn) == 3 and len(set(d[:3] for d in drawn)) == len(drawn)


def corpus(spark, n=3000):
    data = [(i, "word " * (5 + i % 7), ("Big Source" if i % 10 < 7 else "small-source" if i % 10 < 9 else "unwanted"), 1, "x") for i in range(n)]
    data += [(n, None, "Big Source", 1, "x"), (n + 1, "", "Big Source", 1, "x"), (n + 2, "x y", None, 1, "x")]
    return spark.createDataFrame(data, DOCS)


def targets(spark, data):
    return spark.createDataFrame(data, "source string, target_share double, max_repeats int")


needs_vocabulary = pytest.mark.skipif(not os.path.exists(m.vocabulary_path()), reason="no tokenizer here")


@needs_vocabulary
def test_shares(spark):
    want = targets(spark, [("big_source", 0.6, 1), ("SMALL SOURCE", 0.4, 3), ("absent", 0.0, 2), (None, 0.1, 1)])
    got = {r.source: r for r in m.shares(corpus(spark), want).collect()}
    assert got["big_source"].actual_share == pytest.approx(0.6, abs=0.005) and got["small_source"].most_repeats <= 3
    assert got["unwanted"].used_tokens == 0 and got["absent"].used_tokens == 0
    mixed = m.mixture(corpus(spark), want)
    assert mixed.count() == mixed.select("doc_id", "copy").distinct().count() == mixed.select("shard", "position").distinct().count()
    assert rows(mixed) == rows(m.mixture(corpus(spark), want))


@needs_vocabulary
def test_edges(spark):
    want = targets(spark, [("big_source", 1.0, 1)])
    assert m.mixture(corpus(spark).where("false"), want).count() == 0
    assert m.mixture(corpus(spark, 50), targets(spark, [("other", 1.0, 1)])).count() == 0
    assert m.mixture(corpus(spark, 50), targets(spark, [("big_source", None, None)])).count() == 0


@needs_vocabulary
def test_tokens():
    path = m.vocabulary_path()
    long = "word " * 60_000
    assert m.count_tokens(long, path) == pytest.approx(60_000, abs=3) and m.count_tokens("x" * 250_000, path) > 0


@needs_vocabulary
def test_query(spark, data):
    assert queries.p7_mixture(spark, data).columns == ["source", "doc_id", "copy", "shard", "position", "tokens"]
