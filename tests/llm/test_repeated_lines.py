import re
from collections import defaultdict

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.llm import queries
from corpusmill.llm.repeated_lines import MONTHS, repeated_lines, summarize, without_repeated_lines
from tests.conftest import rows

POSTS = "post_id bigint, firm string, url string, body_text string, src string, n int"


def posts(spark, data):
    return spark.createDataFrame([(*d, "x", 1) for d in data], POSTS)


def brute(data, min_urls=5, share=0.1):
    month = re.compile(rf"(?<![^\W\d_])(?:{MONTHS})(?![^\W\d_])")
    key = lambda x: "".join(c for c in month.sub("", x.lower()) if c.isalpha())
    urls, where, lines = defaultdict(set), defaultdict(set), []
    for p, f, u, b in data:
        if f is not None and u is not None:
            urls[f].add(u)
        if f is None or b is None:
            continue
        for n, x in enumerate(b.split("\n"), 1):
            if any(c.isalpha() for c in x):
                if u is not None:
                    where[f, key(x)].add(u)
                lines.append((p, n, f, key(x)))
    return sorted({(p, n) for p, n, f, k in lines if len(where[f, k]) >= min_urls and len(where[f, k]) >= share * len(urls[f])}, key=repr)


def test_definition(spark):
    data = [(i, "A", f"u{i}", f"Own text {chr(97 + i)}\n**Share** this: {i} May\n\nPosted {'March' if i % 2 else 'Oct'} {i}, 20{i}") for i in range(8)]
    data += [(100 + i, "B", f"v{i}", "Share this") for i in range(4)] + [(200, "A", "u0", "share THIS"), (201, None, "w", "Share this"), (202, "A", None, "share this"), (203, "A", "u9", None), (204, "A", "u9", "")]
    data.append(data[0])
    got = rows(repeated_lines(posts(spark, data)))
    assert got == brute(data) and (202, 1) in got and (200, 1) in got and not any(p >= 100 and p < 200 for p, _ in got)


def test_share_of_a_large_source(spark):
    data = [(i, "A", f"u{i}", f"line {'x' if i < 9 else 'y' if i < 19 else 'z' + chr(97 + i % 26) * (1 + i // 26)}") for i in range(100)]
    assert rows(repeated_lines(posts(spark, data))) == brute(data) == sorted([(i, 1) for i in range(9, 19)], key=repr)


def test_empty_and_long(spark):
    assert rows(repeated_lines(posts(spark, []))) == []
    data = [(i, "A", f"u{i}", "footer\n" + "\n".join(f"w{k}x{i}".translate(str.maketrans("0123456789", "abcdefghij")) for k in range(20_000))) for i in range(6)]
    assert rows(repeated_lines(posts(spark, data))) == sorted([(i, 1) for i in range(6)], key=repr)


def test_removal(spark):
    data = [(i, "A", f"u{i}", f"own {'abcdefgh'[i]}\nShare this\nend {'hgfedcba'[i]}") for i in range(6)] + [(9, None, "x", "Share this"), (10, "B", "y", None)]
    got = {r.post_id: r.clean_text for r in without_repeated_lines(posts(spark, data)).collect()}
    assert got[0] == "own a\nend h" and got[9] == "Share this" and got[10] is None and len(got) == 8


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.lists(st.integers(0, 30), max_size=8, unique=True)), max_size=40), st.integers(1, 20))
def test_summaries_bound_the_counts(docs, least):
    """A count is never above the truth, and never below it by more than the error that the summary admits."""
    batch = pa.RecordBatch.from_pydict({"src": pa.array([d[0] for d in docs], pa.int64()), "lines": pa.array([d[1] for d in docs], pa.list_(pa.int64()))})
    out = [r for b in summarize(iter([batch]), least, 10) for r in b.to_pylist()]
    error = {r["src"]: r["error"] for r in out if r["key"] is None}
    counted = {(r["src"], r["key"]): r["n"] for r in out if r["key"] is not None}
    truth = defaultdict(int)
    for s, ks in docs:
        for k in ks:
            truth[s, k] += 1
    for (s, k), n in truth.items():
        assert n - error[s] <= counted.get((s, k), 0) <= n


def test_query(spark, data):
    assert queries.p1_found(spark, data).columns == ["post_id", "line_no"]
