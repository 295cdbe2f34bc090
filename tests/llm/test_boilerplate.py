from corpusmill.llm import boilerplate as b
from corpusmill.llm import queries
from tests.conftest import rows

PAGES = "page_id bigint, firm string, url string, headings array<struct<level:string,text:string>>, body_text string, host string"


def pages(spark, data):
    return spark.createDataFrame([(*d, "x") for d in data], PAGES)


def site(n, hosts):
    """Pages of several hosts with menu, notice, box and footer around content of their own."""
    out, truth, k = [], set(), 0
    letters = "abcdefghijklmnopqrstuvwxyz"
    for h in range(hosts):
        for p in range(n):
            k += 1
            mark = letters[k % 26] + letters[k // 26 % 26]
            own = [f"A heading on {mark} things", f"The {mark} household asked how {mark} plans change over the years, and got an answer.", f"Review the {mark} letter with a planner"]
            lines = ["Skip to content", "Home", "About", "Fees", *own, "Popular posts", f"Notes on {mark} for 20{p:02d}", f"Reading the {mark} file twice", "", "12 Mill Road, Oxbow, PA 12345", f"© 2024 Firm{letters[h]}{letters[h]}. All rights reserved."]
            out.append((k, f"Firm{letters[h]}{letters[h]}_X", f"https://h{h}.example/p{p}", [("H1", own[0])], "\n".join(lines)))
            truth |= {(k, 5), (k, 6), (k, 7)}
    return out, truth


def test_content_is_told_from_furniture(spark):
    data, truth = site(6, 12)
    got = set(rows(b.main_content(pages(spark, data))))
    assert len(got & truth) >= 0.95 * len(truth) and len(got & truth) >= 0.85 * len(got)


def test_joined_verdicts_are_the_same(spark):
    """With more shared wordings than may be broadcast, the result doesn't change."""
    data, _ = site(5, 8)
    assert rows(b.main_content(pages(spark, data), most=0)) == rows(b.main_content(pages(spark, data)))


def test_forms_and_box_words_beyond_the_tables_count(spark, monkeypatch):
    """With more forms and features of box lines than may be broadcast, none is left out."""
    data, _ = site(6, 12)
    data += [(900 + i, "Lone", f"https://lone{i}.example/", None, f"{a}\nWe met {a} people and told them what the plan is about.") for i, a in enumerate(("Elm", "Ash"))]  # a lone label of the form of all menus
    whole = rows(b.main_content(pages(spark, data)))
    for k in (0, 3):
        monkeypatch.setattr(b, "TABLE_ROWS", k)
        assert rows(b.main_content(pages(spark, data))) == whole


def test_headers_are_learned_from_all_pages(spark):
    data, _ = site(6, 12)
    with_known, tables = b.wordings(b.with_wholes(b.supported(b.streams(pages(spark, data)))))
    b.learn_boxes(b.marked_pages(with_known, tables), tables)
    assert "popular posts" in tables.header


def ordered_site(host, first, shuffled):
    """Four pages with the same four short lines on each, in one order or in another on each page."""
    from itertools import permutations

    lines = ["Alpha words: one", "Beta, words", "Gamma (words)", "Delta & words!"]  # of different forms
    orders = [(0, 1, 2, 3), (3, 2, 1, 0), (1, 0, 3, 2), (2, 3, 0, 1)] if shuffled else [(0, 1, 2, 3)] * 4
    assert set(orders) <= set(permutations(range(4)))
    return [(first + i, "X", f"https://{host}.example/{i}", None, "\n".join([*(lines[k] for k in o), f"Text {'abcd'[i]}{host} says something of its own here."])) for i, o in enumerate(orders)]


def test_order_decides(spark):
    """Two hosts with the same lines on as many pages: fixed tokens where they come in one order, content where they don't align."""
    got = rows(b.main_content(pages(spark, [*ordered_site("one", 1, False), *ordered_site("two", 11, True)])))
    one, two = ([n for p, n in got if lo <= p < lo + 10] for lo in (1, 11))
    assert set(one) == {5} and len(two) > 4


def test_rows_come_from_the_expression(spark, monkeypatch):
    data = ordered_site("one", 1, False)
    before = rows(b.main_content(pages(spark, data)))
    monkeypatch.setattr(b, "in_common", lambda place, tokens: {})  # nothing aligns
    supports = [s for r in b._supports([(1, 0, d[0], d[0], d[4].lower(), "") for d in data]) for s in r[5]]
    assert before == [(i, 5) for i in (1, 2, 3, 4)] and max(supports) == 1


def test_chunks_of_a_host_are_judged_together(spark):
    """A notice on every page is a fixed token however the host is split; one on a twentieth of them in one chunk only isn't."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    data = [(i, "Hot", f"https://hot.example/{i}", None, f"Menu\nOpening hours as usual\nPage {letters[i % 26]}{letters[i // 26]} tells a story of its own.") for i in range(130)]
    got = set(rows(b.main_content(pages(spark, data))))
    assert got == {(i, 3) for i in range(130)}
    wholes = b.host_wrappers(b.supported(b.streams(pages(spark, data)))).collect()
    assert len(wholes) > 1 and all(r.all_urls == 130 and r.whole["menu"] == 130 for r in wholes)


def test_special_rows(spark):
    data, _ = site(4, 6)
    extra = [(900, None, None, None, None), (901, None, None, None, ""), (902, "Firmaa_X", "https://h0.example/e", None, "Skip to content\nHome\nAbout\nFees\nAccess denied\nYou do not have permission to view this resource."), (903, None, None, None, "  \n \n")]
    got = rows(b.main_content(pages(spark, [*data, *extra, data[0]])))
    assert not any(p >= 900 for p, _ in got) and len(got) == len(set(got))


def test_empty(spark):
    assert b.main_content(pages(spark, [])).count() == 0


def test_large_host_is_split(spark):
    data = [(i, "Hot", f"https://hot.example/{i}", None, f"Menu\nText of page {'abcdefghij'[i % 10]}{'abcdefghij'[i // 10 % 10]} only.") for i in range(300)]
    chunks = b.streams(pages(spark, data)).groupBy("chunk").count().collect()
    assert len(chunks) > 4 and max(c["count"] for c in chunks) < 120


def test_wrapper():
    w = b.infer_wrapper([["menu", "home", "one", "foot"], ["menu", "home", "two", "three", "foot"], ["menu", "notice", "home", "four", "foot"]])
    assert w.expression() == "menu #text home (#text)+ foot"
    assert b.infer_wrapper([]).expression() == "" and b.infer_wrapper([["a"], ["a"]]).expression() == "a"


def test_support_is_of_aligned_streams():
    w = b.infer_wrapper([["a", "b", "a"], ["b", "c"], ["a", "c"]])
    best = {t: max(n for x, n in zip(w.text, w.support, strict=True) if x == t) for t in "abc"}
    assert best == {"a": 2, "b": 2, "c": 2}
    swapped = b.infer_wrapper([["a", "b"], ["b", "a"]])
    assert sorted(zip(swapped.text, swapped.support, strict=True)) in ([("a", 1), ("a", 1), ("b", 2)], [("a", 2), ("b", 1), ("b", 1)])


def test_text(spark):
    data, _ = site(4, 6)
    got = {r.page_id: r.main_text for r in b.main_text(pages(spark, data)).collect()}
    assert "household asked" in got[1] and "Skip to content" not in got[1]


def test_query(spark, data):
    assert queries.p3_found(spark, data).columns == ["page_id", "line_no"]


def test_the_last_step_reads_only_the_lines_it_needs():
    """Lines that can neither open a box nor stand in one don't travel, and the result is that of all lines."""
    lines = ["menu", "popular posts", "", "notes on a", "see the file… read more", "it ended.", "more of a", "a title", "foot"]
    marks = ["F", "F", "", "C", "C", "C", "C", "H", "F"]
    known = {"popular posts": (1.0, 9.0, 0.0, 3.0), "foot": (1.0, 9.0, 0.0, 3.0)}
    text, letters = b.settled_marks(lines, marks, known)
    assert letters == "FF-CTPCHF"
    assert text.split("\n") == ["", "popular posts", "", "notes on a", "", "", "", "", "foot"]
    tables = b.Tables({}, {}, {"popular posts": 0.9}, {f: 1.0 for f in b.features("notes on a")})
    assert b.main_lines(tables, text.split("\n"), letters, tables.header) == [6, 7, 8]
    assert b.main_lines(tables, lines, letters, tables.header) == [6, 7, 8]


def test_canonical_wording():
    import pyarrow as pa

    texts = ["‘Acme’ & Smith — Fees\t1,250.00 \n ask a.b@c.de or x@y", "Home  About us  Fees  Contact\nBlog / Tax\na / b / c", "Plain text of its own", " İ\xa0“q”\r"]
    got = b.canonical(pa.array(texts), ["Acme_Smith", None, "Plain", ""]).to_pylist()
    assert got == ["'§' & § - fees 0\nask @ or @", "home | about us | fees | contact\nblog / *\na / b / c", "§ text of its own", "i \"q\""]
