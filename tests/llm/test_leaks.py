import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.llm import leaks, queries
from tests.conftest import rows

WORDS = [a + b for a in ("bar", "cal", "dor", "fen", "gri", "hol", "jun", "kel", "lom", "mar") for b in ("ak", "est", "ine", "ow", "und", "yr", "ost", "ick", "ell", "arn", "ev", "im")]
QUESTION = "Which of the following is the most suitable next step?"


def item(seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(60)) + ". " + QUESTION


def scan(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x", 0) for i, t in enumerate(docs)], "doc_id bigint, text string, item_id string, words int")
    q = spark.createDataFrame(list(items), "item_id bigint, text string")
    return rows(leaks.find_leaks(d, q).select("doc_id", "item_id"))


def test_pieces(spark):
    items = [(i, item(i)) for i in range(20)]
    w = items[3][1].split()
    other = " ".join(random.Random(99).choice(["the", "plan", "fee", "year", "adviser", "trust"]) for _ in range(80))
    changed = list(w[10:40])
    changed[9], changed[21] = "altered", "renewed"
    broken = " ".join(w[20:40])
    broken = broken[:30] + "-\n" + broken[30:] if broken[29] != " " and broken[30] != " " else broken
    docs = [items[3][1], f"{other} {' '.join(w[5:21])} {other}", f"{other} {' '.join(changed).upper()} {other}", "\n".join(w[0:30]), f"{other} {' '.join(w[5:11])} {other}", f"{other} {QUESTION} {other}", None, "", other * 300 + " " + " ".join(w[:30]), broken]
    got = scan(spark, docs, items)
    assert {d for d, i in got if i == 3} >= {0, 1, 2, 3, 8, 9} and {i for _, i in got} == {3} and not {4, 5, 6, 7} & {d for d, _ in got}


def test_empty(spark):
    assert scan(spark, [], [(1, item(1))]) == [] and scan(spark, ["x"], []) == [] and scan(spark, ["x"], [(1, None), (2, "too short")]) == []


def test_repeats_and_ties(spark):
    a = item(1)
    got = scan(spark, [a, a], [(1, a), (1, a), (2, item(2))])
    assert got == [(0, 1), (1, 1)]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=50), st.integers(0, 2**31), st.integers(0, 64))
def test_hamming_index_finds_all(prints, seed, flips):
    """Against brute force: every print within the radius is found."""
    prints = np.array(prints, np.uint64)
    r = np.random.default_rng(seed)
    q = prints[r.integers(0, len(prints), 20)].copy()
    for i in range(len(q)):
        for bit in r.choice(64, min(flips, 64), replace=False)[: leaks.RADIUS + 2]:
            q[i] ^= np.uint64(1) << np.uint64(bit)
    a, b = leaks.HammingIndex(prints).near(q)
    brute = {(i, j) for i in range(len(q)) for j in range(len(prints)) if int(q[i] ^ prints[j]).bit_count() <= leaks.RADIUS}
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == brute


def test_items_of_the_same_text(spark):
    """An item that stands twice in the set is no rarer for it: both ids get the leak."""
    a = item(1)
    assert scan(spark, [a], [(1, a), (7, a.upper()), (2, item(2))]) == [(0, 1), (0, 7)]


def test_items_that_share_their_passage(spark):
    a = item(1).replace(QUESTION, "")
    assert scan(spark, [a], [(1, a + QUESTION), (2, a + "Who pays the fee of the second year?"), (3, item(3))]) == [(0, 1), (0, 2)]


def test_blocks_of_items_change_nothing(spark):
    items = [(i, item(i)) for i in range(25)]
    docs = spark.createDataFrame([(i, f"so it goes and {' '.join(t.split()[i : i + 20])} and then it goes on") for i, t in items], "doc_id bigint, text string")
    q = spark.createDataFrame(items, "item_id bigint, text string")
    whole = rows(leaks.find_leaks(docs, q))
    assert {r[:2] for r in whole} == {(i, i) for i, _ in items} and rows(leaks.find_leaks(docs, q, block=7)) == whole


def test_short_items(spark):
    short = "bakbar estcal inedor owfen undgri yrhol ostjun"
    q = [(1, short), (2, "too short"), (3, item(3))]
    assert scan(spark, [f"It was said that {short} in the end", "too short"], q) == [(0, 1)]
    assert leaks.too_short(spark.createDataFrame(q, "item_id bigint, text string")) == [2]


def edited(ws, edits, r):
    """ws with single words changed, left out or put in, spread over it."""
    ws = list(ws)
    for k in range(edits):
        at = min(len(ws) - 2, max(1, (k + 1) * len(ws) // (edits + 1)))
        kind = r.choice(("change", "change", "drop", "add"))
        ws[at : at + 1] = {"change": ["altered"], "drop": [], "add": [ws[at], "inserted"]}[kind]
    return ws


@pytest.mark.parametrize("length, edits", [(15, 1), (15, 2), (18, 2), (20, 3), (25, 3)])
def test_recall_on_short_pieces(length, edits):
    """Against the exact alignment of every item with every text."""
    items = [(i, item(i)) for i in range(40)]
    index = leaks.build_index(leaks.query_set(items))
    r = random.Random(length * 10 + edits)
    texts = []
    for i, t in items:
        ws, at = t.split(), r.randrange(0, 30)
        filler = [r.choice(["the", "plan", "fee", "year", "adviser", "trust"]) for _ in range(30)]
        texts.append(" ".join([*filler, *edited(ws[at : at + length], edits, r), *filler]))
    number = {w: k for k, w in enumerate(index.vocabulary)}
    accept = lambda n, share: n >= leaks.PIECE_WORDS and share >= leaks.MIN_SIMILARITY or n >= leaks.MIN_WORDS and share >= leaks.EXACT_SIMILARITY
    brute = {(d, i) for d, t in enumerate(texts) for i in range(len(items)) if accept(*leaks.similarity(index, i, [number.get(w, len(number)) for w in leaks._words(t)]))}
    signs = np.vstack([leaks.signs_of(index.vocabulary), np.zeros((1, 64), np.int8)])
    found = leaks.search_batch(index, leaks.HammingIndex(index.prints), signs, pa.array(index.vocabulary), pa.array(texts))
    assert {(d, i) for d, i, n, share in found if accept(n, share)} == brute and len(brute) >= 0.25 * len(texts)


def framed(k):
    """Items of one sentence frame, with names and numbers of their own."""
    r = random.Random(k)
    a, b, c, d, e = (r.choice(WORDS) + r.choice(WORDS) for _ in range(5))
    return f"Working as a {a} near {b}, {c} inherited a greenhouse appraised at {k}500 from a foster child named {d}. An insurer in {e} offers {k}250 at once or {k} payments beginning on the first Monday in June."


def accepted(words, share, own=10**6):
    return words >= leaks.PIECE_WORDS and share >= leaks.MIN_SIMILARITY or words >= min(leaks.MIN_WORDS, own) and share >= leaks.EXACT_SIMILARITY


def searched(index, texts):
    signs = np.vstack([leaks.signs_of(index.vocabulary), np.zeros((1, 64), np.int8)])
    return leaks.search_batch(index, leaks.HammingIndex(index.prints), signs, pa.array(index.vocabulary), pa.array(texts))


def test_shared_frames_are_not_aligned(monkeypatch):
    """A text with one item of a frame meets all items of the frame, but is aligned with few others."""
    known = [(i, framed(i)) for i in range(100, 160)]
    index = leaks.build_index(leaks.query_set(known))
    texts = [f"so it goes and {t} and then it goes on" for _, t in known[:20]] + [f"so it goes and {framed(i)} and then it goes on" for i in range(300, 320)]
    aligned, real = [], leaks.similarity
    monkeypatch.setattr(leaks, "similarity", lambda ix, item, doc: aligned.append(item) or real(ix, item, doc))
    found = searched(index, texts)
    assert {(row, item) for row, item, n, share in found if accepted(n, share)} == {(i, i) for i in range(20)} and len(aligned) <= 40


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**31), st.integers(0, 8), st.integers(5, 60), st.sampled_from([5, 9, 12, 13, 15, 40]))
def test_reachable_is_an_upper_bound(seed, edits, length, own):
    """Whatever the alignment of an item with a stretch would accept is reachable."""
    r = random.Random(seed)
    known = [(i, framed(i)) for i in range(100, 110)] + [(i, " ".join(item(i).split()[:own])) for i in range(10)]
    index = leaks.build_index(leaks.query_set(known))
    number = {w: k for k, w in enumerate(index.vocabulary)}
    has_word, has_pair = np.zeros(len(number) + 1, bool), np.zeros(leaks._PAIRS, bool)
    for _, t in known:
        ws = leaks._words(t)
        at = r.randrange(0, max(1, len(ws) - length))
        doc = [number.get(w, len(number)) for w in ["so", "it", *edited(ws[at : at + length], edits, r), "goes", "on"]]
        for k in range(len(index.ids)):
            good = accepted(*leaks.similarity(index, k, doc), own=int(index.begins[k + 1] - index.begins[k]))
            assert not good or leaks.reachable(index, k, np.array(doc), has_word, has_pair)
    assert not has_word.any() and not has_pair.any()


def test_query_set_is_split_together(monkeypatch):
    """Texts and sentences are split in one call each, with the words of texts split one by one."""
    texts = [framed(1), "Één «café»: 1,000.\nWas it well-\nknown? Yes! " + QUESTION, "", None, "?", item(2), item(3)]
    calls, real = [], leaks.words
    monkeypatch.setattr(leaks, "words", lambda x: calls.append(len(x)) or real(x))
    got = leaks.query_set(enumerate(texts))
    assert len(calls) == 2 and got.ids == [[0], [1], [5], [6]]
    assert got.words == [leaks._words(t.replace(QUESTION, "")) for t in (texts[0], texts[1], texts[5], texts[6])]


def test_query(spark, data):
    assert queries.p6_found(spark, data).columns == ["doc_id", "item_id"]
