import numpy as np
import pyarrow as pa

import pytest

from corpusmill.llm import queries, residue
from tests.conftest import rows

BACKGROUND = ["The planner reviews the trust agreement every year with the family before the quarter ends.", "A long page about the fees that advisers charge and how to compare them in your own time.", "Nobody needs a bond ladder and a second mortgage in the same year, and your plan is no exception."] * 40


def found(spark, texts):
    data = [("t", i, t, 0) for i, t in enumerate([*texts, *BACKGROUND])]
    df = spark.createDataFrame(data, "src string, rec_id bigint, text string, kind int")
    return [r[1] for r in rows(residue.residue_records(df))]


CASES = ["Lorem ipsum dolor sit amet, consectetur adipiscing elit. Real text.", "Welcome back, {{ first_name }}, your plan is waiting.", "You need to enable JavaScript to run this app.", "404 Not Found", "Page introuvable\nLa page demandée n’existe pas ou a été déplacée.", "[Insert Title Here]", "Untitled", "At __CITY__, we believe planning is personal.", "Fees start at $NaN per year.", "ERROR ESTABLISHING A DATABASE CONNECTION", "Reach @@headline@@ for a meeting", "x " * 50_000 + "\nAccess denied"]
CONTENT = ["The Untitled Car in the Estate", "Error-Proof Your Tax Folder", "Access to the trust account was denied until the court letter arrived.", "Our fee calculator doesn’t need JavaScript, so it works with scripts switched off.", "The sample letter opens “Dear [trustee name],” and runs to a single page you can adapt.", "In set notation the heirs are {spouse, child, charity}, and the order matters.", "Fill in the blank lines ______ on the beneficiary form and have two witnesses sign.", "Something went wrong with the rollover: the check was made out to the wrong custodian.", "", None, "A Sample Page From Our Planning Binder"]


def test_cases_and_content(spark):
    assert found(spark, [*CASES, *CONTENT]) == sorted(range(len(CASES)), key=lambda i: repr(("t", i)))


def test_repeated_rows_and_empty(spark):
    assert found(spark, ["Untitled", "Untitled"]) == [0, 1]
    empty = spark.createDataFrame([], "src string, rec_id bigint, text string")
    assert residue.residue_records(empty).count() == 0


def test_residue_beside_other_text(spark):
    titles = ["undefined | Holmlyn Astlyn Retirement Partners", "Holmlyn Astlyn Retirement Partners - Page not found", "404 | Holmlyn Astlyn", "Holmlyn Astlyn: NaN", "Just a Moment: Pausing Before You Sell", "Reduced fee – $6,500", "Holmlyn | Estate plans", "Not found on the statement | null", None]
    bodies = [None] * 8 + ["Holmlyn Astlyn | Page not found\nFees | 500"]
    prices = [(100, "Plan prices", "A bond ladder – 500\nA second mortgage | 500\nReview | $6,500")]
    background = [(i + 1000, None, x) for i, x in enumerate(BACKGROUND)]
    df = spark.createDataFrame([(i, t, b) for i, (t, b) in enumerate(zip(titles, bodies, strict=True))] + prices + background, "post_id int, title string, body_text string")
    assert sorted(r[1] for r in rows(residue.residue_records(residue.record_texts(df, "posts", "post_id")))) == [0, 1, 2, 3, 8]


def test_equal_windows_are_looked_up_once(spark):
    """Equal windows of a batch come in one row with all their records, and each record is counted."""
    df = spark.createDataFrame([("t" if i % 2 else "u", i, "Page not found\nAccess denied\nPage not found", None) for i in range(6)], "src string, rec_id bigint, text string, title string").coalesce(1)
    got = residue._grouped_windows(df, residue.DEFAULT).where("word is null").collect()
    assert sorted((r.src, sorted(r.recs)) for r in got) == [("t", [1, 1, 3, 3, 5, 5]), ("t", [1, 3, 5]), ("u", [0, 0, 2, 2, 4, 4]), ("u", [0, 2, 4])]
    assert len(rows(residue.residue_windows(df))) == 18 and len(rows(residue.residue_records(df))) == 6
    assert {r.n for r in residue.candidate_windows(df).where("word is not null").collect()} == {6}


def test_record_texts(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (2, "Untitled", None, "x")], "post_id int, title string, body_text string, src string")
    assert rows(residue.residue_records(residue.record_texts(df, "posts", "post_id"))) == [("posts", 2)]
    kept = residue.without_residue(df, "posts", "post_id", residue.residue_records(residue.record_texts(df, "posts", "post_id")))
    assert [r.post_id for r in kept.collect()] == [1]


@pytest.mark.parametrize("kind", sorted(residue.EXEMPLARS))
def test_exemplars_find_themselves(kind):
    ex = residue.Exemplars()
    scorer = residue.Scorer(residue.np.ones(len(ex.vocabulary)), 1000)
    for e, ids in enumerate(ex.ids):
        if ex.kind[e] == kind and not (kind == "loose" and len(ids) < residue.MIN_LOOSE):
            assert scorer.best(ids)[0], ex.words[e]


def test_query(spark, data):
    assert queries.p4_found(spark, data).columns == ["src", "rec_id"]


def test_wordings_between_exemplars(spark):
    """Wordings that no exemplar has as they are, and content of the same words."""
    new = ["Please enable JavaScript in this browser to continue", "The requested page could not be found on the server", "Sorry, we can't find that page", "Your browser doesn't support JavaScript", "Bitte JavaScript im Browser aktivieren"]
    content = ["Please find the page of the plan that names your adviser.", "Your server of choice may view the account at any time.", "We support a range of funds that you can access in a few minutes.", "The request for a new plan was not found to be in order."]
    talk = ["Household plans change over the years and the adviser reviews the page of the plan with them.", "You can access a new account in minutes and request support in order to view it at any time.", "It was found that a request may take a few minutes of your time."]
    plain = [(k + 100, talk[k % 3], "A plan") for k in range(210)]
    df = spark.createDataFrame([("t", i, t, "A title") for i, t in enumerate([*new, *content])] + [("t", *p) for p in plain], "src string, rec_id bigint, text string, title string")
    got = {r.rec_id for r in residue.residue_records(df).collect()}
    assert len(got & set(range(len(new)))) >= 4 and not {i for i in got if i >= len(new)}


def test_exemplars_as_a_table(spark):
    pairs = residue.exemplar_pairs(spark.createDataFrame([("error", "The hamster is asleep"), ("error", None), (None, "x"), ("content", "The hamster is asleep in the story")], "kind string, text string"))
    df = spark.createDataFrame([("t", 1, "The hamster is asleep", None), ("t", 2, "Page not found", None), ("t", 3, "The hamster is asleep in the story", None), ("t", 4, "Dear {{name}}", None)], "src string, rec_id bigint, text string, title string")
    assert {r.rec_id for r in residue.residue_records(df, pairs).collect()} == {1, 4}


def test_leave_one_wording_out(spark, data):
    """The records of the tables are still found when the exemplars of one of their wordings are taken out of the set."""
    records = queries._records(spark, data.replace("sf0.001", "sf0.01"))
    windows = residue.candidate_windows(records)
    ex = residue.Exemplars()
    counts = {r.word: r.n for r in windows.where("word is not null").groupBy("word").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    df = np.array([counts.get(k, 0) for k in range(len(ex.vocabulary))], np.float64)
    judge = lambda s, r: s.judge(tuple(r.window)) if r.cut is None else s.judge_part(tuple(r.window), r.cut, tuple(r.whole))
    scorer = residue.Scorer(df, counts[-1])
    rows_ = [r for r in windows.where("word is null").collect() if judge(scorer, r)[0]]
    by_record, kept, tried, found = {}, {}, 0, 0
    for r in rows_:
        by_record.setdefault((r.src, r.rec_id), []).append(r)
    for rows_of in by_record.values():
        if any(judge(scorer, r)[0] in ("slot", "loose") for r in rows_of):
            continue
        for wording in {tuple(r.window) for r in rows_of}:
            if wording not in kept:
                mass = lambda s: sum(scorer.weight[i] for i in s)
                same = lambda ids: mass(set(ids) & set(wording)) >= 0.95 * max(mass(ids), mass(set(wording)))  # noqa: E731, B023
                pairs = tuple((k, " ".join(ws)) for k, ws, ids in zip(ex.kind, ex.words, ex.ids, strict=True) if k in ("content", "slot", "loose") or not same(ids))
                less = residue.Exemplars(pairs)
                place = {w: i for i, w in enumerate(less.vocabulary)}
                kept[wording] = (residue.Scorer(np.array([df[ex.vocabulary.index(w)] for w in less.vocabulary]), counts[-1], less), [place.get(w, len(place)) for w in ex.vocabulary] + [len(place)])
            s, number = kept[wording]
            tried += 1
            again = (s.judge(tuple(number[i] for i in r.window)) if r.cut is None else s.judge_part(tuple(number[i] for i in r.window), r.cut, tuple(number[i] for i in r.whole)) for r in rows_of)
            found += any(kind for kind, _ in again)
    assert tried > 20 and found >= 0.85 * tried  # 0.88 on these few records; README has the share at sf 0.1


def test_exemplars_are_split_in_one_call(monkeypatch):
    """Every task builds the set: a call for each passage took a second of CPU."""
    calls, split = [], residue._tokens
    monkeypatch.setattr(residue, "_tokens", lambda t: (calls.append(len(t)), split(t))[1])
    ex = residue.Exemplars()
    assert len(calls) == 1 and len(ex.words) > 200


def test_equal_words_are_split_once(monkeypatch):
    """What stands between blanks is taken apart once in a batch, with each word at its place."""
    ex = residue.Exemplars()
    windows = pa.array(["page not-found", "", "found: page  page 17", "404\tpage", "page not-found"])
    seen, split = [], residue._tokens
    monkeypatch.setattr(residue, "_tokens", lambda t: (seen.extend(t.to_pylist()), split(t))[1])
    ids, of = residue._word_ids(ex, windows)
    assert len(seen) == len(set(seen))
    number = {w: k for k, w in enumerate(ex.vocabulary)}
    assert [number[w] for w in ("page", "not", "found", "found", "page", "page", "404", "page", "page", "not", "found")] == ids.tolist()
    assert of.tolist() == [0, 0, 0, 2, 2, 2, 3, 3, 4, 4, 4]
