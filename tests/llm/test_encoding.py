import random

import pytest

from corpusmill.llm import encoding as e
from corpusmill.llm import queries
from tests.conftest import rows

SENTENCES = ["El préstamo subió más de lo que la niña creyó, según el señor Núñez.", "L’été dernier, la clôture du relevé annuel a été préparée.", "Für ältere Kinder prüfte die Beraterin die Übersicht – ohne Gebühren.", "A declaração não cobre as comissões da apólice, é preciso atenção.", "A client’s résumé doesn’t matter — it’s the café’s own “plan” that counts…", "NINGUÉM LEU A DECLARAÇÃO ATÉ O VERÃO.", "Łódź and Ærø are far from Αθήνα and Київ.", "It costs £506 or ¥376, ½ of it at 18 °C."]


def text(seed, n=8):
    r = random.Random(seed)
    return " ".join(r.choice(SENTENCES) for _ in range(n))


def garble(t, written, read):
    table = e.TABLE[read]
    out = []
    for c in t:
        if c < "\x80":
            out.append(c)
            continue
        try:
            out.append("".join(table[b] for b in c.encode(written)))
        except UnicodeEncodeError:
            out.append(c)
    return "".join(out)


def corpus(spark, docs):
    return spark.createDataFrame([(i, t, s, "x", 1) for i, (t, s) in enumerate(docs)], "doc_id bigint, text string, source string, cipher string, n int")


WAYS = [("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "cp437"), ("utf-8", "mac_roman"), ("utf-8", "cp1251"), ("mac_roman", "cp1252"), ("cp1252", "latin-1")]


def test_found_and_restored(spark):
    clean = [(text(i), ["a", "B", None][i % 3]) for i in range(300)]
    plain = [" ".join(random.Random(1000 + k).sample(SENTENCES[:5], 4)) for k in range(len(WAYS))]
    bad = [(garble(t, *w), "a") for t, w in zip(plain, WAYS, strict=True)]
    twice = garble(garble(plain[0], "utf-8", "cp1252"), "utf-8", "cp1252")
    bad += [(twice, "b"), ("lost � here", "b"), (garble("It’s in one place only, and all else is plain.", "utf-8", "cp1252"), None)]
    docs = corpus(spark, [*clean, *bad])
    assert [r[0] for r in rows(e.garbled(docs))] == sorted(range(300, 300 + len(bad)), key=repr)
    restored = {r.doc_id: r.restored for r in e.restore(docs).collect()}
    for k, t in enumerate(plain):
        assert restored[300 + k] == t, WAYS[k]
    assert restored[300 + len(WAYS)] == plain[0]


def test_pages_beyond_the_usual(spark):
    """Pages that are in no list of this module, but known to Python."""
    clean = [(text(i), "a") for i in range(300)]
    ways = [("utf-8", "koi8_r"), ("utf-8", "cp1257"), ("utf-8", "iso8859_2")]
    plain = [" ".join(random.Random(1000 + k).sample(SENTENCES[:5], 4)) for k in range(len(ways))]
    docs = corpus(spark, [*clean, *((garble(t, *w), "a") for t, w in zip(plain, ways, strict=True))])
    assert [r[0] for r in rows(e.garbled(docs))] == [300, 301, 302]
    restored = {r.doc_id: r.restored for r in e.restore(docs).collect()}
    assert [restored[300 + k] for k in range(len(ways))] == plain


def test_translation():
    t = e.Translation({"Ã©": "é", "Ã³": "ó", "\x92": "’", "Ã": "à"})
    assert t.apply("Ã©\x92Ã³Ã x") == "é’óà x" and e.Translation({}).apply("Ã©") == "Ã©"


def test_special_rows(spark):
    docs = corpus(spark, [(None, "a"), ("", "a"), ("plain", "a"), ("é" * 50_000, None), ("ok", None)])
    assert rows(e.garbled(docs)) == []
    assert rows(e.garbled(corpus(spark, []))) == []


@pytest.mark.parametrize("page", e.PAGES)
def test_utf8_round_trip(page):
    for c in "éßñ€’—Ł":
        assert e._utf8(garble(c, "utf-8", page), page)[0] == c


def test_runs_cover_the_text():
    t = "aéb" + "ü" * 30 + "\nß"
    assert "".join(t[a:b] for _, a, b in e.runs(t)) == "é" + "ü" * 30 + "ß"


def test_query(spark, data):
    assert queries.p8_found(spark, data).columns == ["doc_id"]
