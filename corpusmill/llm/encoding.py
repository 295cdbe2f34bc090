"""Garbled text from wrong character encodings: found and restored.

A wrong decoding is a substitution cipher: each garbled unit (a byte's character, or the characters of one UTF-8 sequence) stands for a letter. A source
holds texts of several unknown ciphers, so its garbled documents form clusters, and each (source, cluster) has a table of its own, from units to
letters. Tables are learned by expectation maximization over the whole corpus:

* Each run of characters outside ASCII is taken with its neighbours, once per document and distinct context (`contexts`). Character bigrams are
  counted from these; as most text is sound, they are the language's from the start.
* For every distinct context the letters that the bigrams would rather have in the run's place are its candidates (`candidates`), and those that a swap
  of two code pages makes of the run name that swap. Contexts without a gain go no further, which is nearly all of them.
* The swaps of all single-byte pages that Python knows (`ciphers`) only start the clusters and are the tables' prior, worth PRIOR_COUNT sightings.
  M step: how often a unit stood for a letter in a cluster's documents, by posterior weight. E step: a document's likelihood under each of its
  source's tables against leaving it as it is, and the weight of the cluster in the source; the bigrams are counted again without garbled text.
* Documents that no cluster takes, but in which bigrams miss letters, may come from a page that no rule knows: a table for each source
  is learned from bigrams alone (`unknown_pages`). Its units count if they stood in several contexts and fit those as well as sound letters do.

`restore` applies a document's table with translate(), units of several characters being folded into one first, where the bigrams favour it. A
replacement character or a C1 control is lost or garbled text at once.

At scale: one pass over the texts writes slim context rows; iterations join those with the few contexts that gain (broadcast while few, shuffled
beyond); tables are aggregates by (source, cluster, unit, letters). Only the bigram table comes to the driver: characters outside all pages are one
class, so it has at most ALPHABET ** 2 entries.

Defined results: null and empty texts are sound. Very long texts and runs are taken whole (runs in overlapping pieces of RUN characters). A null source
is one source. Ties between ciphers take the first by name. Rows repeated in the input give one result; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from encodings.aliases import aliases

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.cluster import materialize, sized

#: Pages that texts were mostly read as, and that texts in Latin letters were written in; swaps with other pages need OTHER_PAGE nats more.
PAGES = ("cp1252", "latin-1", "cp1250", "cp1251", "cp1253", "cp437", "cp850", "mac_roman")
WRITTEN = ("cp1252", "mac_roman", "cp437", "cp850")
TWICE = ("cp1252", "latin-1")
OTHER_PAGE = 4.0
#: The most iterations (they end when no more documents change than 1 in 100 of those found); nats that a context must gain (by a rare
#: page or in the last iteration the second number), and that a document's gains must reach in the last iteration and in those before it, where only the sure ones may move the
#: bigrams; characters of a run that are looked at together.
ROUNDS, MIN_CONTEXT, SURE_CONTEXT, MIN_GAIN, SURE_GAIN, RUN = 6, 4.0, 6.0, 3.0, 6.0, 12
#: What the rules know of a table's unit is worth so many sightings; letters that only bigrams name need so many to count.
PRIOR_COUNT, LEARNED_COUNT = 4.0, 3.0
#: A unit that only bigrams explain stands for one letter in so many of its sightings.
SHARE = 0.8
#: Letters that are candidates for a unit of at most UNIT characters by bigrams alone.
LETTERS, UNIT = 6, 4
#: A unit of an unknown page must have stood in so many different contexts, with so many nats a sighting less than sound letters have at most; a
#: document needs so many of such units.
UNKNOWN_CONTEXTS, UNKNOWN_FIT, UNKNOWN_UNITS = 5, 1.5, 2
#: Counts of a bigram are smoothed by its second character's share of all, and that by so much.
SMOOTH = 0.05
ALPHABET = 1_100
LOST_RE = "[�\u0080-\u009f]"
#: Bytes that cp1252 leaves undefined, and the no-break space: what a cut-off sequence may have lost.
FRAIL = (0x81, 0x8D, 0x8F, 0x90, 0x9D, 0xA0)


def _page(name: str) -> dict[int, str]:
    """The upper half of a page; a byte without a character stands for the C1 control of its number."""
    out = {}
    for b in range(128, 256):
        try:
            out[b] = bytes([b]).decode(name)
        except UnicodeDecodeError:
            out[b] = chr(b)
    return out


def _other_pages() -> list[str]:
    """All further single-byte pages of Python's that hold ASCII and have letters above it."""
    out = []
    for name in sorted(set(aliases.values()) - {p.replace("-", "_") for p in PAGES} - {"latin_1", "ascii"}):
        try:
            plain = bytes(range(32, 127)).decode(name) == bytes(range(32, 127)).decode("ascii") and len(b"\x83A".decode(name, "replace")) == 2
            upper = [bytes([b]).decode(name, "replace") for b in range(160, 256)]
        except (LookupError, UnicodeError):
            continue
        if plain and all(len(c) == 1 for c in upper) and sum(c.isalpha() for c in upper) >= 25:
            out.append(name)
    return out


OTHERS = tuple(_other_pages())
TABLE = {p: _page(p) for p in (*PAGES, *OTHERS)}
BYTE = {p: {c: b for b, c in t.items()} for p, t in TABLE.items()}
KNOWN = {c for t in TABLE.values() for c in t.values()}


def _utf8(run: str, page: str) -> tuple[str, float]:
    """run with every UTF-8 sequence that was read as `page` decoded, and the nats by which such sequences are no chance."""
    byte, out, bonus, i = BYTE[page], [], 0.0, 0
    while i < len(run):
        b = byte.get(run[i], 0)
        n = 2 if 0xC2 <= b <= 0xDF else 3 if 0xE0 <= b <= 0xEF else 4 if 0xF0 <= b <= 0xF4 else 0
        raw = [b]
        while n and len(raw) < n and i + len(raw) < len(run) and 0x80 <= (c := byte.get(run[i + len(raw)], 0)) <= 0xBF:
            raw.append(c)
        if n and len(raw) == n:
            try:
                out.append(bytes(raw).decode())
                bonus += 2.1 + 1.4 * (n - 2)
                i += n
                continue
            except UnicodeDecodeError:
                pass
        out.append(run[i])
        i += 1
    return "".join(out), bonus


def _cut_off(run: str, page: str) -> list[str]:
    """What a run may have been whose last sequence lost its last byte."""
    byte = BYTE[page]
    for n in (2, 1):
        if len(run) >= n and (lead := byte.get(run[-n], 0)) and (n == 1 and 0xC2 <= lead <= 0xDF or n == 2 and 0xE0 <= lead <= 0xEF and 0x80 <= byte.get(run[-1], 0) <= 0xBF):
            raw = bytes(byte[c] for c in run[-n:])
            found = []
            for b in FRAIL:
                try:
                    whole = (raw + bytes([b])).decode()
                except UnicodeDecodeError:
                    continue
                if whole in KNOWN:
                    found.append(run[:-n] + whole)
            return found
    return []


def ciphers() -> dict[str, float]:
    """The known swaps, with the log prior of each."""
    usual = [f"utf-8 as {p}" for p in PAGES] + [f"utf-8 as {p} as {q}" for p in TWICE for q in TWICE] + [f"{a} as {b}" for a in WRITTEN for b in PAGES if a != b]
    return {c: 0.0 for c in usual} | {c: -OTHER_PAGE for p in OTHERS for c in (f"utf-8 as {p}", *(f"{a} as {p}" for a in WRITTEN))}


def decodings(run: str, cipher: str) -> list[tuple[str, float]]:
    """What a run may have been under a cipher, with the nats that its form alone speaks for it."""
    written, *read = cipher.split(" as ")
    if written != "utf-8":
        byte, table = BYTE[read[0]], TABLE[written]
        out = "".join(table[byte[c]] if c in byte else c for c in run)
        return [(out, 0.0)] if out != run else []
    out, bonus = _utf8(run, read[-1])
    cut = [(x, 0.0) for x in _cut_off(out, read[-1])] if read[-1] in TWICE else []
    if len(read) == 2:
        if out == run:
            return []
        again, more = _utf8(out, read[0])
        return [(again, bonus + more)] if again != out else []
    return ([(out, bonus)] if out != run else []) + [(x, bonus) for x, _ in cut]


# -- contexts -----------------------------------------------------------------------------------------------------------------

_RUN = re.compile("[^\x00-\x7f]+")


def _near(c: str) -> str:
    return " " if not c or c.isspace() else c


def runs(text: str) -> Iterator[tuple[str, int, int]]:
    """(left neighbour + run + right neighbour, start, end) of every run; a long run comes in pieces."""
    for m in _RUN.finditer(text):
        for at in range(m.start(), m.end(), RUN):
            end = min(at + RUN, m.end())
            yield _near(text[at - 1 : at]) + text[at:end] + _near(text[end : end + 1]), at, end


def contexts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc, source, context, n), written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d, s, c, n = [], [], [], []
            for doc, src, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                found = Counter(x for x, _, _ in runs(t))
                d.extend([doc] * len(found))
                s.extend([src] * len(found))
                c.extend(found)
                n.extend(found.values())
            if d:
                yield pa.RecordBatch.from_pydict({"doc": pa.array(d, pa.int64()), "source": pa.array(s, pa.string()), "context": pa.array(c, pa.string()), "n": pa.array(n, pa.int64())})

    src = F.lower(F.coalesce(F.col(source), F.lit("")))
    rows = docs.where(F.col(text).rlike(r"[^\x00-\x7f]")).select(F.col(doc_id).cast("bigint").alias("doc"), src.alias("source"), F.col(text).alias("text"))
    return materialize(rows.mapInArrow(run, "doc bigint, source string, context string, n bigint"))


# -- bigrams ------------------------------------------------------------------------------------------------------------------


def _class(c: str) -> str:
    return c if c < "\x80" or c in KNOWN else ""


def _bigrams(counted: DataFrame) -> DataFrame:
    """(a, b, n) from (context, n)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            c: Counter = Counter()
            for x, n in zip(f["context"], f["n"], strict=True):
                x = [_class(ch) for ch in x]
                for a, b in zip(x, x[1:], strict=False):
                    c[a, b] += n
            yield pd.DataFrame([(a, b, n) for (a, b), n in c.items()], columns=["a", "b", "n"])

    return counted.select("context", "n").mapInPandas(run, "a string, b string, n double").groupBy("a", "b").agg(F.sum("n").alias("n"))


class Bigrams:
    """Bigram counts of the characters outside ASCII and their neighbours; at most ALPHABET ** 2 entries."""

    def __init__(self, rows: list[tuple[str, str, float]]):
        self.n = {(a, b): n for a, b, n in rows if n > 0}
        self.of: dict[str, float] = defaultdict(float)
        self.to: dict[str, float] = defaultdict(float)
        for (a, b), n in self.n.items():
            self.of[a] += n
            self.to[b] += n
        self.all = sum(self.of.values())

    def score(self, context: str) -> float:
        x = [_class(c) for c in context]
        floor = self.all + SMOOTH * ALPHABET
        return sum(math.log((self.n.get((a, b), 0) + (self.to.get(b, 0) + SMOOTH) / floor) / (self.of.get(a, 0) + 1)) for a, b in zip(x, x[1:], strict=False))

    def letters(self) -> list[str]:
        """The characters outside ASCII that stand beside ASCII more often than beside others, the frequent ones first: letters and signs of sound text."""
        plain: dict[str, float] = defaultdict(float)
        for (a, b), n in self.n.items():
            for c, beside in ((a, b), (b, a)):
                if c >= "\x80" and c in KNOWN:
                    plain[c] += n if beside < "\x80" and beside else -n
        return [c for c, n in sorted(plain.items(), key=lambda x: (-x[1], x[0])) if n > 0]

    def usual(self) -> dict[str, float]:
        """By letter, what a sighting of it in sound text scores on the average."""
        out: dict[str, list[float]] = defaultdict(lambda: [0.0, 0.0])
        floor = self.all + SMOOTH * ALPHABET
        for (a, b), n in self.n.items():
            g = n * math.log((n + (self.to[b] + SMOOTH) / floor) / (self.of[a] + 1))
            if b >= "\x80" > a:
                out[b][0] += g / self.to[b]
            if a >= "\x80" > b:
                out[a][1] += g / self.of[a]
        return {c: x[0] + x[1] for c, x in out.items()}


_CANDIDATES = "context string, unit string, cipher string, letters string, gain double, fit double"


def candidates(counted: DataFrame, bigrams: Bigrams, least: float = MIN_CONTEXT) -> DataFrame:
    """(context, unit, cipher, letters, gain, fit): what a distinct context's run may stand for, by how many nats the bigrams like it better, and how much
    less than that letter's sound sightings; a row for each swap that says so, and with a null cipher one for each of the best letters."""
    shared = counted.sparkSession.sparkContext.broadcast(bigrams)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lm, names = shared.value, ciphers()
        known: dict[str, dict[str, list[tuple[str, float]]]] = {}
        letters, usual = lm.letters(), lm.usual()
        ranked: dict[tuple[str, str], list[tuple[float, str]]] = {}
        for f in frames:
            out = []
            for x in f["context"]:
                a, unit, b = x[0], x[1:-1], x[-1]
                before = lm.score(x)
                if (a, b) not in ranked:
                    ranked[a, b] = sorted(((lm.score(a + c + b), c) for c in letters), reverse=True)[:LETTERS]
                best = ranked[a, b]
                if len(unit) == 1 and (not best or best[0][0] - before <= least):
                    continue  # no letter does better
                if unit not in known:
                    if len(known) > 100_000:
                        known.clear()
                    told: dict[str, list[tuple[str, float]]] = {}
                    for c in names:
                        for decoded, bonus in decodings(unit, c):
                            told.setdefault(decoded, []).append((c, bonus))
                    known[unit] = told
                for decoded, says in known[unit].items():
                    after = lm.score(a + decoded + b)
                    out += [(x, unit, c, decoded, after - before + bonus, 0.0) for c, bonus in says if after - before + bonus > (least if names[c] == 0 else SURE_CONTEXT)]
                if len(unit) <= UNIT:
                    out += [(x, unit, None, c, after - before, after - usual.get(c, 0.0)) for after, c in best if c != unit and after - before > least]
            yield pd.DataFrame(out, columns=["context", "unit", "cipher", "letters", "gain", "fit"])

    return materialize(counted.select("context").mapInPandas(run, _CANDIDATES))


def _unit_of() -> Column:
    return F.expr("substring(context, 2, length(context) - 2)")


def _sightings(n: Column) -> Column:
    """What n sightings of one context in one document count: each further one tells less."""
    return 1 + F.log(n.cast("double"))


def _evidence(rows: DataFrame, found: DataFrame, tables: DataFrame | None) -> DataFrame:
    """(doc, source, context, cipher, unit, letters, n, logw): each thing that a context of a document may stand for in each cluster, with the log of the
    table's weight times the bigrams' gain. tables is (source, cipher, unit, letters, seen, of_unit); without it only the rules speak."""
    n = found.count()
    at = rows.join(sized(found.select("context"), n), "context", "left_semi")
    by_rule = at.join(sized(found.where("cipher is not null"), n), "context")
    if tables is None:
        return by_rule.select("doc", "source", "context", "cipher", "unit", "letters", "n", F.col("gain").alias("logw"))
    zero, k = F.lit(0.0), tables.count()
    # of_unit stands in each row of a unit: once for a unit, and seen for each of its letters
    units = sized(tables.groupBy("source", "cipher", "unit").agg(F.first("of_unit").alias("of_unit"), F.map_from_entries(F.collect_list(F.struct("letters", "seen"))).alias("seen")), k)
    by_rule = by_rule.join(units, ["source", "cipher", "unit"], "left")
    by_rule = by_rule.select("doc", "source", "context", "cipher", "unit", "letters", "n", (F.col("gain") + F.log((F.coalesce(F.try_element_at("seen", F.col("letters")), zero) + PRIOR_COUNT) / (F.coalesce("of_unit", zero) + PRIOR_COUNT))).alias("logw"))
    learned = sized(tables.where(f"not by_rule and seen >= {LEARNED_COUNT} and seen >= {SHARE} * of_unit"), k)
    by_table = at.join(sized(found.where("cipher is null").select("context", "unit", "letters", "gain"), n), "context").join(learned, ["source", "unit", "letters"])
    return by_rule.unionByName(by_table.select("doc", "source", "context", "cipher", "unit", "letters", "n", (F.col("gain") + F.log(F.col("seen") / (F.col("of_unit") + PRIOR_COUNT))).alias("logw")))


def _learned(evidence: DataFrame, found: DataFrame, best: DataFrame, rows: DataFrame, n_best: int) -> DataFrame:
    """M step: (source, cipher, unit, letters, by_rule, seen, of_unit) from the documents of each cluster, each sighting split by posterior weight."""
    of = sized(best.select("doc", "cipher"), n_best)
    clustered = materialize(rows.join(of, "doc"))
    own = materialize(evidence.join(of, ["doc", "cipher"]).select("doc", "source", "context", "cipher", "unit", "letters", "n", "logw", F.lit(True).alias("by_rule")))
    # letters that bigrams alone name, for units of the cluster's documents that no rule explains
    open_ = clustered.join(own.select("doc", "context"), ["doc", "context"], "left_anti")
    more = open_.join(sized(found.where("cipher is null").select("context", "unit", "letters", F.col("gain").alias("logw")), found.count()), "context").select("doc", "source", "context", "cipher", "unit", "letters", "n", "logw", F.lit(False).alias("by_rule"))
    every = own.unionByName(more)
    weighed = every.groupBy("doc", "source", "cipher", "context", "unit").agg(F.collect_list(F.struct("letters", "logw", "by_rule")).alias("xs"), F.max("logw").alias("most"), F.max("n").alias("n"))  # at most the swaps of one cipher and LETTERS
    each = weighed.select("source", "cipher", "unit", "n", F.aggregate("xs", F.lit(0.0), lambda s, x: s + F.exp(x["logw"] - F.col("most"))).alias("z"), "most", F.explode("xs").alias("x"))
    seen = each.groupBy("source", "cipher", "unit", "x.letters").agg(F.sum(_sightings(F.col("n")) * F.exp(F.col("x.logw") - F.col("most")) / F.col("z")).alias("seen"), F.max("x.by_rule").alias("by_rule"))
    # all sightings of a unit in the cluster's documents, also where it stands for itself
    every_unit = clustered.groupBy("source", "cipher", _unit_of().alias("unit")).agg(F.sum(_sightings(F.col("n"))).alias("of_unit"))
    return materialize(seen.join(every_unit, ["source", "cipher", "unit"]))


def _assigned(evidence: DataFrame, priors: DataFrame | None, least: float, sure: float | None = None) -> DataFrame:
    """E step: (doc, source, cipher, gain, score) of the best cluster of each document that gains by one. sure: contexts that gain less don't count."""
    by_context = evidence.repartition("doc").groupBy("doc", "source", "cipher", "context").agg(F.max("logw").alias("most"), F.max("n").alias("n"))
    if sure is not None:
        by_context = by_context.where(F.col("most") > sure)
    by_cipher = by_context.groupBy("doc", "source", "cipher").agg(F.sum(F.col("most") * _sightings(F.col("n"))).alias("gain"))
    names = ciphers()
    rule = F.when(F.col("cipher").isin([c for c, w in names.items() if w < 0]), -OTHER_PAGE).otherwise(0.0)
    weighed = by_cipher.withColumn("prior", F.lit(-2.0)) if priors is None else by_cipher.join(sized(priors), ["source", "cipher"], "left").withColumn("prior", F.coalesce("prior", F.lit(-5.0)))
    scored = weighed.withColumn("score", F.col("gain") + F.col("prior") + rule)
    best = scored.groupBy("doc", "source").agg(F.max_by(F.struct("cipher", "gain", "score"), F.struct("score", "cipher")).alias("b")).select("doc", "source", "b.*")
    return materialize(best.where(F.col("score") >= least))


@dataclass
class Learned:
    best: DataFrame  # doc, source, cipher, gain, score
    tables: DataFrame  # source, cipher, unit, letters, seen, of_unit
    bigrams: Bigrams
    rounds: int


def learn(rows: DataFrame, rounds: int = ROUNDS) -> Learned:
    """Expectation maximization over the contexts."""
    counted = materialize(rows.groupBy("context").agg(F.sum("n").alias("n")))
    whole = materialize(_bigrams(counted))
    bigrams = Bigrams([tuple(r) for r in whole.collect()])
    totals = materialize(rows.select("doc", "source").distinct().groupBy("source").agg(F.count("*").alias("docs")))
    tables, priors, best = None, None, None
    for k in range(rounds):
        found = candidates(counted, bigrams)
        evidence = materialize(_evidence(rows, found, tables))
        now = _assigned(evidence, priors, SURE_GAIN)
        n_best = now.count()
        moved = n_best if best is None else now.join(best.select("doc", "cipher"), ["doc", "cipher"], "left_anti").count()
        best = now
        tables = _learned(evidence, found, best, rows, n_best)
        shares = best.groupBy("source", "cipher").agg(F.count("*").alias("k")).join(totals, "source")
        priors = materialize(shares.select("source", "cipher", F.greatest(F.lit(-5.0), F.least(F.lit(-0.5), F.log(F.col("k") / F.col("docs")))).alias("prior")))
        if k and moved * 100 <= n_best:
            break
        # the bigrams without what the clusters' tables call garbled
        top = evidence.join(sized(best.select("doc", "cipher"), n_best), ["doc", "cipher"]).groupBy("doc", "context").agg(F.max_by("letters", F.struct("logw", "letters")).alias("letters"), F.max("n").cast("double").alias("n"))
        ends = F.concat(F.substring("context", 1, 1), F.col("letters"), F.substring(F.col("context"), -1, 1))
        swapped = top.groupBy("context", "letters").agg(F.sum("n").alias("n")).select(F.inline(F.array(F.struct(F.col("context"), (-F.col("n")).alias("n")), F.struct(ends.alias("context"), F.col("n")))))
        bigrams = Bigrams([tuple(r) for r in whole.unionByName(_bigrams(swapped)).groupBy("a", "b").agg(F.sum("n").alias("n")).where("n > 0").collect()])
    best = _assigned(_evidence(rows, found, tables), priors, MIN_GAIN, SURE_CONTEXT)
    more, table = unknown_pages(rows, found, best)
    tables = tables.select("source", "cipher", "unit", "letters", "seen", "of_unit")
    return Learned(best.unionByName(more), tables.unionByName(table), bigrams, k + 1)


def unknown_pages(rows: DataFrame, found: DataFrame, best: DataFrame, rounds: int = 4) -> tuple[DataFrame, DataFrame]:
    """What `learn` gives, for the documents that no known swap explains: a table for each source from bigrams alone, from all letters alike."""
    letters = found.where("cipher is null").where(~F.col("unit").rlike(LOST_RE)).select("context", "unit", "letters", "gain", "fit")
    rest = materialize(rows.join(best.select("doc"), "doc", "left_anti").join(sized(letters.select("context").distinct()), "context", "left_semi").groupBy("source", "context").agg(F.count("*").cast("double").alias("n")))
    units = materialize(letters.select("unit").distinct())
    of_unit = materialize(rows.join(best.select("doc"), "doc", "left_anti").select("source", _unit_of().alias("unit")).join(sized(units), "unit").groupBy("source", "unit").agg(F.count("*").cast("double").alias("of_unit")))
    each = rest.join(sized(letters), "context").withColumn("seen", F.lit(1.0)).withColumn("of_unit", F.lit(1.0))
    table = None
    for _ in range(rounds):
        if table is not None:
            each = rest.join(sized(letters), "context").join(sized(table.select("source", "unit", "letters", "seen", "of_unit")), ["source", "unit", "letters"])
        weighed = each.withColumn("logw", F.col("gain") + F.log(F.col("seen") / F.col("of_unit"))).groupBy("source", "context", "unit", "n").agg(F.collect_list(F.struct("letters", "logw", "fit")).alias("xs"), F.max("logw").alias("most"))  # at most LETTERS
        one = weighed.select("source", "context", "unit", "n", "most", F.aggregate("xs", F.lit(0.0), lambda s, x: s + F.exp(x["logw"] - F.col("most"))).alias("z"), F.explode("xs").alias("x")).withColumn("w", F.exp(F.col("x.logw") - F.col("most")) / F.col("z"))
        seen = one.groupBy("source", "unit", "x.letters").agg(F.sum(F.col("n") * F.col("w")).alias("seen"), F.sum("w").alias("contexts"), F.sum(F.col("w") * F.col("x.fit")).alias("fit")).where("seen > 0.01")
        table = materialize(seen.join(of_unit, ["source", "unit"]))
    # a unit stands for one letter, in nearly all its sightings, and fits as sound letters do
    good = materialize(table.where(f"contexts >= {UNKNOWN_CONTEXTS} and fit / contexts >= -{UNKNOWN_FIT} and seen >= {SHARE} * of_unit").select("source", F.lit("unknown").alias("cipher"), "unit", "letters", "seen", "of_unit"))
    hit = rows.join(best.select("doc"), "doc", "left_anti").join(sized(letters), "context").join(sized(good.select("source", "unit", "letters")), ["source", "unit", "letters"])
    docs = hit.groupBy("doc", "source").agg(F.countDistinct("unit").alias("units"), F.sum("gain").alias("gain")).where(f"units >= {UNKNOWN_UNITS}")
    return docs.select("doc", "source", F.lit("unknown").alias("cipher"), "gain", F.col("gain").alias("score")), good


def garbled(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, cipher) of each document whose text holds characters garbled or lost; cipher is null where they are only lost."""
    best = learn(contexts(docs, doc_id, text, source)).best
    lost = docs.where(F.col(text).rlike(LOST_RE)).select(F.col(doc_id).cast("bigint").alias("doc"))
    both = best.select("doc", "cipher").unionByName(lost.select("doc", F.lit(None).cast("string").alias("cipher")))
    return both.groupBy("doc").agg(F.max("cipher").alias("cipher")).withColumnRenamed("doc", doc_id)


def learned_mapping(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(source, cipher, garbled, letters, n): the learned substitution tables, with the weight of the sightings."""
    tables = learn(contexts(docs, doc_id, text, source)).tables
    return tables.select("source", "cipher", F.col("unit").alias("garbled"), "letters", F.round("seen", 3).alias("n"))


class Translation:
    """A learned table as an argument of translate(): units of several characters are first folded into private characters."""

    FIRST = 0xF0000

    def __init__(self, table: dict[str, str]):
        longer = sorted((u for u in table if len(u) > 1), key=lambda u: (-len(u), u))
        self.fold = re.compile("|".join(map(re.escape, longer))) if longer else None
        self.private = {u: chr(self.FIRST + k) for k, u in enumerate(longer)}
        self.letters = {ord(self.private.get(u, u)): t for u, t in table.items()}

    def apply(self, run: str) -> str:
        return (self.fold.sub(lambda m: self.private[m[0]], run) if self.fold else run).translate(self.letters)


def restore(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, cipher, restored, left_lost): each garbled document's text, restored as far as its table tells; left_lost counts characters still lost.

    A unit that the table of the document's (source, cipher) hasn't seen stands for what the swap's rule says.
    """
    got = learn(contexts(docs, doc_id, text, source))
    shared = docs.sparkSession.sparkContext.broadcast(got.bigrams)
    lost = F.col(text).rlike(LOST_RE)
    top = got.tables.where("seen >= 0.5").groupBy("source", "cipher", "unit").agg(F.max_by("letters", F.struct("seen", "letters")).alias("letters"))
    maps = materialize(top.groupBy("source", "cipher").agg(F.map_from_entries(F.collect_list(F.struct("unit", "letters"))).alias("map")))  # a cipher's units
    clusters = got.best.select("doc", "source", "cipher").join(sized(maps), ["source", "cipher"], "left").select("doc", "cipher", "map")
    chosen = docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).alias("text"), lost.alias("lost")).join(clusters, "doc", "left").where(F.col("cipher").isNotNull() | F.col("lost"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lm, made = shared.value, {}
        for b in batches:
            out = []
            for t, cipher, pairs in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                if not cipher:
                    out.append(t)
                    continue
                table = tuple(sorted(pairs or ()))
                if (cipher, table) not in made:
                    if len(made) > 200:
                        made.clear()
                    made[cipher, table] = (Translation(dict(table)), {})
                translation, cache = made[cipher, table]
                parts, at = [], 0
                for context, lo, hi in runs(t):
                    if context not in cache:
                        a, unit, b_ = context[0], context[1:-1], context[-1]
                        ways = [(unit, 0.0), (translation.apply(unit), 0.0)] + (decodings(unit, cipher) if cipher != "unknown" else [])
                        cache[context] = max(ways, key=lambda w: (lm.score(a + w[0] + b_) + w[1], w[0] == unit))[0]  # noqa: B023
                    parts += [t[at:lo], cache[context]]
                    at = hi
                out.append("".join([*parts, t[at:]]))
            lost_now = [len(re.findall(LOST_RE, x)) for x in out]
            yield pa.RecordBatch.from_pydict({doc_id: b.column(0), "cipher": b.column(2), "restored": pa.array(out, pa.string()), "left_lost": pa.array(lost_now, pa.int32())})

    return chosen.select("doc", "text", "cipher", "map").mapInArrow(run, f"{doc_id} bigint, cipher string, restored string, left_lost int")
