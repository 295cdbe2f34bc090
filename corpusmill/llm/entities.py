"""Matching entities across sources without keys: firms of a catalog with registrants, each pair with a probability.

1. Every record's names (trade name, web address; legal name, other names) become their own words: lower case, without legal forms and words of the
   trade. Blocking keys are each own word with one letter left out at a time plus another word's initial, and the words written together,
   likewise; so misspelt, swapped and joined names still meet. Different names meet, as numbers, each pair once, however many records carry them; no
   pair is formed without a common key. A key that would make more than HOT_PAIRS pairs is refined by the other words with up to two letters left out,
   which any two similar names share, so none is lost.
2. A pair's evidence is the level at which names agree (by source), and whether city and state agree, differ or are unknown. Levels are turned into
   odds: log likelihood ratios counted on a bounded sample of labelled pairs (LABELLED firms that have a registry number), smoothed by fixed ones.
3. Loopy belief propagation with one-to-one factors over the candidate pairs: a firm tells a registrant how much its other candidates leave, and the
   registrant answers likewise; messages are exchanged by joins and sums until none moves by TOLERANCE, damped if they swing. Marginals at
   MIN_PROBABILITY are matches.

Everything is by pair, none of a record's pairs is collected anywhere, and message sums are combined before the shuffle. Which records of two names that
agree meet is one rule at every size (`_records_of`): those of the same or nearly the same place; those that met nobody there, all others that didn't; those
of unknown places, all. A pair at other places is worse evidence than any at a record's own place, and one of as many equals as the name has records. More
than HOT_PAIRS pairs of two names are made in cells of about that many, so no task makes all pairs of a common name.

Defined results: records without any own word match nothing. Null or broken addresses are unknown places. Several versions of a record pool their names
and places. Exact ties share the probability and thus may match neither. Registrants whose number a firm carries are taken. Rows repeated in the
input change nothing; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import warnings
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.cluster import materialize, sized

LABELLED, TOLERANCE, MIN_PROBABILITY = 20_000, 1e-3, 0.5
#: Rounds after which messages are damped, and rounds after which they are used although they still move, with a warning.
DAMPED, ROUNDS = 20, 200
#: A blocking key that would make more pairs than this is refined; a pair of names that does is split into cells.
HOT_PAIRS = 250_000
#: What is still hot then is compared in so many parts.
SALTS = 32
#: Log odds that a candidate pair is a match before any evidence.
PRIOR = -4.0

# Legal forms and words of the trade, which tell no firm from another.
COMMON_WORDS = frozenset(
    "llc inc corp corporation company co ltd limited lp llp plc pllc pc pa incorporated and the of a an financial finl fin wealth capital retirement tax family private investment investments invt inv asset assets planning advisory advisors advisers advisor adviser adv "
    "partners partner management mgmt mgt office group grp holdings holding insurance trust services service svcs svc securities consulting consultants strategies solutions associates assoc global international national l c p ptnrs ptnr prtnrs advsrs advs advr cap wlth plng plan plans pln ret retmt fam offc ofc prvt pvt invts consult".split()
)
# The postal codes of states.
STATES = dict(zip(
    "alabama alaska arizona arkansas california colorado connecticut delaware florida georgia hawaii idaho illinois indiana iowa kansas kentucky louisiana maine maryland massachusetts michigan minnesota mississippi missouri montana nebraska nevada new_hampshire new_jersey new_mexico new_york north_carolina north_dakota ohio oklahoma oregon pennsylvania rhode_island south_carolina south_dakota tennessee texas utah vermont virginia washington west_virginia wisconsin wyoming district_of_columbia".split(),
    "al ak az ar ca co ct de fl ga hi id il in ia ks ky la me md ma mi mn ms mo mt ne nv nh nj nm ny nc nd oh ok or pa ri sc sd tn tx ut vt va wa wv wi wy dc".split(), strict=True,
))
# Short forms in places' names.
SHORT = {"n": "north", "s": "south", "e": "east", "w": "west", "ft": "fort", "st": "saint", "mt": "mount", "pt": "point", "port": "port"}


def own_words(name: str | None) -> list[str]:
    """A name's words without those that all names have."""
    s = re.sub(r"\b(?:[a-z]\.){2,}", lambda m: m[0].replace(".", ""), (name or "").lower().replace("’", "'").replace("'", ""))
    return [w for w in re.findall(r"[^\W\d_]+", s) if w not in COMMON_WORDS]


def address_words(url: str | None) -> list[str]:
    """The words of a web address's name, without a trade word at its end."""
    m = re.match(r"\s*(?:[a-z]+://)?(?:www\.)?([^/?#:\s]+)", (url or "").lower())
    if not m or "." not in m[1]:
        return []
    return [w for w in m[1].rsplit(".", 1)[0].split(".")[-1].split("-") if w and w not in COMMON_WORDS]


def city_key(city: str | None) -> str:
    words = re.findall(r"[^\W\d_]+", (city or "").lower())
    return " ".join(SHORT.get(w, w) for w in words)


def state_key(state: str | None) -> str:
    s = "_".join(re.findall(r"[^\W\d_]+", (state or "").lower()))
    return STATES.get(s, s)


def _variants(word: Column) -> Column:
    """A word, and it with one letter left out at a time."""
    return F.array_distinct(F.concat(F.array(word), F.transform(F.sequence(F.lit(1), F.greatest(F.length(word), F.lit(1))), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))))))


def _variants2(word: Column) -> Column:
    """A word with up to two letters left out."""
    return F.array_distinct(F.flatten(F.transform(_variants(word), _variants)))


def blocking_keys(words: Column) -> Column:
    """Array of (key, at): the blocking keys of a name's words, with the word that each is made of, -1 for the words written together."""
    joined = F.array_join(words, "")
    together = F.transform(F.when(F.length(joined) >= 4, _variants(joined)).otherwise(F.array(joined)), lambda k: F.struct(F.xxhash64(F.lit("="), k).alias("key"), F.lit(-1).alias("at")))

    def of_word(w: Column, i: Column) -> Column:
        initials = F.array_distinct(F.transform(F.filter(words, lambda _, j: j != i), lambda o: F.substring(o, 1, 1)))
        each = F.flatten(F.transform(_variants(w), lambda k: F.transform(initials, lambda c: F.struct(F.xxhash64(k, c).alias("key"), i.alias("at")))))
        return F.when(F.length(w) >= 4, each).otherwise(F.array().cast("array<struct<key:bigint,at:int>>"))

    return F.array_distinct(F.concat(together, F.flatten(F.transform(words, of_word))))


def keys(words: list[str], spark: SparkSession) -> set[int]:
    """The blocking keys of one name."""
    row = spark.createDataFrame([(words,)], "w array<string>").select(blocking_keys(F.col("w")).alias("k")).first()
    return {k["key"] for k in row["k"]}


def distance(a: str, b: str, most: int) -> int:
    """Edits (insert, delete, replace, swap of neighbours) from a to b, most + 1 if there are more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            d = min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, older[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
    return row[-1]


def name_level(a: list[str], b: list[str]) -> int:
    """4 the same words or letters, 3 other order, 2 misspelt, 1 one word in common, 0 none."""
    if not a or not b:
        return 0
    ja, jb = "".join(a), "".join(b)
    if ja == jb:
        return 4
    if sorted(a) == sorted(b):
        return 3
    if min(len(ja), len(jb)) >= 7 and distance(ja, jb, 2) <= 2:
        return 2
    if len(a) == len(b) >= 2:
        fits = lambda p, q: all(distance(x, y, 2) <= (2 if min(len(x), len(y)) >= 5 else 1) for x, y in zip(p, q, strict=True))
        if fits(a, b) or fits(sorted(a), sorted(b)) or fits(a, b[::-1]):
            return 2
    return 1 if set(a) & set(b) else 0


def place_level(a: tuple[str, str], b: tuple[str, str]) -> tuple[int, int]:
    """(city, state): 2 the same, 1 unknown, 0 different."""
    city = 1 if not a[0] or not b[0] else 2 if a[0] == b[0] or distance(a[0], b[0], 2) <= (2 if len(a[0]) > 5 else 1) else 0
    state = 1 if not a[1] or not b[1] else 2 if a[1] == b[1] else 0
    return city, state


def _named(df: DataFrame) -> DataFrame:
    """(id, kind, name) -> (id, kind, words, name): the own words of each name, and a number for them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [" ".join(address_words(n) if k == "address" else own_words(n)) for k, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(words, pa.string())], ["id", "kind", "words"])

    own = df.where("name is not null").distinct().mapInArrow(run, "id string, kind string, words string").where("words <> ''").distinct()
    return materialize(own.withColumn("name", F.xxhash64("words")))


def _places(df: DataFrame) -> DataFrame:
    """(id, city, state) -> the same, normalized."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([city_key(c) for c in b.column(1).to_pylist()], pa.string()), pa.array([state_key(s) for s in b.column(2).to_pylist()], pa.string())], ["id", "city", "state"])

    return df.select("id", "city", "state").distinct().mapInArrow(run, "id string, city string, state string").distinct()


def _placed(df: DataFrame) -> DataFrame:
    """The known places."""
    return _places(df).where("city <> '' and state <> ''")


def _meeting(a: DataFrame, b: DataFrame, hot_pairs: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From (name, key, at) of both sides the pairs (na, nb) of keys with at most hot_pairs pairs, and the rows of both sides of the other keys."""
    counts = a.groupBy("key").agg(F.count("*").alias("ka")).join(b.groupBy("key").agg(F.count("*").alias("kb")), "key")
    hot = materialize(counts.where(F.col("ka") * F.col("kb") > hot_pairs).select("key"))
    n = hot.count()
    side = sized(hot, n)
    cold_a, cold_b = (a, b) if not n else (df.join(side, "key", "left_anti") for df in (a, b))
    met = cold_a.select("key", F.col("name").alias("na")).join(cold_b.select("key", F.col("name").alias("nb")), "key").select("na", "nb")
    return met, a.join(side, "key", "left_semi"), b.join(side, "key", "left_semi")


def name_pairs(left: DataFrame, right: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """(na, nb, level) of all pairs of different names with a key in common and level 2 at least. left and right: what `_named` gives."""
    words = [df.select("name", "words").distinct() for df in (left, right)]
    keyed = [materialize(w.select("name", F.inline(blocking_keys(F.split("words", " "))))) for w in words]
    met, hot_a, hot_b = _meeting(*keyed, hot_pairs)
    if not hot_a.isEmpty():
        # names that are similar share each other word, and the words together, within two letters
        refined = []
        for hot, w in ((hot_a, words[0]), (hot_b, words[1])):
            own = hot.join(w, "name").withColumn("w", F.split("words", " "))
            others = F.filter("w", lambda _, j: j != F.col("at"))
            again = F.array_distinct(F.concat(_variants2(F.array_join("w", "")), F.when(F.col("at") >= 0, F.flatten(F.transform(others, _variants2))).otherwise(F.array().cast("array<string>"))))
            refined.append(materialize(own.select("name", F.explode(F.transform(again, lambda k: F.xxhash64("key", k))).alias("key")).distinct().withColumn("at", F.lit(0))))
        more, rest_a, rest_b = _meeting(*refined, hot_pairs)
        met = met.unionByName(more)
        if not rest_a.isEmpty():
            salted = rest_a.withColumn("salt", F.pmod(F.xxhash64("name"), F.lit(SALTS))).join(rest_b.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).select("key", "salt", F.col("name").alias("nb")), ["key", "salt"])
            met = met.unionByName(salted.select(F.col("name").alias("na"), "nb"))

    def level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = pa.array([name_level(x.split(), y.split()) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)], pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), got], ["na", "nb", "level"])

    by_name = [materialize(w) for w in words]
    both = met.distinct().join(sized(by_name[0].select(F.col("name").alias("na"), F.col("words").alias("wa"))), "na").join(sized(by_name[1].select(F.col("name").alias("nb"), F.col("words").alias("wb"))), "nb")
    return materialize(both.select("na", "nb", "wa", "wb").mapInArrow(level, "na bigint, nb bigint, level int").where("level >= 2"))  # one common word is no candidate


def _near_places(a: DataFrame, b: DataFrame) -> DataFrame:
    """(pa, pb): the numbers of known places of both sides, (city, state, place), that are the same or nearly the same."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            ok = pa.array([place_level((ca, ""), (cb, ""))[0] == 2 for ca, cb in zip(x.column(2).to_pylist(), x.column(3).to_pylist(), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([x.column(0).filter(ok), x.column(1).filter(ok)], ["pa", "pb"])

    # places within a letter or two have a spelling with up to two letters left out in common
    spelt_a, spelt_b = (df.select("city", "state", "place").distinct().select(F.col("place").alias(f"p{i}"), F.col("city").alias(f"c{i}"), F.explode(F.transform(_variants2(F.col("city")), lambda c: F.xxhash64(c, F.col("state")))).alias("key")) for df, i in ((a, "a"), (b, "b")))
    met = spelt_a.join(spelt_b, "key").select("pa", "pb", "ca", "cb").distinct()
    return materialize(met.mapInArrow(near, "pa bigint, pb bigint"))


def _all_of(pairs: DataFrame, a: DataFrame, b: DataFrame, hot_pairs: int) -> DataFrame:
    """(a, b, ka, kb, level): the records of (a, ka, na, sa) with those of (b, kb, nb, sb) for each pair of names, where the states sa and sb let them meet.
    More than hot_pairs of one pair of names are made in cells of about that many, with the same result."""
    columns = ["a", "b", "ka", "kb", "level"]
    counts = pairs.join(a.groupBy("na", "sa").agg(F.count("*").alias("ra")), "na").join(b.groupBy("nb", "sb").agg(F.count("*").alias("rb")), "nb")
    counted = materialize(counts.where("sa = 'lost' or sb = 'lost' or sa = 'open' and sb = 'open'"))
    is_hot = F.col("ra") * F.col("rb") > hot_pairs
    usual = counted.where(~is_hot).join(a, ["na", "sa"]).join(b, ["nb", "sb"]).select(*columns)
    side = max(1, math.isqrt(hot_pairs))
    hot = counted.where(is_hot).withColumns({"pa": F.ceil(F.col("ra") / side), "pb": F.ceil(F.col("rb") / side)})
    n = hot.count()
    if not n:
        return usual
    part = lambda i, parts: F.pmod(F.xxhash64(i), F.col(parts))
    each = lambda parts: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(parts) - 1))
    cell = ["na", "nb", "sa", "sb", "i", "j"]
    cells_a = a.join(sized(hot, n), ["na", "sa"]).select("na", "nb", "sa", "sb", "level", "a", "ka", part("a", "pa").alias("i"), each("pb").alias("j"))
    cells_b = b.join(sized(hot, n), ["nb", "sb"]).select("na", "nb", "sa", "sb", "b", "kb", part("b", "pb").alias("j"), each("pa").alias("i"))
    return usual.unionByName(cells_a.join(cells_b, cell).select(*columns))


def _records_of(pairs: DataFrame, left: DataFrame, right: DataFrame, places_a: DataFrame, places_b: DataFrame, hot_pairs: int) -> DataFrame:
    """(a, b, ka, kb, level): the records that carry the names of each pair. Records of the same or nearly the same place meet; those that met nobody
    there meet all others that didn't, at whatever place; those of unknown places meet all. This holds for any number of records."""
    a = left.select(F.col("id").alias("a"), F.col("kind").alias("ka"), F.col("name").alias("na"))
    b = right.select(F.col("id").alias("b"), F.col("kind").alias("kb"), F.col("name").alias("nb"))
    known_a, known_b = (materialize(_placed(df).withColumn("place", F.xxhash64("city", "state"))) for df in (places_a, places_b))
    at_a, at_b = (known.select(F.col("id").alias(i), F.col("place").alias(f"p{i}")) for known, i in ((known_a, "a"), (known_b, "b")))
    near = pairs.join(a.join(at_a, "a"), "na").join(sized(_near_places(known_a, known_b)), "pa").join(b.join(at_b, "b"), ["nb", "pb"])
    near = materialize(near.select("a", "b", "ka", "kb", "level").distinct())

    def stated(x: DataFrame, at: DataFrame, i: str) -> DataFrame:
        known = at.select(i).distinct().join(near.select(i).distinct().withColumn("_met", F.lit(True)), i, "left").select(i, F.when(F.col("_met"), F.lit("met")).otherwise(F.lit("open")).alias("_state"))
        return materialize(x.join(known, i, "left").withColumn(f"s{i}", F.coalesce("_state", F.lit("lost"))).drop("_state"))

    return near.unionByName(_all_of(pairs, stated(a, at_a, "a"), stated(b, at_b, "b"), hot_pairs))


def candidate_pairs(names_a: DataFrame, names_b: DataFrame, places_a: DataFrame, places_b: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """(a, b, name, other, address, city, state): the levels of agreement of all pairs with a common blocking key.

    names: (id, kind, name) with kind name, other or address; places: (id, city, state).
    """
    left, right = _named(names_a), _named(names_b)
    levels = _records_of(name_pairs(left, right, hot_pairs), left, right, places_a, places_b, hot_pairs)
    at = lambda cond: F.coalesce(F.max(F.when(cond, F.col("level"))), F.lit(0))
    best = materialize(levels.groupBy("a", "b").agg(
        at((F.col("ka") == "name") & (F.col("kb") == "name")).alias("name"),
        at((F.col("ka") == "name") & (F.col("kb") == "other")).alias("other"),
        at(F.col("ka") == "address").alias("address"),
    ))
    place_a, place_b = (_places(df).select(F.col("id").alias(i), F.col("city").alias(f"c{i}"), F.col("state").alias(f"s{i}")) for df, i in ((places_a, "a"), (places_b, "b")))
    located = best.select("a", "b").join(place_a, "a", "left").join(place_b, "b", "left")
    none = lambda c: F.coalesce(c, F.lit("")) == ""
    state = F.when(none(F.col("sa")) | none(F.col("sb")), 1).when(F.col("sa") == F.col("sb"), 2).otherwise(0)
    # edits with swaps of neighbours are judged in Python, where plain edits (a swap counts two) leave it open
    edits = F.levenshtein("ca", "cb", 4)
    sure = F.when(none(F.col("ca")) | none(F.col("cb")), 1).when(F.col("ca") == F.col("cb"), 2).when((edits < 0) | (edits > 4), 0)
    rated = located.withColumn("city", sure).withColumn("state", state)

    def cities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            got = pa.array([place_level((ca, ""), (cb, ""))[0] for ca, cb in zip(x.column(0).to_pylist(), x.column(1).to_pylist(), strict=True)], pa.int32())
            yield pa.RecordBatch.from_arrays([x.column(0), x.column(1), got], ["ca", "cb", "judged"])

    open_ = materialize(rated.where("city is null").select("ca", "cb").distinct().mapInArrow(cities, "ca string, cb string, judged int"))
    rated = rated.join(sized(open_), ["ca", "cb"], "left").withColumn("place", F.coalesce("city", "judged") * 3 + F.col("state"))
    # the best place is the one with the most agreement; a place that differs on one snapshot may be an old one
    rank = F.floor(F.col("place") / 3) + F.col("place") % 3
    place = rated.groupBy("a", "b").agg(F.max_by("place", F.struct(rank, "place")).alias("place"))
    return best.join(place, ["a", "b"]).select("a", "b", "name", "other", "address", F.floor(F.col("place") / 3).cast("int").alias("city"), (F.col("place") % 3).cast("int").alias("state"))


def evidence(pairs: DataFrame) -> DataFrame:
    """Adds the two pieces of evidence: how names agree and how places do."""
    name = F.when(F.col("name") >= 2, F.concat(F.lit("name "), F.col("name"))).when(F.col("other") >= 2, F.concat(F.lit("other "), F.col("other"))).otherwise(F.concat(F.lit("address "), F.col("address")))
    return pairs.withColumn("names", name).withColumn("places", F.concat_ws(" ", "city", "state"))


# Log likelihood ratios before any label is seen, and how many labelled pairs they are worth.
NAMES_BEFORE = {"name 4": 5.0, "name 3": 4.0, "name 2": 3.0, "other 4": 4.5, "other 3": 3.5, "other 2": 2.5, "address 4": 4.5, "address 3": 4.0, "address 2": 2.0}
PLACES_BEFORE = {"2 2": 4.0, "2 1": 3.0, "2 0": -2.0, "1 2": 2.0, "1 1": 0.5, "1 0": -5.0, "0 2": -2.0, "0 1": -3.0, "0 0": -6.0}
WORTH = 5.0


def weights(pairs: DataFrame, labels: DataFrame | None) -> tuple[dict[str, float], dict[str, float], float]:
    """The log likelihood ratios of names and places and the log prior odds, from the pairs of labelled firms: labels is (a, b), at most LABELLED firms of it are used."""
    if labels is None:
        return dict(NAMES_BEFORE), dict(PLACES_BEFORE), PRIOR
    known = labels.orderBy(F.xxhash64("a")).limit(LABELLED)
    seen = pairs.join(known.select("a", F.col("b").alias("true")).distinct(), "a").withColumn("is", (F.col("b") == F.col("true")).cast("int"))
    counted = [tuple(r) for r in seen.groupBy("names", "places").agg(F.sum("is"), F.sum(1 - F.col("is"))).collect()]  # 9 x 9 at most
    yes, no = sum(r[2] for r in counted), sum(r[3] for r in counted)
    out = []
    for k, before in ((0, NAMES_BEFORE), (1, PLACES_BEFORE)):
        # the fixed ratios as the counts of WORTH pairs of either kind
        p1, p0 = _softmax({x: b / 2 for x, b in before.items()}), _softmax({x: -b / 2 for x, b in before.items()})
        fit = {}
        for x in before:
            y, n = sum(r[2] for r in counted if r[k] == x), sum(r[3] for r in counted if r[k] == x)
            fit[x] = math.log((y + WORTH * p1[x]) / (yes + WORTH)) - math.log((n + WORTH * p0[x]) / (no + WORTH))
        out.append(fit)
    return out[0], out[1], math.log((yes + WORTH) / (no + WORTH * math.exp(-PRIOR)))


def _softmax(x: dict[str, float]) -> dict[str, float]:
    whole = sum(math.exp(v) for v in x.values())
    return {k: math.exp(v) / whole for k, v in x.items()}


def marginals(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(a, b, probability) of edges (a, b, odds): loopy belief propagation with the factors 'a has one b or none' and 'b has one a or none'."""
    state = materialize(edges.select("a", "b", "odds", F.lit(1.0).alias("nu")))
    moved = 0.0
    for k in range(rounds):
        out = state.groupBy("a").agg(F.sum(F.col("odds") * F.col("nu")).alias("all_a"))
        mu = state.join(out, "a").withColumn("mu", F.col("odds") / (1 + F.greatest(F.lit(0.0), F.col("all_a") - F.col("odds") * F.col("nu"))))
        back = mu.groupBy("b").agg(F.sum("mu").alias("all_b"))
        new = mu.join(back, "b").withColumn("new", 1 / (1 + F.greatest(F.lit(0.0), F.col("all_b") - F.col("mu"))))
        if k >= DAMPED:
            new = new.withColumn("new", (F.col("new") + F.col("nu")) / 2)
        state = materialize(new.select("a", "b", "odds", F.col("new").alias("nu"), F.abs(F.col("new") - F.col("nu")).alias("moved")))
        moved = state.agg(F.max("moved")).first()[0] or 0.0
        if moved < TOLERANCE:
            break
    else:
        warnings.warn(f"messages still move by {moved:.3g} after {rounds} rounds", stacklevel=2)
    out = state.groupBy("a").agg(F.sum(F.col("odds") * F.col("nu")).alias("all_a"))
    return state.join(out, "a").select("a", "b", (F.col("odds") * F.col("nu") / (1 + F.col("all_a"))).alias("probability"))


ADDRESS = "officeAddress struct<city:string,state:string>, city string, state string"


def match_firms(metadata: DataFrame, hits: DataFrame, known_too: bool = False) -> DataFrame:
    """(slug, firm_source_id, probability) of the candidate pairs of firms without a registry number; known_too judges all firms, for measuring."""
    known = metadata.where(F.trim(F.coalesce("crd_number", F.lit(""))) != "").select(F.col("slug").alias("a"), F.trim("crd_number").alias("b")).distinct()
    m = metadata.where("slug is not null")
    h = hits.where("firm_source_id is not null")
    names_a = m.select(F.col("slug").alias("id"), F.lit("name").alias("kind"), F.col("competitor").alias("name")).union(m.select("slug", F.lit("address"), "website"))
    names_b = h.select(F.col("firm_source_id").alias("id"), F.lit("name").alias("kind"), F.col("firm_name").alias("name")).union(h.select("firm_source_id", F.lit("other"), F.explode("firm_other_names")))
    address = F.from_json("firm_ia_address_details", ADDRESS)
    places_a = m.select(F.col("slug").alias("id"), F.col("headquarters_city").alias("city"), F.col("headquarters_state").alias("state"))
    places_b = h.select(F.col("firm_source_id").alias("id"), F.coalesce(address["officeAddress"]["city"], address["city"]).alias("city"), F.coalesce(address["officeAddress"]["state"], address["state"]).alias("state"))
    pairs = materialize(evidence(candidate_pairs(names_a, names_b, places_a, places_b)))
    by_name, by_place, prior = weights(pairs, known)
    table = lambda col, d: F.coalesce(*[F.when(F.col(col) == k, F.lit(float(v))) for k, v in d.items()], F.lit(0.0))
    if not known_too:
        pairs = pairs.join(known.select("a"), "a", "left_anti").join(known.select("b"), "b", "left_anti")
    edges = pairs.withColumn("odds", F.exp(prior + table("names", by_name) + table("places", by_place)))
    return marginals(edges).select(F.col("a").alias("slug"), F.col("b").alias("firm_source_id"), "probability")


def matches(metadata: DataFrame, hits: DataFrame) -> DataFrame:
    return match_firms(metadata, hits).where(F.col("probability") >= MIN_PROBABILITY)


