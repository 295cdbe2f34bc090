"""Evaluation texts leaking into training text.

1. The stated query set (evaluation items) is indexed. Items of the same text are one, with all their ids. Questions that several texts share are left
   out; windows of WINDOW words slide over the rest of each text, each with a 64-bit SimHash of its words. Weights (rarity of words and of pairs of words)
   are counted over the whole query set, so no item's result depends on how the set is cut into blocks of ITEM_BLOCK texts.
2. Each document is read once, in Arrow batches: folded to lower case without accents, split into words, mapped to the index's vocabulary. Windows whose
   words all stand in it get SimHashes. A piece that step 4 accepts has WINDOW words in a row unchanged: with more than one in 5.5 words changed, its
   share of words and pairs of words falls below MIN_SIMILARITY.
3. Multi-index Hamming search: the 64 bits are cut into RADIUS + 1 blocks, so that two fingerprints within RADIUS agree in one block at least
   (pigeonhole); every pair that agrees in a block is compared in full. A block has 16 bits, so a window meets few of a large set's fingerprints.
4. Hits around which at least MIN_NEAR words agree, at their place or SHIFT words off it, are verified exactly on the whole words around them: matching
   runs are chained in order, and the chain must cover a piece of the item of PIECE_WORDS words with a weighted share of MIN_SIMILARITY. Words and pairs
   of words weigh by their rarity among the items, so a sentence frame that many items share is no match without the item's own names and numbers.
   Where even all words and pairs of the item that stand anywhere around the hits would not reach that share, nothing is aligned: `reachable` is an upper
   bound, so this loses no match. Most hits are such frames.

Documents never meet each other and nothing is shuffled but the found pairs. The corpus is read once for each ITEM_BLOCK texts of the query set.

Defined results: null or empty texts leak nothing. An item of less than PIECE_WORDS words of its own counts where all of it stands literally; one of less than WINDOW
can't be told from a phrase and is reported by `too_short`. Whole texts are searched, however long. Ties (a piece that two items share
literally, items of the same text) give both items. Rows repeated in the input give one result. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A piece counts from so many words (TESTDATA.md) and with so much of its weight. A piece that lost a word or two at its ends must match all but literally:
#: sentence frames that two items share with one place and thing in common are about as long.
PIECE_WORDS, MIN_SIMILARITY, EXACT_SIMILARITY = 15, 0.74, 0.92
WINDOW, RADIUS, ITEM_BLOCK = 5, 3, 100_000
MIN_WORDS = 13
#: Around a hit, within REACH words on either side, so many words must agree with the item's at their place or SHIFT words off it; shorter items need all but two.
MIN_NEAR, REACH, SHIFT = 9, 16, 2
#: Words between two matching runs of one chain, on either side.
MAX_GAP = 5


def fold(texts: pa.Array) -> pa.Array:
    """Lower case, without accents, with numbers written together."""
    t = pc.utf8_normalize(pc.utf8_lower(texts), form="NFKD")
    t = pc.replace_substring_regex(t, r"([a-z])[-\x{2010}]\s*\n\s*([a-z])", r"\1\2")  # a word broken at a line's end
    t = pc.replace_substring_regex(t, r"[\x{300}-\x{36f}\x{ad}\x{200b}-\x{200d}\x{feff}]+", "")
    return pc.replace_substring_regex(t, r"([0-9]),([0-9])", r"\1\2")


def words(texts: pa.Array) -> pa.Array:
    return pc.split_pattern_regex(fold(texts), r"[^\p{L}\p{N}]+")


def _all_words(texts: list[str]) -> Iterator[list[str]]:
    """The words of each text, folded and split together: expressions are compiled once a call."""
    return ([w for w in x.as_py() if w] for x in words(pa.array(texts, pa.string())))


def _words(text: str) -> list[str]:
    return next(_all_words([text]))


def questionless(texts: list[str]) -> list[list[str]]:
    """The words of each of some different texts, without questions that texts share."""
    sentences_of = [re.split(r"(?<=[.?!])\s+", t) for t in texts]
    split = _all_words([x for sentences in sentences_of for x in sentences])
    cut = [[(next(split), x.rstrip().endswith("?")) for x in sentences] for sentences in sentences_of]
    seen: Counter = Counter(k for sentences in cut for k in {tuple(ws) for ws, asks in sentences if asks})
    return [[w for ws, asks in sentences if not asks or seen[tuple(ws)] == 1 for w in ws] for sentences in cut]


@dataclass
class Items:
    """The query set: different texts with their ids and words, and weights counted over all of them."""

    ids: list[list[int]]
    words: list[list[str]]
    df: Counter
    pair_df: Counter


def query_set(items: Iterable[tuple[int, str | None]]) -> Items:
    by_words: dict[str, tuple[str, set[int]]] = {}
    given = [(i, t) for i, t in items if t]
    for (i, t), ws in zip(given, _all_words([t for _, t in given]), strict=True):
        if key := " ".join(ws):
            by_words.setdefault(key, (t, set()))[1].add(i)
    owned = questionless([t for t, _ in by_words.values()])
    df: Counter = Counter(w for ws in owned for w in set(ws))
    pair_df: Counter = Counter(p for ws in owned for p in set(zip(ws, ws[1:], strict=False)))
    return Items([sorted(ids) for _, ids in by_words.values()], owned, df, pair_df)


@dataclass
class ItemIndex:
    """What every task gets: bounded by ITEM_BLOCK texts."""

    ids: list[list[int]]
    begins: np.ndarray  # where each text's words begin in flat, and the end
    flat: np.ndarray  # all texts' words in a row, as numbers of the vocabulary
    weight: np.ndarray  # of each word in flat
    pair_weight: np.ndarray  # of each word in flat with the next one
    vocabulary: list[str]
    prints: np.ndarray
    place_of: np.ndarray  # where in flat each fingerprint's window begins


def simhash(ids: np.ndarray, starts: np.ndarray, length: int, signs: np.ndarray) -> np.ndarray:
    """The SimHash of the windows of `length` words that begin at starts."""
    total = np.zeros((len(starts), 64), np.int8)
    for k in range(length):
        total += signs[ids[starts + k]]
    return np.packbits(total > 0, axis=1, bitorder="little").view(np.uint64).ravel()


def signs_of(vocabulary: list[str]) -> np.ndarray:
    """64 signs for each word, the same ones in every block and task."""
    hashes = np.array([int.from_bytes(blake2b(w.encode(), digest_size=8).digest(), "little") for w in vocabulary], np.uint64)
    return (np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int8) * 2 - 1) if len(hashes) else np.zeros((0, 64), np.int8)


def build_index(items: Items, first: int = 0, last: int | None = None) -> ItemIndex:
    """The index of the texts from first to last; texts of less than WINDOW words have none."""
    picked = [k for k in range(first, min(len(items.ids), len(items.ids) if last is None else last)) if len(items.words[k]) >= WINDOW]
    vocabulary = sorted({w for k in picked for w in items.words[k]})
    number = {w: n for n, w in enumerate(vocabulary)}
    n = max(2, len(items.ids))
    rare = lambda df: math.log(n / df) / math.log(n)
    flat, weight, pair_weight, begins, starts = [], [], [], [0], []
    for k in picked:
        ws = items.words[k]
        starts += range(len(flat), len(flat) + len(ws) - WINDOW + 1)
        flat += [number[w] for w in ws]
        weight += [max(0.1, rare(items.df[w])) for w in ws]
        pair_weight += [*(max(0.0, rare(items.pair_df[p])) for p in zip(ws, ws[1:], strict=False)), 0.0]
        begins.append(len(flat))
    ids, places = np.array(flat, np.int64), np.array(starts, np.int64)
    prints = simhash(ids, places, WINDOW, signs_of(vocabulary)) if len(places) else np.zeros(0, np.uint64)
    return ItemIndex([items.ids[k] for k in picked], np.array(begins, np.int64), ids, np.array(weight), np.array(pair_weight), vocabulary, prints, places)


_EDGES = np.linspace(0, 64, RADIUS + 2).round().astype(int)


class HammingIndex:
    """All fingerprints within RADIUS, by RADIUS + 1 blocks of bits."""

    def __init__(self, prints: np.ndarray):
        self.prints, self.blocks = prints, []
        for lo, hi in zip(_EDGES, _EDGES[1:], strict=False):
            key = (prints >> np.uint64(lo)) & np.uint64((1 << int(hi - lo)) - 1)
            order = np.argsort(key, kind="stable")
            bounds = np.searchsorted(key[order], np.arange((1 << int(hi - lo)) + 1, dtype=np.uint64))
            self.blocks.append((int(lo), int(hi), order, bounds))

    def near(self, queries: np.ndarray, step: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
        """(query, print) pairs within the radius, perhaps more than once."""
        out_q, out_p = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in range(0, len(queries), step):
            q = queries[at : at + step]
            for lo, hi, order, bounds in self.blocks:
                key = ((q >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)).astype(np.int64)
                first, n = bounds[key], bounds[key + 1] - bounds[key]
                which = np.repeat(np.arange(len(q)), n)
                hit = order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)]
                ok = np.bitwise_count(q[which] ^ self.prints[hit]) <= RADIUS
                out_q.append(which[ok] + at)
                out_p.append(hit[ok])
        return np.concatenate(out_q), np.concatenate(out_p)


def similarity(index: ItemIndex, item: int, doc: list[int]) -> tuple[int, float]:
    """The best chain of matching runs of an item in a stretch of a document: (words of the item it spans, weighted share that matches)."""
    lo_item, hi_item = int(index.begins[item]), int(index.begins[item + 1])
    own, weight, pair_weight = index.flat[lo_item:hi_item].tolist(), index.weight[lo_item:hi_item].tolist(), index.pair_weight[lo_item:hi_item].tolist()
    chain: list[tuple[int, int, int]] = []
    best = (0, 0.0)

    def judge() -> None:
        nonlocal best
        lo, hi = chain[0][0], chain[-1][0] + chain[-1][2]
        held = {p for a, _, n in chain for p in range(a, a + n)}
        pairs = {p for a, _, n in chain for p in range(a, a + n - 1)}
        whole = part = 0.0
        for p in range(lo, hi):
            whole += weight[p]
            part += weight[p] * (p in held)
            if p + 1 < hi:
                whole += pair_weight[p]
                part += pair_weight[p] * (p in pairs)
        found = (hi - lo, part / whole if whole else 0.0)
        if min(found[0], MIN_WORDS) * found[1] > min(best[0], MIN_WORDS) * best[1]:
            best = found

    for a, b, n in SequenceMatcher(None, own, doc, autojunk=False).get_matching_blocks():
        if not n:
            continue
        if chain and (a - chain[-1][0] - chain[-1][2] > MAX_GAP or b - chain[-1][1] - chain[-1][2] > MAX_GAP):
            judge()
            chain = []
        chain.append((a, b, n))
    if chain:
        judge()
    return best


_PAIRS = 1 << 16


def _pair_keys(ids: np.ndarray) -> np.ndarray:
    """A number below _PAIRS for each word with the next one; other pairs may have the same."""
    return (ids[:-1] * 40_503 + ids[1:]) & (_PAIRS - 1)


def reachable(index: ItemIndex, item: int, doc: np.ndarray, has_word: np.ndarray, has_pair: np.ndarray) -> bool:
    """Whether any chain in a stretch of a document could be accepted: if not, no piece of the item of MIN_WORDS words (or the whole of a shorter one) would
    have MIN_SIMILARITY if every word and pair that stands anywhere in the stretch matched. has_word (of the vocabulary and one more) and has_pair
    (_PAIRS) are all false, before and after."""
    lo, hi = int(index.begins[item]), int(index.begins[item + 1])
    own, pairs = index.flat[lo:hi], _pair_keys(doc)
    has_word[doc] = has_pair[pairs] = True
    word = index.weight[lo:hi] * (has_word[own] - MIN_SIMILARITY)
    pair = index.pair_weight[lo : hi - 1] * (has_pair[_pair_keys(own)] - MIN_SIMILARITY)
    has_word[doc] = has_pair[pairs] = False
    ends = np.cumsum(word)  # what all words up to each one have above MIN_SIMILARITY, with the pairs of these words
    ends[1:] += np.cumsum(pair)
    before = ends - word  # what is left out by a piece that begins at each word: also the pair with the word before it
    n = min(MIN_WORDS, hi - lo)
    return bool((ends[n - 1 :] - np.minimum.accumulate(before[: hi - lo - n + 1])).max() >= -1e-9)


def _near(index: ItemIndex, ids: np.ndarray, rows: np.ndarray, at: np.ndarray, place: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Which hits have MIN_NEAR agreeing words around them; at and place are where the windows begin in the document's and the item's words."""
    along = np.arange(-REACH, WINDOW + REACH)
    theirs = place[:, None] + along
    inside = (theirs >= index.begins[item][:, None]) & (theirs < index.begins[item + 1][:, None])
    words = index.flat[np.clip(theirs, 0, len(index.flat) - 1)]
    agree = np.zeros(theirs.shape, bool)
    for shift in range(-SHIFT, SHIFT + 1):
        mine = at[:, None] + along + shift
        ok = (mine >= 0) & (mine < len(ids))
        mine = np.clip(mine, 0, len(ids) - 1)
        agree |= ok & (rows[mine] == rows[at][:, None]) & (ids[mine] == words)
    own = index.begins[item + 1] - index.begins[item]
    return (agree & inside).sum(1) >= np.minimum(MIN_NEAR, own - 2)


def search_batch(index: ItemIndex, near: HammingIndex, signs: np.ndarray, vocabulary: pa.Array, texts: pa.Array, step: int = 100_000) -> list[tuple[int, int, int, float]]:
    """(row of the batch, item's place in the index, words, similarity) of all verified leaks, without those that can't be accepted."""
    split = words(texts)
    if isinstance(split, pa.ChunkedArray):
        split = split.combine_chunks()
    flat = split.flatten()
    offsets = np.diff(split.offsets.to_numpy())
    rows = np.repeat(np.arange(len(texts)), offsets)
    solid = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    ids = pc.fill_null(pc.index_in(flat, value_set=vocabulary), len(vocabulary)).to_numpy(zero_copy_only=False).astype(np.int64)[solid]
    rows = rows[solid]
    n = len(ids) - WINDOW + 1
    if n <= 0:
        return []
    unknown = np.concatenate([[0], np.cumsum(ids == len(vocabulary))])
    starts = np.flatnonzero((unknown[WINDOW:] == unknown[:-WINDOW]) & (rows[:n] == rows[WINDOW - 1 :]))
    places: dict[tuple[int, int], set[int]] = defaultdict(set)
    for lo in range(0, len(starts), step):
        part = starts[lo : lo + step]
        q, p = near.near(simhash(ids, part, WINDOW, signs))
        at, place = part[q], index.place_of[p]
        item = np.searchsorted(index.begins, place, "right") - 1
        for k in range(0, len(at), step):
            a, i = at[k : k + step], item[k : k + step]
            ok = _near(index, ids, rows, a, place[k : k + step], i)
            for s, e in zip(a[ok].tolist(), i[ok].tolist(), strict=True):
                places[int(rows[s]), e].add(s)
    first = np.searchsorted(rows, np.arange(len(texts)), "left")
    last = np.searchsorted(rows, np.arange(len(texts)), "right")
    has_word, has_pair = np.zeros(len(vocabulary) + 1, bool), np.zeros(_PAIRS, bool)
    out = []
    for (row, item), hits in places.items():
        own = int(index.begins[item + 1] - index.begins[item])
        spans: list[list[int]] = []
        for s in sorted(hits):  # stretches of the document around hits that lie close together
            if spans and s <= spans[-1][1]:
                spans[-1][1] = s + own
            else:
                spans.append([s, s + own])
        stretches = [ids[max(int(first[row]), lo - own) : min(int(last[row]), hi + WINDOW)] for lo, hi in spans]
        if any(reachable(index, item, x, has_word, has_pair) for x in stretches):
            out.append((row, item, *max((similarity(index, item, x.tolist()) for x in stretches), key=lambda x: min(x[0], MIN_WORDS) * x[1])))
    return out


def leak_scores(docs: DataFrame, index: ItemIndex, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, words, own, similarity) of the verified hits of one block of items that may be accepted; own is the item's number of words."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared.value
        near, signs, vocabulary = HammingIndex(ix.prints), np.vstack([signs_of(ix.vocabulary), np.zeros((1, 64), np.int8)]), pa.array(ix.vocabulary, pa.string())
        for b in batches:
            found = [(row, i, n, int(ix.begins[item + 1] - ix.begins[item]), share) for row, item, n, share in (search_batch(ix, near, signs, vocabulary, b.column(1)) if ix.ids else ()) for i in ix.ids[item]]
            if found:
                row, item, n, own, share = zip(*found, strict=True)
                yield pa.RecordBatch.from_pydict({"doc_id": b.column(0).take(pa.array(row)), "item_id": pa.array(item, pa.int64()), "words": pa.array(n, pa.int32()), "own": pa.array(own, pa.int32()), "similarity": pa.array(share, pa.float64())})

    return docs.where(F.col(text) != "").select(F.col(doc_id).cast("bigint").alias("doc_id"), text).mapInArrow(run, "doc_id bigint, item_id bigint, words int, own int, similarity double")


def _query_rows(items: DataFrame) -> Iterator[tuple[int, str]]:
    return ((r[0], r[1]) for r in items.select("item_id", "text").where("text is not null").distinct().orderBy("item_id", "text").toLocalIterator())


def too_short(items: DataFrame) -> list[int]:
    """The ids of items with less than WINDOW words of their own, which can't be searched for."""
    found = query_set(_query_rows(items))
    return sorted(i for ids, ws in zip(found.ids, found.words, strict=True) if len(ws) < WINDOW for i in ids)


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = ITEM_BLOCK) -> DataFrame:
    """(doc_id, item_id, words, similarity): the corpus documents that hold an item's passage or a piece of it. The items are the stated query
    set and come to the driver; a set of more than `block` texts is searched for in as many passes, with the same result."""
    known = query_set(_query_rows(items))
    parts = [leak_scores(docs, build_index(known, at, at + block), doc_id, text) for at in range(0, max(1, len(known.ids)), block)]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    literal = (F.col("words") >= F.least(F.lit(MIN_WORDS), F.col("own"))) & (F.col("similarity") >= EXACT_SIMILARITY)
    good = found.where(((F.col("words") >= PIECE_WORDS) & (F.col("similarity") >= MIN_SIMILARITY)) | literal)
    return good.groupBy("doc_id", "item_id").agg(F.max("words").alias("words"), F.max("similarity").alias("similarity"))
