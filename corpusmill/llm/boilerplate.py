"""Main content of web pages: wrappers of each host by union-free regular expressions, and what lies outside their fixed parts.

1. `streams`: a page is a stream of lines, each brought to a canonical wording (numbers, the firm's own names and addresses become marks, a path or
   list of labels keeps its first). Hosts with many pages are split by url into chunks of about CHUNK pages, so no host is one task.
2. `infer_wrapper`: the streams of a chunk are aligned one after another with the expression found so far, by longest common subsequences. Lines that
   match in order stay tokens; lines that one side lacks become optional groups; runs of lines that nothing matches become text slots, repeated where
   they differ in length. A line's support is the number of streams that its token was aligned in: a wording that comes back at other places, in
   another order, is no part of the expression. The expressions of a split host's chunks are added up (`host_wrappers`) before anything is judged.
3. On hosts of three pages and more the expression decides first: tokens in at least MIN_SUPPORT of the streams are fixed, and furniture. What it leaves open
   (optional groups, slots, hosts of one or two pages) is judged by what the expressions of all hosts say about the wording (`wordings`): it is furniture if
   streams that were aligned on it once mostly were again (cohesion). Content that recurs on many hosts (a common heading, a common sentence)
   has none, so it isn't mistaken for furniture however frequent it is. Where that tells nothing, a line's form is judged.
4. Boxes that point elsewhere are a fixed header with a repeated text slot. Headers are found as furniture that lines of one kind follow; how far a
   slot reaches is decided by naive Bayes on the words of lines that follow a header at once, against lines of main content.
5. Pages whose content is replaced by errors, notices or filler (residue.py) give no rows.

All counts are taken on all pages. Up to TABLE_ROWS wordings, headers, forms and features of box lines are broadcast; more are joined to their pages, the
frequent ones (HOT) by broadcast, with the same result.

Defined results: null and empty bodies give no rows; blank lines are never rows. A null url groups by firm, a page with neither stands alone.
Pages captured again count once per url and each get their rows. Rows repeated in the input give one result; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.cluster import materialize, sized
from corpusmill.llm import residue

CHUNK = 48
#: Cohesion from which a wording of several hosts is furniture, and the chances it must have had to recur; share of the streams from which a token of its own host's wrapper is.
MIN_COHESION, MIN_CHANCES, MIN_SUPPORT = 0.15, 3, 0.5
#: Shared wordings have been seen in so many chunks. Up to TABLE_ROWS rows of any table are broadcast; of more, those with a share of 1 / HOT of all counts are.
SHARED, TABLE_ROWS, HOT = 3, 1_000_000, 100_000
MAX_HEADING_SHARE = 0.4
#: Forms are for labels, addresses and the like, not for paragraphs.
LONG = 120
NAME = "§"


# -- streams ------------------------------------------------------------------------------------------------------------------


_ASIDE = re.compile(r"\S+(?: \S+){0,2}(?:  +\S+(?: \S+){0,2}){3,}")
_BLANKS, _NAMES = re.compile("  +"), re.compile(rf"{NAME}(?:[ &-]+{NAME})+")
_CHARS = (("’", "'"), ("‘", "'"), ("“", '"'), ("”", '"'), ("–", "-"), ("—", "-"), ("\xa0", " "))
_WORDS = re.compile(r"[^\W_]+")


def _replaced(texts: pa.Array, which: list[bool], pattern: str, to: str) -> pa.Array:
    """texts with pattern replaced in some of them, as searching costs more than anything else here."""
    if not any(which):
        return texts
    mask = pa.array(which, pa.bool_())
    return pc.replace_with_mask(texts, mask, pc.replace_substring_regex(texts.filter(mask), pattern, to))


def canonical(texts: pa.Array, firms: list[str | None]) -> pa.Array:
    """Texts with each line in its canonical wording; the number of lines stays."""
    plain = []
    for x in pc.utf8_lower(texts).to_pylist():
        if not x.isascii():
            for c, to in _CHARS:
                x = x.replace(c, to)
        plain.append(x.replace("\t", " ").replace("\r", " "))
    t = pc.replace_substring_regex(pa.array(plain, pa.string()), r"[0-9][0-9.,]*", "0")
    t = _replaced(t, ["@" in x for x in plain], r"(?m)(^|\s)[^\s@]+@\S+", r"\1@")
    named, trails = [], []
    for x, firm in zip(t.to_pylist(), firms, strict=True):
        for w in _own_names(firm):  # a firm's own words are the first of its name; what follows says its trade
            x = x.replace(w, NAME)
        if x.count(NAME) > 1:
            x = _NAMES.sub(NAME, x)
        if x[:1] == " " or x[-1:] == " " or "\n " in x or " \n" in x:
            x = "\n".join([y.strip(" ") for y in x.split("\n")])
        if "  " in x:  # labels side by side become a list
            x = "\n".join([(_BLANKS.sub(" | ", y) if _ASIDE.fullmatch(y) else _BLANKS.sub(" ", y)) if "  " in y else y for y in x.split("\n")])
        named.append(x)
        trails.append(" / " in x or " › " in x or " » " in x)
    return _replaced(pa.array(named, pa.string()), trails, r"(?m)^([^\n/›»]{1,30}) ([›»/]) [^\n/›»]{1,30}$", r"\1 \2 *")


def _own_names(firm: str | None) -> list[str]:
    return [w for w in _WORDS.findall((firm or "").lower()) if len(w) > 3][:2]


def streams(pages: DataFrame, page_id: str = "page_id", chunk: int = CHUNK) -> DataFrame:
    """(page, host, chunk, url, text, heads): canonical streams. Hosts are counted on addresses alone, before any text is read."""
    address = F.regexp_extract(F.lower(F.coalesce(F.col("url"), F.lit(""))), r"^\s*(?:https?://)?(?:www\.)?([^?#\s]+?)/*(?:[?#].*)?\s*$", 1)
    heads = F.array_join(F.transform(F.coalesce(F.col("headings"), F.array()), lambda h: F.translate(F.coalesce(h["text"], F.lit("")), "\n", " ")), "\n")
    rows = pages.where(F.trim("body_text") != "").select(F.col(page_id).cast("bigint").alias("page"), "firm", address.alias("address"), F.col("body_text").alias("text"), heads.alias("heads"))
    host = F.coalesce(F.nullif(F.substring_index("address", "/", 1), F.lit("")), F.col("firm"), F.concat(F.lit("page "), F.col("page").cast("string")))
    url = F.when(F.col("address") == "", F.col("page").cast("string")).otherwise(F.col("address"))
    rows = rows.select("page", F.xxhash64(host).alias("host"), F.xxhash64(url).alias("url"), "firm", "text", "heads")
    many = materialize(rows.groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") > chunk))  # one row per large host
    split = rows.join(sized(many), "host", "left").withColumn("chunk", F.when(F.col("pages").isNull(), F.lit(0)).otherwise(F.pmod(F.col("url"), F.ceil(F.col("pages") / chunk))).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            firms = b.column(4).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), b.column(3), canonical(b.column(5), firms), canonical(b.column(6), firms)], ["page", "host", "chunk", "url", "text", "heads"])

    return split.select("page", "host", "chunk", "url", "firm", "text", "heads").mapInArrow(run, "page bigint, host bigint, chunk int, url bigint, text string, heads string")


# -- wrappers -----------------------------------------------------------------------------------------------------------------


@dataclass
class Wrapper:
    """A union-free expression: tokens in order, with the streams that each was aligned in, and the slots behind them."""

    order: list[int] = field(default_factory=list)  # token numbers
    text: list[str] = field(default_factory=list)  # by token number
    support: list[int] = field(default_factory=list)
    slots: dict[int, int] = field(default_factory=dict)  # behind which token (-1: the beginning) a text slot stands, and the largest number of lines in it
    aligned: list[list[int]] = field(default_factory=list)  # for each stream the token of each line, -1 in a slot

    def expression(self, least: int = 2) -> str:
        slot = lambda k: ["#text" if self.slots[k] == 1 else "(#text)+"] if k in self.slots else []
        out = slot(-1)
        for k in self.order:
            if self.support[k] >= min(least, len(self.aligned)):
                out.append(self.text[k] if self.support[k] == len(self.aligned) else f"({self.text[k]})?")
                out += slot(k)
        return " ".join(out)


def in_common(place: dict[str, list[int]], tokens: list[str]) -> dict[int, int]:
    """Which token matches which place: a longest common subsequence, from the places of each wording."""
    ends, tails, nodes = [], [], []
    for i, t in enumerate(tokens):
        for p in reversed(place.get(t, ())):
            k = bisect_left(ends, p)
            nodes.append((i, p, tails[k - 1] if k else -1))
            if k == len(ends):
                ends.append(p)
                tails.append(len(nodes) - 1)
            else:
                ends[k], tails[k] = p, len(nodes) - 1
    out, n = {}, tails[-1] if tails else -1
    while n >= 0:
        i, p, n = nodes[n]
        out[i] = p
    return out


def infer_wrapper(streams: list[list[str]]) -> Wrapper:
    """Aligns the streams one after another: the expression is generalized by every mismatch."""
    w = Wrapper()
    seen = Counter(x for s in streams for x in set(s))
    for tokens in streams:
        place: dict[str, list[int]] = {}
        for at, k in enumerate(w.order):
            place.setdefault(w.text[k], []).append(at)
        match = in_common(place, tokens)
        merged, own, at, before, run = [], [], 0, -1, 0
        for i, t in enumerate(tokens):
            if i in match:  # what the expression has before it and the stream lacks is optional
                merged += w.order[at : match[i] + 1]
                at, k = match[i] + 1, w.order[match[i]]
                w.support[k] += 1
            elif seen[t] > 1:  # a line that other streams have too, but not here: optional
                k = len(w.text)
                w.text.append(t)
                w.support.append(1)
                merged.append(k)
            else:  # of this stream alone: an instance of a slot
                own.append(-1)
                run += 1
                continue
            if run:
                w.slots[before] = max(w.slots.get(before, 0), run)
            before, run = k, 0
            own.append(k)
        if run:
            w.slots[before] = max(w.slots.get(before, 0), run)
        w.order = merged + w.order[at:]
        w.aligned.append(own)
    return w


def _supports(rows: list[tuple]) -> Iterator[tuple[int, int, int, str, str, list[int], list[int], int, bool]]:
    """(page, host, chunk, text, heads, support of each line, streams that have it (0 where it stands again), urls, whether it is its url's first capture) for one chunk's (host, chunk, page, url, text, heads)."""
    first, by_url = {}, {}
    for _, _, page, url, text, heads in rows:
        if url not in by_url:
            by_url[url], first[url] = text, page
    lines = {u: t.split("\n") for u, t in by_url.items()}
    w = infer_wrapper([[x for x in ls if x] for ls in lines.values()])
    most: dict[str, int] = {}
    for t, n in zip(w.text, w.support, strict=True):
        most[t] = max(n, most.get(t, 0))
    has = Counter(x for ls in lines.values() for x in set(ls))
    found = {}
    for (u, ls), own in zip(lines.items(), w.aligned, strict=True):
        ks = iter(own)
        found[u] = [0 if not x else w.support[k] if (k := next(ks)) >= 0 else 1 for x in ls]
    told = set()
    for host, chunk, page, url, text, heads in rows:
        if page in told:  # a row repeated in the input
            continue
        told.add(page)
        own = found[url] if text is by_url[url] else [most.get(x, 1) if x else 0 for x in text.split("\n")]
        own_lines, met = lines[url] if text is by_url[url] else text.split("\n"), set()
        yield page, host, chunk, text, heads, own, [0 if x in met or met.add(x) else has.get(x, 1) for x in own_lines], len(by_url), first[url] == page


_ARROW = pa.schema([("page", pa.int64()), ("host", pa.int64()), ("chunk", pa.int32()), ("text", pa.string()), ("heads", pa.string()), ("support", pa.list_(pa.int32())), ("has", pa.list_(pa.int32())), ("urls", pa.int32()), ("first", pa.bool_())])
_SUPPORTED = "page bigint, host bigint, chunk int, text string, heads string, support array<int>, has array<int>, urls int, first boolean"


def _by_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of each chunk, from batches that are sorted by chunk."""
    rows = []
    for b in batches:
        for row in zip(*(b.column(i).to_pylist() for i in range(b.num_columns)), strict=True):
            if rows and row[:2] != rows[0][:2]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def supported(pages: DataFrame) -> DataFrame:
    """Each page with the support of its lines in its host's wrapper; pages is what `streams` gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for rows in _by_chunk(batches):
            out += _supports(rows)
            if len(out) > 2000:
                yield pa.RecordBatch.from_pydict(dict(zip(_ARROW.names, map(list, zip(*out, strict=True)), strict=True)), schema=_ARROW)
                out = []
        if out:
            yield pa.RecordBatch.from_pydict(dict(zip(_ARROW.names, map(list, zip(*out, strict=True)), strict=True)), schema=_ARROW)

    grouped = pages.repartition("host", "chunk").sortWithinPartitions("host", "chunk", "url", "page").select("host", "chunk", "page", "url", "text", "heads")
    return materialize(grouped.mapInArrow(run, _SUPPORTED))


def host_wrappers(pages: DataFrame) -> DataFrame:
    """(host, chunk, whole, all_urls) for each chunk of the hosts that were split: the support of the tokens in all chunks together, where it
    is MIN_SUPPORT of the urls (so a wrapper has at most lines-per-page / MIN_SUPPORT of them), repeated for each chunk, as no host's pages come together."""
    chunks = materialize(pages.where("first").groupBy("host", "chunk").agg(F.max("urls").alias("urls")))
    split = materialize(chunks.groupBy("host").agg(F.count("*").alias("chunks"), F.sum("urls").alias("all_urls")).where("chunks > 1"))
    lines = pages.where("first").join(sized(split), "host").select("host", "chunk", "all_urls", F.explode(F.array_distinct(F.arrays_zip(F.split("text", "\n").alias("line"), F.col("support")))).alias("x")).where("x.support > 1")
    by_chunk = lines.groupBy("host", "chunk", "all_urls", "x.line").agg(F.max("x.support").alias("support"))
    fixed = by_chunk.groupBy("host", "all_urls", "line").agg(F.sum("support").alias("support")).where(f"support - 1 >= {MIN_SUPPORT} * (all_urls - 1)")
    per = materialize(fixed.groupBy("host", F.col("all_urls").cast("int").alias("all_urls")).agg(F.map_from_entries(F.collect_list(F.struct("line", F.col("support").cast("int")))).alias("whole")))
    none = F.create_map().cast("map<string,int>")
    return materialize(chunks.join(sized(split), "host").join(sized(per.select("host", "whole")), "host", "left").select("host", "chunk", F.coalesce("whole", none).alias("whole"), F.col("all_urls").cast("int").alias("all_urls")))


def with_wholes(pages: DataFrame) -> DataFrame:
    """pages with `whole` and `all_urls`, null on hosts of one chunk."""
    return pages.join(sized(host_wrappers(pages)), ["host", "chunk"], "left")


def wrappers(pages: DataFrame, page_id: str = "page_id") -> DataFrame:
    """(host, chunk, pages, expression): the union-free expression of each chunk of a host's pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_chunk(batches):
            (host, chunk), texts = rows[0][:2], {r[3]: r[4] for r in rows}
            w = infer_wrapper([[x for x in t.split("\n") if x] for t in texts.values()])
            yield pa.RecordBatch.from_pydict({"host": pa.array([host], pa.int64()), "chunk": pa.array([chunk], pa.int32()), "pages": pa.array([len(rows)], pa.int32()), "expression": pa.array([w.expression()], pa.string())})

    grouped = streams(pages, page_id).repartition("host", "chunk").sortWithinPartitions("host", "chunk", "url", "page").select("host", "chunk", "page", "url", "text")
    return grouped.mapInArrow(run, "host bigint, chunk int, pages int, expression string")


# -- what is furniture --------------------------------------------------------------------------------------------------------

_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?", re.UNICODE)
_FORM = re.compile(r"w(?: w)+")
_TRAIL_RE = r"^(?:.*: )?([^›»/]+) [›»/] \*$"
_TRAIL = re.compile(_TRAIL_RE)


def form(line: str) -> str:
    """A line with its words as w: '0 w, w, w 0' is an address."""
    return _FORM.sub("w+", _WORD.sub("w", line))


Wording = tuple[float, float, float, float]  # cohesion, chances, share of occurrences among the page's headings, hosts


def verdict(w: Wording) -> bool:
    """Whether a wording with enough chances to recur is furniture."""
    return w[0] >= (MIN_COHESION if w[3] >= SHARED else MIN_SUPPORT) and w[2] < MAX_HEADING_SHARE


@dataclass
class Tables:
    wording: dict[str, Wording]  # what the expressions of all hosts say; empty if it is joined to the pages
    form: dict[str, float]  # share of furniture among the wordings of a form; empty if it is joined
    header: dict[str, float] = field(default_factory=dict)  # wordings that open a box
    box: dict[str, float] = field(default_factory=dict)  # log odds of a word feature; empty if its counts are joined
    lines: tuple[int, int] = (1, 1)  # of boxes and of main content, and one more

    def odds(self, box: int, main: int) -> float:
        """The log odds of a feature that so many lines of either kind have."""
        return math.log((box + 0.5) / self.lines[0]) - math.log((main + 0.5) / self.lines[1])

    def furniture(self, known: dict[str, Wording], line: str, support: int, urls: int) -> bool:
        again = support >= 2 and (support - 1) >= MIN_SUPPORT * (urls - 1) and (support >= 3 or not line.endswith((".", "?")))
        if again and urls >= 3:  # a fixed token of its host's expression
            return True
        cohesive = lambda x: x in known and known[x][0] >= MIN_COHESION
        if line.endswith(" *") and (trail := _TRAIL.match(line)):  # the path to a page
            return cohesive(trail[1])
        w = known.get(line)
        if w is not None and w[1] >= MIN_CHANCES:
            return verdict(w)
        if " | " in line:
            parts = line.split(" | ")
            return 2 * sum(map(cohesive, parts)) >= len(parts)
        if again:
            return True
        if len(line) > LONG:
            return False
        share = self.form.get(form(line), 0.0)
        return share > (0.5 if urls < 3 else 0.8)


def looked_up(pages: DataFrame, table: DataFrame, value: Column, strings: Column) -> DataFrame:
    """(page, known): for each page what table (line, n, ...) has for its strings; lines with 1 / HOT of all counts are broadcast, so no line is a hot key."""
    rows = pages.select("page", F.explode(F.array_distinct(strings)).alias("line"))
    table = table.select("line", "n", value.alias("v"))
    least = (table.agg(F.sum("n")).first()[0] or 0) / HOT
    hot, cold = table.where(F.col("n") >= least).drop("n"), table.where(F.col("n") < least).drop("n")
    rest = rows.join(F.broadcast(hot.select("line")), "line", "left_anti").join(cold, "line")  # at most HOT hot lines
    both = rows.join(F.broadcast(hot), "line").unionByName(rest)
    return both.groupBy("page").agg(F.map_from_entries(F.collect_list(F.struct("line", "v"))).alias("known"))


def _listed(pages: DataFrame, strings: Callable[..., set[str]], *columns: str) -> DataFrame:
    """(page, strings): what `strings` gives of these columns of each page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = zip(*(b.column(i).to_pylist() for i in range(1, b.num_columns)), strict=True)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([sorted(strings(*v)) for v in values], pa.list_(pa.string()))], ["page", "strings"])

    return materialize(pages.select("page", *columns).mapInArrow(run, "page bigint, strings array<string>"))


def _forms(text: str) -> set[str]:
    return {form(x) for x in text.split("\n") if x and len(x) <= LONG}


def _box_features(text: str, marks: str) -> set[str]:
    return {f for x, m in zip(text.split("\n"), marks, strict=True) if m == "C" and x for f in features(x)}


def wordings(pages: DataFrame, most: int | None = None) -> tuple[DataFrame, Tables]:
    """The pages with `known` and `forms`, null if the tables hold what is known of all wordings and forms, and the tables."""
    most = TABLE_ROWS if most is None else most
    lines = pages.where("first").select(F.explode(F.arrays_zip(F.split("text", "\n").alias("line"), F.col("support"), F.col("has"))).alias("x"), F.split("heads", "\n").alias("heads"), "urls", "chunk")
    lines = lines.where("x.line <> ''").select(F.col("x.line").alias("line"), F.col("x.support").alias("support"), F.when(F.col("x.has") > 0, 1 / F.col("x.has")).alias("part"), "urls", "chunk", F.array_contains("heads", F.col("x.line")).cast("int").alias("head"))
    # the streams of a chunk that were aligned on a line: each adds its chances to be met again, and how often it was
    token = lines.groupBy("line").agg(F.sum(F.col("support") - 1).alias("again"), F.sum(F.col("urls") - 1).alias("chances"), F.sum("head").alias("heads"), F.count("*").alias("n"), F.sum("part").alias("chunks"), F.sum(F.when(F.col("chunk") == 0, F.col("part"))).alias("hosts"))
    token = materialize(token.where((F.col("chunks") > SHARED - 0.01) | (F.col("chances") >= 2)))
    sure = (F.col("again") - F.sqrt("again")) / F.col("chances")  # one standard deviation below the share, as few chances tell little
    told = [sure, F.col("chances").cast("double"), F.col("heads") / F.col("n"), F.round(F.coalesce("hosts", F.lit(0.0)), 3)]
    shared = token.where(f"chunks > {SHARED - 0.01} and chances > 0").select("line", "n", F.array(*told).alias("v"))
    wording: dict[str, Wording] = {}
    if shared.count() <= most:
        wording = {r[0]: tuple(r[1]) for r in shared.select("line", "v").collect()}
        pages = pages.withColumn("known", F.lit(None).cast("map<string,array<double>>"))
    else:
        own = F.split("text", "\n")
        parts, trails = F.flatten(F.transform(own, lambda x: F.split(x, r" \| "))), F.transform(own, lambda x: F.regexp_extract(x, _TRAIL_RE, 1))
        pages = materialize(pages.join(looked_up(pages, shared, F.col("v"), F.concat(own, parts, trails)), "page", "left"))
        pages = pages.withColumn("known", F.coalesce("known", F.create_map().cast("map<string,array<double>>")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hit: Counter = Counter()
        seen: Counter = Counter()
        for b in batches:
            for line, cohesion in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if len(line) <= LONG and " | " not in line:
                    f = form(line)
                    seen[f] += 1
                    hit[f] += cohesion >= 0.5
        yield pa.RecordBatch.from_pydict({"form": pa.array(list(seen), pa.string()), "seen": pa.array(list(seen.values()), pa.int64()), "hit": pa.array([hit[f] for f in seen], pa.int64())})

    by_form = token.where("chances >= 2").select("line", F.col("again") / F.col("chances")).mapInArrow(run, "form string, seen bigint, hit bigint").groupBy("form").agg(F.sum("seen").alias("seen"), F.sum("hit").alias("hit"))
    by_form = by_form.where("hit * 2 > seen and seen >= 3").select(F.col("form").alias("line"), F.col("seen").alias("n"), (F.col("hit") / F.col("seen")).alias("v"))
    forms = by_form.limit(most + 1).collect()
    if len(forms) <= most:
        return pages.withColumn("forms", F.lit(None).cast("map<string,double>")), Tables(wording, {r[0]: r[2] for r in forms})
    found = looked_up(_listed(pages, _forms, "text"), materialize(by_form), F.col("v"), F.col("strings")).withColumnRenamed("known", "forms")
    pages = materialize(pages.join(found, "page", "left"))
    return pages.withColumn("forms", F.coalesce("forms", F.create_map().cast("map<string,double>"))), Tables(wording, {})


# -- boxes --------------------------------------------------------------------------------------------------------------------


_LENGTHS = [f"n {n // 2}" for n in range(1, 15)]


def features(line: str) -> list[str]:
    first, blank, rest = line.partition(" ")
    return ["1 " + first, "2 " + first + blank + rest.partition(" ")[0], "-1 " + line.rpartition(" ")[2], _LENGTHS[min(line.count(" "), 13)], ": True" if ":" in line else ": False", ", True" if "," in line else ", False"]


def marked(tables: Tables, known: dict[str, Wording], lines: list[str], support: list[int], urls: int, heads: set[str], settled: dict[tuple[str, int, int], bool] | None = None) -> list[str]:
    """For each line: '' blank, F furniture, H heading, C other. settled keeps verdicts between pages of the same tables and known wordings."""
    out, settled = [], {} if settled is None else settled
    for x, s in zip(lines, support, strict=True):
        if not x:
            out.append("")
        elif x in heads and known.get(x, (0, 0, 1.0))[2] >= 0.3:
            out.append("H")
        else:
            if (is_furniture := settled.get((x, s, urls))) is None:
                is_furniture = settled[x, s, urls] = tables.furniture(known, x, s, urls)
            out.append("F" if is_furniture else "H" if x in heads else "C")
    # a label that is also a heading of this page, or of others: the last one before the content begins is the heading
    start = next((i for i, m in enumerate(out) if m == "C" and lines[i] not in heads), len(out))
    shown = {x for x, m in zip(lines, out, strict=True) if m == "H"} if heads else ()
    for h in heads:
        if h in known and h not in shown:
            at = [i for i, x in enumerate(lines) if x == h and out[i] == "F"]
            if at:
                out[max((i for i in at if i < start), default=at[0])] = "H"
    if start < len(out) and "H" not in out[:start]:
        before = [i for i in range(start) if out[i]]
        if before and 0.02 <= known.get(lines[before[-1]], (0, 0, 0))[2]:
            label = lines[before[-1]]
            previous = known.get(lines[before[-2]], (0.0,))[0] if len(before) > 1 else 0.0
            if sum(lines[i] == label for i in before) > 1 or previous < 0.8:
                out[before[-1]] = "H"
    return out


_TEASER = re.compile(r"(?:…|\.\.\.) ?(?:read|learn|see) more$|… ?(?:weiterlesen|lire la suite|leer más)$")
_TEASER_ENDS = (" more", "weiterlesen", "lire la suite", "leer más")  # of every teaser; lines with other ends needn't be searched


def settled_marks(lines: list[str], marks: list[str], known: dict[str, Wording]) -> tuple[str, str]:
    """(text, marks) for `main_lines`: of the lines of main content, T is a teaser and P a paragraph, which are told here. The text has only the lines
    that are still needed: furniture that may be a header, as headers are shared wordings, and what may be in its box, up to a heading or a paragraph. The others are empty."""
    out, kept, open_box = [], [], False
    for x, m in zip(lines, marks, strict=True):
        need = False
        if m == "F":
            need = x in known
            open_box = open_box or need
        elif m:
            if x.endswith(_TEASER_ENDS) and _TEASER.search(x):
                m = "T"
            else:
                if m == "C" and x.endswith((".", '."')):
                    m = "P"
                open_box = need = open_box and m == "C"
        out.append(m or "-")
        kept.append(x if need else "")
    return "\n".join(kept), "".join(out)


def _lists(column: pa.Array) -> list[list[int]]:
    values, offsets = column.flatten().to_numpy().tolist(), column.offsets.to_numpy().tolist()
    base = offsets[0]
    return [values[a - base : b - base] for a, b in zip(offsets, offsets[1:], strict=False)]


_MARKED = "page bigint, text string, marks string, header string, x string, n bigint"


def marked_pages(pages: DataFrame, tables: Tables) -> DataFrame:
    """Written once: (page, text, marks), what `settled_marks` gives, a letter for each line, '-' where it is blank; and (header, x, n), what boxes are learned from.

    For each shared piece of furniture it is counted what follows ('after', 'title'), and for the titles their features; under the header '' stand
    the features of lines of main content: headings and what comes right after them or after a paragraph.
    """
    shared = pages.sparkSession.sparkContext.broadcast(tables)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        c: Counter = Counter()
        met: Counter = Counter()  # lines under a header; equal ones are taken apart once
        settled: dict[tuple[str, int, int], bool] = {}
        for b in batches:
            all_texts, all_marks = [], []
            joined, wholes = b.column(4).to_pylist(), b.column(5).to_pylist()
            for text, heads, support, urls, known, whole, all_urls, first, forms in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), _lists(b.column(3)), b.column(7).to_pylist(), joined, wholes, b.column(6).to_pylist(), b.column(8).to_pylist(), b.column(9).to_pylist(), strict=True):
                lines = text.split("\n")
                known = t.wording if known is None else dict(known)
                if all_urls is not None:  # the expression of all chunks of the host
                    whole, urls = dict(whole), all_urls
                    support = [whole.get(x, min(s, 2)) for x, s in zip(lines, support, strict=True)]
                if len(settled) > 200_000:
                    settled.clear()
                same = settled if known is t.wording and forms is None else None
                marks = marked(t if forms is None else replace(t, form=dict(forms)), known, lines, support, urls, {h for h in heads.split("\n") if h}, same)
                kept, letters = settled_marks(lines, marks, known)
                all_texts.append(kept)
                all_marks.append(letters)
                if not first:
                    continue
                before, mark = "", ""
                for x, m in zip(lines, marks, strict=True):
                    if not m:
                        continue
                    if mark == "F" and before in known:
                        c[before, "after"] += 1
                        if m == "C" and not x.endswith((".", "!", '."', "…")) and len(x) < 120:
                            met[before, x] += 1
                    if m == "H" or m == "C" and (mark == "H" or mark == "C" and before.endswith(".")) and not x.endswith((".", "…")):
                        met["", x] += 1
                    before, mark = x, m
            k = b.num_rows
            yield pa.RecordBatch.from_pydict({"page": b.column(0), "text": pa.array(all_texts, pa.string()), "marks": pa.array(all_marks, pa.string()), "header": pa.nulls(k, pa.string()), "x": pa.nulls(k, pa.string()), "n": pa.nulls(k, pa.int64())})
            if len(met) > 20_000:
                fold(met, c)
            if len(c) > 200_000:
                yield counted(c)
                c = Counter()
        fold(met, c)
        yield counted(c)

    def fold(met: Counter, c: Counter) -> None:
        for (header, x), n in met.items():
            c[header, "title" if header else ""] += n
            for f in features(x):
                c[header, f] += n
        met.clear()

    def counted(c: Counter) -> pa.RecordBatch:
        k = len(c)
        return pa.RecordBatch.from_pydict({"page": pa.nulls(k, pa.int64()), "text": pa.nulls(k, pa.string()), "marks": pa.nulls(k, pa.string()), "header": pa.array([x[0] for x in c], pa.string()), "x": pa.array([x[1] for x in c], pa.string()), "n": pa.array(list(c.values()), pa.int64())})

    return materialize(pages.select("page", "text", "heads", "support", "known", "whole", "all_urls", "urls", "first", "forms").mapInArrow(run, _MARKED))


def learn_boxes(pages: DataFrame, tables: Tables, most: int | None = None) -> DataFrame:
    """Adds the box headers and the words of box lines to the tables; gives the marked pages with `headers` and `box`, which are null if the tables hold all of them."""
    most = TABLE_ROWS if most is None else most
    counted = materialize(pages.where("page is null").groupBy("header", "x").agg(F.sum("n").alias("n")))
    times = lambda what: F.coalesce(F.sum(F.when(F.col("x") == what, F.col("n"))), F.lit(0))
    followed = counted.where("x in ('after', 'title')").groupBy("header").agg(times("after").alias("after"), times("title").alias("title"))
    headers = materialize(followed.where("after >= 5 and title >= 0.55 * after").select(F.col("header").alias("line"), F.col("after").alias("n"), (F.col("title") / F.col("after")).alias("v")))
    of_box = counted.where("x not in ('after', 'title')").join(sized(headers.select(F.col("line").alias("header"))), "header").groupBy("x").agg(F.sum("n").alias("box"))
    of_main = counted.where("header = ''").groupBy("x").agg(F.sum("n").alias("main"))
    zero = F.lit(0)
    both = of_box.join(of_main, "x", "full_outer").where("x <> ''").select(F.col("x").alias("line"), F.coalesce("box", zero).alias("box"), F.coalesce("main", zero).alias("main"))
    words = both.limit(most + 1).collect()
    whole = len(words) <= most
    # every line has one feature of its length, so those add up to the lines
    lengths = words if whole else both.where("line like 'n %'").collect()  # a few
    tables.lines = tuple(sum(r[k] for r in lengths if r[0].startswith("n ")) + 1 for k in (1, 2))
    pages = pages.where("page is not null").select("page", "text", "marks")
    if whole:
        tables.box = {x: tables.odds(box, main) for x, box, main in words}
        pages = pages.withColumn("box", F.lit(None).cast("map<string,array<bigint>>"))
    else:
        table = materialize(both.withColumn("n", F.col("box") + F.col("main")))
        found = looked_up(_listed(pages, _box_features, "text", "marks"), table.withColumn("v", F.array("box", "main")), F.col("v"), F.col("strings")).withColumnRenamed("known", "box")
        pages = materialize(pages.join(found, "page", "left")).withColumn("box", F.coalesce("box", F.create_map().cast("map<string,array<bigint>>")))
    if headers.count() <= most:
        tables.header = {r[0]: r[2] for r in headers.collect()}
        return pages.withColumn("headers", F.lit(None).cast("map<string,double>"))
    pages = materialize(pages.join(looked_up(pages, headers, F.col("v"), F.split("text", "\n")).withColumnRenamed("known", "headers"), "page", "left"))
    return pages.withColumn("headers", F.coalesce("headers", F.create_map().cast("map<string,double>")))


def main_lines(tables: Tables, lines: list[str], marks: str, headers: dict[str, float]) -> list[int]:
    """The numbers of the lines of main content, from 1; lines and marks are what `settled_marks` gives."""
    out, box = [], 0
    for i, m in enumerate(marks, 1):
        if m == "F":
            if lines[i - 1] in headers:
                box = 1
        elif m != "-" and m != "T":
            if box and m == "C" and sum(tables.box.get(f, 0.0) for f in features(lines[i - 1])) > (-3.0 if box == 1 else 0.0):
                box = 2
                continue
            box = 0
            out.append(i)
    return out


def replaced_pages(pages: DataFrame, page_id: str = "page_id") -> DataFrame:
    """(page) of pages that hold an error, a notice or filler in their body; unfilled spots alone don't count."""
    records = residue.record_texts(pages.withColumn("_none", F.lit(None).cast("string")), "page", page_id, "_none")
    return residue.residue_windows(records).where("kind not in ('slot', 'rendering')").select(F.col("rec_id").alias("page")).distinct()


def main_content(pages: DataFrame, page_id: str = "page_id", most: int | None = None) -> DataFrame:
    """(page_id, line_no): each non-blank line of main body. most overrides TABLE_ROWS."""
    with_known, tables = wordings(with_wholes(supported(streams(pages, page_id))), most)
    marks = learn_boxes(marked_pages(with_known, tables), tables, most)
    slim = Tables({}, {}, tables.header, tables.box, tables.lines)
    shared = pages.sparkSession.sparkContext.broadcast(slim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        for b in batches:
            ids, nos = [], []
            for page, text, m, headers, box in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                own = t if box is None else replace(t, box={x: t.odds(*n) for x, n in box})
                found = main_lines(own, text.split("\n"), m, t.header if headers is None else dict(headers))
                ids += [page] * len(found)
                nos += found
            yield pa.RecordBatch.from_pydict({page_id: pa.array(ids, pa.int64()), "line_no": pa.array(nos, pa.int64())})

    kept = marks.join(replaced_pages(pages, page_id), "page", "left_anti").select("page", "text", "marks", "headers", "box")
    return kept.mapInArrow(run, f"{page_id} bigint, line_no bigint")


def main_text(pages: DataFrame, page_id: str = "page_id", out: str = "main_text") -> DataFrame:
    """(page_id, main_text): each page's own content."""
    found = main_content(pages, page_id).groupBy(page_id).agg(F.collect_set("line_no").alias("_keep"))  # one page's lines
    lines = F.transform(F.split(F.col("body_text"), "\n"), lambda x, i: F.struct(x.alias("t"), (i + 1).cast("bigint").alias("n")))
    return pages.join(found, page_id).select(page_id, F.array_join(F.transform(F.filter(lines, lambda p: F.array_contains("_keep", p["n"])), lambda p: p["t"]), "\n").alias(out))


