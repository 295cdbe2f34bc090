"""Lines repeated across one site's documents: found by mergeable heavy-hitter summaries, confirmed by exact counts, removed.

1. Every line becomes a 64-bit key of its wording (letters only; case, spacing, punctuation, markup, digits and month names don't count);
   the keys are written once, so the text is read and normalized a single time.
2. Every partition sums up its rows in Misra-Gries summaries, one per source: at most K counters (20 times the lines per document in that
   partition, so the error stays below 5 % of the source's documents there) and the error made by dropping the rest. Summaries merge by adding.
   A wording whose count plus error can't reach the threshold is out. Should a source's error ever reach its threshold, its summary can't rule
   out anything and all its wordings stay candidates, so no line is lost either way.
3. The candidates' distinct urls are counted exactly (count of distinct (source, wording, url), combined before the shuffle), and the confirmed
   wordings are looked up in the keys: broadcast while they are few (cluster.BROADCAST_ROWS), shuffled beyond that.

Hot sources: nothing is grouped by source alone except counters (one row per partition and source); all other groups are by (source, wording).

Defined results: a null source has no site and gives no lines. A null or empty text has no lines, but its url counts. Documents with a null url hold repeated lines
but don't count as urls. A line of nothing but month names counts as one wording, a line without a letter never counts. Rows repeated in the
input give one result. Extra columns are ignored by `repeated_lines` and kept by `without_repeated_lines`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.cluster import BROADCAST_ROWS, materialize, sized

MIN_URLS, MIN_SHARE = 5, 0.1
#: Wordings of many documents are joined in so many parts where they are too many to be broadcast.
SALTS = 16
MONTHS = "january|february|march|april|may|june|july|august|september|october|november|december|jan|feb|mar|apr|jun|jul|aug|sept|sep|oct|nov|dec"
#: What a wording leaves out: tags, entities, link targets, month names, and all that isn't a letter. A month leaves a mark, for lines of months only.
MONTH_RE = rf"(?<![\p{{L}}\p{{M}}])(?:{MONTHS})(?![\p{{L}}\p{{M}}])"
LEFT_OUT_RE = r"</?[a-z][^>\n]{0,200}>|&(?:[a-z]{2,8}|#[0-9]{1,6});|\]\([^)\n]*\)|[^\p{L}\p{M}\n\x01]+"


def line_keys(body: Column) -> Column:
    """One key per line of a text, null for lines without a letter; line n is element n - 1."""
    text = F.regexp_replace(F.regexp_replace(F.lower(body), MONTH_RE, "\x01"), LEFT_OUT_RE, "")
    return F.transform(F.split(text, "\n", -1), lambda x: F.when(x != "", F.xxhash64(F.replace(x, F.lit("\x01"), F.lit("")))))


def keyed(df: DataFrame, source: str, url: str, doc_id: str, body: str) -> DataFrame:
    return materialize(
        df.where(F.col(source).isNotNull()).select(
            F.col(doc_id).alias("doc"), F.xxhash64(source).alias("src"), F.when(F.col(url).isNotNull(), F.xxhash64(url)).alias("url"), line_keys(F.coalesce(F.col(body), F.lit(""))).alias("lines")
        )
    )


_SUMMARY = "src bigint, key bigint, n bigint, error bigint"


def _reduced(state: pd.DataFrame, rows: pd.Series, items: pd.Series, error: dict[int, int], least: int) -> pd.DataFrame:
    """At most K counters a source: the (K+1)th largest count is taken off all, and is the error made."""
    state = state.groupby(["src", "key"], sort=False, as_index=False)["n"].sum()
    size = state.groupby("src")["n"].transform("size")
    limit = np.maximum(least, np.ceil(20 * items / rows)).astype("int64")
    over = size > state["src"].map(limit)
    if not over.any():
        return state
    kept = [state[~over]]
    for src, part in state[over].groupby("src"):
        counts = part["n"].to_numpy()
        cut = int(np.partition(counts, -(int(limit[src]) + 1))[-(int(limit[src]) + 1)])
        error[src] = error.get(src, 0) + cut
        part = part.assign(n=counts - cut)
        kept.append(part[part["n"] > 0])
    return pd.concat(kept, ignore_index=True)


def summarize(batches: Iterator[pa.RecordBatch], least: int = 512, room: int = 400_000) -> Iterator[pa.RecordBatch]:
    """The Misra-Gries summaries of one partition: rows (src, key, n, null), and (src, null, documents, error) for each source."""
    state = pd.DataFrame({"src": pd.Series(dtype="int64"), "key": pd.Series(dtype="int64"), "n": pd.Series(dtype="int64")})
    rows, items, error, waiting, held = pd.Series(dtype="int64"), pd.Series(dtype="int64"), {}, [], 0
    for b in batches:
        src, lists = b.column("src").to_numpy(zero_copy_only=False), b.column("lines")
        lengths = np.diff(lists.offsets.to_numpy())
        s = np.repeat(src, lengths)
        rows = rows.add(pd.Series(src).value_counts(), fill_value=0)
        items = items.add(pd.Series(s).value_counts(), fill_value=0)
        part = pd.DataFrame({"src": s, "key": lists.flatten().to_numpy(zero_copy_only=False)}).groupby(["src", "key"], sort=False).size().rename("n").reset_index()
        waiting.append(part)
        held += len(part)
        if held > room:
            state, waiting, held = _reduced(pd.concat([state, *waiting]), rows, items.reindex(rows.index, fill_value=0), error, least), [], 0
    if len(rows):
        state = _reduced(pd.concat([state, *waiting]), rows, items.reindex(rows.index, fill_value=0), error, least)
        yield pa.RecordBatch.from_pydict({"src": pa.array(state["src"], pa.int64()), "key": pa.array(state["key"], pa.int64()), "n": pa.array(state["n"], pa.int64()), "error": pa.nulls(len(state), pa.int64())})
        yield pa.RecordBatch.from_pydict({"src": pa.array(rows.index, pa.int64()), "key": pa.nulls(len(rows), pa.int64()), "n": pa.array(rows.astype("int64"), pa.int64()), "error": pa.array([error.get(x, 0) for x in rows.index], pa.int64())})


def confirmed_lines(keys: DataFrame, min_urls: int = MIN_URLS, min_share: float = MIN_SHARE, least: int = 512) -> DataFrame:
    """(src, key, urls, source_urls) of the repeated wordings."""
    per_doc = keys.select("src", F.array_compact(F.array_distinct("lines")).alias("lines"))
    summaries = materialize(per_doc.mapInArrow(lambda bs: summarize(bs, least), _SUMMARY))
    urls = keys.where(F.col("url").isNotNull()).select("src", "url").distinct().groupBy("src").agg(F.count("*").alias("source_urls"))
    need = F.greatest(F.lit(min_urls).cast("double"), F.col("source_urls") * min_share)
    sources = materialize(summaries.where("key is null").groupBy("src").agg(F.sum("error").alias("error")).join(urls, "src").withColumn("need", need))
    by_source = sized(sources)  # a row per source: a hot source's wordings stay where they are
    counted = summaries.where("key is not null").groupBy("src", "key").agg(F.sum("n").alias("n"))
    candidates = materialize(counted.join(by_source, "src").where((F.col("n") + F.col("error") >= F.col("need")) & (F.col("error") < F.col("need"))).select("src", "key"))
    open_sources = sources.where("error >= need").select("src")
    lines = keys.where(F.col("url").isNotNull()).select("src", "url", F.explode(F.array_distinct("lines")).alias("key")).where("key is not null")
    known = lines.join(sized(candidates), ["src", "key"])
    unknown = lines.join(open_sources, "src", "left_semi")
    exact = known.unionByName(unknown).distinct().groupBy("src", "key").agg(F.count("*").alias("urls"))
    return materialize(exact.join(by_source.select("src", "source_urls", "need"), "src").where("urls >= need").select("src", "key", "urls", "source_urls"))


def repeated_lines(df: DataFrame, source: str = "firm", url: str = "url", doc_id: str = "post_id", body: str = "body_text", min_urls: int = MIN_URLS, min_share: float = MIN_SHARE) -> DataFrame:
    """(doc_id, line_no) of each line whose wording stands in documents of at least min_urls urls and min_share of its source's urls."""
    keys = keyed(df, source, url, doc_id, body)
    found = confirmed_lines(keys, min_urls, min_share).select("src", "key")
    lines = keys.select(F.col("doc").alias(doc_id), "src", F.posexplode("lines").alias("pos", "key")).where("key is not null")
    return lines.join(sized(found), ["src", "key"], "left_semi").select(doc_id, (F.col("pos") + 1).cast("bigint").alias("line_no")).dropDuplicates()


def without_repeated_lines(df: DataFrame, source: str = "firm", url: str = "url", doc_id: str = "post_id", body: str = "body_text", out: str = "clean_text", min_urls: int = MIN_URLS, min_share: float = MIN_SHARE) -> DataFrame:
    """df with the column `out`: each text without its source's repeated lines. The confirmed wordings of a source come to its documents as one
    set, broadcast while all sets together are few (BROADCAST_ROWS wordings); beyond that each document gets the set of its own lines among them.
    A text is taken apart and put together in its own row."""
    keys = keyed(df, source, url, doc_id, body)
    confirmed = confirmed_lines(keys, min_urls, min_share).select("src", "key")
    base = df.withColumn("_src", F.when(F.col(source).isNotNull(), F.xxhash64(source)))
    if confirmed.count() <= BROADCAST_ROWS:
        sets = confirmed.groupBy("src").agg(F.collect_set("key").alias("_gone"))  # at most lines-per-document / min_share keys a source
        joined = base.join(F.broadcast(sets.withColumnRenamed("src", "_src")), "_src", "left")
    else:
        # by document: its own lines that are confirmed, found by (source, wording), so a source with many documents is no one task
        lines = keys.select("doc", "src", F.explode(F.array_distinct("lines")).alias("key")).where("key is not null").distinct()
        gone = lines.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS))).join(confirmed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["src", "key", "salt"])
        per_doc = gone.groupBy(F.col("doc").alias(doc_id), F.col("src").alias("_src")).agg(F.collect_set("key").alias("_gone"))
        joined = base.join(per_doc, [doc_id, "_src"], "left")
    pairs = F.arrays_zip(F.split(F.col(body), "\n", -1).alias("t"), line_keys(F.col(body)).alias("k"))
    kept = F.transform(F.filter(pairs, lambda p: F.coalesce(~F.array_contains(F.col("_gone"), p["k"]), F.lit(True))), lambda p: p["t"])
    return joined.withColumn(out, F.when(F.col("_gone").isNull(), F.col(body)).otherwise(F.array_join(kept, "\n"))).select(*df.columns, out)
