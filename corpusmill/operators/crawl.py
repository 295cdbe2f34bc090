"""Which addresses of a site to take: candidate sources in order of trust, one page per kind, and the posts of a blog."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions import urls as u
from corpusmill.operators.pages import PATH_KINDS, PRIORITY, TEXT_KINDS


def candidates(*sources: DataFrame) -> DataFrame:
    """(site, url, text, source_rank): all candidates, the sources in order of trust."""
    parts = [s.select("site", "url", "text").withColumn("source_rank", F.lit(i)) for i, s in enumerate(sources)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def known_path_candidates(sites: DataFrame) -> DataFrame:
    """(site, url, text): the addresses that sites usually have; sites is (site, base)."""
    paths = F.explode(F.array(*[F.lit(p) for p in u.KNOWN_PATHS])).alias("path")
    rows = sites.select("site", "base", paths)
    return rows.select("site", F.concat(F.regexp_replace("base", "/+$", ""), "path").alias("url"), F.regexp_replace(F.substring_index("path", "/", -1), "[-_]", " ").alias("text"))


def sitemap_links(xml: DataFrame, most_depth: int = 2, most: int = 300) -> DataFrame:
    """(site, url, text, place): the pages of sitemaps (site, base, xml) of one origin with at most two path segments, the first `most` per site."""
    loc = F.posexplode(F.regexp_extract_all("xml", F.lit(r"(?i)<loc>\s*([^<\s]+)\s*</loc>"), F.lit(1))).alias("place", "url")
    rows = xml.where(~F.col("xml").rlike("(?i)<sitemapindex")).select("site", "base", loc)
    own = rows.where(u.same_origin(F.col("url"), F.col("base")) & (u.depth(F.col("url")) <= most_depth) & ~u.is_file(F.col("url")))
    rank = F.row_number().over(Window.partitionBy("site").orderBy("place"))
    return own.withColumn("n", rank).where(F.col("n") <= most).select("site", "url", u.segment_text(F.col("url")).alias("text"), "place")


def robots_sitemaps(robots: DataFrame) -> DataFrame:
    """(site, url): the sitemaps that robots files (site, text) name."""
    return robots.select("site", F.explode(F.regexp_extract_all("text", F.lit(r"(?im)^\s*sitemap:\s*(\S+)"), F.lit(1))).alias("url")).distinct()


def reachable_sitemaps(fetched: DataFrame, roots: DataFrame, levels: int = 5) -> DataFrame:
    """(site, base, url, xml) of the page lists among the fetched sitemaps that roots (site, url) lead to, through at most `levels` nested indexes."""
    loc = F.explode(F.regexp_extract_all("xml", F.lit(r"(?i)<loc>\s*([^<\s]+)\s*</loc>"), F.lit(1))).alias("url")
    is_index = F.col("xml").rlike("(?i)<sitemapindex")
    fetched = fetched.select("site", "base", "url", "xml").dropDuplicates(["site", "url"])
    at, out = roots.select("site", "url").distinct(), None
    for _ in range(levels):
        here = fetched.join(at, ["site", "url"], "left_semi")
        pages = here.where(~is_index)
        out = pages if out is None else out.unionByName(pages)
        at = here.where(is_index).select("site", loc).distinct()
    return out.unionByName(fetched.join(at, ["site", "url"], "left_semi").where(~is_index)).dropDuplicates(["site", "url"])


def distinct_addresses(df: DataFrame) -> DataFrame:
    """One row per site and canonical address: the most trusted, then the first by address."""
    keyed = df.withColumn("canon", u.canonical(F.col("url")))
    return keyed.groupBy("site", "canon").agg(F.min(F.struct("source_rank", "url", "text")).alias("b")).select("site", "canon", "b.*")


def _kinds(column: str, patterns: dict[str, str]) -> Column:
    each = F.array(*[F.when(F.col(column).rlike(p), F.lit(k)) for k, p in patterns.items()])
    return F.explode(F.array_compact(each))


def pick_by_path(df: DataFrame) -> DataFrame:
    """(site, kind, url): per kind the address with the shortest path that its patterns fit; ties by source, then address.

    The patterns are expressions on the row, so there is no join; one address may serve several kinds.
    """
    rows = df.withColumn("p", u.path(F.col("url"))).where("p is not null").select("site", "url", "source_rank", u.depth(F.col("url")).alias("d"), _kinds("p", PATH_KINDS).alias("kind"))
    return rows.groupBy("site", "kind").agg(F.min(F.struct("d", "source_rank", "url")).alias("b")).select("site", "kind", F.col("b.url").alias("url"))


def pick_by_text(df: DataFrame, taken: DataFrame) -> DataFrame:
    """(site, kind, url): per kind the first link whose text fits and whose address no path pick has."""
    left = df.withColumn("canon", u.canonical(F.col("url"))).join(taken.select("site", u.canonical(F.col("url")).alias("canon")).distinct(), ["site", "canon"], "left_anti")
    rows = left.where(F.col("url").isNotNull() & F.length("text").between(1, 80)).select("site", "url", "source_rank", _kinds("text", TEXT_KINDS).alias("kind"))
    return rows.groupBy("site", "kind").agg(F.min(F.struct("source_rank", "url")).alias("b")).select("site", "kind", F.col("b.url").alias("url"))


def pick_pages(df: DataFrame, budget: int = 6) -> DataFrame:
    """(site, place, kind, url): path picks before text picks, by priority of kinds, within the budget."""
    by_path = pick_by_path(df)
    by_text = pick_by_text(df, by_path)
    both = by_path.withColumnRenamed("url", "a").join(by_text.withColumnRenamed("url", "b"), ["site", "kind"], "full_outer").select("site", "kind", F.coalesce("a", "b").alias("url"))
    order = F.array_position(F.array(*[F.lit(k) for k in PRIORITY]), F.col("kind"))
    place = F.row_number().over(Window.partitionBy("site").orderBy(order))
    return both.withColumn("place", place).where(F.col("place") <= max(1, budget)).select("site", "place", "kind", "url")


def greedy_text_picks(df: DataFrame) -> DataFrame:
    """The exact order-dependent form of text picks: links in order, each address used once, the first that fits an open kind takes it.

    One site's candidates (at most a few hundred, see `sitemap_links`) are one group.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        taken, used, out = set(), set(), []
        for row in pdf.sort_values(["source_rank", "url"]).itertuples():
            if row.url in used or not isinstance(row.text, str):
                continue
            for kind, p in TEXT_KINDS.items():
                if kind not in taken and re.search(p, row.text.strip()):
                    taken.add(kind)
                    used.add(row.url)
                    out.append((row.site, kind, row.url))
        return pd.DataFrame(out, columns=["site", "kind", "url"])

    return df.where("url is not null").select("site", "url", "text", "source_rank").groupBy("site").applyInPandas(run, "site string, kind string, url string")


def post_candidates(links: DataFrame) -> DataFrame:
    """(site, url, date): addresses of posts among a blog's links (site, blog_url, url), each once.

    Of the blog's origin, no index page and no file; deeper than the blog, or with a content word in the path, or like a slug.
    """
    url, blog = F.col("url"), F.col("blog_url")
    own = links.where(u.same_origin(url, blog) & ~u.is_index(url) & ~u.is_file(url) & (u.path(url) != "/") & (u.canonical(url) != u.canonical(blog)))
    good = own.where((u.depth(url) > u.depth(blog)) | u.is_content(url) | u.is_slug_like(url))
    return good.select("site", F.regexp_replace("url", r"[?#].*", "").alias("url")).distinct().withColumn("date", u.dated(F.col("url")))


def newest_first(posts: DataFrame, most: int) -> DataFrame:
    """The first `most` per site with their place: dated before undated, newest first, undated by address from the end."""
    w = Window.partitionBy("site").orderBy(F.col("date").isNull(), F.desc("date"), F.desc("url"))
    return posts.withColumn("place", F.row_number().over(w)).where(F.col("place") <= most)


def fresh(posts: DataFrame, captured: DataFrame, most: int = 30) -> DataFrame:
    """Candidates that aren't captured yet, then cut to `most` per site."""
    return newest_first(posts.join(captured.select("url").distinct(), "url", "left_anti"), most)


