"""The page index: site pages and posts in one table, its tallies and totals; contacts mined from captures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as tx

# What a page's address and link text say about its kind, and the order in which kinds are wanted.
PATH_KINDS = {
    "pricing": r"(?i)/(pricing|fees?|cost|rates?)(/|$)",
    "about": r"(?i)/(about|our[-_]?firm|who[-_]?we[-_]?are|company|our[-_]?story|story|mission)(/|$)",
    "services": r"(?i)/(services?|what[-_]?we[-_]?do|how[-_]?we[-_]?help|solutions?|approach|process)(/|$)",
    "contact": r"(?i)/(contact|get[-_]?in[-_]?touch|let[-_']?s[-_]?chat|talk[-_]?to|book|schedule)(/|$)",
    "blog": r"(?i)/(blog|insights?|articles?|news|press|resources?/?(news|insights?|blog|articles?)?)(/|$)",
}
TEXT_KINDS = {
    "pricing": r"(?i)^(pricing|fees?|our[-\s]fees?|cost|rates?)$",
    "about": r"(?i)^(about|about[-\s]us|our[-\s]firm|who[-\s]we[-\s]are|our[-\s]story|company)$",
    "services": r"(?i)^(services?|what[-\s]we[-\s]do|how[-\s]we[-\s]help|our[-\s]services|solutions?|our[-\s]approach)$",
    "contact": r"(?i)^(contact|contact[-\s]us|let'?s[-\s]chat|talk[-\s]to[-\s]us|book[-\s]a[-\s](call|meeting))$",
    "blog": r"(?i)^(blog|insights?|articles?|news|press|in[-\s]the[-\s]news|resources?)$",
}
PRIORITY = ("services", "about", "pricing", "blog", "contact")
# Signs of pages that are not there or refused; what addresses, phones and networks look like.
SOFT_404 = r"(?i)\b(page\s+not\s+found|404\s+not\s+found|not\s+found|oops)\b"
CHALLENGE = r"(?i)checking your browser|403 - forbidden|access denied"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"(?:\+?1[-.\s]?)?\(?[2-9][0-9]{2}\)?[-.\s]?[0-9]{3}[-.\s]?[0-9]{4}"
SOCIAL = {
    "linkedin": r"(?i)linkedin\.com/(company|in|school)/[^\s\"'?#]+",
    "twitter": r"(?i)(twitter\.com|x\.com)/[A-Za-z0-9_]+",
    "facebook": r"(?i)facebook\.com/[^\s\"'?#]+",
    "youtube": r"(?i)(youtube\.com/(channel|user|@[^\s\"'?#]+)|youtu\.be/[^\s\"'?#]+)",
    "instagram": r"(?i)instagram\.com/[^\s\"'?#]+",
}


def kind_of(kind: Column) -> Column:
    """A capture's kind in lower case; a blog's index is told from its posts."""
    k = F.lower(tx.or_else(kind, "unknown"))
    return F.when(k == "blog", "blog_index").otherwise(k)


def site_entries(pages: DataFrame) -> DataFrame:
    return pages.select(
        "firm", F.lit("site").alias("source"), kind_of(F.col("kind")).alias("kind"), "url", F.trim(F.coalesce("title", F.lit(""))).alias("title"),
        F.nullif(F.col("meta")["description"], F.lit("")).alias("description"), F.size("headings").alias("heading_count"),
    )


def post_entries(posts: DataFrame) -> DataFrame:
    return posts.select("firm", F.lit("blog").alias("source"), F.lit("blog_post").alias("kind"), "url", F.trim(F.coalesce("title", F.lit(""))).alias("title"), F.col("post_date").alias("date"), "word_count", F.when(F.size("tags") > 0, F.col("tags")).alias("tags"))


def page_index(pages: DataFrame, posts: DataFrame) -> DataFrame:
    """Site pages and posts, a column of either side null on the other."""
    return site_entries(pages).unionByName(post_entries(posts), allowMissingColumns=True)


def kinds_by_firm(index: DataFrame) -> DataFrame:
    return index.groupBy("firm", "kind").agg(F.count("*").alias("n"))


def kind_map(index: DataFrame) -> DataFrame:
    """(firm, kinds): the tally as a map; a firm has as many entries as there are kinds."""
    return kinds_by_firm(index).groupBy("firm").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "n")))).alias("kinds"))


def totals(index: DataFrame) -> DataFrame:
    """(kind, n) for each kind and, with a null kind, for all."""
    return index.rollup("kind").agg(F.count("*").alias("n"), F.count_if(F.col("source") == "site").alias("site_pages"), F.count_if(F.col("source") == "blog").alias("blog_posts"))


def kind_order(kind: Column) -> list[Column]:
    """Kinds by name, posts last."""
    return [kind == "blog_post", kind]


def is_soft_404(title: Column, h1: Column) -> Column:
    """Whether a page that was served says that it isn't there."""
    return F.concat_ws("\n", F.coalesce(title, F.lit("")), F.coalesce(h1, F.lit(""))).rlike(SOFT_404)


def is_challenge(html: Column) -> Column:
    """Whether a robot check or refusal stands at the start."""
    return F.coalesce(F.substring(html, 1, 5000).rlike(CHALLENGE), F.lit(False))


def ctas(items: Column, most: int = 30) -> Column:
    """The calls to action of a page: not empty, at most 60 characters, the first `most`."""
    return F.slice(F.filter(items, lambda c: (F.trim(c["text"]) != "") & (F.length(c["text"]) <= 60)), 1, most)


def found(pattern: str, text: Column, most: int = 10) -> Column:
    """The different matches in a text in order of appearance, at most `most`."""
    return F.slice(F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))), 1, most)


def haystacks(pages: DataFrame) -> DataFrame:
    """(firm, place, text): the texts that contacts are mined from: links of the calls to action, then the body, page by page in order of address."""
    hay = F.concat(F.coalesce(F.transform(F.filter("ctas", lambda c: F.coalesce(c["href"], F.lit("")) != ""), lambda c: c["href"]), F.array().cast("array<string>")), F.when(F.coalesce(F.col("body_text"), F.lit("")) != "", F.array("body_text")).otherwise(F.array().cast("array<string>")))
    return pages.select("firm", F.struct("url", "page_id").alias("at"), F.posexplode(hay).alias("n", "text")).select("firm", F.struct("at.url", "at.page_id", "n").alias("place"), "text")


def contacts(pages: DataFrame, most: int = 10) -> DataFrame:
    """(firm, kind, rank, value): distinct e-mail addresses and phones in order of appearance, at most `most` of each per firm.

    The first place of each value is found by a combined aggregation, so only distinct values are ranked, not matches.
    """
    from pyspark.sql import Window

    hay = haystacks(pages)
    each = [hay.select("firm", F.lit(kind).alias("kind"), "place", F.posexplode(F.regexp_extract_all("text", F.lit(p), F.lit(0))).alias("m", "value")) for kind, p in (("email", EMAIL), ("phone", PHONE))]
    first = each[0].unionByName(each[1]).groupBy("firm", "kind", "value").agg(F.min(F.struct("place", "m")).alias("first"))
    rank = F.row_number().over(Window.partitionBy("firm", "kind").orderBy("first"))
    return first.withColumn("rank", rank).where(F.col("rank") <= most).select("firm", "kind", "rank", "value")


def socials(pages: DataFrame) -> DataFrame:
    """(firm, network, address): the first address of each network, with https:// where a scheme lacks."""
    hay = haystacks(pages)
    matches = hay.select("firm", "place", F.inline(F.array(*[F.struct(F.lit(k).alias("network"), F.nullif(F.regexp_extract("text", p, 0), F.lit("")).alias("m")) for k, p in SOCIAL.items()]))).where("m is not null")
    best = matches.groupBy("firm", "network").agg(F.min_by("m", "place").alias("m"))
    return best.select("firm", "network", F.when(F.col("m").startswith("http"), F.col("m")).otherwise(F.concat(F.lit("https://"), F.col("m"))).alias("address"))
