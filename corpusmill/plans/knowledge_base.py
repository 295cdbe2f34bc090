"""The knowledge base as one plan: posts and pages to sections, digest and search index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.operators import catalog, search, sections


def post_sections(posts: DataFrame) -> DataFrame:
    """Sections of posts (of each url the last capture), with ids and paths."""
    last = catalog.latest(posts.where("url is not null"), "url", F.col("captured"), F.col("post_id"))
    docs = last.select(F.coalesce("firm", F.lit("")).alias("firm"), F.regexp_replace(F.concat_ws("-", "file", F.col("post_id").cast("string")), r"\.md", "").alias("doc"), tx.clean_title(F.coalesce("title", F.lit("Untitled"))).alias("title"), "tags", "body_text")
    docs = docs.withColumn("tags", F.coalesce(F.array_join("tags", " "), F.lit("")))
    rows = sections.sections(docs, ["firm", "doc", "tags"], "body_text", "title")
    return rows.select(*sections.identity(F.col("firm"), F.col("doc"), F.col("anchor")), "firm", "doc", "tags", "ordinal", "level", "heading", "anchor", "words", "snippet", "body")


def section_union(*scopes: tuple[str, DataFrame, str, str, str]) -> DataFrame:
    """(scope, doc, ordinal, level, heading, anchor, words): the sections of firm, market and context documents in one table, from (scope, documents,
    key, body, title) of each."""
    out = None
    for scope, df, key, body, title in scopes:
        docs = df.select(F.col(key).cast("string").alias("doc"), F.col(body).alias("body_text"), F.col(title).alias("title"))
        part = sections.sections(docs, ["doc"], "body_text", "title").select(F.lit(scope).alias("scope"), "doc", "ordinal", "level", "heading", "anchor", "words")
        out = part if out is None else out.unionByName(part)
    return out


def digest(metadata: DataFrame, posts: DataFrame) -> DataFrame:
    """A row per firm: its last snapshot, whether it has a corpus and how many posts that has."""
    last = catalog.latest(metadata, "slug", F.col("last_updated"), F.col("meta_id"))
    counted = posts.where("firm is not null").groupBy("firm").agg(F.countDistinct("url").alias("posts"))
    both = last.join(counted, last.slug == counted.firm, "left")
    return both.select(*metadata.columns, F.coalesce("posts", F.lit(0)).cast("bigint").alias("posts"), (F.coalesce("posts", F.lit(0)) > 0).alias("has_corpus"))


def digest_rows(metadata: DataFrame, posts: DataFrame, caveats: DataFrame) -> DataFrame:
    """The digest with each firm's caveat, the sections of its posts and the posts themselves left to `listed_posts`, which stays distributed."""
    counted = post_sections(posts).groupBy("firm").agg(F.count("*").alias("sections"), F.sum("words").alias("section_words"))
    both = catalog.with_caveats(digest(metadata, posts), caveats).join(counted.withColumnRenamed("firm", "_firm"), F.col("slug") == F.col("_firm"), "left").drop("_firm")
    return both.withColumn("sections", F.coalesce("sections", F.lit(0)).cast("bigint")).withColumn("section_words", F.coalesce("section_words", F.lit(0)).cast("bigint"))


def listed_posts(listed: DataFrame, files: DataFrame, *keys: str) -> DataFrame:
    """The posts of an index whose file is there; what is listed but missing is left out."""
    return listed.join(files.select(*keys).distinct(), list(keys), "left_semi")


def section_index(rows: DataFrame) -> search.Index:
    return search.build(rows, "id", ["firm", "heading", "tags", "body"])
