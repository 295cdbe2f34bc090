"""Documents written from the catalog: firm pages, the matrix as Markdown, the page index as one document, statistics, snapshot sentences, prompts' facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.functions import values as v


def snapshot_sentence() -> Column:
    """The numbers of a snapshot as one sentence: counts that are missing are ?, a sum that is missing is $0, optional parts only where they are there."""
    parts = [
        F.concat(v.grouped_number(F.col("employee_count")), F.lit(" employees")),
        F.concat(v.grouped_number(F.col("advisor_count")), F.lit(" advisors")),
        F.concat(F.lit("$"), F.format_number(F.coalesce("aum_usd", F.lit(0)), 0), F.lit(" under management")),
        F.when(F.col("branch_count").isNotNull(), F.concat(F.format_number("branch_count", 0), F.lit(" branches"))),
        F.when(F.col("aum_as_of").isNotNull(), F.concat(F.lit("as of "), F.col("aum_as_of"))),
    ]
    return F.concat_ws("; ", *parts)


def firm_facts() -> Column:
    """The line of facts on a firm's page."""
    return tx.facts_line(F.col("competitor_type"), F.col("regulator"), F.when(F.col("aum_usd").isNotNull(), tx.billions(F.col("aum_usd"))), F.col("website"), tx.plural(F.col("posts"), "post", "posts"))


def posts_by_date(posts: DataFrame, firm: str = "firm", date: str = "date", key: str = "url") -> DataFrame:
    """posts with `place`, each firm's newest first, undated last, ties by key. Places are counted by month and put behind those of later months, so a
    firm with a large part of all posts is no single task."""
    rows = posts.withColumn("_month", F.substring(F.coalesce(F.col(date), F.lit("")), 1, 7))
    months = rows.groupBy(firm, "_month").agg(F.count("*").alias("_n"))
    before = months.withColumn("_before", F.sum("_n").over(Window.partitionBy(firm).orderBy(F.desc("_month"))) - F.col("_n")).select(F.col(firm).alias("_f"), F.col("_month").alias("_m"), "_before")
    own = F.row_number().over(Window.partitionBy(firm, "_month").orderBy(F.desc(F.coalesce(F.col(date), F.lit(""))), key))
    both = rows.withColumn("_own", own).join(before, F.col(firm).eqNullSafe(F.col("_f")) & (F.col("_month") == F.col("_m")))
    return both.withColumn("place", (F.col("_before") + F.col("_own")).cast("bigint")).drop("_month", "_own", "_f", "_m", "_before")


def firm_page_lines(digest: DataFrame, documents: DataFrame, posts: DataFrame) -> DataFrame:
    """(slug, part, place, line): a firm's page, line by line: its name, its facts, links to its documents (slug, name), its posts (firm, date, title, url)."""
    one = F.lit(1).cast("bigint")
    head = digest.select("slug", F.lit(0).alias("part"), one.alias("place"), F.concat(F.lit("# "), F.coalesce("competitor", "slug")).alias("line"))
    facts = digest.select("slug", F.lit(1).alias("part"), one.alias("place"), firm_facts().alias("line"))
    of = F.row_number().over(Window.partitionBy("slug").orderBy("name")).cast("bigint")  # a firm has few documents
    links = documents.select("slug", F.lit(2).alias("part"), of.alias("place"), F.concat(F.lit("- ["), tx.document_label(F.col("name")), F.lit("](/"), F.col("slug"), F.lit("/"), F.col("name"), F.lit(")")).alias("line"))
    listed = posts_by_date(posts).join(digest.select(F.col("slug").alias("firm")).distinct(), "firm", "left_semi")
    shown = listed.select(F.col("firm").alias("slug"), F.lit(3).alias("part"), "place", F.concat(F.lit("- "), F.coalesce("date", F.lit("undated")), F.lit(": ["), F.coalesce("title", F.lit("Untitled")), F.lit("]("), F.coalesce("url", F.lit("")), F.lit(")")).alias("line"))
    return head.unionByName(facts).unionByName(links).unionByName(shown)


def matrix_row(section: Column, dimension: Column, cells: Column) -> Column:
    """A line of the matrix in Markdown: bars in cells are escaped."""
    safe = F.transform(cells, lambda c: F.replace(c, F.lit("|"), F.lit("\\|")))
    return F.concat(F.lit("| "), F.concat_ws(" / ", section, dimension), F.lit(" | "), F.array_join(safe, " | "), F.lit(" |"))


def matrix_markdown(long: DataFrame, block: Column) -> DataFrame:
    """(section, dimension, block, line): the long matrix with a column per firm, in order of firms. Firms come in blocks, so that a line stays bounded."""
    cells = long.withColumn("block", block).groupBy("section", "dimension", "block").agg(F.transform(F.array_sort(F.collect_list(F.struct("firm", "value"))), lambda x: x["value"]).alias("cells"))
    return cells.select("section", "dimension", "block", matrix_row(F.col("section"), F.col("dimension"), F.col("cells")).alias("line"))


def index_document(index: DataFrame, entries: int = 1_000) -> DataFrame:
    """(firm, kind, part, document): the entries of a firm and kind as JSON, in parts of about `entries`, so that a large firm is no large group."""
    sizes = index.groupBy("firm", "kind").agg(F.count("*").alias("n")).where(F.col("n") > entries)
    split = index.join(sizes.select(F.col("firm").alias("_f"), F.col("kind").alias("_k"), "n"), F.col("firm").eqNullSafe(F.col("_f")) & (F.col("kind") == F.col("_k")), "left")
    part = F.when(F.col("n").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("url", "title"), F.ceil(F.col("n") / entries))).cast("int")
    return split.withColumn("part", part).groupBy("firm", "kind", "part").agg(F.to_json(F.array_sort(F.collect_list(F.struct("title", "url")))).alias("document"))


def statistics(metadata: DataFrame, posts: DataFrame) -> DataFrame:
    """One row: firms, firms with posts, posts, and firms without any post."""
    firms = metadata.where("slug is not null").select("slug").distinct()
    with_posts = posts.where("firm is not null").groupBy("firm").agg(F.countDistinct("url").alias("n"))
    joined = firms.join(with_posts, firms.slug == with_posts.firm, "left")
    return joined.agg(F.count("*").alias("firms"), F.count("n").alias("with_posts"), F.coalesce(F.sum("n"), F.lit(0)).alias("posts"), F.count_if(F.col("n").isNull()).alias("without_posts"))


def facts_again(old: DataFrame, new: DataFrame) -> DataFrame:
    """Facts captured anew with what people wrote and the registry's part kept from the old ones: (competitor, auto_filled, manual)."""
    o = old.select("competitor", F.col("auto_filled").alias("_a"), F.col("manual").alias("_m"))
    kept = F.col("_a")["sec_iapd"]
    auto = F.when(kept.isNotNull() & F.col("auto_filled").isNotNull(), F.col("auto_filled").withField("sec_iapd", kept)).otherwise(F.coalesce("auto_filled", "_a"))
    return new.join(o, "competitor", "left").select("competitor", auto.alias("auto_filled"), F.coalesce("_m", "manual").alias("manual"))


def unmatched(name: Column, note: str) -> Column:
    """What stands for the registry's part of a firm that it doesn't have."""
    return F.struct(F.lit(False).alias("matched"), name.alias("queried_as"), F.lit(note).alias("note"))


def responses_unwrapped(df: DataFrame, column: str, source: str) -> DataFrame:
    """A row for each hit of stored search responses {hits: {hits: [{_source: ...}]}}; source is the schema of a hit."""
    parsed = F.from_json(column, f"hits struct<hits:array<struct<_source:{source}>>>")
    return df.select(*[c for c in df.columns if c != column], F.explode(parsed["hits"]["hits"]).alias("_h")).select(*[c for c in df.columns if c != column], "_h._source.*")
