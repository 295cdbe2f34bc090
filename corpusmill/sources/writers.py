"""Writers. All are distributed writes; where one file is wanted its rows are ordered first and the file is bounded by the catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.operators.catalog import CSV_HEADERS, csv_line


def csv_text(df: DataFrame, path: str, order: list[Column]) -> None:
    """The catalog as CSV with its headers; byte for byte the same for the same rows."""
    head = df.sparkSession.createDataFrame([(0, ",".join(_cell(h) for h in CSV_HEADERS.values()))], "part int, value string")
    lines = df.orderBy(*order).select(F.lit(1).alias("part"), csv_line(df).alias("value"), F.monotonically_increasing_id().alias("n"))
    head.withColumn("n", F.lit(0).cast("bigint")).unionByName(lines).orderBy("part", "n").coalesce(1).select("value").write.mode("overwrite").text(path)


def _cell(text: str) -> str:
    return '"' + text.replace('"', '""') + '"' if any(c in text for c in '",\n') else text


def json_lines(df: DataFrame, path: str) -> None:
    """One object per line, null fields kept."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def section_files(sections: DataFrame, path: str) -> None:
    """Sections by firm and document, for reading one document's without the rest."""
    sections.repartition("firm", "doc").sortWithinPartitions("firm", "doc", "ordinal").write.mode("overwrite").partitionBy("firm").parquet(path)


def post_markdown(posts: DataFrame) -> Column:
    """A post as Markdown below a header with its fields."""
    fields = {k: F.col(k).cast("string") for k in ("title", "url", "author")} | {"date": F.col("post_date")}
    return F.concat(tx.front_matter(fields, {"tags": F.coalesce(F.col("tags"), F.array().cast("array<string>"))}), F.lit("\n\n"), F.coalesce(F.col("body_text"), F.lit("")), F.lit("\n"))


def manifest(digest: DataFrame) -> DataFrame:
    """(slug, line): a line for each firm with its facts, sorted by name over all partitions."""
    facts = tx.facts_line(F.col("competitor_type"), F.col("headquarters_state"), F.when(F.col("aum_usd").isNotNull(), tx.billions(F.col("aum_usd"))), tx.plural(F.col("posts"), "post", "posts"))
    return digest.orderBy(F.collate("competitor", "UNICODE"), "slug").select("slug", F.concat(F.lit("- "), F.trim("competitor"), F.lit(": "), facts).alias("line"))


def bundle(docs: DataFrame, wanted: list[str]) -> DataFrame:
    """(place, text): the wanted documents that are there, in their order, without headers and with a source line each."""
    place = F.array_position(F.array(*[F.lit(w) for w in wanted]), F.col("name"))
    rows = docs.withColumn("place", place).where("place > 0")
    return rows.select("place", F.concat(F.lit("<!-- "), F.col("name"), F.lit(" -->\n"), F.trim("body")).alias("text"))


def replace_if_changed(old: str | None, new: str) -> bool:
    """Whether a text has to be written again."""
    return old != new
