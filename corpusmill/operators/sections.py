"""Markdown documents split into sections with stable anchors.

A heading of level 1 or 2 opens a section; deeper ones stay inside. Text before the first heading is a section of its own under the fallback title. The
heading line stays in the body, and code fences are not special. Lines with \\r at their end are read without it.

One document's lines never leave its row: the split is a chain of array expressions, so it needs no shuffle. Only anchors look across a document's
sections, in the same row too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions import text as tx

HEADING = r"^(#{1,2})\s+(.*)$"


def split_body(body: Column, fallback: Column) -> Column:
    """array of (level, heading, body) in the document's order, without empty sections."""
    lines = F.split(F.replace(body, F.lit("\r\n"), F.lit("\n")), "\n", -1)
    # the places where sections begin (the first line, and each heading), and the lines from each to the next
    starts = F.array_distinct(F.concat(F.array(F.lit(1)), F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(HEADING), i + 1).otherwise(0)), lambda i: i > 0)))
    ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))), F.array(F.size(lines) + 1))
    pieces = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda p: F.array_join(F.slice(lines, p["a"], p["b"] - p["a"]), "\n"))

    def section(piece: Column) -> Column:
        first = F.substring_index(piece, "\n", 1)
        is_heading = first.rlike(HEADING)
        title = F.trim(F.regexp_replace(F.regexp_extract(first, HEADING, 2), r"\s*#+\s*$", ""))
        return F.struct(
            F.when(is_heading, F.length(F.regexp_extract(first, HEADING, 1))).otherwise(1).alias("level"),
            F.when(is_heading, title).otherwise(fallback).alias("heading"),
            F.regexp_replace(piece, r"^\s+|\s+\z", "").alias("body"),
        )

    return F.filter(F.transform(pieces, section), lambda s: s["body"] != "")


def sections(docs: DataFrame, scope: list[str], body: str, title: str, strict: bool = False) -> DataFrame:
    """A row per section: scope columns, ordinal, level, heading, anchor, words, snippet and body.

    An anchor is the heading's slug; from the second on of one slug in a document it ends in -n. With `strict` a suffixed anchor
    that is another heading's own slug gets another ordinal suffix, so anchors are unique.
    """
    rows = docs.where(F.col(body).isNotNull()).select(*scope, F.posexplode(split_body(F.col(body), F.coalesce(F.col(title), F.lit("")))).alias("pos", "s"))
    rows = rows.select(*scope, (F.col("pos") + 1).alias("ordinal"), "s.level", "s.heading", "s.body").withColumn("base", tx.slug(F.col("heading")))
    nth = F.row_number().over(Window.partitionBy(*scope, "base").orderBy("ordinal"))
    rows = rows.withColumn("nth", nth).withColumn("anchor", F.when(F.col("nth") > 1, F.concat_ws("-", "base", "nth")).otherwise(F.col("base")))
    if strict:
        again = F.row_number().over(Window.partitionBy(*scope, "anchor").orderBy("ordinal"))
        rows = rows.withColumn("anchor", F.when(again > 1, F.concat_ws("-", "anchor", F.concat(F.lit("s"), F.col("ordinal").cast("string")))).otherwise(F.col("anchor")))
    return rows.select(*scope, "ordinal", "level", "heading", "anchor", tx.section_words(F.col("body")).alias("words"), tx.snippet(F.col("body")).alias("snippet"), "body")


def identity(firm: Column, doc: Column, anchor: Column) -> list[Column]:
    """A section's id and the path of its own file."""
    return [F.concat_ws("::", firm, doc, anchor).alias("id"), F.concat(F.lit("/sections/"), F.concat_ws("/", firm, doc, anchor), F.lit(".md")).alias("path")]
