"""Checks of the corpus and catalog: vocabulary, freshness, mirrors, repeated titles, colours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def off_vocabulary(df: DataFrame, tags: str, vocabulary: DataFrame) -> DataFrame:
    """(tag, n): tags that the controlled list (tag) doesn't have."""
    return df.select(F.explode(tags).alias("tag")).where("tag is not null").join(vocabulary.select("tag").distinct(), "tag", "left_anti").groupBy("tag").agg(F.count("*").alias("n"))


def is_stale(due: Column, today: str) -> Column:
    """Due before today; missing or unreadable counts as due."""
    d = F.try_to_date(due, "yyyy-MM-dd")
    return d.isNull() | (d < F.to_date(F.lit(today)))


def next_review(today: str, cadence: Column, default: int = 90) -> Column:
    return F.date_format(F.date_add(F.to_date(F.lit(today)), F.coalesce(cadence, F.lit(default)).cast("int")), "yyyy-MM-dd")


def repeated(df: DataFrame, *keys: str) -> DataFrame:
    """Groups of rows that share the keys, with their number."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def drifted(canonical: DataFrame, mirror: DataFrame, key: str, text: str) -> DataFrame:
    """(key, state): records whose copy differs or is on one side only."""
    a, b = canonical.select(key, F.sha2(text, 256).alias("a"), F.lit(True).alias("in_a")), mirror.select(key, F.sha2(text, 256).alias("b"), F.lit(True).alias("in_b"))
    both = a.join(b, key, "full_outer")
    state = F.when(F.col("in_b").isNull(), "missing").when(F.col("in_a").isNull(), "extra").when(~F.col("a").eqNullSafe(F.col("b")), "differs")
    return both.select(key, state.alias("state")).where("state is not null")


def palette(df: DataFrame, key: str, colours: str, most: int = 8) -> DataFrame:
    """(key, palette, primary, accent): the most frequent colours, ties by first appearance; the second is primary, the third accent."""
    from pyspark.sql import Window

    seen = df.select(key, F.posexplode(colours).alias("pos", "colour")).where("colour is not null").groupBy(key, "colour").agg(F.count("*").alias("n"), F.min("pos").alias("first"))
    ranked = seen.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), "first"))).where(F.col("place") <= most)
    listed = ranked.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "colour"))), lambda x: x["colour"]).alias("palette"))  # at most `most` each
    return listed.select(key, "palette", F.try_element_at("palette", F.lit(2)).alias("primary"), F.try_element_at("palette", F.lit(3)).alias("accent"))
