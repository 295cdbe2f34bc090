"""Readers: every source gives a DataFrame with a declared schema; a malformed file gives no row or a null, never an error."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.cluster import exists

SKIPPED = ("README.md", "_template", ".DS_Store")


def json_documents(spark: SparkSession, glob: str, schema: T.StructType) -> DataFrame:
    """One JSON document per file, with the folder's name in `folder`; folders that begin with _ and malformed files are left out."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    df = spark.read.schema(full).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(glob)
    df = df.withColumn("folder", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
    return df.where(F.col("_corrupt").isNull() & ~F.col("folder").startswith("_")).drop("_corrupt")


def tolerant_json(df: DataFrame, column: str, schema: str) -> DataFrame:
    """A JSON column as a struct, null where it is malformed."""
    return df.withColumn(column, F.from_json(column, schema, {"mode": "PERMISSIVE"}))


def folders(spark: SparkSession, glob: str) -> DataFrame:
    """(folder): the folders that hold files, without those that every tree has."""
    files = spark.read.format("binaryFile").load(glob).select(F.element_at(F.split("path", "/"), -2).alias("folder"))
    return files.where(~F.col("folder").isin(*SKIPPED)).distinct()


FRONT = r"(?s)\A---\r?\n(.*?)\r?\n---\r?\n?(.*)\z"


def markdown_documents(spark: SparkSession, glob: str) -> DataFrame:
    """(path, folder, name, front, body): Markdown files with their YAML header apart; front is null without one."""
    df = spark.read.text(glob, wholetext=True).withColumn("path", F.col("_metadata.file_path"))
    has = F.col("value").rlike(FRONT)
    return df.select(
        "path", F.element_at(F.split("path", "/"), -2).alias("folder"), F.element_at(F.split("path", "/"), -1).alias("name"),
        F.when(has, F.regexp_extract("value", FRONT, 1)).alias("front"), F.when(has, F.regexp_extract("value", FRONT, 2)).otherwise(F.col("value")).alias("body"),
    )


def front_fields(df: DataFrame, column: str = "front") -> DataFrame:
    """Adds `fields`, the header's keys and values as text (lists as JSON); read line by line, quoted strings without their quotes."""

    def parse(text: str | None) -> dict[str, str] | None:
        if not isinstance(text, str):
            return None
        import json

        out: dict[str, str] = {}
        for line in text.splitlines():
            key, colon, value = line.partition(":")
            key, value = key.strip(), value.strip()
            if not colon or not key or line[:1] in " \t#-":
                continue
            if value[:1] == '"' == value[-1:] and len(value) > 1:
                try:
                    value = json.loads(value)
                except ValueError:
                    value = value[1:-1]
            elif value[:1] == "'" == value[-1:] and len(value) > 1:
                value = value[1:-1].replace("''", "'")
            out[key] = value
        return out

    schema = T.StructType([*df.schema.fields, T.StructField("fields", T.MapType(T.StringType(), T.StringType()))])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.assign(fields=[parse(x) for x in f[column]])

    return df.mapInPandas(run, schema)


def table_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table, or none of its rows where the path isn't there."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def page_bundles(df: DataFrame, order: list[str]) -> DataFrame:
    """Captures in a fixed order of kinds; unknown kinds first."""
    return df.orderBy(F.array_position(F.array(*[F.lit(k) for k in order]), F.coalesce(F.col("kind"), F.lit(""))), "url")


def pictures(spark: SparkSession, glob: str, preferred: list[str], most_bytes: int = 4_500_000, most: int = 4) -> DataFrame:
    """(name, base64): the first preferred pictures that aren't too large."""
    df = spark.read.format("binaryFile").load(glob).where(F.col("length") <= most_bytes)
    df = df.withColumn("name", F.element_at(F.split("path", "/"), -1)).withColumn("place", F.array_position(F.array(*[F.lit(p) for p in preferred]), F.col("name")))
    return df.where("place > 0").orderBy("place").limit(most).select("name", F.base64("content").alias("base64"))
