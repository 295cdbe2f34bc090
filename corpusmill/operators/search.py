"""Keyword search: an inverted index in three tables and ranked queries on it.

Scores are BM25+ with k=1.2, b=0.7, d=0.5 and idf = ln(1 + (N - df + 0.5) / (df + 0.5)), per field, times the field's boost; terms are joined by OR. A term
also matches longer terms that begin with it (weight 0.375) and terms within a fifth of its length in edits (weight 0.45), each less
the farther they are.

Postings are pre-aggregated per document before they are shuffled; a query touches the terms that match, not the documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.cluster import materialize, sized

K, B, D = 1.2, 0.7, 0.5
PREFIX_WEIGHT, FUZZY_WEIGHT, FUZZY = 0.375, 0.45, 0.2
#: Boosts of a section's fields.
BOOSTS = {"firm": 4.0, "heading": 3.0, "tags": 2.0, "body": 1.0}
K_DEFAULT, K_MOST = 8, 25


def terms(text: Column) -> Column:
    """Lower-case words: runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


@dataclass
class Index:
    postings: DataFrame  # term, field, id, tf, and len, the terms of the field
    lengths: DataFrame  # id, field, len
    vocabulary: DataFrame  # term, field, df
    totals: DataFrame  # field, docs, mean_len


def build(docs: DataFrame, key: str, fields: list[str]) -> Index:
    """The index of (key, fields); null fields have no terms. Texts are read and split once."""
    one = materialize(docs.select(F.col(key).alias("id"), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), terms(F.coalesce(F.col(f), F.lit(""))).alias("terms")) for f in fields])).alias("x")).select("id", "x.field", "x.terms"))
    lengths = one.select("id", "field", F.size("terms").alias("len"))
    postings = materialize(one.select("id", "field", F.size("terms").alias("len"), F.explode("terms").alias("term")).groupBy("term", "field", "id", "len").agg(F.count("*").alias("tf")))
    vocabulary = postings.groupBy("term", "field").agg(F.count("*").alias("df"))
    totals = lengths.groupBy("field").agg(F.count("*").alias("docs"), F.avg("len").alias("mean_len"))
    return Index(postings, lengths, vocabulary, totals)


def save(index: Index, folder: str) -> None:
    """Four Parquet tables; postings are sorted by term within files, so that a query's terms prune row groups."""
    index.postings.repartitionByRange("term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{folder}/postings")
    for name in ("lengths", "vocabulary", "totals"):
        getattr(index, name).write.mode("overwrite").parquet(f"{folder}/{name}")


def load(spark: SparkSession, folder: str) -> Index:
    return Index(*[spark.read.parquet(f"{folder}/{name}") for name in ("postings", "lengths", "vocabulary", "totals")])


def matching_terms(vocabulary: DataFrame, query: str, prefix: bool = True, fuzzy: float = FUZZY) -> DataFrame:
    """(term, weight) of the indexed terms that a query's words match; a term takes its best weight per word, summed over words."""
    words = sorted({w for w in "".join(c if c.isalnum() else " " for c in query.lower()).split()})
    if not words:
        return vocabulary.where("false").select("term", F.lit(1.0).alias("weight"))
    found = None
    for w in words:
        t = F.col("term")
        exact = F.when(t == w, F.lit(1.0))
        longer = F.when(t.startswith(w) & (t != w), PREFIX_WEIGHT * len(w) / (len(w) + 0.3 * (F.length(t) - len(w))))
        most = min(6, round(fuzzy * len(w)))
        edits = F.levenshtein(t, F.lit(w), most) if most else F.lit(-1)
        near = F.when((edits > 0), FUZZY_WEIGHT * len(w) / (len(w) + edits))
        options = [exact] + ([longer] if prefix else []) + ([near] if most else [])
        weight = F.greatest(*[F.coalesce(o, F.lit(0.0)) for o in options]) if len(options) > 1 else F.coalesce(exact, F.lit(0.0))
        close = t.startswith(w) if prefix else F.lit(False)
        if most:
            close = close | F.length(t).between(len(w) - most, len(w) + most)
        part = vocabulary.where((t == w) | close).select("term").distinct().withColumn("weight", weight).where("weight > 0")
        found = part if found is None else found.unionByName(part)
    return found.groupBy("term").agg(F.sum("weight").alias("weight"))


def ranked(index: Index, query: str, k: int = K_DEFAULT, boosts: dict[str, float] | None = None, prefix: bool = True, fuzzy: float = FUZZY) -> DataFrame:
    """(id, score) of the k best documents; ties by id."""
    boosts = boosts or {}
    boost = F.coalesce(*[F.when(F.col("field") == f, F.lit(b)) for f, b in boosts.items()], F.lit(1.0)) if boosts else F.lit(1.0)
    wanted = matching_terms(index.vocabulary, query, prefix, fuzzy)
    terms_ = materialize(wanted.join(index.vocabulary, "term"))  # only what the query's words match; the documents' lengths stand in the postings
    hits = index.postings.join(sized(terms_), ["term", "field"]).join(F.broadcast(index.totals), "field")
    idf = F.log(1 + (F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    gain = D + F.col("tf") * (K + 1) / (F.col("tf") + K * (1 - B + B * F.col("len") / F.col("mean_len")))
    scored = hits.groupBy("id").agg(F.sum(boost * F.col("weight") * idf * gain).alias("score"))
    return scored.orderBy(F.desc("score"), "id").limit(k)


def clamp_k(value: str | int | None) -> int:
    """The number of hits asked for: 8 where it is missing, zero or no number, else between 1 and 25."""
    digits = str(value or "").strip()
    sign = -1 if digits.startswith("-") else 1
    head = digits.lstrip("+-")
    number = ""
    for c in head:
        if not c.isdigit():
            break
        number += c
    return max(1, min(K_MOST, sign * int(number) if number and int(number) else K_DEFAULT))
