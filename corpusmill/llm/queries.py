"""The queries on training text: (spark, folder of tables) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.cluster import table
from corpusmill.llm import boilerplate, encoding, entities, leaks, mixture, repeated_lines, residue


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return repeated_lines.repeated_lines(table(spark, d, "post_index_entry"))


def p1_clean_posts(spark: SparkSession, d: str) -> DataFrame:
    """Every post's text without its site's lines."""
    return repeated_lines.without_repeated_lines(table(spark, d, "post_index_entry")).select("post_id", "file", "clean_text")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return entities.matches(table(spark, d, "firm_metadata"), table(spark, d, "iapd_hit")).select("slug", "firm_source_id")


def p2_confidence(spark: SparkSession, d: str) -> DataFrame:
    """All candidate pairs with their marginal probabilities."""
    return entities.match_firms(table(spark, d, "firm_metadata"), table(spark, d, "iapd_hit"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.main_content(table(spark, d, "page_capture"))


def p3_main_text(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.main_text(table(spark, d, "page_capture"))


def p3_wrappers(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.wrappers(table(spark, d, "page_capture"))


def _records(spark: SparkSession, d: str) -> DataFrame:
    pages = residue.record_texts(table(spark, d, "page_capture"), "page_capture", "page_id")
    return pages.unionByName(residue.record_texts(table(spark, d, "post_index_entry"), "post_index_entry", "post_id"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.residue_records(_records(spark, d))


def p4_kept_posts(spark: SparkSession, d: str) -> DataFrame:
    """The posts without those that hold residue."""
    found = residue.residue_records(_records(spark, d))
    return residue.without_residue(table(spark, d, "post_index_entry"), "post_index_entry", "post_id", found).select("post_id", "title", F.length("body_text").alias("chars"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.find_leaks(table(spark, d, "documents"), table(spark, d, "eval_item")).select("doc_id", "item_id")


def p6_leaked_items(spark: SparkSession, d: str) -> DataFrame:
    """Each evaluation item with the number of documents that hold it, and the largest piece."""
    found = leaks.find_leaks(table(spark, d, "documents"), table(spark, d, "eval_item"))
    per = found.groupBy("item_id").agg(F.count("*").alias("documents"), F.max("words").alias("most_words"))
    return table(spark, d, "eval_item").select("item_id", "suite").join(per, "item_id", "left").select("item_id", "suite", F.coalesce("documents", F.lit(0)).cast("bigint").alias("documents"), "most_words")


def p7_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixture.mixture(table(spark, d, "documents"), table(spark, d, "mix_target"))


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixture.shares(table(spark, d, "documents"), table(spark, d, "mix_target"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return encoding.garbled(table(spark, d, "documents")).select("doc_id")


def p8_restored(spark: SparkSession, d: str) -> DataFrame:
    return encoding.restore(table(spark, d, "documents"))


def p8_mapping(spark: SparkSession, d: str) -> DataFrame:
    """The learned substitution tables."""
    return encoding.learned_mapping(table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (p1_found, p1_clean_posts, p2_found, p2_confidence, p3_found, p3_main_text, p3_wrappers, p4_found, p4_kept_posts, p6_found, p6_leaked_items, p7_mixture, p7_shares, p8_found, p8_restored, p8_mapping)}

_MONTHS = repeated_lines.MONTHS
#: The definition of problem 1 itself, in SQL.
_P1 = rf"""
with line as (
  select post_id, firm, url, unnest(string_split(body_text, chr(10))) as t, generate_subscripts(string_split(body_text, chr(10)), 1) as n
  from post_index_entry where firm is not null and body_text is not null),
keyed as (
  select post_id, firm, url, n, regexp_replace(regexp_replace(regexp_replace(lower(t), '[^\p{{L}}\p{{M}}]+', ' ', 'g'), '(^| )({_MONTHS})( ({_MONTHS}))*( |$)', ' ', 'g'), ' +', '', 'g') as k
  from line where regexp_matches(t, '\p{{L}}')),
site as (select firm, count(distinct url) as urls from post_index_entry where firm is not null group by firm),
hot as (select firm, k from keyed join site using (firm) group by firm, k, urls having count(distinct url) >= 5 and count(distinct url) >= 0.1 * urls)
select distinct post_id, n::bigint as line_no from keyed join hot using (firm, k)"""

ORACLE = {"p1_found": _P1}
