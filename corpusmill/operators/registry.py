"""Registry hits against a firm's name, and fields of regulatory filings as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.cluster import materialize, sized
from corpusmill.functions import text as tx
from corpusmill.functions import values as v
from corpusmill.operators.nested import valid_json

# Where a filing's text has its numbers.
FILING_NUMBERS = {
    "employee_count": r"(?i)Approximately how many employees do you have\?[\s\S]*?do not include any clerical workers\.\s*([0-9][0-9,]*)",
    "advisor_count": r"(?i)perform investment advisory functions \(including research\)\?\s*([0-9][0-9,]*)",
    "iar_state_count": r"(?i)registered with one or more state securities authorities as investment adviser representatives\?\s*([0-9][0-9,]*)",
    "aum_discretionary_usd": r"(?i)Discretionary:\s*\(a\)\s*\$\s*([0-9,]+)",
    "aum_nondiscretionary_usd": r"(?i)Non-Discretionary:\s*\(b\)\s*\$\s*([0-9,]+)",
    "aum_total_usd": r"(?i)Total:\s*\(c\)\s*\$\s*([0-9,]+)",
    "account_count_total": r"(?is)Total:.*?\(f\)\s*([0-9,]+)",
}
# Headings of disclosures, the other fee's place, an address's fields.
DISCLOSURE_HEADS = ("DRP - Criminal Disclosure", "DRP - Regulatory Disclosure", "DRP - Civil Judicial Disclosure")
OTHER_FEE = r"(?i)You are compensated for your investment advisory services[\s\S]*?\(7\)\s*Other\s*\(specify\)[:\s]*([^\n]*)"
ADDRESS_FIELDS = ("street1", "street2", "city", "state", "postalCode", "country")


def filing_fields(text: Column) -> list[Column]:
    """The numbers, evidence of disclosures, other fees and latest date of a filing."""
    numbers = [v.comma_number(F.nullif(F.regexp_extract(text, p, 1), F.lit(""))).alias(k) for k, p in FILING_NUMBERS.items()]
    filed = sum((F.regexp_count(text, F.lit(f"(?i){h}")) for h in DISCLOSURE_HEADS), F.lit(0))
    other = F.trim(F.regexp_extract(text, OTHER_FEE, 1))
    good = (F.length(other) > 1) & (F.length(other) < 200) & ~other.rlike(r"(?i)^Item\s+[0-9]") & ~other.rlike("(?i)Information About")
    return [*numbers, filed.alias("filed_drp_count"), (filed > 0).alias("has_filed_drps"), F.when(good, other).alias("fee_other_specify"), v.latest_us_date(text).alias("filing_date")]


def office(address: Column) -> Column:
    """An office address as one line from its JSON; null where there is none or it is broken."""
    inner = "struct<" + ",".join(f"{f}:string" for f in ADDRESS_FIELDS) + ">"
    a = F.from_json(valid_json(address), f"officeAddress {inner}")["officeAddress"]
    return F.nullif(F.concat_ws(", ", *[F.nullif(a[f], F.lit("")) for f in ADDRESS_FIELDS]), F.lit(""))


def registry_section(hits: DataFrame) -> DataFrame:
    """A registry hit in the catalog's form."""
    others = F.filter(F.coalesce(F.col("firm_other_names"), F.array().cast("array<string>")), lambda n: n != F.col("firm_name"))
    return hits.select(
        F.lit(True).alias("matched"), F.col("firm_name").alias("legal_name"), F.col("firm_source_id").alias("crd_number"), F.coalesce("firm_ia_full_sec_number", "firm_ia_sec_number").alias("sec_number"),
        office(F.col("firm_ia_address_details")).alias("headquarters"), F.col("firm_branches_count").alias("branch_count"), (F.coalesce("firm_ia_disclosure_fl", F.lit("")) == "Y").alias("disciplinary_disclosures"),
        F.col("firm_ia_scope").alias("registration_status"), F.array_join(others, "; ").alias("dbas_and_affiliates"),
    )


def name_score(name: Column, words: Column) -> Column:
    """How many of the words stand in a name, 5 more if the name is just the words."""
    inside = F.size(F.filter(words, lambda w: F.contains(name, w)))
    return inside + F.when(name == F.array_join(words, " "), 5).otherwise(0)


def _grams(text: Column, n: int) -> Column:
    """The distinct runs of n characters without a blank."""
    every = F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - (n - 1), F.lit(1))), lambda i: F.substring(text, i, F.lit(n)))
    return F.array_distinct(F.filter(every, lambda g: (F.length(g) == n) & ~F.contains(g, F.lit(" "))))


def best_hits(queries: DataFrame, hits: DataFrame, strict: bool = False) -> DataFrame:
    """(query, firm_source_id, score): per query the hit with the best name that has all the query's words, anywhere in it (as whole words if `strict`);
    first by number on ties.

    A name that has all words has every run of three letters in them (of a shorter word all of it). Each query looks for its rarest run only, so
    frequent words pair nothing, and there is no cross join.
    """
    q = queries.select("query", tx.query_words(tx.legal_name(F.col("query"))).alias("words")).where(F.size("words") > 0)
    names = hits.select("firm_source_id", F.explode(F.concat(F.array("firm_name"), F.coalesce(F.col("firm_other_names"), F.array().cast("array<string>")))).alias("n")).where("n is not null")
    names = materialize(names.select("firm_source_id", tx.legal_name(F.col("n")).alias("name")).distinct())
    wanted = F.flatten(F.transform("words", lambda w: F.when(F.length(w) >= 3, _grams(w, 3)).otherwise(F.array(w))))
    asked = materialize(q.select("query", "words", F.explode(F.array_distinct(wanted)).alias("key")))
    keys = materialize(asked.select("key").distinct())
    places = names.select("firm_source_id", "name", F.explode(F.concat(*[_grams(F.col("name"), n) for n in (1, 2, 3)])).alias("key")).join(sized(keys), "key", "left_semi")
    common = places.groupBy("key").agg(F.count("*").alias("n"))
    rarest = asked.join(common, "key", "left").groupBy("query").agg(F.min_by(F.struct("words", "key"), F.struct(F.coalesce("n", F.lit(0)), "key")).alias("b")).select("query", "b.*")
    pairs = rarest.join(places, "key").select("query", "words", "firm_source_id", "name")
    whole = F.size(F.array_except("words", F.split("name", " "))) == 0 if strict else F.lit(True)
    scored = pairs.where(whole).withColumn("score", name_score(F.col("name"), F.col("words"))).where(F.col("score") >= F.size("words"))
    best = scored.groupBy("query").agg(F.max("score").alias("score"), F.min_by("firm_source_id", F.struct(-F.col("score"), "firm_source_id")).alias("firm_source_id"))
    return best.select("query", "firm_source_id", "score")


def by_number_or_best(hits: DataFrame, number: Column) -> Column:
    """Orders a query's hits so that the one with the known number is first."""
    return F.when(hits["firm_source_id"] == number, 0).otherwise(1)


def aligned_disclosures(flag: Column, count: Column) -> Column:
    """The count that fits the flag: none if false, unknown if true without a count, as it is without a flag."""
    return F.when(flag.isNull(), count).when(~flag, F.lit(0)).otherwise(F.when(count > 0, count))


def skip_reason(has_facts: Column, has_metadata: Column, matched: Column, address: Column) -> Column:
    """Why a firm's filing isn't read, the first that holds; null if it is."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    return F.when(~yes(has_facts), "no facts").when(~yes(has_metadata), "no metadata").when(~yes(matched), "not matched").when(F.coalesce(address, F.lit("")) == "", "no address")
