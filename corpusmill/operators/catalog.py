"""The catalog: orders, tag counts, tallies, cross-firm matrix, CSV lines, snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions import text as tx

# The catalog's CSV columns, in order, with their headers.
CSV_HEADERS = {
    "competitor": "Competitor", "slug": "Slug", "summary_line": "Summary", "website": "Website", "competitor_type": "Type", "threat_level": "Threat", "confidence": "Confidence", "team_size": "Team size",
    "advisor_count": "Advisors", "employee_count": "Employees", "branch_count": "Branches", "geographic_scope": "Geography", "headquarters_city": "HQ city", "headquarters_state": "HQ state",
    "aum_usd": "AUM (USD)", "aum_as_of": "AUM as of", "pricing_model": "Pricing model", "fee_schedule_published": "Fee schedule published", "fee_aum_pct_low": "AUM fee low (decimal)", "fee_aum_pct_high": "AUM fee high (decimal)",
    "fee_flat_low_usd": "Flat fee low (USD)", "fee_flat_high_usd": "Flat fee high (USD)", "min_account_usd": "Min account (USD)", "wealth_tiers_served": "Wealth tiers", "segment_early_adults": "Serves early adults", "segment_mid_career_401k": "Serves mid-career 401k",
    "regulatory_jurisdiction": "Jurisdiction", "regulator": "Regulator", "sec_registered": "SEC registered", "crd_number": "CRD", "sec_number": "SEC#", "ownership_structure": "Ownership", "fiduciary_stated_explicitly": "Fiduciary stated",
    "fee_only_stated_explicitly": "Fee-only stated", "disciplinary_disclosures": "Disciplinary disclosures", "disciplinary_disclosure_count": "Disciplinary count", "media_presence": "Media presence", "design_tone": "Design tone",
    "positioning_claims": "Positioning claims", "vulnerabilities": "Vulnerabilities", "tags": "Tags", "related_competitors": "Related competitors", "last_updated": "Last updated", "next_review_by": "Next review by", "review_cadence_days": "Cadence (days)",
}
# The matrix's rows by group.
MATRIX = {
    "Threat & confidence": {"Threat level": "threat_level", "Confidence": "confidence", "Competitor type": "competitor_type"},
    "Scale & scope": {"Team size": "team_size", "Branches": "branch_count", "Geography": "geographic_scope"},
    "Pricing": {"Pricing model": "pricing_model", "Fee schedule public": "fee_schedule_published", "Wealth tiers": "wealth_tiers_served"},
    "Our target segments": {"Early adults (first investment)": "segment_early_adults", "Mid-career 401(k)": "segment_mid_career_401k"},
    "Regulatory / structure": {"Jurisdiction": "regulatory_jurisdiction", "Regulator": "regulator", "SEC registered": "sec_registered", "CRD": "crd_number", "Ownership": "ownership_structure", "Fiduciary stated": "fiduciary_stated_explicitly", "Fee-only stated": "fee_only_stated_explicitly", "Disciplinary disclosures": "disciplinary_disclosures"},
    "Brand & voice": {"Media presence": "media_presence", "Design tone": "design_tone"},
}
# Places in the two orders; other values and nulls are given by the functions below.
CATALOG_RANK = {"high": 0, "medium-high": 1, "medium": 2, "low": 3}
LANDING_RANK = {"high": 0, "medium-high": 1, "medium": 2, "medium-low": 3, "low": 4}


def rank_of(value: Column, ranks: dict[str, int], missing: int, other: int) -> Column:
    return F.when(value.isNull(), missing).otherwise(F.coalesce(*[F.when(value == k, v) for k, v in ranks.items()], F.lit(other)))


def catalog_rank(level: Column) -> Column:
    return rank_of(level, CATALOG_RANK, CATALOG_RANK["low"], 99)


def landing_rank(level: Column) -> Column:
    return rank_of(level, LANDING_RANK, 9, 9)


def in_catalog_order(df: DataFrame, name: str = "competitor") -> DataFrame:
    """Most threatening first, then by name as readers sort it."""
    return df.orderBy(catalog_rank(F.col("threat_level")), F.collate(F.col(name), "UNICODE"))


def latest(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """One row per key: the first in the order. It keeps the best row of each task before the shuffle, so a hot key is no hot task."""
    best = df.groupBy(key).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("_r"))
    return best.select("_r.*")


def tag_counts(df: DataFrame, tags: str, ordinal: str) -> DataFrame:
    """(tag, n, place): how often each tag stands in the lists, ties by first appearance in row order."""
    seen = df.select(F.col(ordinal).alias("row"), F.posexplode(tags).alias("pos", "tag")).where("tag is not null")
    counted = seen.groupBy("tag").agg(F.count("*").alias("n"), F.min(F.struct("row", "pos")).alias("first"))
    return counted


def top_tags(df: DataFrame, tags: str, ordinal: str, k: int = 10) -> DataFrame:
    """The k most frequent tags with a label n/total, total being all rows."""
    top = tag_counts(df, tags, ordinal).orderBy(F.desc("n"), "first").limit(k)
    total = df.agg(F.count("*").alias("total"))
    place = F.row_number().over(Window.orderBy(F.desc("n"), "first"))  # k rows
    return top.withColumn("place", place).crossJoin(F.broadcast(total)).select("place", "tag", "n", F.concat_ws("/", "n", "total").alias("label"))


def tally(df: DataFrame, columns: list[str], values: list[str]) -> DataFrame:
    """(segment, one column per value, total): rows by value for each column; other values and nulls only count in the total."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("segment"), F.col(c).cast("string").alias("v")) for c in columns])).alias("x")).select("x.*")
    return long.groupBy("segment").agg(*[F.count_if(F.col("v") == v).alias(v) for v in values], F.count("*").alias("total"))


def fallback_tally(df: DataFrame, *columns: str) -> DataFrame:
    """(value, n) of the first of the columns that isn't null or empty, else 'unknown'."""
    return df.groupBy(tx.or_else(*[F.col(c) for c in columns], "unknown").alias("value")).agg(F.count("*").alias("n"))


def csv_line(df: DataFrame, columns: list[str] | None = None) -> Column:
    """A row as a CSV line: nulls empty, lists joined by commas, numbers plain (0.0005, 1), quotes only where needed."""
    kinds = dict(df.dtypes)
    plain = lambda c: F.regexp_replace(F.regexp_replace(F.col(c).cast("decimal(30,10)").cast("string"), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    shown = lambda c: F.array_join(F.col(c), ", ") if kinds[c].startswith("array") else plain(c) if kinds[c] == "double" else F.col(c)
    return F.concat_ws(",", *[tx.csv_cell(shown(c)) for c in columns or CSV_HEADERS])


def matrix(df: DataFrame, firm: str = "slug") -> DataFrame:
    """(section, dimension, firm, value): the cross-firm matrix in long form, a dash for what is missing."""
    kinds = dict(df.dtypes)

    def value(c: str) -> Column:
        if kinds[c] == "boolean":
            return tx.yes_no(F.col(c))
        v = F.array_join(F.col(c), ", ") if kinds[c].startswith("array") else F.col(c).cast("string")
        return tx.or_else(v, tx.DASH) if kinds[c].startswith("array") else F.coalesce(v, F.lit(tx.DASH))

    cells = [F.struct(F.lit(g).alias("section"), F.lit(label).alias("dimension"), value(c).alias("value")) for g, rows in MATRIX.items() for label, c in rows.items()]
    return df.select(F.col(firm).alias("firm"), F.inline(F.array(*cells))).select("section", "dimension", "firm", "value")


def matrix_wide(df: DataFrame, firms: list[str], firm: str = "slug") -> DataFrame:
    """One row per dimension with a column per firm; the firms are given, so no extra job finds them."""
    return matrix(df, firm).groupBy("section", "dimension").pivot("firm", firms).agg(F.first("value"))


def edges(df: DataFrame, key: str, related: str) -> DataFrame:
    return df.select(F.col(key).alias("source"), F.explode(related).alias("target")).where("target is not null").distinct()


def dangling_edges(df: DataFrame, key: str = "slug", related: str = "related_competitors") -> DataFrame:
    """Links to firms that the catalog doesn't have."""
    return edges(df, key, related).join(df.select(F.col(key).alias("target")).distinct(), "target", "left_anti").select("source", "target")


def keep_latest_by_source(history: DataFrame, key: str, source: str, run: str) -> DataFrame:
    """Of a record's snapshots from one source only the last stays."""
    best = history.groupBy(key, source).agg(F.max_by(F.struct(*history.columns), F.struct(*[c for c in (run, *sorted(set(history.columns) - {run}))])).alias("_r"))
    return best.select("_r.*")


def deltas(history: DataFrame, key: str, as_of: str, value: str) -> DataFrame:
    """Each snapshot with the one before it and the change."""
    w = Window.partitionBy(key).orderBy(as_of, value)
    return history.withColumn("previous", F.lag(value).over(w)).withColumn("change", F.col(value) - F.col("previous"))


def spans(history: DataFrame, key: str, as_of: str, value: str) -> DataFrame:
    """(key, as_of, value, year_ago, years_ago, change_12m, change_24_36m): the last snapshot against the last one at least 12 months before it, and the
    last one 24 to 36 months before it; null where there is none. Dates of a year or month stand for its first day; unreadable ones are left out."""
    day = F.try_to_date(F.concat(F.col(as_of), F.substring(F.lit("0001-01-01"), F.length(as_of) + 1, F.lit(10))), "yyyy-MM-dd")
    rows = history.select(key, F.col(as_of).alias("_a"), F.col(value).alias("_v"), day.alias("_d")).where("_d is not null and _v is not null")
    last = rows.groupBy(key).agg(F.max(F.struct("_d", "_a", "_v")).alias("_l"))
    both = rows.join(last, key)
    months = lambda n: F.add_months(F.col("_l._d"), -n)
    pick = lambda cond: F.max(F.when(cond, F.struct("_d", "_a", "_v")))["_v"]
    out = both.groupBy(key).agg(F.first("_l._a").alias("as_of"), F.first("_l._v").alias("value"), pick(F.col("_d") <= months(12)).alias("year_ago"), pick(F.col("_d").between(months(36), months(24))).alias("years_ago"))
    return out.withColumn("change_12m", F.col("value") - F.col("year_ago")).withColumn("change_24_36m", F.col("value") - F.col("years_ago"))


def with_caveats(df: DataFrame, caveats: DataFrame, key: str = "slug") -> DataFrame:
    """df with `caveat` from (key, caveat), null where there is none. Caveats are written by hand, so the optimizer's own size check decides on a broadcast."""
    return df.join(caveats.select(key, "caveat").dropDuplicates([key]), key, "left")


def upsert(old: DataFrame, new: DataFrame, key: str, columns: list[str], new_wins: bool = True) -> DataFrame:
    """old with the given columns from new where new has a value (or only where old has none)."""
    n = new.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    pick = lambda c: F.coalesce(F.col(f"_{c}"), F.col(c)) if new_wins else F.coalesce(F.col(c), F.col(f"_{c}"))
    return old.join(n, key, "left").select(*[pick(c).alias(c) if c in columns else F.col(c) for c in old.columns])


def changed_fields(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, field, old, new) of all fields that differ, records on one side only included."""

    def long(df: DataFrame, name: str) -> DataFrame:
        return df.select(key, F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias(name)) for c in columns])))

    both = long(old, "old").join(long(new, "new"), [key, "field"], "full_outer")
    return both.where(~F.col("old").eqNullSafe(F.col("new")))
