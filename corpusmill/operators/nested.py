"""Flat child tables of nested catalog records.

Each of a record's lists becomes a table of its own (`target_tables`): a `transform` attaches the place in the list to each item's fields, the lists of all
objects in a payload are put together by `flatten`, and one `inline` per target table emits its rows with the record's key. A record's children
come from its own row, so the plan of a table is scan, projection, generate at any size; payloads are parsed once and written, and each table
reads its list alone. `all_children` gives the items of all target tables in one long form.

Defined results: a null struct at any level, a null or empty list and a null record give no rows. A null item, an item without any value
and '' give no row but keep their place (pos counts every item). An item with other values but without the one asked for gives ''.
A payload that isn't valid JSON gives no rows. In payloads a single value or object in a list's place counts as a list of one, an object may
stand alone, in a list or under `data`, nested parts may be JSON in a string, and keys may be snake, camel, Pascal or kebab case.
Rows repeated in the input give one result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.cluster import materialize

HISTORIES = ("aum_history", "advisor_count_history", "employee_count_history", "branch_count_history")
#: The target tables with their fields; the first one is the item of the long form.
FIELDS = {
    "aum_history": ("as_of", "value_usd", "source"), "advisor_count_history": ("as_of", "value", "source"), "employee_count_history": ("as_of", "value", "source"),
    "branch_count_history": ("as_of", "value", "source"), "notable_events": ("date", "event", "source"),
    "footer_emails": ("item",), "footer_phones": ("item",), "dbas_and_affiliates": ("item",), "sec_iapd": ("crd_number",),
}
STRINGS = ("footer_emails", "footer_phones", "dbas_and_affiliates")


def _has(*values: Column) -> Column:
    """Whether any of the values is there; '' is none."""
    return F.coalesce(*[F.nullif(v.cast("string"), F.lit("")) for v in values]).isNotNull()


def placed(items: Column, child: str) -> Column:
    """A list as an array of (pos, its fields as text) of the items that hold anything; items are structs, or texts where the table has one field."""
    fields = FIELDS[child]
    one = lambda x, f: (x if child in STRINGS else x[f]).cast("string").alias(f)
    each = F.transform(items, lambda x, i: F.struct((i + 1).cast("bigint").alias("pos"), *[one(x, f) for f in fields]))
    return F.filter(each, lambda x: _has(*[x[f] for f in fields]))


# -- payloads -----------------------------------------------------------------------------------------------------------------


MAP = T.MapType(T.StringType(), T.StringType())


def _entries(text: Column) -> Column:
    """The entries of a JSON object as (key in lower case without signs, value as text), so that crd_number, crdNumber and CRD-Number are one."""
    return F.transform(F.map_entries(F.from_json(text, MAP)), lambda e: F.struct(F.regexp_replace(F.lower(e["key"]), "[^a-z0-9]", "").alias("k"), e["value"].alias("v")))


def _get(entries: Column, name: str) -> Column:
    """A key's value as text; nested parts stay JSON."""
    return F.get(F.filter(entries, lambda e: (e["k"] == name.replace("_", "")) & e["v"].isNotNull()), F.lit(0))["v"]


def _as_list(text: Column) -> Column:
    """A list's items as texts; a single value or object counts as a list of one."""
    return F.when(text.rlike(r"^\s*\["), F.from_json(text, T.ArrayType(T.StringType()))).when(text.isNotNull(), F.array(text))


def _objects(text: Column) -> Column:
    """The objects of a JSON text, be it one object or a list of them, as entries."""
    return F.filter(F.transform(_as_list(text), _entries), lambda o: o.isNotNull())


def valid_json(text: Column) -> Column:
    """The text if all of it is one JSON value, else null."""
    wrapped = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    return F.when(F.try_variant_get(wrapped, "$[0]", "variant").isNotNull() & F.try_variant_get(wrapped, "$[1]", "variant").isNull(), text)


def parsed_payloads(df: DataFrame, key: str = "record_id", payload: str = "payload") -> DataFrame:
    """(rec_id, a column per target table), written once: the lists of each object in a payload. Each step parses a text once, for all lists."""
    valid = df.select(F.col(key).cast("bigint").alias("rec_id"), valid_json(F.col(payload)).alias("p")).where("p is not null")
    roots = valid.select("rec_id", F.explode(_objects(F.col("p"))).alias("o"))
    # objects under `data` count too
    both = roots.select("rec_id", F.explode(F.concat(F.array("o"), F.coalesce(_objects(_get(F.col("o"), "data")), F.array().cast("array<array<struct<k:string,v:string>>>")))).alias("o"))
    parts = both.select("rec_id", F.get(_objects(_get(F.col("o"), "trajectory")), F.lit(0)).alias("t"), F.get(_objects(_get(F.col("o"), "auto_filled")), F.lit(0)).alias("a"))
    inner = parts.where("t is not null or a is not null").select("rec_id", "t", "a", F.get(_objects(_get(F.col("a"), "sec_iapd")), F.lit(0)).alias("s"))
    texts = inner.select("rec_id", *[_as_list(_get(F.col("t"), c)).alias(c) for c in (*HISTORIES, "notable_events")], *[_as_list(_get(F.col("a"), c)).alias(c) for c in STRINGS[:2]], _as_list(_get(F.col("s"), STRINGS[2])).alias(STRINGS[2]), _get(F.col("s"), "crd_number").alias("crd"))
    items = texts.select("rec_id", *STRINGS, "crd", *[F.transform(c, _entries).alias(c) for c in (*HISTORIES, "notable_events")])
    structs = lambda c: F.transform(c, lambda x: F.struct(*[_get(x, f).alias(f) for f in FIELDS[c]])).alias(c)
    return materialize(items.select("rec_id", *STRINGS, F.array(F.struct(F.col("crd").alias("crd_number"))).alias("sec_iapd"), *[structs(c) for c in (*HISTORIES, "notable_events")]))


def _once(df: DataFrame, key: str) -> DataFrame:
    """df without repeated rows; the keys alone tell whether there are any, so usually nothing wide is shuffled."""
    return df if df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").isEmpty() else df.dropDuplicates([key])


def target_tables(metadata: DataFrame, facts: DataFrame, raw: DataFrame) -> dict[str, list[DataFrame]]:
    """By child the tables (src, rec_id, pos, fields ...) of the three sources that have it."""
    t, a = F.col("trajectory"), F.col("auto_filled")
    metadata, facts, parsed = _once(metadata, "meta_id"), _once(facts, "facts_id"), parsed_payloads(raw)
    crd = F.when(a["sec_iapd"].isNotNull(), F.array(F.struct(a["sec_iapd"]["crd_number"].alias("crd_number"))))
    lists = {c: (metadata, "firm_metadata", "meta_id", t[c]) for c in (*HISTORIES, "notable_events")}
    lists |= {c: (facts, "company_facts", "facts_id", x) for c, x in (("footer_emails", a["footer_emails"]), ("footer_phones", a["footer_phones"]), ("dbas_and_affiliates", a["sec_iapd"]["dbas_and_affiliates"]), ("sec_iapd", crd))}
    emit = lambda df, src, key, items, c: df.select(F.lit(src).alias("src"), F.col(key).cast("bigint").alias("rec_id"), F.inline(placed(items, c)))
    return {c: [emit(df, src, key, items, c), emit(parsed, "raw_record", "rec_id", F.col(c), c).dropDuplicates()] for c, (df, src, key, items) in lists.items()}


def all_children(metadata: DataFrame, facts: DataFrame, raw: DataFrame) -> DataFrame:
    """src, rec_id, child, pos, item of all target tables."""
    out = None
    for child, tables in target_tables(metadata, facts, raw).items():
        keep = F.col(FIELDS[child][0]) != "" if child == "sec_iapd" else F.lit(True)
        for df in tables:
            part = df.where(keep).select("src", "rec_id", F.lit(child).alias("child"), "pos", F.coalesce(F.col(FIELDS[child][0]), F.lit("")).alias("item"))
            out = part if out is None else out.unionByName(part)
    return out
