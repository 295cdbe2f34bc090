"""Registered queries on the catalog and corpus tables, each with the same result in DuckDB's SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.cluster import materialize, table
from corpusmill.functions import html as hx
from corpusmill.functions import text as tx
from corpusmill.functions import urls as u
from corpusmill.functions import values as v
from corpusmill.operators import catalog, crawl, documents, facets, nested, pages, quality, registry, search, sections
from corpusmill.plans import knowledge_base as kb
from corpusmill.sources import writers
from corpusmill.streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


#: The day that freshness is judged on; a parameter of the operators.
TODAY = "2026-01-15"
LAST_META = "last as (select * from firm_metadata qualify row_number() over (partition by slug order by last_updated desc nulls last, meta_id desc) = 1)"


def _last_meta(spark: SparkSession, d: str) -> DataFrame:
    return catalog.latest(table(spark, d, "firm_metadata"), "slug", F.col("last_updated"), F.col("meta_id"))


# -- nested records -----------------------------------------------------------------------------------------------------------

_STRUCTS = " union all ".join(
    f"select '{src}' src, {key} rec_id, '{h}' child, n pos, coalesce(x.{item}, '') item from (select {key}, unnest({col}.{h}) x, generate_subscripts({col}.{h}, 1) n from {src}) where coalesce(nullif(x.{item}, ''), nullif(x.{val}::varchar, ''), nullif(x.source, '')) is not null"
    for src, key, col, h, item, val in [("firm_metadata", "meta_id", "trajectory", h, "as_of", "value_usd" if h == "aum_history" else "value") for h in nested.HISTORIES] + [("firm_metadata", "meta_id", "trajectory", "notable_events", "date", "event")]
)
_STRINGS = " union all ".join(
    f"select 'company_facts' src, facts_id rec_id, '{c}' child, n pos, x item from (select facts_id, unnest({col}) x, generate_subscripts({col}, 1) n from company_facts) where x <> ''"
    for c, col in (("footer_emails", "auto_filled.footer_emails"), ("footer_phones", "auto_filled.footer_phones"), ("dbas_and_affiliates", "auto_filled.sec_iapd.dbas_and_affiliates"))
)
_TABLES_P5 = f"{_STRUCTS} union all {_STRINGS} union all select 'company_facts', facts_id, 'sec_iapd', 1, auto_filled.sec_iapd.crd_number from company_facts where auto_filled.sec_iapd.crd_number <> ''"
# Keys are brought to one spelling in the text itself: camel case to snake case, for the names that the tables have.
_KEYS = ["trajectory", *nested.HISTORIES, "notable_events", "as_of", "auto_filled", "footer_emails", "footer_phones", "sec_iapd", "dbas_and_affiliates", "crd_number", "value_usd"]


def _camel(name: str) -> str:
    first, *rest = name.split("_")
    return first + "".join(p.capitalize() for p in rest)


def _respelt(text: str) -> str:
    for k in _KEYS:
        if _camel(k) != k:
            text = f"""replace(replace({text}, '"{_camel(k)}"', '"{k}"'), '"{_camel(k)}\\"', '"{k}\\"')"""
    return text


_AS_LIST = "case when json_type({0}) = 'ARRAY' then {0} when {0} is null or json_type({0}) = 'NULL' then null else json_array({0}) end"
_UNPACK = "case when json_type({0}) = 'VARCHAR' and json_valid({0} ->> '$') then ({0} ->> '$')::json else {0} end"
_RAW_P5 = f"""
with valid as (select record_id, ({_respelt("payload")})::json j from raw_record where json_valid(payload)),
roots as (select record_id, unnest(case when json_type(j) = 'ARRAY' then json_extract(j, '$[*]') else [j] end) o from valid),
objs as (select record_id, coalesce(case when json_type(o -> 'data') = 'OBJECT' then o -> 'data' end, o) o from roots),
parts as (select record_id, {_UNPACK.format("(o -> 'trajectory')")} t, {_UNPACK.format("(o -> 'auto_filled')")} a from objs),
lists as (
  {" union all ".join(f"select record_id, '{h}' child, {_AS_LIST.format(f"(t -> '{h}')")} l, '{'date' if h == 'notable_events' else 'as_of'}' k, true st from parts" for h in [*nested.HISTORIES, "notable_events"])}
  union all {" union all ".join(f"select record_id, '{c}' child, {_AS_LIST.format(f"({p} -> '{c}')")} l, '' k, false st from parts" for c, p in (("footer_emails", "a"), ("footer_phones", "a"), ("dbas_and_affiliates", "(a -> 'sec_iapd')")))}),
items as (select record_id, child, k, st, unnest(json_extract(l, '$[*]')) x, generate_subscripts(json_extract(l, '$[*]'), 1) n from lists where l is not null)
select 'raw_record' src, record_id rec_id, child, n pos, case when st then coalesce((x ->> k), '') else (x ->> '$') end item from items
where case when st then json_type(x) = 'OBJECT' and coalesce(nullif((x ->> k), ''), nullif((x ->> 'value'), ''), nullif((x ->> 'value_usd'), ''), nullif((x ->> 'source'), ''), nullif((x ->> 'event'), '')) is not null else json_type(x) <> 'NULL' and (x ->> '$') <> '' end
union all select 'raw_record', record_id, 'sec_iapd', 1, ((a -> 'sec_iapd') ->> 'crd_number') from parts where ((a -> 'sec_iapd') ->> 'crd_number') <> ''"""


@query(f"select distinct src, rec_id, child, pos::bigint pos, item from ({_TABLES_P5} union all ({_RAW_P5}))")
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.all_children(table(spark, d, "firm_metadata"), table(spark, d, "company_facts"), table(spark, d, "raw_record"))


@query("select facts_id, auto_filled.sec_iapd.crd_number crd_number, auto_filled.sec_iapd.legal_name legal_name, auto_filled.social_links.linkedin linkedin, len(auto_filled.footer_emails)::bigint emails, len(manual.leadership)::bigint leaders from company_facts")
def facts_flat(spark: SparkSession, d: str) -> DataFrame:
    a, m = F.col("auto_filled"), F.col("manual")
    return table(spark, d, "company_facts").select("facts_id", a["sec_iapd"]["crd_number"].alias("crd_number"), a["sec_iapd"]["legal_name"].alias("legal_name"), a["social_links"]["linkedin"].alias("linkedin"), F.size(a["footer_emails"]).cast("bigint").alias("emails"), F.size(m["leadership"]).cast("bigint").alias("leaders"))


@query("select record_kind, count(*)::bigint n, count_if(json_valid(payload))::bigint valid from raw_record group by record_kind")
def payload_validity(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "raw_record").groupBy("record_kind").agg(F.count("*").alias("n"), F.count(nested.valid_json(F.col("payload"))).alias("valid"))


# -- scalar functions ---------------------------------------------------------------------------------------------------------

_SLUG = "coalesce(nullif(substring(regexp_replace(regexp_replace({0}, '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 60), ''), '{1}')"


@query(f"select post_id, {_SLUG.format("regexp_replace(lower(title), '[`*_~>#]', '', 'g')", 'section')} anchor, {_SLUG.format('lower(title)', 'untitled')} slug from post_index_entry")
def slugs(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("title")
    return table(spark, d, "post_index_entry").select("post_id", tx.slug(t).alias("anchor"), tx.slug(t, "untitled", False).alias("slug"))


@query("select doc_id, coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\r\\f\\v]+')), 0)::bigint words from documents")
def word_count(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", tx.count_words(F.col("text")).cast("bigint").alias("words"))


_SNIPPET = "body_text"
for _p, _r in ((r"(?m)^#+\s+.*$", ""), (r"(?m)^>\s?", ""), (r"!\[[^\]]*\]\([^)]*\)", ""), (r"\[([^\]]*)\]\([^)]*\)", r"\1"), (r"\]\([^)]*\)", ""), (r"[*_`#>|\[\]]", ""), (r"\s+", " "), (r"^[\s)\-–—:]+", "")):
    _SNIPPET = f"regexp_replace({_SNIPPET}, '{_p}', '{_r}', 'g')"


@query(f"with s as (select post_id, trim({_SNIPPET}) t from post_index_entry) select post_id, case when length(t) > 240 then rtrim(substring(t, 1, 240)) || '…' else t end snippet from s")
def plain_snippet(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "post_index_entry").select("post_id", tx.snippet(F.col("body_text")).alias("snippet"))


@query("select page_id, substring(coalesce(nullif(trim(regexp_replace(title, '(?s)\\s+[—–|]\\s+.*', '')), ''), trim(title)), 1, 200) title from page_capture")
def clean_titles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "page_capture").select("page_id", tx.clean_title(F.col("title")).alias("title"))


@query("select page_id, nullif(coalesce(nullif(meta.og_title, ''), trim(regexp_replace(title, '(?s)[|·\\-–—].*', ''))), '') site from page_capture")
def site_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "page_capture").select("page_id", tx.site_name(F.col("meta")["og_title"], F.col("title")).alias("site"))


_AUTHOR = "trim(regexp_replace(regexp_replace(trim(author), '(?i)^by\\s+', ''), '\\s+', ' ', 'g'))"


@query(f"with a as (select post_id, {_AUTHOR} t from post_index_entry), l as (select *, length(regexp_replace(t, '[^a-zA-Z]', '', 'g')) n from a) select post_id, case when length(t) between 2 and 120 and n > 0 and n * 2 >= length(t) then t end author from l")
def clean_authors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "post_index_entry").select("post_id", tx.clean_author(F.col("author")).alias("author"))


_LEGAL = "trim(regexp_replace(regexp_replace(regexp_replace(lower({0}), '[,.()]', '', 'g'), '\\b(llc|inc|corp|company|co|ltd|lp|llp|plc)\\b', '', 'g'), '\\s+', ' ', 'g'))"
_SHORT = "competitor"
for _p in (r"(?i), LLC$", r"(?i), Inc\.?$", r"(?i)\s+Wealth\s+Management$", r"\s+\(.*\)$"):
    _SHORT = f"regexp_replace({_SHORT}, '{_p}', '')"


@query(f"select meta_id, trim({_SHORT}) short_name, {_LEGAL.format('competitor')} legal_name, list_filter(regexp_split_to_array({_LEGAL.format('competitor')}, '\\s+'), lambda w: length(w) > 2) words from firm_metadata")
def firm_names(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("competitor")
    return table(spark, d, "firm_metadata").select("meta_id", tx.short_name(c).alias("short_name"), tx.legal_name(c).alias("legal_name"), tx.query_words(tx.legal_name(c)).alias("words"))


@query("select meta_id, array_to_string(list_transform(list_filter(regexp_split_to_array(competitor, '[\\s\\-_.]+'), lambda w: w <> ''), lambda w: upper(w[1]) || lower(w[2:])), '_') folder from firm_metadata")
def folder_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "firm_metadata").select("meta_id", F.coalesce(tx.folder_name(F.col("competitor")), F.lit(None)).alias("folder"))


@query("select page_id, substring(regexp_replace(regexp_replace(trim(body_text), '\\s+\\n', chr(10), 'g'), '\\n{3,}', chr(10) || chr(10), 'g'), 1, 50000) body from page_capture")
def clean_bodies(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "page_capture").select("page_id", tx.clean_body(F.col("body_text")).alias("body"))


@query("select meta_id, replace(replace(replace(replace(competitor, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;') escaped, case when sec_registered then 'yes' when not sec_registered then 'no' else '—' end registered, case when aum_usd is null then '—' else printf('$%.2fB', aum_usd / 1e9) end aum, concat_ws(' · ', competitor_type, headquarters_state, pricing_model) facts from firm_metadata")
def shown_values(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "firm_metadata").select("meta_id", tx.html_escape(F.col("competitor")).alias("escaped"), tx.yes_no(F.col("sec_registered")).alias("registered"), tx.billions(F.col("aum_usd")).alias("aum"), tx.facts_line(F.col("competitor_type"), F.col("headquarters_state"), F.col("pricing_model")).alias("facts"))


_ORIGIN = "nullif(lower(regexp_extract(url, '^\\s*([A-Za-z][A-Za-z0-9+.-]*://[^/?#\\s]+)', 1)), '')"
_PATH = f"case when {_ORIGIN} is null then null else coalesce(nullif(regexp_extract(url, '^\\s*[A-Za-z][A-Za-z0-9+.-]*://[^/?#\\s]+([^?#\\s]*)', 1), ''), '/') end"


@query(f"with b as (select page_id, url, {_ORIGIN} o, {_PATH} p, regexp_replace(trim(url), '[?#].*', '') bare from page_capture) select page_id, case when o is null then url when length(p) > 1 then regexp_replace(bare, '/$', '') else bare end canonical, p path, len(list_filter(string_split(p, '/'), lambda s: s <> ''))::bigint depth from b")
def canonical_urls(spark: SparkSession, d: str) -> DataFrame:
    x = F.col("url")
    return table(spark, d, "page_capture").select("page_id", u.canonical(x).alias("canonical"), u.path(x).alias("path"), u.depth(x).cast("bigint").alias("depth"))


_DATED = "case when regexp_extract({0}, '/([0-9]{{4}})/([0-9]{{1,2}})/([0-9]{{1,2}})(?:/|$)', 1) <> '' then concat_ws('-', regexp_extract({0}, '/([0-9]{{4}})/([0-9]{{1,2}})/([0-9]{{1,2}})(?:/|$)', 1), lpad(regexp_extract({0}, '/([0-9]{{4}})/([0-9]{{1,2}})/([0-9]{{1,2}})(?:/|$)', 2), 2, '0'), lpad(regexp_extract({0}, '/([0-9]{{4}})/([0-9]{{1,2}})/([0-9]{{1,2}})(?:/|$)', 3), 2, '0')) when regexp_extract({0}, '/([0-9]{{4}})/([0-9]{{1,2}})(?:/|$)', 1) <> '' then concat_ws('-', regexp_extract({0}, '/([0-9]{{4}})/([0-9]{{1,2}})(?:/|$)', 1), lpad(regexp_extract({0}, '/([0-9]{{4}})/([0-9]{{1,2}})(?:/|$)', 2), 2, '0'), '01') else nullif(regexp_extract({0}, '\\b([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})\\b', 1), '') end"


@query(f"select post_id, {_DATED.format('file')} file_date, {_DATED.format("replace(blog_url || '/' || coalesce(post_date, ''), '-', '/')")} path_date from post_index_entry")
def dates_in_addresses(spark: SparkSession, d: str) -> DataFrame:
    p = F.replace(F.concat("blog_url", F.lit("/"), F.coalesce("post_date", F.lit(""))), F.lit("-"), F.lit("/"))
    return table(spark, d, "post_index_entry").select("post_id", u.dated(F.col("file")).alias("file_date"), u.dated(p).alias("path_date"))


@query(f"select post_id, concat_ws('_', post_date, {_SLUG.format('lower(title)', 'untitled')}, substring(sha1(url), 1, 6)) || '.md' name from post_index_entry")
def post_files(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "post_index_entry").select("post_id", u.post_file(F.col("post_date"), F.col("title"), F.col("url")).alias("name"))


_TIDY = "regexp_replace(trim(post_date), '\\s+', ' ', 'g')"


@query(f"select post_id, coalesce(nullif(regexp_extract(post_date, '^\\s*([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})', 1), ''), {', '.join(f"case when regexp_full_match({_TIDY}, '{p}') then strftime(try_strptime({_TIDY}, '{f}'), '%Y-%m-%d') end" for p, f in (('[A-Z][a-z]{3,} [0-9]{1,2}, [0-9]{4}', '%B %d, %Y'), ('[A-Z][a-z]{2} [0-9]{1,2}, [0-9]{4}', '%b %d, %Y'), ('[A-Z][a-z]{3,} [0-9]{1,2} [0-9]{4}', '%B %d %Y'), ('[A-Z][a-z]{2} [0-9]{1,2} [0-9]{4}', '%b %d %Y'), ('[0-9]{1,2} [A-Z][a-z]{3,} [0-9]{4}', '%d %B %Y'), ('[0-9]{1,2} [A-Z][a-z]{2} [0-9]{4}', '%d %b %Y'), ('[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}', '%m/%d/%Y'), ('[0-9]{4}/[0-9]{2}/[0-9]{2}', '%Y/%m/%d')))}) date from post_index_entry")
def post_dates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "post_index_entry").select("post_id", v.iso_date(F.col("post_date")).alias("date"))


# -- captures -----------------------------------------------------------------------------------------------------------------


@query("select page_id, regexp_matches(coalesce(title, '') || chr(10) || coalesce(headings[1].text, ''), '(?i)\\b(page\\s+not\\s+found|404\\s+not\\s+found|not\\s+found|oops)\\b') soft_404, coalesce(regexp_matches(substring(body_text, 1, 5000), '(?i)checking your browser|403 - forbidden|access denied'), false) challenge from page_capture")
def page_checks(spark: SparkSession, d: str) -> DataFrame:
    h1 = F.try_element_at("headings", F.lit(1))["text"]
    return table(spark, d, "page_capture").select("page_id", pages.is_soft_404(F.col("title"), h1).alias("soft_404"), pages.is_challenge(F.col("body_text")).alias("challenge"))


@query("select page_id, len(list_filter(ctas, lambda c: trim(c.text) <> '' and length(c.text) <= 60)[1:30])::bigint n, list_filter(ctas, lambda c: trim(c.text) <> '' and length(c.text) <= 60)[1].text first_text from page_capture")
def page_ctas(spark: SparkSession, d: str) -> DataFrame:
    c = pages.ctas(F.col("ctas"))
    return table(spark, d, "page_capture").select("page_id", F.size(c).cast("bigint").alias("n"), F.try_element_at(c, F.lit(1))["text"].alias("first_text"))


_KIND = "case when lower(coalesce(nullif(kind, ''), 'unknown')) = 'blog' then 'blog_index' else lower(coalesce(nullif(kind, ''), 'unknown')) end"
_INDEX = f"idx as (select firm, 'site' source, {_KIND} kind, url from page_capture union all select firm, 'blog', 'blog_post', url from post_index_entry)"


def _index(spark: SparkSession, d: str) -> DataFrame:
    return pages.page_index(table(spark, d, "page_capture"), table(spark, d, "post_index_entry"))


@query(f"select firm, 'site' source, {_KIND} kind, url, trim(coalesce(title, '')) title, nullif(meta.description, '') description, len(headings)::bigint heading_count, null::varchar date from page_capture union all select firm, 'blog', 'blog_post', url, trim(coalesce(title, '')), null, null, post_date from post_index_entry")
def page_index(spark: SparkSession, d: str) -> DataFrame:
    return _index(spark, d).select("firm", "source", "kind", "url", "title", "description", F.col("heading_count").cast("bigint").alias("heading_count"), "date")


@query(f"with {_INDEX} select firm, kind, count(*)::bigint n from idx group by firm, kind")
def kinds_by_firm(spark: SparkSession, d: str) -> DataFrame:
    return pages.kinds_by_firm(_index(spark, d))


@query(f"with {_INDEX} select kind, count(*)::bigint n, count_if(source = 'site')::bigint site_pages, count_if(source = 'blog')::bigint blog_posts from idx group by rollup (kind)")
def page_totals(spark: SparkSession, d: str) -> DataFrame:
    return pages.totals(_index(spark, d))


@query(f"with {_INDEX}, k as (select distinct kind from idx) select row_number() over (order by kind = 'blog_post', kind)::bigint place, kind from k")
def kind_order(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    kinds = _index(spark, d).select("kind").distinct()
    return kinds.select(F.row_number().over(Window.orderBy(*pages.kind_order(F.col("kind")))).cast("bigint").alias("place"), "kind")


_HAY = "hay as (select firm, url, page_id, unnest(x) t, generate_subscripts(x, 1) n from (select firm, url, page_id, list_concat(coalesce(list_transform(list_filter(ctas, lambda c: coalesce(c.href, '') <> ''), lambda c: c.href), []), case when coalesce(body_text, '') <> '' then [body_text] else [] end) x from page_capture))"


@query(
    f"with {_HAY}, m as (select firm, 'email' kind, url, page_id, n, unnest(regexp_extract_all(t, '{pages.EMAIL}')) val, generate_subscripts(regexp_extract_all(t, '{pages.EMAIL}'), 1) k from hay union all select firm, 'phone', url, page_id, n, unnest(regexp_extract_all(t, '{pages.PHONE}')), generate_subscripts(regexp_extract_all(t, '{pages.PHONE}'), 1) from hay), "
    "f as (select firm, kind, val, url, page_id, n, k from m qualify row_number() over (partition by firm, kind, val order by url nulls first, page_id, n, k) = 1) select firm, kind, row_number() over (partition by firm, kind order by url nulls first, page_id, n, k)::bigint rank, val as value from f qualify row_number() over (partition by firm, kind order by url nulls first, page_id, n, k) <= 10"
)
def contacts(spark: SparkSession, d: str) -> DataFrame:
    return pages.contacts(table(spark, d, "page_capture")).withColumn("rank", F.col("rank").cast("bigint"))


@query("with l as (select facts_id, unnest([{'network': 'linkedin', 'address': auto_filled.social_links.linkedin}, {'network': 'twitter', 'address': auto_filled.social_links.twitter}, {'network': 'facebook', 'address': auto_filled.social_links.facebook}, {'network': 'youtube', 'address': auto_filled.social_links.youtube}, {'network': 'instagram', 'address': auto_filled.social_links.instagram}]) x from company_facts) select x.network network, count(x.address)::bigint n, count(distinct x.address)::bigint addresses from l group by 1")
def social_links(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("auto_filled")["social_links"]
    rows = table(spark, d, "company_facts").select(F.inline(F.array(*[F.struct(F.lit(k).alias("network"), s[k].alias("address")) for k in ("linkedin", "twitter", "facebook", "youtube", "instagram")])))
    return rows.groupBy("network").agg(F.count("address").alias("n"), F.countDistinct("address").alias("addresses"))


@query("with l as (select competitor firm, facts_id, unnest([{'p': 0, 'h': replace(auto_filled.social_links.linkedin, 'linkedin.example', 'linkedin.com')}, {'p': 1, 'h': replace(auto_filled.social_links.twitter, 'twitter.example', 'twitter.com')}, {'p': 2, 'h': replace(auto_filled.social_links.facebook, 'facebook.example', 'facebook.com')}, {'p': 3, 'h': replace(auto_filled.social_links.youtube, 'youtube.example', 'youtube.com')}]) x from company_facts), m as (select firm, facts_id, x.p p, unnest([{'network': 'linkedin', 'm': nullif(regexp_extract(x.h, '(?i)linkedin\\.com/(company|in|school)/[^\\s\"''?#]+', 0), '')}, {'network': 'twitter', 'm': nullif(regexp_extract(x.h, '(?i)(twitter\\.com|x\\.com)/[A-Za-z0-9_]+', 0), '')}, {'network': 'facebook', 'm': nullif(regexp_extract(x.h, '(?i)facebook\\.com/[^\\s\"''?#]+', 0), '')}, {'network': 'youtube', 'm': nullif(regexp_extract(x.h, '(?i)(youtube\\.com/(channel|user|@[^\\s\"''?#]+)|youtu\\.be/[^\\s\"''?#]+)', 0), '')}, {'network': 'instagram', 'm': nullif(regexp_extract(x.h, '(?i)instagram\\.com/[^\\s\"''?#]+', 0), '')}]) y from l where x.h is not null and x.h <> '') select firm, y.network network, case when starts_with(y.m, 'http') then y.m else 'https://' || y.m end address from m where y.m is not null qualify row_number() over (partition by firm, y.network order by facts_id, p) = 1")
def social_mining(spark: SparkSession, d: str) -> DataFrame:
    """Addresses of networks in captures, on captures whose links are the catalog's social links."""
    s = F.col("auto_filled")["social_links"]
    facts = table(spark, d, "company_facts").select(F.col("competitor").alias("firm"), F.col("facts_id").alias("page_id"), F.lit("").alias("url"), F.lit("").alias("body_text"), F.array(*[F.struct(F.lit("").alias("text"), F.lit("a").alias("tag"), F.replace(s[k], F.lit(f"{k}.example"), F.lit(f"{k}.com")).alias("href")) for k in ("linkedin", "twitter", "facebook", "youtube")]).alias("ctas"))
    return pages.socials(facts)


def _page_candidates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "page_capture").where("url is not null and firm is not null").select(F.col("firm").alias("site"), "url", F.coalesce("title", F.lit("")).alias("text"), F.lit(0).alias("source_rank"))


_PICK = (
    f"c as (select firm site, url, {_PATH} p from page_capture where url is not null and firm is not null), k as (select site, url, len(list_filter(string_split(p, '/'), lambda s: s <> '')) d, unnest(list_filter(["
    + ", ".join(f"case when regexp_matches(p, '{p.replace(chr(39), chr(39) * 2)}') then '{k}' end" for k, p in pages.PATH_KINDS.items())
    + "], lambda x: x is not null)) kind from c where p is not null)"
)


@query(f"with {_PICK} select site, kind, url from k qualify row_number() over (partition by site, kind order by d, url) = 1")
def pages_by_path(spark: SparkSession, d: str) -> DataFrame:
    return crawl.pick_by_path(_page_candidates(spark, d))


_KIND_LIST = lambda col, kinds: "[" + ", ".join(f"case when regexp_matches({col}, '{p.replace(chr(39), chr(39) * 2)}') then '{k}' end" for k, p in kinds.items()) + "]"
_ORIGIN_OF = _ORIGIN.replace("url", "{0}")
_PICKED = (
    f"own as (select firm site, url, coalesce(title, '') t, 0 r from page_capture where url is not null and firm is not null), base as (select site, min({_ORIGIN}) b from own group by site having min({_ORIGIN}) is not null), "
    f"known as (select site, regexp_replace(b, '/+$', '') || p url, regexp_replace(string_split(p, '/')[-1], '[-_]', ' ', 'g') t, 1 r from base, (select unnest({list(u.KNOWN_PATHS)}) p)), every as (select * from own union all select * from known), "
    f"canon as (select *, case when {_ORIGIN} is null then url else case when length({_PATH.replace('url', 'bare')}) > 1 then regexp_replace(bare, '/$', '') else bare end end c from (select *, regexp_replace(trim(url), '[?#].*', '') bare from every)), "
    "best as (select site, c, x.r r, x.url url, x.t t from (select site, c, min({'r': r, 'url': url, 't': t}) x from canon group by site, c)), "
    f"bp as (select site, kind, x.url url from (select site, kind, min({{'d': d, 'r': r, 'url': url}}) x from (select site, url, r, len(list_filter(string_split({_PATH}, '/'), lambda s: s <> '')) d, unnest(list_filter({_KIND_LIST(_PATH, pages.PATH_KINDS)}, lambda x: x is not null)) kind from best where {_PATH} is not null) group by site, kind)), "
    f"taken as (select distinct site, case when {_ORIGIN} is null then url else case when length({_PATH.replace('url', 'bare')}) > 1 then regexp_replace(bare, '/$', '') else bare end end c from (select site, url, regexp_replace(trim(url), '[?#].*', '') bare from bp)), "
    f"bt as (select site, kind, x.url url from (select site, kind, min({{'r': r, 'url': url}}) x from (select site, url, r, unnest(list_filter({_KIND_LIST('t', pages.TEXT_KINDS)}, lambda x: x is not null)) kind from best where length(t) between 1 and 80 and (site, c) not in (select (site, c) from taken)) group by site, kind)), "
    f"al as (select coalesce(bp.site, bt.site) site, coalesce(bp.kind, bt.kind) kind, coalesce(bp.url, bt.url) url from bp full join bt on bp.site = bt.site and bp.kind = bt.kind)"
)


@query(f"with {_PICKED} select site, row_number() over (partition by site order by list_position({list(pages.PRIORITY)}, kind))::bigint place, kind, url from al qualify row_number() over (partition by site order by list_position({list(pages.PRIORITY)}, kind)) <= 6")
def picked_pages(spark: SparkSession, d: str) -> DataFrame:
    """Path and text picks together, known addresses among the candidates, by priority within the budget."""
    own = _page_candidates(spark, d)
    base = own.groupBy("site").agg(F.min(u.origin(F.col("url"))).alias("base")).where("base is not null")
    both = crawl.candidates(own, crawl.known_path_candidates(base))
    return crawl.pick_pages(crawl.distinct_addresses(both)).withColumn("place", F.col("place").cast("bigint"))


@query("with l as (select distinct firm site, blog_url, url from post_index_entry where firm is not null), p as (select *, " + _PATH + " p, " + _PATH.replace("url,", "blog_url,") + " b, " + _ORIGIN + " o, " + _ORIGIN.replace("url,", "blog_url,") + " bo from l) select distinct site, regexp_replace(url, '[?#].*', '') url from p where o = bo and not regexp_matches(p, '" + u.INDEX_HINT + "') and not regexp_matches(p, '" + u.NOT_HTML + "') and p <> '/' and len(list_filter(string_split(p, '/'), lambda s: s <> '')) > len(list_filter(string_split(b, '/'), lambda s: s <> ''))")
def post_candidates(spark: SparkSession, d: str) -> DataFrame:
    links = table(spark, d, "post_index_entry").where("firm is not null").select(F.col("firm").alias("site"), "blog_url", "url")
    return crawl.post_candidates(links).select("site", "url")


@query("with p as (select firm site, url, max(substring(post_date, 1, 10)) date from post_index_entry where firm is not null group by all), c as (select distinct url from post_index_entry where captured < timestamp '2025-01-01'), f as (select * from p where url not in (select url from c where url is not null)) select site, url, row_number() over (partition by site order by date is null, date desc, url desc)::bigint place from f qualify row_number() over (partition by site order by date is null, date desc, url desc) <= 30")
def fresh_posts(spark: SparkSession, d: str) -> DataFrame:
    posts = table(spark, d, "post_index_entry")
    wanted = posts.where("firm is not null").groupBy(F.col("firm").alias("site"), "url").agg(F.max(F.substring("post_date", 1, 10)).alias("date"))
    return crawl.fresh(wanted, posts.where(F.col("captured") < "2025-01-01")).select("site", "url", F.col("place").cast("bigint").alias("place"))


# -- sections and search ------------------------------------------------------------------------------------------------------

_SECTIONS = r"""
line as (select post_id, title, unnest(string_split(replace(body_text, chr(13) || chr(10), chr(10)), chr(10))) t, generate_subscripts(string_split(replace(body_text, chr(13) || chr(10), chr(10)), chr(10)), 1) n from post_index_entry where body_text is not null),
marked as (select *, regexp_matches(t, '^(#{1,2})\s+(.*)$') h, sum(regexp_matches(t, '^(#{1,2})\s+(.*)$')::int) over (partition by post_id order by n rows unbounded preceding) s from line),
sec as (select post_id, s, any_value(title) title, max(case when h then regexp_extract(t, '^(#{1,2})\s+(.*)$', 1) end) marks, max(case when h then trim(regexp_replace(regexp_extract(t, '^(#{1,2})\s+(.*)$', 2), '\s*#+\s*$', '')) end) head, regexp_replace(string_agg(t, chr(10) order by n), '^\s+|\s+$', '', 'g') body from marked group by post_id, s),
full_ as (select post_id, s, coalesce(length(marks), 1) as lvl, coalesce(head, title, '') heading, body from sec where body <> ''),
numbered as (select *, coalesce(nullif(substring(regexp_replace(regexp_replace(regexp_replace(lower(heading), '[`*_~>#]', '', 'g'), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 60), ''), 'section') base, row_number() over (partition by post_id order by s) ordinal from full_),
anchored as (select *, row_number() over (partition by post_id, base order by ordinal) nth from numbered)"""


@query(f"with {_SECTIONS} select post_id, ordinal::bigint ordinal, lvl::bigint as level, heading, case when nth > 1 then base || '-' || nth else base end anchor, body from anchored")
def section_split(spark: SparkSession, d: str) -> DataFrame:
    rows = sections.sections(table(spark, d, "post_index_entry"), ["post_id"], "body_text", "title")
    return rows.select("post_id", F.row_number().over(_by("post_id", "ordinal")).cast("bigint").alias("ordinal"), F.col("level").cast("bigint").alias("level"), "heading", "anchor", "body")


def _by(key: str, order: str):  # noqa: ANN202
    from pyspark.sql import Window

    return Window.partitionBy(key).orderBy(order)


@query(f"with {_SECTIONS} select post_id, count(*)::bigint sections, max(length(body))::bigint longest from anchored group by post_id")
def sections_per_post(spark: SparkSession, d: str) -> DataFrame:
    return sections.sections(table(spark, d, "post_index_entry"), ["post_id"], "body_text", "title").groupBy("post_id").agg(F.count("*").alias("sections"), F.max(F.length("body")).cast("bigint").alias("longest"))


_BM25 = """with post as (select doc_id id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda t: t <> '')) term from documents where text is not null),
tf as (select term, id, count(*) tf from post group by all), df as (select term, count(*) df from tf group by term),
len as (select doc_id id, len(list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda t: t <> '')) len from documents),
tot as (select count(*) n, avg(len) mean from len),
s as (select id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * (0.5 + tf * 2.2 / (tf + 1.2 * (0.3 + 0.7 * len / mean)))) score from tf join df using (term) join len using (id), tot where term in ('roth', 'conversion', 'trustee') group by id)
select id, round(score, 4) score from s order by s.score desc, id limit 10"""


@query(_BM25)
def bm25_topk(spark: SparkSession, d: str) -> DataFrame:
    """The ten best documents for three exact words."""
    index = search.build(table(spark, d, "documents"), "doc_id", ["text"])
    return search.ranked(index, "Roth conversion, trustee", 10, prefix=False, fuzzy=0).select("id", F.round("score", 4).alias("score"))


_SEARCH = (
    r"with src as (select post_id, coalesce(firm, '') firm, body_text, replace(concat_ws('-', file, post_id::varchar), '.md', '') doc, coalesce(array_to_string(tags, ' '), '') tags, substring(coalesce(nullif(trim(regexp_replace(coalesce(title, 'Untitled'), '(?s)\s+[—–|]\s+.*', '')), ''), trim(coalesce(title, 'Untitled'))), 1, 200) title from post_index_entry where url is not null qualify row_number() over (partition by url order by captured desc nulls last, post_id desc) = 1), "
    + _SECTIONS.replace("post_index_entry", "src")
    + r""", sect as (select firm || '::' || doc || '::' || case when nth > 1 then base || '-' || nth else base end id, firm, doc, tags, heading, case when nth > 1 then base || '-' || nth else base end anchor, anchored.body from anchored join src using (post_id)),
fld as (select id, unnest([{'f': 'firm', 'b': 4.0, 't': firm}, {'f': 'heading', 'b': 3.0, 't': heading}, {'f': 'tags', 'b': 2.0, 't': tags}, {'f': 'body', 'b': 1.0, 't': body}]) x from sect),
toks as (select id, x.f f, x.b b, list_filter(regexp_split_to_array(lower(coalesce(x.t, '')), '[^\p{L}\p{N}]+'), lambda t: t <> '') ts from fld),
tot as (select f, count(*) n, avg(len(ts)) mean from toks group by f),
post as (select term, f, b, id, l, count(*) tf from (select unnest(ts) term, f, b, id, len(ts) l from toks) group by all),
df as (select term, f, count(*) df from post group by all),
word as (select unnest(['a', 'benefciary', 'for', 'form', 'vet']) w),
hit as (select term, w, greatest(case when term = w then 1.0 else 0 end, case when starts_with(term, w) and term <> w then 0.375 * length(w) / (length(w) + 0.3 * (length(term) - length(w))) else 0 end, case when levenshtein(term, w) between 1 and least(6, round(0.2 * length(w))) then 0.45 * length(w) / (length(w) + levenshtein(term, w)) else 0 end) wt from (select distinct term from df), word),
want as (select term, sum(wt) wt from hit where wt > 0 group by term),
sc as (select id, sum(b * wt * ln(1 + (n - df + 0.5) / (df + 0.5)) * (0.5 + tf * 2.2 / (tf + 1.2 * (0.3 + 0.7 * l / mean)))) score from post join want using (term) join df using (term, f) join tot using (f) group by id)
select id, round(score, 2) score, firm, doc, heading, anchor from (select * from sc order by sc.score desc, id limit 8) join sect using (id)"""
)


@query(_SEARCH)
def section_search(spark: SparkSession, d: str) -> DataFrame:
    """Ranked sections with boosted fields, prefixes and misspellings."""
    rows = materialize(kb.post_sections(table(spark, d, "post_index_entry")))
    hits = search.ranked(kb.section_index(rows), "benefciary form for a vet", search.clamp_k("8"), search.BOOSTS)
    return hits.join(rows.select("id", "firm", "doc", "heading", "anchor"), "id").select("id", F.round("score", 2).alias("score"), "firm", "doc", "heading", "anchor")


_VOCAB = "voc as (select distinct unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda t: t <> '')) term from documents where text is not null)"


@query(f"with {_VOCAB}, w as (select term, greatest(case when term = 'invest' then 1.0 else 0 end, case when starts_with(term, 'invest') and term <> 'invest' then 0.375 * 6 / (6 + 0.3 * (length(term) - 6)) else 0 end, case when levenshtein(term, 'invest') = 1 then 0.45 * 6 / 7 else 0 end) weight from voc) select term, round(weight, 6) weight from w where weight > 0")
def prefix_and_fuzzy_terms(spark: SparkSession, d: str) -> DataFrame:
    index = search.build(table(spark, d, "documents"), "doc_id", ["text"])
    return search.matching_terms(index.vocabulary, "invest").select("term", F.round("weight", 6).alias("weight"))


@query(f"with {_VOCAB}, post as (select doc_id id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')) term from documents where text is not null) select term, count(distinct id)::bigint df, count(*)::bigint n from post group by term")
def inverted_index_terms(spark: SparkSession, d: str) -> DataFrame:
    return search.build(table(spark, d, "documents"), "doc_id", ["text"]).postings.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("n"))


# -- catalog ------------------------------------------------------------------------------------------------------------------


@query(f"with {LAST_META} select slug, meta_id, last_updated from last where slug is not null")
def latest_snapshots(spark: SparkSession, d: str) -> DataFrame:
    return _last_meta(spark, d).where("slug is not null").select("slug", "meta_id", "last_updated")


@query("with t as (select meta_id, unnest(tags) tag, generate_subscripts(tags, 1) p from firm_metadata), c as (select tag, count(*) n, min((meta_id, p)) f from t where tag is not null group by tag), tot as (select count(*) total from firm_metadata) select row_number() over (order by n desc, f)::bigint place, tag, n::bigint n, n || '/' || total as label from c, tot qualify row_number() over (order by n desc, f) <= 10")
def top_tags(spark: SparkSession, d: str) -> DataFrame:
    return catalog.top_tags(table(spark, d, "firm_metadata"), "tags", "meta_id").withColumn("place", F.col("place").cast("bigint"))


@query("with l as (select unnest([{'segment': 'segment_early_adults', 'v': segment_early_adults}, {'segment': 'segment_mid_career_401k', 'v': segment_mid_career_401k}]) x from firm_metadata) select x.segment segment, count_if(x.v = 'core')::bigint core, count_if(x.v = 'secondary')::bigint secondary, count_if(x.v = 'absent')::bigint absent, count(*)::bigint total from l group by 1")
def segment_tally(spark: SparkSession, d: str) -> DataFrame:
    return catalog.tally(table(spark, d, "firm_metadata"), ["segment_early_adults", "segment_mid_career_401k"], ["core", "secondary", "absent"])


@query("select coalesce(nullif(regulator, ''), nullif(regulatory_jurisdiction, ''), 'unknown') as value, count(*)::bigint n from firm_metadata group by 1")
def jurisdiction_tally(spark: SparkSession, d: str) -> DataFrame:
    return catalog.fallback_tally(table(spark, d, "firm_metadata"), "regulator", "regulatory_jurisdiction")


@query("select meta_id, case when threat_level is null then 3 when threat_level = 'high' then 0 when threat_level = 'medium-high' then 1 when threat_level = 'medium' then 2 when threat_level = 'low' then 3 else 99 end::bigint catalog_rank, case when threat_level = 'high' then 0 when threat_level = 'medium-high' then 1 when threat_level = 'medium' then 2 when threat_level = 'medium-low' then 3 when threat_level = 'low' then 4 else 9 end::bigint landing_rank from firm_metadata")
def catalog_ranks(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("threat_level")
    return table(spark, d, "firm_metadata").select("meta_id", catalog.catalog_rank(t).cast("bigint").alias("catalog_rank"), catalog.landing_rank(t).cast("bigint").alias("landing_rank"))


_CSV = (
    "competitor slug summary_line website competitor_type threat_level confidence team_size advisor_count employee_count branch_count geographic_scope headquarters_city headquarters_state aum_usd aum_as_of pricing_model fee_schedule_published "
    "fee_aum_pct_low fee_aum_pct_high fee_flat_low_usd fee_flat_high_usd min_account_usd wealth_tiers_served segment_early_adults segment_mid_career_401k regulatory_jurisdiction regulator sec_registered crd_number sec_number ownership_structure "
    "fiduciary_stated_explicitly fee_only_stated_explicitly disciplinary_disclosures disciplinary_disclosure_count media_presence design_tone positioning_claims vulnerabilities tags related_competitors last_updated next_review_by review_cadence_days"
).split()  # the columns in SQL's own list


def _csv_sql(c: str) -> str:
    t = f"array_to_string({c}, ', ')" if c in ("wealth_tiers_served", "positioning_claims", "vulnerabilities", "tags", "related_competitors") else f"rtrim(rtrim({c}::decimal(30, 10)::varchar, '0'), '.')" if c.startswith("fee_aum") else f"{c}::varchar"
    s = f"coalesce({t}, '')"
    return f"""case when regexp_matches({s}, '[",\n]') then '"' || replace({s}, '"', '""') || '"' else {s} end"""


@query(f"select meta_id, {" || ',' || ".join(_csv_sql(c) for c in _CSV)} line from firm_metadata")
def csv_lines(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "firm_metadata")
    return df.select("meta_id", catalog.csv_line(df).alias("line"))


# The matrix's rows in SQL, written out here and not taken from the operator.
_MATRIX_SQL = """with m as (select meta_id firm, unnest([
{'section': 'Threat & confidence', 'dimension': 'Threat level', 'value': coalesce(threat_level, '—')},
{'section': 'Threat & confidence', 'dimension': 'Confidence', 'value': coalesce(confidence, '—')},
{'section': 'Threat & confidence', 'dimension': 'Competitor type', 'value': coalesce(competitor_type, '—')},
{'section': 'Scale & scope', 'dimension': 'Team size', 'value': coalesce(team_size, '—')},
{'section': 'Scale & scope', 'dimension': 'Branches', 'value': coalesce(branch_count::varchar, '—')},
{'section': 'Scale & scope', 'dimension': 'Geography', 'value': coalesce(geographic_scope, '—')},
{'section': 'Pricing', 'dimension': 'Pricing model', 'value': coalesce(pricing_model, '—')},
{'section': 'Pricing', 'dimension': 'Fee schedule public', 'value': case when fee_schedule_published then 'yes' when not fee_schedule_published then 'no' else '—' end},
{'section': 'Pricing', 'dimension': 'Wealth tiers', 'value': coalesce(nullif(array_to_string(wealth_tiers_served, ', '), ''), '—')},
{'section': 'Our target segments', 'dimension': 'Early adults (first investment)', 'value': coalesce(segment_early_adults, '—')},
{'section': 'Our target segments', 'dimension': 'Mid-career 401(k)', 'value': coalesce(segment_mid_career_401k, '—')},
{'section': 'Regulatory / structure', 'dimension': 'Jurisdiction', 'value': coalesce(regulatory_jurisdiction, '—')},
{'section': 'Regulatory / structure', 'dimension': 'Regulator', 'value': coalesce(regulator, '—')},
{'section': 'Regulatory / structure', 'dimension': 'SEC registered', 'value': case when sec_registered then 'yes' when not sec_registered then 'no' else '—' end},
{'section': 'Regulatory / structure', 'dimension': 'CRD', 'value': coalesce(crd_number, '—')},
{'section': 'Regulatory / structure', 'dimension': 'Ownership', 'value': coalesce(ownership_structure, '—')},
{'section': 'Regulatory / structure', 'dimension': 'Fiduciary stated', 'value': case when fiduciary_stated_explicitly then 'yes' when not fiduciary_stated_explicitly then 'no' else '—' end},
{'section': 'Regulatory / structure', 'dimension': 'Fee-only stated', 'value': case when fee_only_stated_explicitly then 'yes' when not fee_only_stated_explicitly then 'no' else '—' end},
{'section': 'Regulatory / structure', 'dimension': 'Disciplinary disclosures', 'value': case when disciplinary_disclosures then 'yes' when not disciplinary_disclosures then 'no' else '—' end},
{'section': 'Brand & voice', 'dimension': 'Media presence', 'value': coalesce(media_presence, '—')},
{'section': 'Brand & voice', 'dimension': 'Design tone', 'value': coalesce(design_tone, '—')}
]) x from firm_metadata) """


@query(_MATRIX_SQL + "select x.section as section, x.dimension dimension, firm, x.value as value from m")
def matrix_long(spark: SparkSession, d: str) -> DataFrame:
    return catalog.matrix(table(spark, d, "firm_metadata"), "meta_id")


@query(_MATRIX_SQL + "select x.section as section, x.dimension dimension, max(case when firm = 1 then x.value end) \"1\", max(case when firm = 2 then x.value end) \"2\", max(case when firm = 3 then x.value end) \"3\" from m group by 1, 2")
def matrix_wide(spark: SparkSession, d: str) -> DataFrame:
    """The matrix with a column for each of three given firms, which are the query's parameter."""
    return catalog.matrix_wide(table(spark, d, "firm_metadata"), [1, 2, 3], "meta_id")


@query("select meta_id, coalesce(nullif(array_to_string(list_transform(tags, lambda t: '`' || t || '`'), ', '), ''), '—') tags from firm_metadata")
def tag_lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "firm_metadata").select("meta_id", tx.tag_list(F.col("tags")).alias("tags"))


@query("with e as (select distinct slug source, unnest(related_competitors) target from firm_metadata) select source, target from e where target is not null and target not in (select slug from firm_metadata where slug is not null)")
def dangling_links(spark: SparkSession, d: str) -> DataFrame:
    return catalog.dangling_edges(table(spark, d, "firm_metadata"))


@query("select meta_id, slug from firm_metadata where lower(coalesce(competitor_type, '')) = 'ria' and coalesce(sec_registered, false) and contains(lower(concat_ws(' ', coalesce(competitor, 'null'), coalesce(slug, 'null'), coalesce(summary_line, 'null'))), 'fee')")
def faceted_firms(spark: SparkSession, d: str) -> DataFrame:
    got = facets.filtered(table(spark, d, "firm_metadata"), {"type": " RIA ", "registered": "yes", "q": "Fee", "threat": ""}, {"type": "competitor_type", "threat": "threat_level"}, {"registered": "sec_registered"}, {"q": ["competitor", "slug", "summary_line"]})
    return got.select("meta_id", "slug")


@query("select distinct slug from firm_metadata where slug in (select firm from post_index_entry)")
def firms_with_posts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "firm_metadata").select("slug").distinct().join(table(spark, d, "post_index_entry").select(F.col("firm").alias("slug")), "slug", "left_semi")


@query("select distinct slug from firm_metadata where slug is not null and slug not in (select firm from post_index_entry where firm is not null)")
def firms_without_posts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "firm_metadata").where("slug is not null").select("slug").distinct().join(table(spark, d, "post_index_entry").select(F.col("firm").alias("slug")), "slug", "left_anti")


@query("select firm, count(*)::bigint posts, count(distinct url)::bigint urls from post_index_entry where firm is not null group by firm")
def posts_per_firm(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "post_index_entry").where("firm is not null").groupBy("firm").agg(F.count("*").alias("posts"), F.countDistinct("url").alias("urls"))


@query(f"with {LAST_META}, c as (select firm, count(distinct url) n from post_index_entry where firm is not null group by firm) select slug, meta_id, coalesce(n, 0)::bigint posts, coalesce(n, 0) > 0 has_corpus from last left join c on slug = firm")
def digest(spark: SparkSession, d: str) -> DataFrame:
    return kb.digest(table(spark, d, "firm_metadata"), table(spark, d, "post_index_entry")).select("slug", "meta_id", "posts", "has_corpus")


@query("with h as (select meta_id, unnest(trajectory.aum_history) x from firm_metadata), c as (select meta_id, x.as_of as_of, x.value_usd v, x.source source from h where x.as_of is not null and x.value_usd is not null) select meta_id, as_of, v as value_usd, lag(v) over w previous, v - lag(v) over w change from c window w as (partition by meta_id order by as_of, v)")
def history_deltas(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "firm_metadata").select("meta_id", F.inline("trajectory.aum_history")).where("as_of is not null and value_usd is not null")
    return catalog.deltas(rows, "meta_id", "as_of", "value_usd").select("meta_id", "as_of", "value_usd", "previous", "change")


@query("with h as (select meta_id, unnest(trajectory.advisor_count_history) x from firm_metadata) select meta_id, x.source source, max(x.as_of) as_of from h where x.as_of is not null and x.source is not null group by all")
def latest_by_source(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "firm_metadata").select("meta_id", F.inline("trajectory.advisor_count_history")).where("as_of is not null and source is not null")
    return catalog.keep_latest_by_source(rows, "meta_id", "source", "as_of").select("meta_id", "source", "as_of")


@query("with o as (select * from firm_metadata where slug is not null qualify row_number() over (partition by slug order by last_updated nulls first, meta_id) = 1), n as (select * from firm_metadata where slug is not null qualify row_number() over (partition by slug order by last_updated desc nulls last, meta_id desc) = 1), ol as (select slug, unnest([{'field': 'aum_usd', 'x': aum_usd::varchar}, {'field': 'website', 'x': website}, {'field': 'geographic_scope', 'x': geographic_scope}]) s from o), nl as (select slug, unnest([{'field': 'aum_usd', 'x': aum_usd::varchar}, {'field': 'website', 'x': website}, {'field': 'geographic_scope', 'x': geographic_scope}]) s from n) select ol.slug, ol.s.field field, ol.s.x as old, nl.s.x as new from ol join nl on ol.slug = nl.slug and ol.s.field = nl.s.field where ol.s.x is distinct from nl.s.x")
def changed_fields(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "firm_metadata").where("slug is not null")
    first = df.groupBy("slug").agg(F.min_by(F.struct(*df.columns), F.struct("last_updated", "meta_id")).alias("r")).select("r.*")
    return catalog.changed_fields(first, catalog.latest(df, "slug", F.col("last_updated"), F.col("meta_id")), "slug", ["aum_usd", "website", "geographic_scope"])


@query(f"with {LAST_META}, f as (select competitor, max_by(manual.aum_usd, facts_id) a, max_by(auto_filled.sec_iapd.branch_count, facts_id) b from (select * from company_facts where competitor is not null) group by competitor) select slug, coalesce(a, aum_usd) aum_usd, coalesce(b, branch_count) branch_count from last left join f using (competitor) where slug is not null")
def upserted_facts(spark: SparkSession, d: str) -> DataFrame:
    facts = table(spark, d, "company_facts").where("competitor is not null").groupBy("competitor").agg(F.expr("max_by(manual.aum_usd, facts_id) filter (where manual.aum_usd is not null)").alias("aum_usd"), F.expr("max_by(auto_filled.sec_iapd.branch_count, facts_id) filter (where auto_filled.sec_iapd.branch_count is not null)").alias("branch_count"))
    return catalog.upsert(_last_meta(spark, d), facts, "competitor", ["aum_usd", "branch_count"]).where("slug is not null").select("slug", "aum_usd", "branch_count")


# -- registry -----------------------------------------------------------------------------------------------------------------


@query("select firm_source_id, firm_name legal_name, coalesce(firm_ia_full_sec_number, firm_ia_sec_number) sec_number, case when json_valid(firm_ia_address_details) then nullif(concat_ws(', ', nullif(firm_ia_address_details ->> '$.officeAddress.street1', ''), nullif(firm_ia_address_details ->> '$.officeAddress.street2', ''), nullif(firm_ia_address_details ->> '$.officeAddress.city', ''), nullif(firm_ia_address_details ->> '$.officeAddress.state', ''), nullif(firm_ia_address_details ->> '$.officeAddress.postalCode', ''), nullif(firm_ia_address_details ->> '$.officeAddress.country', '')), '') end headquarters, coalesce(firm_ia_disclosure_fl, '') = 'Y' disciplinary_disclosures, array_to_string(list_filter(coalesce(firm_other_names, []), lambda n: n <> firm_name), '; ') dbas from iapd_hit")
def registry_sections(spark: SparkSession, d: str) -> DataFrame:
    return registry.registry_section(table(spark, d, "iapd_hit")).select(F.col("crd_number").alias("firm_source_id"), "legal_name", "sec_number", "headquarters", "disciplinary_disclosures", F.col("dbas_and_affiliates").alias("dbas"))


@query(
    f"with q as (select distinct competitor query, list_filter(regexp_split_to_array({_LEGAL.format('competitor')}, '\\s+'), lambda w: length(w) > 2) words from firm_metadata where competitor is not null), "
    f"n as (select distinct firm_source_id, {_LEGAL.format('x')} name from (select firm_source_id, firm_name x from iapd_hit union all select firm_source_id, unnest(firm_other_names) from iapd_hit) where x is not null), "
    "s as (select query, firm_source_id, max(len(words) + case when name = array_to_string(words, ' ') then 5 else 0 end)::bigint score from q, n where len(words) > 0 and len(list_filter(words, lambda w: contains(name, w))) = len(words) group by all) "
    "select query, firm_source_id, score from s qualify row_number() over (partition by query order by score desc, firm_source_id) = 1"
)
def registry_matches(spark: SparkSession, d: str) -> DataFrame:
    """The best registry hit of each firm by the words of its name."""
    got = registry.best_hits(table(spark, d, "firm_metadata").select(F.col("competitor").alias("query")).where("query is not null").distinct(), table(spark, d, "iapd_hit"))
    return got.withColumn("score", F.col("score").cast("bigint"))


def _filings(spark: SparkSession, d: str) -> DataFrame:
    """(meta_id, text): a filing in the regulator's wording for each snapshot, with its numbers; no table holds filings."""
    number = lambda c: F.format_number(F.coalesce(c, F.lit(0)), 0)
    parts = (
        F.lit("Approximately how many employees do you have? Include full- and part-time but do not include any clerical workers. "), number("employee_count"), F.lit("\nperform investment advisory functions (including research)? "), number("advisor_count"),
        F.lit("\nregistered with one or more state securities authorities as investment adviser representatives? "), number("branch_count"), F.lit("\nDiscretionary: (a) $ "), number("aum_usd"), F.lit(" (d) 900 Non-Discretionary: (b) $ 0 (e) 0 Total: (c) $ "), number("aum_usd"), F.lit(" (f) "), number("meta_id"),
        F.when(F.col("disciplinary_disclosures"), "\nDRP - Regulatory Disclosure").otherwise(""), F.lit("\nsigned 03/14/2023 amended 11/02/2024\n"), F.coalesce("summary_line", F.lit("")),
    )
    return table(spark, d, "firm_metadata").select("meta_id", F.concat(*parts).alias("text"))


@query("select meta_id, coalesce(employee_count, 0)::bigint employee_count, coalesce(advisor_count, 0)::bigint advisor_count, coalesce(branch_count, 0)::bigint iar_state_count, coalesce(aum_usd, 0)::bigint aum_total_usd, 0::bigint aum_nondiscretionary_usd, meta_id::bigint account_count_total, coalesce(disciplinary_disclosures, false)::int::bigint filed_drp_count, coalesce(disciplinary_disclosures, false) has_filed_drps, '2024-11-02' filing_date from firm_metadata")
def filing_fields(spark: SparkSession, d: str) -> DataFrame:
    texts = _filings(spark, d)
    kept = ("employee_count", "advisor_count", "iar_state_count", "aum_total_usd", "aum_nondiscretionary_usd", "account_count_total", "filed_drp_count")
    return texts.select("meta_id", *registry.filing_fields(F.col("text"))).select("meta_id", *[F.col(c).cast("bigint").alias(c) for c in kept], "has_filed_drps", "filing_date")


@query(f"with {LAST_META} select slug, coalesce(employee_count, 0)::bigint employee_count, coalesce(advisor_count, 0)::bigint advisor_count, coalesce(aum_usd, 0)::bigint aum_usd, '2024-11-02' aum_as_of from last where slug is not null")
def filing_upserts(spark: SparkSession, d: str) -> DataFrame:
    """From the filings' text to the updated records: parsed, then put over each firm's last snapshot."""
    last = _last_meta(spark, d).where("slug is not null")
    parsed = _filings(spark, d).join(last.select("meta_id", "slug"), "meta_id").select("slug", *registry.filing_fields(F.col("text")))
    new = parsed.select("slug", *[F.col(c).cast("bigint").alias(c) for c in ("employee_count", "advisor_count")], F.col("aum_total_usd").cast("bigint").alias("aum_usd"), F.col("filing_date").alias("aum_as_of"))
    return catalog.upsert(last, new, "slug", ["employee_count", "advisor_count", "aum_usd", "aum_as_of"]).select("slug", "employee_count", "advisor_count", "aum_usd", "aum_as_of")


@query("with f as (select competitor, max_by(auto_filled.sec_iapd, facts_id) s from (select * from company_facts where competitor is not null) group by competitor), m as (select distinct competitor from firm_metadata where competitor is not null) select coalesce(f.competitor, m.competitor) competitor, case when f.competitor is null then 'no facts' when m.competitor is null then 'no metadata' when not coalesce(s.matched, false) then 'not matched' when coalesce(s.adv_pdf_url, '') = '' then 'no address' end reason from f full join m on f.competitor = m.competitor")
def filing_skips(spark: SparkSession, d: str) -> DataFrame:
    facts = table(spark, d, "company_facts").where("competitor is not null").select("competitor", "facts_id", F.col("auto_filled.sec_iapd").alias("s"))
    facts = facts.groupBy("competitor").agg(F.expr("max_by(s, facts_id) filter (where s is not null)").alias("s"), F.lit(True).alias("f"))
    both = facts.join(table(spark, d, "firm_metadata").where("competitor is not null").select("competitor", F.lit(True).alias("m")).distinct(), "competitor", "full_outer")
    return both.select("competitor", registry.skip_reason(F.col("f"), F.col("m"), F.col("s.matched"), F.col("s.adv_pdf_url")).alias("reason"))


# -- quality and refresh ------------------------------------------------------------------------------------------------------


@query(f"select meta_id, coalesce(try_strptime(next_review_by, '%Y-%m-%d')::date < date '{TODAY}', true) stale, strftime(date '{TODAY}' + coalesce(review_cadence_days, 90)::int, '%Y-%m-%d') next_review from firm_metadata")
def review_dates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "firm_metadata").select("meta_id", quality.is_stale(F.col("next_review_by"), TODAY).alias("stale"), quality.next_review(TODAY, F.col("review_cadence_days")).alias("next_review"))


@query("with t as (select unnest(tags) tag from post_index_entry) select tag, count(*)::bigint n from t where tag is not null and tag not in ('tax', 'estate', 'retirement', 'investing') group by tag")
def off_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    vocabulary = spark.createDataFrame([("tax",), ("estate",), ("retirement",), ("investing",)], "tag string")
    return quality.off_vocabulary(table(spark, d, "post_index_entry"), "tags", vocabulary)


@query("select firm, title, count(*)::bigint n from post_index_entry group by firm, title having count(*) > 1")
def repeated_titles(spark: SparkSession, d: str) -> DataFrame:
    return quality.repeated(table(spark, d, "post_index_entry"), "firm", "title")


_PHRASES = ["best interest", "no reason to prefer", "the honest answer", "guaranteed"]


@query("with c as (select doc_id, unnest([" + ", ".join(f"{{'phrase': '{p}', 'n': (length(lower(text)) - length(replace(lower(text), '{p}', ''))) // {len(p)}}}" for p in _PHRASES) + "]) x from documents where text is not null) select doc_id, x.phrase phrase, x.n::bigint n from c where x.n > 0")
def lexicon_review(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", F.inline(tx.lexicon_hits(F.col("text"), _PHRASES)))
    return rows.withColumn("n", F.col("n").cast("bigint"))


@query("with a as (select slug, min_by(summary_line, meta_id) s from firm_metadata where summary_line is not null group by slug), b as (select slug, max_by(summary_line, meta_id) s from firm_metadata where summary_line is not null group by slug) select slug, 'differs' state from a join b using (slug) where a.s <> b.s")
def drifted_mirrors(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "firm_metadata").where("summary_line is not null and slug is not null")
    a = df.groupBy("slug").agg(F.min_by("summary_line", "meta_id").alias("t"))
    b = df.groupBy("slug").agg(F.max_by("summary_line", "meta_id").alias("t"))
    return quality.drifted(a, b, "slug", "t")


@query("with p as (select * from post_index_entry where url is not null), o as (select url, post_id from p where captured < timestamp '2025-01-01'), n as (select url, arg_min(post_id, (captured, post_id)) post_id from p where captured >= timestamp '2025-01-01' group by url) select url, post_id from o union all select url, post_id from n where url not in (select url from o)")
def appended_posts(spark: SparkSession, d: str) -> DataFrame:
    """Captures before a day, then all later ones whose address is new."""
    posts = table(spark, d, "post_index_entry").where("url is not null")
    return ingest.append_new(posts.where("captured < timestamp '2025-01-01'"), posts.where("captured >= timestamp '2025-01-01'")).select("url", "post_id")


@query("select post_id, '---' || chr(10) || 'title: ' || coalesce(to_json(title)::varchar, 'null') || chr(10) || 'date: ' || coalesce(to_json(post_date)::varchar, 'null') || chr(10) || 'tags: [' || coalesce(array_to_string(list_transform(tags, lambda t: to_json(t)::varchar), ', '), '') || ']' || chr(10) || '---' header from post_index_entry")
def post_headers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "post_index_entry").select("post_id", tx.front_matter({"title": F.col("title"), "date": F.col("post_date")}, {"tags": F.coalesce("tags", F.array().cast("array<string>"))}).alias("header"))


@query(f"with {LAST_META}, c as (select firm, count(distinct url) n from post_index_entry where firm is not null group by firm) select slug, '- ' || trim(competitor) || ': ' || concat_ws(' · ', competitor_type, headquarters_state, case when aum_usd is not null then printf('$%.2fB', aum_usd / 1e9) end, case when coalesce(n, 0) = 1 then '1 post' else coalesce(n, 0) || ' posts' end) line from last left join c on slug = firm")
def manifest_lines(spark: SparkSession, d: str) -> DataFrame:
    return writers.manifest(kb.digest(table(spark, d, "firm_metadata"), table(spark, d, "post_index_entry")))


@query("with c as (select page_id, unnest(list_transform(ctas, lambda c: c.text)) colour, generate_subscripts(ctas, 1) p from page_capture), g as (select page_id, colour, count(*) n, min(p) f from c where colour is not null group by all), r as (select page_id, colour, row_number() over (partition by page_id order by n desc, f) k from g) select page_id, string_agg(colour, ', ' order by k) palette from r where k <= 8 group by page_id")
def palettes(spark: SparkSession, d: str) -> DataFrame:
    """The histogram operator on the labels of pages' calls to action, which stand in for colours."""
    df = table(spark, d, "page_capture").withColumn("colours", F.transform("ctas", lambda c: c["text"]))
    return quality.palette(df, "page_id", "colours").select("page_id", F.array_join("palette", ", ").alias("palette"))


_HTML = "concat('<html><head><title>', coalesce(title, ''), '</title><meta name=\"description\" content=\"', replace(coalesce(meta.description, ''), '\"', ''), '\"></head><body><a href=\"', coalesce(url, ''), '\">x</a></body></html>')"


@query(f"with h as (select page_id, {_HTML} h from page_capture) select page_id, trim(regexp_extract(h, '(?is)<title[^>]*>(.*?)</title>', 1)) title, nullif(regexp_extract(h, '(?is)<meta[^>]+name=[\"'']description[\"''][^>]*content=[\"'']([^\"'']*)', 1), '') description, regexp_extract(h, '(?is)<a\\s[^>]*?href=[\"'']([^\"'']*)[\"'']', 1) link from h")
def html_fields(spark: SparkSession, d: str) -> DataFrame:
    q = F.concat(F.lit("<html><head><title>"), F.coalesce("title", F.lit("")), F.lit('</title><meta name="description" content="'), F.replace(F.coalesce(F.col("meta")["description"], F.lit("")), F.lit('"'), F.lit("")), F.lit('"></head><body><a href="'), F.coalesce("url", F.lit("")), F.lit('">x</a></body></html>'))
    df = table(spark, d, "page_capture").select("page_id", q.alias("h"))
    return df.select("page_id", hx.title(F.col("h")).alias("title"), hx.meta(F.col("h"), "description").alias("description"), F.coalesce(F.try_element_at(hx.links(F.col("h")), F.lit(1)), F.lit("")).alias("link"))


@query()
def html_markdown(spark: SparkSession, d: str) -> DataFrame:
    """Pages as HTML built of their lines, read back by the parser."""
    lines = F.array_join(F.transform(F.split("body_text", "\n"), lambda x: F.concat(F.lit("<p>"), tx.html_escape(x), F.lit("</p>"))), "")
    df = table(spark, d, "page_capture").where("body_text is not null").select("page_id", F.concat(F.lit("<html><body><script>var a='</p>';</script><main><h1>"), tx.html_escape(F.coalesce("title", F.lit(""))), F.lit("</h1>"), lines, F.lit("</main></body></html>")).alias("html"))
    return hx.parsed(df, "page_id", "html").select("page_id", F.size("headings").alias("headings"), F.length("markdown").alias("chars"))


# -- documents ----------------------------------------------------------------------------------------------------------------

def _grouped(c: str) -> str:
    return f"format('{{:,}}', {c}::bigint)"


@query(f"select meta_id, concat_ws('; ', coalesce({_grouped('employee_count')}, '?') || ' employees', coalesce({_grouped('advisor_count')}, '?') || ' advisors', '$' || {_grouped('coalesce(aum_usd, 0)')} || ' under management', {_grouped('branch_count')} || ' branches', 'as of ' || aum_as_of) sentence from firm_metadata")
def snapshot_sentences(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "firm_metadata").select("meta_id", documents.snapshot_sentence().alias("sentence"))


@query(f"with {LAST_META}, c as (select firm, count(distinct url) n from post_index_entry where firm is not null group by firm) select slug, concat_ws(' · ', competitor_type, regulator, case when aum_usd is not null then printf('$%.2fB', aum_usd / 1e9) end, website, case when coalesce(n, 0) = 1 then '1 post' else coalesce(n, 0) || ' posts' end) facts from last left join c on slug = firm")
def firm_pages(spark: SparkSession, d: str) -> DataFrame:
    return kb.digest(table(spark, d, "firm_metadata"), table(spark, d, "post_index_entry")).select("slug", documents.firm_facts().alias("facts"))


@query(_MATRIX_SQL + "select x.section as section, x.dimension dimension, '| ' || x.section || ' / ' || x.dimension || ' | ' || string_agg(replace(x.value, '|', '\\|'), ' | ' order by firm) || ' |' line, (firm // 100)::bigint block from m group by 1, 2, firm // 100")
def matrix_markdown(spark: SparkSession, d: str) -> DataFrame:
    return documents.matrix_markdown(catalog.matrix(table(spark, d, "firm_metadata"), "meta_id"), F.floor(F.col("firm") / 100))


@query("select firm, kind, count(*)::bigint entries, string_agg(coalesce(title, '') || '|' || coalesce(url, ''), chr(10) order by coalesce(title, '') || '|' || coalesce(url, '')) listed from (select firm, case when lower(coalesce(nullif(kind, ''), 'unknown')) = 'blog' then 'blog_index' else lower(coalesce(nullif(kind, ''), 'unknown')) end kind, trim(coalesce(title, '')) title, url from page_capture union all select firm, 'blog_post', trim(coalesce(title, '')), url from post_index_entry) group by firm, kind")
def page_index_documents(spark: SparkSession, d: str) -> DataFrame:
    """The index's documents, read back: the entries of all parts of a firm and kind."""
    parts = documents.index_document(_index(spark, d))
    back = parts.select("firm", "kind", F.explode(F.from_json("document", "array<struct<title:string,url:string>>")).alias("e"))
    line = F.concat_ws("|", F.coalesce("e.title", F.lit("")), F.coalesce("e.url", F.lit("")))
    return back.select("firm", "kind", line.alias("line")).groupBy("firm", "kind").agg(F.count("*").alias("entries"), F.array_join(F.array_sort(F.collect_list("line")), "\n").alias("listed"))


@query("with f as (select distinct slug from firm_metadata where slug is not null), c as (select firm, count(distinct url) n from post_index_entry where firm is not null group by firm) select count(*)::bigint firms, count(n)::bigint with_posts, coalesce(sum(n), 0)::bigint posts, count_if(n is null)::bigint without_posts from f left join c on slug = firm")
def statistics(spark: SparkSession, d: str) -> DataFrame:
    return documents.statistics(table(spark, d, "firm_metadata"), table(spark, d, "post_index_entry"))


@query(f"with {LAST_META} select case when threat_level is null then 3 when threat_level = 'high' then 0 when threat_level = 'medium-high' then 1 when threat_level = 'medium' then 2 when threat_level = 'low' then 3 else 99 end::bigint rank, slug from last where slug is not null and coalesce(try_strptime(next_review_by, '%Y-%m-%d')::date < date '{TODAY}', true)")
def stale_first(spark: SparkSession, d: str) -> DataFrame:
    """Firms due for review, the most threatening first."""
    due = _last_meta(spark, d).where(F.col("slug").isNotNull() & quality.is_stale(F.col("next_review_by"), TODAY))
    return due.select(catalog.catalog_rank(F.col("threat_level")).cast("bigint").alias("rank"), "slug").orderBy("rank", "slug")


@query("with o as (select competitor, arg_min(manual, facts_id) m, arg_min(auto_filled, facts_id) a from company_facts where competitor is not null group by competitor), n as (select competitor, arg_max(manual, facts_id) m, arg_max(auto_filled, facts_id) a from company_facts where competitor is not null group by competitor) select competitor, coalesce(o.a.sec_iapd.crd_number, case when o.a.sec_iapd is null then n.a.sec_iapd.crd_number end) crd_number, len(coalesce(n.a, o.a).footer_emails)::bigint emails, len(coalesce(o.m, n.m).leadership)::bigint leaders from n join o using (competitor)")
def facts_again(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "company_facts").where("competitor is not null")
    side = lambda f: df.groupBy("competitor").agg(*[f(F.struct(F.lit(1).alias("x"), F.col(c).alias(c)), "facts_id").getField(c).alias(c) for c in ("auto_filled", "manual")])
    got = documents.facts_again(side(F.min_by), side(F.max_by))
    return got.select("competitor", F.col("auto_filled")["sec_iapd"]["crd_number"].alias("crd_number"), F.size(F.col("auto_filled")["footer_emails"]).cast("bigint").alias("emails"), F.size(F.col("manual")["leadership"]).cast("bigint").alias("leaders"))


@query("select firm, min(url) blog from page_capture where kind = 'blog' and firm is not null group by firm")
def blog_addresses(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "page_capture").where("kind = 'blog' and firm is not null").groupBy("firm").agg(F.min("url").alias("blog"))


@query("with e as (select distinct slug, unnest(related_competitors) r from firm_metadata where slug is not null) select r target, count(*)::bigint n from e where r is not null group by r")
def link_targets(spark: SparkSession, d: str) -> DataFrame:
    return catalog.edges(table(spark, d, "firm_metadata").where("slug is not null"), "slug", "related_competitors").groupBy("target").agg(F.count("*").alias("n"))


@query("select firm, kind, source, count(*)::bigint n from (select firm, lower(coalesce(nullif(kind, ''), 'unknown')) kind, 'site' source from page_capture union all select firm, 'blog_post', 'blog' from post_index_entry) group by grouping sets ((firm), (kind, source), ())")
def page_cube(spark: SparkSession, d: str) -> DataFrame:
    """Tallies by firm, by kind and source, and over all, from one pass."""
    pages_ = table(spark, d, "page_capture").select("firm", F.lower(tx.or_else(F.col("kind"), "unknown")).alias("kind"), F.lit("site").alias("source"))
    posts = table(spark, d, "post_index_entry").select("firm", F.lit("blog_post").alias("kind"), F.lit("blog").alias("source"))
    both = pages_.unionByName(posts)
    return both.groupingSets([[F.col("firm")], [F.col("kind"), F.col("source")], []], "firm", "kind", "source").agg(F.count("*").alias("n"))


@query("select distinct firm from page_capture where firm is not null intersect select distinct firm from post_index_entry where firm is not null")
def firms_on_both_sides(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "page_capture").where("firm is not null").select("firm").intersect(table(spark, d, "post_index_entry").where("firm is not null").select("firm"))


@query("select date_trunc('hour', ts) \"hour\", event_type, count(*)::bigint n from events group by 1, 2")
def events_by_hour(spark: SparkSession, d: str) -> DataFrame:
    """The windowed count of the streaming part over a table at rest; an addition to the capture pipeline."""
    got = ingest.windowed_counts(table(spark, d, "events"), "ts", "1 hour", "1 hour", "event_type")
    return got.select(F.col("window.start").alias("hour"), "event_type", "n")


# -- further documents and checks -----------------------------------------------------------------------------------------------


@query("with i as (select firm, file, post_id from post_index_entry), f as (select distinct firm, file from post_index_entry where body_text is not null and body_text <> '') select firm, file, post_id from i where (firm, file) in (select (firm, file) from f where firm is not null and file is not null)")
def listed_posts(spark: SparkSession, d: str) -> DataFrame:
    """Posts of the index whose file is there, that is, holds a text."""
    posts = table(spark, d, "post_index_entry")
    return kb.listed_posts(posts.select("firm", "file", "post_id"), posts.where("body_text <> ''"), "firm", "file")


_CAVEATS = "cav as (select competitor, min(manual.notes) caveat from company_facts where competitor is not null and manual.notes <> '' group by competitor)"


def _caveats(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "company_facts").where("competitor is not null and manual.notes <> ''").groupBy("competitor").agg(F.min("manual.notes").alias("caveat"))


@query(f"with {_CAVEATS}, {LAST_META} select slug, competitor, caveat from last left join cav using (competitor)")
def caveats(spark: SparkSession, d: str) -> DataFrame:
    """Each firm with what people noted about it."""
    return catalog.with_caveats(_last_meta(spark, d), _caveats(spark, d), "competitor").select("slug", "competitor", "caveat")


@query(f"with {_CAVEATS}, {LAST_META}, src as (select post_id, coalesce(firm, '') firm, body_text, title from post_index_entry where url is not null qualify row_number() over (partition by url order by captured desc nulls last, post_id desc) = 1), {_SECTIONS.replace('post_index_entry', 'src')}, n as (select firm, count(*) n from anchored join src using (post_id) group by firm), c as (select firm, count(distinct url) posts from post_index_entry where firm is not null group by firm) select slug, meta_id, coalesce(posts, 0)::bigint posts, coalesce(posts, 0) > 0 has_corpus, coalesce(n, 0)::bigint sections, caveat from last left join cav using (competitor) left join n on slug = n.firm left join c on slug = c.firm")
def digest_rows(spark: SparkSession, d: str) -> DataFrame:
    meta = table(spark, d, "firm_metadata")
    by_slug = _last_meta(spark, d).join(_caveats(spark, d), "competitor").select("slug", "caveat")
    return kb.digest_rows(meta, table(spark, d, "post_index_entry"), by_slug).select("slug", "meta_id", "posts", "has_corpus", "sections", "caveat")


_UNION = "select '{0}' as scope, post_id::varchar doc, ordinal::bigint ordinal, lvl::bigint as level, heading, case when nth > 1 then base || '-' || nth else base end anchor from anchored"


@query(f"select * from (with {_SECTIONS} {_UNION.format('firm')}) union all select * from (with src as (select doc_id post_id, text body_text, title from documents), {_SECTIONS.replace('post_index_entry', 'src')} {_UNION.format('context')})")
def section_union(spark: SparkSession, d: str) -> DataFrame:
    """Sections of firms' posts and of context documents in one table."""
    got = kb.section_union(("firm", table(spark, d, "post_index_entry"), "post_id", "body_text", "title"), ("context", table(spark, d, "documents"), "doc_id", "text", "title"))
    return got.select("scope", "doc", F.col("ordinal").cast("bigint").alias("ordinal"), F.col("level").cast("bigint").alias("level"), "heading", "anchor")


@query("select firm, post_id, row_number() over (partition by firm order by coalesce(post_date, '') desc, post_id)::bigint place from post_index_entry")
def posts_by_date(spark: SparkSession, d: str) -> DataFrame:
    return documents.posts_by_date(table(spark, d, "post_index_entry"), "firm", "post_date", "post_id").select("firm", "post_id", "place")


@query(
    f"with {LAST_META}, c as (select firm, count(distinct url) n from post_index_entry where firm is not null group by firm), f as (select distinct slug from firm_metadata where slug is not null), "
    "doc as (select distinct firm slug, replace(coalesce(nullif(kind, ''), 'unknown'), ' ', '_') || '.md' as name from page_capture where firm is not null), "
    "post as (select firm, min(post_date) date, min(title) title, url from post_index_entry where firm is not null and url is not null group by firm, url) "
    "select slug, 0 part, 1::bigint place, '# ' || coalesce(competitor, slug) line from last where slug is not null union all "
    "select slug, 1, 1, concat_ws(' · ', competitor_type, regulator, case when aum_usd is not null then printf('$%.2fB', aum_usd / 1e9) end, website, case when coalesce(n, 0) = 1 then '1 post' else coalesce(n, 0) || ' posts' end) from last left join c on slug = firm where slug is not null union all "
    "select slug, 2, row_number() over (partition by slug order by name), '- [' || replace(regexp_replace(name, '\\.md$', ''), '_', ' ') || '](/' || slug || '/' || name || ')' from doc union all "
    "select firm, 3, row_number() over (partition by firm order by coalesce(date, '') desc, url), '- ' || coalesce(date, 'undated') || ': [' || coalesce(title, 'Untitled') || '](' || url || ')' from post where firm in (select slug from f)"
)
def firm_page_lines(spark: SparkSession, d: str) -> DataFrame:
    """Firms' pages with facts, links to documents and all posts."""
    firms = kb.digest(table(spark, d, "firm_metadata"), table(spark, d, "post_index_entry")).where("slug is not null")
    docs = table(spark, d, "page_capture").where("firm is not null").select(F.col("firm").alias("slug"), F.concat(F.replace(tx.or_else(F.col("kind"), "unknown"), F.lit(" "), F.lit("_")), F.lit(".md")).alias("name")).distinct()
    posts = table(spark, d, "post_index_entry").where("firm is not null and url is not null").groupBy("firm", "url").agg(F.min("post_date").alias("date"), F.min("title").alias("title"))
    return documents.firm_page_lines(firms, docs, posts)


@query(
    "with h as (select meta_id, unnest(trajectory.aum_history) x from firm_metadata), r as (select meta_id, x.as_of a, x.value_usd v, try_strptime(x.as_of || substring('0001-01-01', length(x.as_of) + 1), '%Y-%m-%d')::date dd from h where x.as_of is not null and x.value_usd is not null), "
    "l as (select meta_id, max((dd, a, v)) l from r where dd is not null group by meta_id), b as (select r.*, l.l[1] ld, l.l[2] la, l.l[3] lv from r join l using (meta_id) where dd is not null) "
    "select meta_id, any_value(la) as_of, any_value(lv)::bigint as value, (max((dd, a, v)) filter (where dd <= ld - interval 12 month))[3]::bigint year_ago, (max((dd, a, v)) filter (where dd between ld - interval 36 month and ld - interval 24 month))[3]::bigint years_ago from b group by meta_id"
)
def history_spans(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "firm_metadata").select("meta_id", F.inline("trajectory.aum_history"))
    return catalog.spans(rows, "meta_id", "as_of", "value_usd").select("meta_id", "as_of", F.col("value").cast("bigint").alias("value"), F.col("year_ago").cast("bigint").alias("year_ago"), F.col("years_ago").cast("bigint").alias("years_ago"))


@query("with t as (select post_id, list_filter(list_transform(coalesce(tags, []), lambda t: lower(trim(replace(replace(coalesce(t, ''), ',', ' '), '\"', ' ')))), lambda t: length(t) between 1 and 39) l, nullif(trim(replace(coalesce(author, ''), '\"', ' ')), '') author from post_index_entry), u as (select post_id, author, l, unnest(l) t, generate_subscripts(l, 1) p from t), g as (select post_id, t, min(p) p from u group by all), k as (select post_id, array_to_string(list(t order by p)[1:10], ',') tags from g group by post_id) select t.post_id, author, coalesce(tags, '') tags from t left join k using (post_id)")
def post_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Author and tags of posts, from pages with meta tags built of the table's columns, as no table holds HTML."""
    clean = lambda c: F.trim(F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit(" ")))
    tags = F.transform(F.coalesce("tags", F.array().cast("array<string>")), lambda t: F.replace(F.replace(F.coalesce(t, F.lit("")), F.lit(","), F.lit(" ")), F.lit('"'), F.lit(" ")))
    page = F.concat(F.lit('<head><meta name="keywords" content="'), F.array_join(tags, ","), F.lit('"><meta name="author" content="'), clean(F.col("author")), F.lit('"></head>'))
    df = table(spark, d, "post_index_entry").select("post_id", page.alias("h"))
    return df.select("post_id", hx.author(F.col("h")).alias("author"), F.array_join(hx.post_tags(F.col("h")), ",").alias("tags"))


@query("select firm site, url from (select firm, url from page_capture where firm is not null and url is not null and url not like '%<%' and not regexp_matches(url, '\\s') and url <> '') group by all")
def sitemap_pages(spark: SparkSession, d: str) -> DataFrame:
    """Addresses of all pages, read from sitemaps behind two levels of indexes that robots files name; the files are built of the captures."""
    own = table(spark, d, "page_capture").where("firm is not null and url is not null and url not like '%<%' and url <> ''").where(~F.col("url").rlike(r"\s")).select(F.col("firm").alias("site"), "url").distinct()
    own = own.withColumn("part", F.pmod(F.xxhash64("url"), F.lit(50)).cast("string"))
    at = lambda *x: F.concat(F.lit("https://site.example/"), *x)
    loc = lambda c: F.concat(F.lit("<loc>"), c, F.lit("</loc>"))
    maps = own.groupBy("site", "part").agg(F.array_join(F.collect_list(loc(F.col("url"))), "").alias("x")).select("site", F.lit("").alias("base"), at(F.lit("map"), "part").alias("url"), F.concat(F.lit("<urlset>"), "x", F.lit("</urlset>")).alias("xml"))
    inner = own.select("site", "part").distinct().groupBy("site").agg(F.array_join(F.collect_list(loc(at(F.lit("map"), F.col("part")))), "").alias("x")).select("site", F.lit("").alias("base"), at(F.lit("inner")).alias("url"), F.concat(F.lit("<sitemapindex>"), "x", F.lit("</sitemapindex>")).alias("xml"))
    sites = own.select("site").distinct()
    outer = sites.select("site", F.lit("").alias("base"), at(F.lit("outer")).alias("url"), F.concat(F.lit("<sitemapindex>"), loc(at(F.lit("inner"))), F.lit("</sitemapindex>")).alias("xml"))
    robots = sites.select("site", F.concat(F.lit("User-agent: *\nDisallow:\nSitemap: "), at(F.lit("outer"))).alias("text"))
    reached = crawl.reachable_sitemaps(maps.unionByName(inner).unionByName(outer), crawl.robots_sitemaps(robots))
    return reached.select("site", F.explode(F.regexp_extract_all("xml", F.lit(r"(?i)<loc>\s*([^<\s]+)\s*</loc>"), F.lit(1))).alias("url")).distinct()


_LAST_SEGMENT = f"coalesce(list_filter(string_split({_PATH}, '/'), lambda s: s <> '')[-1], '')"
_HOST = "regexp_extract(url, '^\\s*[A-Za-z][A-Za-z0-9+.-]*://([^/?#\\s:]+)', 1)"


@query(f"select post_id, case when {_PATH} is null then '' else replace(replace({_LAST_SEGMENT}, '-', ' '), '_', ' ') end segment, case when {_PATH} is null then null else array_to_string(list_transform(list_filter(regexp_split_to_array(string_split(regexp_replace(lower({_HOST}), '^www\\.', ''), '.')[1], '[\\s\\-_.]+'), lambda w: w <> ''), lambda w: upper(w[1]) || lower(w[2:])), '_') end site_slug, 'https://kb.example' || '/posts/' || file as address from post_index_entry where url is not null and regexp_matches(url, '^https?://[A-Za-z0-9.-]+(/[^\\s?#]*)?$')")
def address_parts(spark: SparkSession, d: str) -> DataFrame:
    """The text of an address's last segment, its site's folder name, and a file's address below a base, for well-formed addresses."""
    rows = table(spark, d, "post_index_entry").where(F.col("url").rlike(r"^https?://[A-Za-z0-9.-]+(/[^\s?#]*)?$"))
    return rows.select("post_id", u.segment_text(F.col("url")).alias("segment"), u.slug_of_site(F.col("url")).alias("site_slug"), u.absolute("https://kb.example/", F.concat(F.lit("/posts/"), F.col("file"))).alias("address"))


@query("select meta_id, case when employee_count <= 1 then 'solo' when employee_count <= 30 then 'small' when employee_count <= 300 then 'mid' when employee_count is not null then 'large' end band, case when disciplinary_disclosures is null then disciplinary_disclosure_count when not disciplinary_disclosures then 0 when disciplinary_disclosure_count > 0 then disciplinary_disclosure_count end::bigint disclosures, floor(coalesce(fee_aum_pct_low, 0) * 10000 + 0.5) / 10000 fee, coalesce(last_updated, next_review_by, aum_as_of) dated, replace(regexp_replace(slug || '.md', '\\.md$', ''), '_', ' ') document from firm_metadata")
def record_values(spark: SparkSession, d: str) -> DataFrame:
    """Size bands, aligned disclosure counts, rounding, the first date there is, and a document's shown name."""
    return table(spark, d, "firm_metadata").select(
        "meta_id", v.size_band(F.col("employee_count")).alias("band"), registry.aligned_disclosures(F.col("disciplinary_disclosures"), F.col("disciplinary_disclosure_count")).cast("bigint").alias("disclosures"), v.rounded(F.coalesce("fee_aum_pct_low", F.lit(0.0)), 4).alias("fee"),
        v.date_or(F.col("last_updated"), F.col("next_review_by"), F.col("aum_as_of")).alias("dated"), tx.document_label(F.concat("slug", F.lit(".md"))).alias("document"),
    )


@query("select page_id, case when og = title and coalesce(h1, '') <> '' and h1 <> title then h1 else coalesce(nullif(og, ''), nullif(title, ''), h1) end resolved from (select page_id, meta.og_title og, title, headings[1].text h1 from page_capture)")
def resolved_titles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "page_capture").select("page_id", tx.resolved_title(F.col("meta")["og_title"], F.col("title"), F.try_element_at("headings", F.lit(1))["text"]).alias("resolved"))


@query("select facts_id, false matched, competitor queried_as, 'no hit' note from company_facts where not coalesce(auto_filled.sec_iapd.matched, false)")
def unmatched_markers(spark: SparkSession, d: str) -> DataFrame:
    """What stands for the registry's part of firms without a hit."""
    rows = table(spark, d, "company_facts").where(~F.coalesce(F.col("auto_filled.sec_iapd.matched"), F.lit(False)))
    return rows.select("facts_id", documents.unmatched(F.col("competitor"), "no hit").alias("m")).select("facts_id", "m.*")


@query("select firm_source_id, firm_name from iapd_hit")
def unwrapped_responses(spark: SparkSession, d: str) -> DataFrame:
    """Registry hits wrapped as search responses, and unwrapped again."""
    hits = table(spark, d, "iapd_hit")
    one = F.struct(F.struct("firm_source_id", "firm_name").alias("_source"))
    pages_ = hits.withColumn("page", F.pmod(F.xxhash64("firm_source_id", "captured"), F.lit(200))).groupBy("page").agg(F.to_json(F.struct(F.struct(F.collect_list(one).alias("hits")).alias("hits"))).alias("response"))
    return documents.responses_unwrapped(pages_.select("response"), "response", "struct<firm_source_id:string,firm_name:string>")


@query("select doc_id, replace(coalesce(text, ''), 'a', 'b') as text from documents where doc_id is not null and title is not null")
def replaced_blocks(spark: SparkSession, d: str) -> DataFrame:
    """A block between markers replaced in place: the text of each document, wrapped in markers, gets its letters a as b."""
    rows = table(spark, d, "documents").where("title is not null and doc_id is not null").select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    page = F.concat(F.lit("head <!-- a -->old<!-- z --> foot "), F.lit("x"))
    done = rows.select("doc_id", tx.between_markers(page, "<!-- a -->", "<!-- z -->", F.replace("t", F.lit("a"), F.lit("b"))).alias("p"))
    return done.select("doc_id", F.expr("substring(p, length('head <!-- a -->') + 2, length(p) - length('head <!-- a -->') - length('<!-- z --> foot x') - 2)").alias("text"))


@query("select record_id, json_extract_string(payload, '$.competitor') competitor from raw_record where json_valid(payload)")
def tolerant_payloads(spark: SparkSession, d: str) -> DataFrame:
    """One field of each payload that is valid JSON, null where it lacks."""
    rows = table(spark, d, "raw_record").select("record_id", nested.valid_json(F.col("payload")).alias("payload")).where("payload is not null")
    return rows.select("record_id", F.get_json_object("payload", "$.competitor").alias("competitor"))
