"""Functions on web addresses. They take addresses as written; where a part is missing or malformed the result is null or empty, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions.text import folder_name, slug

# Patterns that tell kinds of addresses apart.
CONTENT_HINT = r"(?i)/(blog|post|posts|article|articles|insights?|news|press|resources?|episodes?|podcast|guides?|stories?|p)/"
INDEX_HINT = r"(?i)/(page/[0-9]+|category/|tag/|topic/|author/|archive)"
NOT_HTML = r"(?i)\.(jpg|jpeg|png|gif|svg|webp|pdf|mp4|webm|mp3|m4a|zip)(\?|$)"
# Addresses that sites of the trade usually have.
KNOWN_PATHS = (
    "/about", "/about-us", "/our-firm", "/who-we-are", "/our-story", "/team", "/our-team",
    "/services", "/our-services", "/what-we-do", "/how-we-help", "/approach", "/process",
    "/pricing", "/fees", "/our-fees",
    "/contact", "/contact-us", "/lets-chat", "/get-started", "/start", "/start-here", "/starthere", "/book-a-call",
    "/blog", "/insights", "/articles", "/news", "/press", "/resources",
    "/compliance", "/membership", "/pricing-plans",
)


def host(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:\s]+)", 1)), F.lit(""))


def origin(url: Column) -> Column:
    """Scheme and authority, in lower case."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^\s*([A-Za-z][A-Za-z0-9+.-]*://[^/?#\s]+)", 1)), F.lit(""))


def path(url: Column) -> Column:
    """The path of an address; / where it has none."""
    p = F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://[^/?#\s]+([^?#\s]*)", 1)
    return F.when(origin(url).isNull(), F.lit(None)).when(p == "", "/").otherwise(p)


def segments(url: Column) -> Column:
    return F.filter(F.split(path(url), "/"), lambda s: s != "")


def depth(url: Column) -> Column:
    return F.size(segments(url))


def canonical(url: Column) -> Column:
    """Without query, fragment and one trailing slash; as it is where it is no address."""
    bare = F.regexp_replace(F.trim(url), r"[?#].*", "")
    return F.when(origin(url).isNull(), url).otherwise(F.when(F.length(path(bare)) > 1, F.regexp_replace(bare, r"/\z", "")).otherwise(bare))


def last_segment(url: Column) -> Column:
    return F.coalesce(F.try_element_at(segments(url), F.lit(-1)), F.lit(""))


def segment_text(url: Column) -> Column:
    return F.regexp_replace(last_segment(url), "[-_]", " ")


def same_origin(url: Column, base: Column) -> Column:
    return F.coalesce(origin(url) == origin(base), F.lit(False))


def is_content(url: Column) -> Column:
    return F.coalesce(path(url).rlike(CONTENT_HINT), F.lit(False))


def is_index(url: Column) -> Column:
    return F.coalesce(path(url).rlike(INDEX_HINT), F.lit(False))


def is_file(url: Column) -> Column:
    return F.coalesce(path(url).rlike(NOT_HTML), F.lit(False))


def is_slug_like(url: Column) -> Column:
    last = last_segment(url)
    return (F.length(last) >= 20) & (F.length(last) - F.length(F.replace(last, F.lit("-"), F.lit(""))) >= 3) & ~is_index(url)


def dated(url: Column) -> Column:
    """The date in an address: /Y/M/D before /Y/M before Y-M-D; null if there is none."""
    group = lambda pattern, k: F.regexp_extract(url, pattern, k)
    day, month, plain = r"/([0-9]{4})/([0-9]{1,2})/([0-9]{1,2})(?:/|$)", r"/([0-9]{4})/([0-9]{1,2})(?:/|$)", r"\b([0-9]{4}-[0-9]{2}-[0-9]{2})\b"
    two = lambda c: F.lpad(c, 2, "0")
    return F.when(group(day, 1) != "", F.concat_ws("-", group(day, 1), two(group(day, 2)), two(group(day, 3)))).when(group(month, 1) != "", F.concat_ws("-", group(month, 1), two(group(month, 2)), F.lit("01"))).otherwise(F.nullif(group(plain, 1), F.lit("")))


def short_hash(url: Column) -> Column:
    return F.substring(F.sha1(url), 1, 6)


def post_file(date: Column, title: Column, url: Column) -> Column:
    """date_slug_hash.md"""
    return F.concat(F.concat_ws("_", date, slug(title, "untitled", drop_marks=False), short_hash(url)), F.lit(".md"))


def slug_of_site(url: Column) -> Column:
    """A folder name from the first label of a site's host."""
    return folder_name(F.substring_index(F.regexp_replace(host(url), r"^www\.", ""), ".", 1))


def absolute(base: str, relative: Column) -> Column:
    """A path below a base; as it is without a base."""
    root = base.rstrip("/")
    return F.concat(F.lit(root), relative) if root else relative


def search_address(base: str, name: Column) -> Column:
    """A search for the first four words of a name, percent-encoded."""
    words = F.array_join(F.slice(F.split(F.trim(name), r"\s+"), 1, 4), " ")
    return F.concat(F.lit(base), F.replace(F.url_encode(words), F.lit("+"), F.lit("%20")))
