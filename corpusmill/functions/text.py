"""Text functions: Column in, Column out, all inside code generation. A null text gives null unless said otherwise."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

DASH = "—"


def _chain(text: Column, *steps: tuple[str, str]) -> Column:
    return reduce(lambda t, s: F.regexp_replace(t, s[0], s[1]), steps, text)


def or_else(value: Column, *others: Column | str) -> Column:
    """The first value that is neither null nor empty."""
    values = [value, *(F.lit(o) if isinstance(o, str) else o for o in others)]
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values[:-1]], values[-1])


def slug(text: Column, default: str = "section", drop_marks: bool = True) -> Column:
    """Lower-case words joined by hyphens, at most 60 characters; `default` where nothing is left."""
    t = F.lower(text)
    if drop_marks:
        t = F.regexp_replace(t, "[`*_~>#]", "")
    t = _chain(t, ("[^a-z0-9]+", "-"), (r"^-+|-+\z", ""))
    return or_else(F.substring(t, 1, 60), default)


def folder_name(text: Column) -> Column:
    """Words with a capital each, joined by underscores."""
    words = F.filter(F.split(text, r"[\s\-_.]+"), lambda w: w != "")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1_000_000)))), "_")


def snippet(body: Column, most: int = 240) -> Column:
    """Markdown as plain text, cut at `most` characters with an ellipsis. The order of the steps matters."""
    t = _chain(
        body,
        (r"(?m)^#+\s+.*$", ""),
        (r"(?m)^>\s?", ""),
        (r"!\[[^\]]*\]\([^)]*\)", ""),
        (r"\[([^\]]*)\]\([^)]*\)", "$1"),
        (r"\]\([^)]*\)", ""),
        (r"[*_`#>|\[\]]", ""),
        (r"\s+", " "),
        (r"^[\s)\-–—:]+", ""),
    )
    t = F.trim(t)
    return F.when(F.length(t) > most, F.concat(F.rtrim(F.substring(t, 1, most)), F.lit("…"))).otherwise(t)


def count_words(text: Column) -> Column:
    """Runs of characters other than white space; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0))


def section_words(body: Column) -> Column:
    """Words of a section as shown: of its snippet without a limit."""
    t = snippet(body, 100_000)
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, r"\s+")))


def clean_title(title: Column) -> Column:
    """The part before the first spaced dash or bar, at most 200 characters; the whole where that part is empty."""
    head = F.trim(F.regexp_replace(title, r"(?s)\s+[—–|]\s+.*", ""))
    return F.substring(or_else(head, F.trim(title)), 1, 200)


def clean_author(author: Column) -> Column:
    """A name without 'by' and odd spaces; null unless it has 2 to 120 characters, at least half of them letters."""
    t = F.trim(_chain(F.trim(author), (r"(?i)^by\s+", ""), (r"\s+", " ")))
    letters = F.length(F.regexp_replace(t, "[^a-zA-Z]", ""))
    return F.when(F.length(t).between(2, 120) & (letters > 0) & (letters * 2 >= F.length(t)), t)


def short_name(name: Column) -> Column:
    """A firm's name without its common endings, taken off one after another."""
    return F.trim(_chain(name, (r"(?i), LLC\z", ""), (r"(?i), Inc\.?\z", ""), (r"(?i)\s+Wealth\s+Management\z", ""), (r"\s+\(.*\)\z", "")))


def legal_name(name: Column) -> Column:
    """A legal name in lower case without signs and legal forms."""
    return F.trim(_chain(F.lower(name), (r"[,.()]", ""), (r"\b(llc|inc|corp|company|co|ltd|lp|llp|plc)\b", ""), (r"\s+", " ")))


def query_words(name: Column) -> Column:
    """The words of a normalized name with more than two characters."""
    return F.filter(F.split(name, r"\s+"), lambda w: F.length(w) > 2)


def site_name(og_site: Column, title: Column) -> Column:
    """The declared name of a site, else the title before its first separator; null if both are empty."""
    return F.nullif(or_else(og_site, F.trim(F.regexp_replace(title, r"(?s)[|·\-–—].*", ""))), F.lit(""))


def clean_body(text: Column, most: int = 50_000) -> Column:
    """Captured text without trailing blanks in lines and long gaps, cut at `most` characters."""
    return F.substring(_chain(F.trim(text), (r"\s+\n", "\n"), (r"\n{3,}", "\n\n")), 1, most)


def csv_cell(value: Column) -> Column:
    """A value quoted only if it must be."""
    v = F.coalesce(value.cast("string"), F.lit(""))
    return F.when(v.rlike('[",\n]'), F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(v)


def html_escape(text: Column) -> Column:
    """The four signs that HTML reserves."""
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(sign), F.lit(name))
    return text


def document_label(file: Column) -> Column:
    return F.replace(F.regexp_replace(file, r"\.md\z", ""), F.lit("_"), F.lit(" "))


def plural(n: Column, one: str, many: str) -> Column:
    return F.concat(n.cast("string"), F.lit(" "), F.when(n == 1, one).otherwise(many))


def yes_no(flag: Column) -> Column:
    return F.when(flag, "yes").when(~flag, "no").otherwise(DASH)


def billions(value: Column) -> Column:
    """A sum as $x.xxB, a dash where it is null."""
    return F.when(value.isNull(), DASH).otherwise(F.format_string("$%.2fB", value / 1e9))


def facts_line(*parts: Column) -> Column:
    """The parts that are there, between middle dots."""
    return F.concat_ws(" · ", *parts)


def tag_list(tags: Column) -> Column:
    """Tags in back ticks between commas, a dash where there are none."""
    return or_else(F.array_join(F.transform(tags, lambda t: F.concat(F.lit("`"), t, F.lit("`"))), ", "), DASH)


def resolved_title(article: Column, document: Column, h1: Column) -> Column:
    """The article's title, unless that is only the document's title and the first heading says something else."""
    return F.when((article == document) & (F.coalesce(h1, F.lit("")) != "") & (h1 != document), h1).otherwise(or_else(article, document, h1))


def quoted(text: Column) -> Column:
    """A JSON string, or null as the word."""
    return F.coalesce(F.regexp_extract(F.to_json(F.struct(text.alias("v"))), r'(?s)^\{"v":(.*)\}\z', 1), F.lit(""))


def front_matter(fields: dict[str, Column], lists: dict[str, Column]) -> Column:
    """A header of `key: value` lines between rules; strings are quoted as JSON, null is the word null, lists are in brackets."""
    lines = [F.lit("---")]
    for k, v in fields.items():
        lines.append(F.concat(F.lit(f"{k}: "), F.when(v.isNull(), "null").otherwise(quoted(v))))
    for k, v in lists.items():
        lines.append(F.concat(F.lit(f"{k}: ["), F.coalesce(F.array_join(F.transform(v, quoted), ", "), F.lit("")), F.lit("]")))
    return F.concat_ws("\n", *lines, F.lit("---"))


def lexicon_hits(text: Column, phrases: list[str]) -> Column:
    """How often each phrase stands in a text: array of (phrase, n) with n above 0."""
    low = F.lower(text)
    counts = [F.struct(F.lit(p).alias("phrase"), ((F.length(low) - F.length(F.replace(low, F.lit(p), F.lit("")))) / len(p)).cast("int").alias("n")) for p in phrases]
    return F.filter(F.array(*counts), lambda c: c["n"] > 0)


def between_markers(text: Column, start: str, end: str, block: Column) -> Column:
    """text with what lies between two markers replaced; null if a marker is missing or they are in the wrong order."""
    a, b = F.instr(text, start), F.instr(text, end)
    return F.when((a > 0) & (b > a), F.concat(text.substr(F.lit(1), a + len(start) - 1), F.lit("\n"), block, F.lit("\n"), text.substr(b, F.length(text))))
