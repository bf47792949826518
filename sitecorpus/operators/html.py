"""Page metadata from raw HTML (title, description, language), JVM-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sitecorpus.functions.text import (
    collapse_spaces, py_strip, sql_collapse_spaces, sql_lit, sql_strip,
)

TITLE_RX = r"(?is)<title[^>]*>(.*?)</title>"
# A meta tag as a whole: quoted values may hold ">" or the other quote. Possessive runs keep the matcher
# from recursing once a character and from going back over a tag that is never closed; a second
# "<meta" outside quotes ends the attempt, so open tags are not scanned to the end of the page each.
META_RX = r"""(?is)<meta\b(?:[^<>"']++|<(?!meta\b)|"[^"]*+"|'[^']*+')*+>"""
# One step through a tag: a stray quoted string, or a name (group 1) and perhaps its value in double
# quotes (2), single quotes (3) or none (4).
ATTRIBUTE_RX = r"""(?is)"[^"]*+"|'[^']*+'|([^\s"'>=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?+"""
# The same rules for a matcher that runs in linear time (no possessive runs, no look-ahead).
SQL_META_RX = r"""(?is)<meta\b(?:[^>"']|"[^"]*"|'[^']*')*>"""


def _attribute(tag: Column, name: str) -> Column:
    """The value of the tag's first attribute of that name; null without one."""
    names, *values = [F.regexp_extract_all(tag, F.lit(ATTRIBUTE_RX), F.lit(i)) for i in (1, 2, 3, 4)]
    at = F.array_position(F.transform(names, F.lower), F.lit(name)).cast("int")
    return F.when(at > 0, F.concat(*[F.get(v, at - 1) for v in values]))


LANG_RX = r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?([^\"'\s>]+)"

# The five XML entities, decoded natively (&amp; last).
XML_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                ("&apos;", "'"), ("&amp;", "&")]


def decode_entities(col: Column) -> Column:
    """HTML entity decoding (named HTML 4 entities and numeric references) on the JVM via
    commons-text, which ships with Spark; no Python round trip."""
    # &apos; is an XML entity, not one of HTML 4: it is spelled as a number first
    return F.call_function("java_method", F.lit("org.apache.commons.text.StringEscapeUtils"),
                           F.lit("unescapeHtml4"), F.replace(col, F.lit("&apos;"), F.lit("&#39;")))


def description(html: Column) -> Column:
    """Content of the first meta tag named ``description``: attributes in any order, in double,
    single or no quotes; "" without one."""
    tags = F.filter(F.regexp_extract_all(html, F.lit(META_RX), F.lit(0)),
                    lambda t: F.lower(_attribute(t, "name")) == "description")
    return F.coalesce(_attribute(F.get(tags, F.lit(0)), "content"), F.lit(""))


def extract_page_metadata(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Add ``title``, ``description``, ``language`` (``""`` when absent) from the HTML."""
    h = F.col(html_col)

    def field(raw):
        return collapse_spaces(decode_entities(raw))

    return pages.select(
        "*",
        field(F.regexp_extract(h, TITLE_RX, 1)).alias("title"),
        field(description(h)).alias("description"),
        F.regexp_extract(h, LANG_RX, 1).alias("language"),
    )


def sql_title(html_expr: str = "html") -> str:
    """DuckDB twin of the title rule."""
    raw = f"regexp_extract({html_expr}, {sql_lit(TITLE_RX)}, 1)"
    for ent, ch in XML_ENTITIES:
        raw = f"replace({raw}, {sql_lit(ent)}, {sql_lit(ch)})"
    return sql_collapse_spaces(raw)


def sql_description(html_expr: str = "html") -> str:
    """DuckDB twin of the description rule, one look for each attribute."""
    def attribute(tag, name):
        rx = (r"""(?is)^(?:[^"'=]|=\s*"[^"]*"|=\s*'[^']*'|=\s*[^\s"'>]+)*?\s%s\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""" % name)
        return " || ".join(f"regexp_extract({tag}, {sql_lit(rx)}, {i})" for i in (1, 2, 3))
    tags = f"list_filter(regexp_extract_all({html_expr}, {sql_lit(SQL_META_RX)}), lambda t: lower({attribute('t', 'name')}) = 'description')"
    raw = f"coalesce({attribute(f'({tags})[1]', 'content')}, '')"
    for ent, ch in XML_ENTITIES:
        raw = f"replace({raw}, {sql_lit(ent)}, {sql_lit(ch)})"
    return sql_collapse_spaces(raw)


def sql_language(html_expr: str = "html") -> str:
    return f"regexp_extract({html_expr}, {sql_lit(LANG_RX)}, 1)"


# ---- plain-text body (the reader's "text" response mode), JVM-side ----------------------

def _cls(chars: str) -> str:
    return "[" + "".join(f"\\x{{{ord(c):x}}}" for c in chars) + "]"


# White space other than the newline, as an explicit class valid in Java and RE2.
HSPACE = _cls("".join(c for c in map(chr, range(0x110000)) if c.isspace() and c != "\n"))

BLOCK_TAGS = ("br|p|div|li|h[1-6]|tr|td|th|ul|ol|article|section|footer|nav|header|main|"
              "aside|hr|blockquote|pre|table|dl|dt|dd|figure|figcaption|form")

# The entities the SQL oracles decode (the pages use no others).
SQL_ENTITIES = [("&nbsp;", "\u00a0"), ("&copy;", "\u00a9"), ("&middot;", "\u00b7")]

# (pattern, replacement) steps shared by the Spark expression and its SQL twin.
TEXT_STEPS = [
    (r"(?is)^.*?<body\b[^>]*>|</body>.*$", ""),
    (r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<noscript\b.*?</noscript>|"
     r"<template\b.*?</template>|<head\b.*?</head>", " "),
    (r"(?i)</?(?:" + BLOCK_TAGS + r")\b[^>]*>", "\n"),
    (r"<[^>]*>", ""),
]
TEXT_TIDY = [(HSPACE + "+", " "), (r" ?\n ?", "\n"), (r"\n{3,}", "\n\n")]


def _strip_tags(col: Column) -> Column:
    t = col
    for rx, rep in TEXT_STEPS:
        t = F.regexp_replace(t, rx, rep)
    return t


def _decode_tidy(stripped: Column) -> Column:
    t = decode_entities(stripped)
    for rx, rep in TEXT_TIDY:
        t = F.regexp_replace(t, rx, rep)
    return py_strip(t)


def html_text(col: Column) -> Column:
    """Visible text of a page: head, scripts, styles and comments dropped, block tags become
    line breaks, other tags removed, entities decoded, spaces collapsed, blank-line runs
    reduced to one empty line. JVM only."""
    return _decode_tidy(_strip_tags(col))


def with_html_text(df: DataFrame, html_col: str = "html", out_col: str = "markdown") -> DataFrame:
    """Add :func:`html_text` of ``html_col`` as ``out_col``."""
    return df.withColumn(out_col, html_text(F.col(html_col)))


def sql_html_text(expr: str = "html") -> str:
    t = expr
    for rx, rep in TEXT_STEPS:
        t = f"regexp_replace({t}, {sql_lit(rx)}, {sql_lit(rep)}, 'g')"
    for ent, ch in SQL_ENTITIES + XML_ENTITIES:
        t = f"replace({t}, {sql_lit(ent)}, {sql_lit(ch)})"
    for rx, rep in TEXT_TIDY:
        t = f"regexp_replace({t}, {sql_lit(rx)}, {sql_lit(rep)}, 'g')"
    return sql_strip(t)
