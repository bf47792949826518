"""URL naming rules (authority, path, derived file name) as JVM expressions.

A generic URL splitter regex is used instead of ``parse_url`` because ``parse_url`` throws on
spaces and ``try_parse_url`` returns null there; this regex splits like Python's urlparse.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# scheme, authority, path (query and fragment excluded)
URL_RX = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)"

_H, _V4 = "[0-9A-Fa-f]{1,4}", r"(?:\d{1,3}\.){3}\d{1,3}"
# Eight groups, or fewer around one "::", the last two possibly as IPv4; or "v<hex>.<text>".
BRACKETED = (rf"^(?:(?:{_H}:){{6}}(?:{_H}:{_H}|{_V4})|(?=(?:[^:]*:){{2,7}}[^:]*$)(?!.*::.*::)(?!.*:::)"
             rf"(?:{_H}(?::{_H})*)?::(?:(?:{_H}:)*(?:{_H}|{_V4}))?)(?:%.+)?$|^v[0-9A-Fa-f]+\..+$")

# Schemes whose last path segment carries ";params" that urlparse splits off.
PARAM_SCHEMES = ["", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp",
                 "rtspu", "sip", "sips", "mms", "sftp", "tel"]


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _clean(u: Column) -> Column:
    """As Python's urlparse reads it: without leading control characters and spaces, and without
    tabs and line breaks anywhere."""
    return F.regexp_replace(F.regexp_replace(u, r"[\t\r\n]", ""), r"^[\x00-\x20]+", "")


def url_parts(col) -> tuple[Column, Column, Column]:
    u = _clean(_c(col))
    return (F.lower(F.regexp_extract(u, URL_RX, 1)), F.regexp_extract(u, URL_RX, 2),
            F.regexp_extract(u, URL_RX, 3))


def url_domain(col) -> Column:
    """Authority with every ``www.`` substring removed (port and userinfo kept)."""
    _, netloc, _ = url_parts(col)
    return F.replace(netloc, F.lit("www."), F.lit(""))


def url_path(col) -> Column:
    scheme, _, path = url_parts(col)
    no_params = F.regexp_replace(path, r";[^/]*$", "")
    return F.when(scheme.isin(PARAM_SCHEMES), no_params).otherwise(path)


def url_filename(col) -> Column:
    """``{domain}_{path}.md``: path without outer slashes, inner ``/`` → ``_``, empty → index."""
    p = F.replace(F.regexp_replace(url_path(col), r"^/+|/+$", ""), F.lit("/"), F.lit("_"))
    p = F.when(F.length(p) == 0, F.lit("index")).otherwise(p)
    return F.concat(url_domain(col), F.lit("_"), p, F.lit(".md"))


def url_error(col) -> Column:
    """``bad_url`` where urlparse raises: an unbalanced bracket in the authority, or brackets that
    hold no IPv6 address (or v-form address)."""
    _, netloc, _ = url_parts(col)
    lb, rb = netloc.contains("["), netloc.contains("]")
    inner = F.regexp_extract(netloc, r"\[([^\]]*)", 1)
    return F.when((lb != rb) | (lb & ~inner.rlike(BRACKETED)), F.lit("bad_url"))


# DuckDB twins for oracle SQL.
def sql_domain(expr: str) -> str:
    return f"replace(regexp_extract({expr}, '{URL_RX}', 2), 'www.', '')"


def sql_filename(expr: str) -> str:
    scheme = f"lower(regexp_extract({expr}, '{URL_RX}', 1))"
    path = f"regexp_extract({expr}, '{URL_RX}', 3)"
    schemes = ", ".join(f"'{s}'" for s in PARAM_SCHEMES)
    p = (f"(CASE WHEN {scheme} IN ({schemes}) THEN regexp_replace({path}, ';[^/]*$', '') "
         f"ELSE {path} END)")
    p = f"replace(regexp_replace({p}, '^/+|/+$', '', 'g'), '/', '_')"
    return f"({sql_domain(expr)} || '_' || (CASE WHEN {p} = '' THEN 'index' ELSE {p} END) || '.md')"
