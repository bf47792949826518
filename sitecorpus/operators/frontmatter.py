"""Markdown records with a YAML frontmatter block: quote, render, split, parse, lint.

Rendering and splitting are pure JVM expressions. Parsing has a JVM fast path for the fixed
layout :func:`render_pages` writes (``key: "value"`` lines whose values YAML reads back
unchanged); every other block goes to PyYAML in an Arrow-batched UDF that sees
the block, never the body.
"""

from __future__ import annotations

import datetime as _dt
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sitecorpus.functions.text import sql_lit

FENCE_RX = r"(?s)^---\n(.*?)\n---\n(.*)"

# Words YAML 1.1 reads as booleans or null when used as plain keys.
YAML_SPECIAL_WORDS = ["yes", "Yes", "YES", "no", "No", "NO", "true", "True", "TRUE", "false",
                      "False", "FALSE", "on", "On", "ON", "off", "Off", "OFF", "null",
                      "Null", "NULL"]
# A line of the fixed layout: plain key, one space, double-quoted value free of quotes,
# backslashes, control characters and the code points YAML rejects or folds.
FAST_LINE_RX = (r"^(?!(?:" + "|".join(YAML_SPECIAL_WORDS) + r"):)[A-Za-z_][A-Za-z0-9_]*: "
                r"\"[^\"\\\p{Cc}\x{2028}\x{2029}\x{feff}\x{fffe}\x{ffff}]*\"$")
FAST_KEY_RX = r"^([^:]*): \"(.*)\"$"

ENTRY_TYPE = T.ArrayType(T.StructType([T.StructField("key", T.StringType()),
                                       T.StructField("value", T.StringType())]))
PARSED_TYPE = T.StructType([
    T.StructField("entries", ENTRY_TYPE),
    T.StructField("kind", T.StringType()),
    T.StructField("error", T.StringType()),
])


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def yaml_quote(col) -> Column:
    """Escape ``"`` only; null or empty gives ``""``. Backslashes are left as they are."""
    return F.replace(F.coalesce(_c(col), F.lit("")), F.lit('"'), F.lit('\\"'))


def render_frontmatter(title, source_url, domain, crawl_date, description, language=None,
                       include_language: bool = True) -> Column:
    """Fixed-order block; ``language`` only when included and non-empty."""
    def line(k, v):
        return F.concat(F.lit(f'{k}: "'), yaml_quote(v), F.lit('"\n'))

    parts = [F.lit("---\n"), line("title", title), line("source_url", source_url),
             line("domain", domain),
             F.concat(F.lit('crawl_date: "'), _c(crawl_date).cast("string"), F.lit('"\n')),
             line("description", description)]
    if include_language and language is not None:
        lang = _c(language)
        parts.append(F.when(F.coalesce(F.length(lang), F.lit(0)) > 0, line("language", lang))
                     .otherwise(F.lit("")))
    parts.append(F.lit("---\n\n"))
    return F.concat(*parts)


def render_pages(df: DataFrame, include_language: bool = True, body_col: str = "markdown",
                 crawl_date_col: str = "crawl_date", out_col: str = "text") -> DataFrame:
    """Add the file text: frontmatter block, one blank line, then the body."""
    fm = render_frontmatter("title", "url_source", "domain", crawl_date_col, "description",
                            "language", include_language)
    return df.withColumn(out_col, F.concat(fm, F.coalesce(F.col(body_col), F.lit(""))))


def normalize_newlines(col) -> Column:
    """Text-mode reading: ``\\r\\n`` and lone ``\\r`` become ``\\n``."""
    return F.regexp_replace(_c(col), r"\r\n?", "\n")


def split_frontmatter(df: DataFrame, raw_col: str = "raw") -> DataFrame:
    """Add ``has_frontmatter``, ``fm_block`` (null when absent) and ``body``."""
    raw = F.col(raw_col)
    matched = raw.rlike(FENCE_RX)
    return df.select(
        "*", matched.alias("has_frontmatter"),
        F.when(matched, F.regexp_extract(raw, FENCE_RX, 1)).alias("fm_block"),
        F.when(matched, F.regexp_extract(raw, FENCE_RX, 2)).otherwise(raw).alias("body"),
    )


#: A block of ``name: "..."`` lines, whose values may run over several; and characters that the loaders differ on.
QUOTED_RX = re.compile(r'(?:[A-Za-z_]++: "(?:[^"\\]++|\\.)*+"(?:\n|\Z))++', re.S)
ODD_RX = re.compile("[\t\x85\u2028\u2029\ufeff]")


def _yaml_text(v):
    """Value as Python's ``str`` prints it; None stays None (a missing value)."""
    if v is None:
        return None
    if isinstance(v, (_dt.date, _dt.datetime)):
        return str(v)
    return str(v)


def _parse_block(block):
    import yaml
    if block is None:
        return {"entries": [], "kind": "none", "error": None}
    # The loader in C reads the written layout as the one in Python does; on anything else the two differ
    # here and there (tabs, comments after block marks), so that goes to the latter.
    quick = QUOTED_RX.fullmatch(block) is not None and not ODD_RX.search(block)
    try:
        data = yaml.load(block, Loader=getattr(yaml, "CSafeLoader", yaml.SafeLoader) if quick else yaml.SafeLoader)
    except Exception:
        return {"entries": None, "kind": None, "error": "invalid_yaml"}
    if data is None:
        return {"entries": None, "kind": "null", "error": None}
    if not isinstance(data, dict):
        return {"entries": None, "kind": "other", "error": "not_mapping"}
    return {"entries": [{"key": str(k), "value": _yaml_text(v)} for k, v in data.items()],
            "kind": "mapping", "error": None}


@F.pandas_udf(PARSED_TYPE)
def _parse_blocks(blocks: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_parse_block(b) for b in blocks], columns=["entries", "kind", "error"])


def _fast_entries(block: Column) -> Column:
    lines = F.split(block, "\n")
    return F.transform(lines, lambda l: F.struct(
        F.regexp_extract(l, FAST_KEY_RX, 1).alias("key"),
        F.regexp_extract(l, FAST_KEY_RX, 2).alias("value")))


def parse_frontmatter(df: DataFrame, block_col: str = "fm_block") -> DataFrame:
    """Add ``meta`` (``map<string,string>``, null values for YAML nulls), ``yaml_kind``
    (``none`` no block, ``mapping``, ``null`` empty block, ``other``) and ``fm_error``
    (``invalid_yaml``, ``not_mapping``)."""
    block = F.col(block_col)
    lines = F.split(block, "\n")
    keys = F.transform(lines, lambda l: F.regexp_extract(l, FAST_KEY_RX, 1))
    fast = (block.isNotNull() & F.forall(lines, lambda l: l.rlike(FAST_LINE_RX))
            & (F.size(F.array_distinct(keys)) == F.size(keys)))
    slow = _parse_blocks(F.when(~fast & block.isNotNull(), block))
    entries = (F.when(block.isNull(), F.array().cast(ENTRY_TYPE))
               .when(fast, _fast_entries(block)).otherwise(slow["entries"]))
    kind = (F.when(block.isNull(), F.lit("none")).when(fast, F.lit("mapping"))
            .otherwise(slow["kind"]))
    err = F.when(fast | block.isNull(), F.lit(None).cast("string")).otherwise(slow["error"])
    return df.select("*", F.map_from_entries(entries).alias("meta"), kind.alias("yaml_kind"),
                     err.alias("fm_error"))


def lint_frontmatter(df: DataFrame, fields=("title", "url_source", "domain", "description"),
                     names=("title", "source_url", "domain", "description"),
                     key: str = "doc_id") -> DataFrame:
    """Render → split → parse each record and report, one row per problem, the fields whose
    re-read value differs: ``key, field, written, reread`` (quotes are escaped but
    backslashes are not, so ``a\\d`` fails and ``a\\n`` turns into a newline).

    Problems are produced by exploding a per-record array, so a clean record yields no row
    without a Filter (which Catalyst would push below the parse and evaluate twice)."""
    rendered = df.select(key, *fields, render_frontmatter(
        *fields[:3], F.lit(0), fields[3], None, include_language=False).alias("_raw"))
    parsed = parse_frontmatter(split_frontmatter(rendered, "_raw"))
    checks = []
    for f, n in zip(fields, names):
        written = F.coalesce(F.col(f), F.lit(""))
        reread = F.try_element_at(F.col("meta"), F.lit(n))
        checks.append(F.when(F.col("fm_error").isNotNull() | ~written.eqNullSafe(reread),
                             F.struct(F.lit(n).alias("field"), written.alias("written"),
                                      reread.alias("reread"))))
    problems = F.filter(F.array(*checks), lambda x: x.isNotNull())
    return parsed.select(key, F.explode(problems).alias("p")).select(
        key, "p.field", "p.written", "p.reread")


# ---- SQL twins ---------------------------------------------------------------------------

def sql_yaml_quote(expr: str) -> str:
    return f"replace(coalesce({expr}, ''), '\"', '\\\"')"


def sql_render_frontmatter(title, source_url, domain, crawl_date, description,
                           language=None, include_language=True) -> str:
    def line(k, v):
        return f"'{k}: \"' || {sql_yaml_quote(v)} || '\"' || chr(10)"
    parts = ["'---' || chr(10)", line("title", title), line("source_url", source_url),
             line("domain", domain),
             f"'crawl_date: \"' || CAST({crawl_date} AS VARCHAR) || '\"' || chr(10)",
             line("description", description)]
    if include_language and language is not None:
        parts.append(f"(CASE WHEN length(coalesce({language}, '')) > 0 THEN {line('language', language)}"
                     f" ELSE '' END)")
    parts.append("'---' || chr(10) || chr(10)")
    return "(" + " || ".join(parts) + ")"


def sql_fence_block(expr: str) -> str:
    return f"regexp_extract({expr}, {sql_lit(FENCE_RX)}, 1)"
