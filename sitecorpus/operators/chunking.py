"""Pre-processing and hierarchical chunking (full-document parents, token-window children).

All steps are JVM expressions (``regexp_replace``, ``split``, ``sequence``, ``slice``,
``explode``) and map-only: a long document only makes its own row explode into more pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sitecorpus.functions.text import SPACE_CHARS, is_blank, py_strip, sql_lit, sql_strip


def _cls(chars: str, negate: bool = False) -> str:
    return "[" + ("^" if negate else "") + "".join(f"\\x{{{ord(c):x}}}" for c in chars) + "]"


# Explicit classes valid in both Java and RE2.
ANY_SPACE = _cls(SPACE_CHARS)
NON_SPACE = _cls(SPACE_CHARS, negate=True)
OTHER_SPACE = _cls(SPACE_CHARS.replace("\n", ""))
URL_RX = r"https?://" + NON_SPACE + "+"
EMAIL_RX = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def preprocess(col, extra_spaces: bool = True, urls_emails: bool = False) -> Column:
    """``extra_spaces``: 3+ newlines → 2, runs of 2+ other white-space characters → one
    space. ``urls_emails``: remove http(s) URLs and e-mail addresses (off by default)."""
    t = _c(col)
    if urls_emails:
        t = F.regexp_replace(F.regexp_replace(t, URL_RX, ""), EMAIL_RX, "")
    if extra_spaces:
        t = F.regexp_replace(F.regexp_replace(t, r"\n{3,}", "\n\n"), OTHER_SPACE + "{2,}", " ")
    return t


def token_count(col) -> Column:
    """Tokens = maximal runs of non-space characters (counted by splitting the stripped
    text on space runs, which is much cheaper than materialising every match)."""
    stripped = py_strip(_c(col))
    return F.when(F.length(stripped) == 0, F.lit(0)).otherwise(
        F.size(F.split(stripped, ANY_SPACE + "+"))).cast("long")


def parents(df: DataFrame, text_col: str = "text", max_parent_tokens: int | None = None) -> DataFrame:
    """Full-document parents: ``parent_text`` and ``n_tokens``; with ``max_parent_tokens``
    each line of it is cut into windows the way :func:`children` cuts (no overlap), one parent
    each, numbered by ``seg_no`` and ``piece_no``."""
    if max_parent_tokens is not None:
        return children(df, text_col, sep="\n", max_tokens=max_parent_tokens, overlap=0).select(
            "doc_id", "seg_no", "piece_no", F.col("text").alias("parent_text"), "n_tokens")
    return df.select("*", F.col(text_col).alias("parent_text"),
                     token_count(F.col(text_col)).alias("n_tokens"))


def children(df: DataFrame, text_col: str = "text", sep: str = "\n", max_tokens: int = 512,
             overlap: int = 50, key: str = "doc_id") -> DataFrame:
    """Child chunks: split at ``sep``, drop blank segments; a segment longer than
    ``max_tokens`` becomes windows of ``max_tokens`` tokens stepping ``max_tokens - overlap``,
    up to the first window that reaches its end. Output ``key, seg_no, piece_no,
    token_start, n_tokens, text``."""
    if overlap >= max_tokens or overlap < 0 or max_tokens < 1:
        raise ValueError("need 0 <= overlap < max_tokens")
    step = max_tokens - overlap
    segs = df.select(key, F.posexplode(F.split(F.col(text_col), _sep_rx(sep))).alias("seg_no", "seg"))
    segs = segs.filter(~is_blank(F.col("seg")))
    toks = segs.select(key, (F.col("seg_no") + 1).cast("long").alias("seg_no"),
                       F.split(py_strip(F.col("seg")), ANY_SPACE + "+").alias("_t"))
    toks = toks.withColumn("_n", F.size("_t"))
    n_pieces = F.ceil(F.greatest(F.col("_n") - overlap, F.lit(1)) / F.lit(step)).cast("int")
    pieces = toks.select(key, "seg_no", "_t", "_n",
                         F.explode(F.sequence(F.lit(0), n_pieces - 1)).alias("_i"))
    start = F.col("_i") * step
    window = F.slice("_t", start + 1, F.lit(max_tokens))
    return pieces.select(key, "seg_no", (F.col("_i") + 1).cast("long").alias("piece_no"),
                         start.cast("long").alias("token_start"),
                         F.size(window).cast("long").alias("n_tokens"),
                         F.array_join(window, " ").alias("text"))


def _sep_rx(sep: str) -> str:
    import re
    return re.escape(sep).replace("\\\n", "\n")


# ---- SQL twins -------------------------------------------------------------------------------

def sql_preprocess(expr: str) -> str:
    t = f"regexp_replace({expr}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return f"regexp_replace({t}, {sql_lit(OTHER_SPACE + '{2,}')}, ' ', 'g')"


def sql_token_count(expr: str) -> str:
    return f"length(regexp_extract_all({expr}, {sql_lit(NON_SPACE + '+')}))"


def sql_children(table_sql: str, key: str, text: str, max_tokens: int = 512, overlap: int = 50) -> str:
    step = max_tokens - overlap
    return f"""
  WITH s AS (
    SELECT {key}, generate_subscripts(string_split({text}, chr(10)), 1) AS seg_no,
           unnest(string_split({text}, chr(10))) AS seg FROM ({table_sql}) src),
  t AS (
    SELECT {key}, seg_no, regexp_split_to_array({sql_strip('seg')}, {sql_lit(ANY_SPACE + '+')}) AS toks
    FROM s WHERE {sql_strip('seg')} <> ''),
  p AS (
    SELECT {key}, seg_no, toks,
           unnest(range(0, CAST(ceil(greatest(len(toks) - {overlap}, 1) / {step}) AS BIGINT))) AS i FROM t)
  SELECT {key}, seg_no, i + 1 AS piece_no, i * {step} AS token_start,
         len(list_slice(toks, i * {step} + 1, i * {step} + {max_tokens})) AS n_tokens,
         array_to_string(list_slice(toks, i * {step} + 1, i * {step} + {max_tokens}), ' ') AS text
  FROM p"""
