"""Reader responses: field extraction, attempt resolution (retries and cached-snapshot
refetch) and the labelled text envelope."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sitecorpus.functions.text import py_strip

# Labels of the text envelope, in the order they are written.
TITLE_LABEL = "Title: "
URL_LABEL = "URL Source: "
DESCRIPTION_LABEL = "Description: "
LANGUAGE_LABEL = "Language: "
BODY_LABEL = "Markdown Content:"
CACHED_MARK = "cached snapshot"
RETRYABLE_ERRORS = ["timeout", "connection"]


def _field(v: Column, path: str, default: Column) -> Column:
    """Missing → ``default``; JSON null → ``'None'`` (as the f-string prints it)."""
    sub = F.variant_get(v, path, "variant")
    return (F.when(sub.isNull(), default)
            .when(F.is_variant_null(sub), F.lit("None"))
            .otherwise(F.variant_get(v, path, "string")))


def _is_object(v: Column, path: str | None = None) -> Column:
    t = F.schema_of_variant(v if path is None else F.variant_get(v, path, "variant"))
    return t.startswith("OBJECT")


def _present(v: Column, path: str) -> Column:
    return F.variant_get(v, path, "variant").isNotNull()


@F.pandas_udf(T.BooleanType())
def _python_json_ok(bodies: pd.Series) -> pd.Series:
    def ok(b):
        if b is None:
            return False
        try:
            json.loads(b)
            return True
        except ValueError:
            return False
    return bodies.map(ok)


def parse_responses(df: DataFrame, include_language: bool = True, body_col: str = "body",
                    url_col: str = "url", strict: bool = False) -> DataFrame:
    """Add ``title, content, url_source, description, language, error``.

    Missing keys take defaults (``url_source`` defaults to the requested URL); explicit
    nulls print as ``None``. ``error``: ``invalid_json``, or ``bad_shape`` when the body,
    ``data``, ``warning`` or (with language) ``metadata`` has a type the original tool
    could not read.

    Spark's JSON parser differs from Python's on a few inputs: it rejects repeated keys and
    ``NaN`` and accepts text after the object. ``strict=True`` additionally requires that
    Python's parser accepts the body (an Arrow-batched check that sees only the body)."""
    parsed = df.withColumn("_v", F.try_parse_json(F.col(body_col)))
    if strict:
        parsed = parsed.withColumn("_v", F.when(_python_json_ok(F.col(body_col)), F.col("_v")))
    v = F.col("_v")
    data_ok = ~_present(v, "$.data") | _is_object(v, "$.data")
    warn = F.variant_get(v, "$.warning", "variant")
    warn_ok = warn.isNull() | F.schema_of_variant(warn).startswith("STRING")
    shape_ok = _is_object(v) & data_ok & warn_ok
    if include_language:
        shape_ok = shape_ok & (~_present(v, "$.data.metadata") | _is_object(v, "$.data.metadata"))
        lang = _field(v, "$.data.metadata.lang", F.lit(""))
    else:
        lang = F.lit("")
    err = F.when(v.isNull(), F.lit("invalid_json")).when(~shape_ok, F.lit("bad_shape"))
    checked = parsed.withColumn("error", err)
    ok = F.col("error").isNull()
    return checked.select(
        *[c for c in df.columns if c != "error"],
        F.when(ok, _field(v, "$.data.title", F.lit(""))).alias("title"),
        F.when(ok, _field(v, "$.data.content", F.lit(""))).alias("content"),
        F.when(ok, _field(v, "$.data.url", F.col(url_col))).alias("url_source"),
        F.when(ok, _field(v, "$.data.description", F.lit(""))).alias("description"),
        F.when(ok, lang).alias("language"),
        "error",
    )


def response_flags(v: Column) -> tuple[Column, Column]:
    """(valid JSON, carries a cached-snapshot warning) for a parsed body (variant)."""
    warning = F.lower(F.coalesce(F.variant_get(v, "$.warning", "string"), F.lit("")))
    return v.isNotNull(), warning.contains(CACHED_MARK)


def number_attempts(attempts: DataFrame, limit: int, order: tuple = ("started_at",)) -> DataFrame:
    """Add ``seq`` (1-based per URL and kind, in ``order``) keeping only the first ``limit``
    attempts of each. The ``row_number() <= limit`` filter is planned as a partial
    WindowGroupLimit before the shuffle, so a URL with very many attempts never lands
    whole on one task."""
    from pyspark.sql import Window
    w = Window.partitionBy("url", "kind").orderBy(*order)
    ranked = attempts.withColumn("seq", F.row_number().over(w))
    return ranked.filter(F.col("seq") <= max(limit, 1)).withColumn("seq", F.col("seq").cast("int"))


def resolve_attempts(attempts: DataFrame, max_retries: int = 2,
                     accept_cached: bool = False, with_body: bool = True,
                     order: tuple | None = None) -> DataFrame:
    """One outcome per URL: ``url, ok, reason, n_attempts, decided_seq, from_refetch``
    (+ ``body`` of the deciding response).

    Attempts carry ``seq`` (1-based number within ``kind``; or pass ``order`` to number
    them here, see :func:`number_attempts`), ``kind`` (``fetch`` or
    ``refetch``), ``status`` (null without a response) and ``error`` (``timeout``,
    ``connection`` or another error name). The first ``max_retries + 1`` fetches are read in
    order; a status >= 400, timeout or connection error is retried; the first other
    attempt decides. A cached-snapshot warning on the decider (unless ``accept_cached``)
    hands the decision to the single refetch.

    A URL without a usable fetch (refetches only, or every ``seq`` beyond the limit) fails with
    ``no_attempts``.

    Bodies are reduced to two flags before anything is shuffled: numbering and the group-by on
    ``url`` move narrow rows, and only the deciding body is joined back, on (url, kind) and the
    numbering columns (``order`` must tell a URL's attempts of one kind apart).
    """
    limit = max_retries + 1
    place = list(order) if order is not None else ["seq"]
    narrow = narrow_attempts(attempts, place)
    if order is not None:
        narrow = number_attempts(narrow, limit, order)
    out = settle(narrow, max_retries, accept_cached, place)
    if not with_body:
        return out.drop("_place")
    bodies = attempts.select(F.col("url").alias("_b_url"), F.col("kind").alias("_b_kind"),
                             F.struct(*place).alias("_b_place"), F.col("body"))
    keyed = out.withColumn("_kind", F.when(F.col("from_refetch"), F.lit("refetch"))
                           .otherwise(F.lit("fetch")))
    joined = keyed.join(bodies, (F.col("url") == F.col("_b_url")) & (F.col("_kind") == F.col("_b_kind"))
                        & (F.col("_place") == F.col("_b_place")) & F.col("ok"), "left")
    return joined.select("url", "ok", "reason", "n_attempts", "decided_seq", "from_refetch", "body")


def narrow_attempts(attempts: DataFrame, place: list[str]) -> DataFrame:
    """Attempts with two flags in place of their bodies, and whether each is tried again."""
    valid, cached = response_flags(F.col("_v"))
    retryable = (F.coalesce(F.col("status") >= 400, F.lit(False))
                 | F.coalesce(F.col("error").isin(RETRYABLE_ERRORS), F.lit(False)))
    return attempts.withColumn("_v", F.try_parse_json(F.col("body"))).select(
        "url", "kind", *place, "status", "error", valid.alias("valid"), cached.alias("cached"),
        retryable.alias("retryable"))


def settle(narrow: DataFrame, max_retries: int, accept_cached: bool, place: list[str]) -> DataFrame:
    """The outcome of each URL from its numbered narrow attempts, and the ``_place`` of the one that decides."""
    limit = max_retries + 1
    narrow = narrow.withColumn("place", F.struct(*place))
    fetch = (F.col("kind") == "fetch") & (F.col("seq") <= limit)
    info = F.struct("seq", "status", "error", "valid", "cached", "place")
    agg = narrow.groupBy("url").agg(
        F.min(F.when(fetch & ~F.col("retryable"), info)).alias("dec"),
        F.max(F.when(fetch, info)).alias("last"),
        F.count(F.when(fetch, 1)).alias("n_fetch"),
        F.min(F.when(F.col("kind") == "refetch", info)).alias("ref"),
    )
    dec, last, ref = F.col("dec"), F.col("last"), F.col("ref")
    last_reason = F.when(last["status"] >= 400, F.lit("http_error")).otherwise(last["error"])
    needs_refetch = dec["cached"] & F.lit(not accept_cached)
    ref_reason = (F.when(ref.isNull(), F.lit("no_refetch"))
                  .when(ref["error"].isNotNull(), F.lit("refetch_error"))
                  .when(ref["status"] >= 400, F.lit("refetch_http_error"))
                  .when(~ref["valid"], F.lit("invalid_json"))
                  .when(ref["cached"], F.lit("still_cached")))
    reason = (F.when(F.lit(limit < 1), F.lit("no_attempts"))
              .when(dec.isNull(), F.coalesce(last_reason, F.lit("no_attempts")))
              .when(dec["error"].isNotNull(), F.lit("unhandled"))
              .when(~dec["valid"], F.lit("invalid_json"))
              .when(needs_refetch, ref_reason))
    n_att = (F.when(F.lit(limit < 1), F.lit(0)).when(dec.isNull(), F.col("n_fetch"))
             .otherwise(dec["seq"]))
    from_ref = F.coalesce(dec.isNotNull() & dec["valid"] & dec["error"].isNull()
                          & needs_refetch, F.lit(False))
    return agg.select(
        "url", reason.isNull().alias("ok"), reason.alias("reason"),
        n_att.cast("int").alias("n_attempts"),
        F.when(from_ref, ref["seq"]).otherwise(dec["seq"]).alias("decided_seq"),
        from_ref.alias("from_refetch"),
        F.when(from_ref, ref["place"]).otherwise(dec["place"]).alias("_place"))


def format_envelope(df: DataFrame, out_col: str = "envelope") -> DataFrame:
    """The labelled text block: title, URL, description, language, then the body."""
    def s(c):
        return F.coalesce(F.col(c), F.lit("None"))
    return df.withColumn(out_col, F.concat(
        F.lit(TITLE_LABEL), s("title"), F.lit("\n\n" + URL_LABEL), s("url_source"),
        F.lit("\n\n" + DESCRIPTION_LABEL), s("description"), F.lit("\n\n" + LANGUAGE_LABEL),
        s("language"), F.lit("\n\n" + BODY_LABEL + "\n"), s("content")))


def parse_envelope(df: DataFrame, col: str = "envelope") -> DataFrame:
    """Read the envelope back line by line (header lines up to the first body-label line).

    Per label the last line starting with it wins; every occurrence of the label text in
    that line is removed, then stripped. Only one line per field survives. The body is the
    rest after the body label, stripped (``""`` without a body label). An empty envelope
    gives no record."""
    # An empty envelope yields no record. The rows are dropped by a generator rather than a
    # Filter: Catalyst pushes a Filter below the projections that build the envelope and
    # substitutes the whole building expression into it, evaluating it twice.
    keep = F.when(F.coalesce(F.length(F.col(col)), F.lit(0)) > 0, F.array(F.lit(True)))
    base = df.select("*", F.explode(keep).alias("_keep")).drop("_keep")
    staged = base.withColumn("_lines", F.split(F.col(col), "\n")).withColumn(
        "_pos", F.array_position(F.transform("_lines", lambda l: l.startswith(BODY_LABEL)), True))
    lines, pos = F.col("_lines"), F.col("_pos")
    staged = staged.withColumn("_header", F.when(
        pos > 0, F.slice(lines, 1, F.greatest(pos - 1, F.lit(0)))).otherwise(lines))

    def last(label):
        hit = F.try_element_at(F.filter("_header", lambda l: l.startswith(label)), F.lit(-1))
        return F.coalesce(py_strip(F.replace(hit, F.lit(label), F.lit(""))), F.lit(""))

    body = F.when(pos > 0, py_strip(F.array_join(
        F.slice(lines, pos + 1, F.greatest(F.size(lines) - pos, F.lit(0))), "\n"))).otherwise(F.lit(""))
    return staged.select(
        *df.columns, last(TITLE_LABEL).alias("env_title"), last(URL_LABEL).alias("env_url_source"),
        last(DESCRIPTION_LABEL).alias("env_description"),
        last(LANGUAGE_LABEL).alias("env_language"), body.alias("env_markdown"))
