"""Knowledge-table upsert: importability, document names, field registry, metadata
assignment, existing-document lookup, create/replace/skip plan and the resulting state.

The remote calls of the original tool become tables: the listing and registry are read
from captured responses, and the plan says which documents to create, replace or skip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sitecorpus.functions.text import is_blank

# Metadata fields the importer needs, with their types.
REQUIRED_FIELDS = [("source_url", "string"), ("domain", "string"), ("crawl_date", "time"),
                   ("description", "string")]
LANGUAGE_FIELD = ("language", "string")
MAX_TITLE = 150
TITLE_KEEP = 147

LISTING_SCHEMA = "struct<data: array<struct<id: string, name: string>>, has_more: boolean>"
REGISTRY_SCHEMA = "struct<doc_metadata: array<struct<id: string, name: string, type: string>>>"


def read_document_listing(pages: DataFrame) -> DataFrame:
    """Paged listing responses ``page, status, body`` → ``page, pos, name, id``.

    Pages are read in order up to the first page whose ``has_more`` is false or missing
    (that page included) or whose status is not 200 (that page excluded). A page in range
    whose body cannot be read empties the whole listing, as the original loader discards
    its cache on an error. Rows need a non-empty name and id. The page table is small (one
    row per 100 documents, bodies parsed once), so the bound is one aggregate."""
    v = F.try_parse_json("body")
    readable = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    parsed = pages.select("*", F.from_json("body", LISTING_SCHEMA).alias("_j"), readable.alias("_ok"))
    ok = F.col("status") == 200
    # one-row aggregate: the last page to read (a scalar, collected)
    b = parsed.agg(
        F.min(F.when(~ok, F.col("page"))).alias("stop_excl"),
        F.min(F.when(ok & ~F.coalesce(F.col("_j.has_more"), F.lit(False)), F.col("page")))
        .alias("stop_incl")).first()
    last = min(x for x in ((b.stop_excl - 1) if b.stop_excl is not None else None,
                           b.stop_incl, 2 ** 62) if x is not None)
    in_range = parsed.filter(F.col("page") <= last)
    if in_range.filter(ok & ~F.col("_ok")).head(1):
        in_range = in_range.filter(F.lit(False))
    rows = in_range.select("page", F.posexplode("_j.data").alias("pos", "d"))
    return rows.select("page", (F.col("pos") + 1).cast("long").alias("pos"), F.col("d.name").alias("name"),
                       F.col("d.id").alias("id")).filter(
        (F.length("name") > 0) & (F.length("id") > 0))


def read_field_registry(responses: DataFrame) -> DataFrame:
    """Registry responses ``status, body`` (and ``page``, if there are several) → ``name, field_id,
    type``; a later entry with the same name, by page and place, replaces an earlier one; non-200
    responses give nothing."""
    page = F.col("page") if "page" in responses.columns else F.lit(0)
    entries = (responses.filter(F.col("status") == 200)
               .select(page.alias("page"), F.posexplode(F.from_json("body", REGISTRY_SCHEMA)["doc_metadata"])
                       .alias("pos", "f")))
    return entries.groupBy(F.col("f.name").alias("name")).agg(
        F.max_by(F.struct(F.col("f.id").alias("field_id"), F.col("f.type").alias("type")),
                 F.struct("page", "pos")).alias("v")).select("name", "v.field_id", "v.type")


def importable(docs: DataFrame, body_col: str = "body") -> DataFrame:
    """Add ``import_status``: null when the document can be imported, else ``unreadable``
    (bad bytes or YAML: read as an empty document), ``empty_frontmatter``,
    ``not_mapping``, ``blank`` (body only white space) or ``bad_title`` (a null title)."""
    null_title = (F.coalesce(F.map_contains_key("meta", F.lit("title")), F.lit(False))
                  & F.try_element_at("meta", F.lit("title")).isNull())
    status = (F.when(F.col("error").isNotNull() | (F.col("fm_error") == "invalid_yaml"),
                     F.lit("unreadable"))
              .when(F.col("yaml_kind") == "null", F.lit("empty_frontmatter"))
              .when(F.col("fm_error") == "not_mapping", F.lit("not_mapping"))
              .when(is_blank(F.col(body_col)), F.lit("blank"))
              .when(null_title, F.lit("bad_title")))
    return docs.withColumn("import_status", status)


def document_name(meta: Column, stem: Column) -> Column:
    """``{title} ({crawl_date})``; title from the frontmatter (else the stem), cut to 147
    characters plus ``...`` when longer than 150; a missing date prints as nothing, a null
    one as ``None``. A null title gives null (``bad_title``)."""
    has_title = F.coalesce(F.map_contains_key(meta, F.lit("title")), F.lit(False))
    title = F.when(has_title, F.try_element_at(meta, F.lit("title"))).otherwise(stem)
    title = F.when(F.length(title) > MAX_TITLE,
                   F.concat(F.left(title, F.lit(TITLE_KEEP)), F.lit("..."))).otherwise(title)
    has_date = F.coalesce(F.map_contains_key(meta, F.lit("crawl_date")), F.lit(False))
    date = F.when(has_date, F.coalesce(F.try_element_at(meta, F.lit("crawl_date")),
                                       F.lit("None"))).otherwise(F.lit(""))
    return F.concat(title, F.lit(" ("), date, F.lit(")"))


def field_id(name: Column) -> Column:
    return F.substring(F.sha2(F.concat(F.lit("field|"), name), 256), 1, 32)


def document_id(name: Column, filename: Column) -> Column:
    return F.substring(F.sha2(F.concat(F.lit("doc|"), name, F.lit("|"), filename), 256), 1, 32)


def reconcile_registry(existing: DataFrame, include_language: bool = True) -> DataFrame:
    """Registry after setup: every existing field (``action='existing'``) plus the required
    fields missing by name (``action='create'``, id derived from the name)."""
    spark = existing.sparkSession
    required = REQUIRED_FIELDS + ([LANGUAGE_FIELD] if include_language else [])
    req = spark.createDataFrame(required, "name string, type string")
    create = req.join(existing.select("name"), "name", "left_anti").select(
        "name", field_id(F.col("name")).alias("field_id"), "type", F.lit("create").alias("action"))
    keep = existing.select("name", "field_id", "type", F.lit("existing").alias("action"))
    return keep.unionByName(create)


def assign_metadata(docs: DataFrame, registry: DataFrame, doc_key: str = "filename") -> DataFrame:
    """One row per (document, registered frontmatter key): ``field_id, name, value, ord``
    in frontmatter order; values print as text, YAML null as ``None``."""
    entries = docs.select(doc_key, F.posexplode(F.map_entries("meta")).alias("ord", "e"))
    reg = registry.select("name", "field_id")
    return entries.join(reg, F.col("e.key") == reg["name"]).select(
        doc_key, "field_id", "name", F.coalesce(F.col("e.value"), F.lit("None")).alias("value"),
        (F.col("ord") + 1).alias("ord"))


def existing_documents(listing: DataFrame) -> DataFrame:
    """Name → id of the existing documents; for a repeated name the last listed wins."""
    return listing.groupBy("name").agg(
        F.max_by(F.col("id"), F.struct("page", "pos")).alias("id"))


def plan_upsert(docs: DataFrame, existing: DataFrame, skip_existing: bool = False,
                name_col: str = "doc_name") -> DataFrame:
    """Per importable document: ``action`` create / replace / skip, ``old_id`` and the
    ``new_id``. Lookups see only the listing taken before the import, so two incoming
    documents with the same new name are both created. A replacement gets an id of its own, made
    from the replaced one."""
    ex = existing.select(F.col("name").alias("_name"), F.col("id").alias("old_id"))
    joined = docs.join(ex, docs[name_col] == ex["_name"], "left").drop("_name")
    action = (F.when(F.col("old_id").isNull(), F.lit("create"))
              .when(F.lit(skip_existing), F.lit("skip")).otherwise(F.lit("replace")))
    new_id = F.when(action == "skip", F.col("old_id")).otherwise(document_id(
        F.col(name_col), F.concat_ws("|", "filename", "old_id")))
    return joined.withColumn("action", action).withColumn("new_id", new_id)


def apply_upsert(listing: DataFrame, plan: DataFrame, name_col: str = "doc_name") -> DataFrame:
    """Table state after the upsert: listed documents minus the replaced ids, plus the
    created ones. Older same-named rows that were not the last listed stay."""
    deleted = plan.filter(F.col("action") == "replace").select(F.col("old_id").alias("id")).distinct()
    kept = listing.select("name", "id").join(deleted, "id", "left_anti")
    created = plan.filter(F.col("action").isin("create", "replace")).select(
        F.col(name_col).alias("name"), F.col("new_id").alias("id"))
    return kept.unionByName(created)


def import_summary(plan: DataFrame) -> DataFrame:
    """``successful, failed`` counts (skips count as successes)."""
    ok = F.col("import_status").isNull() & F.col("action").isNotNull()
    return plan.agg(F.count(F.when(ok, 1)).alias("successful"),
                    F.count(F.when(~ok, 1)).alias("failed"))


def failed_imports(plan: DataFrame) -> DataFrame:
    return plan.filter(F.col("import_status").isNotNull() | F.col("action").isNull()).select(
        "path", "import_status")
