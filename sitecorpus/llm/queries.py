"""The registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sitecorpus.llm import sql
from sitecorpus.plans.catalog import register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@register("op1_ngram_jaccard_join", sql.NGRAM_JACCARD)
def op1(spark, sf_dir):
    from sitecorpus.llm.ngram_jaccard import jaccard_classes
    classes = jaccard_classes(_table(spark, sf_dir, "documents"), n=3, threshold=0.9, count_links=True)
    return classes.select("doc_id", "n_shingles", "component_id", "n_links")


@register("op5_substring_dedup", sql.SUBSTRING_DEDUP)
def op5(spark, sf_dir):
    from sitecorpus.llm.substring_dedup import remove_repeats
    rest = remove_repeats(_table(spark, sf_dir, "documents"))
    return rest.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@register("op10_token_counts")
def op10(spark, sf_dir):
    import public_tokenizers
    from sitecorpus.llm.token_counts import count_tokens
    return count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@register("op3_toxicity")
def op3(spark, sf_dir):
    from sitecorpus.llm.folds import held_out
    from sitecorpus.llm.toxicity import fit_fold, score_toxicity
    docs = _table(spark, sf_dir, "documents")
    machine = fit_fold(docs, _table(spark, sf_dir, "labels"))
    return score_toxicity(docs.withColumn("held_out", held_out("doc_id")), machine, keep=["held_out"])


@register("op4_language_id")
def op4(spark, sf_dir):
    from sitecorpus.llm.folds import held_out
    from sitecorpus.llm.language_id import fit_fold, identify
    docs = _table(spark, sf_dir, "documents")
    found = identify(docs.withColumn("held_out", held_out("doc_id")), fit_fold(docs), keep=["held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").alias("n_spans"))


@register("op2_secret_scans", sql.SECRET_SCANS)
def op2(spark, sf_dir):
    from sitecorpus.llm.secret_scans import digest, find_secrets
    found, _ = find_secrets(_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
                        F.sha2(digest(F.col("spans")), 256).alias("base_sha256"), digest(F.col("spans")).alias("spans"))


@register("op6_document_fingerprints")
def op6(spark, sf_dir):
    from sitecorpus.llm.fingerprints import compare_with_edits
    return compare_with_edits(_table(spark, sf_dir, "documents"))


@register("op7_source_mixing", sql.SOURCE_MIXING)
def op7(spark, sf_dir):
    from sitecorpus.llm.source_mixing import mix
    return mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@register("op8_nearest_neighbours")
def op8(spark, sf_dir):
    from sitecorpus.llm.ann import nearest
    return nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@register("op9_sentencepiece_sampling")
def op9(spark, sf_dir):
    import public_tokenizers
    from sitecorpus.llm.piece_sampling import decode, encode
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))
    rows = encode(docs, path, keep=["sha"]).select("doc_id", "sha", F.posexplode("samples").alias("sample", "s"))
    return decode(rows.select("*", "s.*"), path, "ids", "decoded").select(
        "doc_id", "sample", F.size("ids").cast("long").alias("n_pieces"), "log_p", "perturbed", "inclusion",
        F.xxhash64("ids").alias("ids_hash"), (F.sha2("decoded", 256) == F.col("sha")).alias("round_trip"))


@register("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir).select(
        "doc_id", "source", F.size("samples").alias("n_samples"),
        F.aggregate("samples", F.lit(0).cast("long"), lambda n, s: n + F.size(s["ids"])).alias("n_pieces"))


@register("op11_best_fit_packing")
def op11(spark, sf_dir):
    import public_tokenizers
    from sitecorpus.llm.packing import pack
    from sitecorpus.llm.token_ids import token_pieces
    pieces = token_pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pack(pieces, 2048)


@register("op13_merkle_manifest", sql.MERKLE_MANIFEST)
def op13(spark, sf_dir):
    """Every fifth document's text is tampered with (A-Z lower-cased) before its proof is folded."""
    import string
    from sitecorpus.llm.merkle import folded, leaf, manifest, siblings
    docs = _table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    leaves = docs.select("source", "doc_id", leaf(*fields, F.col("text")).alias("leaf"),
                         F.when(tampered, leaf(*fields, lower)).alias("altered"))
    found = manifest(leaves, carry=["altered"])
    end = folded(F.coalesce("altered", "leaf"), F.col("proof"))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("proof")), 256).alias("proof_sha256"),
                        end.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def _with_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` as op12's contract wants them searched: where h = crc32 of doc_id leaves 0 modulo 10, the words
    from a = g % n on repeat the p words there (g = h div 10, p = 1 + (n - a) div (3 + g % 8))."""
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    h, n = F.col("h"), F.size(words)
    g = F.floor(h / 10)
    a = (g % n).cast("int")
    p = (F.floor((n - a) / (3 + g % 8)) + 1).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    text = F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a), again), F.lit(1), n), " ")
    return rows.select("doc_id", F.when((h % 10 == 0) & (n > 0), text).otherwise(F.col("text")).alias("text"))


@register("op12_periodic_runs")
def op12(spark, sf_dir):
    from sitecorpus.llm.periodic_runs import collapse_runs
    found = collapse_runs(_with_repeats(_table(spark, sf_dir, "documents")))
    less = lambda a, b: (F.when(a < b, -1).when(a > b, 1).otherwise(0))

    def order(a, b):  # greatest length / period first, then start, then period
        power = less(b["length"] * a["period"], a["length"] * b["period"])
        start = less(a["start"], b["start"])
        return F.when(power != 0, power).when(start != 0, start).otherwise(less(a["period"], b["period"]))
    best = F.get(F.array_sort("runs", order), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                        F.sha2(text, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
