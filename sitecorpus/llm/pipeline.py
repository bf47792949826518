"""Five stages over ``documents``, each calling one operator on all that the one before kept.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of their input, so
columns that the stages do not know pass through, whatever their names. Stages need doc_id, text
and source; n_chars follows the text where a stage changes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sitecorpus.llm import ngram_jaccard, piece_sampling, secret_scans, source_mixing, toxicity
from sitecorpus.llm.stored import store
from sitecorpus.session import ensure_checkpoint_dir, ship_package


def _ready(spark: SparkSession) -> None:
    ship_package(spark)
    ensure_checkpoint_dir(spark)


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, text, source and the whole row, out of the way of the operators' own columns."""
    return docs.select("doc_id", "text", "source", F.struct("*").alias("whole"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine, fitted on the labelled training fold of ``docs``,
    scores below 0.5."""
    _ready(spark)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    score = toxicity.scorer(spark, toxicity.fit_fold(docs, labels))
    return docs.filter(score("text") < 0.5)


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8 or more): the one
    with the smallest doc_id, once. Documents without words are near nothing: all stay."""
    _ready(spark)
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = (ngram_jaccard.jaccard_classes(docs, n=5, threshold=0.8)
            .filter("kept AND n_shingles > 0").select("row_key"))
    rows = docs.filter(worded).select(F.struct("*").alias("whole"), F.xxhash64("doc_id", "text").alias("row_key"))
    first = Window.partitionBy("row_key").orderBy("row_key")
    ones = (rows.join(kept, "row_key", "left_semi").withColumn("n", F.row_number().over(first))
            .filter("n = 1").select("whole.*"))
    return ones.union(docs.filter(~worded))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret in the text replaced by a mark."""
    _ready(spark)
    found, _ = secret_scans.find_secrets(_packed(docs), keep=["text", "whole"])
    new = secret_scans.redact(F.col("text"), F.col("spans"))
    whole = found.select(F.col("whole").withField("text", new).alias("whole"), F.size("spans").alias("n"))
    out = whole.select("whole.*", F.col("n").alias("__secrets")) if "n_chars" in docs.columns else whole.select("whole.*")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__secrets") > 0, F.length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))).drop("__secrets")
    return out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    _ready(spark)
    mixed = source_mixing.mix(_packed(docs), keep=["whole"])
    return (mixed.filter("copies > 0")
            .select("whole", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy"))
            .select("whole.*"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source and the sampled segmentations of each document's whole text."""
    import public_tokenizers
    _ready(spark)
    return piece_sampling.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=["source"])


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", one_per_group),
    ("secret_scans", redact_secrets),
    ("source_mixing", mix_sources),
    ("sentencepiece_sampling", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents``; each stage's result is written and read back."""
    _ready(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
