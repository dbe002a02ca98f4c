"""The corpus pipeline: quality rules, language ID, near-duplicate removal, substring dedup, packing.

Counted as part of the llm subpackage.  Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents.  run() writes each result as Parquet into the shared folder and reads it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import bpe, jaccard, langid, packing, quality, substring
from lexmill.llm.scratch import discard, materialise, scope, shielded

#: The share of held-out labelled rows in their own language that may fall below the limit of the language score.
CLEAN_SHARE = 0.005


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that pass the base rules and the model trained on labelled rows."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    carried, restore = shielded(docs, "doc_id", "text")
    return restore(quality.judge(carried, model, carry=True).filter("kept"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose text is in one of the learned languages, by a limit fixed on all held-out labelled rows.

    Where no document has a label there is nothing to judge by, and all stay.
    """
    model = langid.train(docs)
    if model is None:
        return docs
    least = langid.least_score(docs, model, share=CLEAN_SHARE)
    carried, restore = shielded(docs, "doc_id", "text")
    judged = langid.predict(carried, model, carry=True)
    return restore(judged.filter((F.col("lang_pred") != "und") & (F.col("score") >= least)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest doc_id of each group linked by 5-word shingles at a Jaccard similarity of 0.8 or more.

    Documents without words and those with a null doc_id stay; rows that repeat the doc_id that stays are one document.
    """
    groups = jaccard.near_duplicate_components(docs, size=5, threshold="4/5")
    gone = groups.filter((F.col("n_shingles") > 0) & (F.col("doc_id") != F.col("component_id"))).select("doc_id").distinct()
    return docs.join(gone.hint("shuffle_hash"), "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 50 words or more that also occur in a document with a smaller doc_id."""
    return substring.without_repeated_passages(docs, window=50)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the token pieces of all documents into sequences of 2048."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(spark, docs, lambda: bpe.encoder(path), capacity=2048, forget=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: Trained models and BPE can't be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with scope(spark):  # what the stage wrote for itself goes once its result is written
            made = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}", up=1)
        discard(docs)
        docs = made
    return docs
