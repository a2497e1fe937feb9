"""A corpus through five stages; each stage's documents are written as Parquet and read again by the next.

    from corpus_pipeline import run
    tokens = run(spark, "/data/corpus")        # folder with documents, labels and benchmark

Every stage works on all documents that its predecessor kept and returns the columns of its input (extra ones too); the
last returns tokens. Null and empty texts, repeated rows and rows without a doc_id pass as each operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, mil_quality, near_copies, substring_dedup
from tidemark.llm.common import cut, in_fold, release, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. It learns from the labels of four fifths of the documents."""
    learnt = ~in_fold(5, 0)
    model = mil_quality.learn(docs.where(learnt), table(spark, sf_dir, "labels").where(learnt))
    # other names in between: a column of the input may be called like one of the classifier's
    inner = {f"_c{i}": F.col(f"`{name}`") for i, name in enumerate(docs.columns)}
    return mil_quality.score(docs, model, inner).where("predicted = 1").select(
        *[F.col(f"_c{i}").alias(name) for i, name in enumerate(docs.columns)])


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of near duplicates: texts linked by a
    Jaccard similarity of 0.8 over five-word shingles. SimHash fingerprints with pigeonring come first, exact sets confirm
    their pairs, and a prefix filter finds the pairs that two bits miss."""
    return near_copies.one_of_each_group(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that start earlier in the corpus. A changed text is its kept words joined by one
    space, with n_chars counted anew; a document of which no word is left goes."""
    changed = substring_dedup.deduplicate(docs, with_text=True).where("n_removed > 0").select(
        F.col("doc_id").alias("_changed_id"), F.col("kept_text").alias("_kept_text")).dropDuplicates(["_changed_id"])
    joined = docs.join(changed, docs["doc_id"].cast("long") == changed["_changed_id"], "left").where(
        "_kept_text IS NULL OR _kept_text <> ''")
    new = {"text": F.coalesce("_kept_text", docs["text"])}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("_kept_text").isNull(), docs["n_chars"]).otherwise(
            F.length("_kept_text")).cast(docs.schema["n_chars"].dataType)
    return joined.select(*[new.get(name, docs[f"`{name}`"]).alias(name) for name in docs.columns])


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, edited copies included."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang and source with the ids of the text, their number and the digests of ids and decoded text."""
    keep = {"doc_id": F.col("doc_id").cast("long"), "lang": F.col("lang"), "source": F.col("source")}
    # fewer cached words than by itself: the workers of the other stages are the same
    return bpe.encode_digests(docs, keep=keep, with_ids=True, most_cached=100_000)


STAGES = [
    ("quality classifier", good_quality),
    ("near-dedup", one_per_group),
    ("substring dedup", without_repeats),
    ("benchmark decontamination", without_benchmark),
    ("BPE encoding and decoding", tokens),
]

#: SQL can't express the classifier: the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        before, docs = docs, cut(stage(spark, docs, sf_dir))
        release(before)
    return docs
