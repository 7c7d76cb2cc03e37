"""A training-data pipeline: each stage works on all that its predecessor kept.

run() applies the stages to documents one after the other, each written as Parquet
below the shared folder of spark.checkpoint.dir and read again; what a stage has read is removed when its own table is written.

Edge cases, of every stage: null and empty texts count as texts without words or letters (language_id drops them, the others keep them as
they are); texts of any length are read whole; null ids are kept and equal no other id; repeated rows are documents of
their own to all but near_duplicates, which keeps one of them; ties go to the least id; an empty table gives an empty one; all columns but the last stage's
are those of the documents, extra ones of any names included.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm import bpe, decontam, langid, neardup, pii
from linkloom.llm.common import bound_batches, fresh, named, remove, shared_folder, table

#: Least share of a text's n-grams that the profile of its best language must hold.
LEAST_SCORE = 0.25

#: SQL cannot express the first stage's learned model; tests/llm/test_pipeline.py checks each stage by brute force.
ORACLE_SQL: str | None = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows; null texts, texts without letters and those no language claims go."""
    bound_batches(spark)
    model = langid.fit(docs)
    names = tuple(docs.columns)
    lang, score = fresh("predicted", names), fresh("predicted_score", names)
    marked = langid.predict(docs, model, names, (lang, score))
    return marked.where((F.col(lang) != "und") & (F.col(score) >= LEAST_SCORE)).select(*named(names))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 of five-word shingles: the one of least id.

    Texts without words and rows with a null id stay.
    """
    bound_batches(spark)
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null and empty texts hold none."""
    bound_batches(spark)
    return decontam.drop(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked in text, n_chars as it is then (null for null texts)."""
    bound_batches(spark)
    out = pii.redact(docs, pii.fit(docs))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*named(docs.columns))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the token ids of every document; none for null and empty texts."""
    bound_batches(spark)
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = bpe.encode(docs, path, public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{top}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
