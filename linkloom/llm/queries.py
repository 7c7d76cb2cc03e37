"""The queries of the training-data operators: thin calls with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm import ann, bpe, chat, decontam, html, langid, lm, neardup, pii, toxicity
from linkloom.llm.common import bound_batches, fold_of, table


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op2_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counted = lm.count_words(docs)
    words = lm.vocabulary(counted)
    return lm.score(docs, words, lm.train(docs, words), counted)


def _bpe_tokens(text: str) -> int:
    import public_tokenizers

    return len(bpe.codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN).encode(text)) // 4


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.digest(chat.format_conversations(rows.unionByName(more), count=_bpe_tokens))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = fold_of(F.col("doc_id"))
    model = langid.fit(docs.where(fold != 2))
    return langid.predict(docs.select("doc_id", (fold == 2).alias("held_out"), "text"), model, ("doc_id", "held_out"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.digest(pii.find(docs, pii.fit(docs)))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_copies")


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(fold_of(F.col("doc_id")) != 2))
    out = toxicity.score(docs, model)
    return out.select("doc_id", (fold_of(F.col("doc_id")) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_lm": op2_lm,
    "op3_chat": op3_chat,
    "op4_langid": op4_langid,
    "op5_decontamination": op5_decontamination,
    "op6_pii": op6_pii,
    "op7_ann": op7_ann,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_html": op9_html,
    "op10_toxicity": op10_toxicity,
}



def _bounded(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return query(spark, sf_dir)

    return call


QUERIES = {name: _bounded(query) for name, query in QUERIES.items()}

#: Shingle sets, their sizes of intersection by a join on shingles, and the least id that links reach.
JACCARD = """WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\pL\\pN\\pM]+') AS w FROM documents),
 shingles AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i : i + 4], ' '))) AS s FROM words WHERE len(w) > 0),
 sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
 shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
 links AS MATERIALIZED (SELECT a, b, s.n = x.n AND x.n = y.n AS same FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE s.n * 1.8 >= 0.8 * (x.n + y.n) - 1e-9),
 reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
 SELECT d.doc_id, least(d.doc_id, coalesce(r.least, d.doc_id)) AS class_id, coalesce(n.links, 0) AS n_links, coalesce(n.copies, 0) AS n_copies FROM documents d
 LEFT JOIN (SELECT a, min(b) AS least FROM reach GROUP BY a) r ON r.a = d.doc_id LEFT JOIN (SELECT a, count(*) AS links, count(*) FILTER (WHERE same) AS copies FROM links GROUP BY a) n ON n.a = d.doc_id"""

ORACLE: dict[str, str] = {"op8_jaccard_join": JACCARD}
