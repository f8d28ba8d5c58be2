"""The registered queries of the numbered operators."""

from __future__ import annotations

import uuid
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelfold.llm import bpe, centroids, conversations, decontaminate, embeddings, lmscore, quality, repeats, simhash, tokencount, tokenfiles, toxicity, wrappers
from panelfold.llm.common import fold, importable, read, scratch_dir, stage, text_of
from panelfold.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

QUERIES: dict = {}


def _register(fn):
    @wraps(fn)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = query
    return query


@_register
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and their decoding, as digests."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.encode_documents(documents, path, public_tokenizers.PATTERN, decoded="decoded")
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def toxicity_models(spark: SparkSession, documents: DataFrame, sf_dir: str) -> toxicity.Models:
    """Models of the training folds of ``labels``."""
    training = toxicity.training_rows(documents, read(spark, sf_dir, "labels"), "toxic", fold("doc_id", 3) != 1)
    return toxicity.fit(training, "toxic")


@_register
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of toxicity of every document."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_texts(documents, toxicity_models(spark, documents, sf_dir), details=True)
    return scored.select(
        "doc_id",
        (fold("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "toxic_loglik",
        "ordinary_loglik",
    )


@_register
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under SimHash links of at most four bits."""
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=4, bits=4, seed=42)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@_register
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that documents hold, also with other numbers and names."""
    return decontaminate.find_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@_register
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without the strings of 200 bytes that occur again."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = repeats.remove_repeats(documents, width=200)
    n_bytes = F.octet_length(text_of("text")).cast("long")
    return found.select(
        "doc_id",
        n_bytes.alias("n_bytes"),
        (n_bytes - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@_register
def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return wrappers.extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@_register
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of good quality of every document."""
    documents = quality.measured(read(spark, sf_dir, "documents").select("doc_id", "text"))
    documents = stage(documents, "quality-measured")  # for the training and for the scores
    rows = documents.select(F.col("doc_id").alias("row"), "statistics")
    training = toxicity.labelled(rows, read(spark, sf_dir, "labels"), "quality", fold("doc_id", 4) != 2, of=F.min)
    scored = quality.score_texts(documents, quality.fit(training, "quality"), statistic="statistics")
    return scored.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@_register
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram tokens of every document."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = tokencount.read_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    return tokencount.count_tokens(documents, vocabulary).drop("text")


@_register
def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector at a cosine of 0.95."""
    return embeddings.near_duplicates(read(spark, sf_dir, "embeddings"), cosine=0.95)


@_register
def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much more likely every document is under the good documents' model than under that of all."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    good = read(spark, sf_dir, "labels").where("quality = 1")
    return lmscore.score_texts(documents, lmscore.fit(documents, good), keep_text=False)


@_register
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, read back from the token files."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    path = f"{scratch_dir(spark)}/token-files-{uuid.uuid4().hex}"
    written = tokenfiles.write_tokens(documents, path, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return written.checksums()


@_register
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest of eight centroids after ten rounds, and the clusters' inertia."""
    return centroids.cluster(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@_register
def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation, and its cheapest repair."""
    return conversations.repair_damaged(read(spark, sf_dir, "conversations"))
