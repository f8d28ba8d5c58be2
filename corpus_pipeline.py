"""The training-data pipeline: stages over ``documents``, each reading what its predecessor kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns the documents it keeps,
with the columns it was given.  The last one adds the token ids.  Empty tables give empty results, and
NULL or repeated ids are handled as each operator states.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelfold.llm import bpe, decontaminate, queries, repeats, simhash, toxicity
from panelfold.llm.common import importable, read, stage, temp_name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity of under 0.7, by models of the labelled ones among all documents."""
    importable(spark)
    score = temp_name(docs, "toxicity")
    models = queries.toxicity_models(spark, read(spark, sf_dir, "documents").select("doc_id", "text"), sf_dir)
    return toxicity.score_texts(docs, models, score=score).where(F.col(score) < 0.7).drop(score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked by SimHash: that of the smallest id, then the smallest hash of the text.

    Every row counts by itself: of rows with one id only near copies go, and a row with a NULL id is a copy
    like any other, kept only where no row of its group has an id.
    """
    importable(spark)
    row = temp_name(docs, "row")
    # Written once, so that the numbers hold however often the rows are read.
    docs = stage(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = simhash.near_duplicates(docs, key=row, shingle=4, bits=4, seed=42).select(F.col(row).alias("of"), "component_id")
    found = stage(found, "copies")
    several = found.groupBy("component_id").agg(F.count("*").alias("n")).where("n > 1").select("component_id")
    found = found.join(several, "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.xxhash64("text").alias("text"), F.col(row).alias("best"))
    named = docs.select(F.col(row).alias("of"), order.alias("order")).join(found, "of")
    best = named.groupBy("component_id").agg(F.min("order").alias("order")).select("component_id", "order.best")
    copy = temp_name(docs, "copy")
    others = found.join(best, "component_id").where("of <> best").select(F.col("of").alias(copy))
    return docs.join(others, F.col(row) == F.col(copy), "left_anti").drop(row)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 200 bytes that occur again; characters cut in two go whole."""
    importable(spark)
    kept, spans = temp_name(docs, "kept"), temp_name(docs, "spans")
    found = repeats.remove_repeats(docs, width=200, kept=kept, spans=spans, as_text=True).withColumn("text", F.col(kept))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(F.size(spans) == 0, F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return found.select(*[f"`{c}`" for c in docs.columns])


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Every row counts by itself, also one with a NULL id or one that shares its id; so does every item.
    """
    row = temp_name(docs, "row")
    # Written once, so that the numbers hold however often the rows are read.
    docs = stage(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    items = stage(read(spark, sf_dir, "benchmark").select(F.monotonically_increasing_id().alias("item_id"), "text"), "items")
    found = decontaminate.find_items(docs.select(row, "text"), items, key=row)
    leak = temp_name(docs, "leak")
    return docs.join(found.select(F.col(row).alias(leak)).distinct(), F.col(row) == F.col(leak), "left_anti").drop(row)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their packed token ids and how many they are."""
    importable(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.encode_documents(docs, path, public_tokenizers.PATTERN)
    return coded.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("suffix_dedup", drop_repeats),
    ("decontaminate", drop_leaks),
    ("byte_bpe", tokenize),
]

# The stages learn models, find fuzzy groups and merge token pairs, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
