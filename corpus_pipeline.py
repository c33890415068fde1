"""The corpus pipeline: documents in, token files out. Each stage is written as Parquet and read again.

Every stage works on all rows that the one before it kept, whatever columns are null; it returns the columns
of documents, but for the last, which returns a row for each document in the token files.
Rows with a null doc_id pass the near-duplicate stage, as they can't be named there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.llm import decontamination, jaccard_join, mixing, token_files, toxicity
from quadrille.llm.common import BROADCAST_LIMIT_BYTES, shared_folder, stored

TOXIC_FROM = 0.7


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that score under TOXIC_FROM."""
    return toxicity.score(docs, toxicity.train_on_table(spark, docs, sf_dir)).where(F.col("score") < TOXIC_FROM).select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the least id of each group that shingles of five words link at 0.8 or more.

    Of rows that share that id those of different texts all stay; of those of one text, that of the least other columns."""
    groups = jaccard_join.jaccard_components(docs.select("doc_id", "text"), 5, 80, links=False).where("doc_id is not null")
    ids = stored(groups.groupBy("doc_id").agg(F.count_if(F.col("doc_id") == F.col("component_id")).alias("n")), "kept-ids")
    named = docs.where("doc_id is not null")
    # texts stay where they are while the ids whose rows are not kept as they stand make a short list
    others, repeated = ids.where("n <> 1").select("doc_id"), ids.where("n > 1").select("doc_id")
    if others.count() * 32 <= BROADCAST_LIMIT_BYTES:
        one, again = named.join(F.broadcast(others), "doc_id", "left_anti"), named.join(F.broadcast(repeated), "doc_id", "left_semi")
    else:
        one, again = named.join(ids.where("n = 1").select("doc_id"), "doc_id", "left_semi"), named.join(repeated, "doc_id", "left_semi")
    # few ids repeat; only their rows are grouped
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    several = again.groupBy("doc_id", "text").agg(F.min(F.struct(*rest)).alias("r"))
    several = several.select("doc_id", "text", *[F.col(f"r.{c}").alias(c) for c in rest])
    return one.unionByName(several).unionByName(docs.where("doc_id is null")).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents of which less than a twentieth of the words is in windows of benchmark items, without their spans of over 50 such words."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.remove_spans(docs, items).withColumn("n_chars", F.length("text").cast("long"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents as often as their source's target takes them."""
    return mixing.mix_documents(docs).withColumn("n_chars", F.length("text").cast("long"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all rows, read back."""
    import public_tokenizers

    return token_files.token_output(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("near copies", one_of_near_copies),
    ("benchmark decontamination", decontaminate),
    ("mixing", mix),
    ("token output", tokens),
]

#: No SQL: scores of a trained model and a tokenizer's ids are not within SQL; tests compare with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_folder(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = f"{folder}/{i}"
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
