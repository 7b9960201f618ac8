"""Documents to packed training sequences: toxicity, quality rules, near duplicates, best-fit packing.

Each stage works on what its predecessor kept. All but the last return the columns of ``documents``; the last returns the
pieces of documents with their sequences. A document without an id is judged by its text like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scenequarry.llm import decision_lists as D
from scenequarry.llm import deobfuscation as X
from scenequarry.llm import near_frames as H
from scenequarry.llm import near_texts as N
from scenequarry.llm import queries as Q
from scenequarry.llm.components import connected
from scenequarry.session import cut


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text scores below 0.5."""
    model = Q.toxicity_model(spark, docs, sf_dir)
    return X.score_notes(docs, model, "text", "_toxicity").filter("_toxicity < 0.5").drop("_toxicity")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and that no learnt rule rejects."""
    columns = docs.columns
    labels = F.broadcast(Q.drawn_verdicts(spark, sf_dir))
    labelled = docs.join(labels, docs["doc_id"] == labels["frame_id"]).select(labels["accepted"], docs["text"])
    rules = D.fit_decision_list(cut(D.caption_metrics(labelled, "text").drop("text")), D.caption_ratios())
    kept = D.caption_metrics(docs.select(F.struct("*").alias("_row"), F.col("text").alias("_text")), "_text")
    return kept.filter(~Q.base_failed() & rules.verdict(D.caption_ratios())).select(*[F.col("_row").getField(c).alias(c) for c in columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id, of equal ids or none at all any one row.

    Near copies are documents whose fingerprints (five-word shingles) differ in 4 bits at most, found by the trees of
    ``near_frames``, and those beyond that reach with a Jaccard similarity of 0.8 of these shingles on. Groups follow chains of both.
    """
    columns = docs.columns
    rows = cut(docs.withColumn("_row", F.monotonically_increasing_id()))
    texts = rows.select(F.col("_row").alias("row"), "text")
    coded = H.near_frames(H.caption_phash(texts, "text", words=5).drop("text"), "row", out="group").select("row", "group")
    near = cut(N.near_texts(texts, similarity=0.8, words=5))
    parts = connected(coded.unionByName(near), "row", "group").withColumnsRenamed({"node": "_row", "component": "_group"})
    groups = rows.select("_row").join(parts, "_row", "left").withColumn("_group", F.coalesce("_group", "_row"))
    first = rows.select("_row", "doc_id").join(groups, "_row").groupBy("_group").agg(F.min_by("_row", F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("_row")).select("_row")
    return rows.join(first, "_row", "left_semi").select(*columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 2048 tokens."""
    return Q.packed(docs)


STAGES = [("toxicity", drop_toxic), ("quality rules", keep_quality), ("near duplicates", drop_copies), ("packing", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written to the shared folder and read by the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
