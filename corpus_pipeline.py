"""Corpus pipeline: the stages that turn ``documents`` into packed training sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and works on all that the stage before kept. All but the last return the
columns of ``documents``. ``run`` writes every stage's result to the shared
folder and rereads it, so a lost executor repeats at most one stage's tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyspark.llm.ngram_join import ngram_jaccard_components
from surveyspark.llm.packing import pack
from surveyspark.llm.pii import redact
from surveyspark.llm.substring_dedup import remove_spans, repeated_spans
from surveyspark.llm.tables import Shared, source, temporary
from surveyspark.llm.toxicity import label_categories, toxicity_chain


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain rejects as toxic go."""
    scored, _ = toxicity_chain(docs, source(spark, sf_dir, "labels"), label_categories(), "toxic")
    return scored.where(~F.col("rejected")).select(docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the least id; of repeated rows of an id
    the one with the least text; rows without an id stay."""
    groups = ngram_jaccard_components(docs).where("component_id = doc_id").select("doc_id")
    kept = docs.join(groups, "doc_id", "left_semi").select(docs.columns)
    if docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count():
        kept = kept.groupBy("doc_id").agg(F.min(F.struct("text", *(c for c in docs.columns if c not in ("doc_id", "text")))).alias("r"))
        kept = kept.select("doc_id", "r.*").select(docs.columns)
    return kept.union(docs.where("doc_id is null"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has go; a document of which nothing is left goes whole."""
    return remove_spans(docs, repeated_spans(docs))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by their kind."""
    return redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of at most 4096 ids."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("substring_dedup", substring_dedup),
    ("pii", pii),
    ("best_fit_packing", best_fit_packing),
]

#: The stages are not expressible in SQL; tests hold each against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared = Shared(spark, "pipeline")
    docs, last = source(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with temporary():  # a stage's own tables and its input go when its result is written
            docs = shared.put(stage(spark, docs, sf_dir), name)
        if last is not None:
            shared.drop(last)
        last = docs
    return docs
