"""Five stages from raw documents to token ids. Each works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.decontamination import contaminated, match_benchmark
from feedloom.llm.inputs import table
from feedloom.llm.jaccard_join import jaccard_components
from feedloom.llm.mixing import mix
from feedloom.llm.quality_rules import judge, trusted_ids
from feedloom.llm.token_ids import tokenize_documents, tokenizer_file
from feedloom.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = judge(docs, trusted_ids(table(spark, sf_dir, "labels")), docs.columns)
    return judged.where("kept").select("own.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each component. Documents without words are all kept, rows equal
    in id and text once."""
    key = F.xxhash64("doc_id", "text").alias("key")
    # A second hash, so that two rows are taken for equal by 128 bits.
    more = F.xxhash64(F.lit("row"), "text", "doc_id").alias("more")
    keyed = docs.select(F.struct(*docs.columns).alias("own"), "doc_id", "text", key, more)
    found = jaccard_components(keyed, "key")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "tag")
    first = found.where("component IS NOT NULL").groupBy("component").agg(F.min(order).alias("first"))
    alone = found.where("component IS NULL").select(F.col("tag").alias("key"))
    keep = first.select(F.col("first.tag").alias("key")).unionByName(alone)
    kept = keyed.select("own", "key", "more").join(keep, "key", "left_semi")
    return kept.dropDuplicates(["key", "more"]).select("own.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth stands in the benchmark."""
    columns = docs.columns
    carried = docs.select(F.struct(*columns).alias("own"), "text")
    found = match_benchmark(carried, table(spark, sf_dir, "benchmark"))
    return found.where(~contaminated()).select(*(F.col("own")[c].alias(c) for c in columns))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    mixed = mix(docs, docs.columns).where("copies > 0")
    return mixed.select("own", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("own.*")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the mix, written and read back."""
    return tokenize_documents(spark, docs, tokenizer_file())


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", source_mixing),
    ("token-ID / binary output", token_ids),
]
# SQL cannot express the shingle components, the dual of the mix or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, "pipeline-stage")
    return docs
