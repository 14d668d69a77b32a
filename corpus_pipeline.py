"""Corpus pipeline: toxicity, near-duplicates, benchmark decontamination, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. The first three
return the columns of ``docs``, extra ones included.

A decision holds for a row, told by its doc_id and the SHA-256 of its text: of
two rows with one doc_id and different texts the one may go and the other stay,
and a row without a doc_id goes like any other. Rows equal in both share their
fate. Empty tables give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream.llm import bpe, decontaminate, simhash, toxicity
from citystream.llm.common import bounded, cut, read_table
from citystream.llm.queries import VOCABULARY
from citystream.session import prepare, scratch_path

ROW = "_pipeline_row"


def with_row_key(docs: DataFrame) -> DataFrame:
    """``docs`` and a string that names a row: keys sort by doc_id, null last."""
    number = F.col("doc_id").cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")
    shown = F.coalesce(F.lpad(number.cast("decimal(20,0)").cast("string"), 20, "0"), F.lit("~"))
    return docs.withColumn(ROW, F.concat_ws(":", shown, F.coalesce(F.sha2("text", 256), F.lit("~"))))


def without(keyed: DataFrame, rejected: DataFrame) -> DataFrame:
    """``keyed`` but for the rows whose key is among the ``rejected`` ones. Only
    those keys are shuffled or, if counted few, broadcast."""
    return keyed.join(bounded(rejected.select(ROW).distinct()), ROW, "left_anti").select(keyed.columns)


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the rows judged toxic. A null text has no words and stays unless
    the model's constant alone says otherwise; without labels all rows stay."""
    keyed = with_row_key(docs)
    chain = toxicity.train(docs, read_table(spark, sf_dir, "labels").select("doc_id", "toxic"), toxicity.document_chain())
    judged = toxicity.predict(keyed, chain, id_col=ROW)
    return without(keyed, cut(judged.where(F.col("p_toxic") >= chain.threshold).select(ROW))).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each component: the smallest doc_id's, the one with the
    smaller hash if an id has several texts; a row without a doc_id only where
    no other has one. Rows equal in doc_id and text count once. All word-less
    and null texts are near-duplicates of each other."""
    prepare(spark)
    keyed = with_row_key(docs)
    found = cut(simhash.near_duplicates(keyed, id_col=ROW, shingle=3, max_bits=3).select(ROW, "component_id"))
    kept = without(keyed, found.where(F.col(ROW) != F.col("component_id")))
    repeated = found.where(F.col(ROW) == F.col("component_id")).groupBy(ROW).count().where("count > 1").select(ROW)
    if not repeated.isEmpty():
        once = kept.join(bounded(repeated), ROW, "left_semi").dropDuplicates([ROW])
        kept = without(kept, repeated).unionByName(once)
    return kept.select(docs.columns)


def contaminated_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the rows that share a window with the benchmark; null and
    word-less texts share none, an empty benchmark keeps all."""
    keyed = with_row_key(docs)
    found = decontaminate.contamination(keyed, read_table(spark, sf_dir, "benchmark"), id_col=ROW)
    return without(keyed, found.where("contaminated")).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every row of ``docs``; a null text has no ids."""
    ranks = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    return bpe.round_trip_digests(docs, ranks, public_tokenizers.PATTERN)


STAGES = [("toxicity", toxic_documents), ("near_duplicates", near_duplicates),
          ("decontamination", contaminated_documents), ("bpe", tokens)]

#: SQL can express neither the first stage's classifier nor the last one's merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
