"""The pipeline's stages against brute force on planted rows, and the registered queries."""

import duckdb
import pandas as pd
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from citystream.llm import bpe

SF = "/root/testdata/sf0.01"


def test_all_operators_are_registered():
    names = entry.queries()
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in names)] == [] and "pipeline" in names


def test_stages_keep_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    text = " ".join(f"word{i}" for i in range(80))
    planted = spark.createDataFrame([
        (10 ** 9, text, "en", "s", 1), (10 ** 9 + 1, text, "en", "s", 1), (10 ** 9 + 2, text + " end", "en", "s", 1),
        (10 ** 9 + 3, f"so {bench} it", "en", "s", 1), (10 ** 9 + 4, "you idiot moron, scum and trash, pathetic loser", "en", "s", 1),
        (10 ** 9 + 5, "a clean short text", "en", "s", 1), (None, "a text without an id", "en", "s", 1),
        (10 ** 9 + 6, "repeated row", "en", "s", 1), (10 ** 9 + 6, "repeated row", "en", "s", 1), (10 ** 9 + 7, None, None, None, None)], docs.schema)
    all_docs = docs.unionByName(planted)
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda df: sorted((r.doc_id for r in df.select("doc_id").collect()), key=str)
    own = lambda df: [i for i in ids(df) if i is None or i >= 10 ** 9]
    first = stages["toxicity"](spark, all_docs, SF)
    assert first.columns == docs.columns and 10 ** 9 + 4 not in own(first) and len(own(first)) == 9
    second = stages["near_duplicates"](spark, first, SF)
    assert second.columns == docs.columns
    assert own(second).count(10 ** 9 + 6) == 1 and 10 ** 9 in own(second) and 10 ** 9 + 1 not in own(second) and None in own(second)
    third = stages["decontamination"](spark, second, SF)
    assert third.columns == docs.columns and set(own(second)) - set(own(third)) == {10 ** 9 + 3}
    last = stages["bpe"](spark, third, SF)
    assert ids(last) == ids(third)
    ranks = bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    counts = {r.doc_id: r.n_tokens for r in last.collect()}
    assert all(counts[r.doc_id] == len(library.encode_ordinary(r.text or "")) for r in third.collect())


def test_decisions_hold_for_rows(spark):
    """Rejected rows without an id go; of one id's texts only the rejected goes; extra columns stay."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    toxic = docs.join(spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1"), "doc_id", "left_semi").where("lang = 'en'").orderBy("doc_id").first().text
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    long = " ".join(f"word{i}" for i in range(80))
    big = 10 ** 9
    rows = [(None, toxic), (big, toxic), (big, "a calm text about gardens and bread"), (None, f"so {bench} it"), (big + 1, f"so {bench} it"),
            (big + 1, "another calm text, about rivers"), (None, long), (big + 2, long), (big + 2, long), (None, "alone and calm"), (None, "alone and calm")]
    planted = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], docs.schema)
    wider = docs.unionByName(planted).withColumn("p_toxic", F.lit("x")).withColumn("fp", F.lit(1)).withColumn("n_hit", F.lit(None).cast("int"))
    stages, texts = dict(corpus_pipeline.STAGES), lambda df: sorted(
        ((r.doc_id, r.text) for r in df.where(f"doc_id IS NULL OR doc_id >= {big}").collect()), key=str)
    left = rows
    gone = {"toxicity": {(None, toxic), (big, toxic)}, "near_duplicates": {(None, long)}, "decontamination": {(None, f"so {bench} it"), (big + 1, f"so {bench} it")}}
    for name in ("toxicity", "near_duplicates", "decontamination"):
        wider = stages[name](spark, wider, SF)
        assert wider.columns == [*docs.columns, "p_toxic", "fp", "n_hit"]
        left = [r for r in left if r not in gone[name]]
        if name == "near_duplicates":  # equal rows count once; the copies of a passage with different ids are one group
            left = sorted(set(left) - {(None, f"so {bench} it")}, key=str)
        assert texts(wider) == sorted(left, key=str), name


def test_stages_on_empty_tables(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    for name, stage in corpus_pipeline.STAGES:
        if name != "near_duplicates":
            assert stage(spark, docs, str(tmp_path)).count() == 20, name


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n.startswith("op")))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    want = con.sql(entry.oracle_sql()[name]).df()
    got = entry.queries()[name](spark, "/root/testdata/sf0.001").toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda d: sorted(tuple("" if pd.isna(v) else str(v).removesuffix(".0") for v in r)
                            for r in d[sorted(d.columns)].itertuples(index=False))
    assert rows(got) == rows(want)
