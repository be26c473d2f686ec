"""The pipeline's rows against its stages, and the registered queries' tables."""

import numpy as np
import tiktoken
from compare import connect, difference

import __spark_entry__ as contract
import corpus_pipeline
from textmill.llm import mixing, secrets, toxicity, vocabulary
from textmill.llm.oracles import ORACLES
from textmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert QUERIES.keys() | {"pipeline"} <= contract.queries().keys()
    assert ORACLES.keys() <= contract.oracle_sql().keys()


def test_queries_with_sql(spark):
    con = connect(SF)
    for name, sql in ORACLES.items():
        assert difference(contract.queries()[name](spark, SF).toPandas(), con.sql(sql).df()) is None


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.toPandas(), docs.schema)
        seen.append((name, docs.toPandas()))
        assert docs.columns == columns or name == "byte_bpe"
    tables = dict(seen)
    source = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rejected = {r.doc_id for r in toxicity.score(source, labels).collect() if r.predicted}
    assert set(tables["toxicity"].doc_id) == set(source.toPandas().doc_id) - rejected
    assert tables["near_duplicates"].text.is_unique
    assert len(tables["secrets"]) == len(tables["near_duplicates"])
    report = secrets.secret_report(spark.createDataFrame(tables["secrets"], source.schema)).collect()
    assert all(r.spans == "" for r in report)
    assert (tables["secrets"].n_chars == tables["secrets"].text.str.len()).all()
    mixed = mixing.mix_report(spark.createDataFrame(tables["secrets"], source.schema)).toPandas()
    assert tables["mixing"].doc_id.value_counts().to_dict() == dict(zip(mixed[mixed.copies > 0].doc_id, mixed[mixed.copies > 0].copies))
    with open(vocabulary.BYTE_BPE, "rb") as file:
        public = tiktoken.Encoding("own", pat_str=vocabulary.PATTERN, mergeable_ranks=vocabulary.ranks(file.read()), special_tokens={})
    texts = tables["mixing"].drop_duplicates("doc_id").set_index("doc_id").text
    assert len(tables["byte_bpe"]) == len(tables["mixing"])
    for row in tables["byte_bpe"].itertuples():
        ids = public.encode_ordinary(texts[row.doc_id])
        assert np.frombuffer(row.ids, "<u4").tolist() == ids and row.n_tokens == len(ids)
