"""Registered queries against their SQL, and the pipeline against a plain run of its stages."""

from __future__ import annotations

import duckdb
import public_tokenizers
import pytest

import corpus_pipeline
from test_table_operators import similar_brute
from tidemark.llm.queries import ORACLE_SQL, QUERIES

TABLES = ("documents", "embeddings", "pages", "labels", "benchmark")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, sf_small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    cur = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in cur.description]
    df = QUERIES[name](spark, sf_small)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(*columns).collect()), key=str) == sorted(cur.fetchall(), key=str)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL) - {"pipeline"}))
def test_query_covers_its_table(spark, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    key, source = next((k, t) for k, t in (("doc_id", "documents"), ("vec_id", "embeddings"), ("page_id", "pages")) if k in df.columns)
    want = {r[0] for r in spark.read.parquet(f"{sf_small}/{source}.parquet").select(key).collect()}
    assert {r[0] for r in df.select(key).collect()} == want


def test_pipeline_stages(spark, sf_small, tmp_path):
    docs = first = spark.read.parquet(f"{sf_small}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_small).write.parquet(f"{tmp_path}/{name}")
        kept[name] = docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert docs.columns == first.columns
    rows = {n: [r.asDict() for r in d.collect()] for n, d in kept.items()}
    assert len(rows["language"]) == first.count()  # every text is clean in this respect
    component = similar_brute([(r["doc_id"], r["text"]) for r in rows["quality"]])
    assert {r["doc_id"] for r in rows["near_duplicates"]} == {i for i, (_, c, _) in component.items() if i == c}
    from tokenizers import Tokenizer

    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sum(len(e.ids) + 1 for e in tokens.encode_batch([r["text"] or "" for r in rows["mixing"]], add_special_tokens=False))
    assert sum(r["length"] for r in rows["packing"]) == want
    assert corpus_pipeline.run(spark, sf_small).count() == len(rows["packing"])
