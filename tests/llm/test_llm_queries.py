import duckdb
import pytest
from compare import differences

import corpus_pipeline
from boardpulse.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, db, name):
    assert differences(QUERIES[name](spark, SF_DIR), db, ORACLE_SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_has_a_row_for_each_row(spark, db, name):
    table = {"op6": "pages", "op12": "embeddings"}.get(name.split("_")[0], "documents")
    frame = QUERIES[name](spark, SF_DIR)
    assert frame.count() == db.execute(f"SELECT count(*) FROM {table}").fetchall()[0][0]


def test_pipeline(spark, odd, nothing, tmp_path):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_duplicates", "repeated_spans", "decontamination", "pieces"]
    for docs in (odd, nothing):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            before = docs
            stage(spark, docs, SF_DIR).write.parquet(path := str(tmp_path / f"{id(before)}-{k}"))
            docs = spark.read.parquet(path)
            assert k == 4 or docs.columns == odd.columns
            assert docs.count() <= before.count()
    found = corpus_pipeline.run(spark, SF_DIR)
    rows = found.collect()
    assert found.columns == ["doc_id", "n_tokens", "ids", "text"] and rows
    assert all(r.n_tokens == len(r.ids) for r in rows)
