"""Queries that SQL can express, against DuckDB on the same tables."""

import duckdb
import pytest

from ledgerscreen.llm import queries
from tests.llm.conftest import same

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF).toPandas()
    assert len(got)
    same(got, con.sql(queries.ORACLE[name]).df())


@pytest.mark.parametrize("name", ["op1_suffix_repetition", "op4_cuckoo_lines", "op7_bayes_minhash", "op8_template_leaks",
                                  "op12_level_products", "op13_curriculum"])
def test_oracle_on_edge_cases(spark, name, edge_docs, tmp_path):
    docs = edge_docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    bench = spark.createDataFrame([(0, None), (1, ""), (2, "a b"), (None, "some text without an id here"),
                                   (3, edge_docs.where("doc_id = 8").first()["text"]), (3, "word again and again"),
                                   (5, "### $$ 1 2 3 ### $$ 1 2 3 1"), (6, "In 1 2 3 $ 1 2 km of 3 days 2 1")],
                                  "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    got = queries.QUERIES[name](spark, str(tmp_path)).toPandas()
    same(got, con.sql(queries.ORACLE[name]).df())
