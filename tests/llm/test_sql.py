"""Queries that SQL can say, on the tables and on odd rows."""

import duckdb
import pytest
from compare import connect, differences

from retaloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, folder, name):
    found = queries.QUERIES[name](spark, folder)
    assert differences(found, connect(folder), queries.ORACLES[name]) == ""


def test_every_operator_is_registered_once():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))


@pytest.mark.parametrize("name", ["op4_suffix_automaton", "op8_exact_dedup"])
def test_odd_rows_match_sql(spark, odd, tmp_path, name):
    odd.where("doc_id is not null and coalesce(length(text), 0) < 1000").dropDuplicates(["doc_id"]).coalesce(1).write.parquet(
        str(tmp_path / "d"))
    items = [(1, "quick brown fox"), (2, None), (3, ""), (4, "word1 filler1"), (5, "one"), (5, "one")]
    spark.createDataFrame(items, "item_id bigint, text string").coalesce(1).write.parquet(
        str(tmp_path / "b"))
    (tmp_path / "documents.parquet").symlink_to(tmp_path / "d")
    (tmp_path / "benchmark.parquet").symlink_to(tmp_path / "b")
    con = duckdb.connect()
    for t, d in (("documents", "d"), ("benchmark", "b")):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{d}/*.parquet'")
    assert differences(queries.QUERIES[name](spark, str(tmp_path)), con, queries.ORACLES[name]) == ""
