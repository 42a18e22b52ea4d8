"""The registered queries on the smallest data."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from starloom.llm import catalog
from tools_check import TABLES, compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_all_operators_and_the_pipeline_are_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "decontaminate", "bpe"]


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, name, SF).startswith("ok")
