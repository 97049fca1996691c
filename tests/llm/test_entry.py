"""The registered queries of the corpus operators."""

import re

import duckdb
import pytest

import __spark_entry__ as driver
from grantweave.llm import queries as corpus

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    numbers = [int(re.match(r"op(\d+)_", name)[1]) for name in corpus.ALL]
    assert numbers == list(range(1, 14))
    assert set(corpus.ALL) | {"pipeline"} <= set(driver.queries())
    assert set(corpus.ORACLES) <= set(corpus.ALL)


@pytest.mark.parametrize("name", sorted(corpus.ORACLES))
def test_twin(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "conversations", "benchmark"):
        duck.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    ours = corpus.ALL[name](spark, SF).toArrow()
    theirs = duck.sql(corpus.ORACLES[name]).to_arrow_table()
    names = sorted(ours.column_names)
    assert names == sorted(theirs.column_names)
    rows = [sorted(map(str, zip(*(t.column(n).to_pylist() for n in names)))) for t in (ours, theirs)]
    assert rows[0] == rows[1]
