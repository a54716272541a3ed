"""The registered queries of this package: names, SQL where there is one, and no Python where none is allowed."""

import re

import pytest

import __spark_entry__ as entry_points
from ledgerlake.llm.oracle import STATEMENTS
from ledgerlake.llm.queries import REGISTRY
from tests.compare import database, difference

SF = "/root/testdata/sf0.001"


def test_names():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in REGISTRY) == list(range(1, 14))
    assert set(REGISTRY) | {"pipeline"} <= set(entry_points.queries())
    assert set(STATEMENTS) <= set(entry_points.oracle_sql()) & set(REGISTRY)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_matches_sql(spark, name):
    assert difference(REGISTRY[name](spark, SF), database(SF), STATEMENTS[name]) is None


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - set(STATEMENTS)))
def test_a_row_per_document(spark, name):
    rows = REGISTRY[name](spark, SF)
    if name == "op4_decontamination":
        assert rows.count() == rows.distinct().count()
    elif name == "op2_chat_threads":
        assert rows.count() == spark.read.parquet(f"{SF}/conversations.parquet").count()
    else:
        assert rows.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


@pytest.mark.parametrize("name", [n for n in REGISTRY if re.match("op[2459]_", n)])
def test_native_plans(spark, name):
    assert not re.search("Python|Pandas|Arrow", REGISTRY[name](spark, SF)._jdf.queryExecution().toString())
