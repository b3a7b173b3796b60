"""Every registered query against its DuckDB SQL, and the driver contract."""

import os
import re

import pytest

import __spark_entry__ as contract
from testbed import check
from testbed.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return check.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck, sf_dir):
    assert check.run(name, spark, duck, sf_dir) == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_no_python_workers_and_no_local_checkpoints():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    banned = re.compile(r"pandas_udf|F\.udf|\.rdd\b|localCheckpoint|applyInPandas|mapInPandas|crossJoin")
    for folder in ("milepost", "testbed"):
        for base, _, names in os.walk(os.path.join(root, folder)):
            for name in names:
                if name.endswith(".py"):
                    with open(os.path.join(base, name), encoding="utf-8") as f:
                        assert not banned.search(f.read()), name
