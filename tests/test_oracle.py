"""Every registered query against its SQL twin on the small benchmark tables."""

import pytest

import __spark_entry__ as entry
from workload.compare import compare, duck

OWN = [m for m in entry.MODULES if m.__name__.startswith("workload.")]
QUERIES = {name: fn for m in OWN for name, fn in m.QUERIES.items()}
ORACLE = {name: sql for m in OWN for name, sql in m.ORACLE.items()}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    ok, message, _ = compare(spark, con, sf_dir, QUERIES[name], ORACLE[name])
    assert ok, message


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["event_id", "run_id", "failed_checks", "min_confidence", "last_seen_at"]
    assert df.count() > 0
