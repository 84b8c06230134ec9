"""Every registered query against its SQL twin on the smallest scale."""

import pytest

import __spark_entry__ as entries
import compare
import oracles

SF = "/root/testdata/sf0.001"
ORACLES = entries.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF)


def test_every_query_has_an_oracle():
    own = set(oracles.oracle_sql())
    assert own <= set(entries.queries()) and set(ORACLES) <= set(entries.queries())
    corpus = set(entries.corpus.queries()) | {"pipeline"} if entries.corpus else set()
    assert set(entries.queries()) - corpus == own


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_oracle(as_deployed, duck, name):
    assert compare.differences(entries.queries()[name](as_deployed, SF), duck, ORACLES[name]) == ""


def test_entry(spark):
    assert entries.entry(spark).count() == 1_996
