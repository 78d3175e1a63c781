"""Every registered query against its SQL; the comparison also refuses plans with cross joins."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from tools.check import compare  # noqa: E402
from weftline.plans import ORACLES, QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the test tables")


def test_entry(spark):
    assert entry(spark).columns == ["word", "n"]


def test_entry_offers_every_query():
    assert set(QUERIES) <= set(queries())
    assert set(ORACLES) <= set(oracle_sql()) <= set(queries())


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert sorted(set(QUERIES) - set(ORACLES)) == ["als_recommend", "logreg_predict", "text_classifier_predict"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    good, detail, _ = compare(spark, FOLDER, name, QUERIES[name], ORACLES.get(name))
    assert good, detail
