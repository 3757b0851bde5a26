"""Every query of the subpackage against its SQL, or at least run, on the smallest tables."""

import os

import pytest

from sparkshoal.llm import queries
from tests.oracle import DATA, same

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    same(spark, queries.QUERIES[name], queries.SQL[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_runs(spark, name):
    assert queries.QUERIES[name](spark, DATA).count() > 0


def test_files_hold_each_image_in_one_split(spark):
    found = queries.QUERIES["p1_splits"](spark, DATA)
    assert found.count() == found.select("dataset", "image_path").distinct().count()
    assert found.where("split is null").count() == 0
