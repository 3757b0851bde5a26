"""Every core query against its SQL on the smallest tables, and the invariants of the corpus build."""

import os

import pytest
from pyspark.sql import functions as F

from sparkshoal.plans import build, catalog
from tests.oracle import DATA, same

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_its_sql(spark, name):
    same(spark, catalog.QUERIES[name], catalog.SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_query_runs(spark, name):
    catalog.QUERIES[name](spark, DATA).collect()


def test_corpus_invariants(spark):
    out = build.corpus(spark, DATA).cache()
    assert out.count() > 0
    assert out.groupBy("dataset", "group").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0
    assert out.where("disposition = 'kept' and size(labels) = 0").count() == 0
    assert out.where(F.exists("labels", lambda b: (b["cx"] < 0) | (b["cx"] > 1) | (b["w"] > 1) | F.isnan(b["w"]))).count() == 0
    assert out.groupBy("out_name").count().where("count > 1").count() == 0
    assert sorted(r.out_name for r in build.corpus(spark, DATA).select("out_name").collect()) == sorted(r.out_name for r in out.select("out_name").collect())
    out.unpersist()
