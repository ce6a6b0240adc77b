"""Every registered query of the library against its SQL, on the smallest tables."""

import pytest

from winnow.plans import catalogue

from .oracle import same, views

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return views(FOLDER)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, con, name):
    got = catalogue.queries()[name](spark, FOLDER).toPandas()
    if name in catalogue.oracle_sql():
        same(got, con.sql(catalogue.oracle_sql()[name]).df())


def test_leaders_are_the_sequential_ones(spark):
    near = {(r["a"], r["b"]): r["similarity"] for r in catalogue.queries()["cosine_pairs"](spark, FOLDER).collect()}
    ids = sorted(r[0] for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id").collect())
    leader = {}
    for i in ids:
        if i not in leader:
            leader[i] = i
            for j in ids:
                if j > i and j not in leader and (i, j) in near:
                    leader[j] = i
    assert {r["id"]: r["leader"] for r in catalogue.queries()["leader_clusters"](spark, FOLDER).collect()} == leader


def test_entry():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
