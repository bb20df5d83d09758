import pytest
from compare import connect, spark_rows, sql_rows

import __spark_entry__ as entry_point
import corpus_pipeline
from conftest import SMALL
from curbside.llm.mixing import mix_sources
from curbside.llm.queries import QUERIES, SQL
from curbside.llm.tables import read


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry_point.queries())
    assert set(SQL) <= set(entry_point.oracle_sql())
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    got = spark_rows(QUERIES[name](spark, SMALL))
    assert got == sql_rows(connect(SMALL), SQL[name])


def test_stages_return_documents(spark):
    docs = read(spark, SMALL, "documents")
    rows = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SMALL)
        assert after.columns == docs.columns, name
        assert after.exceptAll(docs).count() == 0, name
        assert 0 < after.count() <= rows, name


def test_run_mixes_what_the_stages_kept(spark):
    docs = read(spark, SMALL, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
    got = spark_rows(corpus_pipeline.run(spark, SMALL))
    assert got == spark_rows(mix_sources(docs))
