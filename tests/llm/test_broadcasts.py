"""Tables with about a row per input row are never broadcast, whatever size Spark takes them for."""

import pytest
from pyspark.sql import functions as F

from loadlens.llm import common, components, simhash


@pytest.fixture
def plans(monkeypatch):
    """The plans of all tables that the operators store."""
    found = []

    def write_table(df, name):
        found.append(df._jdf.queryExecution().executedPlan().toString())
        return common.write_table(df, name)

    monkeypatch.setattr(simhash, "write_table", write_table)
    monkeypatch.setattr(components, "write_table", write_table)
    return found


def texts(spark):
    rows = spark.range(300).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("a b c d e f g h"), (F.col("id") % 100).cast("string")).alias("text"))
    return common.write_table(rows, "texts")


def test_near_duplicates_broadcast_no_table_of_rows(spark, plans):
    found = simhash.near_duplicates(common.located(texts(spark)))
    assert found.select("doc_id").distinct().count() == 300 and found.where("component_id > doc_id").isEmpty()
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in p for p in plans) > 2
    assert not [p for p in plans if "Broadcast" in p]


def test_kept_rows_are_not_broadcast(spark):
    docs = common.located(texts(spark))
    kept = common.keep_located(docs, "loc", docs.where("doc_id < 7").select("loc"))
    assert "Broadcast" not in kept._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.doc_id for r in kept.collect()) == list(range(7))
