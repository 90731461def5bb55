import pytest

import __spark_entry__
from siltstone import queries
from tests.helpers import SF, same


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_its_sql(spark, name):
    if name in queries.ORACLES:
        same(spark, queries.QUERIES[name], queries.ORACLES[name])
    else:
        assert queries.QUERIES[name](spark, SF).count() >= 0


def test_entry(spark):
    rows = __spark_entry__.entry(spark).collect()
    assert {r["split"] for r in rows} <= {"train", "validation", "test", "excluded"}
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_gate_summary_counts_folders_however_many_shards_they_have(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        shards = queries.faulty_shards(spark, SF).where("problem IS NOT NULL").count()
        same(spark, queries.gate_summary, queries.ORACLES["gate_summary"])
    finally:
        spark.conf.unset(key)
    assert shards > 3
