from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sluice.operators.joins import drop_matching, keep_matching, lookup_join, settle_measured


@pytest.fixture
def skewed(spark):
    """Rows of which a third share one key, some have none, and the keys to look for."""
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 1000 == 1, None).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"), F.repeat(F.lit("x"), 60).alias("padding"))
    keys = spark.range(0, 60_000, 5).select(F.col("id").alias("k")).union(spark.sql("SELECT -1L AS k"))
    return rows, keys.union(keys)


def expected(matching: bool):
    wanted = {*range(0, 60_000, 5), -1}
    found = set()
    for i in range(60_000):
        key = -1 if i % 3 == 0 else None if i % 1000 == 1 else i
        if (key in wanted) == matching:
            found.add(i)
    return found


@pytest.mark.parametrize("bound", [None, 0])
def test_both_ways_give_the_whole_result(skewed, bound):
    rows, keys = skewed
    for operator, matching in ((keep_matching, True), (drop_matching, False)):
        found = [row.v for row in operator(rows, keys, ["k"], max_broadcast_bytes=bound).select("v").collect()]
        assert len(found) == len(set(found))
        assert set(found) == expected(matching)


def test_a_small_set_is_broadcast_without_shuffling_the_rows(skewed):
    plan = drop_matching(*skewed, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_a_hot_key_is_split_when_the_set_is_too_large_to_broadcast(spark, skewed):
    rows, keys = skewed
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
                "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        for how in ("left_anti", "left_semi", "left"):
            joined = lookup_join(rows.repartition(8, "v"), keys.distinct(), ["k"], how, max_broadcast_bytes=0)
            joined.collect()
            assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString(), how
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_size_is_measured_while_settling(spark):
    settled, size = settle_measured(spark.createDataFrame([("abc", 1), (None, 22)], "a STRING, b INT"))
    assert size == 2 * 48 + 3 + 1 + 2
    assert settled.count() == 2
    assert settle_measured(settled.limit(0))[1] == 0
