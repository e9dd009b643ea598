import random

from pyspark.sql import functions as F

from stratalake.operators import broadcastable, frequent_keys, keys_to_spread, lookup_join
from tests.helpers import final_plan, rows


def fact_and_dimension(spark, n=6000):
    """A third of the facts have one member, a sixth have none, some an unknown one."""
    rng = random.Random(7)

    def member(i):
        if i % 3 == 0:
            return "hot"
        return None if i % 6 == 1 else f"m{rng.randrange(300)}"

    facts = [(f"c{i}", member(i)) for i in range(n)]
    members = [("hot", "X")] + [(f"m{i}", f"p{i}") for i in range(250)]
    return (
        spark.createDataFrame(facts, "claim_id string, member_id string").repartition(4),
        spark.createDataFrame(members, "member_id string, plan string").repartition(2),
        facts, dict(members),
    )


def test_frequent_keys(spark, conf):
    conf(spark__sql__shuffle__partitions="40")
    fact, *_ = fact_and_dimension(spark)
    found = frequent_keys(fact, ["member_id", "claim_id"])
    assert list(found["member_id"]) == ["hot"] and abs(found["member_id"]["hot"] - 1 / 3) < 0.01
    assert found["claim_id"] == {}
    assert frequent_keys(fact.limit(0), ["member_id"]) == {"member_id": {}}


def test_join_against_brute_force(spark, conf):
    conf(spark__sql__shuffle__partitions="16", spark__sql__autoBroadcastJoinThreshold="-1")
    fact, dimension, facts, members = fact_and_dimension(spark)
    want = sorted(((c, m, members.get(m)) for c, m in facts), key=repr)
    for frequent in (None, {"member_id": {}}, {"member_id": {"hot": 0.33}}, frequent_keys(fact, ["member_id"])):
        got = lookup_join(fact, dimension, "member_id", "claim_id", frequent)
        assert rows(got, "claim_id", "member_id", "plan") == want


def test_hot_and_missing_keys_are_spread(spark, conf):
    conf(spark__sql__shuffle__partitions="16", spark__sql__autoBroadcastJoinThreshold="-1",
         spark__sql__adaptive__enabled="false")
    fact, dimension, facts, _ = fact_and_dimension(spark)
    joined = lookup_join(fact, dimension, "member_id", "claim_id", frequent_keys(fact, ["member_id"]))
    largest = max(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
    assert largest < 3 * len(facts) / 16


def test_both_sides_are_shuffled_for_the_join_so_aqe_can_split(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__shuffle__partitions="8",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
    )
    facts = spark.range(0, 40000, 1, 8).selectExpr(
        "concat('c', id) AS claim_id", "IF(id % 3 = 0, 'hot', concat('m', id % 300)) AS member_id"
    )
    members = spark.range(300).selectExpr("concat('m', id) AS member_id", "'p' AS plan").union(
        spark.createDataFrame([("hot", "X")], "member_id string, plan string")
    )
    joined = lookup_join(facts, members.repartition("member_id"), "member_id", "claim_id", {"member_id": {}})
    assert "SortMergeJoin(skew=true)" in final_plan(joined)
    assert joined.count() == 40000


def test_a_small_dimension_is_broadcast(spark):
    fact, dimension, *_ = fact_and_dimension(spark)
    joined = lookup_join(fact, dimension, "member_id", "claim_id")
    assert "BroadcastHashJoin" in final_plan(joined)


def test_only_dimensions_too_large_to_broadcast_are_looked_at(spark, folder, conf):
    conf(spark__sql__shuffle__partitions="40", spark__sql__autoBroadcastJoinThreshold="20KB")
    fact, dimension, *_ = fact_and_dimension(spark)
    spark.range(20000).selectExpr("concat('c', id) AS claim_id", "uuid() AS note").write.parquet(str(folder / "large"))
    dimension.write.parquet(str(folder / "small"))
    large, small = spark.read.parquet(str(folder / "large")), spark.read.parquet(str(folder / "small"))
    assert broadcastable(small) and not broadcastable(large)
    assert keys_to_spread(fact, {"member_id": small}) == {}
    assert list(keys_to_spread(fact, {"member_id": large, "claim_id": small})["member_id"]) == ["hot"]
    assert keys_to_spread(fact, {"member_id": small, "claim_id": large}) == {"claim_id": {}}
