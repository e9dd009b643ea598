import random

import pytest
from pyspark.sql import functions as F

from stratalake.operators import insert_only, latest_by, unmatched, upsert
from tests.helpers import final_plan, plan, rows

SCHEMA = "k string, f string, v string, t string"


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def random_batch(spark, seed, keys=30, size=40, t="2026-01-01"):
    rng = random.Random(seed)
    data = [(f"k{rng.randrange(keys)}", rng.choice("fg"), f"v{rng.randrange(99)}", t) for _ in range(size)]
    return latest_by(frame(spark, *data), ["k"], "v")


def test_known_keys_are_left_alone(spark):
    target = frame(spark, ("a", "f", "old", None))
    batch = frame(spark, ("a", "f", "new", None), ("b", "f", "new", None))
    assert rows(insert_only(target, batch, ["k"]), "k", "v") == [("a", "old"), ("b", "new")]


def test_composite_key(spark):
    target = frame(spark, ("a", "f", "old", None))
    batch = frame(spark, ("a", "f", "new", None), ("a", "g", "new", None))
    assert rows(insert_only(target, batch, ["k", "f"]), "k", "f", "v") == [("a", "f", "old"), ("a", "g", "new")]


def test_a_null_key_never_matches(spark):
    target, batch = frame(spark, (None, "f", "old", None)), frame(spark, (None, "f", "new", None))
    assert rows(insert_only(target, batch, ["k"]), "v") == [("new",), ("old",)]
    assert rows(upsert(target, batch, ["k"]), "v") == [("new",), ("old",)]


@pytest.mark.parametrize("merge", [insert_only, upsert])
def test_merging_twice_changes_nothing(spark, merge):
    target, batch = random_batch(spark, 1), random_batch(spark, 2)
    once = merge(target, batch, ["k"])
    assert rows(merge(once, batch, ["k"])) == rows(once)


def test_insert_only_in_two_parts_is_the_same_for_disjoint_parts(spark):
    target, batch = random_batch(spark, 1), random_batch(spark, 3)
    first, second = batch.where("v < 'v5'"), batch.where("v >= 'v5'")
    assert rows(insert_only(insert_only(target, first, ["k"]), second, ["k"])) == rows(insert_only(target, batch, ["k"]))


def test_upsert_of_both_batches_equals_one_after_the_other(spark):
    target = random_batch(spark, 1)
    older, newer = random_batch(spark, 2, t="2026-01-02"), random_batch(spark, 3, t="2026-01-03")
    both = latest_by(older.unionByName(newer), ["k"], "t")
    assert rows(upsert(upsert(target, older, ["k"]), newer, ["k"])) == rows(upsert(target, both, ["k"]))


def test_upsert_keeps_first_values_where_asked(spark):
    target = frame(spark, ("a", "first", "old", None), ("b", "first", "old", None))
    batch = frame(spark, ("a", "second", "new", None), ("c", "second", "new", None))
    got = rows(upsert(target, batch, ["k"], keep=["f"]), "k", "f", "v")
    assert got == [("a", "first", "new"), ("b", "first", "old"), ("c", "second", "new")]


def test_upsert_takes_nulls_from_the_batch(spark):
    got = upsert(frame(spark, ("a", "f", "old", None)), frame(spark, ("a", None, None, None)), ["k"])
    assert rows(got) == [("a", None, None, None)]


def test_upsert_newer_only(spark):
    target = frame(spark, ("a", "f", "old", "2026-01-02"), ("b", "f", "old", "2026-01-02"), ("c", "f", "old", "soon"))
    batch = frame(spark, ("a", "f", "new", "2026-01-01"), ("b", "f", "new", "2026-01-02"), ("c", "f", "new", "2026-01-01"),
                  ("d", "f", "new", None))
    got = rows(upsert(target, batch, ["k"], newer_by="t"), "k", "v")
    assert got == [("a", "old"), ("b", "new"), ("c", "new"), ("d", "new")]


def test_against_brute_force(spark):
    for seed in range(3):
        target, batch = random_batch(spark, seed), random_batch(spark, seed + 100)
        have, new = {r.k: r for r in target.collect()}, {r.k: r for r in batch.collect()}
        assert rows(insert_only(target, batch, ["k"])) == sorted(map(tuple, {**new, **have}.values()), key=repr)
        assert rows(upsert(target, batch, ["k"])) == sorted(map(tuple, {**have, **new}.values()), key=repr)


def test_within_gives_the_same_rows(spark):
    target = frame(spark, ("a", "f", "old", None), ("a", "g", "old", None), ("b", "h", "old", None))
    batch = frame(spark, ("a", "f", "new", None), ("b", "f", "new", None), ("c", "g", "new", None))
    free = rows(unmatched(batch, target, ["k", "f"]))
    assert rows(unmatched(batch, target, ["k", "f"], within={"f": ["f", "g"]})) == free
    with pytest.raises(ValueError):
        unmatched(batch, target, ["k", "f"], within={"v": ["new"]})


def test_a_large_target_is_scanned_for_its_keys_and_not_shuffled(spark, folder):
    path = str(folder / "target")
    spark.range(20000).selectExpr(
        "concat('k', id) AS k", "concat('f', id % 3) AS f", "repeat('v', 50) AS v", "'t' AS t"
    ).write.parquet(path)
    spark.range(50).selectExpr(
        "concat('k', id * 1000) AS k", "'f1' AS f", "'n' AS v", "'t' AS t"
    ).write.parquet(str(folder / "batch"))
    target, batch = spark.read.parquet(path), spark.read.parquet(str(folder / "batch"))
    fresh = unmatched(batch, target, ["k", "f"], within={"f": ["f1"]})
    text = plan(fresh)
    assert "Exchange hashpartitioning" not in text
    narrow = [line for line in text.split("\n") if "ReadSchema: struct<k:string,f:string>" in line]
    assert "LeftSemi" in text and narrow and all("EqualTo(f,f1)" in line for line in narrow)
    assert fresh.count() == 50 - 7


def test_many_keys_are_not_broadcast_however_small_their_files(spark, folder):
    """Beside columns of NULLs the keys are a small share of a file's estimated size."""
    many = spark.range(120_000).selectExpr("concat('C', id) AS k", *[f"CAST(NULL AS STRING) AS v{i}" for i in range(12)])
    many.write.parquet(f"{folder}/batch")
    many.where("k > 'C5'").unionByName(many.limit(1).withColumn("k", F.lit(None).cast("string"))).write.parquet(f"{folder}/target")
    batch, target = spark.read.parquet(f"{folder}/batch"), spark.read.parquet(f"{folder}/target")
    one = latest_by(batch, ["k"], "v0")
    known_size, estimated = unmatched(one, target, ["k"], rows=120_000), unmatched(one, target, ["k"])
    assert rows(known_size, "k") == rows(estimated, "k") and known_size.count() == many.where("k <= 'C5'").count()
    assert "BroadcastExchange" in plan(estimated) and "BroadcastExchange" not in final_plan(known_size)


def test_upsert_shuffles_each_side_once(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    merged = upsert(frame(spark, ("a", "f", "o", None)), frame(spark, ("a", "f", "n", None)), ["k"])
    assert final_plan(merged).split("Initial Plan")[0].count("Exchange hashpartitioning") == 2
