import random

import pytest

from stratalake.operators import latest_by
from tests.helpers import plan, rows


def frame(spark, data):
    return spark.createDataFrame(data, "k string, t int, v string")


def test_newest_and_oldest(spark):
    df = frame(spark, [("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z")])
    assert rows(latest_by(df, ["k"], "t")) == [("a", 3, "y"), ("b", 2, "z")]
    assert rows(latest_by(df, ["k"], "t", newest=False)) == [("a", 1, "x"), ("b", 2, "z")]


@pytest.mark.parametrize(("newest", "nulls_are_largest", "want"), [
    (True, True, None), (True, False, 3), (False, True, 1), (False, False, None),
])
def test_null_order(spark, newest, nulls_are_largest, want):
    df = frame(spark, [("a", 1, "x"), ("a", 3, "y"), ("a", None, "z")])
    assert rows(latest_by(df, ["k"], "t", newest, nulls_are_largest), "t") == [(want,)]


def test_ties_do_not_depend_on_the_split(spark):
    data = [("a", 1, v) for v in "dcba"] + [("a", 1, None)]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        assert rows(latest_by(frame(spark, data).repartition(3), ["k"], "t")) == [("a", 1, "a")]


def test_null_keys_are_one_group_and_exact_copies_collapse(spark):
    df = frame(spark, [(None, 1, "x"), (None, 2, "y"), ("a", 1, "x"), ("a", 1, "x")])
    assert rows(latest_by(df, ["k"], "t")) == [("a", 1, "x"), (None, 2, "y")]


def test_against_brute_force(spark):
    rng = random.Random(5)
    data = [(rng.choice("abcdef"), rng.choice([None, 1, 2, 3]), rng.choice("pqrs")) for _ in range(400)]
    best = {}
    for k, t, v in data:
        rank = (t is not None, -(t or 0), v)
        if k not in best or rank < best[k][0]:
            best[k] = (rank, (k, t, v))
    assert rows(latest_by(frame(spark, data).repartition(4), ["k"], "t")) == sorted(r for _, r in best.values())


def test_a_hot_key_is_cut_down_before_the_shuffle(spark):
    hot = [("hot", i, "x") for i in range(3000)] + [(f"k{i}", i, "x") for i in range(6000)]
    df = spark.createDataFrame(hot, "k string, t int, v string").repartition(4)
    picked = latest_by(df, ["k"], "t")
    lines = plan(picked).split("\n")
    above, below = lines[:_exchange(lines)], lines[_exchange(lines):]
    assert any("WindowGroupLimit" in line for line in above)
    assert any("WindowGroupLimit" in line for line in below)
    assert picked.count() == 6001


def _exchange(lines):
    return next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(k" in line)


def test_rows_that_lie_together_are_not_shuffled_again(spark):
    data = [(f"{o}-{k % 3}", k, f"v{k}", o) for o in (1, 2, 3, None) for k in range(6)]
    df = spark.createDataFrame(data, "k string, t int, v string, o long")
    got = latest_by(df.repartition(4, "o"), ["k"], "t", together="o")
    assert got.columns == ["k", "t", "v"] and plan(got).count("Exchange hashpartitioning") == 1
    assert rows(got) == rows(latest_by(df.drop("o"), ["k"], "t"))
