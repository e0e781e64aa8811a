"""Joins with heavy keys: equal to plain joins, and split evenly without AQE's skew join."""

import pytest
from pyspark.sql import functions as F

from handover.operators.skew import heavy_keys, split_join


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.range(30_000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 20 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 700)).alias("k")
    )
    right = spark.range(600).select(F.concat(F.lit("k"), "id").alias("name"), F.col("id").alias("v"))
    right = right.unionByName(spark.createDataFrame([("hot", -1), ("hot", -2), (None, -3)], "name string, v long"))
    return left.cache(), right.cache()


def test_heavy_keys_are_the_frequent_ones(spark, sides):
    left, _ = sides
    heavy = heavy_keys(left, "k", 1 / 64)
    hashed = {r["k"]: r["h"] for r in left.select("k", F.xxhash64("k").alias("h")).distinct().collect()}
    assert set(heavy) == {hashed["hot"], hashed[None]}
    assert heavy[hashed["hot"]] in (21, 22)
    assert heavy_keys(left.limit(0), "k") == {}


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_split_join_equals_the_plain_join(spark, sides, how, null_safe):
    left, right = sides
    same = left["k"].eqNullSafe(right["name"]) if null_safe else left["k"] == right["name"]
    want = sorted(map(tuple, left.join(right, same, how).collect()), key=repr)
    got = split_join(left, right, "k", "name", how, ["id"], share=1 / 64, null_safe=null_safe)
    assert got.columns == left.join(right, same, how).columns
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_condition_and_empty_sides(spark, sides):
    left, right = sides
    got = split_join(left, right, "k", "name", "left_semi", ["id"], condition=lambda a, b: a["id"] > b["v"])
    assert got.count() == left.join(right, (left["k"] == right["name"]) & (left["id"] > right["v"]), "left_semi").count()
    assert split_join(left.limit(0), right, "k", "name", "inner", ["id"]).count() == 0
    assert split_join(left, right.limit(0), "k", "name", "left", ["id"]).count() == left.count()
    with pytest.raises(ValueError):
        split_join(left, right, "k", "name", "right", ["id"])


def test_a_third_of_the_rows_in_one_key_is_no_long_task(spark, sides):
    left, right = sides
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = lambda df: sorted(r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect())
        split = sizes(split_join(left, right.where("v <> -2"), "k", "name", "inner", ["id"]))
        plain = sizes(left.join(right.where("v <> -2"), left["k"] == right["name"]))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert split[-1] <= 2 * split[len(split) // 2]
    assert plain[-1] > 2 * plain[len(plain) // 2]
