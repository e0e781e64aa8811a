import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from handover.operators.keys import with_row_index


def test_row_index_equals_row_number(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 50), rnd.random(), i) for i in range(5000)]
    df = spark.createDataFrame(rows, "a int, b double, id int").repartition(13)
    got = with_row_index(df, ["a", "b", "id"], "k", start=10, num_partitions=7)
    exp = df.withColumn("k2", F.row_number().over(Window.orderBy("a", "b", "id")) + 9)
    diff = got.join(exp, "id").filter(F.col("k") != F.col("k2"))
    assert got.count() == 5000 and diff.count() == 0
    assert got.select("k").distinct().count() == 5000


def test_row_index_skewed_key(spark):
    # a third of the rows share the first order column
    rows = [(0 if i % 3 == 0 else i, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "a int, id int")
    got = with_row_index(df, ["a", "id"], "k")
    ks = sorted(r.k for r in got.collect())
    assert ks == list(range(1, 3001))


def test_row_index_with_coalesced_ranges(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    try:
        rnd = random.Random(5)
        rows = [(rnd.randint(0, 9), i) for i in range(2000)]
        df = spark.createDataFrame(rows, "a int, id int")
        got = with_row_index(df, ["a", "id"], "k")
        exp = {r[1]: n + 1 for n, r in enumerate(sorted(rows))}
        assert {r.id: r.k for r in got.collect()} == exp
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_row_index_with_start_over_many_ranges(spark):
    rows = [(i % 17, i) for i in range(1500)]
    df = spark.createDataFrame(rows, "a int, id int")
    got = with_row_index(df, ["a", "id"], "k", start=5, num_partitions=300)
    exp = {r[1]: n + 5 for n, r in enumerate(sorted(rows))}
    assert {r.id: r.k for r in got.collect()} == exp
