"""Joins and row numbers when one key holds a large share of all rows."""

from pyspark.sql import Window, functions as F

from pageflow.operators.joins import fits_broadcast, lookup_join, split_join
from pageflow.operators.ranking import number_rows

from conftest import rows


def skewed(spark, n=3000):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50))
    return spark.range(n).select(key.alias("k"), F.col("id").alias("v"), (F.col("id") % 7).alias("w"))


def lookup(spark):
    return spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("k2", 4), ("none", 5)], "k string, t int")


def test_both_join_strategies_agree(many_partitions):
    spark = many_partitions
    big, small = skewed(spark), lookup(spark)
    expected = rows(big.join(small, "k"), "k", "v", "w", "t")
    assert rows(lookup_join(big, small, "k"), "k", "v", "w", "t") == expected
    assert rows(lookup_join(big, small, "k", broadcast_rows=2, rows_per_split=40), "k", "v", "w", "t") == expected


def test_hot_key_is_cut_into_slices(many_partitions):
    spark = many_partitions
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = split_join(skewed(spark), lookup(spark), ["k"], rows_per_split=40)
        spread = joined.where("k = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert spread > 4


def test_keys_hot_on_either_or_both_sides(many_partitions):
    spark = many_partitions
    big = skewed(spark, 600)
    many = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.lit("k1")).otherwise(F.lit("k2")).alias("k"),
        F.col("id").alias("t"),
        F.array(F.col("id")).alias("words"),
    )
    joined = split_join(big, many, ["k"], rows_per_split=30)
    assert sorted(joined.columns) == ["k", "t", "v", "w", "words"]
    assert rows(joined, "k", "v", "w", "t") == rows(big.join(many, "k"), "k", "v", "w", "t")


def test_a_spread_side_is_cut_without_being_stored(many_partitions):
    spark = many_partitions
    big = skewed(spark, 600)
    many = spark.range(300).select(F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.lit("k1")).alias("k"), F.col("id").alias("t"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = split_join(big, many, ["k"], rows_per_split=30, spread=["v"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        spread = joined.where("k = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
        assert rows(joined, "k", "v", "w", "t") == rows(big.join(many, "k"), "k", "v", "w", "t")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "join-big" not in plan and "join-lookup" in plan and spread > 4


def test_a_side_of_keys_only_and_equal_rows(many_partitions):
    spark = many_partitions
    big = spark.range(900).select(F.lit("hot").alias("k"), F.lit(1).alias("v"))
    keys = spark.createDataFrame([("hot",), ("hot",), ("cold",)], "k string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = split_join(big, keys, ["k"], rows_per_split=50)
        per_task = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r["count"] for r in per_task) == 1800
    assert max(r["count"] for r in per_task) < 900


def test_fits_broadcast_looks_at_rows_and_bytes(spark):
    df = spark.createDataFrame([("x" * 1000, ["y" * 1000])] * 10, "a string, b array<string>")
    assert fits_broadcast(df)
    assert not fits_broadcast(df, rows=9)
    assert not fits_broadcast(df, size=15_000)
    assert fits_broadcast(df.limit(0))


def test_numbering_matches_a_window(many_partitions):
    df = skewed(many_partitions)
    order = [F.desc("w"), F.asc("v")]
    found = number_rows(df, ["k"], order, "n").withColumn("n", F.col("n").cast("int"))
    window = Window.partitionBy("k").orderBy(*order)
    expected = df.withColumn("n", F.row_number().over(window))
    assert rows(found, "k", "v", "w", "n") == rows(expected, "k", "v", "w", "n")


def test_numbering_spreads_one_group_over_tasks(many_partitions):
    df = many_partitions.range(5000).select(F.lit("only").alias("k"), F.col("id").alias("v"))
    found = number_rows(df, ["k"], [F.asc("v")], "n")
    assert found.where(F.col("n") != F.col("v") + 1).count() == 0
    tasks = found.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    assert max(r["count"] for r in tasks) < 5000


def test_numbering_an_empty_table(spark):
    df = spark.createDataFrame([], "k string, v int")
    assert number_rows(df, ["k"], [F.asc("v")]).count() == 0
