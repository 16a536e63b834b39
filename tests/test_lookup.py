from pyspark.sql import functions as F

from meterlake.operators.lookup import hot_keys, lookup_join, measure, salted_join
from meterlake.session import settle_measured


def facts(spark):
    """One key holds a third of the rows, and a third have none."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 100)).alias("k"),
        "id",
    )


def dim(spark):
    keys = [("hot", 1.0)] + [(f"k{i}", float(i)) for i in range(0, 100, 2)] + [(None, -1.0)]
    return spark.createDataFrame(keys, "k string, w double")


def test_salted_join_gives_the_plain_left_join(spark, rows):
    expected = rows(facts(spark).join(dim(spark), "k", "left"), "k", "id", "w")
    salted = salted_join(facts(spark), dim(spark), ["k"], spread_by=["id"], rows_per_task=100)
    assert rows(salted, "k", "id", "w") == expected
    assert len(expected) == 3000


def test_salted_join_deals_out_hot_and_null_keys(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        salted = salted_join(facts(spark), dim(spark), ["k"], spread_by=["id"], rows_per_task=50)
        sizes = [r["count"] for r in salted.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(sizes) < 1100, sizes


def test_a_hot_key_gets_as_many_tasks_as_its_rows_fill(spark, rows):
    assert rows(hot_keys(facts(spark), ["k"], 300)) == [("hot", 4)]
    assert rows(hot_keys(facts(spark), ["k"], 1000)) == []


def test_keys_are_counted_where_the_caller_says(spark, rows, plan):
    wide = facts(spark).join(spark.range(3000), "id")
    expected = rows(wide.join(dim(spark), "k", "left"), "k", "id", "w")
    salted = salted_join(wide, dim(spark), ["k"], spread_by=["id"], count_in=facts(spark), rows_per_task=100)
    assert rows(salted, "k", "id", "w") == expected


def test_a_dimension_over_the_limit_is_not_broadcast(spark, rows, plan):
    small = lookup_join(facts(spark), dim(spark), ["k"], spread_by=["id"])
    large = lookup_join(facts(spark), dim(spark), ["k"], spread_by=["id"], limit_bytes=10)
    assert rows(small, "k", "id", "w") == rows(large, "k", "id", "w")
    text = plan(small)
    assert "BroadcastHashJoin" in text
    assert "_salt" in plan(large)


def test_measured_size(spark):
    df = spark.createDataFrame([("ab", 1), (None, 2)], "s string, n int")
    assert measure(df).bytes == 2 * 32 + 2
    assert settle_measured(df, "sized").bytes == 2 * 32 + 2
    assert measure(df.limit(0)).bytes == 0
