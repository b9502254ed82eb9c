from collections import Counter

from conftest import plan_of
from pyspark.sql import functions as F

from corpusloom.operators import relational as rel
from corpusloom.plans import skew


def skewed(spark):
    """A third of the rows share one key."""
    return spark.range(0, 3000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )


def test_hot_keys(spark):
    assert [r["k"] for r in skew.hot_keys(skewed(spark), ["k"]).collect()] == [0]
    even = spark.range(1000).select((F.col("id") % 100).alias("k"))
    assert skew.hot_keys(even, ["k"]).isEmpty()


def test_salted_join_equals_join(spark):
    left = skewed(spark).unionByName(spark.createDataFrame([(None, -1)], "k bigint, v bigint"))
    right = spark.range(0, 3000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    right = right.unionByName(right.filter("k < 10"))
    for how in ("inner", "left"):
        salted = skew.salted_join(left, right, ["k"], how, splits=4)
        plain = left.join(right, ["k"], how)
        assert Counter(salted.collect()) == Counter(plain.collect())


def test_salted_join_divides_the_hot_key(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        right = spark.range(3000).select(F.col("id").alias("k"), F.col("id").alias("w"))
        assert not skew.balances_joins(right)
        joined = skew.skew_join(skewed(spark), right, ["k"])
        # One shuffle partition would hold all 1000 rows of the hot key; divided, none does.
        hot = joined.filter("k = 0").groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in hot) == 1000
        assert max(r["count"] for r in hot) < 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_adaptive_execution_splits_the_hot_partition(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        right = spark.range(3000).select(F.col("id").alias("k"), F.col("id").alias("w"))
        joined = skew.skew_join(skewed(spark), right, ["k"])
        assert joined.count() == 3000
        rows = joined.collect()
        assert len(rows) == 3000
        assert "skew=true" in plan_of(joined)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_null_keys_are_divided(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(1000).select(F.lit(None).cast("long").alias("k"), "id").union(spark.range(10).select("id", "id"))
        right = spark.range(10).select(F.col("id").alias("k"), F.col("id").alias("w"))
        joined = skew.salted_join(left, right, ["k"]).select("k", "w", F.spark_partition_id().alias("p"))
        sizes = [r["count"] for r in joined.filter("k IS NULL").groupBy("p").count().collect()]
        assert sum(sizes) == 1000 and max(sizes) < 600
        assert joined.filter("k = w").count() == 10
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_latest_is_pruned_before_the_shuffle(spark):
    latest = rel.latest_per_key(skewed(spark), ["k"], ["v"])
    plan = plan_of(latest)
    assert plan.count("WindowGroupLimit") == 2
    assert latest.filter("k = 0").head()["v"] == 2997


def test_counts_before_joining(spark):
    dim = spark.range(3000).select(F.col("id").alias("k"), F.concat(F.lit("n"), F.col("id") % 2).alias("name"))
    top = rel.top_groups(skewed(spark), dim, "k", "name", "v", 1).collect()
    assert [(r["name"], r["purchases"]) for r in top] == [("n0", 2000)]
