from pyspark.sql import functions as F

from millrace.operators import marts, skew
from millrace.operators.skew import SkewPolicy, heavy_keys

# Treats any key with more than a handful of rows as heavy.
EAGER = SkewPolicy(min_bytes=0, min_hits=20, cell_rows=20)


def left(spark):
    """A third of the rows on one key as copies of one row, a fifth on null."""
    return spark.range(0, 3000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 5 == 0, F.lit(None))
        .otherwise((F.col("id") % 700).cast("string"))
        .alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("v"),
    )


def right(spark):
    return spark.range(0, 900, 2).select(
        F.when(F.col("id") == 2, "hot")
        .when(F.col("id") == 4, F.lit(None))
        .otherwise(F.col("id").cast("string"))
        .alias("rk"),
        (F.col("id") * 10).alias("w"),
    )


def test_heavy_rows_spread_over_salts(spark):
    cells = dict(heavy_keys(left(spark), "k", EAGER))
    assert cells["hot"] == 50
    salted = skew.add_salt(left(spark), "k", list(cells.items()), "s")
    per_salt = salted.filter("k = 'hot'").groupBy("s").count()
    assert per_salt.agg(F.max("count")).first()[0] <= 500


def test_looking_for_heavy_keys_is_one_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("probe", "heavy keys")
    heavy_keys(left(spark), "k", EAGER)
    probe = len(tracker.getJobIdsForGroup("probe"))
    spark.sparkContext.setJobGroup("enrich", "plan only")
    sales = left(spark).withColumnsRenamed({"k": "customer_id"})
    marts.enrich(sales, right(spark).withColumnsRenamed({"rk": "user_id"}))
    assert len(tracker.getJobIdsForGroup("enrich")) == 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert probe >= 1


def test_cells_grow_with_the_input():
    policy = SkewPolicy()
    assert policy.most_cells * policy.min_hits <= 4_000_000


def test_enrich_splits_a_heavy_buyer(spark):
    """Adaptive execution cuts the partition of the key that half of the sales have."""
    other = spark.newSession()
    for key, value in (
        ("spark.sql.autoBroadcastJoinThreshold", "-1"),
        ("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1"),
        ("spark.sql.adaptive.coalescePartitions.enabled", "false"),
        ("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20k"),
        ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10k"),
        ("spark.sql.shuffle.partitions", "20"),
    ):
        other.conf.set(key, value)
    sales = other.range(0, 40_000, numPartitions=8).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("customer_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("order_id"),
    )
    users = other.range(0, 40_000).select(F.col("id").cast("string").alias("user_id"), F.lit("x").alias("country"))
    users = users.union(other.createDataFrame([("hot", "y")], "user_id string, country string"))
    out = marts.enrich(sales, users)
    assert out.groupBy("country").count().filter("country = 'y'").first()["count"] == 20_000
    out.collect()
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()


def test_no_heavy_keys_in_small_input(spark):
    assert heavy_keys(left(spark), "k") == []


def test_sampled_keys_are_found(spark):
    policy = SkewPolicy(min_bytes=0, min_hits=400, cell_rows=10_000)
    df = spark.range(0, 100_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k")
    )
    found = heavy_keys(df, "k", policy)
    assert [k for k, _ in found] == [-1]


def test_enrich_keeps_every_sale(spark, rows):
    sales = left(spark).withColumnsRenamed({"k": "customer_id", "v": "order_id"})
    users = right(spark).withColumnsRenamed({"rk": "user_id", "w": "country"})
    out = marts.enrich(sales, users)
    assert out.columns == ["customer_id", "order_id", "country"]
    assert out.count() == 3000
    assert out.filter("customer_id is null and country is not null").count() == 0


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "k string")
    assert [tuple(r) for r in marts.duplicate_keys(df, "k").collect()] == [("a", 2)]


def test_daily_region(spark):
    inf = float("inf")
    df = spark.createDataFrame(
        [
            ("2024-01-01", "a", 2, 3.0), ("2024-01-01", "a", None, None),
            ("2024-01-01", "b", 1, 0.1), ("2024-01-01", "b", 1, 0.2),
            (None, None, 1, inf), (None, None, 1, float("nan")), (None, None, 1, 1e300),
        ],
        "d string, region string, quantity int, revenue double",
    ).withColumn("order_date", F.to_date("d"))
    out = {
        (str(r["order_date"]), r["region"]): (r["order_count"], r["units"], r["revenue"])
        for r in marts.daily_region(df).collect()
    }
    assert out[("2024-01-01", "a")] == (2, 2, 3)
    assert str(out[("2024-01-01", "b")][2]) == "0.3000"
    assert out[("None", None)] == (3, 3, None)


def test_daily_region_combines_before_the_shuffle(spark, plan):
    df = spark.createDataFrame(
        [], "order_date date, region string, quantity int, revenue double"
    )
    assert "partial_sum" in plan(marts.daily_region(df))
