from pyspark.sql import functions as F

from claimlens.operators.rowid import add_row_id, number_of_id, number_rows


def test_ids_are_as_wide_as_the_last_one(spark):
    got = add_row_id(spark.range(11).withColumnRenamed("id", "k"), ["k"]).orderBy("k").collect()
    assert [r.uniqueid for r in got] == [f"id_{i:02d}" for i in range(11)]


def test_empty_frame(spark):
    assert add_row_id(spark.range(0).withColumnRenamed("id", "k"), ["k"]).collect() == []


def test_numbers_follow_the_order_across_partitions_and_a_hot_key(spark):
    df = spark.range(5000).repartition(7).select(
        F.when(F.col("id") % 3 == 0, 42).otherwise(F.col("id") % 100).alias("hot"), F.col("id").alias("k")
    )
    got = [(r.hot, r.k, r.n) for r in number_rows(df, ["hot", "k"], "n").collect()]
    assert [n for _, _, n in sorted(got)] == list(range(5000))


def test_number_inside_an_id(spark):
    got = add_row_id(spark.range(101).withColumnRenamed("id", "k"), ["k"]).select("k", number_of_id().alias("n"))
    assert all(r.k == r.n for r in got.collect())


def test_no_window_over_the_data(spark):
    """The only unpartitioned window runs over one row per partition."""
    plan = number_rows(spark.range(100).withColumnRenamed("id", "k"), ["k"])._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window"):]
    assert "Aggregate" in window.splitlines()[1] or "Aggregate" in window.splitlines()[2]
