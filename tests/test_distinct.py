"""Merged distinct counts against counting the rows."""

from pyspark.sql import functions as F

from orderpulse.operators import distinct


def rows(spark, n=20_000):
    value = "IF(id % 17 = 0, NULL, IF(id % 3 = 0, 'hot', concat('v', pmod(xxhash64(id), 3000))))"
    return spark.range(n).selectExpr("id", "date_add(DATE'2025-01-01', CAST(id % 40 AS INT)) AS day", f"{value} AS value")


def test_any_range_of_days_counts_exactly(spark, tmp_path):
    data = rows(spark)
    numbers = distinct.numbered(data, "value")
    numbers.write.parquet(f"{tmp_path}/numbers")
    numbers = spark.read.parquet(f"{tmp_path}/numbers")
    assert numbers.count() == numbers.select("number").distinct().count() == data.select("value").dropna().distinct().count()
    assert numbers.agg(F.max("number")).first()[0] < 20 * distinct.LANES
    days = distinct.daily_bitmaps(data, F.col("day"), "value", numbers)
    days.write.parquet(f"{tmp_path}/days")
    days = spark.read.parquet(f"{tmp_path}/days")
    week = F.date_trunc("WEEK", "day").alias("week")
    got = {r.week: r.values for r in distinct.distinct_over(days, week).collect()}
    assert got == {r.week: r.n for r in data.groupBy(week).agg(F.count_distinct("value").alias("n")).collect()}
    some = F.col("day").between("2025-01-05", "2025-01-19")
    assert distinct.distinct_over(days.filter(some)).first()[0] == data.filter(some).select(F.count_distinct("value")).first()[0]
    assert "Expand" not in distinct.distinct_over(days, week)._jdf.queryExecution().executedPlan().toString()
    assert distinct.distinct_over(days.limit(0)).first()[0] == 0


def test_known_values_keep_their_numbers(spark, tmp_path):
    data = rows(spark, 6_000)
    first = distinct.numbered(data.filter("id < 2000"), "value")
    first.write.parquet(f"{tmp_path}/first")
    first = spark.read.parquet(f"{tmp_path}/first")
    both = distinct.numbered(data, "value", first)
    both.write.parquet(f"{tmp_path}/both")
    both = {r.value: r.number for r in spark.read.parquet(f"{tmp_path}/both").collect()}
    assert {r.value: r.number for r in first.collect()}.items() <= both.items()
    assert len(set(both.values())) == len(both) == data.select("value").dropna().distinct().count()
