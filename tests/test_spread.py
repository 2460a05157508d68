"""Rows dealt out before costly work, whatever the cut of their files."""

from pyspark.sql import functions as F

from tidemart.adapters import star_schema as star
from tidemart.adapters.star_schema import Tables


def events(spark, folder, rows=4_000):
    """One file of one row group, read by several tasks of which one has all rows."""
    kinds = "element_at(array('click', 'error', 'purchase', 'signup', 'view'), cast(id % 5 as int) + 1)"
    df = spark.range(rows).selectExpr(
        "id event_id", "timestamp_seconds(1700000000 + id) ts", "id % 50 user_id", f"{kinds} event_type", "1.5 value",
        "concat('{\"k\": ', id % 100, '}') props",
    )
    df.coalesce(1).write.parquet(f"{folder}/events.parquet")
    return df


def test_log_lines_do_not_follow_the_cut_of_files(spark, tmp_path):
    events(spark, tmp_path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    # Many partitions of the scan, one of which has the row group.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        tables = Tables(spark, str(tmp_path))
        assert tables("events").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        counts = [r["count"] for r in star.log_lines(tables).groupBy(F.spark_partition_id()).count().collect()]
        assert sum(counts) == 5_600 and max(counts) < 500
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_streamed_log_lines_are_dealt_out(spark, tmp_path):
    events(spark, tmp_path, 10)
    lines = star.log_lines(Tables(spark, str(tmp_path), streaming=True))
    assert lines.isStreaming and "Repartition" in lines._jdf.queryExecution().analyzed().toString()
